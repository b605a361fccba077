"""Which allele-like names in a paper are not alleles that it studies.

Rules are rows of a table: to which names a rule applies, and what in the text
speaks against the name. The first row that holds gives the reason. Rules that
count mentions are functions in the same table. A document's text and names are
one row, which meets the rules in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

I = re.IGNORECASE  # noqa: E741

# Names and words that the rules are about.
BACKGROUND_MARKERS = ("ed3", "ed4")
MARKER_GENES = ("dpy-10", "dpy-17", "dpy-20", "unc-4", "unc-32", "unc-52", "rol-6", "lon-2", "lin-15")
MARKER_ALLELES = ("e128", "e120")
COINJECTION_MARKERS = ("su1006",)
HIM_GENES = ("him-5", "him-8")
HIM_ALLELES = ("e1489", "e1490")
BALANCERS = ("ht2", "qc1", "nt1", "min1", "et1", "mt1", "sc1", "szt1", "hin1", "mnc1", "sdp2", "sdp3", "mdf1", "qdf")
BALANCER_ALLELES = ("e937", "q782", "e1259", "q339", "q361", "h661", "mn316", "mn398")
DEGRON_TRANSGENES = ("iesi64", "iesi57", "ca1199", "ca1200")
REAGENTS = ("gfp", "mcherry", "rfp", "yfp", "cfp", "bfp", "dsred", "tdtomato", "venus", "cerulean")
CONTEXT_WORDS = ("allele", "alleles", "mutant", "mutants", "mutation", "mutations", "variant", "variants", "suppressor", "suppressors")
MARKER_WORDS = r"(?:reporter|marker|GFP|mCherry|RFP|YFP|CFP|fluorescent|expressing|expression\s+pattern|visualize|labeled|tag(?:ged)?)"
STUDY_WORDS = (
    r"left[- ]?handed|right[- ]?handed|handedness|helical|super[- ]?coil|cuticle|collagen|body\s+(?:shape|morpholog)|annul[ei]|seam\s+cell|"
    r"ultrastructur|abnormal\s+\w+\s+(?:cuticle|collagen)"
)
INJECTION_WORDS = (
    r"p?rf4|p?fr4|co[- ]?inject\w*|micro\s*inject\w*|injected|(?:co[- ]?)?transform(?:ation|ed|ants?|ing)|transgen\w*|co[- ]?marker|\bmarker\b|"
    r"selection\s+marker|dominant\s+(?:marker|mutation|rol|collagen\s+gene|amino)|marked\s+by|plasmid|cosmid|\barray\b|::|\bp[A-Za-z]{2,}\d|"
    r"\d+\s*(?:ng|µg|ug|mg)\s*/?\s*m?[µuμ]?l"
)
CONTROL_WORDS = r"positive\s+control|negative\s+control|control\s+(?:strain|animal|worm)|used\s+as\s+(?:a\s+)?control|as\s+(?:a\s+)?(?:positive|negative)?\s*control"
DEGRON_WORDS = r"auxin[- ]inducible|AID\s*(?:system|degron)?|plant[- ]specific\s+F[- ]box|TIR1"
YEAST_WORDS = r"yeast|S\.\s*cerevisiae|Saccharomyces|budding\s+yeast|fission\s+yeast|S\.\s*pombe|Schizosaccharomyces"
COMPARED_WORDS = (r"identical\s+to", r"same\s+as", r"equivalent\s+to")
SUPPLEMENT_WORDS = r"(?:fig(?:ure)?\.?\s*\[?|table\s+|movie\s+|video\s+|supplementary\s+(?:fig(?:ure)?|table|movie|video|material)\s*)"

ALLELE = re.compile(r"(?<![A-Za-z0-9_.\-])(?=[A-Za-z0-9_.\-]*\d)[a-z][A-Za-z0-9_.\-]+(?![A-Za-z0-9_.\-])")
ULTRA_SHORT = re.compile(r"[a-z]\d{1,2}")


def any_of(words: tuple[str, ...]) -> str:
    return "|".join(map(re.escape, words))


class Paper(NamedTuple):
    text: str

    def has(self, pattern: str) -> bool:
        return re.search(pattern, self.text, I) is not None

    def count(self, pattern: str) -> int:
        return sum(1 for _ in re.finditer(pattern, self.text, I))


def windows(text: str, c: str, reach: int = 50) -> Iterator[str]:
    """Mentions with what stands within ``reach`` characters of them on their line; windows don't overlap.

    A window begins at most ``reach`` before the first mention that is left,
    and goes on around the last mention that begins within ``reach`` of there.
    """
    mentions = [(m.start(), m.end()) for m in re.finditer(rf"\b{c}\b", text, I)]
    end = k = 0
    while k < len(mentions):
        first = mentions[k][0]
        if first < end:
            k += 1
            continue
        begin = max(end, first - reach, text.rfind("\n", 0, first) + 1)
        while k + 1 < len(mentions) and mentions[k + 1][0] <= begin + reach and "\n" not in text[first : mentions[k + 1][0]]:
            k += 1
        line = text.find("\n", mentions[k][1])
        end = min(mentions[k][1] + reach, len(text) if line < 0 else line)
        yield text[begin:end]
        k += 1


def in_control(paper: Paper, c: str) -> bool:
    """Mentions as a control outweigh the others."""
    control = sum(bool(re.search(CONTROL_WORDS, w, I)) for w in windows(paper.text, c))
    if not control:
        return False
    mentions = paper.count(rf"\b{c}\b")
    return mentions == control or control > mentions // 2


def not_studied(paper: Paper, c: str) -> bool:
    """No mention has a sign of study and none of injection within 150 characters."""
    windows = (paper.text[max(0, m.start() - 150) : m.end() + 150] for m in re.finditer(c, paper.text, I))
    return not any(re.search(STUDY_WORDS, w, I) and not re.search(INJECTION_WORDS, w, I) for w in windows)


def only_compared(paper: Paper, c: str) -> bool:
    named = any(
        any(m[1].lower() == re.sub(r"\\(.)", r"\1", c) for m in re.finditer(rf"{w}\s+(?:the\s+)?(?:\w+-?\d*\s*\()?(\w+)\)?", paper.text, I)) for w in COMPARED_WORDS
    )
    return named and paper.count(rf"\b{c}\b") <= 3


def of_yeast(paper: Paper, c: str) -> bool:
    """A deletion with a word for yeast, or a name beside one; the patterns are fixed values."""
    deleted = paper.has(rf"Δ{c}(?!\w)") and paper.has(YEAST_WORDS)
    return deleted or paper.has(rf"{c}\s+(?:yeast|S\.\s*cerevisiae)|(?:yeast|S\.\s*cerevisiae)\s+{c}")


def mostly_figures(paper: Paper, c: str) -> bool:
    """As many figures and panels of this label as genes with this allele; the patterns are fixed values."""
    panels = paper.count(rf"(?:Fig(?:ure)?\.?\s*\d+\s*|Panel\s+){c}(?!\d)")
    return panels > 0 and panels >= paper.count(rf"\w+-?\d*\s*\(\s*{c}\s*\)")


def mostly_supplements(paper: Paper, c: str) -> bool:
    """More supplements of this name than genes with this allele; the patterns are fixed values."""
    named = paper.count(rf"{SUPPLEMENT_WORDS}{c}(?!\d)")
    return named > 0 and named > paper.count(rf"[a-z]+-\d+\s*\(\s*{c}\s*\)")


def looks_like_allele(text: str, candidate: str) -> bool:
    """Named as gene(candidate), or (unless of one letter and one or two digits) near a word for alleles at its first mention; the patterns and reaches are fixed values."""
    if not text or not candidate:
        return False
    low, c = text.lower(), re.escape(candidate.lower())
    figures = len(re.findall(rf"(?:fig(?:ure)?\.?\s*\d+\s*|panel\s+){c}", text, I))
    if figures and figures >= len(re.findall(rf"\w+-?\d*\s*\(\s*{c}\s*\)", text, I)):
        return False
    if re.search(rf"[a-z][a-z0-9_.-]{{1,15}}\({c}\)", low):
        return True
    at = low.find(candidate.lower())
    if at < 0 or ULTRA_SHORT.fullmatch(candidate.lower()):
        return False
    near = low[max(0, at - 60) : at + len(candidate) + 60]
    return any(w in near for w in CONTEXT_WORDS)


class Rule(NamedTuple):
    reason: str
    names: str  # what the whole name must match, in any case
    holds: str | Callable[[Paper, str], bool] = ""  # evidence in the text, where {c} is the name


def unlike_allele(paper: Paper, c: str) -> bool:
    return not looks_like_allele(paper.text, re.sub(r"\\(.)", r"\1", c))


# The rules' names, and the patterns of names and evidence.
RULES = (
    Rule("transgene marker", r"[a-z]{1,4}Is\d+", rf"{{c}}.{{{{0,50}}}}{MARKER_WORDS}|{MARKER_WORDS}.{{{{0,50}}}}{{c}}"),
    Rule("extrachromosomal array", r"[a-z]{1,4}Ex\d+", rf"{{c}}.{{{{0,50}}}}{MARKER_WORDS}|{MARKER_WORDS}.{{{{0,50}}}}{{c}}"),
    Rule("transposon insertion site", r"ttTi\d+", r"{c}\s*(?:transposon|insertion\s*site|locus|site\s+on\s+chromosome|Mos1|MosSCI)|(?:insert\w*|integrat\w*|MosSCI|single[- ]copy)[^.\n]{{0,40}}\b{c}"),
    Rule("background marker", any_of(BACKGROUND_MARKERS), r"unc-?119\s*\(\s*{c}\s*\)"),
    Rule("genetic marker", any_of(MARKER_ALLELES), rf"(?:{any_of(MARKER_GENES)})\s*\(\s*{{c}}\s*\)"),
    Rule("co-injection marker", any_of(COINJECTION_MARKERS), not_studied),
    Rule("male-production marker", any_of(HIM_ALLELES), rf"(?:{any_of(HIM_GENES)})\s*\(\s*{{c}}\s*\)"),
    Rule("control allele", ".+", in_control),
    Rule("balancer chromosome name", any_of(BALANCERS), r"\b{c}(?:/\+)?\s*(?:\[|with|strain|balancer)"),
    Rule("balancer allele", any_of(BALANCER_ALLELES), rf"(?:{any_of(BALANCERS)})[^;\n.]{{{{0,150}}}}\b{{c}}\b"),
    Rule("degron system reagent", "tir1", DEGRON_WORDS),
    Rule("degron system transgene", any_of(DEGRON_TRANSGENES), DEGRON_WORDS),
    Rule("yeast gene or strain", ".+", of_yeast),
    Rule("reference-only mention", ".+", only_compared),
    Rule("histone or protein name", r"h[1234][abx]?", unlike_allele),
    Rule("measurement", r"[td]\d{1,2}|\d+[munp]?[mc]", unlike_allele),
    Rule("reagent name", any_of(REAGENTS)),
    Rule("figure or panel label", ".{1,3}", mostly_figures),
    Rule("supplementary reference", r"s\d+", mostly_supplements),
)


def rejection(text: str | None, candidate: str | None) -> str | None:
    """Why ``candidate`` isn't an allele that ``text`` studies: ``reason (candidate)``, or None."""
    if not text or not candidate:
        return None
    paper, c = Paper(text), re.escape(candidate.lower())
    for rule in RULES:
        if not re.fullmatch(rule.names, candidate, I):
            continue
        if not rule.holds or (rule.holds(paper, c) if callable(rule.holds) else paper.has(rule.holds.format(c=c))):
            return f"{rule.reason} ({candidate})"
    return None


def rescued(text: str | None, found: list[str], case_sensitive: bool = False) -> list[str]:
    """Allele-like names of the text that weren't found; ultra-short ones need the context of an allele."""
    fold = (lambda s: s) if case_sensitive else str.lower
    seen, out = set(map(fold, found)), []
    for m in ALLELE.finditer(text or ""):
        name = fold(m[0].rstrip("."))
        if len(name) < 2 or name in seen or (ULTRA_SHORT.fullmatch(name.lower()) and not looks_like_allele(text, name)):
            continue
        seen.add(name)
        out.append(name)
    return out


def judged(docs: DataFrame, text: str, names: str, key: str, curated: DataFrame | None = None, chain: bool = False) -> DataFrame:
    """key, name, reason: why each of a document's ``names`` (an array) is to be rejected, null for the kept ones.

    A document is one row with all its names, so its text is sent once and
    never shuffled. ``chain``: short names need context, further names are
    rescued from the text, and dots are stripped before the rules. Of
    ``curated`` (name), other names are left out; reasons don't depend on it.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, t, own in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "names")), strict=True):
                own = [n for n in own or [] if n]
                for n in chained(t, own) if chain else dict.fromkeys(own):
                    rows.append((k, n, rejection(t, n)))
            columns = zip(*rows, strict=True) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.column("key").type, pa.string(), pa.string()), strict=True)], names=["key", "name", "reason"])

    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(names).alias("names")).mapInArrow(run, f"key {kind}, name string, reason string")
    if curated is not None:
        found = found.join(curated.select("name").distinct(), "name", "left_semi")
    return found.select(F.col("key").alias(key), "name", "reason")


def chained(text: str | None, found: list[str]) -> list[str]:
    """The names that the rules decide on: found ones with context if short, then rescued ones, without dots at their ends."""
    names = [n for n in found if not ULTRA_SHORT.fullmatch(n.lower()) or looks_like_allele(text, n)]
    return [n for n in dict.fromkeys(n.rstrip(".") for n in [*names, *rescued(text, names, True)]) if n]


def category(reason: Column) -> Column:
    """What a reason says, without the name that it says it of."""
    return F.trim(F.substring_index(reason, "(", 1))


def reasons(judged_names: DataFrame) -> DataFrame:
    """category, n: how many names each kind of reason rejects."""
    return judged_names.where("reason is not null").groupBy(category(F.col("reason")).alias("category")).agg(F.count("*").alias("n"))
