"""Sentence rules that tell papers with antibodies, as data and Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import plain_dashes

# Fixed values of the rules.
EXCLUDED_GENES = ("PDI",)
EXTRA_ANTI_KEYWORDS = ("MSP",)
EXTRA_KEYWORDS = ("MH46", "SP56", "a-SP56")
PREPARATION_WORDS = (
    "preparation", "prepared", "prepare", "production", "purification", "generation", "generate",
    "generated", "produce", "produced", "purify", "purified", "raised",
)
ANTIBODY_WORDS = ("antiserum", "antibody", "antibodies", "antisera")
OPENS, CLOSES = r"[\s(\[{.,;:'\"<]", r"[\s.;:,'\")\]}>?]"


def quoted(word: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in word)


def anti_gene(sentence: Column, genes: list[str]) -> Column:
    """``anti-GENE`` where the part after the dash has an upper-case letter."""
    names = {g.lower() for g in genes} - {g.lower() for g in EXCLUDED_GENES} | {k.lower() for k in EXTRA_ANTI_KEYWORDS}
    pattern = f"(?iu){OPENS}(anti-(?:{'|'.join(quoted(n) for n in sorted(names))}|C\\. elegans)){CLOSES}"
    found = F.regexp_extract_all(sentence, F.lit(pattern), F.lit(1))
    return F.filter(found, lambda m: F.substring(m, 6, 1 << 20) != F.lower(F.substring(m, 6, 1 << 20)))


def keywords(sentence: Column, extra: tuple[str, ...] = EXTRA_KEYWORDS) -> Column:
    return F.regexp_extract_all(sentence, F.lit(f"{OPENS}({'|'.join(map(quoted, extra))}){CLOSES}"), F.lit(1))


def combinations(low: Column, first: tuple[str, ...] = PREPARATION_WORDS, second: tuple[str, ...] = ANTIBODY_WORDS) -> Column:
    """``a b`` for each pair of words that a lower-case sentence has in either order on one line.

    Words that the sentence doesn't contain are dropped before any pattern
    runs, so most sentences cost a few substring searches.
    """
    there = lambda names: F.filter(F.array(*map(F.lit, names)), lambda w: F.contains(low, w))
    pairs = F.flatten(F.transform(there(first), lambda a: F.transform(there(second), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    # From the first x of the first line, or one that ends it: linear, where ``.*x\s.*y`` is quadratic.
    rule = lambda x, y: F.concat(F.lit("(?d)^(?:(?:(?!"), x, F.lit(r"\s).)*+"), x, F.lit(r"\s|.*"), x, F.lit(r"\n).*?"), y, F.lit(CLOSES))
    hits = F.filter(pairs, lambda p: F.rlike(low, rule(p["a"], p["b"])) | F.rlike(low, rule(p["b"], p["a"])))
    return F.transform(hits, lambda p: F.concat_ws(" ", p["a"], p["b"]))


def matches(df: DataFrame, sentence: str, genes: list[str], first: tuple[str, ...] = PREPARATION_WORDS, second: tuple[str, ...] = ANTIBODY_WORDS, extra: tuple[str, ...] = EXTRA_KEYWORDS, name: str = "match") -> DataFrame:
    """``df`` without ``sentence``, a row for each match of any rule in it."""
    rest = [c for c in df.columns if c != sentence]
    padded = df.select(*rest, plain_dashes(F.col(sentence)).alias("__s"))
    both = padded.select(*rest, "__s", F.lower("__s").alias("__low"))
    found = F.concat(anti_gene(F.col("__s"), genes), combinations(F.col("__low"), first, second), keywords(F.col("__s"), extra))
    return both.select(*rest, F.explode(found).alias(name))


def note(matches: Column) -> Column:
    """Sorted distinct matches joined by a comma, null if none."""
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(matches)), ", "), F.lit(""))
