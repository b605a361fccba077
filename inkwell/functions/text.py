"""Text functions as Column expressions.

Patterns follow Java's dialect; ``(?U)`` where word classes must be Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of which entity-like tokens are made.
TOKEN_RUN = r"[A-Za-z0-9_.\-]+"
STRAIN_RUN = r"[A-Za-z0-9](?:[A-Za-z0-9_-]|\([A-Za-z0-9]+\))*"
SPECIES_NAME = r"\b[A-Z][a-z]+(?:\s[a-z]+)+"
BOW_TOKEN = r"(?U)\b[\w-]{2,}\b"

# Prefixes and numerals that disqualify an entity-like token.
NOT_ENTITY_PREFIX = ("fig", "sup", "sub", "sec", "eq", "lt", "gt", "amp")
ROMAN_NUMERAL = "^[ivxlcdm]+$"


def distinct_runs(text: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)))


def generic_tokens(text: Column) -> Column:
    """Maximal token runs of two characters or more with a letter and a digit."""
    return F.filter(distinct_runs(text, TOKEN_RUN), lambda t: (F.length(t) >= 2) & t.rlike("[A-Za-z]") & t.rlike("[0-9]"))


def allele_tokens(text: Column) -> Column:
    """Generic tokens that begin with a lower-case letter."""
    return F.filter(generic_tokens(text), lambda t: t.rlike("^[a-z]"))


def strain_tokens(text: Column) -> Column:
    whole = F.regexp_extract_all(text, F.lit(f"(?<![A-Za-z0-9])({STRAIN_RUN})(?![A-Za-z0-9])"), F.lit(1))
    return F.filter(F.array_distinct(whole), lambda t: t.rlike("[A-Za-z]") & t.rlike("[0-9]"))


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def looks_like_entity(token: Column) -> Column:
    """A letter and a digit, two characters or more, no figure or markup prefix, no roman numeral."""
    low = F.lower(token)
    prefixed = F.lit(False)
    for p in NOT_ENTITY_PREFIX:
        prefixed = prefixed | low.startswith(p)
    return (F.length(token) >= 2) & token.rlike("[A-Za-z]") & token.rlike("[0-9]") & ~prefixed & ~low.rlike(ROMAN_NUMERAL)


def mined_tokens(text: Column) -> Column:
    """Sorted entity-like tokens, as sentences of one token each."""
    runs = F.transform(distinct_runs(text, TOKEN_RUN), lambda t: F.regexp_replace(t, r"^[._-]+|[._-]+$", ""))
    return F.array_sort(F.array_distinct(F.filter(runs, looks_like_entity)))


def with_mined_tokens(text: Column) -> Column:
    mined = mined_tokens(text)
    return F.when(F.size(mined) > 0, F.concat(text, F.lit(" "), F.array_join(mined, ". "), F.lit("."))).otherwise(text)


def prefiltered(text: Column, pattern: str) -> Column:
    """Sentences that match, joined; the full text where none does."""
    kept = F.array_join(F.filter(sentences(text), lambda s: s.rlike(pattern)), " ")
    return F.coalesce(F.nullif(kept, F.lit("")), text)


def without_markup(html: Column) -> Column:
    plain = F.regexp_replace(html, r"<[^<]+>", " ")
    for name, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(name), F.lit(mark))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def closed_sentence(text: Column) -> Column:
    return F.when(text.endswith("."), text).otherwise(F.concat(text, F.lit(".")))


def plain_dashes(sentence: Column) -> Column:
    """Padded with spaces, en dashes and hyphens as plain hyphens."""
    return F.concat(F.lit(" "), F.translate(sentence, "–‐", "--"), F.lit(" "))


def file_name(curie: Column) -> Column:
    return F.replace(curie, F.lit(":"), F.lit("_"))


def curie_of(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(":"))


def without_trailing_dots(names: Column) -> Column:
    """First-seen distinct names without trailing dots."""
    return F.array_distinct(F.filter(F.transform(names, lambda n: F.regexp_replace(n, r"\.+$", "")), lambda n: n != ""))


def taxon_id(curie: Column) -> Column:
    return F.nullif(F.regexp_extract(curie, r"^(?:NCBITaxon:)?(\d+)$", 1), F.lit(""))


def cache_key(names: Column) -> Column:
    """16 hex digits of the SHA-1 of the sorted distinct names as a JSON list with ", " between."""
    listed = F.array_join(F.transform(F.array_sort(F.array_distinct(names)), lambda n: F.concat(F.lit('"'), n, F.lit('"'))), ", ")
    return F.substring(F.sha1(F.concat(F.lit("["), listed, F.lit("]"))), 1, 16)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def without_stop_words(text: Column, stop: list[str]) -> Column:
    """Words that aren't stop words (compared as written), then in lower case."""
    return F.lower(F.array_join(F.filter(words(text), lambda w: ~w.isin(*stop)), " "))


def object_path(md5: Column, environment: str) -> Column:
    """Folders of an object store from the first four hex digits of a checksum."""
    parts = [F.substring(md5, k, 1) for k in range(1, 5)]
    return F.concat_ws("/", F.lit(environment), F.lit("reference/documents"), *parts, F.concat(md5, F.lit(".gz")))


def merged_pieces(tokens: Column) -> Column:
    """Words from word pieces, where a piece that begins with ## goes on with the word before it."""

    def step(done: Column, piece: Column) -> Column:
        last = F.concat(F.element_at(done, -1), F.substring(piece, 3, 1 << 20))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(last))
        return F.when(piece.startswith("##") & (F.size(done) > 0), grown).otherwise(F.concat(done, F.array(piece)))

    return F.aggregate(tokens, F.array().cast("array<string>"), step)


LINK = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*specific_papers=WBPaper[^\"']*)[\"']"
LISTED = r"(?is)<textarea\b[^>]*?\bname\s*=\s*[\"']specific_papers[\"'][^>]*>(.*?)</textarea>"


def paper_ids(html: Column) -> Column:
    """Paper ids of links to lists of papers and of the list's text field, in the order of their first occurrence.

    In the field, a word of eight digits is an id without its prefix; any word with the prefix counts as it is.
    """
    linked = F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lambda h: F.regexp_extract(h, r"WBPaper\d{8}", 0))
    words = F.split(F.trim(F.regexp_replace(F.regexp_extract(html, LISTED, 1), r"\s+", " ")), " ")
    named = F.transform(words, lambda w: F.when(w.startswith("WBPaper"), w).when(w.rlike(r"^\d{8}$"), F.concat(F.lit("WBPaper"), w)))
    return F.array_distinct(F.filter(F.concat(linked, named), lambda p: p.isNotNull() & (p != "")))
