"""Species names: spaces, abbreviations, common names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common names and their species.
COMMON_NAMES = {
    "human": "Homo sapiens", "humans": "Homo sapiens",
    "mouse": "Mus musculus", "mice": "Mus musculus", "murine": "Mus musculus",
    "rat": "Rattus norvegicus", "rats": "Rattus norvegicus",
    "bovine": "Bos taurus", "cow": "Bos taurus", "cows": "Bos taurus", "calf": "Bos taurus", "calves": "Bos taurus",
    "zebrafish": "Danio rerio", "danio": "Danio rerio",
    "fruitfly": "Drosophila melanogaster", "fruit fly": "Drosophila melanogaster", "fruitflies": "Drosophila melanogaster",
    "fruit-flies": "Drosophila melanogaster", "fruit-fly": "Drosophila melanogaster",
    "budding yeast": "Saccharomyces cerevisiae S288C", "budding-yeast": "Saccharomyces cerevisiae S288C",
    "fission yeast": "Schizosaccharomyces pombe", "fission-yeast": "Schizosaccharomyces pombe",
}
# Epithets that tell the genus of an abbreviation.
GENUS_OF = {
    "elegans": "Caenorhabditis", "melanogaster": "Drosophila", "rerio": "Danio", "musculus": "Mus",
    "norvegicus": "Rattus", "cerevisiae": "Saccharomyces", "pombe": "Schizosaccharomyces",
}
# Fixed value: an initial that a closing tag parts from its epithet.
SPLIT_INITIAL = re.compile(r"([A-Z])\.\s*</[^>]+>\s*([a-z])")


def normal_spaces(text: str | None) -> str:
    """Compatibility-composed, initials joined over markup, all white space as single spaces."""
    if not text:
        return ""
    return " ".join(SPLIT_INITIAL.sub(r"\1. \2", unicodedata.normalize("NFKC", text)).split())


def abbreviations(name: Column) -> Column:
    """``G. s``, ``G.s`` and ``G s`` of a binomial (and ``G.tail`` of a longer name); empty for a single word."""
    parts = F.split(name, " ")
    initial, tail = F.substring(parts[0], 1, 1), F.array_join(F.slice(parts, 2, 100), " ")
    short = F.array(F.concat(initial, F.lit(". "), tail), F.concat(initial, F.lit("."), F.get(parts, F.lit(1))), F.concat(initial, F.lit(" "), tail))
    longer = F.when(F.size(parts) > 2, F.array(F.concat(initial, F.lit("."), tail))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(parts) >= 2, F.array_distinct(F.concat(short, longer))).otherwise(F.array().cast("array<string>"))


def alias_table(names: DataFrame, column: str = "name") -> DataFrame:
    """alias (lower case), canonical: curated names and abbreviations, over which common names win; longest first by ``rank``."""
    own = names.select(F.col(column).alias("canonical"), F.explode(F.concat(F.array(column), abbreviations(F.col(column)))).alias("alias"))
    own = own.select(F.lower("alias").alias("alias"), "canonical", F.lit(0).alias("priority"))
    common = names.sparkSession.createDataFrame([(a, c, 1) for a, c in COMMON_NAMES.items()], "alias string, canonical string, priority int")
    best = own.unionByName(common).groupBy("alias").agg(F.max_by("canonical", F.struct("priority", "canonical")).alias("canonical"))
    return best


def expand_abbreviations(text: Column) -> Column:
    """``C. elegans`` and the like with the full genus, by the epithet."""
    for epithet, genus in GENUS_OF.items():
        text = F.regexp_replace(text, f"\\b{genus[0]}\\.?\\s*{epithet}\\b", f"{genus} {epithet}")
    return text


class AliasReplacer:
    """Replaces aliases, longest first and bounded by letters and digits, whatever their case."""

    def __init__(self, aliases: Iterable[tuple[str, str]]):
        self.canonical = {a.lower(): c for a, c in aliases}
        names = sorted(self.canonical, key=lambda a: (-len(a), a))
        self.pattern = re.compile(r"(?<![A-Za-z0-9])(?:" + "|".join(map(re.escape, names)) + r")(?![A-Za-z0-9])", re.IGNORECASE) if names else None

    def __call__(self, text: str | None) -> str:
        text = normal_spaces(text)
        return self.pattern.sub(lambda m: self.canonical[m[0].lower()], text) if self.pattern else text


def replace_aliases(df: DataFrame, column: str, aliases: dict[str, str]) -> DataFrame:
    """``df`` with aliases in ``column`` replaced; one compiled pattern per Python worker."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(aliases.items()))

    @F.pandas_udf("string")
    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        replacer = AliasReplacer(shared.value)
        for batch in batches:
            yield batch.map(replacer)

    return df.withColumn(column, replaced(F.col(column)))
