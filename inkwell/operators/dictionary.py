"""Dictionary entities in texts: mentions, gates, TF-IDF, names and CURIEs.

Single-token names are found by tokenising once and joining on the token;
names with spaces or marks by a leftmost-longest matcher over compact arrays,
which are broadcast in parts of a bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from inkwell.functions.text import words
from inkwell.sources.storage import stored

#: The longest list of names that is broadcast.
MOST_NAMES = 1_000_000
#: Names, and their bytes, that one index for matching in texts has at most.
MATCHED_NAMES, MATCHED_BYTES = 1_000_000, 64 << 20
#: A run of letters and digits, or any other character.
PIECE = re.compile(r"[^\W_]+|[\W_]")
TRIM = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, token: the words of each text, without marks at their ends."""
    each = docs.select(key, F.explode(words(F.col(text))).alias("w"))
    return each.select(key, F.regexp_replace("w", TRIM, "").alias("token")).where("token <> ''")


def mentions(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", fold: bool = True) -> DataFrame:
    """key, token, n: how often each text has each name, compared in lower case if ``fold``."""
    found = tokens(docs, key, text)
    own = names.select("name")
    if fold:
        found, own = found.withColumn("token", F.lower("token")), own.select(F.lower("name").alias("name"))
    own = own.distinct().withColumnRenamed("name", "token")
    if own.limit(MOST_NAMES + 1).count() <= MOST_NAMES:
        # The list comes to the tokens, so only those that are names are ever counted or shuffled.
        found = found.join(F.broadcast(own), "token", "left_semi")
        return found.groupBy(key, "token").agg(F.count("*").alias("n"))
    # A longer list: counts first, so that what is joined has a row for each distinct token of a text.
    counted = found.groupBy(key, "token").agg(F.count("*").alias("n"))
    return counted.join(own, "token", "left_semi").select(key, "token", "n")


def idf(counts: DataFrame, n_docs: int | Column, key: str = "doc_id") -> DataFrame:
    """token, df and idf = ln((N + 1) / (df + 1)) + 1 from (key, token, ...) rows that are distinct."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return counts.groupBy("token").agg(F.count(key).alias("df")).withColumn("idf", F.ln((n + 1) / (F.col("df") + 1)) + 1)


def tfidf_gate(counts: DataFrame, idfs: DataFrame, threshold: float, least: int, key: str = "doc_id") -> DataFrame:
    """Tokens that pass: ``least`` mentions, and tf * idf of the threshold.

    tf is the count over the text's number of distinct names; an unknown token
    or a product of zero scores the threshold itself.
    """
    sizes = counts.groupBy(key).agg(F.count("*").alias("__distinct"))
    scored = counts.join(sizes, key).join(idfs.select("token", "idf"), "token", "left")
    product = F.col("n") / F.col("__distinct") * F.col("idf")
    score = F.when(product.isNull() | (product == 0), F.lit(float(threshold))).otherwise(product)
    passed = (F.col("n") >= least) & ((F.lit(threshold) <= 0) | (score >= threshold))
    return scored.select(key, "token", "n", score.alias("tfidf")).where(passed)


def resolve(names: DataFrame, curated: DataFrame, name: str = "name", *, strict: bool = False) -> DataFrame:
    """``names`` with ``curie``: by exact name, else by upper case; others are dropped (or raise if ``strict``)."""
    exact = curated.groupBy(F.col("name").alias("__name")).agg(F.max("curie").alias("__exact"))
    folded = curated.groupBy(F.upper("name").alias("__upper")).agg(F.max("curie").alias("__folded"))
    joined = names.join(exact, F.col(name) == F.col("__name"), "left").join(folded, F.upper(name) == F.col("__upper"), "left")
    curie = F.coalesce("__exact", "__folded")
    if strict:
        curie = F.coalesce(curie, F.raise_error(F.concat(F.lit("no CURIE for "), F.col(name))).cast("string"))
    return joined.select(*names.columns, curie.alias("curie")).where("curie is not null")


def display_names(curies: DataFrame, curated: DataFrame) -> DataFrame:
    """``curies`` with the last name of each CURIE, or the CURIE itself."""
    last = curated.groupBy("curie").agg(F.max("name").alias("__name"))
    return curies.join(last, "curie", "left").select(*curies.columns, F.coalesce("__name", "curie").alias("name"))


def no_shouting_twins(names: DataFrame, key: str, name: str) -> DataFrame:
    """Without names in capitals that the same text also has in another case."""
    cased = names.where(F.col(name) != F.upper(name)).select(key, F.upper(name).alias(name)).distinct()
    return names.join(cased, [key, name], "left_anti")


def lowered(text: str) -> str:
    """In lower case, at the same places: letters whose lower case is longer stay as they are."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def first_piece(text: str) -> str:
    """The run of letters and digits that a text begins with, or its first character if that is none."""
    return PIECE.match(text)[0]


class NameIndex(NamedTuple):
    """Names for leftmost-longest matching, in arrays of about forty bytes a name.

    A name is found by its first piece: the pieces' hashes, in order, lead to
    the lengths of the names that begin with them, longest first. Names are
    found by their hashes and then compared, so no two are ever confused.
    """

    fold: bool
    pieces: np.ndarray  # hashes, in order
    first: np.ndarray  # of each piece's lengths, and one more
    lengths: np.ndarray
    hashes: np.ndarray  # of the names as compared, in order
    begin: np.ndarray  # of each name's bytes, and the end of all
    data: bytes
    shown: list[str] | None  # names as they are given, where folding changed any

    @classmethod
    def of(cls, names: Iterable[str], fold: bool = False) -> NameIndex:
        """Of names that are equal when folded, the last in order counts."""
        own = {(lowered(n) if fold else n): n for n in sorted(names) if n}
        keys = sorted(own, key=lambda n: xxhash.xxh64_intdigest(n.encode()))
        by: dict[int, set[int]] = {}
        for n in keys:
            by.setdefault(xxhash.xxh64_intdigest(first_piece(n).encode()), set()).add(len(n))
        pieces = sorted(by)
        data = [n.encode() for n in keys]
        return cls(
            fold, np.array(pieces, dtype=np.uint64), np.cumsum([0, *(len(by[p]) for p in pieces)]), np.array([n for p in pieces for n in sorted(by[p], reverse=True)], dtype=np.int32),
            np.array([xxhash.xxh64_intdigest(d) for d in data], dtype=np.uint64), np.cumsum([0, *map(len, data)]), b"".join(data), [own[n] for n in keys] if any(n != own[n] for n in keys) else None,
        )

    def named(self, text: str) -> str | None:
        """The name that ``text``, folded if names are, is."""
        own = text.encode()
        h = np.uint64(xxhash.xxh64_intdigest(own))
        at = int(np.searchsorted(self.hashes, h))
        while at < len(self.hashes) and self.hashes[at] == h:
            if self.data[self.begin[at] : self.begin[at + 1]] == own:
                return self.shown[at] if self.shown else text
            at += 1
        return None

    def find(self, text: str, overlapping: bool = False) -> Iterator[tuple[str, int, int]]:
        """(name, start, end) of the longest name at the leftmost place, again and again; none begins or ends inside a run of letters and digits.

        ``overlapping``: of the longest name at every place.
        """
        seen = lowered(text) if self.fold else text
        pieces = list(PIECE.finditer(seen))
        if not pieces or not len(self.pieces):
            return
        hashes = np.array([xxhash.xxh64_intdigest(m[0].encode()) for m in pieces], dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.pieces, hashes), len(self.pieces) - 1)
        behind, size = 0, len(text)
        for i in np.flatnonzero(self.pieces[at] == hashes).tolist():
            start = pieces[i].start()
            if start < behind and not overlapping:
                continue
            for n in self.lengths[self.first[at[i]] : self.first[at[i] + 1]].tolist():
                end = start + n
                inside = end < size and seen[end].isalnum() and seen[end - 1].isalnum()
                if end <= size and not inside and (name := self.named(seen[start:end])) is not None:
                    yield name, start, end
                    behind = end
                    break


def longest_matches(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", fold: bool = False, most: int = MATCHED_NAMES, most_bytes: int = MATCHED_BYTES) -> DataFrame:
    """key, name, start, end of each match of ``names`` (name).

    Up to ``most`` names of ``most_bytes`` in all are broadcast as one index. A
    longer list is cut by a hash of the names' first pieces: names that can
    begin at the same place are in one part, so each part finds the longest of
    them there, and of all parts' matches of a text the leftmost ones that don't
    overlap are kept. Only matches are shuffled then.
    """
    spark = docs.sparkSession
    own = names.select("name").where("name <> ''").distinct()
    n, held = own.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("name")), F.lit(0))).first()
    parts = max(1, -(-n // most), -(-held // most_bytes))
    schema = T.StructType([T.StructField("__key", docs.schema[key].dataType), *T.StructType.fromDDL("name string, start int, end int").fields])

    def matched(rows: DataFrame, listed: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast(NameIndex.of(listed, fold))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found = [(k, *m) for k, t in zip(batch.column("__key").to_pylist(), batch.column("__text").to_pylist(), strict=True) if t for m in index.find(t, parts > 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True) if found else [[]] * 4, pa_schema, strict=True)], schema=pa_schema)

        return rows.mapInArrow(run, schema)

    pa_schema = to_arrow_schema(schema)
    if parts == 1:
        rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
        return matched(rows, [r.name for r in own.collect()]).withColumnRenamed("__key", key)
    # Rows get numbers of their own, as a key may have several.
    numbered = stored(docs.select(F.col(key).alias("__own"), F.col(text).alias("__text")).withColumn("__key", F.monotonically_increasing_id()), "texts")
    schema = T.StructType([T.StructField("__key", T.LongType()), *schema.fields[1:]])
    pa_schema = to_arrow_schema(schema)
    dealt = stored(own.withColumn("__part", F.pmod(F.xxhash64(first_pieces(F.lower("name") if fold else F.col("name"))), F.lit(parts))), "names")
    rows = numbered.select("__key", "__text")
    made = [matched(rows, [r.name for r in dealt.where(F.col("__part") == p).select("name").collect()]) for p in range(parts)]
    every = reduce(DataFrame.union, made)

    def leftmost(found: pa.Table) -> pa.Table:
        order = np.lexsort((-found["end"].to_numpy(), found["start"].to_numpy()))
        start, end, kept, behind = found["start"].to_numpy(), found["end"].to_numpy(), [], 0
        for i in order.tolist():
            if start[i] >= behind:
                kept.append(i)
                behind = end[i]
        return found.take(kept)

    best = every.groupBy("__key").applyInArrow(leftmost, schema)
    return numbered.select("__key", F.col("__own").alias(key)).join(best, "__key").drop("__key")


def first_pieces(name: Column) -> Column:
    """What ``first_piece`` gives, or more of the name: equal first pieces give equal values."""
    return F.regexp_extract(name, r"(?s)^([\p{L}\p{N}]+|.)", 1)


def token_ids(names: DataFrame) -> DataFrame:
    """token, id: numbers from 1 in the order of the tokens (0 is unknown).

    Tokens are partitioned by range and numbered within, after the ranges before.
    """
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(names.select("token").distinct().repartitionByRange(parts, "token").withColumn("__part", F.spark_partition_id()), "tokens")
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    bases = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy("token"))
    # As many rows as ranges: a bounded broadcast.
    return ranged.withColumn("__place", place).join(F.broadcast(bases), "__part").select("token", (F.col("__base") + F.col("__place")).alias("id"))
