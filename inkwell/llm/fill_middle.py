"""Fill-in-the-middle rows: prefix, middle and suffix of a text change places between markers.

A text's units are its runs of ASCII letters and its other characters, one
each. A text is stored as its maximal runs of one class (letters or others)
with the units before each run: a run of letters counts one unit, a run of
others as many as it has characters. The run that holds a cut is found by
binary search in those sums, and the cut's place in it follows by arithmetic,
so no list of units is ever made. All texts of a slice share one such table.

The cuts and the form are drawn from the SHA-256 of ``seed:key``.

* ``plain``: the text, for empty texts, texts that hold a marker, and a tenth.
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle.
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

No text with markers of its own is changed, and no marker can arise where a
part meets a marker, so ``restored`` finds the parts again by the first marker
of each kind.

Defined results: a null text is empty; a null key is drawn as an empty one;
repeated rows and equal keys get equal draws; texts of any length are worked on
whole, in slices of bounded bytes beyond the longest text; an empty table gives
no row. Extra columns, whatever their names, are ignored by ``fill_in_middle``
and stay as they are in ``transformed_documents``.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.llm import common

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
SEED = 1
#: Of a hundred texts: from which draw on a text stays plain, and below which one its suffix comes first.
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20


class Runs(NamedTuple):
    """The maximal class runs of several texts that follow each other."""

    start: np.ndarray  # of each run, in characters, and the end of all
    units: np.ndarray  # before each run, and all of them
    letters: np.ndarray  # whether each run is one of letters, and one more
    first: np.ndarray  # the number of each text's first run, and one more
    begin: np.ndarray  # of each text, in characters

    @classmethod
    def of(cls, texts: list[str]) -> Runs:
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        begin = np.cumsum(sizes) - sizes
        folded = codes | np.uint32(32)
        letter = (folded >= ord("a")) & (folded <= ord("z"))
        edge = np.ones(len(codes), dtype=bool)
        edge[1:] = letter[1:] != letter[:-1]
        edge[begin[sizes > 0]] = True
        start = np.flatnonzero(edge)
        letters = letter[start]
        length = np.diff(start, append=len(codes))
        units = np.concatenate([[0], np.cumsum(np.where(letters, 1, length))])
        return cls(np.append(start, len(codes)), units, np.append(letters, False), np.append(np.searchsorted(start, begin), len(start)), begin)

    def counts(self) -> np.ndarray:
        """Units of each text."""
        return np.diff(self.units[self.first])

    def places(self, cuts: np.ndarray) -> np.ndarray:
        """Characters of each text before its first ``cuts`` units."""
        wanted = self.units[self.first[:-1]] + cuts
        run = np.searchsorted(self.units, wanted, side="right") - 1
        # A cut within a run of letters is one at its start: the run is a single unit.
        inside = np.where(self.letters[run], 0, wanted - self.units[run])
        return self.start[run] + inside - self.begin


def draws(key: object, seed: int = SEED) -> tuple[int, int, int, int]:
    """The first four unsigned 32-bit numbers, high byte first, of the SHA-256 of ``seed:key``."""
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()[:16])


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """key, n, form, prefix_chars, middle_chars and output; the two in code points, null for plain texts."""
    made = formed(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), seed)
    return made.select(F.col("key").alias(key), *[c for c in made.columns if c != "key"])


def formed(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` (key, text and more) with n, form, prefix_chars, middle_chars and output in place of the text."""
    carried = [c for c in rows.columns if c != "text"]
    shape = StructType([rows.schema[c] for c in carried]).add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, "text"):
            drawn = np.array([draws(k, seed) for k in batch.column("key").to_pylist()], dtype=np.int64).reshape(-1, 4)
            runs = Runs.of(texts)
            n = runs.counts()
            low, high = (runs.places(f(drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1))).tolist() for f in (np.minimum, np.maximum))
            forms, prefixes, middles, outputs = [], [], [], []
            for t, a, b, h3, h4 in zip(texts, low, high, *drawn[:, 2:].T.tolist(), strict=True):
                if plain := not t or h3 % 100 >= PLAIN_FROM or any(m in t for m in MARKERS):
                    form, made = "plain", t
                elif h4 % 100 < SUFFIX_FIRST_BELOW:
                    form, made = "spm", f"{SUFFIX}{t[b:]}{PREFIX}{t[:a]}{MIDDLE}{t[a:b]}"
                else:
                    form, made = "psm", f"{PREFIX}{t[:a]}{SUFFIX}{t[b:]}{MIDDLE}{t[a:b]}"
                forms.append(form)
                outputs.append(made)
                prefixes.append(None if plain else a)
                middles.append(None if plain else b - a)
            columns = [pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *columns], names=shape.names)

    return rows.mapInArrow(run, shape)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` of this ``form`` was made from."""
    size = len(PREFIX)
    after = lambda c, part: F.substring(c, F.length(part) + F.lit(size + 1), F.length(c))
    body = F.substring(output, F.lit(size + 1), F.length(output))
    # Of the parts in order of the output: the first, the second and the middle.
    until = lambda c, marker: F.call_function("substring_index", c, marker, F.lit(1))
    first = until(body, F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX)))
    rest = after(body, first)
    second = until(rest, F.lit(MIDDLE))
    middle = after(rest, second)
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))


def transformed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``docs`` with each text in its drawn form; rows travel as one column, so that no name of theirs can clash."""
    own = F.struct(*[F.col(c) for c in docs.columns if c != text])
    made = formed(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), own.alias("row")), seed)
    return made.select(*[F.col("output").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(common.documents(spark, sf_dir))
    digest = lambda c: F.sha2(c, 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
