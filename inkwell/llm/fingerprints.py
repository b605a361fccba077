"""Document fingerprints by consistent weighted sampling, with DataFrame operations only.

A text's terms are its words, weighted by their counts. For each sample k and
term, hashes of (term, k) give r and c from Gamma(2, 1) and b from U(0, 1).
With t = floor(ln(weight) / r + b), the sample is the (term, t) whose
ln(c) - r * (t - b + 1) is least; two texts agree in a sample with the
probability of their generalised Jaccard similarity (sum of smaller over sum
of larger weights). The criterion and 16 bits of the sample share a long, so
a signature is a set of minima: whole-stage code, aggregated within the task
that holds the text. The 16 bits add 2^-16 to the collision rate.

A text and its edited form are sampled together: a term's r, c and b are drawn
once for both weights. Most terms cannot win a sample, which their uniform
numbers tell before any logarithm is taken: with r = -ln(q) and c = -ln(p),
the criterion is at least ln(2 * (1 - p) / (1 + p) * q / weight), while the least one of a
text of n words is ln(x) for an exponential x of rate n. Terms whose bound is
above ln(``SURE`` / n) are passed over; that no term is left has probability
exp(-``SURE``) for each sample (7e-13), which is then zero.

``neighbours`` pairs each document with the one before it without a global
window: documents are partitioned by range of key and text (so one key with
many texts is split, too), ranks are taken within, and the ranges' ends are
stitched. Ranges follow from the number of documents. Rows meet on hashes of
key and text (128 bits together).

Defined results: a null text is empty; texts without words share the
fingerprint of zeros, and two such are alike; rows repeated with key and text
count as one document in the order and each get its result; rows of one key
with different texts are ordered by a hash of the text; null keys come first;
a lone document is its own next one; an empty table gives no row. The key may
have any type that can be ordered; extra columns, whatever their names, are
not carried on.
"""

from __future__ import annotations

import math
import random
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm import common

SAMPLES = 64
#: Samples that one row of the exploded terms works on.
TOGETHER = 4
#: Minus the logarithm of how likely a sample finds no term.
SURE = 28.0
#: Documents that one range of the order holds, and the most ranges (whose ends are broadcast).
RANGE_ROWS, MOST_RANGES = 100_000, 16_384
DIGITS = 4
SCALE = float(1 << 22)


def weighted_terms(df: DataFrame, keys: list[str], body: str, edited: str) -> DataFrame:
    """``keys`` and a row for each distinct word of either text, or one of nulls if there is none.

    term (a hash), log_1 and log_2 (of its count in each text, null for none),
    most_1 and most_2 (``SURE`` times its share of each text's words). The
    words that the texts begin with alike are split and counted once.
    """
    alike = F.expr(f"left({body}, char_length({body}) - cast(char_length({body}) div 2 as int))")
    parted = df.withColumn("__same", F.regexp_extract(alike, r"(?s)^(.*[\x20\x09-\x0D])", 1)).withColumn("__at", F.char_length("__same") + 1)
    words = lambda c: F.split(c, r"[\x20\x09-\x0D]+")
    rest = lambda c: words(F.substr(F.col(c), F.col("__at")))
    split = parted.select(*keys, words(F.col("__same")).alias("__0"), rest(body).alias("__1"), rest(edited).alias("__2"))
    # Empty ends of the splits count, so a few less: what is left is never more than the words that are there.
    least = lambda k: F.greatest(F.lit(1), F.size("__0") + F.size(f"__{k}") - 4)
    pieces = F.explode(F.array(*[F.struct(F.lit(x).cast("long").alias("x"), F.lit(y).cast("long").alias("y"), F.col(c).alias("w")) for x, y, c in ((1, 1, "__0"), (1, 0, "__1"), (0, 1, "__2"))])).alias("__p")
    sizes = F.shiftleft(least(1).cast("long"), 32).bitwiseOR(least(2).cast("long")).alias("__n")
    each = split.select(*keys, sizes, pieces).select(*keys, "__n", "__p.x", "__p.y", F.explode("__p.w").alias("w"))
    # An empty word has no count; it stays as the row of a text without words.
    here = F.col("w") != ""
    counted = each.select(*keys, "__n", F.when(here, F.xxhash64("w")).alias("term"), F.when(here, F.col("x")).otherwise(0).alias("x"), F.when(here, F.col("y")).otherwise(0).alias("y"))
    terms = counted.groupBy(*keys, "__n", "term").agg(F.sum("x").cast("double").alias("x"), F.sum("y").cast("double").alias("y"))
    size = {"x": F.shiftrightunsigned("__n", 32), "y": F.col("__n").bitwiseAND(F.lit(0xFFFFFFFF))}
    weights = [e for k, c in ((1, "x"), (2, "y")) for e in (F.ln(c).alias(f"log_{k}"), (SURE * F.col(c) / size[c]).alias(f"most_{k}"))]
    return terms.select(*keys, "term", *weights)


def unit(bits: Column, n: int) -> Column:
    """A number in (0, 1) from ``n`` random bits."""
    return (bits.cast("double") + 0.5) * (1.0 / (1 << n))


def drawn(i: int) -> tuple[Column, Column]:
    """Sample ``i`` of a row's part: for each text the criterion in the high bits and the sample in the low 16; null if the term can't win."""
    salt = random.Random(i)
    one, two = (F.xxhash64(F.col("seed").bitwiseXOR(F.lit(salt.getrandbits(62)))) for _ in range(2))
    part = lambda h, at, n: F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << n) - 1))
    q = unit(F.shiftrightunsigned(one, 40), 24) * unit(part(one, 16, 24), 24)
    p = unit(F.shiftrightunsigned(two, 43), 21) * unit(part(two, 22, 21), 21)
    b = unit(part(two, 0, 22), 22)
    able = F.lit(2.0) * (1.0 - p) * q <= F.col("most") * (1.0 + p)
    r, log_c = F.when(able, -F.ln(q)), F.when(able, F.ln(-F.ln(p)))

    def least(k: int) -> Column:
        t = F.floor(F.col(f"log_{k}") / r + b)
        criterion = F.floor((log_c - r * (t.cast("double") - b + 1)) * SCALE)
        return F.shiftleft(criterion, 16).bitwiseOR(one.bitwiseXOR(t).bitwiseAND(F.lit(0xFFFF)))

    return least(1), least(2)


def signatures(texts: DataFrame, keys: list[str], body: str, edited: str, samples: int = SAMPLES) -> DataFrame:
    """``keys``, part, chunk_1 and chunk_2: the fingerprints of both texts in ``TOGETHER`` samples a row."""
    terms = weighted_terms(texts, keys, body, edited)
    parts = F.posexplode(F.array(*[F.xxhash64("term", F.lit(j)) for j in range(samples // TOGETHER)])).alias("part", "seed")
    seeded = terms.select(*keys, "log_1", "log_2", F.greatest("most_1", "most_2").alias("most"), parts)
    # Within the aggregates, each expression becomes a method of its own, small enough to be compiled.
    least = seeded.groupBy(*keys, "part").agg(*[F.min(v).alias(f"v{k}_{i}") for i in range(TOGETHER) for k, v in zip("12", drawn(i), strict=True)])
    digits = lambda k, i: F.lpad(F.lower(F.hex(F.coalesce(F.col(f"v{k}_{i}"), F.lit(0)).bitwiseAND(F.lit(0xFFFF)))), DIGITS, "0")
    return least.select(*keys, "part", *[F.concat(*[digits(k, i) for i in range(TOGETHER)]).alias(f"chunk_{k}") for k in "12"])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two fingerprints."""
    equal = [(F.substring(a, DIGITS * k + 1, DIGITS) == F.substring(b, DIGITS * k + 1, DIGITS)).cast("int") for k in range(samples)]
    return reduce(lambda x, y: x + y, equal) / float(samples)


def neighbours(slim: DataFrame, n: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """rid, tid, before (rid, tid and n_chars of the document before it), for distinct documents of ``slim``'s ``n`` rows."""
    own = slim.groupBy("__key", "rid", "tid").agg(F.first("n_chars").alias("n_chars"))
    ranges = min(MOST_RANGES, max(int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / range_rows)))
    # Written once, so that all that follows sees the same ranges.
    placed = common.cut(own.repartitionByRange(ranges, F.col("__key").asc_nulls_first(), "tid").withColumn("range", F.spark_partition_id()))
    this = F.struct("__key", "tid", "rid", "n_chars")
    within = Window.partitionBy("range").orderBy(F.col("__key").asc_nulls_first(), "tid")
    lasts = placed.groupBy("range").agg(F.max(this).alias("last"))
    order = Window.orderBy("range")
    ends = lasts.select("range", F.coalesce(F.lag("last").over(order), F.last("last").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("__end"))
    # As many rows as ranges, ``MOST_RANGES`` at most: a bounded broadcast.
    linked = placed.withColumn("__lag", F.lag(this).over(within)).join(F.broadcast(ends), "range")
    before = F.coalesce("__lag", "__end")
    return linked.select("rid", "tid", before["rid"].alias("p_rid"), before["tid"].alias("p_tid"), before["n_chars"].alias("p_chars"))


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """For each row its fingerprint, that of its edited text, and how alike both and the next document are."""
    body = F.coalesce(F.col(text), F.lit(""))
    # A null key hashes to the seed, so joins need not be null-safe.
    named = docs.select(F.col(key).alias("__key"), F.xxhash64(F.col(key), F.lit(31)).alias("rid"), F.xxhash64(body, F.lit(37)).alias("tid"), body.alias("body"))
    slim = common.cut(named.select("__key", "rid", "tid", F.char_length("body").cast("long").alias("n_chars")))
    n = slim.count()
    before = common.cut(neighbours(slim, n))
    texts = named.select("rid", "tid", "body")
    if n > before.count():  # only then pay for a distinct over texts: rows repeated with key and text
        texts = texts.dropDuplicates(["rid", "tid"])
    heads = texts.join(before, ["rid", "tid"]).select(F.col("p_rid").alias("rid"), F.col("p_tid").alias("tid"), F.expr("left(body, cast(p_chars div 2 as int))").alias("head"))
    met = texts.join(heads, ["rid", "tid"])
    edited = F.concat(F.expr("left(body, char_length(body) - cast(char_length(body) div 2 as int))"), "head")
    both = met.select("rid", "tid", "body", edited.alias("edited"))
    both = both.withColumn("sha", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    chunks = signatures(both, ["rid", "tid", "sha"], "body", "edited", samples)
    whole = lambda k: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", f"chunk_{k}"))), lambda c: c[f"chunk_{k}"]), "")
    made = common.cut(chunks.groupBy("rid", "tid", "sha").agg(whole(1).alias("fingerprint"), whole(2).alias("edited_fingerprint")))
    following = made.select("rid", "tid", F.col("fingerprint").alias("next_fingerprint")).join(before, ["rid", "tid"]).select(F.col("p_rid").alias("rid"), F.col("p_tid").alias("tid"), "next_fingerprint")
    out = slim.join(made, ["rid", "tid"]).join(following, ["rid", "tid"])
    return out.select(
        F.col("__key").alias(key), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(common.documents(spark, sf_dir))
