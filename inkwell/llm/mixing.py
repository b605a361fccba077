"""Mixing sources to target weights, with DataFrame operations only.

1. Sizes (words) per source give targets: all words shared by weight, a target
   stopping at ``most`` times its source's size and the excess shared again
   (closed form: sources in order of size over weight, prefix sums).
2. Each source's words, in the order of its documents, are one stream, packed
   into blocks of ``block`` words. Starts come from prefix sums in two levels,
   within hashed buckets and over bucket totals, so no task holds a source.
3. A source takes ``target / mean block length`` slots. They are thrown over
   the output shards by a hash, which makes each source's counts per shard a
   multinomial draw with the source's total, so that targets hold exactly
   instead of on average. The counts (``shard_counts``) are all that goes on:
   a shard's slots of a source are numbered from the sum of its counts in the
   shards before.
4. A slot is mapped to a block by a pseudorandom permutation of the source's
   block indexes (a swap-or-not shuffle of any domain, keyed by source and
   epoch). An epoch uses each block once, so no block is used more than
   ``most`` times.
5. Documents meet the blocks that their words lie in by (source, block).

Draws are hashes of values, so reruns and recomputed tasks agree. Buckets and
shards grow with the rows; only tables with a row per source (and per shard of
a source) are ever in one task.

Defined results: a null text has no word; a document without words is never
taken; a null source is a source of its own, ordered last; repeated rows take
places of their own in the stream; rows of equal key and size may change
places; an empty table gives no row; extra columns, whatever their names, are
carried on by ``mixed_documents`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm import common

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
BLOCK = 128
#: Documents that one bucket of a source's stream is meant to hold, and the fewest buckets.
BUCKET_ROWS, BUCKETS = 100_000, 512
SHARD_SLOTS = 1 << 16
CHUNK_SLOTS = 1 << 12
ROUNDS = 12


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, sid (rank by code point, null last), source_size, target; ``sizes`` has source and size.

    The windows below span one row per source, not per document.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = by_source.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    levels = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    order = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("most").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = levels.withColumn("level", left / open_weight)
    # The water level: that of the first source which it does not fill.
    first = F.min(F.when(F.col("weight") * F.col("level") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "sid", "level"))).over(everything)
    filled = F.when(first.isNull(), F.col("most").cast("double")).otherwise(F.least(F.col("most").cast("double"), F.col("weight") * first["level"]))
    return levels.select("source", "sid", "source_size", filled.alias("target"))


def stream_starts(sizes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``sizes`` (sid, doc_id, size) with ``start``: words before the document in its source's stream."""
    placed = sizes.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "size", F.lit(5)), F.lit(buckets)).cast("int"))
    totals = placed.groupBy("sid", "__bucket").agg(F.sum("size").alias("__n"))
    before = Window.partitionBy("sid").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("sid", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy("sid", "__bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return local.join(bases, ["sid", "__bucket"]).withColumn("start", F.col("__base") + F.col("__local")).drop("__bucket", "__base", "__local")


def permuted(x: Column, n: Column, *keys: Column, rounds: int = ROUNDS) -> Column:
    """Where a keyed permutation of 0..n-1 sends x, by swap-or-not rounds."""

    def step(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*keys, r, F.lit(11)), n) - at, n)
        swap = F.xxhash64(F.greatest(at, partner), *keys, r, F.lit(13)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, step)


def slot_numbers(counted: DataFrame, n: str, *columns: str) -> DataFrame:
    """``columns`` and ``i``: numbers from 0 to ``n`` - 1 for each row, from chunks that are spread over tasks."""
    last = F.floor((F.col(n) - 1) / CHUNK_SLOTS)
    chunks = counted.where(F.col(n) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    # A stated number of partitions, which adaptive execution does not merge although the rows are few.
    chunks = chunks.repartition(int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[c for c in columns if c in ("sid", "shard")], "chunk")
    first = F.col("chunk") * CHUNK_SLOTS
    return chunks.select(*columns, F.explode(F.sequence(first, F.least(first + CHUNK_SLOTS, F.col(n)) - 1)).alias("i"))


def shard_counts(sources: DataFrame, block: int = BLOCK, most: int = MOST, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """sid, n_blocks, shard, n: how many blocks of each source each output shard takes."""
    planned = sources.where("source_size > 0").select("sid", F.ceil(F.col("source_size") / block).cast("long").alias("n_blocks"), "source_size", "target")
    planned = planned.withColumn("n_slots", F.least(F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long"), F.col("n_blocks") * most))
    shards = F.greatest(F.lit(1), F.ceil(F.sum("n_slots").over(Window.partitionBy()) / shard_slots)).cast("long")
    thrown = slot_numbers(planned.withColumn("n_shards", shards), "n_slots", "sid", "n_blocks", "n_shards")
    return thrown.groupBy("sid", "n_blocks", F.pmod(F.xxhash64("sid", "i", F.lit(17)), F.col("n_shards")).alias("shard")).agg(F.count("*").alias("n"))


def draw_slots(counts: DataFrame) -> DataFrame:
    """sid, shard, slot, block: the blocks that make up each output shard."""
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    slots = slot_numbers(placed, "n", "sid", "n_blocks", "shard", "first").withColumn("slot", F.col("first") + F.col("i"))
    epoch, index = F.floor(F.col("slot") / F.col("n_blocks")), F.col("slot") % F.col("n_blocks")
    return slots.select("sid", "shard", "slot", permuted(index, F.col("n_blocks"), F.col("sid"), epoch).alias("block"))


def taken_words(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """A row for each row of ``sizes`` (doc_id, source, size): with source_size, target, taken and the first output shard that takes of it."""
    sources = common.cut(source_targets(sizes, weights, most))
    named = sizes.withColumnRenamed("source", "__source")
    known = named.join(sources, F.col("__source").eqNullSafe(F.col("source"))).drop("__source")
    held = stream_starts(known.where("size > 0"), max(BUCKETS, sizes.count() // BUCKET_ROWS))
    # A row per source and shard: written once, as both the offsets and the slots come from it.
    counts = common.cut(shard_counts(sources, block, most, shard_slots))
    times = draw_slots(counts).groupBy("sid", "block").agg(F.count("*").alias("times"), F.min("shard").alias("shard"))
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = held.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block)
    own = ["sid", "start", "doc_id", "source", "size", "source_size", "target"]
    # Merged, not broadcast: the planner can't see how many rows the explodes above make.
    met = pieces.withColumn("words", words).join(times.hint("merge"), ["sid", "block"], "left")
    taken = met.groupBy(*own).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"), F.min("shard").alias("first_shard"))
    columns = ["doc_id", "source", "size", "source_size", "target", "taken", "first_shard"]
    return taken.select(*columns).unionByName(known.where("size = 0").withColumns({"taken": F.lit(0).cast("long"), "first_shard": F.lit(None).cast("long")}).select(*columns))


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words); written once, as the texts are long and the rest is short."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(common.WORD)).cast("long")
    return common.cut(docs.select("doc_id", "source", size.alias("size")))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """Whole documents of the mix, with ``docs``' columns, each repeated about taken / size times.

    The fraction is rounded up or down by a hash of the key, so that shares
    hold on average and no document comes more than ``most`` times.
    """
    taken = taken_words(document_sizes(docs), weights, most, block)
    share = taken.where("size > 0").groupBy(F.col("doc_id").alias("id"), F.col("source").alias("of")).agg((F.sum("taken") / F.sum("size")).alias("share"))
    # Rows travel as one column, so that no name of theirs can clash.
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("key"), F.col("source").alias("from"))
    joined = whole.join(share.hint("merge"), F.col("key").eqNullSafe(F.col("id")) & F.col("from").eqNullSafe(F.col("of")))
    copies = F.floor(F.col("share") + common.uniform(F.col("id"), F.col("of"), seed=23)).cast("int")
    return joined.withColumn("copies", copies).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(document_sizes(common.documents(spark, sf_dir))).select("doc_id", "size", "source_size", "target", "taken", "first_shard")
