"""Points in intervals, by a sweep instead of pairs of points and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Positions that one group of a sweep spans: two to this many.
BIN_BITS = 16


def covered(points: DataFrame, spans: DataFrame, key: str, pos: str = "pos", start: str = "start", end: str = "end", out: str = "inside", bits: int = BIN_BITS) -> DataFrame:
    """``points`` with ``out``: whether one of their key's spans [start, end) holds their position.

    Points and the ends of spans are swept in order of position: a start adds
    one, an end takes one away, and a point is inside where the running sum
    isn't zero. So the rows are those of the points and two for each span,
    however many spans overlap. Each key is cut into bins of 2^bits positions;
    a span has its ends in every bin that it meets, so a group of a sweep holds
    one bin of one key. A span without a start or end, or that ends before it
    starts, holds nothing, and so do null keys and positions.
    """
    bin_of = lambda c: F.shiftright(c.cast("long"), bits)
    own = spans.select(F.col(key).alias("__key"), F.col(start).cast("long").alias("__a"), F.col(end).cast("long").alias("__b")).where("__key is not null and __a < __b")
    cut = own.withColumn("__bin", F.explode(F.sequence(bin_of(F.col("__a")), bin_of(F.col("__b") - 1))))
    first, beyond = F.shiftleft("__bin", bits), F.shiftleft(F.col("__bin") + 1, bits)
    ends = F.explode(F.array(F.struct(F.greatest("__a", first).alias("at"), F.lit(1).alias("step")), F.struct(F.least("__b", beyond).alias("at"), F.lit(-1).alias("step"))))
    # Points travel as one column, so that no name of theirs can clash.
    row = F.struct(*[F.col(c) for c in points.columns])
    swept = points.select(F.col(key).alias("__key"), bin_of(F.col(pos)).alias("__bin"), F.col(pos).cast("long").alias("__at"), F.lit(0).alias("__step"), row.alias("__row"))
    moves = cut.select("__key", "__bin", ends.alias("__e")).select("__key", "__bin", F.col("__e.at").alias("__at"), F.col("__e.step").alias("__step"), F.lit(None).cast(swept.schema["__row"].dataType).alias("__row"))
    order = Window.partitionBy("__key", "__bin").orderBy("__at", F.col("__row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    open_ = F.sum("__step").over(order) > 0
    known = F.col("__key").isNotNull() & F.col("__at").isNotNull()
    return swept.union(moves).withColumn("__open", known & open_).where("__row is not null").select("__row.*", F.col("__open").alias(out))
