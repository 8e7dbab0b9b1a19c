"""Joins and summaries over a star schema. An extension: curation itself needs key lookups only."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ten_thousandths(x: Column) -> Column:
    """A double as a whole number of ten-thousandths, so that sums don't depend on their order."""
    return F.floor(x * 10000 + 0.5).cast("long")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """left with the columns of the last right row of the same key at or before its time; null if there is none.

    One shuffle: both sides are united, sorted by key and time, and each row looks back. Of right rows of one time the
    one with the greatest columns counts. Columns take new names: `last_<column>`.
    """
    right = right.groupBy(key, at).agg(F.max(F.struct(*columns)).alias("_r")).withColumn("_side", F.lit(0))
    both = left.withColumn("_side", F.lit(1)).unionByName(right, allowMissingColumns=True)
    before = Window.partitionBy(key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_r", F.last("_r", ignorenulls=True).over(before)).where("_side = 1")
    return found.select(*left.columns, *[F.col("_r")[c].alias(f"last_{c}") for c in columns])


def salted_join(big: DataFrame, small: DataFrame, key: str, parts: int, spread: str, how: str = "inner") -> DataFrame:
    """A join on a key that a large share of big's rows may have: each key is dealt to `parts` tasks by the column `spread`."""
    dealt = big.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    copies = small.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.join(copies, [key, "_part"], how).drop("_part")
