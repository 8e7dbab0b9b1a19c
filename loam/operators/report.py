"""Counts, shares and distributions of what a run has kept."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"))


def kept_and_dropped(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    return df.agg(F.count_if(F.col(reason) == "").alias("kept"), F.count_if(F.col(reason) != "").alias("dropped"))


def shares(df: DataFrame, bucket: str, target: Mapping[str, float], tolerance: float) -> DataFrame:
    """Each target bucket's count, share and whether it is within the tolerance; buckets without rows have 0."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(i, k, float(v)) for i, (k, v) in enumerate(target.items())], "ord int, bucket string, target double")
    every = Window.partitionBy(F.lit(0))
    # One row a bucket.
    found = df.groupBy(F.col(bucket).alias("bucket")).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(every))
    out = wanted.join(found, "bucket", "full").withColumns({"n": F.coalesce("n", F.lit(0)), "total": F.greatest(F.coalesce(F.max("total").over(every), F.lit(1)), F.lit(1))})
    out = out.where("ord is not null")
    share = F.col("n") / F.col("total")
    return out.select("ord", "bucket", "n", "target", share.alias("share"), (F.abs(share - F.col("target")) <= tolerance).alias("ok"))


def first_failure(checked: DataFrame) -> DataFrame:
    """One row: whether all is well, and the first bucket, in the target's order, that isn't."""
    return checked.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"), F.min_by("bucket", F.when(~F.col("ok"), F.col("ord"))).alias("_b"), F.count_if(~F.col("ok")).alias("_n")).select("ok", F.when(F.col("_n") > 0, F.col("_b")).alias("bucket"))


def caption_figures(df: DataFrame) -> DataFrame:
    """captioned, answered (a quality was given), blocked, skipped; one pass."""
    return df.agg(F.count_if("captioned").alias("captioned"), F.count_if(F.col("captioned") & (F.col("quality") != "")).alias("answered"), F.count_if("blocked").alias("blocked"), F.count_if("skipped").alias("skipped"))


def vocabulary_use(values: DataFrame, vocabulary: DataFrame, least: int = 0) -> DataFrame:
    """How often each (slot, value) of the vocabulary is used; unused ones have 0, `dead` those below `least`."""
    used = values.groupBy("slot", "value").agg(F.count("*").alias("n"))
    out = vocabulary.join(used, ["slot", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("dead", F.col("n") < least)


def percentiles(df: DataFrame, column: str, qs: list[float]) -> DataFrame:
    """One row a percentile, exact, with linear interpolation."""
    got = df.agg(F.percentile(column, F.array(*[F.lit(q) for q in qs])).alias("v"))
    return got.select(F.explode(F.arrays_zip(F.array(*[F.lit(q) for q in qs]).alias("q"), F.col("v"))).alias("x")).select(F.col("x.q").alias("q"), F.col("x.v").alias("value"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows by bin; bin 0 and bins + 1 take what is outside."""
    return df.groupBy(F.width_bucket(F.col(column).cast("double"), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def pair_integrity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: items on the left, on the right, on both sides, and whether each item has its partner and there are any."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    out = a.join(b, key, "full").agg(F.count("_l").alias("n_left"), F.count("_r").alias("n_right"), F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_both"))
    return out.withColumn("ok", (F.col("n_both") > 0) & (F.col("n_left") == F.col("n_both")) & (F.col("n_right") == F.col("n_both")))


def read_cost(posts, media, post_price: float = 0.005, media_price: float = 0.005):
    """An estimate before a paid fetch, of numbers or columns."""
    return posts * post_price + media * media_price

