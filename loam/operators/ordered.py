"""What depends on an order: budgets, names that collide, heads of groups."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.functions.text import stem
from loam.session import materialised


def within_budget(pages: DataFrame, size: str, order: list[str], most: int, spent: int = 0, group: list[str] | None = None) -> DataFrame:
    """Pages that are read while what was read before is below the budget; the last one may go over it.

    A budget over all pages orders them in one task: pages are one row a request, not the data.
    """
    before = Window.partitionBy(*(group or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return pages.withColumn("read_before", F.coalesce(F.sum(size).over(before), F.lit(0)) + spent).where(F.col("read_before") < most)


def output_names(items: DataFrame, prefix: Column, path: str, order: list[str], ending: str = ".jpg") -> DataFrame:
    """items with `out_name`: prefix, stem and, from the second of a name on, its number."""
    named = items.withColumn("_name", F.concat(prefix, F.lit("_"), stem(F.col(path))))
    number = F.row_number().over(Window.partitionBy("_name").orderBy(*order)) - 1
    number = named.withColumn("_n", number)
    return number.withColumn("out_name", F.concat("_name", F.when(F.col("_n") > 0, F.concat(F.lit("_"), F.col("_n").cast("string"))).otherwise(""), F.lit(ending))).drop("_name", "_n")


def first_of_each(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group, with their rank. Spark keeps no more than n a group and task before it shuffles."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def pair_names(items: DataFrame, path: str, allowed: tuple[str, ...] = ("jpg", "jpeg", "png")) -> DataFrame:
    """items with the names of their image and its caption; other image kinds are written as jpg."""
    ending = F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))
    base = stem(F.col(path))
    return items.withColumns({"image_name": F.concat(base, F.lit("."), F.when(ending.isin(*allowed), ending).otherwise("jpg")), "caption_name": F.concat(base, F.lit(".txt"))})


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with its place in the order, from 0 without gaps. Ranges of the order are sorted apart; one count a range is added up."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialised(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    # An id holds the range above 33 bits of the place in it.
    span, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = F.sum("_n").over(Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1))
    spans = dealt.groupBy(span.alias("_span")).agg(F.count("*").alias("_n")).select("_span", F.coalesce(before, F.lit(0)).alias("_before"))
    return dealt.withColumn("_span", span).join(F.broadcast(spans), "_span").withColumn(name, F.col("_before") + place).drop("_span", "_before", "_at")


def emission(rows: DataFrame, reason: str, order: list, name: str = "emitted") -> DataFrame:
    """rows with the place at which a manifest lists them: what gates drop, then duplicates, then what stays, each in order."""
    part = F.when(F.col(reason) == "", 2).when(F.col(reason) == "duplicate", 1).otherwise(0)
    return numbered(rows.withColumn("_part", part), ["_part", *order], name).drop("_part")
