"""Helpers that several operators share: tables, the shared folder, bindings, ranges and offsets."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.session import materialised as saved  # noqa: F401

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_array(values: list, kind: str) -> Column:
    """Numbers as one constant, however many they are."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def range_of(key: Column, bounds: list, kind: str = "long") -> Column:
    """How many of the ascending bounds are <= key, by a binary search in a constant array; 0 for a null key."""
    if not bounds:
        return F.lit(0)
    array = literal_array(bounds, kind)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, s: F.when(F.get(array, low + s - 1) <= key, low + s).otherwise(low))


def with_offsets(df: DataFrame, group: list[str], bucket: str, values: dict[str, Column]) -> DataFrame:
    """Adds `<name>_before` for each value: its sum over all rows of the same group in lower buckets.

    Only one row a group and bucket is gathered, so a group of any size spreads over its buckets.
    """
    sums = df.groupBy(*group, bucket).agg(*[F.sum(v).alias(k) for k, v in values.items()])
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    running = [F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}_before") for k in values]
    keys = [*group, bucket]
    sums = sums.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keys)], *running)
    on = F.lit(True)
    for i, c in enumerate(keys):
        on = on & F.col(c).eqNullSafe(F.col(f"_{i}"))
    return df.join(sums, on, "left").drop(*[f"_{i}" for i in range(len(keys))])


def unused(columns: list[str], *wanted: str) -> list[str]:
    """Names for helper columns, one for each wanted, that clash with none of the columns, whatever the case."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], rows: str, most: int = 1000) -> DataFrame:
    """left joined with right, a written table of one row a key with `rows`, how many rows of left have it, which is dropped.

    A key of over 1 / most of all rows would be one task's: those, `most` at most, are broadcast instead. No key is null.
    """
    total = right.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    hot = F.broadcast(right.where(F.col(rows) * most > F.lit(total)).drop(rows))
    rest = right.where(F.col(rows) * most <= F.lit(total)).drop(rows)
    left = left.drop(rows) if rows in left.columns and rows not in keys else left
    return left.join(hot, keys).unionByName(left.join(hot.select(*keys), keys, "left_anti").join(rest, keys))
