"""Sharding by sampled splitters, to shards of nearly equal bytes.

Records are ordered by a hash of their text, so that equal texts lie together. A sample of keys, drawn by size, gives quantile
boundaries, and records are dealt to the ranges between them. The bytes of each range are counted exactly; an overfull range is
subdivided by a denser sample of its own keys, until it fits or holds one key alone. Ranges in order, and records in order
within each, give every record its place in the order of all bytes, which is cut into shards. A group of equal texts that is
large against a shard is subdivided by document; a smaller one stays whole. The few records that are large against a shard
are placed first, each into the shard with the most room.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_spread, partitions, range_of, saved, with_offsets

SHARDS, OVERHEAD = 40, 16
#: Of a shard's bytes: a record from the first on is placed by itself, a group up to the second stays whole.
LARGE, WHOLE = 0.02, 0.01
#: Sampled keys a range; how often its even share of the bytes a range may hold; rows of a large group that are numbered together
#: at least, and the parts of it a task at most.
SAMPLE, OVERFULL, TOGETHER, PARTS = 64, 2.0, 256, 4


def _quantiles(sample: list[tuple[int, float]], ranges: int) -> list[int]:
    """Keys that cut a sample (key, weight) into so many parts of even weight."""
    if not sample:
        return []
    sample.sort()
    weight = np.cumsum([w for _, w in sample])
    return sorted({sample[i][0] for i in np.searchsorted(weight, weight[-1] * np.arange(1, ranges) / ranges)})


def _drawn(groups: DataFrame, step: float, salt: int) -> list:
    """Keys with their bytes, drawn by size: one of every `step` bytes, about; groups of more bytes are all drawn."""
    share = F.pmod(F.xxhash64(F.lit(salt), "key", "crc"), F.lit(1 << 30)) / float(1 << 30)
    return groups.where(share < F.col("bytes") / F.lit(step)).collect()


def splitters(groups: DataFrame, total: int, ranges: int) -> list[int]:
    """Ascending boundaries of at least `ranges` ranges of keys, so that none holds over OVERFULL times its even share of the
    bytes, but for a range of one key. groups: written, (key, crc, bytes).

    Only sampled keys, SAMPLE a range, and one sum a range reach the driver.
    """
    even = max(1.0, total / ranges)
    first = _drawn(groups.select("key", "crc", "bytes"), even / SAMPLE, 1)
    bounds, tried = _quantiles([(r["key"], max(r["bytes"], even / SAMPLE)) for r in first], ranges), 1
    while True:
        ranged = groups.select("key", "crc", "bytes", range_of(F.col("key"), bounds).alias("range"))
        sums = ranged.groupBy("range").agg(F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        over = {r["range"]: r["bytes"] for r in sums if r["bytes"] > OVERFULL * even and r["low"] < r["high"]}
        if not over:
            return bounds
        tried += 1
        # At most ranges / OVERFULL ranges are overfull. Each further sample is four times as dense.
        inside = ranged.where(F.col("range").isin(list(over)))
        step, found = even / SAMPLE / 4 ** (tried - 1), {}
        for r in _drawn(inside, step, tried):
            found.setdefault(r["range"], []).append((r["key"], max(r["bytes"], step)))
        new = set(bounds)
        for r, sample in found.items():
            new |= set(_quantiles(sample, int(np.ceil(over[r] / even)) + 1))
        # A range whose keys' quantiles are its own boundaries is cut where its least key ends.
        new |= {r["low"] + 1 for r in sums if r["range"] in over} if new == set(bounds) else set()
        bounds = sorted(new)


def _room(shards: int, loads: np.ndarray, rest: int) -> list[float]:
    """Boundaries that cut `rest` bytes so that the fullest shard is as low as it can be."""
    order = np.sort(loads)
    for n in range(shards, 0, -1):
        level = (rest + order[:n].sum()) / n
        if level >= order[n - 1]:
            break
    return [float(x) for x in np.cumsum(np.maximum(0, level - loads))[:-1]]


def shard(docs: DataFrame, shards: int = SHARDS, group_limit: float = WHOLE) -> DataFrame:
    """One row a document (doc_id, text): its shard, and its slot there, from 0 without gaps.

    A null text counts as empty. Repeated rows are records of their own; null doc_ids come first in their shard. A text of any
    length is one record. Other columns are ignored, whatever their names. No rows give none.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    columns = [F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("key")]
    rows = saved(docs.select(*columns))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    target, n = total / shards, partitions(spark)

    # At most shards / LARGE records.
    placed, loads = {}, np.zeros(shards)
    before: dict = {}
    large = F.col("size") > LARGE * target
    for r in sorted(rows.where(large).collect(), key=lambda r: (-r["size"], r["key"], r["doc_id"] is not None, r["doc_id"], r["row"])):
        same = before.get((r["key"], r["crc"]), -1)
        s = same if same >= 0 and loads[same] + r["size"] <= target else int(loads.argmin())
        before[r["key"], r["crc"]], placed[r["row"]] = s, s
        loads[s] += r["size"]
    one = spark.createDataFrame([(int(r), s) for r, s in placed.items()], "row long, shard int")
    first = rows.where(large).join(F.broadcast(one), "row").select("row", "doc_id", "size", "crc", "shard")

    small = rows.where(~large)
    group = ["key", "crc", "size"]
    groups = saved(small.groupBy(*group).agg(F.count("*").alias("n"))).withColumn("bytes", F.col("n") * F.col("size"))
    bounds = splitters(groups, total, max(64, 4 * n))
    groups = with_offsets(groups.withColumn("range", range_of(F.col("key"), bounds)), [], "range", {"bytes": F.col("bytes")})
    earlier = Window.partitionBy("range").orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("start", F.col("bytes_before") + F.coalesce(F.sum("bytes").over(earlier), F.lit(0)))
    groups = saved(groups.select(*group, "n", "bytes", "start"))

    cuts = _room(shards, loads, total - int(loads.sum()))
    whole = F.col("bytes") <= group_limit * target
    kept = groups.where(whole).withColumn("shard", range_of(F.col("start") + F.col("bytes") / 2, cuts, "double"))
    # At most shards / group_limit groups are larger.
    split = groups.where(~whole).select(*group, "n", "start")
    apart = small.join(F.broadcast(split), group)
    apart = apart.withColumn("part", F.pmod(F.xxhash64("doc_id", "row"), F.least(F.ceil(F.col("n") / TOGETHER), F.lit(PARTS * n))))
    apart = with_offsets(apart, group, "part", {"rank": F.lit(1)})
    number = F.row_number().over(Window.partitionBy(*group, "part").orderBy("doc_id", "row")) - 1 + F.col("rank_before")
    middle = F.col("start") + number * F.col("size") + F.col("size") / 2
    apart = apart.select("row", "doc_id", "size", "crc", range_of(middle, cuts, "double").alias("shard"))
    rest = small.join(F.broadcast(split), group, "left_anti")
    together = join_spread(rest, saved(kept.select(*group, "n", "shard")), group, "n").select("row", "doc_id", "size", "crc", "shard")

    out = first.unionByName(apart).unionByName(together).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int"))
    out = with_offsets(saved(out), ["shard"], "part", {"slot": F.lit(1)})
    slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "crc", "row")) - 1 + F.col("slot_before")
    return out.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
