"""Greedy near-duplicate clusters in a fixed order.

Items are taken in their order; one that no leader has absorbed yet becomes a leader and absorbs every later free item
within the distance. So leaders are the lexicographically first maximal independent set of the graph of close pairs, and
each other item belongs to its first adjacent leader. Rounds settle, at once, every item whose earlier neighbours are
settled; few are needed on average.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.arrays import hamming
from loam.session import materialised

BITS = 64
#: Hashes a block, where blocks are compared in pairs; the narrowest band by whose variants pairs are sought.
BLOCK, LEAST_BAND = 4096, 16


def _dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """By keys, over a number of partitions that isn't reduced, however few bytes the keys have."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _by_blocks(hashes: DataFrame, near: Column, extra: list[str]) -> DataFrame:
    """Pairs x < y of distinct hashes that are near. Each pair of blocks of a group is one key of a join."""
    sizes = hashes.groupBy(*extra).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    if extra:
        sizes = sizes.select(F.col("_g").alias("_s"), "n")
        counted = hashes.join(F.broadcast(sizes), F.col("_g").eqNullSafe(F.col("_s"))).drop("_s")
    else:
        counted = hashes.withColumn("n", F.lit(sizes.first()["n"]))
    dealt = counted.withColumn("block", F.pmod(F.xxhash64("h"), F.col("n")).cast("int"))
    left = dealt.select(*[F.col(g).alias("_l") for g in extra], F.col("h").alias("x"), F.col("block").alias("i"), F.explode(F.sequence("block", F.col("n") - 1)).alias("j"))
    right = dealt.select(*[F.col(g).alias("_r") for g in extra], F.col("h").alias("y"), F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    left, right = _dealt(left, ["i", "j", *["_l" for _ in extra]]), _dealt(right, ["i", "j", *["_r" for _ in extra]])
    on = (left["i"] == right["i"]) & (left["j"] == right["j"]) & ((left["i"] != left["j"]) | (F.col("x") < F.col("y"))) & near
    if extra:
        on = on & F.col("_l").eqNullSafe(F.col("_r"))
    return left.join(right.hint("merge"), on).select(*[F.col("_l").alias("_g") for _ in extra], F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def _by_bands(hashes: DataFrame, near: Column, extra: list[str], bands: int) -> DataFrame:
    """Pairs x < y of distinct hashes that are near: they differ in at most two bits of some band, so both have a variant of
    it within one bit. A hash sends its variants of every band, at most 64 + bands in all."""
    cuts = [round(i * BITS / bands) for i in range(bands + 1)]

    def variants(number: int, low: int, width: int) -> Column:
        band = F.shiftrightunsigned("h", low).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(number << width))
        masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(width)])
        return F.transform(masks, lambda m: band.bitwiseXOR(m))

    found = [variants(k, low, high - low) for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))]
    dealt = hashes.withColumn("key", F.explode(F.concat(*found)))
    left, right = dealt.select(*[F.col(g).alias("_l") for g in extra], F.col("h").alias("x"), "key"), dealt.select(*[F.col(g).alias("_r") for g in extra], F.col("h").alias("y"), "key")
    on = (left["key"] == right["key"]) & (F.col("x") < F.col("y")) & near
    if extra:
        on = on & F.col("_l").eqNullSafe(F.col("_r"))
    return left.join(right.hint("merge"), on).select(*[F.col("_l").alias("_g") for _ in extra], "x", "y").distinct()


def close_hashes(hashes: DataFrame, most: int) -> DataFrame:
    """(_g?, x, y): pairs x < y of different hashes h that differ in at most `most` bits, within a group `_g` if there is one.

    hashes: written, without repeats. Up to 11 bits, pairs are sought by the variants of bands; beyond, bands would be too narrow
    to prune, and all are compared in pairs of blocks. Neither loses any. Both join by merging: Spark takes exploded rows to be as
    small as their file, and would send them all through the driver.
    """
    extra = [c for c in hashes.columns if c == "_g"]
    near, bands = hamming(F.col("x"), F.col("y")) <= most, max(2, most // 3 + 1)
    if not hashes.limit(1).count():
        return hashes.select(*extra, F.col("h").alias("x"), F.col("h").alias("y"))
    return _by_bands(hashes, near, extra, bands) if BITS // bands >= LEAST_BAND else _by_blocks(hashes, near, extra)


def close_pairs(items: DataFrame, most: int) -> DataFrame:
    """(a, b, dist): ordinals a < b of items (ord, h) whose hashes differ in at most `most` bits: all pairs, of copies too, as a
    result of its own. Items without a hash are in no pair."""
    items = materialised(items.select("ord", "h").where("h is not null"))
    hashes = materialised(items.select("h").distinct())
    pairs = close_hashes(hashes, most)
    turned = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    pairs = pairs.select(F.inline(turned)).unionByName(hashes.select(F.col("h").alias("x"), F.col("h").alias("y")))
    a, b = items.select(F.col("ord").alias("a"), F.col("h").alias("x")), items.select(F.col("ord").alias("b"), F.col("h").alias("y"))
    return pairs.join(a, "x").join(b, "y").where("a < b").select("a", "b", hamming(F.col("x"), F.col("y")).alias("dist"))


#: Rounds of settling that are computed together before their result is written.
STEPS = 2


def leaders(pairs: DataFrame) -> DataFrame:
    """(ord, leader) of all items that are in a pair (a, b), a < b by the order; a leader's leader is itself."""
    pairs = materialised(pairs.select("a", "b"))
    state = pairs.select(F.col("a").alias("ord")).union(pairs.select("b")).distinct().withColumn("state", F.lit(0))

    def settled(state: DataFrame) -> DataFrame:
        """Leaders (1) are those without an earlier one that is undecided (0) or leads; members (2) those with one that leads."""
        before = pairs.join(state.select(F.col("ord").alias("a"), F.col("state").alias("s")), "a").groupBy("b").agg(F.max((F.col("s") == 1).cast("int")).alias("led"), F.min((F.col("s") == 2).cast("int")).alias("free"))
        new = F.when(F.col("state") != 0, F.col("state")).when(F.col("led") == 1, 2).when(F.coalesce("free", F.lit(1)) == 1, 1).otherwise(0)
        return state.join(before, state["ord"] == before["b"], "left").select("ord", new.alias("state"))

    while True:
        for _ in range(STEPS):
            state = settled(state)
        state = materialised(state)
        if not state.where("state = 0").limit(1).count():
            break
    firsts = pairs.join(state.where("state = 1").select(F.col("ord").alias("a")), "a").groupBy("b").agg(F.min("a").alias("leader"))
    out = state.join(firsts, state["ord"] == firsts["b"], "left")
    return out.select("ord", F.when(F.col("state") == 1, F.col("ord")).otherwise(F.col("leader")).alias("leader"))


def greedy_clusters(items: DataFrame, most: int, group: str | None = None) -> DataFrame:
    """items (ord, h, px, ...) with `leader` and `kept`: of each cluster the item of most px stays, the first on ties.

    `ord` is a number, unique and in the order that decides. Items without a hash are clusters of their own. Equal hashes are
    walked once, at the place of their first item: what leads or absorbs it does so with the others, so copies are never paired.
    """
    items = materialised(items)
    extra = [F.col(group).alias("_g")] if group else []
    by = [c for c in ("_g",) if group] + ["h"]
    firsts = materialised(items.where("h is not null").select(*extra, "h", "ord").groupBy(*by).agg(F.min("ord").alias("first")))
    pairs = materialised(close_hashes(firsts.select(*by), most))
    same = lambda h: (F.col(h) == F.col("h")) & (F.col("_p").eqNullSafe(F.col("_g")) if group else F.lit(True))
    pairs = pairs.withColumnRenamed("_g", "_p")
    one = pairs.join(firsts, same("x")).select(*[c for c in ("_p",) if group], F.col("first").alias("a"), "y")
    both = one.join(firsts, same("y")).select("a", F.col("first").alias("b"))
    found = leaders(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    led = firsts.join(found, firsts["first"] == found["ord"], "left").select(*[F.col(c).alias(f"_led{c}") for c in by], F.coalesce("leader", "first").alias("leader"))
    on = (F.col("h") == F.col("_ledh")) & (F.col(group).eqNullSafe(F.col("_led_g")) if group else F.lit(True))
    out = items.join(led, on, "left").drop("_ledh", "_led_g").withColumn("leader", F.coalesce("leader", "ord"))
    best = out.groupBy("leader").agg(F.max_by("ord", F.struct("px", -F.col("ord"))).alias("_best"))
    return out.join(best, "leader").withColumn("kept", F.col("ord") == F.col("_best")).drop("_best")
