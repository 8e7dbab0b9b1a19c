"""Connected components of a table of links, by alternating large and small stars.

A large star links each node's greater neighbours to the least node around; a small star links its smaller neighbours to
it. Rounds go on until nothing changes, about log2 of the longest path squared at most; each round's links are
written to the shared folder, so that lineage stays short.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


#: A node with many links is joined in so many parts.
PARTS = 16


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """links (u, v) with the m of their u; each node's links are spread over PARTS keys."""
    salted = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return links.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int")).join(salted, ["u", "part"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    pairs = F.array(*[F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("v", "u")])
    return _with_least(down, least).select(F.explode(pairs).alias("x")).select("x.a", "x.b").where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each linked node reaches. links: two columns of numbers, in any order.

    Nodes without a link to another one are not in the result.
    """
    a, b = links.columns
    links = saved(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    seen = None
    while True:
        links = saved(_small_star(_large_star(links)).distinct())
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).where("a > b")


def local_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """root, the least member of each one's component, after links between the members i and j are added."""
    root = root.copy()
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((above := root[root]) != root).any():
            root = above
