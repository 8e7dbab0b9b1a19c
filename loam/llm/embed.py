"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the axis, with its sign, that
it then is nearest to. A few such hashes make a bucket, in each of several tables; each vector goes to its own bucket and to
the next best ones. Candidate pairs, of equal labels, are verified by their cosine in double precision. The larger the largest
group, the more hashes make a bucket, so that buckets hold as few unlike vectors at any size; more tables and probes make up for it.

Equal vectors are one class, so that copies are never paired. A bucket of many classes is processed in pairs of blocks, each
a task's share: pairs are compared there, but only each vector's number of links and local components leave it. A pair that
meets in several buckets counts in the first of them alone.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import join_spread, partitions, saved
from .components import components

LEAST, SEED = 0.93, 4
#: Classes of a bucket that are compared as one block; unlike ones that a bucket may hold on average.
BLOCK, UNLIKE = 1024, 8
#: Tables by the hashes of a bucket, for a recall of over 0.99 at a cosine of LEAST. A vector goes to twice as many buckets of each
#: table as that has hashes.
TABLES = {2: 5, 3: 7, 4: 10, 5: 14}


def shape(classes: int, dim: int) -> tuple[int, int, int]:
    """Hashes a bucket, tables and probes for the largest group's number of classes."""
    axes = 2 * _padded(dim)
    hashes = next((k for k in TABLES if classes * 2 * k <= UNLIKE * axes**k), max(TABLES))
    while axes**hashes * TABLES[hashes] > 1 << 62:
        hashes -= 1
    return hashes, TABLES[hashes], 2 * hashes


def _padded(dim: int) -> int:
    return max(4, 1 << (dim - 1).bit_length())


def _rotations(dim: int, hashes: int, tables: int) -> np.ndarray:
    return np.random.default_rng(SEED + dim).choice([-1.0, 1.0], (tables, hashes, 3, dim))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def codes(vectors: np.ndarray, hashes: int = 2, tables: int = 5, probes: int = 4) -> np.ndarray:
    """(n, tables, probes): the buckets of unit vectors, the own one first. All codes of a table are below the next one's."""
    n, dim = vectors.shape
    d = _padded(dim)
    x = np.zeros((n, d))
    x[:, :dim] = vectors
    out = np.zeros((n, tables, probes), "i8")
    # Which of its three best axes each hash takes: all the best, one or two others the second, or one the third.
    own = np.zeros(hashes, int)
    one = np.eye(hashes, dtype=int)
    combos = np.array([own, *one, *(2 * one), *(one[i] + one[j] for i in range(hashes) for j in range(i))])
    for t, signs_of in enumerate(_rotations(d, hashes, tables)):
        axes, loss = [], 0.0
        for h, signs in enumerate(signs_of):
            y = x
            for s in signs:
                y = _hadamard(y * s)
            size = np.abs(y)
            top = np.argpartition(-size, 3, axis=1)[:, :3] if d > 3 else np.arange(d)[None].repeat(n, 0)
            v = np.take_along_axis(size, top, 1)
            order = np.lexsort((top, -v), axis=1)
            top, v = np.take_along_axis(top, order, 1), np.take_along_axis(v, order, 1)
            axes.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
            loss = loss + ((v[:, :1] - v) ** 2)[:, combos[:, h]]
        best = combos[np.argsort(loss, axis=1, kind="stable")[:, :probes]]
        code = np.full(best.shape[:2], t)
        for h in range(hashes):
            code = code * (2 * d) + np.take_along_axis(axes[h], best[:, :, h], 1)
        out[:, t, : best.shape[1]] = code
        out[:, t, best.shape[1] :] = code[:, :1]
    return out


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.astype(float).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each pair of rows of codes: the least code that both have. All codes of a table are below the next one's."""
    same = (a[:, :, :, None] == b[:, :, None, :]).any(3)
    return np.where(same, a, np.iinfo("i8").max).reshape(len(a), -1).min(1)


def _block(code: int, rows: dict[str, np.ndarray], parts: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket's block or pair of blocks: each row's linked vectors, and a root for each component in it."""
    x, k, block = rows["x"], rows["codes"], rows["block"]
    n = len(x)
    left, right = (np.flatnonzero(block == p) for p in parts)
    links, root = np.zeros(n, "i8"), rows["rep"].copy()
    found = []
    for lo in range(0, len(left), 256):
        some = left[lo : lo + 256]
        i, j = np.nonzero(x[some] @ x[right].T >= LEAST)
        i, j = some[i], right[j]
        if parts[0] == parts[1]:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            own = _first_shared(k[p], k[q]) == code
            found.append((p[own], q[own]))
    if found:
        i, j = (np.concatenate(c) for c in zip(*found, strict=True))
        np.add.at(links, i, rows["n"][j])
        np.add.at(links, j, rows["n"][i])
        while True:
            old = root.copy()
            least = np.minimum(root[i], root[j])
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
            if (root == old).all():
                break
    some = links > 0
    return rows["rep"][some], links[some], root[some]


def _links(classes: DataFrame, kind: str) -> DataFrame:
    """(rep, links, root), in any number of rows a class. classes: (grp, rep, n, vector), grp a label and dimension."""
    spark = classes.sparkSession
    n = partitions(spark)
    largest = classes.groupBy("grp", F.size("vector").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("n")).collect()
    # One figure a dimension.
    shapes = {r["dim"]: shape(r["n"], r["dim"]) for r in largest}

    def hashed(batches):
        for batch in batches:
            ends = np.cumsum(dims := np.array([len(v) for v in batch.column(3)], int))
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            out = [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = np.concatenate([flat[ends[i] - dim : ends[i]] for i in at])
                for i, c in zip(at, codes(_unit(own, int(dim)), *shapes[int(dim)]), strict=True):
                    out[i] = c.ravel()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], ["grp", "rep", "n", "vector", "codes"])

    coded = saved(classes.select("grp", "rep", "n", "vector").mapInArrow(hashed, f"grp long, rep long, n long, vector array<{kind}>, codes array<long>"))
    narrow = coded.select("grp", "rep", F.explode(F.array_distinct("codes")).alias("code"))
    sizes = narrow.groupBy("grp", "code").agg(F.count("*").alias("size")).where("size > 1")
    narrow = narrow.join(sizes, ["grp", "code"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    narrow = narrow.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    narrow = narrow.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    narrow = narrow.select("grp", "code", "rep", F.col("block").cast("long").alias("block"), F.least("block", "other").cast("long").alias("i"), F.greatest("block", "other").cast("long").alias("j"))
    wide = narrow.join(coded.drop("grp"), "rep").repartition(n, "grp", "code", "i", "j").sortWithinPartitions("grp", "code", "i", "j")

    def compare(batches):
        key, held = None, []

        def done():
            rep, count, block, vec, own = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(rep) < 2:
                return
            dim = len(vec) // len(rep)
            rows = {"rep": rep, "n": count, "block": block, "x": _unit(vec, dim), "codes": own.reshape(len(rep), *shapes[dim][1:])}
            r, k, root = _block(key[1], rows, key[2:])
            if len(r):
                yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(k), pa.array(root)], ["rep", "links", "root"])

        for batch in batches:
            keys = np.stack([c.to_numpy() for c in batch.columns[:4]], axis=1)
            rep, count, block = (c.to_numpy() for c in batch.columns[4:7])
            vec, own = ((c.offsets.to_numpy() - c.offsets[0].as_py(), c.flatten().to_numpy(zero_copy_only=False)) for c in batch.columns[7:9])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                now = tuple(keys[a].tolist())
                if now != key:
                    if held:
                        yield from done()
                    key, held = now, []
                held.append((rep[a:b], count[a:b], block[a:b], vec[1][vec[0][a] : vec[0][b]], own[1][own[0][a] : own[0][b]]))
        if held:
            yield from done()

    return wide.select("grp", "code", "i", "j", "rep", "n", "block", "vector", "codes").mapInArrow(compare, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row a vector (vec_id, embedding, label): n_links, component_id and kept.

    Null, empty and zero vectors and those with null or non-finite components link with nothing, nor do vectors without a
    label; vectors of different lengths link with nothing of each other. Equal vectors of a label link, copies included.
    Components keep the precision that they are given in. Repeated vec_ids are vectors of their own; a row with a null vec_id may
    link, and stays null if it is alone. Other columns are ignored, whatever their names. No rows give none.
    """
    v = F.col("embedding")
    kind = "float" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "double"
    sound = F.col("label").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "label", v.cast(f"array<{kind}>").alias("embedding"), F.coalesce(sound, F.lit(False)).alias("sound"))
    grp = F.xxhash64(F.col("label").cast("string"), F.size("embedding"))
    same = ["grp", "h", "g"]
    rows = rows.withColumn("grp", grp).withColumns({"h": F.xxhash64("grp", "embedding"), "g": F.xxhash64(F.lit(SEED), "embedding")})
    rows = rows.select("row", "vec_id", "embedding", "sound", *same)
    # A class is known by its number; numbers follow the least vec_ids only where they are needed, in the end.
    classes = rows.where("sound").groupBy(*same).agg(F.min("row").alias("rep"), F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("embedding").alias("vector"))
    classes = saved(classes)
    found = saved(_links(classes, kind))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select("rep", "root")).withColumnRenamed("node", "rep")
    label = classes.select(*same, "rep", "least", "n").join(counts, "rep", "left").join(joined, "rep", "left")
    label = saved(label.withColumn("component", F.coalesce("component", "rep")))
    least = saved(label.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("members")))
    label = join_spread(label, least, ["component"], "members")
    label = saved(label.select(*same, "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    out = join_spread(rows.where("sound").select("vec_id", *same), label, same, "n").select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
