"""SimHash near-duplicates: fingerprints of 64 bits that differ in few of them are linked.

Meet-in-the-middle ball hashing. Every fingerprint emits all variants of itself within half the radius; two that are at
most the radius apart share a variant. A whole ball of half of 4 has 2,081 variants, of 33 KB, for a fingerprint that stands
for 3 KB of text. So the ball is taken in each of a few parts of the bits: by the pigeonhole principle two fingerprints within
the radius are at most 2 apart in one part, and balls of radius 1 meet there: 66 variants for two parts of 32 bits.

Fingerprints that share a variant of a part are compared in the task that holds it, and what leaves it is one row at most a
member: the least member that it is connected to there. Members of a large bucket are reached from one another, each looking
only at those that nothing has reached yet, so a group of near copies, where almost all are reached at once, costs little more
than one comparison a member. A bucket of more than SPLIT members is dealt out in pairs of blocks.

Near copies in the sense of a Jaccard similarity need a radius so wide that parts are narrow. So sketches of the texts' shingles
confirm what fingerprints suggest; and where a table is so large that buckets fill with unlike texts, a bucket's task takes it apart
by the sketches: those that differ in few bits are at most 2 apart in one of their parts too. Nothing is lost by that: at any size
exactly those are connected that the rule links.
"""

from dataclasses import dataclass
from itertools import combinations, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_spread, partitions, saved, unused
from .components import components, local_roots

SEED = 42
#: Rows that a task looks at together; members up to which a bucket is compared pair by pair, and from which on it is split.
CHUNK, SMALL, SPLIT = 1 << 18, 64, 1 << 20
#: Orders of a text's shingles, whose least ones are its samples: the last bit of each makes its sketch.
SAMPLES = 64
MIX = np.random.default_rng(SEED).integers(0, 1 << 31, SAMPLES, dtype="u4") * np.uint32(2) + np.uint32(1)
#: Unlike nodes on average from which on buckets of more members are taken apart by the sketches, once so many seeds have reached
#: their near copies.
UNLIKE, SEEDS = 512, 8


@dataclass(frozen=True)
class Rule:
    """What is linked: fingerprints over shingles of so many words that differ in at most `radius` bits, sought in so many parts
    (radius // parts must be 2 or less), of texts whose sketches differ in at most `apart` samples."""

    shingle: int = 4
    radius: int = 4
    parts: int = 2
    apart: int = SAMPLES

    def __post_init__(self):
        if self.radius // self.parts > 2:
            raise ValueError("balls of radius 1 meet only within 2 bits: more parts are needed")

    @property
    def sketched(self) -> bool:
        return self.apart < SAMPLES

    @property
    def sketch_parts(self) -> int:
        """So many that sketches which `apart` allows are at most 2 apart in one of them."""
        return self.apart // 3 + 1


#: The contract's rule: fingerprints alone. And near copies: at a Jaccard similarity of 0.8 fingerprints differ in 10 bits on
#: average, and bits of the sketch with a chance of 0.1, so 10 or fewer of 64 in 95 of 100 cases; of unlike texts half of them differ.
FINGERPRINTS, NEAR_COPIES = Rule(), Rule(shingle=5, radius=11, parts=4, apart=10)


def _shingles(text: str | None, n: int) -> np.ndarray:
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return np.array([digest(joined, SEED)], "<u8")
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8", len(words) - n + 1)


def _fingerprint(hashes: np.ndarray) -> int:
    counts = np.zeros(64, "int64")
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits((2 * counts > len(hashes)).astype("u1"), bitorder="little").view("<u8")[0])


def _samples(hashes: np.ndarray) -> np.ndarray:
    """The least of all hashes, of 32 bits, in each of SAMPLES orders of them; 0 for none."""
    least = np.full(SAMPLES, np.iinfo("u4").max)
    for at in range(0, len(hashes), 1 << 11):
        x = hashes[at : at + (1 << 11), None].astype("u4") * MIX
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        least = np.minimum(least, x.min(axis=0))
    return least if len(hashes) else np.zeros(SAMPLES, "u4")


def _sketch(hashes: np.ndarray) -> int:
    """The last bit of every sample."""
    return int(np.packbits((_samples(hashes) & 1).astype("u1"), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, rule: Rule = FINGERPRINTS) -> DataFrame:
    """(doc_id, mark, fp, sketch): all but doc_id as signed 64-bit numbers, sketch 0 where the rule has none; mark
    a hash of the text itself. ASCII letters count as lower case; words are split at ASCII white space."""
    n, sketched = rule.shingle, rule.sketched

    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column(2).to_pylist():
                h = _shingles(text, n)
                found.append((_fingerprint(h) if len(h) else 0, _sketch(h) if sketched else 0))
            cols = np.array(found, "u8").reshape(-1, 2).view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in cols.T)], ["doc_id", "mark", "fp", "sketch"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return ids.mapInArrow(run, "doc_id long, mark long, fp long, sketch long")


def ball(width: int, radius: int) -> list[int]:
    """Masks of all numbers of `width` bits, up to 63, that differ from 0 in at most `radius`."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _variants(fp: Column, parts: int) -> Column:
    """The variants of each part within one bit, with the part's number above them."""
    cuts = [round(i * 64 / parts) for i in range(parts + 1)]

    def of(number: int, low: int, width: int) -> Column:
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(number << width))
        return F.transform(F.array(*[F.lit(m).cast("long") for m in ball(width, 1)]), lambda m: part.bitwiseXOR(m))

    return F.concat(*[of(p, low, high - low) for p, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))])


def _near(rule: Rule):
    """near(fps, fps, sketches, sketches), all unsigned: which of the pairs are linked."""
    radius, apart, sketched = rule.radius, rule.apart, rule.sketched

    def near(a, b, s, t):
        close = np.bitwise_count(a ^ b) <= radius
        return close & (np.bitwise_count(s ^ t) <= apart) if sketched else close

    return near


def _reached(fp: np.ndarray, sketch: np.ndarray, near, seeds: int | None = None):
    """Links (seed, member) of a bucket: members are reached from a seed over ever more members, each of which is compared
    with those that aren't reached yet. After so many seeds, if given, nothing that is left is near what they reached."""
    left = np.arange(len(fp))
    while len(left) and seeds != 0:
        seeds = seeds and seeds - 1
        seed, left = left[0], left[1:]
        queue = [np.array([seed])]
        while queue and len(left):
            some = queue.pop()
            step = max(1, (1 << 20) // len(left))
            if len(some) > step:
                queue.append(some[step:])
                some = some[:step]
            hit = near(fp[some, None], fp[None, left], sketch[some, None], sketch[None, left]).any(axis=0)
            if hit.any():
                queue.append(left[hit])
                yield np.full(int(hit.sum()), seed), left[hit]
                left = left[~hit]


def _meetings(sketch, parts):
    """(keys, members), ascending by key and whole keys at a time: members whose sketches are at most 2 bits apart in one of so
    many parts have a key in common there."""
    cuts = [round(i * 64 / parts) for i in range(parts + 1)]
    for low, high in zip(cuts, cuts[1:], strict=False):
        part = sketch >> np.uint64(low) & np.uint64((1 << high - low) - 1)
        keys = (part ^ np.array(ball(high - low, 1), "u8")[:, None]).ravel()
        # Numbers of 16 bits are sorted by radix.
        keys = keys.astype("u2") if high - low <= 16 else keys
        order, at = np.argsort(keys, kind="stable"), 0
        keys = keys[order]
        while at < len(keys):
            # CHUNK rows, and the rest of the last key.
            end = int(np.searchsorted(keys, keys[min(at + CHUNK, len(keys)) - 1], side="right"))
            yield keys[at:end], order[at:end] % len(sketch)
            at = end


def _joined(key, fp, sketch, near, parts):
    """Pairs (i, j) of rows enough to connect all that `near` connects within a key. Rows lie by key, ascending. Buckets of over
    UNLIKE rows are taken apart by so many parts of the sketches, if any."""
    n = len(key)
    same = key[1:] == key[:-1]
    first = np.flatnonzero(np.r_[True, ~same]) if n else np.zeros(0, int)
    size = np.diff(np.r_[first, n])
    large = np.flatnonzero(size > SMALL)
    at = np.flatnonzero(same if not len(large) else same & (np.repeat(size, size) <= SMALL)[:-1])
    for step in range(1, SMALL):
        if step > 1:
            at = at[at + step < n]
            at = at[key[at] == key[at + step]]
        if not len(at):
            break
        i = at[near(fp[at], fp[at + step], sketch[at], sketch[at + step])]
        yield i, i + step
    for lo, m in zip(first[large].tolist(), size[large].tolist(), strict=True):
        f, s, left = fp[lo : lo + m], sketch[lo : lo + m], np.ones(m, bool)
        apart = parts and m > UNLIKE
        for i, j in _reached(f, s, near, SEEDS if apart else None):
            left[i], left[j] = False, False
            yield lo + i, lo + j
        if apart:
            rest = np.flatnonzero(left)
            for keys, some in _meetings(s[rest], parts):
                some = rest[some]
                for i, j in _joined(keys, f[some], s[some], near, 0):
                    yield lo + some[i], lo + some[j]


def _resolved(key, node, fp, sketch, near, parts=0):
    """(node, least node that it is connected to within these rows), for those that aren't the least. Rows lie by key, ascending."""
    ids, own = np.unique(node, return_inverse=True)
    root, held, waiting = np.arange(len(ids)), [], 0

    def merge():
        nonlocal root, held, waiting
        root = local_roots(root, *(np.concatenate(x) for x in zip(*held, strict=True))) if held else root
        held, waiting = [], 0

    for i, j in _joined(key, fp, sketch, near, parts):
        if len(i):
            held.append((own[i], own[j]))
            waiting += len(i)
        if waiting > CHUNK:
            merge()
    merge()
    some = np.flatnonzero(root != np.arange(len(ids)))
    return ids[some], ids[root[some]]


def _settle(rule: Rule, split: int | None, parts: int = 0):
    """Of rows (key, node, fp, sketch) sorted by key: links (a, b), and (a, null, key) for members of a bucket of over `split`.
    Buckets are taken apart by so many parts of the sketches, if any."""
    near = _near(rule)

    def links(a, b=None, key=None):
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), none if b is None else pa.array(b), none if key is None else pa.array(key)], ["a", "b", "key"])

    def solved(cols):
        key, node, fp, sketch = cols
        a, b = _resolved(key, node, fp.view("u8"), sketch.view("u8"), near, parts)
        if len(a):
            yield links(a, b)

    def run(batches):
        held, n, goal, hot = [], 0, CHUNK, None
        for batch in batches:
            cols = [np.array(c) for c in batch.columns]
            if hot is not None:
                k = int(np.searchsorted(cols[0], hot, side="right"))
                if k:
                    yield links(cols[1][:k], key=cols[0][:k])
                cols = [c[k:] for c in cols]
                if not len(cols[0]):
                    continue
                hot = None
            held.append(cols)
            n += len(cols[0])
            if n >= goal:
                cols = [np.concatenate(c) for c in zip(*held, strict=True)]
                last = int(np.searchsorted(cols[0], cols[0][-1]))
                yield from solved([c[:last] for c in cols])
                cols = [c[last:] for c in cols]
                held, n = [cols], n - last
                if split and n > split:
                    yield links(cols[1], key=cols[0])
                    held, n, hot = [], 0, cols[0][0]
                goal = n + CHUNK
        if held:
            yield from solved([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def chosen(nodes: int, rule: Rule) -> int:
    """How many times 16-fold buckets hold more unlike nodes than UNLIKE on average, for so many nodes. Large buckets of a small table
    are near copies, reached at once; from 1 on it costs less to take them apart. Links are enough for the same components either way."""
    width = 64 // rule.parts
    unlike = nodes * (width + 1) / (1 << width)
    return next(k for k in count() if unlike <= UNLIKE * 16**k) if rule.sketched else 0


def links(nodes: DataFrame, rule: Rule = FINGERPRINTS) -> DataFrame:
    """(a, b): links between nodes (node, fp, sketch), a written table, enough to connect all that the rule connects."""
    n, schema = partitions(nodes.sparkSession), "a long, b long, key long"
    parts = rule.sketch_parts if rule.sketched and chosen(nodes.count(), rule) else 0
    lie = lambda df: df.repartition(n, "key").sortWithinPartitions("key").select("key", "node", "fp", "sketch")
    dealt = nodes.select("node", "fp", "sketch", F.explode(_variants(F.col("fp"), rule.parts)).alias("key"))
    met = saved(lie(dealt).mapInArrow(_settle(rule, SPLIT, parts), schema))
    found, crowd = met.where("b is not null"), met.where("b is null").select(F.col("a").alias("node"), F.col("key").alias("bucket"))
    if crowd.limit(1).count():
        # At most one row a SPLIT variants that were dealt.
        blocks = crowd.groupBy("bucket").agg(F.ceil(F.count("*") * 2 / SPLIT).cast("int").alias("blocks"))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        crowd = crowd.join(F.broadcast(blocks), "bucket").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        crowd = crowd.select("node", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("key")).join(nodes, "node")
        found = found.unionByName(lie(crowd).mapInArrow(_settle(rule, None, parts), schema))
    return found.select("a", "b").distinct()


def _labelled(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """fingerprints() of each document, and (fp, sketch, n, first) of each node of the links: the documents that it stands for,
    and the least (no id?, doc_id, mark) that it reaches."""
    prints = saved(fingerprints(docs, rule))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    nodes = prints.groupBy("fp", "sketch").agg(F.min(place).alias("least"), F.count("*").alias("n"))
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id() if rule.sketched else F.col("fp")))
    joined = components(links(nodes.select("node", "fp", "sketch"), rule))
    linked = saved(nodes.join(joined, "node"))
    first = linked.unionByName(nodes.join(joined.select(F.col("component").alias("node")).distinct(), "node").withColumn("component", F.col("node")))
    first = first.groupBy("component").agg(F.min("least").alias("first"), F.count("*").alias("members"))
    alone = nodes.join(joined.select("node"), "node", "left_anti").join(first.withColumnRenamed("component", "node").select("node", "first"), "node", "left")
    alone = alone.select("fp", "sketch", "n", F.coalesce("first", "least").alias("first"))
    return prints, alone.unionByName(join_spread(linked, saved(first), ["component"], "members").select("fp", "sketch", "n", "first"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, text): fingerprint and component_id, the least doc_id reachable.

    A text without words, or null, has the fingerprint 0 and is linked like any other. Equal fingerprints are one node
    of the links, so that copies are never paired. Rows without a doc_id keep their null and take part in links; a
    component of such rows alone has a null id. Repeated rows get equal results; other columns are ignored, whatever their
    names. No rows give none.
    """
    prints, label = _labelled(docs, FINGERPRINTS)
    label = saved(label.select("fp", "n", F.col("first.doc_id").alias("component_id")))
    return join_spread(prints, label, ["fp"], "n").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, rule: Rule = NEAR_COPIES) -> DataFrame:
    """docs with one document of each component: the one of least doc_id, of equal ids the one whose text's hash is least,
    of equal rows any. Rows without a doc_id come last, and texts without words, or null, are copies of one another. All
    columns are kept, whatever their names. No rows give none."""
    prints, label = _labelled(docs.select("doc_id", "text"), rule)
    id_, mark = unused(docs.columns, "id", "mark")
    first = saved(label.select(F.col("first.doc_id").alias(id_), F.col("first.mark").alias(mark)).distinct())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(mark))
    kept = docs.join(first, same, "left_semi")
    again = saved(prints.groupBy(F.col("doc_id").alias(id_), F.col("mark").alias(mark)).count().where("count > 1").select(id_, mark))
    if again.limit(1).count():
        # Rows that are equal in id and text: one of each.
        kept = kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept
