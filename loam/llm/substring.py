"""Substring dedup: words covered by a window of 20 words that also starts earlier are removed.

1. Each window has an anchor, the least of its gram hashes (a gram: GRAM words), the rightmost of equals; equal windows have
   equal anchors at equal places. A count-min sketch of all anchors' places, summed over partitions, overestimates how often
   each occurs, and so how often each window can.
2. Windows whose anchor may occur again are hashed to 96 bits. Of those that a task has several times only the first goes on,
   so that no window reaches a later stage more often than there are tasks; the others are known to be repeated. What goes on
   is dealt out by hash, in one row a task and bucket, and the first of each window is found exactly.
3. The repeated windows of each document return to it, and the words that they cover are removed.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, saved

WINDOW, GRAM = 20, 5
#: The sketch: hash rows, and cells a row, by the number of anchors and within bounds (a bit a cell, once
#: summed: 100 MB at most, broadcast).
ROWS, CELLS_PER_ANCHOR, LEAST_CELLS, MOST_CELLS = 3, 4, 1 << 20, 1 << 28
#: Windows that a task looks at together.
TOGETHER = 4_000_000
_rng = np.random.default_rng(20)
MIX = _rng.integers(1, 1 << 62, (3, WINDOW), dtype="u8") * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 250_000:
            self.clear()
        self[word] = h
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slid(h: np.ndarray, width: int, row: int) -> np.ndarray:
    """A hash of each `width` values in a row."""
    n = len(h) - width + 1
    out = h[:n] * MIX[row, 0]
    for j in range(1, width):
        out = out + h[j : j + n] * MIX[row, j]
    return _mixed(out)


def _word_hashes(text: str | None, known: _WordHashes) -> np.ndarray:
    words = (text or "").encode().split()
    return np.fromiter(map(known.__getitem__, words), "u8", len(words))


def _anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and for each window the place of its anchor. h: hashes of at least WINDOW words."""
    grams = _slid(h, GRAM, 0)
    n, w = len(h) - WINDOW + 1, WINDOW - GRAM + 1
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, w):
        now = grams[j : j + n]
        better = now <= best
        best = np.where(better, now, best)
        at = np.where(better, np.arange(j, j + n), at)
    return grams, at


def _cells(grams: np.ndarray, cells: int) -> np.ndarray:
    """(ROWS, n): the cell of each hash in each row of the sketch."""
    step = _mixed(grams ^ np.uint64(0x9E3779B97F4A7C15))
    return np.stack([(grams + np.uint64(r) * step) & np.uint64(cells - 1) for r in range(ROWS)]).astype("i8")


def _sketch(docs: DataFrame, cells: int) -> np.ndarray:
    """(ROWS, cells): how often a cell is met, up to 2. Partitions send the cells that they meet, by blocks, to be summed."""
    block = 1 << 18
    blocks = max(1, cells // block)

    def count(batches):
        known, met = _WordHashes(), []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                h = _word_hashes(text, known)
                if len(h) >= WINDOW:
                    grams, at = _anchors(h)
                    met.append(grams[np.unique(at)])
        if met:
            for r, found in enumerate(_cells(np.concatenate(met), cells)):
                cell, times = np.unique(found, return_counts=True)
                owner = cell // block
                for b in np.unique(owner):
                    mine = owner == b
                    one, more = (cell[mine & (times < 2)] % block).astype("<u4"), (cell[mine & (times > 1)] % block).astype("<u4")
                    yield pa.RecordBatch.from_arrays([pa.array([r * blocks + int(b)]), pa.array([one.tobytes()]), pa.array([more.tobytes()])], ["block", "one", "more"])

    def merge(batches):
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, one, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b not in have:
                    have[b] = np.zeros(min(block, cells), "u1")
                have[b][np.frombuffer(one, "<u4")] += 1
                have[b][np.frombuffer(more, "<u4")] = 2
                np.minimum(have[b], 2, out=have[b])
        for b, a in have.items():
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([np.packbits(a > 1).tobytes()])], ["block", "twice"])

    n = min(partitions(docs.sparkSession), ROWS * blocks)
    parts = docs.select("text").mapInArrow(count, "block long, one binary, more binary").repartition(n, "block").mapInArrow(merge, "block long, twice binary")
    out = np.zeros((ROWS * blocks, min(block, cells) // 8), "u1")
    for r in parts.toLocalIterator():
        out[r["block"]] = np.frombuffer(r["twice"], "u1")
    return out.reshape(ROWS, -1)


def _size_of_sketch(docs: DataFrame) -> int:
    """Cells a row: a power of two, by the number of words, which a seventh of are anchors."""
    words = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] / 5
    wanted = max(LEAST_CELLS, int(words / 7 * CELLS_PER_ANCHOR))
    return min(MOST_CELLS, 1 << (wanted - 1).bit_length())


#: A record holds windows (with hashes a, b) or repeated starts (without) of many documents: parallel arrays as bytes.
RECORD = {"bucket": pa.int32(), "docs": pa.binary(), "marks": pa.binary(), "places": pa.binary(), "start": pa.binary(), "a": pa.binary(), "b": pa.binary()}
RECORD_DDL = "bucket int, docs binary, marks binary, places binary, start binary, a binary, b binary"


def _again(doc, start, a, b) -> np.ndarray:
    """Of windows sorted by hash, document and start: those that start later than the first of their hash."""
    if not len(a):
        return np.zeros(0, bool)
    head = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    first = np.maximum.accumulate(np.where(head, np.arange(len(a)), 0))
    return (doc != doc[first]) | (start != start[first])


def _numbered(doc, mark) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's number among the different (doc, mark), and these."""
    order = np.lexsort((mark, doc))
    d, m = doc[order], mark[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (m[1:] != m[:-1])] if len(d) else np.zeros(0, bool)
    own = np.empty(len(d), "i8")
    own[order] = np.cumsum(new) - 1
    return own, d[new], m[new]


def _packed(owner, own, ids, marks, start, a=None, b=None):
    """A record for each owner (a bucket) of rows; own numbers their documents in ids and marks."""
    order = np.lexsort((start, own, owner))
    owner, own, start = owner[order], own[order], start[order].astype("<i4")
    a, b = (None if x is None else x[order] for x in (a, b))
    at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, int)
    for i, j in zip(at[:-1], at[1:], strict=True):
        some, places = np.unique(own[i:j], return_inverse=True)
        cols = {"docs": ids[some], "marks": marks[some], "places": places.astype("<i4"), "start": start[i:j]}
        cols |= {} if a is None else {"a": a[i:j], "b": b[i:j]}
        cols = {n: v.tobytes() for n, v in cols.items()} | {"bucket": int(owner[i])}
        yield pa.RecordBatch.from_arrays([pa.array([cols.get(n)], t) for n, t in RECORD.items()], list(RECORD))


def _starts(doc, mark, start, buckets: int):
    """Records of repeated starts, by their documents' buckets."""
    own, ids, marks = _numbered(doc, mark)
    # By the text too, so that many rows of one id, or of none, spread.
    yield from _packed((_mixed(doc.astype("u8") ^ _mixed(mark.astype("u8"))) % np.uint64(buckets)).astype("i8"), own, ids, marks, start)


def _unpacked(record) -> tuple[np.ndarray, ...]:
    _, docs, marks, places, start, a, b = record
    at = np.frombuffer(places, "<i4")
    out = np.frombuffer(docs, "<i8")[at], np.frombuffer(marks, "<i8")[at], np.frombuffer(start, "<i4")
    return out if a is None else (*out, np.frombuffer(a, "<u8"), np.frombuffer(b, "<u4"))


def _records(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _repeated(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc, mark, starts): of each document with repeated windows their starts, as 32-bit numbers.

    docs: (doc, mark, text); doc orders documents, and mark tells apart those of one doc."""
    spark = docs.sparkSession
    cells, n_parts = _size_of_sketch(docs), partitions(spark)
    sketch = spark.sparkContext.broadcast(_sketch(docs, cells))

    def flush(ids, marks, held):
        own, start, a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        ids, marks = np.array(ids, "i8"), np.array(marks, "i8")
        order = np.lexsort((start, ids[own], b, a))
        own, start, a, b = own[order], start[order], a[order], b[order]
        again = _again(ids[own], start, a, b)
        # What starts later than another one of this task is repeated; the first may be too, by another task's.
        yield from _starts(ids[own[again]], marks[own[again]], start[again], buckets)
        own, start, a, b = own[~again], start[~again], a[~again], b[~again]
        yield from _packed((a % np.uint64(buckets)).astype("i8"), own, ids, marks, start, a, b)

    def deal(batches):
        known, twice = _WordHashes(), sketch.value
        ids, marks, held, n = [], [], [], 0
        for d, m, text in _records(batches):
            h = _word_hashes(text, known)
            if len(h) < WINDOW:
                continue
            grams, at = _anchors(h)
            ours = np.unique(at)
            found = _cells(grams[ours], cells)
            maybe = np.ones(len(ours), bool)
            for r in range(ROWS):
                maybe &= (twice[r, found[r] >> 3] >> (7 - (found[r] & 7)).astype("u1")) & 1 == 1
            flag = np.zeros(len(grams), bool)
            flag[ours[maybe]] = True
            start = np.flatnonzero(flag[at])
            if len(start):
                held.append((np.full(len(start), len(ids), "i4"), start.astype("i4"), _slid(h, WINDOW, 1)[start], (_slid(h, WINDOW, 2)[start] >> np.uint64(32)).astype("u4")))
                ids.append(d)
                marks.append(m)
                n += len(start)
            if n >= TOGETHER:
                yield from flush(ids, marks, held)
                ids, marks, held, n = [], [], [], 0
        if held:
            yield from flush(ids, marks, held)

    def settle(batches):
        windows: dict[int, list] = {}
        known: dict[int, list] = {}
        for record in _records(batches):
            (known if record[-1] is None else windows).setdefault(record[0], []).append(_unpacked(record))
        parts = [tuple(np.concatenate(x) for x in zip(*p, strict=True)) for p in known.values()]
        known.clear()
        while windows:
            doc, mark, start, a, b = (np.concatenate(x) for x in zip(*windows.popitem()[1], strict=True))
            order = np.lexsort((start, doc, b, a))
            doc, mark, start, a, b = doc[order], mark[order], start[order], a[order], b[order]
            again = _again(doc, start, a, b)
            parts.append((doc[again], mark[again], start[again]))
        if parts:
            yield from _starts(*(np.concatenate(x) for x in zip(*parts, strict=True)), buckets)

    def gather(batches):
        held: dict[int, list] = {}
        for record in _records(batches):
            held.setdefault(record[0], []).append(_unpacked(record))
        while held:
            doc, mark, start = (np.concatenate(x) for x in zip(*held.popitem()[1], strict=True))
            own, ids, marks = _numbered(doc, mark)
            order = np.lexsort((start, own))
            cuts = np.cumsum(np.bincount(own, minlength=len(ids)))[:-1]
            for lo in range(0, len(ids), 4096):
                hi = min(len(ids), lo + 4096)
                edge = np.r_[0, cuts, len(own)][lo : hi + 1]
                starts = [start[order[i:j]].tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi]), pa.array(marks[lo:hi]), pa.array(starts, pa.binary())], ["doc", "mark", "starts"])

    dealt = docs.select("doc", "mark", "text").mapInArrow(deal, RECORD_DDL).repartition(n_parts, "bucket")
    settled = dealt.mapInArrow(settle, RECORD_DDL).repartition(n_parts, "bucket")
    return settled.mapInArrow(gather, "doc long, mark long, starts binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, text): its words, how many are removed, and the kept ones joined by a space, `kept`.

    A null text has no words. Rows that share a doc_id count as one document: windows that start at the same word of
    both aren't earlier than each other. Null doc_ids count as one document after all others. No rows give none.
    """
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("mark"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = saved(_repeated(ids, 4 * partitions(docs.sparkSession)))

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, "i8")
                if starts:
                    at = np.unique(np.frombuffer(starts, "<i4"))
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + WINDOW, -1)
                keep = np.cumsum(gone)[: len(words)] == 0
                left = words if keep.all() else [words[i] for i in np.flatnonzero(keep)]
                for col, v in zip(out, (len(words), len(words) - len(left), b" ".join(left).decode()), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    joined = ids.join(found, ["doc", "mark"], "left").select("doc_id", "text", "starts")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def repeats_removed(docs: DataFrame) -> DataFrame:
    """without_repeats(), with a digest of the kept words in their place."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
