"""Hierarchical packing of documents into sequences of several lengths.

Every task packs its own documents, a bounded round of tokens at a time, and nothing is shuffled. A document's full
windows come first; what is left of it goes to the shortest tier that holds it. Tiers are packed from the longest: each
window takes one document of its tier and fills its gap with the longest shorter ones that fit, the last one cut. What
remains when a task ends is cut at powers of two. So no sequence holds padding.
"""

import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tokens import document_ids

CONTEXT, TIERS = 4096, (512, 1024, 2048, 4096)
#: Tokens that a task holds at once, and that a training step takes.
ROUND, STEP = 1 << 21, 1 << 16
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_id long"


class Packer:
    """Of one task. A piece is (tokens, document's number, start); documents are (doc_id, ids)."""

    def __init__(self, first: int):
        self.next_sequence = self.next_step = first
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.pool: list[tuple[int, int, int]] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        n = len(self.docs)
        self.docs.append((doc_id, ids))
        self.pool.append((len(ids), n, 0))
        self.held += len(ids)

    def fill(self, room: int, pool: list, parts: list) -> int:
        """Moves the longest pieces that fit from the sorted pool, then the head of another; returns the room left."""
        while room and pool:
            at = bisect_right(pool, (room, 1 << 62, 0)) - 1
            if at >= 0:
                piece = pool.pop(at)
            else:
                n, doc, start = pool.pop(0)
                insort(pool, (n - room, doc, start + room))
                piece = (room, doc, start)
            parts.append(piece)
            room -= piece[0]
        return room

    def round(self, last: bool) -> list[tuple[int, list]]:
        """The sequences, as (tier, pieces), of what is held. Unless it is the last one, an unfilled one is held on."""
        out, pool = [], []
        for n, doc, start in self.pool:
            while n > CONTEXT:
                out.append((CONTEXT, [(CONTEXT, doc, start)]))
                n, start = n - CONTEXT, start + CONTEXT
            pool.append((n, doc, start))
        pool.sort()
        self.pool = []
        for tier in reversed(TIERS):
            while pool and (pool[-1][0] > tier // 2 or tier == TIERS[0]):
                parts = [pool.pop()]
                if self.fill(tier - parts[0][0], pool, parts):
                    self.pool = parts
                else:
                    out.append((tier, parts))
        if last:
            rest, self.pool = sorted(self.pool), []
            left = sum(n for n, _, _ in rest)
            while left:
                size = 1 << (left.bit_length() - 1)
                parts: list = []
                self.fill(size, rest, parts)
                out.append((size, parts))
                left -= size
        return out

    def rows(self, last: bool) -> pa.RecordBatch:
        """The pieces of a round's sequences. Each step gets sequences of one tier, dealt so that their costs are even."""
        cols: list[list] = [[] for _ in range(9)]
        by_tier: dict[int, list] = {}
        for tier, parts in self.round(last):
            by_tier.setdefault(tier, []).append(parts)
        for tier, group in sorted(by_tier.items()):
            group.sort(key=lambda parts: -sum(n * n for n, _, _ in parts))
            steps = -(-len(group) * tier // STEP)
            for i, parts in enumerate(group):
                lap, at = divmod(i, steps)
                step, offset = self.next_step + (steps - 1 - at if lap % 2 else at), 0
                for n, doc, start in parts:
                    doc_id, ids = self.docs[doc]
                    crc = zlib.crc32(ids[start : start + n].tobytes())
                    for col, v in zip(cols, (doc_id, start, n, crc, len(ids), self.next_sequence, offset, tier, step), strict=True):
                        col.append(v)
                    offset += n
                self.next_sequence += 1
            self.next_step += steps
        kept = sorted({doc for _, doc, _ in self.pool})
        new = {doc: i for i, doc in enumerate(kept)}
        self.docs = [self.docs[doc] for doc in kept]
        self.pool = [(n, new[doc], start) for n, doc, start in self.pool]
        self.held = sum(n for n, _, _ in self.pool)
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """One row a piece of a document (doc_id, text). tokenizer: a file of the tokenizers library.

    A null text counts as empty; an empty one is the end id alone. Repeated doc_ids are packed each for itself; null
    ones keep their null. No rows give none.
    """

    def run(batches):
        packer = Packer(TaskContext.get().partitionId() << 36)
        for batch in batches:
            ids_of = document_ids(tokenizer)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packer.add(doc_id, np.append(np.frombuffer(ids_of(text or ""), "<u4"), np.array([end_id], "<u4")))
                if packer.held >= ROUND:
                    yield packer.rows(False)
        yield packer.rows(True)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
