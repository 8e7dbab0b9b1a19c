"""Paged sources with a cursor and a budget of reads, as a Spark data source: in one batch, or as a stream whose offsets are cursors.

`fetch(key, cursor) -> (rows, reads, next cursor or None)` asks for one page; the first cursor is None. Keys are walked in their
order and share the budget: a page is asked for as long as less than the budget has been read, so the last one may go over it.
A key that fails is skipped alone. Pages follow one another by their cursors, so one task asks for them; what is done
with their rows is distributed.
"""

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

Fetch = Callable[[str, str | None], tuple[list[tuple], int, str | None]]


def step(fetch: Fetch, keys: Sequence[str], most_reads: int, at: dict) -> tuple[list[tuple], dict]:
    """One page's rows and the offset after it; an offset without a key is the end."""
    if at["key"] >= len(keys) or at["read"] >= most_reads:
        return [], at
    try:
        rows, reads, cursor = fetch(keys[at["key"]], at["cursor"])
    except Exception:
        rows, reads, cursor = [], 0, None
    done = cursor is None or not rows
    return rows, {"key": at["key"] + done, "cursor": None if done else cursor, "read": at["read"] + reads}


START = {"key": 0, "cursor": None, "read": 0}


def walk(fetch: Fetch, keys: Sequence[str], most_reads: int, start: dict = START, end: dict | None = None) -> Iterator[tuple]:
    at = start
    while at != end:
        rows, now = step(fetch, keys, most_reads, at)
        yield from rows
        if now == at:
            return
        at = now


def paged_source(name: str, schema: str, fetch: Fetch, keys: Sequence[str], most_reads: int) -> type[DataSource]:
    """A data source to register with spark.dataSource.register() and read by its name."""
    keys = list(keys)

    class Batch(DataSourceReader):
        def partitions(self):
            return [InputPartition(0)]

        def read(self, partition):
            return walk(fetch, keys, most_reads)

    class Stream(SimpleDataSourceStreamReader):
        def initialOffset(self):
            return START

        def read(self, start):
            rows, now = step(fetch, keys, most_reads, start)
            return iter(rows), now

        def readBetweenOffsets(self, start, end):
            return walk(fetch, keys, most_reads, start, end)

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Batch()

        def simpleStreamReader(self, schema):
            return Stream()

    return Paged
