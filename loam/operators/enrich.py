"""Expensive enrichment by an outside function, resumable: what has succeeded is never computed again.

`generate(path, tags) -> dict` is called once an item, with retries; an item that keeps failing gives a blank result that
isn't stored, so that the next run tries again. Blocked items must be filtered before: they never reach the function.
"""

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.operators.manifest import worklist, with_results
from loam.session import exists, materialised

SCHEMA = "path string, response string, ok boolean, schema_version int"


def is_transient(error: Exception) -> bool:
    """Whether trying again may help: an error that carries a status must be 429 or from 500 on; any other may."""
    status = getattr(error, "status", None) or getattr(error, "code", None) or getattr(getattr(error, "response", None), "status_code", None)
    return not isinstance(status, int) or status == 429 or status >= 500


def with_retries(call: Callable, *args, retries: int = 4, first: float = 1.0, longest: float = 30.0, sleep: Callable[[float], None] = time.sleep, again: Callable[[Exception], bool] = lambda e: True):
    """call(*args); on an error that `again` allows waits `first`, twice, four times ... that many seconds, up to the longest, and
    tries again, `retries` calls in all."""
    for attempt in range(retries):
        try:
            return call(*args)
        except Exception as error:
            if attempt == retries - 1 or not again(error):
                raise
            sleep(min(first * 2.0**attempt, longest))


def fetched(call: Callable, *args, sleep: Callable[[float], None] = time.sleep):
    """A call to a paged service: six tries, 5, 10, 20 ... seconds apart, after answers 429 and from 500 on."""
    return with_retries(call, *args, retries=6, first=5.0, longest=float("inf"), sleep=sleep, again=is_transient)


def responses(items: DataFrame, generate: Callable[[str, str], dict], version: int = 1, concurrency: int = 12, retries: int = 4, pause: float = 1.0, on_result: Callable[[str, dict, bool], None] | None = None) -> DataFrame:
    """(path, response as JSON, ok, schema_version) of items (path, tags), in their order; calls of a task overlap in a pool.
    on_result(path, response, ok) is called on the executor as soon as each one is there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(item):
            try:
                response, ok = with_retries(generate, *item, retries=retries, sleep=lambda s: time.sleep(s * pause)) or {}, True
            except Exception:
                response, ok = {}, False
            if on_result:
                on_result(item[0], response, ok)
            return json.dumps(response), ok

        with ThreadPoolExecutor(max(1, concurrency)) as pool:
            for batch in batches:
                got = list(pool.map(one, zip(batch["path"], batch["tags"], strict=True)))
                yield pd.DataFrame({"path": batch["path"], "response": [g[0] for g in got], "ok": [g[1] for g in got], "schema_version": version})

    return items.select("path", "tags").mapInPandas(run, SCHEMA)


def read_cache(spark, path: str, version: int) -> DataFrame:
    """Stored results of this version; none if there is no cache yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("schema_version") == version)


def preflight(items: DataFrame, generate: Callable[[str, str], dict]) -> None:
    """One call on the driver, so that a wrong key or model ends the run before the fan-out."""
    first = items.select("path", "tags").limit(1).collect()
    if first:
        generate(first[0]["path"], first[0]["tags"])


def enrich(items: DataFrame, generate: Callable[[str, str], dict], cache_path: str, version: int = 1, **options) -> DataFrame:
    """items with response and ok. Fresh successes are appended to the cache; failures are in the result alone."""
    spark = items.sparkSession
    cache = materialised(read_cache(spark, cache_path, version))
    todo = worklist(items.dropDuplicates(["path"]), cache)
    fresh = materialised(responses(todo, generate, version, **options))
    fresh.where("ok").write.mode("append").parquet(cache_path)
    return with_results(items, cache, fresh)
