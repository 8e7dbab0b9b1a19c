"""Manifests: tables keyed by path, extended and joined by key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def augment(manifest: DataFrame, updates: DataFrame, key: str = "path") -> DataFrame:
    """manifest with the columns of updates added or overwritten where the key is found; all other cells and rows stay.

    Every row of a repeated key is updated. Null cells of updates change nothing; keys must be unique there.
    """
    new = [c for c in updates.columns if c != key]
    right = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in new])
    joined = manifest.join(right, manifest[key] == right["_key"], "left")
    cols = []
    for c in [*manifest.columns, *[c for c in new if c not in manifest.columns]]:
        if c not in new:
            cols.append(F.col(c))
        elif c in manifest.columns:
            cols.append(F.coalesce(F.col(f"_new_{c}").cast(manifest.schema[c].dataType), F.col(c)).alias(c))
        else:
            cols.append(F.col(f"_new_{c}").alias(c))
    return joined.select(*cols)


def unmatched(manifest: DataFrame, updates: DataFrame, key: str = "path") -> DataFrame:
    """Updates whose key isn't in the manifest."""
    return updates.join(manifest.select(key), key, "left_anti")


def union(*parts: DataFrame, export: bool = False) -> DataFrame:
    """All rows, with all columns in the order of their first appearance; for export, missing cells are ''."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in out.columns]) if export else out


def present(rows: DataFrame, listing: DataFrame, key: str = "path") -> DataFrame:
    """Rows whose key is listed: files that a reviewer has deleted drop out."""
    return rows.join(listing.select(key), key, "left_semi")


def worklist(rows: DataFrame, cache: DataFrame, key: str = "path") -> DataFrame:
    """Rows that the cache lacks."""
    return rows.join(cache.select(key), key, "left_anti")


def with_results(rows: DataFrame, cache: DataFrame, fresh: DataFrame, key: str = "path") -> DataFrame:
    """Every row with its result, cached or fresh; `ok` is null where there is none."""
    return rows.join(cache.unionByName(fresh, allowMissingColumns=True), key, "left")
