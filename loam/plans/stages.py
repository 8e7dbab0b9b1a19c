"""The curation stages end to end: from measured items to a manifest, captions and a training set.

Items are rows (path, source, source_ord, width, height, corrupt, h, sharpness, tiles). Cheap gates come first; the near-duplicate
clusters see only what passes, and every rejected item is in the manifest with its reason.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.config import Captions, Gates, Ratios
from loam.functions import arrays, captions, geometry, text
from loam.operators import cluster, enrich, gates, manifest, ordered, report
from loam.session import materialised


def in_order(items: DataFrame) -> DataFrame:
    """items with `ord`, their place by source and the parts of their paths."""
    key = F.struct("source_ord", text.path_order(F.col("path")).alias("parts"))
    return ordered.numbered(items.withColumn("_key", key), ["_key"], "ord").drop("_key")


def measured_gates(items: DataFrame, g: Gates) -> DataFrame:
    """items with drop_reason, and bg_metric, the share of sharp tiles, where there are tiles."""
    share = arrays.sharp_share(F.col("tiles"), g.tile_sharpness) if "tiles" in items.columns else F.lit(None).cast("double")
    return items.withColumns({"drop_reason": gates.chain(items, g), "bg_metric": share})


def curate_pool(items: DataFrame, g: Gates = Gates(), per_source: bool = False) -> DataFrame:
    """The manifest of a pool: gates, then clusters over all sources, or within each, then crops and names. `emitted` is the place
    of a row in it: what the gates drop, duplicates, then what stays."""
    gated = materialised(in_order(measured_gates(items, g)))
    good, bad = gates.split_kept(gated)
    clustered = cluster.greedy_clusters(good.withColumn("px", F.col("width").cast("long") * F.col("height")), g.max_hamming, "source" if per_source else None)
    first = clustered.where("kept")
    cropped = first.withColumn("box", geometry.ratio_crop(F.col("width").cast("long"), F.col("height").cast("long")))
    named = ordered.output_names(cropped, F.col("source"), "path", ["ord"])
    kept = named.select("ord", F.col("out_name").alias("path"), F.col("path").alias("original"), "source", (F.col("box.r") - F.col("box.l")).alias("width"), (F.col("box.b") - F.col("box.t")).alias("height"), "box", arrays.hex64(F.col("h")).alias("phash"), F.col("sharpness").alias("blur_var"), "bg_metric", F.lit("False").alias("dropped"), F.lit("").alias("drop_reason"))
    dropped = bad.select("ord", "path", "source", "drop_reason").unionByName(clustered.where("not kept").select("ord", "path", "source", F.lit("duplicate").alias("drop_reason")))
    return ordered.emission(manifest.union(kept, dropped.withColumn("dropped", F.lit("True"))), "drop_reason", ["ord"]).drop("ord")


def bucket_ratios(curated: DataFrame, r: Ratios = Ratios()) -> DataFrame:
    return report.shares(gates.kept(curated), "source", r.target, r.tolerance)


def caption(curated: DataFrame, tagged: DataFrame, generate: Callable[[str, str], dict], vocab: captions.Vocabulary, order: tuple[str, ...], cache: str, c: Captions = Captions(), **options) -> DataFrame:
    """The manifest with rating_tag, quality_tag and caption; tagged: (path, tags, label).

    Items with a blocked tag are dropped before anything is generated: they never reach the outside function. An item
    without tags can't be judged, so it isn't captioned.
    """
    rows = gates.kept(curated).select("path", "width", "height").join(tagged, "path")
    rows = rows.withColumn("hits", text.block_hits(F.col("tags"), c.blocked))
    # Written out, so that the block is settled before the calls whatever the optimiser would do.
    rows = materialised(rows)
    blocked, clear = rows.where(F.size("hits") > 0), rows.where(F.size("hits") == 0)
    enrich.preflight(clear, generate)
    got = enrich.enrich(clear, generate, cache, retries=c.retries, concurrency=c.concurrency, **options)
    got = got.withColumn("parts", captions.coerce(F.coalesce("response", F.lit("{}")), vocab))
    fallback = text.first_label(F.col("label"), c.label_map, c.default_rating)
    parts = F.col("parts")
    quality = parts["quality"] if "quality" in vocab.singles else F.lit("")
    resolution = geometry.resolution_tag(F.col("width").cast("string"), F.col("height").cast("string"))
    done = got.select("path", captions.rating_of(parts, fallback).alias("rating_tag"), quality.alias("quality_tag"), captions.assemble(parts, order, vocab, F.col("tags"), resolution, fallback).alias("caption"))
    stopped = blocked.select("path", F.lit("True").alias("dropped"), F.concat(F.lit("underage_flag:"), F.array_join("hits", ",")).alias("drop_reason"))
    return manifest.augment(manifest.augment(curated, done), stopped)


def training_pairs(captioned: DataFrame, listing: DataFrame | None = None, min_size: int = 0, min_sharpness: float = 0) -> DataFrame:
    """(image_name, caption_name, caption, path) of what is curated and still listed."""
    rows = gates.curate(captioned, min_size, min_sharpness)
    rows = manifest.present(rows, listing) if listing is not None else rows
    return ordered.pair_names(rows, "path").select("image_name", "caption_name", "caption", "path")


def flat_epochs(losses: DataFrame, epochs: int = 2, least_gain: float = 0.0) -> DataFrame:
    """(epoch, loss, stop): stop is set once the loss hasn't fallen for that many epochs in a row; a row an epoch."""
    w = Window.orderBy("epoch")
    worse = (F.lag("loss").over(w) - F.col("loss") <= least_gain).cast("int")
    marked = losses.withColumn("_worse", F.coalesce(worse, F.lit(0)))
    return marked.withColumn("stop", F.sum("_worse").over(w.rowsBetween(1 - epochs, 0)) >= epochs).drop("_worse")
