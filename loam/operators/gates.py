"""Quality gates. Every rejected row keeps its reason; rows are never lost."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.config import Gates
from loam.functions import arrays, geometry
from loam.functions.text import to_double, to_int
from loam.session import materialised


def drop_reason(corrupt: Column, small: Column, blurry: Column, drop_small: bool = True, drop_blurry: bool = True, duplicate: Column | None = None) -> Column:
    """The first that holds of corrupt, too_small, blurry and duplicate; '' if none does. Nulls don't hold."""
    reason = F.when(corrupt, "corrupt")
    if drop_small:
        reason = reason.when(small, "too_small")
    if drop_blurry:
        reason = reason.when(blurry, "blurry")
    if duplicate is not None:
        reason = reason.when(duplicate, "duplicate")
    return reason.otherwise("")


def split_kept(df: DataFrame, reason: str = "drop_reason") -> tuple[DataFrame, DataFrame]:
    """Kept rows and rejected ones."""
    return df.where(F.col(reason) == ""), df.where(F.col(reason) != "")


def kept(df: DataFrame) -> DataFrame:
    """Manifest rows that are marked as not dropped; an unmarked row isn't kept."""
    return df.where(F.col("dropped") == "False")


def curate(df: DataFrame, min_size: int = 0, min_sharpness: float = 0) -> DataFrame:
    """Kept rows with a caption that pass the gates that are on; a metric that can't be read fails its gate."""
    out = kept(df).where(F.coalesce(F.col("caption") != "", F.lit(False)))
    if min_size:
        out = out.where(F.coalesce((to_int(F.col("width")) >= min_size) & (to_int(F.col("height")) >= min_size), F.lit(False)))
    if min_sharpness:
        sharp = to_double(F.col("blur_var"))
        out = out.where(F.coalesce((sharp >= min_sharpness) & ~F.isnan(sharp), F.lit(False)))
    return out


def text_flag(share: Column, most: float) -> Column:
    """A flag, not a reason to drop."""
    return F.coalesce(share > most, F.lit(False))


def chain(items: DataFrame, g: Gates) -> Column:
    """Why an item (width, height, corrupt, sharpness, tiles?) is dropped: unreadable, too small, blurry, or sharp in too few
    tiles. A measure that is missing fails its gate; tiles aren't looked at if the items have none or the setting is 0."""
    small = geometry.too_small(F.col("width"), F.col("height"), g.min_size)
    blurry = F.coalesce(F.col("sharpness"), F.lit(0.0)) < g.min_sharpness
    reason = drop_reason(F.coalesce("corrupt", F.lit(True)), small, blurry, g.drop_small, g.drop_blurry)
    if not g.tiles or "tiles" not in items.columns:
        return reason
    flat = ~arrays.passes_share(F.col("tiles"), g.tile_sharpness, g.tile_share)
    return F.when((reason == "") & flat, "flat_background").otherwise(reason)


def with_duplicates(rows: DataFrame, digest: str, order: str, reason: str = "drop_reason") -> DataFrame:
    """rows whose reason is 'duplicate' where an earlier one has the same digest; what other gates drop has a null digest.

    `order` is unique. Rows are computed once, without their contents. They meet the first of their digest by digest and
    order, so that a digest of very many rows is nowhere gathered.
    """
    rows = materialised(rows)
    first = rows.where(F.col(digest).isNotNull()).groupBy(F.col(digest).alias("_digest")).agg(F.min(order).alias("_first"))
    out = rows.join(first, (F.col(digest) == F.col("_digest")) & (F.col(order) == F.col("_first")), "left")
    again = F.col(digest).isNotNull() & F.col("_digest").isNull()
    return out.withColumn(reason, F.when(again, "duplicate").otherwise(F.col(reason))).drop("_digest", "_first")
