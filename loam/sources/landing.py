"""Pages of search results that have landed as JSON lines: one row an item, filtered before anything is fetched."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loam.operators.ordered import within_budget
from loam.session import exists

MEDIA = "struct<media_key:string,type:string,url:string,width:int,height:int>"
PAGE = f"page long, handle string, data array<struct<id:string>>, media array<{MEDIA}>, next_token string"


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PAGE).json(folder) if exists(spark, folder) else spark.createDataFrame([], PAGE)


def consumed(found: DataFrame, most_reads: int) -> DataFrame:
    """Pages within the read budget, which all handles share, in the order of handle and page."""
    return within_budget(found.withColumn("reads", F.coalesce(F.size("data"), F.lit(0))), "reads", ["handle", "page"], most_reads)


def walked(found: DataFrame, least_side: int, most_saved: int) -> DataFrame:
    """Pages of each handle up to the first that is empty or names no next one, while fewer than most_saved items that fit
    came before; in the order of handle and page, each handle for itself."""
    small = lambda m: F.least(F.coalesce(m["width"], F.lit(0)), F.coalesce(m["height"], F.lit(0))) < least_side
    fits = F.size(F.filter(F.coalesce("media", F.array()), lambda m: (m["type"] == "photo") & ~small(m)))
    empty = F.coalesce(F.size("data"), F.lit(0)) <= 0
    over = empty | F.col("next_token").isNull() | (F.col("next_token") == "")
    before = Window.partitionBy("handle").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    marked = found.withColumns({"_over": F.coalesce(F.max(over).over(before), F.lit(False)), "_saved": F.coalesce(F.sum(fits).over(before), F.lit(0))})
    return marked.where(~F.col("_over") & (F.col("_saved") < most_saved) & ~empty).drop("_over", "_saved")


def media(found: DataFrame, least_side: int, landed: DataFrame | None = None) -> DataFrame:
    """Photos with a key and an address whose short side is large enough and that haven't landed yet; sizes default to 0."""
    m = found.select("handle", F.explode("media").alias("m")).select("handle", "m.*")
    small = F.least(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))) < least_side
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    out = m.where((F.col("type") == "photo") & ~small & filled("media_key") & filled("url")).dropDuplicates(["media_key"])
    return out.join(landed.select("media_key"), "media_key", "left_anti") if landed is not None else out


def resolved(handles: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Handles with their user's id, and those that have none."""
    joined = handles.join(users, "handle", "left")
    return joined.where("user_id is not null"), joined.where("user_id is null").select("handle")


def figures(found: DataFrame, least_side: int) -> DataFrame:
    """scanned, too_small and saved items."""
    m = found.select(F.explode("media").alias("m")).select("m.*")
    small = F.least(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))) < least_side
    return m.agg(F.count("*").alias("scanned"), F.count_if(small).alias("too_small"), F.count_if(~small & (F.col("type") == "photo")).alias("saved"))


def sampled(df: DataFrame, labels: str, wanted: list[str], most: int) -> DataFrame:
    """At most that many rows that have one of the wanted labels."""
    return df.where(F.arrays_overlap(labels, F.array(*[F.lit(w) for w in wanted]))).limit(most)
