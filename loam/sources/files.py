"""Files as tables: images, buckets of them, and manifests."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions.text import path_order
from loam.session import exists

# The endings that are images.
IMAGES = ("jpg", "jpeg", "png", "webp", "bmp")
IMAGE_COLUMNS = "path string, length long, modificationTime timestamp"


def images(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """All images below a folder, in the order of their paths' parts: path, length, and `ord`; bytes only if asked for.

    A missing folder is an error; roots() skips it.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.*").load(folder)
    found = found.where(F.lower(F.regexp_extract("path", r"\.([^./\\]+)$", 1)).isin(*IMAGES))
    return found.select("path", "length", *(["content"] if content else [])).orderBy(path_order(F.col("path")))


def roots(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Images of several folders with their source's name and number; missing folders are skipped."""
    out = None
    for i, (source, folder) in enumerate(folders.items()):
        if exists(spark, folder):
            part = images(spark, folder).select("path", "length", F.lit(source).alias("source"), F.lit(i).alias("source_ord"))
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "path string, length long, source string, source_ord int")


def buckets(spark: SparkSession, folder: str, names: tuple[str, ...] = ("detail", "anchor", "bg")) -> DataFrame:
    return roots(spark, {n: f"{folder}/{n}" for n in names}).withColumnRenamed("source", "bucket")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table of text columns, empty cells being ''; a missing one has no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "path string")
    return spark.read.csv(path, header=True, multiLine=True, escape='"').na.fill("")


def of_size(listing: DataFrame, size: int) -> DataFrame:
    """Files of exactly that many bytes: a check of downloads."""
    return listing.where(F.col("length") == size)
