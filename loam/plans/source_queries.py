"""What comes from sources and models: pages that end, several sources as one, scores by name, attached results."""

from pyspark.sql import functions as F

from loam.functions import models, text
from loam.operators import report
from loam.sources import landing

from .registry import query, table

#: Pages of landed results, made of orders: a page for each customer and day's order, most of them followed by another.
PAGES_SQL = """SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page, o_orderkey, o_orderkey % 11 = 0 AS none,
  CASE WHEN o_orderkey % 7 <> 0 THEN 't' END AS next_token, (CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END) AS fits FROM orders"""


@query(f"""WITH p AS ({PAGES_SQL}), m AS (SELECT *, coalesce(max(CASE WHEN none OR next_token IS NULL THEN 1 ELSE 0 END) OVER w, 0) AS over, coalesce(sum(fits) OVER w, 0) AS saved FROM p
  WINDOW w AS (PARTITION BY o_custkey ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_custkey, page, o_orderkey FROM m WHERE over = 0 AND saved < 6 AND NOT none""")
def pages_until_end(spark, sf):
    """Each handle's pages up to its first empty or last one, while fewer than six items are saved."""
    from pyspark.sql import Window

    k = F.col("o_orderkey")
    item = F.struct(F.lit("k").alias("media_key"), F.lit("photo").alias("type"), F.lit("u").alias("url"), F.lit(1600).alias("width"), F.lit(1600).alias("height"))
    small = F.struct(F.lit("s").alias("media_key"), F.lit("photo").alias("type"), F.lit("u").alias("url"), F.lit(1600).alias("width"), F.lit(900).alias("height"))
    found = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("handle"),
        F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("page"),
        "o_orderkey",
        F.when(k % 11 == 0, F.array().cast("array<string>")).otherwise(F.array(k.cast("string"))).alias("data"),
        F.when(k % 3 == 0, F.array(item, small, item)).otherwise(F.array(small, item)).alias("media"),
        F.when(k % 7 != 0, "t").alias("next_token"),
    )
    return landing.walked(found, 1536, 6).select(F.col("handle").alias("o_custkey"), "page", "o_orderkey")


@query("""SELECT name, source, source_ord FROM (SELECT c_name AS name, 'customer' AS source, 0 AS source_ord FROM customer UNION ALL SELECT 'Supplier ' || s_suppkey, 'supplier', 1 FROM supplier
  UNION ALL SELECT n_name, 'nation', 2 FROM nation)""")
def sources_as_one(spark, sf):
    """Rows of several sources, each with its source's name and number, in their declared order."""
    parts = {"customer": F.col("c_name"), "supplier": F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string")), "nation": F.col("n_name")}
    rows = [table(spark, sf, s).select(name.alias("name"), F.lit(s).alias("source"), F.lit(i).alias("source_ord")) for i, (s, name) in enumerate(parts.items())]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


SCORES_SQL = "SELECT event_id, event_id * 7 % 100 / 100.0::DOUBLE AS a, event_id * 13 % 100 / 100.0::DOUBLE AS b, value / 100::DOUBLE AS c FROM events"


def scores(spark, sf):
    i = F.col("event_id")
    found = F.create_map(F.lit("tag a"), (i * 7 % 100) / 100.0, F.lit("tag b"), (i * 13 % 100) / 100.0, F.lit("tag c"), F.col("value") / 100)
    return table(spark, sf, "events").select("event_id", found.alias("scores"))


@query(f"""SELECT event_id, coalesce(string_agg(tag, ', ' ORDER BY score DESC, tag) FILTER (score >= 0.5), '') AS tags, first(tag ORDER BY score DESC, tag) AS best
FROM (SELECT event_id, unnest(['tag a', 'tag b', 'tag c']) AS tag, unnest([a, b, c]) AS score FROM ({SCORES_SQL})) GROUP BY event_id""")
def scored_tags(spark, sf):
    """Tags by a threshold, best first, and the best one, of a model's scores by name."""
    return scores(spark, sf).select("event_id", models.tags_above(F.col("scores"), 0.5).alias("tags"), models.best_label(F.col("scores")).alias("best"))


@query("""SELECT d.doc_id, d.source, l.quality, p.url, CASE WHEN l.toxic = 1 THEN 'explicit' ELSE 'general' END AS rating FROM documents d JOIN labels l ON d.doc_id = l.doc_id JOIN pages p ON d.doc_id = p.page_id""")
def attach_results(spark, sf):
    """Tags, ratings and metadata met by their key: only what all three know goes on."""
    labels = table(spark, sf, "labels").select("doc_id", "quality", F.when(F.col("toxic") == 1, "UNSAFE").otherwise("SAFE").alias("label"))
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url")
    rating = text.first_label(F.col("label"), {"SAFE": "general", "UNSAFE": "explicit"}, "general")
    return table(spark, sf, "documents").select("doc_id", "source").join(labels, "doc_id").join(pages, "doc_id").select("doc_id", "source", "quality", "url", rating.alias("rating"))


@query("SELECT event_type, count(*) AS posts, count(*) FILTER (event_id % 3 = 0) AS media, round(count(*) * 0.005::DOUBLE + count(*) FILTER (event_id % 3 = 0) * 0.005::DOUBLE, 6) AS cost FROM events GROUP BY event_type")
def fetch_cost(spark, sf):
    """What a paid fetch of each kind would cost."""
    n = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("posts"), F.count_if(F.col("event_id") % 3 == 0).alias("media"))
    return n.select("event_type", "posts", "media", F.round(report.read_cost(F.col("posts"), F.col("media")), 6).alias("cost"))


@query("SELECT page_id, length(html) AS length FROM pages WHERE length(html) = (SELECT length(html) FROM pages WHERE page_id = 7)")
def exact_size(spark, sf):
    """Files of exactly the size that is expected: a check of downloads."""
    from loam.sources.files import of_size

    listing = table(spark, sf, "pages").select("page_id", F.length("html").alias("length"))
    return of_size(listing, listing.where("page_id = 7").first()["length"])
