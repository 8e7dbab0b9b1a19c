"""Counts, shares, percentiles, budgets and names."""

from pyspark.sql import functions as F

from loam.operators import ordered, report

from .registry import query, table

TARGET, TOLERANCE = {"en": 0.60, "fr": 0.35, "xx": 0.05}, 0.10
PAGE, BUDGET = "date", 2500
QS = [0.05, 0.33, 0.5, 0.95]
SHARES = f"""SELECT ord, t.bucket, coalesce(n, 0) AS n, target, coalesce(n, 0) / greatest(total, 1) AS share, abs(coalesce(n, 0) / greatest(total, 1) - target) <= {TOLERANCE} AS ok
FROM (VALUES {', '.join(f"({i}, '{k}', {v}::DOUBLE)" for i, (k, v) in enumerate(TARGET.items()))}) t(ord, bucket, target)
LEFT JOIN (SELECT lang AS bucket, count(*) AS n FROM documents GROUP BY lang) f ON t.bucket = f.bucket CROSS JOIN (SELECT count(*) AS total FROM documents)"""


@query(SHARES)
def ratio_check(spark, sf):
    return report.shares(table(spark, sf, "documents"), "lang", TARGET, TOLERANCE)


@query(f"SELECT coalesce(bool_and(ok), true) AS ok, min_by(bucket, ord) FILTER (NOT ok) AS bucket FROM ({SHARES})")
def ratio_first_failure(spark, sf):
    return report.first_failure(report.shares(table(spark, sf, "documents"), "lang", TARGET, TOLERANCE))


@query("SELECT source, count(*) AS n, count(*) FILTER (n_chars >= 1536) AS n_large, count(*) FILTER (lang = 'en') AS n_en FROM documents GROUP BY source")
def source_distribution(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") >= 1536).alias("n_large"), F.count_if(F.col("lang") == "en").alias("n_en"))


@query("""SELECT v.slot, v.value, coalesce(n, 0) AS n, coalesce(n, 0) < 50 AS dead FROM (VALUES ('lang', 'en'), ('lang', 'xx'), ('source', 'src0'), ('source', 'src1')) v(slot, value)
LEFT JOIN (SELECT 'lang' AS slot, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source) u ON u.slot = v.slot AND u.value = v.value""")
def vocab_population(spark, sf):
    slots = F.array(*[F.struct(F.lit(c).alias("slot"), F.col(c).alias("value")) for c in ("lang", "source")])
    values = table(spark, sf, "documents").select(F.explode(slots).alias("x")).select("x.*")
    vocab = spark.createDataFrame([("lang", "en"), ("lang", "xx"), ("source", "src0"), ("source", "src1")], "slot string, value string")
    return report.vocabulary_use(values, vocab, 50)


@query(" UNION ALL ".join(f"SELECT {q}::DOUBLE AS q, quantile_cont(n_chars::DOUBLE, {q}) AS value FROM documents" for q in QS))
def metric_percentiles(spark, sf):
    return report.percentiles(table(spark, sf, "documents"), "n_chars", QS)


@query("SELECT CASE WHEN n_chars < 0 THEN 0 WHEN n_chars >= 10000 THEN 11 ELSE n_chars // 1000 + 1 END::BIGINT AS bin, count(*) AS n FROM documents GROUP BY 1")
def metric_histogram(spark, sf):
    return report.histogram(table(spark, sf, "documents"), "n_chars", 0, 10000, 10)


@query("""SELECT count(*) FILTER (c) AS captioned, count(*) FILTER (c AND quality <> '') AS answered, count(*) FILTER (b) AS blocked, count(*) FILTER (s) AS skipped
FROM (SELECT coalesce(l.toxic, 0) = 0 AND l.doc_id IS NOT NULL AS c, coalesce(l.toxic = 1, false) AS b, l.doc_id IS NULL AS s, CASE WHEN l.quality = 1 THEN 'good' ELSE '' END AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def stage_counters(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").withColumn("has", F.lit(True)), "doc_id", "left")
    flags = d.select((F.col("has").isNotNull() & (F.coalesce("toxic", F.lit(0)) == 0)).alias("captioned"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("blocked"), F.col("has").isNull().alias("skipped"), F.when(F.col("quality") == 1, "good").otherwise("").alias("quality"))
    return report.caption_figures(flags)


@query(f"""WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY day, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS read_before FROM p)
SELECT user_id, CAST(day AS VARCHAR) AS day, n, read_before FROM r WHERE read_before < {BUDGET}""")
def budget_cutoff(spark, sf):
    pages = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return ordered.within_budget(pages, "n", ["day", "user_id"], BUDGET).select("user_id", F.col("day").cast("string").alias("day"), "n", "read_before")


@query("""WITH s AS (SELECT page_id, 'web_' || regexp_replace(regexp_extract(url, '([^/]*)/*$', 1), '(.)\\.[^.]*$', '\\1') AS name FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY page_id) - 1 AS k FROM s)
SELECT page_id, name || CASE WHEN k > 0 THEN '_' || k ELSE '' END || '.jpg' AS out_name FROM n""")
def collision_names(spark, sf):
    return ordered.output_names(table(spark, sf, "pages"), F.lit("web"), "url", ["page_id"]).select("page_id", "out_name")


@query("SELECT source, doc_id, n_chars, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 2")
def top_n_per_group(spark, sf):
    return ordered.first_of_each(table(spark, sf, "documents"), ["source"], [F.desc("n_chars"), "doc_id"], 2).select("source", "doc_id", "n_chars", "rank")


@query("""SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)/*$', 1), '(.)\\.[^.]*$', '\\1') || '.jpg' AS image_name, regexp_replace(regexp_extract(url, '([^/]*)/*$', 1), '(.)\\.[^.]*$', '\\1') || '.txt' AS caption_name FROM pages""")
def pair_names(spark, sf):
    return ordered.pair_names(table(spark, sf, "pages"), "url").select("page_id", "image_name", "caption_name")


@query("SELECT page_id, url FROM (SELECT *, row_number() OVER (ORDER BY string_split(url, '/')) AS rn FROM pages) WHERE rn <= 6")
def path_order_head(spark, sf):
    """The first six by the parts of their paths: a preview."""
    from loam.functions.text import path_order

    return table(spark, sf, "pages").orderBy(path_order(F.col("url")), "page_id").limit(6).select("page_id", "url")
