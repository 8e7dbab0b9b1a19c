"""Gates, manifests and curation, over the star schema's and the documents' tables."""

from pyspark.sql import functions as F

from loam.config import Gates
from loam.functions import arrays, geometry, text
from loam.operators import gates, manifest, report
from loam.sources import landing

from .registry import query, table

BLANK = r"^\s*$"
#: Of the stand-in gates on documents: least characters, and least distinct words in ten.
LEAST_CHARS, LEAST_DISTINCT = 200, 3


def gated(spark, sf):
    """Documents with the reason that drops them. No document is blank, so each 31st one stands for an unreadable item."""
    blank = F.col("doc_id") % 31
    docs = table(spark, sf, "documents").withColumn("text", F.when(blank == 0, None).when(blank == 1, F.lit(" \t")).otherwise(F.col("text")))
    words = F.split("text", " ")
    few = F.size(F.array_distinct(words)) * 10 < F.size(words) * LEAST_DISTINCT
    return docs.withColumn("drop_reason", gates.drop_reason(F.col("text").isNull() | F.col("text").rlike(BLANK), F.col("n_chars") < LEAST_CHARS, few))


GATED = f"""
SELECT *, CASE WHEN text IS NULL OR regexp_full_match(text, '\\s*') THEN 'corrupt' WHEN n_chars < {LEAST_CHARS} THEN 'too_small'
  WHEN len(list_distinct(string_split(text, ' '))) * 10 < len(string_split(text, ' ')) * {LEAST_DISTINCT} THEN 'blurry' ELSE '' END AS drop_reason
FROM (SELECT * REPLACE (CASE doc_id % 31 WHEN 0 THEN NULL WHEN 1 THEN ' \t' ELSE text END AS text) FROM documents)"""


@query(f"SELECT doc_id, drop_reason FROM ({GATED})")
def gate_drop_reason(spark, sf):
    return gated(spark, sf).select("doc_id", "drop_reason")


@query(f"SELECT drop_reason, count(*) AS n FROM ({GATED}) GROUP BY drop_reason")
def drop_reason_counts(spark, sf):
    return report.counts(gated(spark, sf), "drop_reason")


@query(f"SELECT count(*) FILTER (drop_reason = '') AS kept, count(*) FILTER (drop_reason <> '') AS dropped FROM ({GATED})")
def kept_and_dropped(spark, sf):
    return report.kept_and_dropped(gated(spark, sf))


@query("""SELECT doc_id, n_copies FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS n_copies,
  row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn = 1""")
def exact_dedup_keep_best(spark, sf):
    docs = table(spark, sf, "documents")
    best = F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id")))
    return docs.groupBy(F.sha2("text", 256).alias("digest")).agg(best.alias("doc_id"), F.count("*").alias("n_copies")).select("doc_id", "n_copies")


@query(f"""WITH g AS ({GATED}), d AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM g WHERE drop_reason = '')
SELECT doc_id, drop_reason FROM g WHERE drop_reason <> '' UNION ALL SELECT doc_id, CASE WHEN rn > 1 THEN 'duplicate' ELSE '' END FROM d""")
def gates_then_duplicates(spark, sf):
    """Duplicates are sought among what the gates keep."""
    rows = gated(spark, sf).select("doc_id", F.when(F.col("drop_reason") == "", F.sha2("text", 256)).alias("digest"), "drop_reason")
    return gates.with_duplicates(rows, "digest", "doc_id").select("doc_id", "drop_reason")


@query("""SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NOT NULL THEN 'labelled' ELSE d.source END AS source, CAST(l.quality AS VARCHAR) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def manifest_augment(spark, sf):
    updates = table(spark, sf, "labels").select("doc_id", F.lit("labelled").alias("source"), F.col("quality").cast("string").alias("quality"))
    return manifest.augment(table(spark, sf, "documents").select("doc_id", "lang", "source"), updates, "doc_id")


@query("SELECT l.doc_id FROM labels l ANTI JOIN (SELECT doc_id FROM documents WHERE lang = 'en') d ON l.doc_id = d.doc_id")
def manifest_unmatched(spark, sf):
    return manifest.unmatched(table(spark, sf, "documents").where("lang = 'en'"), table(spark, sf, "labels").select("doc_id"), "doc_id")


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN drop_reason = '' THEN CAST(n_chars AS VARCHAR) ELSE '' END AS n_chars,
  drop_reason, CASE WHEN drop_reason = '' THEN '' ELSE 'True' END AS dropped FROM ({GATED})""")
def manifest_union(spark, sf):
    good, bad = gates.split_kept(gated(spark, sf))
    return manifest.union(good.select("doc_id", "n_chars", "drop_reason"), bad.select("doc_id", "drop_reason", F.lit("True").alias("dropped")), export=True)


@query("""WITH m AS (SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'True' WHEN l.toxic = 0 THEN 'False' END AS dropped,
  CASE WHEN d.doc_id % 7 <> 0 THEN d.lang ELSE '' END AS caption,
  CASE WHEN d.doc_id % 11 = 0 THEN 'x' WHEN d.doc_id % 13 = 0 THEN NULL ELSE CAST(d.n_chars AS VARCHAR) END AS width,
  CAST(d.n_chars + 100 AS VARCHAR) AS height, CASE WHEN d.doc_id % 5 = 0 THEN 'nan' ELSE CAST(d.n_chars / 10 AS VARCHAR) END AS blur_var
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id FROM m WHERE dropped = 'False' AND caption <> '' AND try_cast(width AS INT) >= 1024 AND try_cast(height AS INT) >= 1024
  AND blur_var <> 'nan' AND try_cast(blur_var AS DOUBLE) >= 150""")
def curate(spark, sf):
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    n, i = F.col("n_chars"), F.col("doc_id")
    m = d.join(l, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("toxic") == 1, "True").when(F.col("toxic") == 0, "False").alias("dropped"),
        F.when(i % 7 != 0, F.col("lang")).otherwise("").alias("caption"),
        F.when(i % 11 == 0, "x").when(i % 13 == 0, None).otherwise(n.cast("string")).alias("width"),
        (n + 100).cast("string").alias("height"),
        F.when(i % 5 == 0, "nan").otherwise((n / 10).cast("string")).alias("blur_var"),
    )
    return gates.curate(m, 1024, 150).select("doc_id")


@query("SELECT d.doc_id FROM documents d ANTI JOIN (SELECT doc_id FROM labels WHERE quality = 1) l ON d.doc_id = l.doc_id")
def cache_worklist(spark, sf):
    """What no stored success covers: unlabelled documents, and those whose stored result was a failure."""
    return manifest.worklist(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").where("quality = 1"), "doc_id")


@query("SELECT p.page_id, l.quality AS cached FROM pages p LEFT JOIN labels l ON p.page_id = l.doc_id")
def cache_hits(spark, sf):
    cache = table(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("cached"))
    return manifest.with_results(table(spark, sf, "pages").select("page_id"), cache, cache.limit(0), "page_id")


@query("SELECT d.doc_id FROM documents d SEMI JOIN labels l ON d.doc_id = l.doc_id")
def exists_semi(spark, sf):
    return manifest.present(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


@query("""SELECT count(DISTINCT d.doc_id) AS n_left, count(DISTINCT l.doc_id) AS n_right,
  count(DISTINCT CASE WHEN d.doc_id = l.doc_id THEN d.doc_id END) AS n_both,
  count(DISTINCT d.doc_id) = count(DISTINCT l.doc_id) AS ok FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def pair_integrity(spark, sf):
    return report.pair_integrity(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


BLOCKED = ("the that", "anly", "ou", "reading", "Thing_er")


@query(f"""WITH t AS (SELECT doc_id, list_sort(list_distinct([trim(regexp_replace(lower(replace(x, '_', ' ')), '^\\s+|\\s+$', '', 'g'))
  FOR x IN string_split(text, ',')])) AS tokens FROM documents)
SELECT doc_id, array_to_string([x FOR x IN tokens IF x IN {tuple(b.lower().replace('_', ' ') for b in BLOCKED)}], ',') AS hits FROM t""")
def token_block(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(text.block_hits(F.col("text"), BLOCKED), ",").alias("hits"))


@query("""SELECT p_partkey, CASE WHEN bad THEN 'undecodable' WHEN coalesce(w, 0) < 1536 OR coalesce(h, 0) < 1536 THEN 'too_small' WHEN coalesce(sharp, 0) < 100 THEN 'blurry'
  WHEN tiles IS NULL OR len(tiles) = 0 OR len([x FOR x IN tiles IF x >= 100]) / len(tiles) < 0.5 THEN 'flat_background' ELSE '' END AS drop_reason
FROM (SELECT p_partkey, p_partkey % 13 = 0 AS bad, CASE WHEN p_partkey % 17 <> 0 THEN 1400 + p_partkey % 1000 END AS w, 1500 + p_partkey % 777 AS h,
  CASE WHEN p_partkey % 19 <> 0 THEN p_size * 10.0 END AS sharp,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN [] WHEN 2 THEN [100.0, 1.0] WHEN 3 THEN [99.9, 200.0, 1.0] ELSE [p_size * 8.0, p_size * 4.0, 300.0, 20.0] END AS tiles FROM part)""")
def gate_chain(spark, sf):
    """Size, sharpness and tiles, in the order of their cost; an item without tiles has failed to show any sharp one."""
    k, size = F.col("p_partkey"), F.col("p_size")
    tiles = F.when(k % 6 == 0, None).when(k % 6 == 1, F.array().cast("array<double>")).when(k % 6 == 2, F.array(F.lit(100.0), F.lit(1.0))).when(k % 6 == 3, F.array(F.lit(99.9), F.lit(200.0), F.lit(1.0)))
    items = table(spark, sf, "part").select(
        "p_partkey",
        (k % 13 == 0).alias("corrupt"),
        F.when(k % 17 != 0, 1400 + k % 1000).alias("width"),
        (1500 + k % 777).alias("height"),
        F.when(k % 19 != 0, size * 10.0).alias("sharpness"),
        tiles.otherwise(F.array(size * 8.0, size * 4.0, F.lit(300.0), F.lit(20.0))).alias("tiles"),
    )
    reason = gates.chain(items, Gates(min_size=1536))
    return items.select("p_partkey", F.when(reason == "corrupt", "undecodable").otherwise(reason).alias("drop_reason"))


@query("""SELECT l_orderkey, round(share, 6) AS share, share > 0.1 AS flag FROM (SELECT l_orderkey, least(sum(l_quantity * l_discount) / 100, 1) AS share FROM lineitem GROUP BY l_orderkey
  UNION ALL SELECT -1, NULL)""".replace("share > 0.1 AS flag", "coalesce(share > 0.1, false) AS flag"))
def text_overlay_flag(spark, sf):
    """A flag on what stays; without a measurement there is none. Sums of doubles depend on their order in the last bits, which
    decide at the limit itself: there, lines are added in the order of their files, as the SQL does on one thread."""
    limit = Gates().text_share
    lines = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_quantity") * F.col("l_discount")).alias("x"), F.struct("_metadata.file_path", "_metadata.row_index").alias("at"))
    sums = lines.groupBy("l_orderkey").agg(F.sum("x").alias("total"))
    close = F.coalesce(F.abs(F.col("total") / 100 - limit) < 1e-9, F.lit(False))
    near = lines.join(sums.where(close).select(F.col("l_orderkey").alias("_k")), F.col("l_orderkey").eqNullSafe(F.col("_k")), "left_semi").where("x is not null")
    in_order = F.aggregate(F.sort_array(F.collect_list(F.struct("at", "x"))), F.lit(0.0), lambda a, line: a + line["x"])
    sums = sums.where(~close).unionByName(near.groupBy("l_orderkey").agg(in_order.alias("total")))
    share = sums.select("l_orderkey", F.least(F.col("total") / 100, F.lit(1.0)).alias("share"))
    share = share.unionByName(spark.createDataFrame([(-1, None)], "l_orderkey long, share double"))
    return share.select("l_orderkey", F.round("share", 6).alias("share"), gates.text_flag(F.col("share"), limit).alias("flag"))


#: Landed pages of results, made of orders: a media item for each, of several kinds and sizes, some without a key.
MEDIA_SQL = """SELECT o_orderkey, 'u' || o_custkey % 50 AS handle, CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE 'k' || o_orderkey // 2 END AS media_key, CASE WHEN o_orderkey % 5 = 0 THEN 'video' ELSE 'photo' END AS type,
  CASE WHEN o_orderkey % 29 <> 0 THEN 'https://h/' || o_orderkey // 2 END AS url, CASE WHEN o_orderkey % 31 <> 0 THEN 1200 + o_orderkey % 900 END AS width, 1400 + o_custkey % 500 AS height FROM orders"""


def landed_media(spark, sf):
    k = F.col("o_orderkey")
    media = F.struct(
        F.when(k % 23 == 0, "").otherwise(F.concat(F.lit("k"), F.floor(k / 2).cast("string"))).alias("media_key"),
        F.when(k % 5 == 0, "video").otherwise("photo").alias("type"),
        F.when(k % 29 != 0, F.concat(F.lit("https://h/"), F.floor(k / 2).cast("string"))).alias("url"),
        F.when(k % 31 != 0, (1200 + k % 900).cast("int")).alias("width"),
        (1400 + F.col("o_custkey") % 500).cast("int").alias("height"),
    )
    handle = F.concat(F.lit("u"), (F.col("o_custkey") % 50).cast("string"))
    return table(spark, sf, "orders").select(handle.alias("handle"), F.array(media).alias("media"))


FITS = "least(coalesce(width, 0), coalesce(height, 0)) >= 1536"


@query(f"""SELECT DISTINCT media_key FROM ({MEDIA_SQL}) WHERE {FITS} AND type = 'photo' AND media_key <> '' AND url <> '' AND media_key NOT IN (SELECT 'k' || doc_id FROM labels)""")
def media_to_fetch(spark, sf):
    """What of the landed pages is worth fetching and hasn't been fetched."""
    done = table(spark, sf, "labels").select(F.concat(F.lit("k"), F.col("doc_id").cast("string")).alias("media_key"))
    return landing.media(landed_media(spark, sf), 1536, done).select("media_key")


@query(f"SELECT count(*) AS scanned, count(*) FILTER (NOT {FITS}) AS too_small, count(*) FILTER ({FITS} AND type = 'photo') AS saved FROM ({MEDIA_SQL})")
def fetch_counters(spark, sf):
    return landing.figures(landed_media(spark, sf), 1536)


@query("SELECT DISTINCT 'u' || o_custkey % 50 AS handle, n_nationkey AS user_id FROM orders LEFT JOIN nation ON 'u' || n_nationkey = 'u' || o_custkey % 50")
def resolve_users(spark, sf):
    """Every handle with its user's id; those that can't be resolved are skipped alone, here with a null id."""
    users = table(spark, sf, "nation").select(F.concat(F.lit("u"), F.col("n_nationkey").cast("string")).alias("handle"), F.col("n_nationkey").alias("user_id"))
    known, lost = landing.resolved(landed_media(spark, sf).select("handle").distinct(), users)
    return known.unionByName(lost, allowMissingColumns=True)


@query("""SELECT page_id, width, height, bytes, width IS NULL AS corrupt FROM (SELECT page_id, length(html) AS bytes,
  CASE WHEN page_id % 4 <> 3 THEN page_id * 7 % 4000 + 1 END AS width, CASE WHEN page_id % 4 <> 3 THEN page_id * 11 % 3000 + 1 END AS height FROM pages)""".replace("bytes, width IS NULL", "width IS NULL").replace("length(html) AS bytes,", ""))
def header_sizes(spark, sf):
    """Sizes read from the headers of made-up files; a header of no known kind is a corrupt file."""
    from loam.sources import pixels

    be = lambda c, n: F.unhex(F.lpad(F.hex(c), 2 * n, "0"))
    le = lambda c, n: F.concat(*[be(F.call_function("shiftright", c, F.lit(8 * i)).bitwiseAND(F.lit(255)), 1) for i in range(n)])
    w, h, k = (F.col("page_id") * 7) % 4000 + 1, (F.col("page_id") * 11) % 3000 + 1, F.col("page_id") % 4
    raw = lambda b: F.lit(bytearray(b))
    png = F.concat(raw(b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR"), be(w, 4), be(h, 4))
    bmp = F.concat(raw(b"BM" + bytes(16)), le(w, 4), le(h, 4))
    jpeg = F.concat(raw(b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x0b\x08"), be(h, 2), be(w, 2))
    files = table(spark, sf, "pages").select("page_id", F.when(k == 0, png).when(k == 1, bmp).when(k == 2, jpeg).otherwise(raw(b"no image")).alias("content"))
    return pixels.with_sizes(files).select("page_id", "width", "height", "corrupt")


@query(f"""SELECT vec_id, CASE WHEN score >= 0.2 THEN 'good' WHEN score >= 0 THEN 'medium' ELSE 'bad' END AS bucket
FROM (SELECT vec_id, list_sum([embedding[i]::DOUBLE * (i % 3 - 1) FOR i IN range(1, 65)]) / sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])) + 0.05 AS score FROM embeddings)""")
def score_buckets(spark, sf):
    """A linear score of normalised vectors, in buckets."""
    from loam.functions import models

    score = models.linear_score(F.col("embedding"), [float(i % 3 - 1) for i in range(1, 65)], 0.05)
    return table(spark, sf, "embeddings").select("vec_id", models.score_bucket(score, 0.2, 0.0).alias("bucket"))


@query("""SELECT day, total, coalesce(sum(worse) OVER (ORDER BY day ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) >= 2, false) AS stop FROM (SELECT day, total,
  CASE WHEN lag(total) OVER (ORDER BY day) - total <= 0 THEN 1 ELSE 0 END AS worse FROM (SELECT dayofyear(ts) AS day, sum(floor(value * 100 + 0.5))::BIGINT AS total FROM events GROUP BY 1))""")
def flat_epochs(spark, sf):
    """Where the daily sum hasn't fallen for two days in a row."""
    from .stages import flat_epochs as flat

    days = table(spark, sf, "events").groupBy(F.dayofyear("ts").alias("epoch")).agg(F.sum(F.floor(F.col("value") * 100 + 0.5).cast("long")).alias("loss"))
    return flat(days).select(F.col("epoch").alias("day"), F.col("loss").alias("total"), "stop")


@query("""SELECT doc_id, row_number() OVER (ORDER BY CASE WHEN drop_reason = '' THEN 2 WHEN drop_reason = 'duplicate' THEN 1 ELSE 0 END, doc_id) - 1 AS emitted, drop_reason FROM (
  SELECT doc_id, CASE WHEN short THEN 'too_small' WHEN row_number() OVER (PARTITION BY short, text ORDER BY doc_id) > 1 THEN 'duplicate' ELSE '' END AS drop_reason
  FROM (SELECT doc_id, text, n_chars < 400 AS short FROM documents))""")
def emission_order(spark, sf):
    """A manifest's rows in the order in which they are written: what gates drop, then duplicates, then what stays."""
    from loam.operators.ordered import emission

    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") >= 400, F.sha2("text", 256)).alias("digest"), F.when(F.col("n_chars") < 400, "too_small").otherwise("").alias("drop_reason"))
    return emission(gates.with_duplicates(docs, "digest", "doc_id"), "drop_reason", ["doc_id"]).select("doc_id", "emitted", "drop_reason")
