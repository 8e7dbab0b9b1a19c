"""Labels, annotations and captions."""

from pyspark.sql import functions as F

from loam.functions import captions, text
from loam.functions.geometry import resolution_tag
from loam.functions.models import class_of

from .registry import query, table

PRIORITIES = {"URGENT": "now", "HIGH": "soon", "NOT": "unset", "NOT SPECIFIED": "none"}
VOCAB = captions.Vocabulary(
    values={"event": ("view", "click", "purchase"), "rating": ("low", "high"), "tags": ("view", "error", "sale", "other")},
    arrays=("tags",),
    required=("event", "rating"),
)


@query("""SELECT o_orderkey, CASE WHEN upper(o_orderpriority) LIKE '%NOT SPECIFIED%' THEN 'none' WHEN upper(o_orderpriority) LIKE '%URGENT%' THEN 'now'
  WHEN upper(o_orderpriority) LIKE '%HIGH%' THEN 'soon' WHEN upper(o_orderpriority) LIKE '%NOT%' THEN 'unset' ELSE 'later' END AS label FROM orders""")
def label_map_longest(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text.first_label(F.col("o_orderpriority"), PRIORITIES, "later").alias("label"))


@query("""SELECT doc_id, trim(regexp_replace(trim(regexp_replace(chr(9) || replace(text, '. ', '.  ' || chr(10)) || '.. .', '\\s+', ' ', 'g')), '\\.+$', '')) AS clean FROM documents""")
def clean_text(spark, sf):
    """Texts with white space doubled and full stops added."""
    raw = F.concat(F.lit("\t"), F.regexp_replace("text", r"\. ", ".  \n"), F.lit(".. ."))
    return table(spark, sf, "documents").select("doc_id", text.clean_text(raw).alias("clean"))


@query("""SELECT page_id, CASE lower(regexp_extract(name, '(\\.[^.]+)$', 1)) WHEN '.png' THEN 'image/png' WHEN '.webp' THEN 'image/webp' WHEN '.gif' THEN 'image/gif' ELSE 'image/jpeg' END AS mime
FROM (SELECT page_id, 'f' || page_id || (['.jpg', '.PNG', '.webp', '.gif', ''])[page_id % 5 + 1] AS name FROM pages)""")
def mime_types(spark, sf):
    endings = F.array(*[F.lit(e) for e in (".jpg", ".PNG", ".webp", ".gif", "")])
    name = F.concat(F.lit("f"), F.col("page_id").cast("string"), F.get(endings, (F.col("page_id") % 5).cast("int")))
    known = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp", ".gif": "image/gif"}
    return table(spark, sf, "pages").select("page_id", text.mime_type(name, known).alias("mime"))


@query("SELECT c_custkey, CASE WHEN length(s) > 8 THEN s[1:4] || '...' || s[-4:] || ' (len ' || length(s) || ')' ELSE '(len ' || length(s) || ')' END AS masked FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment[1:5] ELSE c_mktsegment END AS s FROM customer)")
def masked_values(spark, sf):
    """Of short values only the length is shown."""
    value = F.when(F.col("c_custkey") % 3 == 0, F.substring("c_mktsegment", 1, 5)).otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", text.masked(value).alias("masked"))


def raw_responses(spark, sf):
    """A response as a model might give it: values out of the vocabulary, lists that are too long, text to be cleaned."""
    e = table(spark, sf, "events")
    raw = F.to_json(F.struct(F.col("event_type").alias("event"), F.when(F.col("event_id") % 3 == 0, "high").when(F.col("event_id") % 3 == 1, "x").alias("rating"), F.array(F.col("event_type"), F.lit("bogus"), F.lit("sale"), F.lit("other")).alias("tags"), (F.col("event_id") % 4 == 0).alias("has_watermark"), F.concat(F.lit("  seen\n "), F.col("event_type"), F.lit("..")).alias("description")))
    raw = F.when(F.col("event_id") % 17 == 0, "not json").otherwise(raw)
    return e.select("event_id", captions.coerce(raw, VOCAB).alias("r"))


COERCED = """SELECT event_id, broken, CASE WHEN NOT broken AND event_type IN ('view', 'click', 'purchase') THEN event_type ELSE '' END AS event,
  CASE WHEN NOT broken AND event_id % 3 = 0 THEN 'high' ELSE '' END AS rating,
  CASE WHEN broken THEN '' WHEN event_type IN ('view', 'error') THEN event_type || ', sale' ELSE 'sale, other' END AS tags,
  NOT broken AND event_id % 4 = 0 AS has_watermark, CASE WHEN broken THEN '' ELSE 'seen ' || event_type END AS nl
FROM (SELECT *, event_id % 17 = 0 AS broken FROM events)"""


@query(f"SELECT event_id, event, rating, tags, has_watermark, nl FROM ({COERCED})")
def coerce_json(spark, sf):
    r = raw_responses(spark, sf)
    return r.select("event_id", "r.event", "r.rating", F.array_join("r.tags", ", ").alias("tags"), "r.has_watermark", "r.nl")


@query(f"""SELECT event_id, concat_ws(', ', nullif(event, ''), CASE WHEN event_id % 3000 >= 2048 THEN 'absurdres' WHEN event_id % 3000 >= 1024 THEN 'highres' END, nullif(tags, ''),
  CASE WHEN rating = '' THEN 'low' ELSE rating END, CASE WHEN event_id % 2 = 0 THEN 'tag a, tag b' END, CASE WHEN has_watermark THEN 'watermark' END, nullif(nl, '')) AS caption
FROM ({COERCED})""")
def assemble_caption(spark, sf):
    size = F.col("event_id") % 3000
    tags = F.when(F.col("event_id") % 2 == 0, "tag a, tag b").otherwise("")
    caption = captions.assemble(F.col("r"), ("event", "_resolution", "tags", "_rating"), VOCAB, tags, resolution_tag(size, size), F.lit("low"))
    return raw_responses(spark, sf).select("event_id", caption.alias("caption"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, CASE WHEN CAST(json_extract(props, '$.k') AS INT) < 30 THEN 'person' WHEN event_type IN ('view', 'click') THEN 'bg' ELSE '' END AS class FROM events""")
def detection_class(spark, sf):
    """A person wins over a background."""
    k = F.from_json("props", "k int")["k"]
    labels = F.array(F.when(k < 30, "person").otherwise("none"), F.col("event_type"))
    return table(spark, sf, "events").select("event_id", k.alias("k"), class_of(labels, {"person": ["person"], "bg": ["view", "click"]}).alias("class"))


@query("SELECT l_orderkey, l_linenumber, l_quantity AS quantity, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_quantity >= 10")
def explode_detections(spark, sf):
    """Detections nested by image, exploded and met with their image's metadata."""
    found = table(spark, sf, "lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").alias("quantity"))).alias("found"))
    images = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return found.join(images, "l_orderkey").select("l_orderkey", "o_orderstatus", F.explode("found").alias("d")).select("l_orderkey", "d.*", "o_orderstatus").where("quantity >= 10")
