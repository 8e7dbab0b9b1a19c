"""Web pages, benchmark passages and conversations, and the vocabulary's schema."""

from pyspark.sql import functions as F

from .caption_queries import VOCAB
from .registry import query, table

#: Words in a row that a document must share with a benchmark item to be counted as containing a part of it.
GRAM = 8

TAGS = "(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->|<[^>]*>"


@query(f"""SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
  array_to_string(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1)).list_sort(), ' ') AS links,
  trim(regexp_replace(regexp_replace(html, '{TAGS}', ' ', 'g'), '[\\x20\\t-\\r]+', ' ', 'g')) AS body FROM pages""")
def page_text_extract(spark, sf):
    """Host, title, links and the text between tags."""
    html = F.col("html")
    return table(spark, sf, "pages").select(
        "page_id",
        F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#:]+)", 1)).alias("host"),
        F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1)))), " ").alias("links"),
        F.trim(F.regexp_replace(F.regexp_replace(html, TAGS, " "), r"[\x20\t-\r]+", " ")).alias("body"),
    )


def grams(df, key):
    """(key, gram): the distinct runs of GRAM words of each text, in lower case."""
    words = F.split(F.lower("text"), " ")
    starts = F.when(F.size("w") >= GRAM, F.sequence(F.lit(1), F.size("w") - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    found = F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(F.col("w"), i, F.lit(GRAM)), " ")))
    return df.select(key, words.alias("w")).select(key, F.explode(found).alias("gram"))


SPLIT_GRAMS = "SELECT DISTINCT {key}, array_to_string(w[i : i + {last}], ' ') AS gram FROM (SELECT {key}, w, unnest(range(1, len(w) - {last} + 1)) AS i FROM (SELECT {key}, string_split(lower(text), ' ') AS w FROM {table}))"


@query(f"""SELECT d.doc_id, b.item_id, count(*) AS shared FROM ({SPLIT_GRAMS.format(key='doc_id', last=GRAM - 1, table='documents')}) d
JOIN ({SPLIT_GRAMS.format(key='item_id', last=GRAM - 1, table='benchmark')}) b ON d.gram = b.gram GROUP BY ALL""")
def contamination_join(spark, sf):
    """How many runs of words a document shares with a benchmark item.

    The benchmark's distinct runs decide which of the documents' go on: a Bloom filter of them drops the others as they are made,
    where Spark finds it worthwhile, and a run is joined by its hash and text.
    """
    items = grams(table(spark, sf, "benchmark"), "item_id")
    return grams(table(spark, sf, "documents"), "doc_id").join(items, "gram").groupBy("doc_id", "item_id").agg(F.count("*").alias("shared"))


@query("""SELECT conv_id, count(*) AS turns, bool_or(role = 'system') AS has_system, string_agg('<' || role || '> ' || text, chr(10) ORDER BY turn) AS chat,
  list_sum([CASE WHEN r = 'assistant' THEN 1 ELSE 0 END FOR r IN list(role ORDER BY turn)])::BIGINT AS answers, last(role ORDER BY turn) = 'assistant' AS complete FROM conversations GROUP BY conv_id""")
def conversation_assemble(spark, sf):
    """Turns in their order as one text, and whether it ends with an answer."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    lines = F.transform("t", lambda t: F.concat(F.lit("<"), t["role"], F.lit("> "), t["text"]))
    return c.select(
        "conv_id",
        F.size("t").cast("long").alias("turns"),
        F.exists("t", lambda t: t["role"] == "system").alias("has_system"),
        F.array_join(lines, "\n").alias("chat"),
        F.size(F.filter("t", lambda t: t["role"] == "assistant")).cast("long").alias("answers"),
        (F.element_at("t", -1)["role"] == "assistant").alias("complete"),
    )


@query("""SELECT * FROM (VALUES ('event', 'string', 'view,click,purchase', true), ('rating', 'string', 'low,high', true), ('tags', 'array', 'view,error,sale,other', false),
  ('has_watermark', 'boolean', '', false), ('description', 'string', '', false)) v(slot, kind, allowed, required)""")
def response_schema(spark, sf):
    """What a model is asked to answer by, one row a slot, from the vocabulary."""
    schema = VOCAB.json_schema()
    rows = [(k, v["type"], ",".join(v.get("enum") or v.get("items", {}).get("enum") or []), k in schema["required"]) for k, v in schema["properties"].items()]
    return spark.createDataFrame(rows, "slot string, kind string, allowed string, required boolean")


@query("""SELECT page_id, 'Describe it. Tags: ' || CASE WHEN page_id % 4 = 0 THEN '' ELSE regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) END AS prompt FROM pages""")
def prompts(spark, sf):
    from loam.functions.captions import prompt

    tags = F.when(F.col("page_id") % 4 != 0, F.regexp_extract("url", r"^[a-z]+://([^/?#:]+)", 1))
    return table(spark, sf, "pages").select("page_id", prompt("Describe it. Tags: ", tags).alias("prompt"))
