"""Metrics, hashes and clusters of embeddings as 8 x 8 grids; crops and boxes."""

from pyspark.sql import functions as F

from loam.functions import arrays, geometry
from loam.operators import cluster

from .registry import query, table

SIDE, NEAR, SHARP, SHARE = 8, 20, 0.3, 0.5


def _mirror_sql(values: str, cells: list[list[int]]) -> str:
    """DuckDB: the Laplacian's list over a rectangle of cells, by indexes that mirror at its border."""
    h, w = len(cells), len(cells[0])
    m = lambda i, n: -i if i < 0 else 2 * (n - 1) - i if i >= n else i
    rows = [[cells[m(r + a, h)][m(c + b, w)] + 1 for a, b in ((-1, 0), (1, 0), (0, -1), (0, 1))] + [cells[r][c] + 1] for r in range(h) for c in range(w)]
    return f"[{values}[k[1]]::DOUBLE + {values}[k[2]]::DOUBLE + {values}[k[3]]::DOUBLE + {values}[k[4]]::DOUBLE - 4 * {values}[k[5]]::DOUBLE FOR k IN {rows}]"


def _tiles_sql(n: int) -> str:
    return "[" + ", ".join(f"list_aggregate({_mirror_sql('embedding', t)}, 'var_pop')" for t in arrays.tile_cells(SIDE, SIDE, n)) + "]"


WHOLE = [[r * SIDE + c for c in range(SIDE)] for r in range(SIDE)]
HASHES = """SELECT vec_id, label, list_sum([CASE WHEN embedding[k + 1]::DOUBLE > m THEN (1::UBIGINT << k)::HUGEINT ELSE 0::HUGEINT END FOR k IN range(0, 64)])::UBIGINT AS h
FROM (SELECT vec_id, label, embedding, (s[32] + s[33]) / 2 AS m FROM (SELECT *, list_sort([x::DOUBLE FOR x IN embedding]) AS s FROM embeddings))"""


def hashed(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", arrays.median_hash(F.col("embedding")).alias("h"))


@query(f"SELECT vec_id, lower(lpad(to_hex(h), 16, '0')) AS h FROM ({HASHES})")
def hash64_median_bits(spark, sf):
    return hashed(spark, sf).select("vec_id", arrays.hex64(F.col("h")).alias("h"))


@query(f"WITH h AS ({HASHES}) SELECT a.vec_id AS a, b.vec_id AS b, bit_count(xor(a.h, b.h)) AS dist FROM h a JOIN h b ON a.vec_id < b.vec_id AND bit_count(xor(a.h, b.h)) <= {NEAR}")
def hamming_pairs(spark, sf):
    return cluster.close_pairs(hashed(spark, sf).withColumnRenamed("vec_id", "ord"), NEAR)


def _greedy_sql(group: str) -> str:
    """Walks each group in order and carries its leaders along."""
    return f"""
WITH RECURSIVE h AS (SELECT *, {group} AS grp, row_number() OVER (PARTITION BY {group} ORDER BY vec_id) AS rn FROM ({HASHES})),
w AS (SELECT grp, rn, vec_id, label, vec_id AS leader, [{{'v': vec_id, 'h': h}}] AS leaders FROM h WHERE rn = 1
  UNION ALL SELECT grp, rn, vec_id, label, coalesce(found, vec_id), CASE WHEN found IS NULL THEN list_append(leaders, {{'v': vec_id, 'h': h}}) ELSE leaders END
  FROM (SELECT h.grp, h.rn, h.vec_id, h.label, h.h, w.leaders, list_min([x.v FOR x IN w.leaders IF bit_count(xor(x.h, h.h)) <= {NEAR}]) AS found
    FROM w JOIN h ON h.grp = w.grp AND h.rn = w.rn + 1))
SELECT vec_id, leader, row_number() OVER (PARTITION BY leader ORDER BY label DESC, vec_id) = 1 AS kept FROM w"""


@query(_greedy_sql("0"))
def greedy_cluster_global(spark, sf):
    items = hashed(spark, sf).select(F.col("vec_id").alias("ord"), "h", F.col("label").alias("px"))
    return cluster.greedy_clusters(items, NEAR).select(F.col("ord").alias("vec_id"), "leader", "kept")


@query(_greedy_sql("label"))
def greedy_cluster_per_bucket(spark, sf):
    items = hashed(spark, sf).select(F.col("vec_id").alias("ord"), "h", F.col("label").alias("px"), "label")
    return cluster.greedy_clusters(items, NEAR, "label").select(F.col("ord").alias("vec_id"), "leader", "kept")


DIGITS = 15  # of a word's digest: 60 bits
BIT_SUMS = ", ".join(f"sum((w >> {k}) & 1) AS b{k}" for k in range(4 * DIGITS))
DOC_HASHES = f"""SELECT doc_id, n_chars, ({' + '.join(f'(CASE WHEN 2 * b{k} > n THEN {1 << k} ELSE 0 END)' for k in range(4 * DIGITS))})::UBIGINT AS h FROM (
SELECT doc_id, n_chars, count(*) AS n, {BIT_SUMS} FROM (SELECT doc_id, n_chars, ('0x' || substr(md5(x), 1, {DIGITS}))::BIGINT AS w
FROM (SELECT doc_id, n_chars, unnest(list_distinct(string_split(text, ' '))) AS x FROM documents)) GROUP BY doc_id, n_chars)"""


@query(f"""
WITH RECURSIVE h AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM ({DOC_HASHES})),
w AS (SELECT rn, doc_id, n_chars, doc_id AS leader, [{{'v': doc_id, 'h': h}}] AS leaders FROM h WHERE rn = 1
  UNION ALL SELECT rn, doc_id, n_chars, coalesce(found, doc_id), CASE WHEN found IS NULL THEN list_append(leaders, {{'v': doc_id, 'h': h}}) ELSE leaders END
  FROM (SELECT h.rn, h.doc_id, h.n_chars, h.h, w.leaders, list_min([x.v FOR x IN w.leaders IF bit_count(xor(x.h, h.h)) <= 8]) AS found FROM w JOIN h ON h.rn = w.rn + 1))
SELECT doc_id, leader, row_number() OVER (PARTITION BY leader ORDER BY n_chars DESC, doc_id) = 1 AS kept FROM w""")
def near_dup_documents(spark, sf):
    """Clusters of documents by a hash of their distinct words; the longest of a cluster stays."""
    half = 2 * DIGITS
    low, one = F.lit((1 << half) - 1), lambda k: F.lit(1 << k).cast("long")
    words = table(spark, sf, "documents").select("doc_id", "n_chars", F.explode(F.array_distinct(F.split("text", " "))).alias("x"))
    words = words.select("doc_id", "n_chars", F.conv(F.substring(F.md5(F.encode("x", "utf-8")), 1, DIGITS), 16, 10).cast("long").alias("w"))
    # Bits k and k + half are counted together, in the two halves of one number: as few sums as the compiled aggregation takes.
    sums = [F.sum(F.shiftright("w", k).bitwiseAND(F.lit(1 | 1 << half))).alias(f"b{k}") for k in range(half)]
    counts = words.groupBy("doc_id", "n_chars").agg(F.count("*").alias("n"), *sums)
    bits = [F.when(2 * F.col(f"b{k}").bitwiseAND(low) > F.col("n"), one(k)).otherwise(F.lit(0)) for k in range(half)]
    bits += [F.when(2 * F.shiftright(f"b{k}", half) > F.col("n"), one(k + half)).otherwise(F.lit(0)) for k in range(half)]
    h = F.aggregate(F.array(*bits), F.lit(0).cast("long"), lambda a, x: a + x)
    items = counts.select(F.col("doc_id").alias("ord"), F.col("n_chars").alias("px"), h.alias("h"))
    return cluster.greedy_clusters(items, 8).select(F.col("ord").alias("doc_id"), "leader", "kept")


@query(f"SELECT vec_id, round(list_aggregate({_mirror_sql('embedding', WHOLE)}, 'var_pop'), 6) AS sharpness FROM embeddings")
def laplacian_variance(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.round(arrays.sharpness(F.col("embedding"), SIDE, SIDE), 6).alias("sharpness"))


@query(f"""SELECT vec_id, len([x FOR x IN tiles IF x >= {SHARP}]) / 4 AS sharp_share, len([x FOR x IN tiles IF x >= {SHARP}]) / 4 >= {SHARE} AS passes
FROM (SELECT vec_id, {_tiles_sql(2)} AS tiles FROM embeddings)""")
def grid_tile_metric(spark, sf):
    tiles = table(spark, sf, "embeddings").select("vec_id", arrays.tile_sharpness(F.col("embedding"), SIDE, SIDE, 2).alias("tiles"))
    return tiles.select("vec_id", arrays.sharp_share(F.col("tiles"), SHARP).alias("sharp_share"), arrays.passes_share(F.col("tiles"), SHARP, SHARE).alias("passes"))


@query(f"""SELECT vec_id, list_aggregate(tiles, 'quantile_cont', 0.5) >= 0.2 AS median, list_min(tiles) >= 0.05 AS minimum, list_aggregate(tiles, 'quantile_cont', 0.25) >= 0.1 AS p25
FROM (SELECT vec_id, {_tiles_sql(4)} AS tiles FROM embeddings)""")
def tile_rule_variants(spark, sf):
    tiles = table(spark, sf, "embeddings").select("vec_id", arrays.tile_sharpness(F.col("embedding"), SIDE, SIDE, 4).alias("tiles"))
    rules = {"median": 0.2, "minimum": 0.05, "p25": 0.1}
    return tiles.select("vec_id", *[arrays.TILE_RULES[k](F.col("tiles"), t).alias(k) for k, t in rules.items()])


SIZES = "SELECT l_orderkey, l_linenumber, l_partkey % 3000 + 100 AS w, l_orderkey % 2500 + 100 AS h FROM lineitem"


def sizes(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 3000 + 100).alias("w"), (F.col("l_orderkey") % 2500 + 100).alias("h"))


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN w::DOUBLE / h > 1.5 THEN (w - nw) // 2 ELSE 0 END AS l, CASE WHEN w::DOUBLE / h < 0.66 THEN (h - nh) // 2 ELSE 0 END AS t,
  CASE WHEN w::DOUBLE / h > 1.5 THEN (w - nw) // 2 + nw ELSE w END AS r, CASE WHEN w::DOUBLE / h < 0.66 THEN (h - nh) // 2 + nh ELSE h END AS b
FROM (SELECT *, round_even(h * 1.5::DOUBLE, 0)::BIGINT AS nw, round_even(w / 0.66::DOUBLE, 0)::BIGINT AS nh FROM ({SIZES}))""")
def ar_crop_box(spark, sf):
    return sizes(spark, sf).withColumn("box", geometry.ratio_crop(F.col("w"), F.col("h"))).select("l_orderkey", "l_linenumber", "box.*")


@query(f"""SELECT l_orderkey, l_linenumber, greatest(0, trunc(l - (r - l) * 0.25::DOUBLE)::BIGINT) AS l, greatest(0, trunc(t - (b - t) * 0.25::DOUBLE)::BIGINT) AS t,
  least(w, trunc(r + (r - l) * 0.25::DOUBLE)::BIGINT) AS r, least(h, trunc(b + (b - t) * 0.25::DOUBLE)::BIGINT) AS b
FROM (SELECT *, x * w AS l, y * h AS t, (x + 0.25::DOUBLE) * w AS r, (y + 0.5::DOUBLE) * h AS b FROM (SELECT s.*, (s.w % 4) / 8::DOUBLE AS x, (s.h % 8) / 16::DOUBLE AS y FROM ({SIZES}) s))""")
def bbox_pad_crop(spark, sf):
    s = sizes(spark, sf).withColumns({"x": (F.col("w") % 4) / 8, "y": (F.col("h") % 8) / 16})
    box = geometry.padded_box(F.col("x"), F.col("y"), F.lit(0.25), F.lit(0.5), F.col("w"), F.col("h"), 0.25)
    return s.withColumn("box", box).select("l_orderkey", "l_linenumber", "box.*")


@query("""WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'x' WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN '1024.0' ELSE CAST(p_size * 90 AS VARCHAR) END AS w,
  CAST(p_partkey * 37 % 4000 AS VARCHAR) AS h FROM part), n AS (SELECT p_partkey, CASE WHEN regexp_full_match(w, '\\d+') THEN least(w::INT, h::INT) END AS short FROM s)
SELECT p_partkey, CASE WHEN short >= 2048 THEN 'absurdres' WHEN short >= 1024 THEN 'highres' ELSE '' END AS tag FROM n""")
def resolution_tag(spark, sf):
    k = F.col("p_partkey")
    w = F.when(k % 5 == 0, "x").when(k % 7 == 0, None).when(k % 3 == 0, "1024.0").otherwise((F.col("p_size") * 90).cast("string"))
    return table(spark, sf, "part").select("p_partkey", geometry.resolution_tag(w, (k * 37 % 4000).cast("string")).alias("tag"))


@query("""WITH b AS (SELECT l_orderkey, list(least(l_quantity / 50, 1)::DOUBLE ORDER BY l_linenumber) AS q, list(l_discount::DOUBLE ORDER BY l_linenumber) AS d FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, round(least(list_sum([q[i] * 100 * (d[i] * 1000) FOR i IN range(1, len(q) + 1)]) / 20000, 1), 6) AS share FROM b""")
def text_area_ratio(spark, sf):
    """Boxes as wide as a line's quantity and as high as its discount, as corners."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    w, h = F.least(F.col("l_quantity") / 50, F.lit(1.0)) * 100, F.col("l_discount") * 1000
    box = F.array(point(F.lit(0.0), F.lit(0.0)), point(w, F.lit(0.0)), point(w, h), point(F.lit(0.0), h))
    orders = table(spark, sf, "lineitem").select("l_orderkey", box.alias("box")).groupBy("l_orderkey").agg(F.collect_list("box").alias("boxes"))
    return orders.select("l_orderkey", F.round(geometry.text_area(F.col("boxes"), F.lit(200), F.lit(100)), 6).alias("share"))
