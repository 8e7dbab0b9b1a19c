"""Relational queries over the star schema and events (an extension)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loam.operators.relational import as_of, salted_join, ten_thousandths

from .registry import query, table

REVENUE = "CAST(floor(l_extendedprice * (1 - l_discount) * 10000 + 0.5) AS BIGINT)"


def revenue():
    return ten_thousandths(F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query(f"""SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(sum({REVENUE}) AS BIGINT) AS revenue, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2024-01-01' OR l_quantity > 5 GROUP BY ALL""")
def pricing_summary(spark, sf):
    rows = table(spark, sf, "lineitem").where((F.col("l_shipdate") <= F.lit("2024-01-01").cast("timestamp_ntz")) | (F.col("l_quantity") > 5))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("long").alias("sum_qty"), F.sum(revenue()).alias("revenue"), F.count("*").alias("n"))


@query(f"""SELECT l_orderkey, o_orderpriority, CAST(sum({REVENUE}) AS BIGINT) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' GROUP BY ALL ORDER BY revenue DESC, l_orderkey LIMIT 10""")
def top_orders(spark, sf):
    c, o, l = (table(spark, sf, t) for t in ("customer", "orders", "lineitem"))
    joined = l.join(o.join(c.where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_orderkey", "o_orderpriority").agg(F.sum(revenue()).alias("revenue")).orderBy(F.desc("revenue"), "l_orderkey").limit(10)


@query(f"""SELECT n_name, CAST(sum({REVENUE}) AS BIGINT) AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY n_name""")
def region_revenue(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    inner = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf, "lineitem").join(inner, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy("n_name").agg(F.sum(revenue()).alias("revenue"))


@query("""SELECT coalesce(lang, 'all') AS lang, coalesce(source, 'all') AS source, count(*) AS n FROM documents GROUP BY CUBE (lang, source)""")
def documents_cube(spark, sf):
    d = table(spark, sf, "documents").cube("lang", "source").agg(F.count("*").alias("n"))
    return d.select(F.coalesce("lang", F.lit("all")).alias("lang"), F.coalesce("source", F.lit("all")).alias("source"), "n")


@query("""WITH p AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT e.event_id, p.event_id AS last_event_id FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def last_purchase_before_error(spark, sf):
    e = table(spark, sf, "events")
    errors, bought = e.where("event_type = 'error'").select("event_id", "user_id", "ts"), e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return as_of(errors, bought, "user_id", "ts", ["event_id"]).select("event_id", "last_event_id")


@query("""SELECT event_id, event_type, running, gap_seconds FROM (SELECT event_id, event_type, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS running,
  epoch(date_trunc('second', ts))::BIGINT - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))::BIGINT AS gap_seconds FROM events)""")
def user_running_events(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = lambda c: F.unix_timestamp(c.cast("timestamp"))
    return table(spark, sf, "events").select("event_id", "event_type", F.count("*").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"), (seconds(F.col("ts")) - seconds(F.lag("ts").over(w))).alias("gap_seconds"))


@query("SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def customers_by_sets(spark, sf):
    o = table(spark, sf, "orders")
    of = lambda s: o.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("custkey"))
    return of("F").intersect(of("O")).subtract(table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("SELECT e.event_type, d.k % 3 AS kind, count(*) AS n FROM events e JOIN (SELECT DISTINCT user_id, user_id % 7 AS k FROM events) d ON e.user_id = d.user_id GROUP BY ALL")
def salted_lookup(spark, sf):
    e = table(spark, sf, "events")
    users = e.select("user_id").distinct().withColumn("k", F.col("user_id") % 7)
    return salted_join(e, users, "user_id", 4, "event_id").groupBy("event_type", (F.col("k") % 3).alias("kind")).agg(F.count("*").alias("n"))
