"""The stream operators' batch results."""

from pyspark.sql import functions as F

from loam.streaming import events

from .registry import query, table


def of_events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def events_tumbling(spark, sf):
    return events.windowed(of_events(spark, sf), late=None).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("""SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total
FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS s, event_type, value FROM events) GROUP BY ALL""")
def events_sliding(spark, sf):
    return events.windowed(of_events(spark, sf), "2 hours", "1 hour", late=None).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def events_sessions(spark, sf):
    return events.sessions(of_events(spark, sf), late=None).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
