"""Stream queries: the events table sent as JSON messages, landed, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline import domain
from harborline.catalog.registry import query
from harborline.catalog.sqltext import ts
from harborline.session import scratch
from harborline.streaming import events as stream

NOW = {"availableNow": True}
MILLIS = "date_trunc('millisecond', ts)"
EVENT_SQL = f"""SELECT CAST(user_id AS VARCHAR) AS policy_number, event_type, props AS payload,
  {ts(MILLIS)} AS event_time FROM events"""


def _topic(spark, sf, label):
    """The messages as files of lines, standing in for a topic."""
    path = scratch(spark, label)
    domain.event_messages(domain.table(spark, sf, "events")).write.text(path)
    return path


def _landed(spark, sf, label):
    target, checkpoint = scratch(spark, f"{label}-landing"), scratch(spark, f"{label}-offsets")
    topic = _topic(spark, sf, label)
    for _ in range(2):  # the second start finds nothing new
        messages = stream.event_stream(spark, topic, "text")
        stream.land_stream(stream.parse_events(messages), target, checkpoint, NOW).awaitTermination()
    return target


def _land(spark, sf, label):
    return spark.read.parquet(_landed(spark, sf, label))


@query("s13_event_source", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s13(spark, sf):
    messages = stream.event_stream(spark, _topic(spark, sf, "s13"), "text")
    target, checkpoint = scratch(spark, "s13-landing"), scratch(spark, "s13-offsets")
    messages.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(**NOW).start(
        target
    ).awaitTermination()
    parsed = stream.parse_events(spark.read.parquet(target))
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("r1_stream_parse", EVENT_SQL)
def r1(spark, sf):
    return stream.parse_events(domain.event_messages(domain.table(spark, sf, "events")))


@query("r2_stream_landing", EVENT_SQL)
def r2(spark, sf):
    return _land(spark, sf, "r2").select(*stream.EVENT_COLUMNS)


@query("g8_stream_map", "SELECT event_type, count(DISTINCT user_id) AS policies, count(*) AS n FROM events GROUP BY 1")
def g8(spark, sf):
    landed = _land(spark, sf, "g8")
    return landed.groupBy("event_type").agg(
        F.count_distinct("policy_number").alias("policies"), F.count(F.lit(1)).alias("n")
    )


@query("r3_quarantine", f"""
SELECT 'good' AS kind, CAST(user_id AS VARCHAR) AS policy_number, event_type, props AS content, {ts(MILLIS)} AS event_time
FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'bad', NULL, NULL, substring('{{"policy_number":"' || user_id || '"', 1, 20), NULL
FROM events WHERE event_type = 'error'""")
def r3(spark, sf):
    # messages of error events are cut short, which leaves broken JSON; the stream stops between two halves of the topic
    topic, offsets = scratch(spark, "r3"), scratch(spark, "r3-offsets")
    target, aside = scratch(spark, "r3-landing"), scratch(spark, "r3-quarantine")
    messages = domain.event_messages(domain.table(spark, sf, "events"))
    broken = F.when(F.col("value").contains('"event_type":"error"'), F.substring_index("value", ",", 1))
    broken = F.when(broken.isNotNull(), F.substring(broken, 1, 20))
    messages = messages.select(F.coalesce(broken, "value").alias("value"))
    half = F.xxhash64("value") % 2 == 0
    for part in (messages.where(half), messages.where(~half)):
        part.write.mode("append").text(topic)
        stream.land_sorted(stream.event_stream(spark, topic, "text"), target, aside, offsets, NOW).awaitTermination()
    good, bad = spark.read.parquet(target), spark.read.parquet(aside)
    return good.select(
        F.lit("good").alias("kind"), "policy_number", "event_type", F.col("payload").alias("content"), "event_time",
    ).unionByName(bad.select(F.lit("bad").alias("kind"), F.col("value").alias("content")), allowMissingColumns=True)


@query("r4_replay", "SELECT DISTINCT * FROM (" + EVENT_SQL + ")")
def r4(spark, sf):
    # offsets are lost between two starts, and the topic is read from its start again
    topic, target = _topic(spark, sf, "r4"), scratch(spark, "r4-landing")
    for start in ("a", "b"):
        messages = stream.event_stream(spark, topic, "text")
        keyed = stream.parse_events(messages, keep=["value"]).withColumn("message", F.sha2("value", 256)).drop("value")
        stream.land_once(keyed, target, scratch(spark, f"r4-offsets-{start}"), "message", trigger=NOW).awaitTermination()
    return spark.read.parquet(target).select(*stream.EVENT_COLUMNS)


@query("r5_latest_first", f"""
SELECT CAST(user_id AS VARCHAR) AS policy_number, {ts(MILLIS)} AS event_time FROM events
ORDER BY {MILLIS} DESC, 1 LIMIT 20""")
def r5(spark, sf):
    target = _landed(spark, sf, "r5")
    return stream.latest_events(spark, target, 20, "policy_number").select("policy_number", "event_time")


@query("r6_staged_events", f"""
SELECT *, substring(event_time, 1, 10) AS event_day FROM ({EVENT_SQL})""")
def r6(spark, sf):
    return stream.stg_events(_land(spark, sf, "r6"))


@query("a26_landing_check", f"SELECT count(*) AS events, {ts(f'max({MILLIS})')} AS latest_event FROM events")
def a26(spark, sf):
    return stream.landing_check(_land(spark, sf, "a26"))


@query("k18_stream_batches", EVENT_SQL)
def k18(spark, sf):
    target, checkpoint = scratch(spark, "k18-landing"), scratch(spark, "k18-offsets")
    messages = stream.event_stream(spark, _topic(spark, sf, "k18"), "text")
    stream.land_batches(
        stream.parse_events(messages), stream.batch_folders(target), checkpoint, NOW
    ).awaitTermination()
    return spark.read.parquet(target).select(*stream.EVENT_COLUMNS)


@query("k18_flush_by_rows", "SELECT count(*) AS row_count, true AS small FROM events")
def k18_flush(spark, sf):
    target, checkpoint = scratch(spark, "k18-flushes"), scratch(spark, "k18-flush-offsets")
    messages = stream.event_stream(spark, _topic(spark, sf, "k18-flush"), "text")
    stream.land_batches(
        stream.parse_events(messages), stream.batch_folders(target, flush_rows=1000), checkpoint, NOW
    ).awaitTermination()
    files = spark.read.parquet(target).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("row_count"), (F.max("n") <= 1000).alias("small"))
