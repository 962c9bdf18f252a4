"""Policy event stream: parse JSON messages, land them, replay them safely."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from harborline.functions.exprs import clip, from_millis
from harborline.operators.joins import orphans
from harborline.sinks.merge import merge_insert_only

MESSAGE = "policy_number variant, event_type variant, payload variant, event_time_ms variant"
EVENT_COLUMNS = ["policy_number", "event_type", "payload", "event_time"]


def event_stream(spark: SparkSession, source: str, fmt: str = "kafka", **options: str) -> DataFrame:
    """A stream of message texts in ``value``: a Kafka topic from its start, or files of lines."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", source).option("startingOffsets", "earliest")
        return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))
    return spark.readStream.format(fmt).schema("value string").options(**options).load(source)


@F.pandas_udf(StringType())
def _spaced(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: json.dumps(json.loads(t)), na_action="ignore")


def _text(field: str) -> Column:
    return F.expr(f"try_variant_get({field}, '$', 'string')")


def _payload(spaced: bool) -> Column:
    """Text payloads as they are, other JSON as its text, '{}' when the key is missing."""
    nested = F.expr("schema_of_variant(m.payload)") != "STRING"
    text = _text("m.payload")
    if spaced:
        text = F.coalesce(_spaced(F.when(nested, text)), text)
    return (
        F.when(F.col("m.payload").isNull(), "{}").when(F.expr("is_variant_null(m.payload)"), "null").otherwise(text)
    )


def _parsed(lines: DataFrame, spaced: bool, payload_limit: int | None, keep: Sequence[str] = ()) -> DataFrame:
    read = lines.withColumn("m", F.from_json("value", MESSAGE))
    millis = F.expr("try_variant_get(m.event_time_ms, '$', 'bigint')")
    complete = F.col("m.policy_number").isNotNull() & F.col("m.event_type").isNotNull() & millis.isNotNull()
    return read.select(
        "value",
        *[c for c in keep if c != "value"],
        complete.alias("ok"),
        _text("m.policy_number").alias("policy_number"),
        _text("m.event_type").alias("event_type"),
        (_payload(spaced) if payload_limit is None else clip(_payload(spaced), payload_limit)).alias("payload"),
        from_millis(millis).alias("event_time"),
    )


def parse_events(
    lines: DataFrame, strict: bool = True, spaced: bool = False, payload_limit: int | None = None, keep: Sequence[str] = (),
):
    """JSON messages to policy_number, event_type, payload and event_time.

    A message is bad when it is not a JSON object, or lacks one of the three other keys. Strict parsing
    stops at a bad message; else the result is a pair (events, bad message texts).

    ``payload_limit`` cuts payloads to so many characters, after which one may no longer be JSON; without it
    they stay whole. Nested payloads are written as compact JSON; ``spaced`` writes them with a blank after each comma
    and colon, and non-ASCII characters escaped, at the price of a Python pass. ``keep`` names columns of the
    messages (their text, or topic, partition and offset) that events carry on.
    """
    parsed = _parsed(lines, spaced, payload_limit, keep)
    if strict:
        broken = F.raise_error(F.concat(F.lit("bad event message: "), F.coalesce("value", F.lit("NULL"))))
        checked = F.when(F.col("ok"), F.col("event_time")).otherwise(broken.cast("timestamp"))
        return parsed.withColumn("event_time", checked).select(*EVENT_COLUMNS, *keep)
    return parsed.where("ok").select(*EVENT_COLUMNS, *keep), parsed.where(~F.col("ok")).select("value")


def land_stream(
    events: DataFrame, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append events to Parquet with their arrival time, laid out by event day.

    The checkpoint and the file sink's log make this exactly-once: a restart continues, adding nothing
    twice. The day layout serves reads of the latest events by event time.
    """
    landed = events.withColumn("received_at", F.current_timestamp()).withColumn("event_day", F.to_date("event_time"))
    writer = landed.writeStream.format("parquet").outputMode("append").partitionBy("event_day")
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start(target)


def land_batches(
    events: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand each micro-batch and its number to ``write``: at least once, so ``write`` must skip repeats."""
    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def batch_folders(target: str, flush_rows: int | None = None) -> Callable[[DataFrame, int], None]:
    """A batch writer that replaces the folder of its own batch, so a repeated batch changes nothing.

    ``flush_rows`` is the most rows that one file gets: a task closes a file and begins another after so many. How
    long rows wait is up to the trigger, how many come in at once up to the source (``maxFilesPerTrigger``,
    ``maxOffsetsPerTrigger``).
    """

    def write(batch: DataFrame, number: int) -> None:
        writer = batch.withColumn("received_at", F.current_timestamp()).write.mode("overwrite")
        if flush_rows is not None:
            writer = writer.option("maxRecordsPerFile", flush_rows)
        writer.parquet(f"{target}/batch_id={number}")

    return write


def land_sorted(
    messages: DataFrame, target: str, quarantine: str, checkpoint: str, trigger: dict | None = None,
    flush_rows: int | None = None, **parsing,
) -> StreamingQuery:
    """Land a stream of message texts: events under ``target``, messages that cannot be read under ``quarantine``.

    Both go to the folder of their batch, so a batch that is repeated after a failure, also one between the two
    writes, replaces what it wrote: each message is in exactly one of the two tables, once. Quarantined rows hold the
    message text (``value``) and ``received_at``. ``parsing`` is handed to ``parse_events``.
    """
    keep, aside = batch_folders(target, flush_rows), batch_folders(quarantine, flush_rows)

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            good, bad = parse_events(held, strict=False, **parsing)
            keep(good, number)
            aside(bad, number)
        finally:
            held.unpersist()

    return land_batches(messages, write, checkpoint, trigger)


def land_once(
    events: DataFrame, target: str, checkpoint: str, key: str, within: str | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Land a stream so that a message is there once, also when its source is read again from the start.

    ``key`` tells messages apart (a digest of the text, or topic, partition and offset); equal keys have equal
    ``event_time``. Each batch is merged into the landing by its key: it reads the keys of the event days it has
    rows for and adds the others, so a lost checkpoint, a repeated batch or a write that broke off in the middle
    adds nothing twice, and a late message, however late, lands in its day.

    With ``within`` (a span such as "2 days") a state store drops repeats before the merge, which then sees fewer rows.
    The price is its watermark: a message whose event time is older than the latest one by more than that span does
    not land, even if it is new. Without it nothing is dropped.
    """
    if within is not None:
        events = events.withWatermark("event_time", within).dropDuplicatesWithinWatermark([key])

    def write(batch: DataFrame, number: int) -> None:
        staged = batch.dropDuplicates([key]).withColumn("received_at", F.current_timestamp())
        staged = staged.withColumn("event_day", F.to_date("event_time")).persist()
        try:
            merge_insert_only(staged, target, key, partition="event_day")
        finally:
            staged.unpersist()

    return land_batches(events, write, checkpoint, trigger)


def still_missing(batch: DataFrame, held: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of a batch whose key the table does not hold yet, however batch and table are partitioned."""
    return orphans(batch, held, key)


def _is_database_error(error: Exception) -> bool:
    return isinstance(error, (Py4JJavaError, PySparkException)) and "java.sql." in str(error)


def jdbc_batches(
    url: str, table: str, key: Sequence[str], retries: int = 3, flush_rows: int = 1000, **options: str
) -> Callable[[DataFrame, int], None]:
    """A batch writer over JDBC that can be repeated.

    ``key`` names columns that tell the rows of a batch apart by their source: topic, partition and offset,
    or file and position. Rows are stamped with the batch number; a repeated batch reads the keys that the
    table holds of it and writes the others, so it does not matter how tasks cut the batch. Each task
    writes in one transaction. Only errors of the database are tried again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jdbc = {"url": url, **options}
        stamped = batch.withColumn("batch_id", F.lit(number))
        query = f"SELECT {', '.join(key)} FROM {table} WHERE batch_id = {int(number)}"
        for attempt in range(retries + 1):
            try:
                held = spark.read.format("jdbc").options(query=query, **jdbc).load()
                todo = still_missing(stamped, held, key)
                todo.write.format("jdbc").mode("append").options(dbtable=table, batchsize=str(flush_rows), **jdbc).save()
                return
            except Exception as error:
                if attempt == retries or not _is_database_error(error):
                    raise

    return write


def _days(spark: SparkSession, landed: str) -> list[str]:
    """The days of a landing, newest first, from the names of its folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path(landed)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found]
    days = [n.removeprefix("event_day=") for n in names if n.startswith("event_day=")]
    return sorted((d for d in days if not d.startswith("__HIVE")), reverse=True)


def latest_events(spark: SparkSession, landed: str, n: int, *order: str) -> DataFrame:
    """The ``n`` latest events of a landing laid out by event_day, newest first, ties by ``order``.

    Days are known from the names of their folders. The newest one is counted, then the two newest, four and so on
    until they hold ``n`` events; only these are then read and sorted, so no file of an older day is opened.
    """
    days, taken = _days(spark, landed), 1
    if not days:
        return spark.read.parquet(landed).limit(0)
    newest = spark.read.option("basePath", landed).parquet(f"{landed.rstrip('/')}/event_day={days[0]}")
    rows = spark.read.schema(newest.schema).parquet(landed)
    while True:
        picked = rows.where(F.col("event_day") >= F.lit(days[min(taken, len(days)) - 1]).cast("date"))
        if taken >= len(days) or picked.count() >= n:
            return picked.orderBy(F.desc("event_time"), *order).limit(n)
        taken *= 2


def landing_check(landed: DataFrame) -> DataFrame:
    return landed.agg(F.count(F.lit(1)).alias("events"), F.max("event_time").alias("latest_event"))


def stg_events(landed: DataFrame) -> DataFrame:
    """Staging over the landed stream: typed columns, and the event's day."""
    return landed.select(
        "policy_number", "event_type", "payload",
        F.col("event_time").cast("timestamp").alias("event_time"),
        F.to_date("event_time").alias("event_day"),
    )
