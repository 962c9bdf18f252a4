"""Streams with restarts: quarantine, replay without a checkpoint, flushes by rows."""

import json

import pytest
from pyspark.sql import functions as F

from harborline.streaming import events as stream

NOW = {"availableNow": True}


def message(i, minutes=None):
    at = 60_000 * (1 + (i if minutes is None else minutes))  # a watermark begins at zero
    return json.dumps({"policy_number": f"P{i}", "event_type": "x", "payload": str(i), "event_time_ms": at})


def put(topic, name, lines):
    topic.mkdir(exist_ok=True)
    (topic / name).write_text("\n".join(lines))


def test_bad_messages_go_to_quarantine_once(spark, tmp_path):
    topic, target, aside, offsets = tmp_path / "topic", *(str(tmp_path / n) for n in ("landing", "quarantine", "offsets"))

    def run():
        source = stream.event_stream(spark, str(topic), "text")
        stream.land_sorted(source, target, aside, offsets, NOW).awaitTermination()
        good, bad = spark.read.parquet(target), spark.read.parquet(aside)
        return sorted(r.policy_number for r in good.collect()), sorted(r.value for r in bad.collect())

    put(topic, "1.txt", [message(1), "not json", message(2)])
    assert run() == (["P1", "P2"], ["not json"])
    put(topic, "2.txt", [message(3), '{"event_type": "x"}', "[]"])
    assert run() == run() == (["P1", "P2", "P3"], ["[]", "not json", '{"event_type": "x"}'])
    assert spark.read.parquet(aside).where("received_at IS NULL").count() == 0


def test_a_batch_that_broke_off_between_its_two_writes(spark, tmp_path, monkeypatch):
    topic, target, aside, offsets = tmp_path / "topic", *(str(tmp_path / n) for n in ("landing", "quarantine", "offsets"))
    put(topic, "1.txt", [message(1), "bad"])
    real = stream.batch_folders

    def failing(folder, flush_rows=None):
        def write(batch, number):
            raise RuntimeError("disk full")

        return write if folder == aside else real(folder, flush_rows)

    with monkeypatch.context() as patch:
        patch.setattr(stream, "batch_folders", failing)
        with pytest.raises(Exception, match="disk full"):
            stream.land_sorted(stream.event_stream(spark, str(topic), "text"), target, aside, offsets, NOW).awaitTermination()
    assert spark.read.parquet(target).count() == 1  # the first write is done
    put(topic, "2.txt", [message(2)])
    stream.land_sorted(stream.event_stream(spark, str(topic), "text"), target, aside, offsets, NOW).awaitTermination()
    assert spark.read.parquet(target).count() == 2 and spark.read.parquet(aside).count() == 1


def keyed(spark, topic):
    parsed = stream.parse_events(stream.event_stream(spark, str(topic), "text", maxFilesPerTrigger="1"), keep=["value"])
    return parsed.withColumn("message", F.sha2("value", 256)).drop("value")


@pytest.mark.parametrize("within", [None, "100 days"])
def test_replay_with_lost_offsets_adds_nothing(spark, tmp_path, within):
    topic, target = tmp_path / "topic", str(tmp_path / "landing")
    put(topic, "1.txt", [message(i) for i in range(50)])
    put(topic, "2.txt", [message(i, 3000 + i) for i in range(50, 60)] + [message(i) for i in range(5)])  # some are sent again
    put(topic, "3.txt", [message(1000, 0)])  # late
    for start in ("a", "b", "b"):
        stream.land_once(keyed(spark, topic), target, str(tmp_path / start), "message", within, NOW).awaitTermination()
        assert spark.read.parquet(target).count() == 61
    put(topic, "4.txt", [message(2000), message(7)])
    stream.land_once(keyed(spark, topic), target, str(tmp_path / "b"), "message", within, NOW).awaitTermination()
    landed = spark.read.parquet(target)
    assert landed.count() == landed.select("message").distinct().count() == 62
    assert landed.where("event_day <> to_date(event_time) OR received_at IS NULL").count() == 0


def test_late_messages_with_and_without_a_watermark(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "1.txt", [message(i, 100_000) for i in range(3)])
    put(topic, "2.txt", [message(10, 100_001)])
    put(topic, "3.txt", [message(11, 5), message(12, 99_999)])  # one is two months late, one a minute
    counts = {}
    for within in (None, "1 day"):
        target = str(tmp_path / f"landing-{within}")
        stream.land_once(keyed(spark, topic), target, str(tmp_path / f"offsets-{within}"), "message", within, NOW).awaitTermination()
        counts[within] = sorted(r.policy_number for r in spark.read.parquet(target).collect())
    assert counts[None] == ["P0", "P1", "P10", "P11", "P12", "P2"]
    assert counts["1 day"] == ["P0", "P1", "P10", "P12", "P2"]


def test_flushes_hold_at_most_so_many_rows(spark, tmp_path):
    topic, target = tmp_path / "topic", str(tmp_path / "landing")
    for n in range(3):
        put(topic, f"{n}.txt", [message(100 * n + i) for i in range(47)])
    events = stream.parse_events(stream.event_stream(spark, str(topic), "text", maxFilesPerTrigger="1"))
    stream.land_batches(events, stream.batch_folders(target, flush_rows=10), str(tmp_path / "offsets"), NOW).awaitTermination()
    landed = spark.read.parquet(target)
    sizes = [r["n"] for r in landed.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) == 10 and sum(sizes) == 141 and landed.select("policy_number").distinct().count() == 141
    assert landed.select("batch_id").distinct().count() == 3


def test_latest_events_open_no_older_day(spark, tmp_path):
    rows = spark.range(240).selectExpr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS event_time", "id")
    path = str(tmp_path / "t")
    rows.selectExpr("*", "to_date(event_time) AS event_day").write.partitionBy("event_day").parquet(path)
    for old in (tmp_path / "t").glob("event_day=2024-01-0[1-5]/*.parquet"):
        old.write_bytes(b"cannot be read")
    got = stream.latest_events(spark, path, 40)
    assert [r["id"] for r in got.collect()] == list(range(239, 199, -1))
    assert stream.latest_events(spark, path, 0).count() == 0
