import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from harborline.streaming import events as stream

NOW = {"availableNow": True}
GOOD = [
    {"policy_number": "P1", "event_type": "issued", "payload": '{"seq": 1}', "event_time_ms": 1700000000123},
    {"policy_number": "P2", "event_type": "paid", "payload": {"a": 1, "b": [1, "é"]}, "event_time_ms": "1700000000000"},
    {"policy_number": None, "event_type": "paid", "payload": None, "event_time_ms": 0},
    {"policy_number": 7, "event_type": "x", "event_time_ms": 1},
    {"policy_number": "P5", "event_type": "x", "payload": "y" * 9000, "event_time_ms": 1},
]
BAD = ["not json", '["list"]', '{"policy_number": "P1", "event_type": "x"}', '{"event_type": "x", "event_time_ms": 1}',
       '{"policy_number": "P1", "event_type": "x", "event_time_ms": "soon"}']


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse(spark):
    got = stream.parse_events(lines(spark, [json.dumps(g) for g in GOOD])).collect()
    assert [r["policy_number"] for r in got] == ["P1", "P2", None, "7", "P5"]
    assert [r["payload"] for r in got[:4]] == ['{"seq": 1}', '{"a":1,"b":[1,"é"]}', "null", "{}"]
    assert len(got[4]["payload"]) == 9000
    cut = stream.parse_events(lines(spark, [json.dumps(GOOD[4])]), payload_limit=8000).first()
    assert cut["payload"] == "y" * 8000
    assert got[0]["event_time"] == datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_spaced_payload_is_what_a_json_dump_writes(spark):
    got = stream.parse_events(lines(spark, [json.dumps(g) for g in GOOD]), spaced=True).collect()
    assert got[1]["payload"] == json.dumps(GOOD[1]["payload"])
    assert got[0]["payload"] == '{"seq": 1}' and got[2]["payload"] == "null"


def test_bad_messages_stop_or_are_set_aside(spark):
    mixed = lines(spark, [json.dumps(GOOD[0]), *BAD])
    with pytest.raises(PySparkException, match="bad event message"):
        stream.parse_events(mixed).collect()
    good, bad = stream.parse_events(mixed, strict=False)
    assert good.count() == 1 and sorted(r[0] for r in bad.collect()) == sorted(BAD)


def test_restart_lands_only_new_messages(spark, tmp_path):
    topic, target, offsets = tmp_path / "topic", str(tmp_path / "landing"), str(tmp_path / "offsets")
    topic.mkdir()

    def run():
        messages = stream.event_stream(spark, str(topic), "text")
        stream.land_stream(stream.parse_events(messages), target, offsets, NOW).awaitTermination()
        return spark.read.parquet(target)

    (topic / "1.txt").write_text("\n".join(json.dumps(g) for g in GOOD[:2]))
    assert run().count() == 2
    assert run().count() == 2
    (topic / "2.txt").write_text(json.dumps(GOOD[3]))
    landed = run()
    assert landed.count() == 3 and landed.where("received_at IS NULL").count() == 0
    check = stream.landing_check(landed).first()
    assert check["events"] == 3 and check["latest_event"] == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert "event_day" in stream.stg_events(landed).columns


def test_repeated_batch_changes_nothing(spark, tmp_path):
    write = stream.batch_folders(str(tmp_path / "t"))
    batch = stream.parse_events(lines(spark, [json.dumps(g) for g in GOOD]))
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_rows_written_before_are_found_under_any_partitioning(spark):
    batch = spark.range(100).selectExpr("id AS offset", "id % 3 AS part")
    held = batch.where("offset % 7 < 5").repartition(5)
    for parts in (1, 4, 9):
        left = stream.still_missing(batch.repartition(parts), held, ["part", "offset"])
        assert sorted(r["offset"] for r in left.collect()) == [i for i in range(100) if i % 7 >= 5]


def test_latest_events_read_the_newest_days_only(spark, tmp_path):
    rows = spark.range(96).selectExpr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS event_time", "id")
    path = str(tmp_path / "t")
    rows.selectExpr("*", "to_date(event_time) AS event_day").write.partitionBy("event_day").parquet(path)
    got = stream.latest_events(spark, path, 30)
    assert [r["id"] for r in got.collect()] == list(range(95, 65, -1))
    assert "2024-01-03" in got._jdf.queryExecution().executedPlan().toString()
    assert len(stream.latest_events(spark, path, 500).collect()) == 96
