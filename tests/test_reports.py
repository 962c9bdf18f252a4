from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.operators import profile, quality, retrieval
from harborline.plans import adhoc, dashboard, trips


def test_checks_on_frames_that_fail_and_pass(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "z"), (3, None)], "id int, s string")
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert quality.not_null(df, "id").count() == 2
    assert rows(quality.accepted(df, "s", ["a", "b", "c"]), "s") == [("z",)]
    parents = spark.createDataFrame([(1,), (2,)], "key int")
    assert rows(quality.references(df, "id", parents, "key"), "id") == [(3,)]
    results = quality.run_checks({"u": quality.unique(df, "id"), "n": quality.not_null(df.where("id = 3"), "id")})
    assert rows(results) == [("n", 0), ("u", 1)]
    with pytest.raises(quality.ChecksFailed, match="u: 1"):
        quality.require(results)
    quality.require(results.where("failures = 0"))


def test_starter_rows_fail_not_null(spark):
    literal = spark.sql("SELECT * FROM VALUES (1), (NULL) AS t(id)")
    assert quality.not_null(literal, "id").count() == 1 and quality.unique(literal, "id").count() == 0
    assert literal.where("id = 1").count() == 1


def test_profile(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3), (None, 3)], "k string, v int")
    assert rows(profile.null_counts(df)) == [("k", 1), ("v", 1)]
    assert [tuple(r) for r in profile.frequency(df, "k").collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert rows(profile.histogram_of_counts(df, "k")) == [(1, 2), (2, 1)]
    assert rows(profile.bucketed_counts(df, "k")) == [("multi_policy", 1), ("single_policy", 2)]
    assert rows(profile.coverage({"x": df, "y": df.where("v = 3")}, "k")) == [(2, 1)]
    base = spark.createDataFrame([("a",)], "k string")
    assert rows(profile.orphan_report({"x": df, "y": base}, base, "k")) == [("x", 2), ("y", 0)]
    assert rows(profile.shape(df)) == [(0, "k", "string", 4), (1, "v", "int", 4)]
    assert profile.ddl(df, "t") == "CREATE TABLE t (\n  k string,\n  v int\n)"
    assert rows(profile.union_distinct([base, base])) == [("a",)]


@pytest.fixture(scope="module")
def zones(spark):
    # two location ids share the name Corona
    return trips.dim_zones(spark.createDataFrame(
        [(1, "Queens", "Corona", "Boro"), (2, "Queens", "Corona", "Boro"), (3, "Bronx", "Norwood", "Boro")],
        "LocationID int, Borough string, Zone string, service_zone string",
    ))


@pytest.fixture(scope="module")
def raw_green(spark):
    at = datetime(2025, 11, 18, 10)
    data = [(1, at, at, 1, 3, 10.0, 2.0), (2, at, at, 2, 3, 20.0, 5.0), (None, at, at, 3, 1, 5.0, 1.0), (3, at, at, 3, 1, 7.0, 9.0)]
    df = spark.createDataFrame(data, """VendorID int, lpep_pickup_datetime timestamp_ntz,
      lpep_dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, total_amount double, tip_amount double""")
    for name, (source, to) in trips.LAYOUT.items():
        column = source.format(p="lpep")
        if column not in df.columns:
            df = df.withColumn(column, F.lit("1"))
    return df


def test_trips_by_zone_name(spark, raw_green, zones, rows):
    green = trips.stg_green(raw_green)
    assert green.count() == 3  # the trip without a vendor is dropped
    assert trips.top_pickup_zone(green, zones).first() == ("Corona", Decimal("30.000000000"))
    assert rows(trips.rarest_pickup_zones(green, zones)) == [("Corona", 2), ("Norwood", 1)]
    assert trips.largest_tip(green, zones, "Corona").first() == ("Norwood", Decimal("5.000000000"))
    yellow = raw_green.withColumnsRenamed({
        "lpep_pickup_datetime": "tpep_pickup_datetime", "lpep_dropoff_datetime": "tpep_dropoff_datetime"
    }).drop("trip_type", "ehail_fee")
    both = trips.union_trips(green, trips.stg_yellow(yellow))
    assert both.count() == 6 and both.columns == list(trips.LAYOUT)
    names = dict(tuple(r) for r in trips.dim_vendors(both).collect())
    assert names == {1: "Creative Mobile Technologies, LLC", 2: "VeriFone Inc.", 3: None}


ALLOWED = [
    "SELECT 1", "select 1;", "WITH t AS (SELECT 1 AS a) SELECT a FROM t", " select created_at from v;; ",
]
REFUSED = {
    "": "empty", "   ": "empty", "SELECT 1; SELECT 2": "chained", "SELECT 1; ;": "chained", "SHOW TABLES": "not a query",
    "SELECT * FROM t WHERE a = 'drop me'": "forbidden word: DROP",
    "WITH t AS (SELECT 1) INSERT INTO x SELECT * FROM t": "forbidden word: INSERT",
}


def test_statement_check():
    assert [adhoc.verdict(text) for text in ALLOWED] == ["ok"] * len(ALLOWED)
    assert {text: adhoc.verdict(text) for text in REFUSED} == REFUSED


def test_readonly_sql_limits_its_answer(spark):
    spark.range(500).createOrReplaceTempView("many")
    assert adhoc.readonly_sql(spark, "SELECT id FROM many ORDER BY id DESC;").count() == 200
    assert adhoc.readonly_sql(spark, "SELECT id FROM many LIMIT 300").count() == 300
    assert adhoc.readonly_sql(spark, "SELECT id FROM many ORDER BY id DESC", 2).collect()[0]["id"] == 499
    assert adhoc.readonly_sql(spark, "WITH t AS (SELECT 1 AS a) SELECT a FROM t").first()["a"] == 1
    assert adhoc.readonly_sql(spark, "SELECT id FROM many", None).count() == 500
    assert adhoc.readonly_sql(spark, "SELECT id FROM many -- limit 300").count() == 200
    assert adhoc.readonly_sql(spark, "WITH t AS (SELECT id FROM many) SELECT a.id FROM t a JOIN t b USING (id)", None).count() == 500
    with pytest.raises(adhoc.Refused):
        adhoc.readonly_sql(spark, "SELECT nothing FROM nowhere")


def test_readonly_sql_reads_views_only(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    spark.range(5).createOrReplaceTempView("few")
    for text in (
        f"SELECT * FROM parquet.`{tmp_path}/t`", f"SELECT (SELECT max(id) FROM parquet.`{tmp_path}/t`) AS m FROM few",
        f"WITH t AS (SELECT * FROM parquet.`{tmp_path}/t`) SELECT * FROM t",
        "SELECT java_method('java.lang.System', 'currentTimeMillis')", "SELECT reflect('java.lang.Math', 'abs', id) FROM few",
    ):
        with pytest.raises(adhoc.Refused):
            adhoc.readonly_sql(spark, text)
    assert adhoc.readonly_sql(spark, "SELECT * FROM few", views=["FEW"]).count() == 5
    with pytest.raises(adhoc.Refused):
        adhoc.readonly_sql(spark, "SELECT * FROM few", views=["other"])


@pytest.fixture(scope="module")
def days(spark):
    return spark.createDataFrame(
        [(date(2024, 5, 15), Decimal("100"), 1, Decimal("90"), 2), (date(2024, 5, 2), Decimal("10"), 1, Decimal("0"), 0),
         (date(2023, 5, 15), Decimal("50"), 3, Decimal("20"), 1)],
        "day_date date, premium_received decimal(18,2), policies_issued int, claims_paid decimal(18,2), claim_count int",
    )


def test_period_summary(days):
    got = {r["window"]: r for r in dashboard.period_summary(days, date(2024, 5, 17)).collect()}
    assert set(got) == set(dashboard.WINDOWS)
    week, month = got["last_7_days"], got["month_to_date"]
    assert week["premium_received"] == 100 and week["premium_received_ly"] == 50
    assert week["loss_ratio"] == Decimal("0.9000") and week["loss_ratio_ly"] == Decimal("0.4000")
    assert month["premium_received"] == 110 and got["week_to_date"]["policies_issued"] == 1


def test_age_bands(spark):
    df = spark.createDataFrame([(date(2004, 5, 18),), (date(2004, 5, 17),), (date(1950, 1, 1),), (None,)], "b date")
    got = [r[0] for r in df.select(dashboard.age_band("b", F.lit(date(2024, 5, 17)))).collect()]
    assert got == ["under 20", "20-29", "60 and over", None]


def test_chunks_cover_the_whole_text(spark):
    words = [f"w{i}" for i in range(25)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "short\n text"), (3, "")], "doc_id long, text string")
    got = retrieval.chunk(docs, 10, 4).orderBy("doc_id", "chunk_no").collect()
    one = [r["text"].split(" ") for r in got if r["doc_id"] == 1]
    assert [c[0] for c in one] == ["w0", "w6", "w12", "w18"] and one[-1][-1] == "w24"
    assert all(a[-4:] == b[:4] for a, b in zip(one, one[1:]))
    assert [r["text"] for r in got if r["doc_id"] == 2] == ["short text"]
    assert [r["chunk_no"] for r in got if r["doc_id"] == 3] == [0]
    with pytest.raises(ValueError):
        retrieval.chunk(docs, 4, 4)


@pytest.mark.parametrize("per_pass", [1, 2, 256])
def test_nearest_vectors_equal_brute_force(spark, per_pass):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(60, 5))
    data[10] = data[11]  # a tie: the smaller id wins
    data[20] = 0  # no direction: never found
    vectors = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<float>"
    ).repartition(5)
    got = retrieval.top_k(vectors, vectors.where("vec_id IN (3, 10, 20)"), 4, 7, per_pass).orderBy("query_id", "rank").collect()
    data = data.astype("float32").astype("float64")
    for query in (3, 10):
        sims = data @ data[query] / (np.linalg.norm(data, axis=1) * np.linalg.norm(data[query]) + 1e-300)
        sims[20] = -2
        expected = sorted(range(60), key=lambda i: (-round(sims[i], 12), i))[:4]
        assert [r["vec_id"] for r in got if r["query_id"] == query] == expected
    assert not [r for r in got if r["query_id"] == 20]
