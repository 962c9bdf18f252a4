"""Exact nearest vectors, the inverted file, and drifting schemas found by halves."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harborline.operators import retrieval, scoring
from harborline.sources import drift

SHAPE = "vec_id bigint, embedding array<float>"


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16)) * 4
    rows = [(i, (centres[i % 30] + rng.normal(size=16)).tolist()) for i in range(1500)]
    odd = [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] + [1.0] * 15)]
    return spark.createDataFrame(rows + odd, SHAPE)


def asked(vectors):
    return vectors.where("vec_id % 20 = 0 OR vec_id >= 5000")


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.similarity, 9)))
    return out


def test_vectors_without_a_direction_are_nobodys_neighbours(clustered):
    got = by_query(retrieval.top_k(clustered, asked(clustered), 3))
    assert set(got) == set(range(0, 1500, 20))
    assert all(len(hits) == 3 and hits[0][0] == q and all(v < 5000 for v, _ in hits) for q, hits in got.items())
    assert retrieval.top_k(clustered.where("vec_id >= 5000"), asked(clustered), 3).count() == 0


def test_index_holds_every_vector_and_finds_most(spark, clustered, tmp_path):
    path = str(tmp_path / "index")
    retrieval.build_index(clustered, path, lists=24, block_rows=32)
    held = spark.read.parquet(f"{path}/lists")
    ids = [r[0] for r in held.select(F.explode("v_rows.vec_id")).collect()]
    assert sorted(ids) == sorted(r.vec_id for r in clustered.select("vec_id").collect())
    nowhere = held.where(F.col("list") == retrieval.NOWHERE).select(F.explode("v_rows.vec_id")).collect()
    assert sorted(r[0] for r in nowhere) == [5000, 5001, 5002, 5003]
    queries = asked(clustered)
    exact = retrieval.top_k(clustered, queries, 10)
    few = retrieval.recall(retrieval.search_index(spark, path, queries, 10, probes=4), exact).first()
    assert few["queries"] == 75 and few["recall"] >= 0.9
    whole = retrieval.search_index(spark, path, queries, 10, probes=24, query_rows=16)
    assert by_query(whole) == by_query(exact)


def test_index_on_a_bounded_sample_and_on_nothing(spark, clustered, tmp_path):
    centroids = retrieval.fit_centroids(clustered, 8, sample_rows=200)
    assert centroids.shape == (8, 16)
    for name, vectors in (("none", clustered.where("false")), ("odd", clustered.where("vec_id >= 5000"))):
        path = str(tmp_path / name)
        retrieval.build_index(vectors, path, lists=4)
        assert retrieval.search_index(spark, path, asked(clustered), 5).count() == 0


def test_a_search_leaves_k_rows_per_task_not_per_block(spark, clustered, monkeypatch, tmp_path):
    monkeypatch.setattr(retrieval, "_ranked", lambda found, k: found)
    queries, spans = asked(clustered), 4 * spark.sparkContext.defaultParallelism
    assert retrieval.top_k(clustered, queries, 10, block_rows=8).count() <= 75 * spans * 10
    path = str(tmp_path / "index")
    retrieval.build_index(clustered, path, lists=24, block_rows=4)
    assert retrieval.search_index(spark, path, queries, 10, probes=24).count() <= 75 * spans * 10


def test_directions():
    rows = [[3.0, 4.0], None, [0.0, 0.0], [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [0.0, -2.0]]
    places, units = scoring.directions(pa.array(rows, pa.list_(pa.float32())))
    assert places.tolist() == [0, 7] and units.tolist() == [[0.6, 0.8], [0.0, -1.0]]
    for nobody in ([], [None], [None, []]):
        places, units = scoring.directions(pa.array(nobody, pa.list_(pa.float32())))
        assert len(places) == len(units) == 0


@pytest.mark.parametrize("held, block_rows, query_rows", [(16_384, 1024, 256), (7, 16, 3), (20, 5, 64)])
def test_exact_neighbours_by_brute_force(spark, monkeypatch, tmp_path, held, block_rows, query_rows):
    """Copies and vectors that differ by less than single precision tells, however queries and vectors are dealt."""
    monkeypatch.setattr(retrieval, "HELD", held)
    rng = np.random.default_rng(held)
    base = rng.normal(size=(40, 8))
    vectors = np.concatenate([base, base, base + 1e-9 * rng.normal(size=base.shape), np.repeat(base[:1], 60, axis=0), 3 * base])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [0.0] * 8), (902, [])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    queries = frame.where("vec_id < 50 OR vec_id >= 900")
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    want = np.sort(unit[:50] @ unit.T, axis=1)[:, ::-1][:, :7]
    path = str(tmp_path / "index")
    retrieval.build_index(frame, path, lists=6, block_rows=block_rows)
    for found in (
        retrieval.top_k(frame, queries, 7, block_rows, query_rows),
        retrieval.search_index(spark, path, queries, 7, probes=6, query_rows=query_rows),
    ):
        got = {}
        for r in sorted(found.collect(), key=lambda r: r["rank"]):
            assert abs(unit[r.query_id] @ unit[r.vec_id] - r.similarity) < 1e-14
            got.setdefault(r.query_id, []).append((-r.similarity, r.vec_id))
        assert set(got) == set(range(50)) and all(hits == sorted(hits) for hits in got.values())
        assert np.abs(np.array([[-s for s, _ in got[q]] for q in range(50)]) - want).max() < 1e-14
    hot = [v for _, v in got[0]]
    assert len(set(hot)) == 7  # sixty copies of one vector: seven of them, none twice


def test_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.1]), (2, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = retrieval.top_k(frame, frame.where("vec_id = 2 OR vec_id IS NULL"), 4).collect()
    assert sorted((r.query_id or 0, r["rank"], r.vec_id) for r in got if r.query_id == 2) == [(2, 1, 2), (2, 2, None), (2, 3, 1), (2, 4, 1)]
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id is None] == [None, 1, 1, 2]


def test_schemas_cost_jobs_by_run_not_by_file(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    for i in range(40):
        kind = "int" if i < 23 else "double"
        more = ", 'x' AS extra" if i >= 30 else ""
        spark.sql(f"SELECT {i} AS id, CAST({i} AS {kind}) AS fee{more}").coalesce(1).write.parquet(f"{base}/m={i:02d}")
    calls, real = [], drift._merged

    def counted(reader, files):
        calls.append(len(files))
        return real(reader, files)

    monkeypatch.setattr(drift, "_merged", counted)
    got = drift.read_drifting(spark, [base])
    assert len(calls) < 16 and dict(got.dtypes) == {"id": "int", "fee": "double", "extra": "string", "m": "int"}
    assert sorted((r.id, r.fee, r.extra, r.m) for r in got.collect() if r.id in (0, 22, 23, 39)) == [
        (0, 0.0, None, 0), (22, 22.0, None, 22), (23, 23.0, None, 23), (39, 39.0, "x", 39)]
    assert got.count() == 40 and plan_scans(got) == 2


def plan_scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_paths_that_begin_alike_stay_apart(spark, tmp_path):
    for name, value in (("a", 1), ("ab", 2), ("a/b", 3)):
        spark.sql(f"SELECT {value} AS id").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    assert sorted(r.id for r in drift.read_drifting(spark, [str(tmp_path / "ab")]).collect()) == [2]
    both = drift.read_drifting(spark, [str(tmp_path / "a"), str(tmp_path / "ab")])
    assert sorted(r.id for r in both.collect()) == [1, 2, 3]
    with pytest.raises(PySparkException):
        drift.read_drifting(spark, [str(tmp_path / "missing")])
