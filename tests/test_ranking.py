"""Ranks of a user's policies, with busy days cut into slots."""

import random
from datetime import datetime, timedelta

import pytest

from harborline.operators import ranking

SHAPE = "id bigint, policy_number {}, user_id int, effective_date timestamp"


def plain(rows):
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3] is None, r[3] or datetime.min, r[1] is None, r[1] or type(r[1] or 0)(), r[0]))
    seen, out = {}, {}
    for r in order:
        seen[r[2]] = seen.get(r[2], 0) + 1
        out[r[0]] = seen[r[2]]
    return out


def rows(rng, n, number):
    at = datetime(2024, 1, 1)
    return [
        (i, number(rng.randint(-50, 400)) if rng.random() < 0.95 else None, rng.choice([1, 1, 1, 2, None]),
         rng.choice([None, at, at + timedelta(hours=rng.randint(0, 60)), at + timedelta(days=rng.randint(0, 3))]))
        for i in range(n)
    ]


@pytest.mark.parametrize("busy,slot", [(10, 16), (0, 1), (100_000, 1 << 16)])
def test_ranks_however_days_are_cut(spark, monkeypatch, busy, slot):
    monkeypatch.setattr(ranking, "BUSY_DAY", busy)
    monkeypatch.setattr(ranking, "SLOT", slot)
    made = rows(random.Random(busy), 600, int)
    got = ranking.rank_policies(spark.createDataFrame(made, SHAPE.format("bigint")).repartition(4)).collect()
    assert {r.id: r.policy_rank for r in got} == plain(made) and len(got) == len(made)
    assert all(r.is_new_policy == (r.policy_rank == 1) for r in got)


def test_policy_numbers_that_are_text(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUSY_DAY", 5)
    made = rows(random.Random(4), 200, lambda n: f"P{n % 50:03d}")
    got = ranking.rank_policies(spark.createDataFrame(made, SHAPE.format("string"))).collect()
    assert {r.id: r.policy_rank for r in got} == plain([(a, b or None, c, d) for a, b, c, d in made])


def test_a_busy_day_is_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUSY_DAY", 100)
    monkeypatch.setattr(ranking, "SLOT", 64)
    made = spark.range(2000).selectExpr("id", "id * 3 % 2003 AS policy_number", "7 AS user_id", "cast(NULL AS timestamp) AS effective_date")
    got = {r.policy_number: r.policy_rank for r in ranking.rank_policies(made).collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(got))} and len(got) == 2000
