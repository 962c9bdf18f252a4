"""Conversation repair against a dynamic program that carries whole audits."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest

from harborline.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANK)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain(rows):
    """(cost, audit, repaired) of rows in order: the least of all ways, each carried whole."""
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", ())}

    def more(ways):
        ways, todo = dict(ways), list(ways)
        while todo:
            s = todo.pop()
            for to, name in (("u", "user"), ("a", "assistant")):
                if (s, to) in follow:
                    way = (ways[s][0] + 5, ways[s][1] + "I", (*ways[s][2], f"{name}:"))
                    if to not in ways or way < ways[to]:
                        ways[to] = way
                        todo.append(to)
        return ways

    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        after = {}
        for s, (cost, audit, said) in more(best).items():
            moves = [(s, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] and (s, role[0]) in follow:
                    moves.append((role[0], extra, "K", (f"{role}:{text}",)))
                for to, name in (("u", "user"), ("a", "assistant")):
                    if (s, to) in follow:
                        moves.append((to, extra + 1, "R", (f"{name}:{text}",)))
            for to, price, letter, line in moves:
                way = (cost + price, audit + letter, said + line)
                after[to] = min(after.get(to, way), way)
        best = after
    return min(way for s, way in more(best).items() if s in ("", "a"))


def summary(rows):
    fault = faults(rows)
    cost, audit, said = plain(rows)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = itertools.pairwise([r[:1] for _, r, _ in rows])
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": fault.count("blank"),
        "duplicate": fault.count("duplicate"), "truncated": fault.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in pairs), "cost": cost, "audit": audit,
        "sha": hashlib.sha256("\n".join(said).encode()).hexdigest(),
    }


def check(spark, rows, parts=4):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role or "", text or ""))
    done = repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    digests = {r.conv: r.repaired_sha256 for r in done.digests().collect()}
    got = {r.conv: r.asDict() for r in done.conversations.collect()}
    assert set(got) == set(by_conv)
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        want, found = summary(own), got[conv]
        found["sha"] = digests.get(conv, hashlib.sha256(b"").hexdigest())
        assert {k: found[k] for k in want} == want, (conv, own)


def random_rows(rng, conv, n):
    """Turns differ, but for repeats of a row, so the order of rows is plain."""
    rows, turn = [], rng.randint(-3, 3)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    for _ in range(n):
        turn += rng.choice((1, 1, 1, 2))
        row = (conv, turn, rng.choice(roles), rng.choice(["Yes.", "No", "", " \t", "What?", f"n {rng.randint(0, 9)}!", f"m {turn}"]))
        rows += [row] * rng.choice((1, 1, 1, 1, 2, 3))
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 3, 4096])
def test_random_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rng = random.Random(chunk)
    check(spark, [r for c in range(120) for r in random_rows(rng, c, rng.randint(1, 12))])


def test_every_short_conversation(spark):
    texts = ("Fine.", "cut")
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in texts] + [("user", "")]
    rows = []
    for conv, own in enumerate(k for n in (1, 2, 3) for k in itertools.product(kinds, repeat=n)):
        rows += [(conv, i, role, f"{i} {text}" if text else "") for i, (role, text) in enumerate(own)]
    check(spark, rows)


def test_one_conversation_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 50)
    rng = random.Random(9)
    rows = random_rows(rng, 1, 900) + [(1, 10**6 + i, "user", "Again.") for i in range(300)]
    rows += [r for c in range(2, 30) for r in random_rows(rng, c, 6)]
    check(spark, rows, parts=6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows, parts=6)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_crossings_take_linear_space():
    kinds = random.Random(2).choices(["u", "a", "a!", "s", "x", "-", "u!"], k=3000)
    steps = [repair.row_step(k) for k in kinds]
    for leave in (repair.START, repair.ASSISTANT):
        states = repair.crossings(steps, repair.START, leave)
        cost = sum(s.cost[4 * a + b] for s, a, b in zip(steps, states, states[1:], strict=False))
        low, whole = repair.joined(steps)
        assert cost == low + whole.cost[leave]


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, None, "user", "Hi."), (None, 3, "assistant", "Ho."), (1, None, "user", "x" * 300_000 + "."),
        (1, None, "assistant", None), (2, 5, None, "Hm."), (3, 1, "user", "Same."), (3, 1, "user", "Same."), (4, 1, "user", "İs\x1c"),
    ]
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role or "", text or ""))
    frame = spark.createDataFrame(rows, SCHEMA)
    done = repair.repair(frame)
    got = {r.conv: r for r in done.conversations.collect()}
    assert set(got) == set(by_conv) and got[3].duplicate == 1 and got[2].audit == "D" and got[None].gaps == 0
    named = "conv a b fp kind copies part chunk place first later blank cut entry leave tail audit gaps cost rank".split()
    from pyspark.sql import functions as F

    more = repair.repair(frame.select("*", *[F.lit(i).alias(n) for i, n in enumerate(named)]))
    assert {str(r) for r in more.conversations.collect()} == {str(r) for r in got.values()}
    empty = repair.repair(frame.where("false"))
    assert empty.conversations.count() == empty.rows.count() == empty.digests().count() == 0


def test_repaired_rows_read_as_the_grammar(spark):
    rng = random.Random(11)
    rows = [r for c in range(60) for r in random_rows(rng, c, 10)]
    done = repair.repair(spark.createDataFrame(rows, SCHEMA))
    said = defaultdict(list)
    for r in sorted(done.rows.collect(), key=lambda r: (r.conv, r.part, r.chunk, r.place)):
        said[r.conv].append(r.role[:1])
    assert said and all(GRAMMAR.match("".join(roles)) for roles in said.values())
