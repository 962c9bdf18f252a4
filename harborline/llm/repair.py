"""Conversation structure repair: the cheapest edits that make a conversation alternate, by divide and conquer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import BATCHES, fingerprint, stored

#: Costs of edits; an undeleted truncated row costs ``CUT`` more.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: Distinct rows of a conversation that are repaired together, and chunks that are unpacked at once.
CHUNK, SLICE = 4096, 16
#: What may come before a row and happen to it, in ASCII order; no one begins another, so audits of the same rows compare by rank.
LETTERS = ("D", "IK", "IR", "K", "R")
#: States: nothing yet, behind a system, user and assistant row; how each is brought to an accepted end.
START, SYSTEM, USER, ASSISTANT = range(4)
TAIL = ("", "II", "I", "")
NEXT = {("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT, ("s", START): SYSTEM}
INSERTED = {("u", USER): "assistant", ("a", START): "user", ("a", SYSTEM): "user", ("a", ASSISTANT): "user"}
NAMES = {"u": "user", "a": "assistant"}
NEVER = 1 << 60


class Step(NamedTuple):
    """For each state before (major) and after: the least cost, and the rank of its least audit among the others'."""

    cost: tuple[int, ...]
    rank: tuple[int, ...]


def _choices(initial: str, forced: bool, cut: bool) -> dict[tuple[int, int], tuple[int, int, str]]:
    """(before, after) -> (cost, letters as place in ``LETTERS``, initial of the row as kept)."""
    best = {(s, s): (DELETE, 0, "") for s in range(4)}
    if forced:
        return best
    for to in "sua":
        if to == "s" and initial != "s":
            continue
        own, letter = (0, "K") if to == initial else (REROLE, "R")
        for before in range(4):
            insert = (to, before) in INSERTED
            if not insert and (to, before) not in NEXT:
                continue
            after = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[to]
            told = (own + CUT * cut + INSERT * insert, LETTERS.index("I" * insert + letter), to)
            best[before, after] = min(best.get((before, after), told), told)
    return best


@lru_cache(None)
def choices(kind: str) -> dict[tuple[int, int], tuple[int, int, str]]:
    """A row's choices; ``kind`` is the initial of its role (``-`` for any other), with ``!`` when truncated, or ``x`` for a forced deletion."""
    return _choices(kind[0], kind == "x", kind.endswith("!"))


@lru_cache(None)
def row_step(kind: str) -> Step:
    told = choices(kind)
    pairs = [told.get((i, j), (NEVER, 9, "")) for i in range(4) for j in range(4)]
    return Step(tuple(c for c, _, _ in pairs), tuple(r for _, r, _ in pairs))


@lru_cache(1 << 16)
def _joined(a: Step, b: Step) -> tuple[int, Step]:
    """Two steps in a row: (cost taken out, step); ranks are renumbered, so that few steps differ."""
    found = []
    for i in range(4):
        for j in range(4):
            through = [(a.cost[4 * i + k] + b.cost[4 * k + j], a.rank[4 * i + k], b.rank[4 * k + j]) for k in range(4)]
            best = min(through)
            found.append(best if best[0] < NEVER else (NEVER, -1, -1))
    low = min(c for c, _, _ in found)
    order = {key: n for n, key in enumerate(sorted({f[1:] for f in found}))}
    return low, Step(tuple(c - low if c < NEVER else NEVER for c, _, _ in found), tuple(order[f[1:]] for f in found))


IDENTITY = Step(tuple(0 if i == j else NEVER for i in range(4) for j in range(4)), (0,) * 16)


def joined(steps) -> tuple[int, Step]:
    total, step = 0, IDENTITY
    for s in steps:
        low, step = _joined(step, s)
        total += low
    return total, step


@lru_cache(1 << 16)
def _forward(vector: tuple, step: Step) -> tuple:
    """Costs and audit ranks of the four states one step later; costs are relative, since only their order matters."""
    found = []
    for j in range(4):
        best = min((vector[k][0] + step.cost[4 * k + j], vector[k][1], step.rank[4 * k + j]) for k in range(4))
        found.append(best if best[0] < NEVER else (NEVER, -1, -1))
    return _relative(found)


@lru_cache(1 << 16)
def _backward(vector: tuple, step: Step) -> tuple:
    found = []
    for i in range(4):
        best = min((step.cost[4 * i + k] + vector[k][0], step.rank[4 * i + k], vector[k][1]) for k in range(4))
        found.append(best if best[0] < NEVER else (NEVER, -1, -1))
    return _relative(found)


def _relative(found: list[tuple[int, int, int]]) -> tuple:
    low = min(c for c, _, _ in found)
    order = {key: n for n, key in enumerate(sorted({f[1:] for f in found}))}
    return tuple((c - low if c < NEVER else NEVER, order[a, b]) for c, a, b in found)


def _only(state: int) -> tuple:
    return tuple((0 if s == state else NEVER, 0) for s in range(4))


def crossings(steps: list[Step], entry: int, leave: int) -> list[int]:
    """The states before, between and after ``steps`` on the cheapest way, of several the one with the least audit.

    Hirschberg's scheme: four costs from the front and four from the back meet in the middle, the best crossing splits
    the steps into two problems of half the size. Only four-state vectors are held besides the answer.
    """
    states = [entry] * len(steps) + [leave]
    open_parts = [(0, len(steps))]
    while open_parts:
        low, high = open_parts.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        front, back = _only(states[low]), _only(states[high])
        for s in steps[low:middle]:
            front = _forward(front, s)
        for s in reversed(steps[middle:high]):
            back = _backward(back, s)
        states[middle] = min(range(4), key=lambda k: (front[k][0] + back[k][0], front[k][1], back[k][1]))
        open_parts += [(low, middle), (middle, high)]
    return states


@dataclass
class Chunk:
    """Rows of one conversation in order; equal rows are one with a number of copies."""

    conv: object
    number: int
    rows: list[tuple] = field(default_factory=list)  # turn, role, a, b, kind, copies

    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0))
    before: tuple | None = None  # turn and initial of the row before

    def add(self, turn, role: str, a: int, b: int, blank: bool, cut: bool, later: bool, copies: int) -> None:
        initial, n = role[:1], self.counts
        n["blank"] += copies * blank
        n["duplicate"] += 0 if blank else copies - (not later)
        n["truncated"] += not blank and not later and cut
        n["illegal"] += copies - 1
        if self.rows:
            n["illegal"] += illegal(self.before[1], initial)
        n["turns"] += turn is not None and (not self.rows or turn != self.before[0])
        self.before = turn, initial
        kind = "x" if blank or later else (initial if initial in ("s", "u", "a") else "-") + "!" * cut
        self.rows.append((turn, role, a, b, kind, copies))


def illegal(left: str, right: str) -> bool:
    return left + right not in ("su", "ua", "au")


def _steps(kinds: list[str]) -> list[Step]:
    return [row_step(k) for k in kinds]


def _chunked(schema: pa.Schema):
    """Sorted rows -> chunks, each with its step (16 costs and ranks) and what it takes to join it to its neighbours."""

    def told(chunk: Chunk) -> dict:
        turn, role, a, b, kind, copies = zip(*chunk.rows, strict=True)
        low, step = joined(_steps(kind))
        real = [t for t in turn if t is not None]
        return chunk.counts | {
            "conv": chunk.conv, "part": TaskContext.get().partitionId(), "chunk": chunk.number, "turn": turn, "role": role,
            "a": a, "b": b, "kind": kind, "copies": copies, "low": low + DELETE * (sum(copies) - len(copies)),
            "cost": step.cost, "rank": step.rank, "first_initial": role[0][:1], "last_initial": role[-1][:1],
            "first_turn": turn[0], "last_turn": turn[-1], "min_turn": min(real, default=None), "max_turn": max(real, default=None),
        }

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, out, held = None, [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if chunk is None or row[0] != chunk.conv or len(chunk.rows) >= CHUNK:
                    if chunk:
                        out.append(told(chunk))
                        held += len(chunk.rows)
                    chunk = Chunk(row[0], chunk.number + 1 if chunk else 0)
                chunk.add(*row[1:])
                if held >= CHUNK:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
        if chunk:
            out.append(told(chunk))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return chunks


def _crossed(schema: pa.Schema):
    """Chunks of a conversation in order, without their rows -> the states around each; totals with the last one."""

    def settled(chunks: list[dict]) -> list[dict]:
        steps = [Step(tuple(c["cost"]), tuple(c["rank"])) for c in chunks]
        low, whole = joined(steps)
        cost, _, tail, leave = min((whole.cost[s] + INSERT * len(TAIL[s]), whole.rank[s], TAIL[s], s) for s in range(4))
        states = crossings(steps, START, leave)
        total = {n: sum(c[n] for c in chunks) for n in ("blank", "duplicate", "truncated", "illegal", "turns")}
        for left, right in zip(chunks, chunks[1:]):
            total["illegal"] += illegal(left["last_initial"], right["first_initial"])
            total["turns"] -= right["first_turn"] is not None and left["last_turn"] == right["first_turn"]
        lows = [c["min_turn"] for c in chunks if c["min_turn"] is not None]
        highs = [c["max_turn"] for c in chunks if c["max_turn"] is not None]
        total["gaps"] = max(highs) - min(lows) + 1 - total["turns"] if lows else 0
        total["cost"] = low + cost + sum(c["low"] for c in chunks)
        out = [{"conv": c["conv"], "part": c["part"], "chunk": c["chunk"], "entry": states[i], "leave": states[i + 1], "tail": ""}
               for i, c in enumerate(chunks)]
        out[-1] |= total | {"tail": tail}
        return out

    def crossed(batches):
        own, out = [], []
        for batch in batches:
            for c in batch.to_pylist():
                if own and own[0]["conv"] != c["conv"]:
                    out += settled(own)
                    own = []
                own.append(c)
                if len(out) >= CHUNK:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if own:
            out += settled(own)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return crossed


def _edited(schema: pa.Schema):
    """Chunks with their states -> a row per row that stays or is inserted, and one with the chunk's audit."""

    def edits(c: dict) -> Iterator[dict]:
        at = {"conv": c["conv"], "part": c["part"], "chunk": c["chunk"]}
        states, audit = crossings(_steps(c["kind"]), c["entry"], c["leave"]), []
        for i, kind in enumerate(c["kind"]):
            _, letters, to = choices(kind)[states[i], states[i + 1]]
            audit.append(LETTERS[letters] + "D" * (c["copies"][i] - 1))
            if not to:
                continue
            if LETTERS[letters][0] == "I":
                yield at | {"place": 2 * i, "new_role": INSERTED[to, states[i]]}
            role = c["role"][i]
            new = role if LETTERS[letters][-1] == "K" else NAMES[to]
            yield at | {"place": 2 * i + 1, "new_role": new, "turn": c["turn"][i], "role": role, "a": c["a"][i], "b": c["b"][i]}
        for k in range(len(c["tail"])):
            yield at | {"place": 2 * len(c["kind"]) + k, "new_role": ("user", "assistant")[(k + 2 - len(c["tail"]))]}
        yield at | {"place": -1, "audit": "".join(audit) + c["tail"]}

    def edited(batches):
        out = []
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                for c in batch.slice(k, SLICE).to_pylist():
                    out += edits(c)
                if len(out) >= CHUNK:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return edited


def _hashed(schema: pa.Schema):
    """Repaired rows in order -> the digest of each conversation, read as a stream."""

    def hashed(batches):
        conv, digest, out = None, None, []
        for batch in batches:
            for own, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")], strict=True):
                if digest is None or own != conv:
                    if digest:
                        out.append({"conv": conv, "repaired_sha256": digest.hexdigest()})
                    conv, digest = own, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if len(out) >= CHUNK:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if digest:
            out.append({"conv": conv, "repaired_sha256": digest.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return hashed


def _passed(df: DataFrame, fn, shape: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return df.mapInArrow(fn(to_arrow_schema(_parse_datatype_string(shape))), shape)


def _met(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Joined on columns of the same names, NULL meeting NULL; the right side adds its other columns."""
    right = right.withColumnsRenamed({n: f"__{n}" for n in names})
    met = F.lit(True)
    for n in names:
        met &= left[n].eqNullSafe(right[f"__{n}"])
    return left.join(right, met, how).drop(*[f"__{n}" for n in names])


@dataclass
class Repaired:
    conversations: DataFrame  #: conv, gaps, blank, duplicate, truncated, illegal, cost, audit
    rows: DataFrame  #: conv, part, chunk, place (order of rows), role, text

    def digests(self) -> DataFrame:
        """(conv, repaired_sha256): of a conversation's ``role:text``, joined by newlines; none where no row is left."""
        kind = self.rows.schema["conv"].dataType.simpleString()
        order = ["conv", "part", "chunk", "place"]
        dealt = self.rows.repartition("conv").sortWithinPartitions(*order)
        return _passed(dealt, _hashed, f"conv {kind}, repaired_sha256 string")


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """The cheapest edits after which role initials read ``(s?(ua)+)?``, the ASCII-least ones where several cost the same.

    Rows are taken by turn (NULL first), then role and a hash of the text. A row's first fault counts: blank (nothing but
    [\\x20\\x09-\\x0D]), duplicate (role and text seen earlier), truncated (its last other character is none of ``.!?``).
    Keep costs 0, rerole to user or assistant 1, delete 2 (blank and duplicate rows have to go), insert an empty user or
    assistant row 5; a truncated row that stays costs 5 more. ``audit`` holds the edits' initials in order. ``gaps`` counts
    missing turns between least and greatest, ``illegal`` neighbours whose initials are not su, ua or au, both before edits.

    Equal rows become one with a count before anything is dealt out, and the first turn of a (role, text) is found by an
    aggregation. Sorted rows are cut into chunks of ``CHUNK``, so a conversation of any length is spread over tasks; a
    chunk is told by a 4 x 4 table of costs and audit ranks. A task sees one conversation's tables (a 4096th of its rows),
    finds the states between chunks by Hirschberg's scheme, and each chunk is then solved by the same scheme from its two
    states. Texts join at the end, to the rows that stay.

    NULL role or text is empty; a NULL conversation is one of its own. Other columns are not returned. An empty table
    gives empty tables.
    """
    spark = turns.sparkSession
    blank, end = "[^\\x20\\x09-\\x0D]", "[.!?][\\x20\\x09-\\x0D]*\\z"
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).withColumn("fp", fingerprint(F.col("text"))).select("conv", "turn", "role", "fp.a", "fp.b", "text")
    key = ["conv", "turn", "role", "a", "b"]
    facts = rows.select(*key, (~F.col("text").rlike(blank)).alias("blank"), (~F.col("text").rlike(end)).alias("cut"))
    merged = stored(facts.groupBy(*key, "blank", "cut").agg(F.count("*").alias("copies")), "turns")
    first = merged.groupBy("conv", "role", "a", "b").agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("first"))
    known = _met(merged, first, ["conv", "role", "a", "b"], "left")
    listed = known.select(*key, "blank", "cut", (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("later"), "copies")
    ordered = listed.repartitionByRange(*key).sortWithinPartitions(*key)

    kind = rows.schema["conv"].dataType.simpleString()
    sums = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint"
    place = f"conv {kind}, part int, chunk int"
    tables = (
        f"{place}, {sums}, low bigint, cost array<bigint>, rank array<int>, first_initial string, last_initial string, "
        "first_turn bigint, last_turn bigint, min_turn bigint, max_turn bigint"
    )
    lists = "turn array<bigint>, role array<string>, a array<bigint>, b array<bigint>, kind array<string>, copies array<bigint>"
    _limit_batches(spark)
    chunks = stored(_passed(ordered, _chunked, f"{tables}, {lists}"), "chunks")
    told = chunks.drop("turn", "role", "a", "b", "kind", "copies").repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    crossed = stored(
        _passed(told, _crossed, f"{place}, entry int, leave int, tail string, {sums}, gaps bigint, cost bigint"), "crossings")
    met = _met(
        chunks.select("conv", "part", "chunk", "turn", "role", "a", "b", "kind", "copies"),
        crossed.select("part", "chunk", "entry", "leave", "tail"), ["part", "chunk"])
    edits = stored(
        _passed(met, _edited, f"{place}, place int, new_role string, turn bigint, role string, a bigint, b bigint, audit string"),
        "edits")

    audits = edits.where("place = -1").groupBy("conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "chunk", "audit"))), lambda c: c["audit"]), "").alias("audit"))
    totals = crossed.where("gaps IS NOT NULL").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    conversations = _met(totals, audits, ["conv"])

    kept, texts = edits.where("a IS NOT NULL"), rows.dropDuplicates(key)
    order = ["conv", "part", "chunk", "place"]
    back = _met(kept, texts, key).select(*order, F.col("new_role").alias("role"), "text")
    new = edits.where("a IS NULL AND place >= 0").select(*order, F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repaired(conversations, back.unionByName(new))


def _limit_batches(spark) -> None:
    for name, (default, limit) in BATCHES.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, limit)
