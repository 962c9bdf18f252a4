"""Winnowing against a plain loop over all windows."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from harborline.llm import winnow

SF = "/root/testdata/sf0.001"


def signed(v):
    v &= (1 << 64) - 1
    return v - (1 << 64) if v >> 63 else v


def gram_hash(gram):
    return signed(xxhash.xxh64_intdigest(gram.encode(), 42) << winnow.PLACE_BITS) >> winnow.PLACE_BITS


def plain_marks(text, gram=16, window=16):
    hashes = [gram_hash(text[i : i + gram]) for i in range(len(text) - gram + 1)] or ([gram_hash(text)] if text else [])
    out = []
    for start in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = hashes[start : start + window]
        least = min(part)
        place = start + max(i for i, h in enumerate(part) if h == least)
        if not out or out[-1][0] != place:
            out.append((place, least))
    return out


def alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def sample_texts():
    rng = random.Random(3)
    texts = ["", "a", "a" * 15, "a" * 16, "a" * 31, "a" * 5000, "ab" * 1500, "日本語😀é" * 700]
    for n in (15, 16, 17, 30, 31, 32, 1023, 1024, 1025, 1054, 1055, 1056, 2048, 2078, 2079, 3000):
        texts.append("".join(rng.choice("abc é\n") for _ in range(n)))
    return texts


@pytest.mark.parametrize("gram,window", [(16, 16), (5, 4), (1, 1), (7, 10), (12, 100)])
def test_marks(spark, gram, window):
    texts = sample_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in winnow.fingerprints(frame, gram=gram, window=window).collect():
        assert [tuple(m) for m in r.marks] == plain_marks(texts[r.doc_id], gram, window), (r.doc_id, gram, window)


def test_a_shared_passage_leaves_a_shared_mark(spark):
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = letters(winnow.GRAM + winnow.WINDOW - 1)
    texts = [letters(rng.randint(0, 3000)) + passage + letters(rng.randint(0, 500)) for _ in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = []
    for r in winnow.fingerprints(frame).collect():
        at = texts[r.doc_id].index(passage)
        found.append({(m.position - at, m.hash) for m in r.marks if at <= m.position <= at + winnow.WINDOW - 1})
    assert set.intersection(*found)


def check(texts, rows):
    """``texts`` in order of the documents, ``rows`` by document."""
    names = {}
    for i, (doc, text) in enumerate(texts):
        follower, quarter, got = texts[(i + 1) % len(texts)][1], len(text) // 4, rows[doc]
        edited = text[: len(text) - quarter] + follower[:quarter]
        own = plain_marks(text)
        assert (got.n_chars, got.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert got.near_edited == pytest.approx(alike(own, plain_marks(edited)), abs=1e-12)
        assert got.near_next == pytest.approx(alike(own, plain_marks(follower)), abs=1e-12)
        names.setdefault(tuple(own), set()).add(got.fingerprint)
        names.setdefault(tuple(plain_marks(edited)), set()).add(got.edited_fingerprint)
    assert all(len(n) == 1 for n in names.values()) and len(set.union(*names.values())) == len(names)


def told(frame):
    return winnow.edited_likeness(frame).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), winnow.name(F.col("blocks")).alias("fingerprint"),
        winnow.name(F.col("edited_blocks")).alias("edited_fingerprint"), "near_edited", "near_next").collect()


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = entry.queries()["op11_document_fingerprints"](spark, SF).collect()
    assert len(rows) == len(docs)
    check(sorted((r.doc_id, r.text or "") for r in docs), {r.doc_id: r for r in rows})


def test_neighbours_across_many_groups(spark, monkeypatch):
    monkeypatch.setattr(winnow, "GROUP", 3)
    rng = random.Random(5)
    ids = rng.sample(range(-(10**6), 10**6), 60) + [-(2**62), 2**62, 2**62 + 1]
    texts = {i: "".join(rng.choice("abc ") for _ in range(rng.randint(0, 1500))) for i in ids}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    check(sorted(texts.items()), {r.doc_id: r for r in told(frame)})


def test_one_id_in_most_rows(spark, monkeypatch):
    monkeypatch.setattr(winnow, "GROUP", 2)
    rng = random.Random(6)
    rows = [(7 if i % 3 else i, "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 90)))) for i in range(120)]
    rows += [(None, f"no id {i}, some more words to have a gram") for i in range(20)] + [(7, "twice " * 9)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = winnow.with_next(frame).select("doc_id", "text", "next_text").collect()
    assert len(got) == len(rows)
    ordered = winnow.with_next(frame).select("text").collect()
    assert sorted(r.text for r in ordered) == sorted(t for _, t in rows)
    assert sorted(r.next_text for r in got) == sorted(t for _, t in rows)  # each row follows exactly one
    by_text = {r.text: r.next_text for r in got if r.text != "twice " * 9}
    unique = {t: d for d, t in rows}
    for text, after in by_text.items():  # the next row has the same id or the next greater one
        if text in unique and after in unique and unique[text] is not None and unique[after] is not None:
            assert unique[after] >= unique[text] or unique[text] == max(d for d, _ in rows if d is not None)
    assert [r.next_text for r in got if r.text == "twice " * 9].count("twice " * 9) == 1


def test_main_path_is_native(spark):
    plan = entry.queries()["op11_document_fingerprints"](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "RDD"))


def test_odd_rows(spark, odd, crowded, nothing):
    got = told(odd)
    assert len(got) == 14 and {r.fingerprint for r in got if r.n_chars == 0} == {r.fingerprint for r in got if r.doc_id == 2}
    assert sorted(map(str, told(crowded))) == sorted(map(str, got))
    assert told(nothing) == [] and winnow.fingerprints(nothing).count() == 0
    assert len({r.fingerprint for r in got if r.doc_id in (4, 5)}) == 1
    one = told(odd.where("doc_id = 4"))
    assert one[0].near_next == 1.0
