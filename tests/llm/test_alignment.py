"""Cross-tokenizer alignment against whole-text encoding and a plain walk over byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
from harborline.llm import alignment

SF = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
EMPTY = (0, 0, 0, [], "")


@pytest.fixture(scope="module")
def own():
    return alignment.Aligner(*PATHS)


def plain(own, text):
    """n_a, n_b, n_groups, links, digest; both tokenizers see the whole text."""
    raw = (" " + (text or "")).encode()
    a, b = own.a.encode(raw.decode(), add_special_tokens=False).ids, own.b.encode(text or "")
    same = all(b"".join(table[i] for i in ids) == raw for ids, table in ((a, own.bytes_a), (b, own.bytes_b)))
    if not text or not same:
        return EMPTY
    links, groups, i, j, part, end_a, end_b = [], [], 0, 0, ([], []), len(own.bytes_a[a[0]]), len(own.bytes_b[b[0]])
    while True:
        links.append((a[i], b[j]))
        step_a, step_b, both = end_a <= end_b, end_b <= end_a, end_a == end_b
        if step_a:
            part[0].append(a[i])
            i += 1
            end_a += len(own.bytes_a[a[i]]) if i < len(a) else 0
        if step_b:
            part[1].append(b[j])
            j += 1
            end_b += len(own.bytes_b[b[j]]) if j < len(b) else 0
        if both:
            groups.append("|".join(",".join(map(str, side)) for side in part))
            part = ([], [])
        if i == len(a):
            return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def check(own, texts, rows):
    want = [plain(own, t) for _, t in texts]
    counts, most = Counter(p for w in want for p in w[3]), defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    expected = Counter(
        (doc, *w[:3], len(w[3]), sum(counts[p] == most[p[1]] for p in w[3]), sum(counts[p] for p in w[3]), w[4])
        for (doc, _), w in zip(texts, want, strict=True))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows) == expected


def test_query(spark, own):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(own, docs, entry.queries()["op13_cross_tokenizer_alignment"](spark, SF).collect())


ODD = [*" " * 6, "\n", "\t", "a", "b", "é", "日", "😀", "▁", "'s", "ﬁ", "́", "\xa0", "　", "<s>", "</s>", "<0x0A>",
       "<|endoftext|>", "1", "!", "\x1c", "\x85", "\r", "𐍈", "\U000e0001", "\x00", "​", "�", "ẞ", "مر", "हि"]


@pytest.mark.parametrize("shard", [40, 8_000_000])
def test_odd_texts(spark, own, monkeypatch, shard):
    monkeypatch.setattr(alignment, "SHARD", shard)
    rng = random.Random(shard)
    texts = [(i, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 14)))) for i in range(3000 if shard > 99 else 60)]
    texts += [(-1, None), (-2, ""), (None, "no id"), (5, "twice twice"), (5, "twice twice"), (-3, "x" * 20_000), (-4, " " * 3000)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    check(own, texts, alignment.align(frame, *PATHS).collect())


def test_spans_and_decoded_bytes_agree(own):
    """A word's links cover each byte range once: tokens of either side add up to the word's bytes."""
    words = [" naïve", " 日本語😀", " \U000e0001x", " a\nb", " <0x0A>"]
    known = own.align(words)
    assert all(g is not None for g in known.groups) and known.sizes[:, 0].min() > 0
    at = np.concatenate(([0], np.cumsum(known.sizes[:, 3])))
    for k, word in enumerate(words):
        a, b, groups, links, _ = plain(own, word[1:])
        assert known.sizes[k].tolist() == [a, b, groups, len(links)]
        assert [(p >> 32, p & 0xFFFFFFFF) for p in known.links[at[k] : at[k + 1]].tolist()] == links


def test_words_that_fail_do_not_hurt_their_neighbours(own):
    words = [f" word{i}" for i in range(50)] + [" ▁bad"] + [f" more{i}" for i in range(50)] + [" end  "]
    known = own.align(words)
    assert [k for k, g in enumerate(known.groups) if g is None] == [50]
    assert known.groups[:50] + known.groups[51:] == own.align([w for w in words if "bad" not in w]).groups


def test_crowded_and_empty_tables(spark, odd, crowded, nothing):
    got = sorted(map(str, alignment.align(odd, *PATHS).collect()))
    assert len(got) == 14 and sorted(map(str, alignment.align(crowded, *PATHS).collect())) == got
    assert alignment.align(nothing, *PATHS).collect() == []


def test_no_row_holds_a_shard(spark, own, monkeypatch):
    """A shard of 40,000 distinct words leaves its task in rows of a document or a run of words each."""
    kept, stored = [], alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, label: kept.append(stored(df, label)) or kept[-1])
    texts = [(d, " ".join(f"w{d}x{i}" for i in range(1000))) for d in range(40)]
    check(own, texts, alignment.align(spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1), *PATHS).collect())
    lists = [c for c, kind in kept[0].dtypes if kind.startswith("array")]
    longest = kept[0].selectExpr(*[f"max(size({c})) AS {c}" for c in lists]).first()
    assert lists and max(longest) <= 20_000


@pytest.mark.parametrize("run, rows, most", [(1, 2, 3), (3, 5, 10_000), (500, 7, 1)])
def test_pieces_of_a_shard(spark, own, monkeypatch, run, rows, most):
    """Pairs, words and documents of a shard meet again however they were cut; batches that end inside them too."""
    monkeypatch.setattr(alignment, "RUN", run)
    monkeypatch.setattr(alignment, "ROWS", rows)
    monkeypatch.setattr(alignment, "AT_ONCE", most)
    monkeypatch.setattr(alignment, "SHARD", 300)
    rng = random.Random(run)
    texts = [(i, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 9)))) for i in range(150)] + [(-1, None), (-2, "")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        check(own, texts, alignment.align(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3), *PATHS).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
