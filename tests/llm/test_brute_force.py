"""Queries without SQL against brute force on the smallest data set, and the parts of operators on made-up cases."""

import hashlib
import html as entities
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from harborline.llm import chat, components, decontaminate, html, licenses, lines, lm, packing, rules, simhash, suffix

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(docs):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def prints_of(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {k: find(k) for k in keys}


def near(texts, radius=4):
    fp = {i: prints_of(t) for i, t in texts.items()}
    every = sorted(fp)
    return fp, groups(every, [(a, b) for a in every for b in every if a < b and (fp[a] ^ fp[b]).bit_count() <= radius])


def test_simhash(spark, docs):
    fp, root = near({i: r.text for i, r in docs.items()})
    got = entry.queries()["op10_simhash_near_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fp[i]:016x}", root[i]) for i in docs}
    assert len(got) == len(docs)


def test_near_links_of_dense_clusters(spark):
    rng = random.Random(3)
    points = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(60):
            points.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    points = sorted(points)
    want = groups(points, [(a, b) for a in points for b in points if a < b and (a ^ b).bit_count() <= 4])
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in points], "fp bigint")
    for piece in (4096, 16):  # whole shards, and shards cut into pieces
        linked = simhash.near_links(frame, 4, piece).collect()
        unsigned = [(r.a % (1 << 64), r.b % (1 << 64)) for r in linked]
        assert all((a in want and want[a] == want[b]) for a, b in unsigned)
        assert groups(points, unsigned) == want


def test_tables_lose_no_pair():
    rng = random.Random(1)
    masks = simhash.tables(4)
    for _ in range(2000):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(flips & m == 0 for m in masks)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 50)}


def repeated_bytes(texts, length):
    seen = Counter(b[i : i + length] for b in texts.values() for i in range(len(b) - length + 1))
    out = {}
    for k, b in texts.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out[k] = gone
    return out


def test_suffix_dedup(spark, docs):
    raw = {i: r.text.encode() for i, r in docs.items()}
    want = repeated_bytes(raw, 400)
    got = entry.queries()["op8_suffix_array_dedup"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        gone = want[r.doc_id]
        kept = bytes(np.frombuffer(raw[r.doc_id], np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(gone), int(gone.sum()), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_of_edited_copies(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcde \n") for _ in range(900))
    texts = {0: "a" * 1200, 1: "ab" * 700, 2: passage, 3: "x" + passage[:450] + "y" + passage[100:520], 4: passage[37:436]}
    for i in range(5, 40):
        t = list(passage)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice("ABC")
        texts[i] = "".join(rng.choice("uvw") for _ in range(rng.randint(0, 50))) + "".join(t)[rng.randint(0, 300) :]
    frame = spark.createDataFrame(list(texts.items()), "doc_id int, text string").repartition(5)
    want = repeated_bytes({i: t.encode() for i, t in texts.items()}, 400)
    for r in suffix.drop_repeats(frame).collect():
        raw = np.frombuffer(texts[r.doc_id].encode(), np.uint8)
        assert bytes(r.kept) == bytes(raw[~want[r.doc_id]]), r.doc_id


def test_suffix_dedup_spreads_one_core_in_many_surroundings(spark, monkeypatch):
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    passage, frames, real = letters(360), {}, suffix._strings
    texts = {i: letters(300) + passage + letters(300) for i in range(200)}
    texts |= {200 + i: texts[i][rng.randint(0, 60) : 700 + rng.randint(0, 60)] + letters(50) for i in range(20)}

    def limited(doc_type, length):
        inner = real(doc_type, length)

        def strings(batches):
            held = list(batches)
            assert sum(b.num_rows for b in held) < 150, "pieces of one core meet in one task"
            yield from inner(iter(held))

        return strings

    def kept(df, label):
        frames[label] = df
        return stored(df, label)

    stored = suffix.stored
    monkeypatch.setattr(suffix, "_strings", limited)
    monkeypatch.setattr(suffix, "stored", kept)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(list(texts.items()), "doc_id int, text string").repartition(5)
        got = suffix.drop_repeats(frame).collect()
        open_rows = frames["suffixes"].where(f"kind <> {suffix.MARK}").withColumn("task", F.spark_partition_id())
        hot = open_rows.groupBy("core").agg(F.count("*").alias("n"), F.countDistinct("task").alias("tasks")).orderBy(F.desc("n")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert hot.n >= 200 and hot.tasks == 4
    want = repeated_bytes({i: t.encode() for i, t in texts.items()}, 400)
    assert len(got) == len(texts) and sum(r.n_removed for r in got) > 0
    for r in got:
        raw = np.frombuffer(texts[r.doc_id].encode(), np.uint8)
        assert bytes(r.kept) == bytes(raw[~want[r.doc_id]]), r.doc_id


def test_family_against_counts():
    rng = np.random.default_rng(0)
    family, every = suffix.Family(), []
    for size in (1, 5, 300, 7, 64, 64, 1000, 2):
        keys = rng.integers(0, 900, size).astype(np.uint64)
        every.append(keys)
        family.add(keys)
    every = np.concatenate(every)
    counts = Counter(every.tolist())
    assert family.hit.tolist() == [counts[k] > 1 for k in every.tolist()]
    sizes = [len(k) for k, _ in family.runs]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == len(every)


def test_lm_scores(spark, docs):
    tokens = {i: r.text.encode().lower().split() + [b""] for i, r in docs.items()}
    learned = [w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 10]
    words, pairs = Counter(), Counter()
    for w in learned:
        words.update(w)
        pairs.update(zip([None, *w], w, strict=False))
    n, v, k = sum(words.values()), len(words), 16.0
    p = lambda w: (words[w] + 0.1) / (n + 0.1 * (v + 1))
    q = lambda h, w: (pairs[h, w] + k * p(w)) / ((len(learned) if h is None else words[h]) + k)
    got = entry.queries()["op6_lm_scoring"](spark, SF).collect()
    assert len(got) == len(docs)
    better = 0
    for r in got:
        w = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(words[x] > 0 for x in w), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert math.isclose(r.base_score, sum(math.log10(p(x)) for x in w), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(q(h, x)) for h, x in zip([None, *w], w, strict=False)), rel_tol=1e-9)
        better += r.held_out * (r.score - r.base_score)
    assert better > 0
    some = learned[0][0]  # all arcs out of a state, and the failure arc, have probability one in sum
    total = sum(q(some, w) for w in words) + k * 0.1 / (n + 0.1 * (v + 1)) / (words[some] + k)
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_ranges_of_keys_get_all_and_no_more_messages_than_keys():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 64, 500, np.uint64))
    for parts in (1, 8, 100_000):
        part, begin = lm.ranges(keys, parts)
        assert len(part) <= len(keys) and (np.diff(part) > 0).all() and part[0] >= 0 and part[-1] < parts
        split = np.split(keys, begin[1:])
        assert np.array_equal(np.concatenate(split), keys)
        for p, own in zip(part.tolist(), split, strict=True):
            assert len(own) and lm.ranges(own, parts)[0].tolist() == [p]


def test_strings_that_agree_in_half_of_their_hash_are_not_equal():
    kind = pa.int64()
    pieces = pa.record_batch(
        [pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array([0, 0, 0]), pa.array([b"a" * 20, b"a" * 20, b"b" * 20])],
        names=["doc", "uid", "first", "bytes"])
    table = pa.Table.from_batches(list(suffix._strings(kind, 20)([pieces])))
    assert sorted(r["doc"] for r in table.to_pylist() if r["core"] is None) == [1, 2] and table.num_rows == 4
    rows = [(5, 1, False, d, d, 0, 0, 0) for d in (1, 2)] + [(5, 2, False, 3, 3, 0, 0, 0)]
    met = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=suffix._schema(kind).names)
    marks = [r for b in suffix._needs(kind, np.zeros(0, np.int64))([met]) for r in b.to_pylist() if r["kind"] == suffix.MARK]
    assert sorted(r["doc"] for r in marks) == [1, 2]


def check_packing(rows, sizes, limit=2048):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    total = sum(sizes)
    assert len(held) <= max(-(-total // limit) * 1.02 + 1, 1)


def test_packing(spark, docs, ids):
    got = entry.queries()["op5_best_fit_packing"](spark, SF).collect()
    of = defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
    assert set(of) == set(docs)
    for i, parts in of.items():
        own = np.array([*ids(docs[i].text), 0], "<u4")
        parts.sort(key=lambda r: r.piece)
        assert [r.start for r in parts] == list(range(0, len(own), 2048))
        for n, r in enumerate(parts):
            piece = own[r.start : r.start + 2048]
            assert (r.piece, r.length, r.ids_crc32) == (n, len(piece), zlib.crc32(piece.tobytes()))
    check_packing(got, [r.length for r in got])


def test_encoder_equals_the_tokenizer(ids):
    encode = packing.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    odd = [
        "", " ", "Hello, WORLD's  best café x", "İI ıi ΑΣ ΑΣ. ﬁ Å é ½ ² ª º ß ẞ", "a\x1cb\x1f c\x85d", "<|endoftext|> x", "12'll3",
        "日本語 text", "́ x ́", "don't DON'T 'S", "µµ ÿŸ ŉ ǰ ʼn", "� \x00 \x7f", "ǅ ǆ ȺɐⱯ",
    ]
    for text in odd:
        assert np.frombuffer(encode(text), "<u4").tolist() == ids(text), text


def test_a_part_goes_through_the_model_once(ids, tmp_path, monkeypatch):
    path = tmp_path / "vocabulary.json"  # no encoder is kept for it
    path.write_text(Path(public_tokenizers.path("word_bpe_49k.json")).read_text())
    whole, asked = Tokenizer.from_file(str(path)), []

    class Model:
        def tokenize(self, part):
            asked.append(part)
            return whole.model.tokenize(part)

    class Counting:
        model, encode, get_added_tokens_decoder = Model(), whole.encode, whole.get_added_tokens_decoder

    monkeypatch.setattr(Tokenizer, "from_file", lambda path: Counting, raising=False)
    text = "Stein stein STEIN stein, Stein. stein. \"Stein\" stein!? stein-Stein"
    found = np.frombuffer(packing.word_encoder(str(path))(text), "<u4").tolist()
    monkeypatch.undo()
    assert found == ids(text)
    assert sorted(asked) == ["!?", '"', ",", "-", ".", "stein"]


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece(seed):
    rng = np.random.default_rng(seed)
    make = [
        lambda: rng.integers(1, 2049, 4000), lambda: np.minimum(2048, rng.geometric(1 / 300, 20000)),
        lambda: rng.integers(500, 1100, 9000), lambda: rng.choice([700, 690, 2048, 650, 1000], 2000), lambda: np.array([2048]),
        lambda: np.ones(5000, int),
    ][seed]
    lengths = make()
    counts = Counter(lengths.tolist())
    made = packing.plan(dict(counts))
    got = Counter()
    for pattern, n in made.patterns:
        assert sum(pattern) <= 2048
        for x in pattern:
            got[x] += n
    assert got == counts
    assert made.sequences <= packing.best_fit(dict(counts), 2048).sequences
    assert made.from_columns > 0


def test_much_of_a_large_plan_are_columns_of_the_program():
    rng = np.random.default_rng(7)
    lengths = np.minimum(2048, 1 + rng.lognormal(5.8, 1.1, 60_000).astype(int))  # short texts, and long ones cut
    counts = Counter(lengths.tolist())
    made = packing.plan(dict(counts))
    assert made.from_columns > 0.4 * made.sequences
    assert made.sequences <= 1.001 * -(-sum(k * n for k, n in counts.items()) // 2048)


def edits_inside(item, text):
    row, best = list(range(len(item) + 1)), len(item)
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_leaks_against_edit_distance():
    rng = random.Random(4)
    letters = "etaoin shr"
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(30, 150)))) for i in range(12)]
    index = decontaminate.Index(items, 6, 0.1)
    texts, cases = [], []
    for n in range(60):
        i, item = rng.choice(items)
        t = list(item)
        for _ in range(rng.randint(0, int(0.14 * len(t)))):
            at = rng.randrange(len(t))
            t[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters), rng.choice(letters) * 2])
        noise = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, 300)))
        texts.append(noise() + "".join(t) + noise())
        cases.append((n, i))
    found = decontaminate.search(texts, index)
    place = {i: n for n, (i, _) in enumerate(index.items)}
    for n, i in cases:
        best = edits_inside(index.items[place[i]][1], decontaminate.plain(texts[n]))
        got = {f["item_id"]: f["edits"] for f in found[n]}
        assert got.get(i) == (best if best <= index.budget[place[i]] else None)


def test_excerpts_against_edit_distance():
    rng = random.Random(5)
    letters = "etaoin shr"
    text = lambda low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    items = [(i, text(60, 240)) for i in range(12)]
    index = decontaminate.Index(items, 5, 0.125, 0.75)
    where = {i: n for n, (i, _) in enumerate(index.items)}
    texts, cases, kinds = [], [], Counter()
    for n in range(110):
        i, _ = rng.choice(items)
        item = index.items[where[i]][1]
        size = math.ceil(len(item) * rng.choice([0.6, 0.76, 0.8, 0.86, 0.95, 1]))
        begin = rng.randint(0, len(item) - size)
        t = list(item[begin : begin + size])
        for _ in range(rng.choice([0, rng.randint(0, int(0.14 * len(t)))])):
            at = rng.randrange(len(t))
            t[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters), rng.choice(letters) * 2])
        texts.append(text(0, 150) + "".join(t) + text(0, 150))
        cases.append((n, where[i], size == math.ceil(len(item) * 0.86) and "".join(t) == item[begin : begin + size]))
    found = decontaminate.search(texts, index)
    for n, at, must in cases:
        item, k, run = index.items[at][1], int(index.budget[at]), int(index.run[at])
        hay = decontaminate.plain(texts[n])
        want, first, until = edits_inside(item, hay), 0, len(item)
        if want > k and index.excerpts(at):
            want, first = min((edits_inside(item[b : b + run], hay), b) for b in index.excerpts(at))
            k, until = int(index.run_budget[at]), first + run
        got = {f["item_id"]: f for f in found[n]}.get(index.items[at][0])
        assert (got and got["edits"]) == (want if want <= k else None)
        if got:
            kinds["whole" if until - first == len(item) else "excerpt"] += 1
            assert edits_inside(item[got["item_at"] : got["item_until"]], hay[got["at"] : got["until"]]) == got["edits"]
        kinds["none"] += not got
        assert got or not must or not index.excerpts(at)
    assert min(kinds["whole"], kinds["excerpt"], kinds["none"]) >= 10


def test_leaks_in_documents(spark, docs):
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = entry.queries()["op4_benchmark_decontamination"](spark, SF).collect()
    exact = {(i, b) for i, r in docs.items() for b, t in bench.items() if decontaminate.plain(t) in decontaminate.plain(r.text)}
    size = {b: len(decontaminate.plain(t)) for b, t in bench.items()}
    assert {(r.doc_id, r.item_id) for r in got if r.edits == 0 and r.item_until - r.item_at == size[r.item_id]} == exact and exact
    for r in got:
        item, text = decontaminate.plain(bench[r.item_id]), decontaminate.plain(docs[r.doc_id].text)
        item = item[r.item_at : r.item_until]
        assert edits_inside(item, text[r["at"] : r.until]) == r.edits <= len(item) * 0.125
    index = decontaminate.Index(list(bench.items()), 5, 0.125, 0.75)
    some = {
        (i, index.items[n][0]) for i, r in docs.items() for n in range(len(index.items)) for b in index.excerpts(n)
        if index.items[n][1][b : b + int(index.run[n])] in decontaminate.plain(r.text)}
    assert some <= {(r.doc_id, r.item_id) for r in got}


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in entry.queries()["op3_html_extraction"](spark, SF).collect()}
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(x for x in parts if x)
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (want, len(want))


def test_html_drops_long_parts_and_one_word_menus(spark):
    tree = html.train(html.labelled(spark))
    words = lambda n, w="word": " ".join([w] * n)
    pages = [
        f"<article><p>{words(40)}</p></article><footer><p>{words(70, 'gone')}</p></footer>",
        f"<main><h1>{words(3)}</h1><p>{words(40)}</p></main><div class='cookie-notice'><p>{words(70, 'gone')}</p></div>",
        f"<nav><a href='/'>gone</a></nav><article><p>{words(70)}</p></article>",
        f"<div class='menu'>gone</div><article><p>{words(70)}</p></article>",
        f"<article><p>{words(70)}</p><aside>{words(80, 'gone')}</aside><p>{words(3)}</p></article>",
        f"<article><p>{words(70)}</p></article><section class='comments'><p>{words(100, 'gone')}</p></section>",
        f"<header><p>{words(60, 'gone')}</p></header><article><p>{words(2)}</p><p>{words(70)}</p></article>",
    ]
    for page in pages:
        got = html.main_text(f"<html><body>{page}</body></html>", tree)
        assert "gone" not in got and got.count("word") == page.count("word"), page


def test_html_without_markup_is_told_by_words_and_links(spark):
    """Pages of bare divisions: no element, class or role says what a block is for."""
    tree = html.train(html.labelled(spark))
    good = whole = 0
    for page in html.labelled_pages(400, seed=98):
        blocks = html.blocks(page)
        flags = [html.FEATURES.index(f) for f in ("in_article", "in_page_part", "in_comments")]
        if any(features[i] for _, features in blocks for i in flags):
            continue
        good += sum(html.is_main(tree, features) == (html.MARK in text) for text, features in blocks)
        whole += len(blocks)
    assert whole > 800 and good >= 0.95 * whole


PAGE = """<html><body class="single has-sidebar"><header class="site"><h1>Site Name</h1><p>tag line</p></header><nav><a href=/>Home</a>
</nav><div id="cookie-notice"><p>We use cookies to make this site better for everyone who comes here to read.</p></div>
<div class="layout with-sidebar"><main><article class="post"><header class="entry-header"><h1>Title &amp; more</h1></header>
<p>First&nbsp;para  with\n <b>bold</b> and <a href="x>y">a link</a>.</p><p>To.</p><ul><li>item one</li></ul>
<div class="ad-content">Buy our things now please, good things, the best things</div><!-- <p>no</p> -->
<footer>Tags: x, y</footer></article><section id="comments"><h2>Comments</h2><article class="comment">
<p>I really liked this long article, and I want to tell you so with many words.</p></article></section></main>
<aside class="sidebar"><h3>Related</h3><p>Another story that is long enough to look like real text, for sure it is.</p></aside></div>
<form><label>Your mail</label><input><textarea>zzz</textarea></form><footer><p>&copy; site</p></footer>
<script>var a="<p>no</p>";</script></body></html>"""


def test_main_text_of_a_full_page(spark):
    tree = html.train(html.labelled(spark))
    want = "Title & more\n\nFirst para with bold and a link.\n\nTo.\n\nitem one"
    assert html.main_text(PAGE, tree) == want
    assert html.main_text("", tree) == html.main_text("<script>x", tree) == ""
    good = total = 0
    for page in html.labelled_pages(60, seed=99):  # held out: another seed
        for text, features in html.blocks(page):
            total += 1
            good += html.is_main(tree, features) == (html.MARK in text)
    assert good / total > 0.93


def test_chat_layouts(spark):
    say = [("user", "hi"), ("assistant", "yo")]
    frames = [
        spark.createDataFrame([(1, "hi", "yo")], "conv_id int, prompt string, response string"),
        spark.createDataFrame([(1, "hi", "yo")], "conv_id int, instruction string, output string"),
        spark.createDataFrame([(1, [("user", "hi"), ("assistant", "yo")])],
                              "conv_id int, messages array<struct<role:string,content:string>>"),
        spark.createDataFrame([(1, [("human", "hi"), ("gpt", "yo")])],
                              "conv_id int, conversations array<struct<`from`:string,value:string>>"),
        spark.createDataFrame([(1, 1, "assistant", "yo", 5), (1, 0, "user", "hi", 6)],
                              "conv_id int, turn int, role string, text string, extra int"),
    ]
    for frame in frames:
        row = chat.read_back(chat.formatted(chat.canonical(frame))).first()
        assert [tuple(t) for t in row.read] == say and row.loss == ["yo"]
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([(1, 2)], "conv_id int, z int"))


def test_chat_json_records(spark):
    records = [
        '{"prompt": "hi", "response": "yo"}', '{"response": "yo", "prompt": "hi"}',
        '{"messages": [{"role": "user", "content": "hi"}, {"content": "yo", "role": "assistant"}]}',
        '{"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}',
        '{"instruction": "a", "input": "b", "output": null}', "no json", '{"x": 1}', None,
    ]
    frame = spark.createDataFrame(list(enumerate(records)), "conv_id int, record string")
    got = {r.conv_id: r for r in chat.canonical_json(frame).collect()}
    for i in range(4):
        assert [tuple(t) for t in got[i].turns] == [("user", "hi"), ("assistant", "yo")], i
    assert got[4].layout == "instruction with input"
    assert [tuple(t) for t in got[4].turns] == [("user", "a\n\nb"), ("assistant", "")]
    assert [got[i].layout for i in (5, 6, 7)] == [None, None, None]


def test_license_inheritance(spark):
    apache, mit = licenses.TEMPLATES[0][1], licenses.TEMPLATES[1][1]
    files = [
        ("LICENSE", mit), ("a/LICENSE", apache), ("a/b/x.py", "plain code"), ("a/b/c/y.py", "some code of many words " * 4 + "\n" + mit + "\nand more words"),
        ("z.py", "code"), (None, "nothing"), ("q/LICENSE", None),
    ]
    got = {r.path: tuple(r)[2:] for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["LICENSE"][0] == "MIT" and got["LICENSE"][2] == "file"
    assert got["a/b/x.py"][0] == "Apache-2.0" and got["a/b/x.py"][2:] == ("directory", 1)
    assert got["a/b/c/y.py"][0] == "MIT" and got["a/b/c/y.py"][2] == "line"
    assert got["z.py"][0] == "MIT" and got["z.py"][3] == 0 and got["q/LICENSE"][3] == 1


def test_license_texts_hand_down(spark):
    texts = dict(licenses.license_texts())
    files = [(f"{name}/LICENSE", f"Copyright (c) 2020 A. Nyone\n\n{t}") for name, t in texts.items()]
    files += [(f"{name}/src/x.py", f"plain code {i}") for i, name in enumerate(texts)]
    files += [(f"other/{i}.txt", f"the of and to you may {i} or software copies of a tale") for i in range(200)]
    got = {r.path: tuple(r)[2:] for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {"MIT", "Apache-2.0", "GPL-3.0", "BSD-3-Clause", "MPL-2.0"} <= set(texts)
    for name in texts:
        assert got[f"{name}/LICENSE"][0] == name and got[f"{name}/LICENSE"][2] == "file"
        assert got[f"{name}/src/x.py"][0] == name and got[f"{name}/src/x.py"][2:] == ("directory", 1)
    assert all(got[f"other/{i}.txt"][0] is None for i in range(200))


def test_pipeline(spark, docs, ids):
    good = {i: r for i, r in docs.items()}
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(BLANK))
    spread = defaultdict(set)
    for r in docs.values():
        for x in r.text.split("\n"):
            if key(x):
                spread[r.source, key(x)].add(r.text)
    stay = {}
    for i, r in good.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        again = rules.repeated_words([w.encode() for w in words])
        lost = sum(len(x.split()) for x in r.text.split("\n") if key(x) and len(spread[r.source, key(x)]) >= 10)
        if len(words) >= 20 and 100 * again <= 30 * len(words) and 100 * (len(words) - lost) >= 20 * len(words):
            stay[i] = r.text
    found = Counter(k for t in stay.values() for k in {key(x) for x in t.split("\n")} if k)
    stay = {i: "\n".join(x for x in t.split("\n") if not key(x) or found[key(x)] < 10) for i, t in stay.items()}
    _, root = near(stay)
    stay = {i: t for i, t in stay.items() if root[i] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.Index(bench, 5, 0.125, 0.75)
    stay = {i: t for i, t in stay.items() if not decontaminate.search([t], index)[0]}
    got = corpus_pipeline.run(spark, SF).collect()
    want = {}
    for i, t in stay.items():
        own = np.array([*ids(t), 0], "<u4")
        want |= {(i, n): own[at : at + 2048].tobytes() for n, at in enumerate(range(0, len(own), 2048))}
    assert {(r.doc_id, r.piece): bytes(r.ids) for r in got} == want and len(got) == len(want)
    check_packing(got, [r.length for r in got])


def test_line_keys_keep_other_letters():
    assert lines.line_key("\x0b ÀB\xa0 ".encode()) == "Àb\xa0".encode()
