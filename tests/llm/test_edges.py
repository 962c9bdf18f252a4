"""Odd rows, clashing columns and empty tables: every operator and stage gives a defined result."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from harborline.llm import chat, decontaminate, html, licenses, lines, lm, packing, rules, simhash, suffix

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
OWN = ["doc_id", "text", "lang", "source", "n_chars"]


def bench(spark):
    return spark.createDataFrame([(1, "word3 word4 word5 word6 word7 word8"), (2, None), (None, "x"), (3, "")], "item_id int, text string")


OPERATORS = {
    "lines": lambda s, d: lines.dedup_lines(d),
    "rules": lambda s, d: rules.judge(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "decontaminate": lambda s, d: decontaminate.leaks(d, bench(s)),
    "packing": lambda s, d: packing.pack_documents(d, WORDS),
    "lm": lambda s, d: lm.score(d),
    "licenses": lambda s, d: licenses.scan(d.withColumn("path", F.concat_ws("/", "source", "doc_id"))),
    "suffix": lambda s, d: suffix.drop_repeats(d),
    "html": lambda s, d: html.extract(d.withColumnRenamed("text", "html"), training=trained(s)),
}
ROWWISE = {"lines", "rules", "simhash", "lm", "licenses", "suffix", "html"}
_trained = []


def trained(spark):
    if not _trained:
        _trained.append(html.labelled(spark))
    return _trained[0]


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(spark, name, odd, crowded, odd_rows):
    def seen(df):
        drop = {"path"}
        columns = sorted(c for c in plain.columns if c not in drop)
        return sorted(str([r[c] for c in columns]) for r in df.collect())

    plain = OPERATORS[name](spark, odd)
    got = seen(plain)
    if name in ROWWISE:
        assert len(got) == len(odd_rows)
    if name != "packing":  # sequences are any numbers
        assert seen(OPERATORS[name](spark, crowded)) == got
    else:
        assert OPERATORS[name](spark, crowded).count() == len(got)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name, nothing):
    assert OPERATORS[name](spark, nothing).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, name, stage, odd, crowded, nothing):
    assert stage(spark, nothing, SF).count() == 0
    out = stage(spark, crowded, SF)
    if name != "best-fit packing":
        assert out.columns == crowded.columns
        assert stage(spark, odd, SF).columns == OWN
    assert out.count() > 0


def test_line_dedup_of_odd_rows(spark, odd):
    got = {(r.doc_id, r.lang): r for r in lines.dedup_lines(odd, min_docs=2).collect()}
    assert (got[1, "en"].text, got[1, "en"].n_lines, got[1, "en"].n_dropped) == ("", 1, 0)
    assert (got[9, "en"].text, got[9, "en"].n_lines) == ("\n" * 50, 51)
    assert got[4, "en"].text == "" and got[4, "en"].n_dropped == 900
    assert got[6, "en"].text == "" and got[None, "en"].text == ""  # a NULL id is a document too
    assert got[6, "de"].n_dropped == 0


def test_rules_on_odd_rows(spark, odd):
    got = {(r.doc_id, r.lang): r for r in rules.judge(odd).collect()}
    assert got[1, "en"].base_failed and got[1, "en"].n_words == 0
    assert got[6, "de"].kept and got[None, "en"].kept
    assert got[10, "en"].n_repeat_words == 2000 and not got[10, "en"].kept
    assert got[8, "en"].word_chars == 5000


def test_simhash_of_odd_rows(spark, odd):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert got[1, "0" * 16] == got[2, "0" * 16] == got[3, "0" * 16] == got[9, "0" * 16] == 1
    assert got[None, "0" * 16] == 1
    assert {r.doc_id for r in simhash.one_of_each(odd).collect()} >= {1, 4, 6}


def test_chat_of_odd_rows(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, "a\\b <\\|turn|> <|turn|>"), (None, None, "user", ""), (None, None, "user", "")]
    turns = chat.canonical(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(turns)).collect()}
    assert [tuple(t) for t in got[1].read] == [("", "a\\b <\\|turn|> <|turn|>"), ("assistant", "")]
    assert got[1].loss == [""] and len(got[None].read) == 2
    empty = chat.canonical(spark.createDataFrame([], "conv_id int, turn int, role string, text string"))
    assert chat.read_back(chat.formatted(empty)).count() == 0


def test_documents_made_of_their_hosts_boilerplate_are_rejected(spark):
    menu = "\n".join(f"menu line {i} with some words in it" for i in range(8))
    own = lambda i, n: " ".join(f"own{i}x{j}" for j in range(n))
    rows = [(i, f"{menu}\n{own(i, 60)}", "h") for i in range(30)]  # the menu is boilerplate, the rest is their own
    rows += [(100 + i, f"{menu}\n{own(100 + i, 3)}", "h") for i in range(5)]  # nothing but the menu
    rows += [(200, f"{menu}\n{own(200, 3)}", "other")]  # not boilerplate of that host
    rows += [(300 + i, own(300, 40), "copies") for i in range(50)]  # copies of one text count once
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    assert all(got[i].kept and got[i].n_boilerplate_words == 64 for i in range(30))
    assert not any(got[100 + i].kept or got[100 + i].base_failed for i in range(5))
    assert got[200].kept and all(got[300 + i].kept for i in range(50))


def test_boilerplate_of_a_large_host_counts_as_on_a_small_one(spark):
    menu = "\n".join(f"menu line {i} with some words in it" for i in range(8))
    own = lambda i, n: " ".join(f"own{i}x{j}" for j in range(n))
    rows = [(i, f"{menu}\n{own(i, 3)}", "small") for i in range(12)]
    rows += [(1000 + i, f"{menu}\n{own(1000 + i, 3)}", "large") for i in range(12)]
    rows += [(2000 + i, own(2000 + i, 40), "large") for i in range(400)]  # the menu is in 3 % of its texts
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    want = {2000 + i for i in range(400)}
    assert {r.doc_id for r in rules.judge(docs).collect() if r.kept} == want
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()} == want
    by_share = {r.doc_id for r in rules.judge(docs, min_share=0.05).collect() if r.kept}
    assert by_share == want | {1000 + i for i in range(12)}


def test_rows_are_told_apart_by_id_and_text(spark):
    words = lambda k: " ".join(f"{k}word{i}" for i in range(80))
    rows = [(None, words("a")), (None, words("b")), (7, words("c")), (7, words("d")), (7, words("d")), (9, words("a")), (None, words("a"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("more", F.lit(1))
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()]
    assert sorted(kept, key=str) == sorted([(9, words("a")), (None, words("b")), (7, words("c")), (7, words("d"))], key=str)
    items = spark.createDataFrame([(1, words("b")), (2, words("c"))], "item_id int, text string")
    clean = [(r.doc_id, r.text) for r in decontaminate.clean_documents(docs, items).collect()]
    assert sorted(clean, key=str) == sorted([r for r in rows if r[1] not in (words("b"), words("c"))], key=str)
    assert decontaminate.clean_documents(docs, items.where("false")).count() == len(rows)


def test_boilerplate_leaves_the_texts(spark):
    own = lambda i: f"own text {i} of some length\nand a line that is shared by few\n\nend {i}"
    rows = [(i, f"  Menu\n{own(i)}\nFOOTER line", "h") for i in range(12)]
    rows += [(100, "menu\nfooter LINE", "h"), (101, f"menu\n{own(1)}", "other"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string").withColumn("gone", F.lit(1))
    got = {r.doc_id: r for r in rules.without_boilerplate(docs).collect()}
    assert all(got[i].text == own(i).replace("and a line that is shared by few\n", "") for i in range(12))
    assert got[100].text == "" and got[101].text == f"menu\n{own(1)}" and got[None].text == "" and got[100].gone == 1
    assert rules.without_boilerplate(docs.where("false")).count() == 0
    counted = {r.doc_id: r.n_boilerplate_words for r in rules.judge(docs).collect()}
    lost = lambda r: len((r[1] or "").split()) - len(got[r[0]].text.split())
    assert all(counted[r[0]] == lost(r) for r in rows)
