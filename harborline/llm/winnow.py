"""Document fingerprints by winnowing, with SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import fingerprint, stored, text_of, without

#: Characters of a gram, and grams of a window: a passage of GRAM + WINDOW - 1 characters always leaves a mark.
GRAM, WINDOW = 16, 16
#: Windows that begin in one block of a text, and the bits that hold a place in it. A block has BLOCK + WINDOW - 1 grams at most.
BLOCK, PLACE_BITS = 1024, 11
LAST_PLACE = (1 << PLACE_BITS) - 1
#: About so many rows are put in order by one sort group; no more than one group in ``HOT`` holds over a share of 1 in ``HOT``.
GROUP, HOT = 1024, 1000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _least(values: Column, step: int, most: int) -> Column:
    """At each place the least of up to ``most`` values, ``step`` apart, from there on."""
    return let(values, lambda v: F.transform(v, lambda x, i: F.least(x, *[F.get(v, i + step * k) for k in range(1, most)])))


def _selected(block: Column, gram: int, window: int) -> Column:
    """The marks of a block, in order: hash above, place below (the later the less), so the least is the rightmost least hash."""
    whole = F.regexp_extract_all(block, F.lit(f"(?s)(?=(.{{{gram}}}))."), F.lit(1))
    grams = let(whole, lambda g: F.when(F.size(g) == 0, F.array(block)).otherwise(g))
    keyed = F.transform(
        grams, lambda g, i: F.shiftleft(F.xxhash64(g), PLACE_BITS).bitwiseOR((F.lit(LAST_PLACE) - i).cast("bigint")))
    width = 1
    least = keyed
    while width < window:
        most = min(4, -(-window // width))
        step = width if width * most <= window else -(-(window - width) // (most - 1))
        least = _least(least, step, most)
        width += step * (most - 1)
    return let(least, lambda v: F.array_distinct(F.slice(v, F.lit(1), F.greatest(F.size(v) - (window - 1), F.lit(1)))))


def blocks(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Marks of a text by block, hash and place in one number (see ``marks``).

    A block holds the windows that begin in it and the characters they reach, so it is as long as it is at every length of
    the text. A text with fewer grams than a window is one window, one shorter than a gram is one gram, the empty text
    has no block. ``gram`` characters are code points; ``window`` is at most 1024.
    """
    reach = gram + window - 1
    cut = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{reach},{BLOCK + reach - 1}}})).{{1,{BLOCK}}}"), F.lit(1))
    whole = let(cut, lambda c: F.when((F.size(c) == 0) & (F.octet_length(text) > 0), F.array(text)).otherwise(c))
    return F.transform(whole, lambda b: _selected(b, gram, window))


def marks(by_block: Column) -> Column:
    """array<struct<position, hash>>: where each chosen gram begins, in code points from 0, and its 53-bit hash."""
    return F.array_distinct(F.flatten(F.transform(by_block, lambda block, j: F.transform(block, lambda m: F.struct(
        (F.lit(LAST_PLACE) - m.bitwiseAND(F.lit(LAST_PLACE)) + j * BLOCK).alias("position"),
        F.shiftright(m, PLACE_BITS).alias("hash"))))))


def hashes(by_block: Column) -> Column:
    """The distinct hashes of a text's marks."""
    return F.array_distinct(F.transform(F.flatten(by_block), lambda m: F.shiftright(m, PLACE_BITS)))


def likeness(left: Column, right: Column) -> Column:
    """Shared hashes among all hashes of both (arrays of distinct hashes); 1 for two texts without marks."""
    shared = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def name(by_block: Column) -> Column:
    """32 hexadecimal digits that stand for all marks of a text and their positions."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), by_block)), 16, "0") for seed in (0, 1)]))


def fingerprints(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``marks``: array<struct<position:bigint, hash:bigint>>, in order of position.

    Every gram of ``gram`` code points is hashed; of each ``window`` neighbouring grams the least hash is chosen, the
    rightmost where it occurs more than once, and a gram that several windows choose is one mark. Two texts that share a
    passage of ``gram + window - 1`` code points share a mark at the same place in it; nothing shorter than a gram is matched.

    Nothing is shuffled: a row's marks are made in place, block by block, so long texts cost time in proportion and hold
    one block of grams at a time. NULL and the empty text have no marks; equal texts, repeated rows included, have
    equal marks; ties follow the rule above. Other columns stay, an input column called ``marks`` is replaced. An empty
    table gives an empty table.
    """
    docs = without(docs, "marks")
    return docs.withColumn("marks", marks(blocks(text_of(docs, text), gram, window)))


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (doc, text, a, b) with a sort group (g1, g2, g3): groups follow each other as (doc, a, b) do.

    A group is a range of ids with ``GROUP`` rows on average. A range with over 1 in ``HOT`` of all rows (there are fewer
    than ``HOT`` of these) and NULL ids are split by id and hash, so an id that many rows share is in many groups.
    """
    stats = rows.agg(F.count("*").alias("n"), F.min("doc").cast("double").alias("low"), F.max("doc").cast("double").alias("high")).first()
    low, high = stats.low or 0.0, stats.high or 0.0
    width = max(1.0, (high - low + 1) * GROUP / max(1, stats.n))
    ranged = F.floor((F.col("doc").cast("double") - low) / width)
    limit = max(8 * GROUP, stats.n // HOT)
    counted = rows.groupBy(ranged.alias("g")).count().where(F.col("g").isNotNull() & (F.col("count") > limit))
    hot = [r.g for r in counted.select("g").collect()]  # fewer than HOT
    split = F.col("g1").isNull() | (F.col("g1").isin(hot) if hot else F.lit(False))
    return (
        rows.withColumn("g1", ranged)
        .withColumn("g2", F.when(split, F.col("doc")))
        .withColumn("g3", F.when(split, F.shiftright("a", 56)))
    )


KEY = ["g1", "g2", "g3"]


def _followers(groups: DataFrame) -> DataFrame:
    """Each sort group with the one that follows it (n1, n2, n3); the first follows the last."""
    ranged = stored(groups.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "groups")
    here = F.struct(*KEY)
    inside = F.lead(here).over(Window.partitionBy("part").orderBy(*KEY))
    # one row for each range partition of the session
    heads = ranged.groupBy("part").agg(F.min(here).alias("head"))
    order = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("head").over(order), F.min("head").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    followed = ranged.withColumn("next", inside).join(after, "part")
    return followed.select(*KEY, *[F.coalesce("next", "after")[k].alias(n) for k, n in zip(KEY, ("n1", "n2", "n3"), strict=True)])


def _met(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Joined, NULL meeting NULL; the right side's key columns go."""
    right = right.withColumnsRenamed({r: f"__{r}" for r in on.values()})
    met = F.lit(True)
    for own, other in on.items():
        met &= left[own].eqNullSafe(right[f"__{other}"])
    return left.join(right, met).drop(*[f"__{r}" for r in on.values()])


def with_next(docs: DataFrame, text: str = "text", doc: str = "doc_id", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(``doc``, ``text``, ``blocks``, ``next_text``, ``next_blocks``): each row and the row after it, the first after the last.

    Rows are in order of ``doc`` (an integer; NULL first), then of a 128-bit hash of the text; equal rows follow each other.
    Texts are shuffled once, into sort groups (see ``_grouped``); a row finds its neighbour inside its group, and the last
    row of a group, about one in ``GROUP``, gets the first row of the next group by a join.
    """
    rows = docs.select(F.col(f"`{doc}`").cast("bigint").alias("doc"), text_of(docs, text).alias("text"))
    rows = rows.select("doc", "text", fingerprint(F.col("text")).alias("fp")).select("doc", "text", "fp.a", "fp.b")
    grouped = _grouped(rows)
    dealt = grouped.repartition(*KEY)
    order = Window.partitionBy(*KEY).orderBy("doc", "a", "b")
    made = dealt.withColumn("blocks", blocks(F.col("text"), gram, window))
    ahead = F.lead(F.struct("text", "blocks")).over(order)
    inner = made.withColumn("next", ahead).where("next IS NOT NULL").select(
        "doc", "text", "blocks", F.col("next.text").alias("next_text"), F.col("next.blocks").alias("next_blocks"))

    edges = dealt.withColumn("first", F.row_number().over(order) == 1).withColumn("last", F.lead(F.lit(1)).over(order).isNull())
    edges = edges.where("first OR last").withColumn("blocks", blocks(F.col("text"), gram, window))
    heads = edges.where("first").select(*KEY, F.col("text").alias("next_text"), F.col("blocks").alias("next_blocks"))
    tails = _met(edges.where("last"), _followers(grouped.select(*KEY).distinct()), {k: k for k in KEY})
    outer = _met(tails, heads, {"n1": "g1", "n2": "g2", "n3": "g3"})
    columns = ["doc", "text", "blocks", "next_text", "next_blocks"]
    return inner.select(*columns).unionByName(outer.select(*columns)).withColumnsRenamed({"doc": doc, "text": text})


def respliced(by_block: Column, text: Column, kept: Column, more: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Blocks of the first ``kept`` code points of ``text`` followed by ``more``; blocks that end before the cut are taken over."""
    reach = gram + window - 1
    whole = F.greatest(F.floor((kept - reach) / BLOCK), F.lit(0)).cast("int")
    rest = F.concat(F.substring(text, whole * BLOCK + 1, kept - whole * BLOCK), more)
    return F.concat(F.slice(by_block, F.lit(1), whole), blocks(rest, gram, window))


def edited_likeness(docs: DataFrame, text: str = "text", doc: str = "doc_id", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint beside those of an edited copy and of the next document.

    Returns ``doc``, ``n_chars``, ``edited`` (the text, its last quarter, rounded down, replaced by as many first code
    points of the next row's text, or all of it), ``blocks``, ``edited_blocks``, ``near_edited``, ``near_next``. The next row
    is that of ``with_next``; one row alone is its own next. NULL and empty texts have no marks and are wholly like
    each other. Other columns are not returned. An empty table gives an empty table.
    """
    rows = with_next(docs, text, doc, gram, window).withColumnsRenamed({text: "__text", "blocks": "__blocks"})
    n = F.char_length("__text")
    rows = rows.withColumn("n_chars", n.cast("bigint")).withColumn("kept", n - F.floor(n / 4).cast("int"))
    rows = rows.withColumn("more", F.substring("next_text", F.lit(1), n - F.col("kept")))
    rows = rows.withColumn("edited_blocks", respliced(F.col("__blocks"), F.col("__text"), F.col("kept"), F.col("more"), gram, window))
    rows = rows.withColumn("own", hashes(F.col("__blocks")))
    return rows.select(
        doc, "n_chars", F.concat(F.substring("__text", F.lit(1), F.col("kept")), "more").alias("edited"),
        F.col("__blocks").alias("blocks"), "edited_blocks",
        likeness(F.col("own"), hashes(F.col("edited_blocks"))).alias("near_edited"),
        likeness(F.col("own"), hashes(F.col("next_blocks"))).alias("near_next"))
