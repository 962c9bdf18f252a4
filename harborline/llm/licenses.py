"""License scans: TF-IDF cosine of lines and whole files to license templates, inherited along directories.

DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import without

#: The statements by which a license is declared in a header or a short licence file.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved."),
)
#: The texts of common licences, one file each; CC-BY-4.0 and CC-BY-NC-4.0 are made from the CC-BY-SA-4.0 text.
TEXTS = Path(__file__).parent / "license_texts"
WORD = "[a-z0-9]+"
FOUND = ("license", "license_cosine", "license_from", "license_depth")


@cache
def license_texts() -> tuple[tuple[str, str], ...]:
    return tuple((f.stem, f.read_text(encoding="utf-8")) for f in sorted(TEXTS.glob("*.txt")))


def terms(text: str) -> Counter:
    return Counter(re.findall(WORD, text.lower()))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def constant(ws: list[str]) -> Column:
    """An array of words, as one literal."""
    return F.split(F.lit(" ".join(ws)), " ")


def frequencies(files: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of files, and for each word of the templates the number of files that hold it."""
    held = F.array_intersect(constant(vocabulary), words(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    marked = F.explode(F.concat(F.array(F.lit("")), held))
    rows = files.select(marked.alias("w")).groupBy("w").count().collect()  # one row per word of the templates, and ''
    counts = {r["w"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


def weights(total: int, counts: dict[str, int], templates) -> dict[str, dict[str, float]]:
    """Per template the TF-IDF weight of its words, as a unit vector."""
    out = {}
    for name, text in templates:
        raw = {w: n * idf(total, counts.get(w, 0)) for w, n in terms(text).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out[name] = {w: v / norm for w, v in raw.items()}
    return out


def idf(total: int, count: int) -> float:
    return round(math.log((1 + total) / (1 + count)) + 1, 9)


def anchors(vectors: dict[str, dict[str, float]], threshold: float) -> list[str]:
    """Words of which a text must hold at least one to reach ``threshold`` with any template.

    A cosine is at most the length of the template's vector over the shared words. The lightest words are left out as
    long as their own length stays below the threshold, so a text with none of the others cannot reach it.
    """
    needed = set()
    for vector in vectors.values():
        left = 0.0
        for w, v in sorted(vector.items(), key=lambda p: (p[1], p[0])):
            left += v * v
            if left >= (threshold * (1 - 1e-9)) ** 2:
                needed.add(w)
    return sorted(needed)


def rare_anchors(vectors: dict[str, dict[str, float]], counts: dict[str, int], threshold: float) -> list[str]:
    """``anchors``, leaving out the words that most files hold first: licence texts weigh their common words heavily."""
    needed = set()
    for vector in vectors.values():
        left = 0.0
        for w, v in sorted(vector.items(), key=lambda p: (-counts.get(p[0], 0), p[1], p[0])):
            left += v * v
            if left >= (threshold * (1 - 1e-9)) ** 2:
                needed.add(w)
    return sorted(needed)


def rated(units: DataFrame, total: int, counts: dict[str, int], templates, threshold: float) -> DataFrame:
    """(``path``, ``unit``, ``license``, ``cosine``) of units (``path``, ``unit``, ``words``) at or over ``threshold``.

    Words outside the templates count with an IDF of 1, the weight of a word that every file holds. Cosines are
    rounded to six decimals before they are compared.
    """
    spark, vectors = units.sparkSession, weights(total, counts, templates)
    known = sorted({w for v in vectors.values() for w in v})
    scale = spark.createDataFrame([(w, idf(total, counts.get(w, 0))) for w in known], "w string, idf double")
    vector = spark.createDataFrame(
        [(n, w, v) for n, ws in vectors.items() for w, v in ws.items()], "license string, w string, weight double")
    tf = units.select("path", "unit", F.explode("words").alias("w")).groupBy("path", "unit", "w").agg(F.count("*").alias("tf"))
    weighed = tf.join(F.broadcast(scale), "w", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(1.0)))
    length = weighed.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = (
        weighed.join(F.broadcast(vector), "w")
        .groupBy("path", "unit", "license").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    return dots.join(length, ["path", "unit"]).select("path", "unit", "license", cosine.alias("cosine")).where(
        F.col("cosine") >= threshold)


def directory(path: Column) -> Column:
    """The directory of a path, '' for the top."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """A directory and all above it, down to the top ''."""
    parts = F.filter(F.split(folder, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def scan(
    files: DataFrame, path: str = "path", text: str = "text", templates=TEMPLATES,
    line_threshold: float = 0.6, file_threshold: float = 0.6, texts=None,
) -> DataFrame:
    """``files`` with ``license``, ``license_cosine``, ``license_from`` ('line', 'file', 'directory', NULL), ``license_depth``.

    Every line and every whole text is compared with each template: cosine of TF-IDF vectors over the words [a-z0-9]+
    in lower case, IDF = ln((1 + files) / (1 + files with the word)) + 1 over all files. A whole text at or over
    ``file_threshold`` makes the file a licence file ('file'), and so does one at or over it with one of ``texts``, the
    (name, text) of whole licences (``license_texts`` if None), weighed over their own words; otherwise its best line at or over ``line_threshold``
    is its header ('line'). The highest cosine wins, ties go to the license whose name sorts first. Other files take the
    license of the nearest directory at or above their own that holds a licence file; of several there, again the best,
    then the first by path. ``license_depth`` is the number of directory levels in between.

    Only files with one of the ``anchors`` are cut into words by line, which loses none. Directories are made distinct
    before ancestors are looked up, so a folder with a third of all files is looked up once.

    NULL text is empty; a NULL path is the top-level file ''. Rows that repeat a path are one file: the words of all
    of them are judged together, by line as they come, and each row gets the result. Input columns with the names of
    the results are replaced. An empty table gives an empty table.
    """
    files = without(files, *FOUND)
    texts = license_texts() if texts is None else texts
    vocabulary = sorted({w for _, t in (*templates, *texts) for w in terms(t)})
    total, counts = frequencies(files, text, vocabulary)
    needed = anchors(weights(total, counts, templates), min(line_threshold, file_threshold))
    own = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit(""))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    wanted = F.array(*map(F.lit, needed))
    near = files.select(own.alias("path"), body.alias("body"), words(body).alias("words")).where(
        F.arrays_overlap("words", wanted))
    one = F.array(F.struct(F.lit(-1).alias("unit"), F.col("words").alias("words")))
    each = F.transform(F.split("body", "\n"), lambda x, i: F.struct(i.alias("unit"), words(x).alias("words")))
    units = near.select("path", F.inline(F.concat(one, F.filter(each, lambda u: F.arrays_overlap(u["words"], wanted)))))
    hits = rated(units, total, counts, templates, min(line_threshold, file_threshold))
    if texts:
        rare = rare_anchors(weights(total, counts, texts), counts, file_threshold)
        whole = files.select(own.alias("path"), F.lit(-1).alias("unit"), words(body).alias("words")).where(
            F.arrays_overlap("words", constant(rare)))
        hits = hits.unionByName(rated(whole, total, counts, texts, file_threshold))
    kind = F.when(F.col("unit") == -1, F.lit("file")).otherwise(F.lit("line"))
    limit = F.when(F.col("unit") == -1, F.lit(file_threshold)).otherwise(F.lit(line_threshold))
    hits = hits.withColumn("kind", kind).where(F.col("cosine") >= limit)
    top = F.min(F.struct(F.col("kind"), (-F.col("cosine")).alias("less"), F.col("license")))  # 'file' before 'line'
    direct = hits.groupBy("path").agg(top.alias("t")).select(
        "path", F.col("t.license").alias("license"), (-F.col("t.less")).alias("cosine"), F.col("t.kind").alias("kind"))
    granted = direct.where("kind = 'file'").groupBy(
        F.array_join(F.filter(F.split(directory(F.col("path")), "/"), lambda p: p != ""), "/").alias("folder")
    ).agg(F.min(F.struct((-F.col("cosine")).alias("less"), "path", "license")).alias("g"))
    folders = files.select(directory(own).alias("own")).distinct()
    above = folders.select("own", F.posexplode(F.reverse(ancestors(F.col("own")))).alias("up", "folder"))
    nearest = above.join(granted, "folder").groupBy("own").agg(F.min(F.struct("up", "g")).alias("n")).select(
        F.col("own").alias("__own"), F.col("n.g.license").alias("__of_folder"), (-F.col("n.g.less")).alias("__folder_cosine"),
        F.col("n.up").alias("__up"))
    direct = direct.select(
        F.col("path").alias("__p"), F.col("license").alias("__l"), F.col("cosine").alias("__cosine"), F.col("kind").alias("__kind"))
    told = files.withColumns({"__path": own, "__dir": directory(own)})
    told = told.join(direct, told["__path"] == direct["__p"], "left").join(nearest, told["__dir"] == nearest["__own"], "left")
    return told.select(
        *[F.col(f"`{c}`") for c in files.columns],
        F.coalesce("__l", "__of_folder").alias("license"),
        F.coalesce("__cosine", "__folder_cosine").alias("license_cosine"),
        F.coalesce("__kind", F.when(F.col("__of_folder").isNotNull(), F.lit("directory"))).alias("license_from"),
        F.when(F.col("__l").isNull(), F.col("__up")).cast("bigint").alias("license_depth"),
    )
