"""Document chunks, nearest vectors, and an inverted-file index for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.operators import scoring


def chunk(documents: DataFrame, size: int, overlap: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole documents cut into runs of ``size`` words, each sharing ``overlap`` words with the next.

    The last chunk is the first one that reaches the end of the document.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must lie between 0 and size - 1")
    step = size - overlap
    words = F.split(F.trim(F.regexp_replace(text_col, "[ \t\r\n]+", " ")), " ")
    last = F.greatest(F.lit(0), F.ceil((F.size("_w") - size) / F.lit(step))).cast("int")
    # texts are cut inside the row, so what is exploded is the finished chunks and not the words once per chunk
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("_w", i * step + 1, size), " "))
    return documents.select(id_col, words.alias("_w")).select(id_col, F.posexplode(cut).alias("chunk_no", "text"))


#: Queries that a task holds at most, and pairs of query and vector that it is given at most.
HELD, PAIRS = 16_384, 2**30


def _best(
    vectors: DataFrame, sizes: dict[int, int], queries: DataFrame, asked: int, k: int, block_rows: int, query_rows: int,
) -> DataFrame:
    """The best k vectors of each query (query_id, vec_id, similarity, rank) among the lists that it probes.

    ``vectors`` has a ``list`` (``sizes`` of them by number, from 0), ``queries`` an array ``lists``. Lists are laid end to end
    and cut into even spans, a vector's place in its list being a hash of its id; queries are dealt into parts of up to
    ``HELD``. A task holds one part, lets the vectors of one span pass, ``block_rows`` against ``query_rows`` at a time, and
    leaves k rows per query: a query is sent once to each span that it probes, a vector once to each part.
    """
    spark = vectors.sparkSession
    sizes = sizes or {0: 1}
    n, parts = sum(sizes.values()), max(1, -(-asked // HELD))
    spans = max(-(-4 * spark.sparkContext.defaultParallelism // parts), -(-n * -(-asked // parts) // PAIRS))
    spans = max(1, min(spans, -(-n // block_rows)))
    span = -(-n // spans)
    counts = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)], np.int64)
    starts = np.concatenate(([0], np.cumsum(counts)))

    def of_list(values) -> Callable[[Column], Column]:
        told = F.array(*[F.lit(int(x)).cast("bigint") for x in values])
        return lambda i: F.get(told, i)

    size, start = of_list(counts), of_list(starts[:-1])
    first, last = of_list(starts[:-1] // span), of_list((starts[1:] - 1) // span)
    place = start(F.col("list")) + F.pmod(F.xxhash64("vec_id"), size(F.col("list")))
    told = vectors.select(
        F.floor(place / F.lit(span)).alias("span"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("own"),
        "list", F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    sent = queries.select("vec_id", "embedding", F.filter("lists", lambda i: size(i) > 0).alias("lists"))
    reached = F.array_distinct(F.flatten(F.transform("lists", lambda i: F.sequence(first(i), last(i)))))
    sent = sent.select("vec_id", "embedding", "lists", F.explode(reached).alias("span"))
    here = F.filter("lists", lambda i: (first(i) <= F.col("span")) & (last(i) >= F.col("span")))
    sent = sent.select(
        "span", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("own"), F.lit(scoring.QUERY).alias("list"),
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", here.alias("lists"))
    part = (F.col("span") * F.lit(parts) + F.col("own")).cast("int")
    met = sent.unionByName(told, allowMissingColumns=True).select(part.alias("part"), "list", "vec_id", "embedding", "lists")
    dealt = met.repartitionById(spans * parts, F.col("part")).sortWithinPartitions(F.shiftleft(F.col("part").cast("bigint"), 32) + F.col("list"))
    shape = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("similarity", pa.float64())])
    found = dealt.mapInArrow(scoring.searched(k, block_rows, query_rows, shape), "query_id long, vec_id long, similarity double")
    return _ranked(found, k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, block_rows: int = 1024, query_rows: int = 256) -> DataFrame:
    """The k vectors of largest cosine similarity per query vector, ties by the smaller id.

    Every pair is scored, ``block_rows`` vectors against ``query_rows`` queries at a time; see ``_best`` for what goes where.
    NULL vectors, zero vectors and vectors with NULL or NaN in them have no neighbours and are nobody's neighbour.
    """
    vectors, queries = (df.where(F.col("embedding").isNotNull()).select("vec_id", "embedding") for df in (vectors, queries))
    held, asked = vectors.count(), queries.count()
    every = queries.withColumn("lists", F.array(F.lit(0)))
    return _best(vectors.withColumn("list", F.lit(0)), {0: held} if held else {}, every, asked, k, block_rows, query_rows)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


#: The list of vectors without a direction (NULL, zero, NaN): kept in the index, never probed.
NOWHERE = -1


def _directions(vectors: DataFrame) -> DataFrame:
    """Vectors of length one, of those that have a direction."""

    def directions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, units = scoring.directions(batch.column("embedding"))
            at = pa.array(np.arange(len(units) + 1) * units.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(at, pa.array(units.ravel()))], ["direction"])

    return vectors.select("embedding").mapInArrow(directions, "direction array<double>")


def fit_centroids(vectors: DataFrame, lists: int, sample_rows: int = 100_000, seed: int = 7) -> np.ndarray:
    """At most ``lists`` centroids of directions, fitted on about ``sample_rows`` vectors at most, chosen by a hash of their id.

    The result, ``lists`` times the dimension, is what the driver holds and tasks get; ``lists`` bounds it.
    """
    n = _directions(vectors).count()
    if n > sample_rows:
        vectors = vectors.where(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)) < sample_rows)
    if n == 0:
        return np.zeros((0, 0))
    points = _directions(vectors).select(array_to_vector("direction").alias("features"))
    model = KMeans(k=max(2, min(lists, n)), seed=seed, maxIter=10, initMode="random").fit(points)
    return np.array(model.clusterCenters())


def _listed(vectors: DataFrame, centroids: np.ndarray, n: int) -> DataFrame:
    """Ids and vectors with the ``n`` lists whose centroids are nearest, nearest first, NULL without a direction."""
    half = (centroids**2).sum(axis=1) / 2

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            real, units = scoring.directions(batch.column("embedding"))
            known, order = np.zeros(batch.num_rows, bool), np.zeros((0, 0), int)
            if len(centroids) and len(real):
                known[real], scores = True, units @ centroids.T - half
                order = scores.argmax(axis=1)[:, None] if n == 1 else np.argsort(-scores, axis=1, kind="stable")[:, :n]
            at = pa.array(np.concatenate(([0], np.cumsum(known * order.shape[1]))), pa.int32())
            lists = pa.ListArray.from_arrays(at, pa.array(order.ravel(), pa.int32()), mask=pa.array(~known))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), lists], ["vec_id", "embedding", "lists"])

    given = vectors.select("vec_id", "embedding")
    return given.mapInArrow(listed, "vec_id {0}, embedding {1}, lists array<int>".format(*[kind for _, kind in given.dtypes]))


def build_index(
    vectors: DataFrame, path: str, lists: int = 256, sample_rows: int = 100_000, block_rows: int = 1024,
) -> None:
    """Write an inverted file of ``vectors`` (vec_id, embedding) to ``path``: every row in the list of its nearest centroid.

    Lists are folders; inside, vectors are packed into blocks of about ``block_rows``, so a search reads only the lists it
    probes and shuffles no vector. A list of any size is many blocks, dealt by a hash of the id. Vectors without a
    direction are kept in a list that is never probed. Centroids lie beside the lists.
    """
    spark = vectors.sparkSession
    centroids = fit_centroids(vectors, lists, sample_rows)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "list int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    nearest = F.coalesce(F.get("lists", F.lit(0)), F.lit(NOWHERE))
    placed = _listed(vectors, centroids, 1).select("vec_id", "embedding", nearest.alias("list"))
    blocks = max(1, -(-vectors.count() // (block_rows * max(1, len(centroids)))))
    dealt = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    packed = dealt.groupBy("list", "block").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("v_rows"))
    packed.hint("rebalance", F.col("list")).write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int, probes: int = 32, query_rows: int = 256,
) -> DataFrame:
    """The k nearest vectors per query (query_id, vec_id, similarity, rank) among the ``probes`` lists nearest to it.

    Similarities are exact; a neighbour in a list that was not probed is missed, so recall grows with ``probes`` and is
    whole when every list is probed. Only lists that some query probes are read, ``query_rows`` queries are scored at a time;
    queries without a direction find nothing. The columns of ``queries`` have the types that the indexed vectors had.
    """
    saved = sorted(spark.read.parquet(f"{path}/centroids").collect(), key=lambda r: r["list"])  # bounded by build_index
    centroids = np.array([r["centroid"] for r in saved]) if saved else np.zeros((0, 0))
    sent = _listed(queries, centroids, probes).where(F.col("lists").isNotNull())
    probed = [r["list"] for r in sent.select(F.explode("lists").alias("list")).distinct().collect()]  # bounded by build_index
    vector = "struct<vec_id:{0},embedding:{1}>".format(*[queries.schema[c].dataType.simpleString() for c in ("vec_id", "embedding")])
    held = spark.read.schema(f"v_rows array<{vector}>, list int").parquet(f"{path}/lists")  # an empty index has no files
    held = held.where(F.col("list").isin(probed))
    sizes = held.groupBy("list").agg(F.sum(F.size("v_rows.vec_id")).alias("n")).collect()
    vectors = held.select("list", F.explode("v_rows").alias("v")).select("list", "v.vec_id", "v.embedding")
    return _best(vectors, {r["list"]: r["n"] for r in sizes}, sent, queries.count(), k, 1024, query_rows)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the queries that have neighbours, and the share of the exact neighbours that were found."""
    hits = exact.select("query_id", "vec_id").join(
        found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hits.agg(F.count_distinct("query_id").alias("queries"), (F.count("hit") / F.count(F.lit(1))).alias("recall"))
