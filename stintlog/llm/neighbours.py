"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected at random, shifted, and put on several Hilbert curves. Each curve is sorted
by range partitioning; a query is compared with the rows of a window around it on every curve,
and what the windows yield is merged and reranked. The width of the window is measured, not
guessed: it is the least that finds a given share of the true neighbours of sampled queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlog.llm.common import written
from stintlog.llm.hilbert import hilbert_positions

CURVES, DIMS, BITS = 8, 4, 14
SAMPLED = 128  # queries whose true neighbours are searched to measure the window
FOUND = 0.96  # share of those neighbours that the windows must contain
LEAST_BLOCK, MOST_BLOCK = 1_024, 65_536  # rows of a curve that one task compares at once


def taking_part(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector, one row for each id, of the rows that can be compared.

    No part take rows without id, and vectors that are null, all zero, or hold a null or a number
    that is not finite, or have another length than most. Of rows that repeat an id, the one with
    the smallest vector takes part.
    """
    x = F.col("vector")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda e: e != 0))
    lengths = rows.groupBy(F.size(x).alias("length")).count().orderBy(F.desc("count"), "length").limit(1)
    rows = rows.join(F.broadcast(lengths.select("length")), F.size(x) == F.col("length")).select("vec_id", "vector")
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1)


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """The places of the largest scores, ties to the smaller id, without those of minus infinity."""
    if len(scores) > most:
        limit = scores[np.argpartition(-scores, most - 1)[most - 1]]
        among = np.flatnonzero((scores >= limit) & (scores > -np.inf))
    else:
        among = np.flatnonzero(scores > -np.inf)
    return among[np.lexsort((ids[among], -scores[among]))[:most]]


def _searched(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, most: int, near=None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places, scores) of the best rows; ``near`` says which rows a slice of queries may see.

    Scores are summed pair by pair, so a pair has the same score wherever it is found.
    """
    for i in range(0, len(queries), 256):
        scores = queries[i : i + 256] @ rows.T
        if near is not None:
            scores[~near(slice(i, i + 256))] = -np.inf
        for j, line in enumerate(scores):
            best = _best(line, ids, most)
            yield i + j, best, (rows[best] * queries[i + j]).sum(axis=1)


def _first(df: DataFrame, by: str, order: list[Column], most: int) -> DataFrame:
    """The first rows of each group; Spark cuts groups before the shuffle as well."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= most)


def curve_ranks(classes: DataFrame, dims: int, seed: int) -> DataFrame:
    """curve, rank, class_id, low, vector: every vector's place on every curve."""
    rng = np.random.Generator(np.random.PCG64(seed))
    axes = [np.linalg.qr(rng.normal(size=(dims, min(DIMS, dims))))[0] for _ in range(CURVES)]
    shifts = rng.uniform(0, 1, size=(CURVES, min(DIMS, dims)))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = _matrix(frame["vector"])
            unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
            for curve, (axis, shift) in enumerate(zip(axes, shifts)):
                # A unit vector's projections lie within 1 of 0: the grid spans that and the shift.
                grid = ((unit @ axis + 1 + shift) / 3 * ((1 << BITS) - 1)).astype(np.int64)
                yield frame.assign(curve=curve, pos=hilbert_positions(grid, BITS))

    out = "class_id long, low long, vector array<double>, curve int, pos long"
    along = classes.select("class_id", "low", "vector").mapInPandas(place, out)
    order = ["curve", "pos", "class_id"]
    sorted_ = written(
        along.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("mark", F.monotonically_increasing_id()),
        "curves",
    )
    # Rows before each partition: one number a partition and curve.
    part = F.shiftright("mark", 33)
    counts = sorted_.groupBy(part.alias("part"), "curve").count().orderBy("part", "curve").collect()
    offsets, starts, total = {}, {}, 0
    for row in counts:
        starts.setdefault(row["curve"], total)
        offsets.setdefault(row["part"], total)
        total += row["count"]
    spark = classes.sparkSession
    before = spark.createDataFrame([*offsets.items()] or [(0, 0)], "part long, before long")
    start = spark.createDataFrame([*starts.items()] or [(0, 0)], "curve int, start long")
    inside = F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = sorted_.withColumn("part", part).join(before, "part").join(start, "curve")
    return ranked.select("curve", (F.col("before") + inside - F.col("start")).alias("rank"), "class_id", "low", "vector")


def _window(ranked: DataFrame, classes: DataFrame, sample: DataFrame, most: int) -> int:
    """The least distance of ranks within which the sampled queries' true neighbours lie.

    The sample is bounded, its neighbours are searched among all rows.
    """
    asked = sample.collect()
    ids = np.array([r["class_id"] for r in asked])
    queries = np.array([r["vector"] for r in asked], dtype=np.float64)

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, own, low = _matrix(frame["vector"]), frame["class_id"].to_numpy(), frame["low"].to_numpy()
            for i, best, scores in _searched(queries, rows, low, most + 1):
                yield pd.DataFrame({"query": ids[i], "class_id": own[best], "score": scores})

    true = classes.select("class_id", "low", "vector").mapInPandas(exact, "query long, class_id long, score double")
    true = _first(true.filter("query <> class_id"), "query", [F.desc("score"), F.col("class_id")], most)
    at = ranked.select("curve", "rank", "class_id")
    pairs = true.select("query", "class_id").join(at, "class_id")
    asking = at.join(F.broadcast(classes.sparkSession.createDataFrame([(int(i),) for i in ids], "class_id long")), "class_id")
    asking = asking.select("curve", F.col("class_id").alias("query"), F.col("rank").alias("own"))
    apart = pairs.join(asking, ["query", "curve"]).groupBy("query", "class_id").agg(F.min(F.abs(F.col("rank") - F.col("own"))).alias("apart"))
    apart = sorted(r["apart"] for r in apart.collect())  # SAMPLED * most numbers at most
    return int(apart[min(len(apart) - 1, int(FOUND * len(apart)))]) if apart else 1


def nearest(vectors: DataFrame, most: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for each query, by largest inner product.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own. Equal vectors are one class on the curves with the ``most`` + 1 smallest ids, which is all
    that any query can show of them; so a vector that many rows share costs no more than another.
    Ties go to the smaller id. See ``taking_part`` for rows left out. Fewer rows than ``most``
    come back where there are fewer candidates; no rows for an empty table.
    """
    spark = vectors.sparkSession
    rows = written(taking_part(vectors, id_col, vector_col), "vectors")
    copies = _first(rows, "vector", [F.col("vec_id")], most + 1)
    asks = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vector").agg(F.lit(True).alias("asks"))
    classes = written(
        copies.groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .join(asks, "vector", "left")
        .select(
            F.monotonically_increasing_id().alias("class_id"), "vector", "ids", F.col("ids")[0].alias("low"),
            F.coalesce("asks", F.lit(False)).alias("asks"),
        ),
        "classes",
    )
    total = classes.count()
    asking = classes.filter("asks")
    sample = asking.orderBy(F.xxhash64("class_id")).limit(SAMPLED)
    if not total or sample.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = len(classes.select("vector").first()["vector"])
    ranked = written(curve_ranks(classes, dims, seed), "ranks")
    window = max(most, _window(ranked, classes, sample, most))
    block = min(MOST_BLOCK, max(LEAST_BLOCK, window // 2))

    def blocks(rank: Column) -> Column:
        return F.floor(rank / F.lit(block))

    beside = ranked.withColumn("block", blocks(F.col("rank")))
    asked = ranked.join(asking.select("class_id"), "class_id", "left_semi").select(
        F.col("curve").alias("on_curve"), "rank", F.col("class_id").alias("query"), F.col("vector").alias("wanted")
    )
    reach = F.sequence(
        blocks(F.greatest(F.col("rank") - window, F.lit(0))),
        blocks(F.least(F.col("rank") + window, F.lit(total - 1))),
    )
    asked = asked.select("on_curve", F.col("rank").alias("own"), "query", "wanted", F.explode(reach).alias("in_block"))

    def compare(_: tuple, there: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(there) and len(queries):
            ranks, ids, low = (there[c].to_numpy() for c in ("rank", "class_id", "low"))
            own, query = queries["own"].to_numpy(), queries["query"].to_numpy()
            near = lambda part: np.abs(own[part, None] - ranks[None, :]) <= window
            for i, best, scores in _searched(_matrix(queries["wanted"]), _matrix(there["vector"]), low, most + 1, near):
                found.append(pd.DataFrame({"query": query[i], "class_id": ids[best], "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query": [], "class_id": [], "score": []})

    pairs = (
        beside.groupBy("curve", "block")
        .cogroup(asked.groupBy("on_curve", "in_block"))
        .applyInPandas(compare, "query long, class_id long, score double")
        .dropDuplicates(["query", "class_id"])
        .join(classes.select("class_id", "ids"), "class_id")
        .select("query", "score", F.explode("ids").alias("vec_id"))
    )
    order = [F.desc("score"), F.col("vec_id")]
    pairs = _first(pairs, "query", order, most + 1).drop("place")
    members = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).join(
        classes.select("vector", F.col("class_id").alias("query")), "vector"
    )
    members = members.select("query", F.col("vec_id").alias("query_id"))
    out = pairs.join(members, "query").filter("query_id <> vec_id")
    out = _first(out, "query_id", order, most)
    return out.select("query_id", F.col("place").cast("int").alias("rank"), "vec_id", "score")
