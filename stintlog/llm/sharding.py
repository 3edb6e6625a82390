"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

Rows are frozen in parts. A matrix drawn without replacement says how many rows of each part go
to each block of a shard. Each part permutes its rows and sends them so, each block permutes what
it receives; block sizes are given, so slots are gapless without a global sort.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlog.llm.common import documents, written

# Rows of a part or block, and how many parts or blocks there are at most: the matrix on the
# driver is bounded by MOST * MOST counts, and past that parts and blocks grow instead.
ROWS_PER_PART = 16_384
MOST = 4_096

OUT = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"


def block_sizes(rows: int, shards: int, rows_per_block: int = ROWS_PER_PART, most: int = MOST) -> list[tuple[int, int, int]]:
    """(shard, first slot, size) of every block; shards differ by one row at most, as do a shard's blocks."""
    out = []
    for shard in range(shards):
        size = rows // shards + (shard < rows % shards)
        n = max(1, min(max(1, most // shards), -(-size // rows_per_block)))
        start = 0
        for block in range(n):
            length = size // n + (block < size % n)
            out.append((shard, start, length))
            start += length
    return out


# The library draws for fewer than this many of a kind.
LARGE = 1_000_000_000


def drawn(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many good ones ``n`` draws without replacement have, for any numbers.

    Large ones by the inverse of the distribution around its mode: neighbouring probabilities are
    simple ratios of each other, and beyond 12 standard deviations there is nothing a double can hold.
    """
    if max(good, bad) < LARGE:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    share = good / (good + bad)
    wide = int(12 * (n * share * (1 - share)) ** 0.5) + 40
    start, stop = max(low, mode - wide), min(high, mode + wide)
    k = np.arange(start, stop, dtype=np.float64)
    with np.errstate(divide="ignore"):
        steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.r_[0.0, np.cumsum(steps)]
    total = np.cumsum(np.exp(weight - weight.max()))
    return start + int(np.searchsorted(total, rng.random() * total[-1], side="right"))


def communication_matrix(parts: list[int], targets: list[int], seed: int) -> np.ndarray:
    """How many rows of each part go to each target: a draw with exactly these sums of rows and columns."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(targets, dtype=np.int64)
    matrix = np.zeros((len(parts), len(targets)), dtype=np.int64)
    for i, n in enumerate(parts):
        rest, need = int(left.sum()), n
        # One binary hypergeometric draw per target, conditional on those before it.
        for j in np.flatnonzero(left):
            if not need:
                break
            rest -= int(left[j])
            got = drawn(rng, int(left[j]), rest, need) if rest else need
            matrix[i, j] = got
            need -= got
        left -= matrix[i]
    return matrix


def shuffle_to_shards(docs: DataFrame, shards: int = 24, seed: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its shard and slot, under the law ``rows``.

    Shard sizes differ by one row at most; slots of a shard run from 0 without gaps; each
    arrangement is equally likely. ``size`` is the bytes of the text in UTF-8 plus 8 (null text:
    none). Null ids and repeated rows are rows like others; an empty table gives no rows.
    Only id, size and checksum travel, 24 bytes a row and no text.
    """
    spark = docs.sparkSession
    rows = documents(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    rows = written(rows, "shard-rows")
    total = rows.count()
    n_parts = max(1, min(MOST, -(-total // ROWS_PER_PART)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(n_parts)).cast("int"))
    sizes = dict(rows.groupBy("part").count().collect())  # MOST rows at most
    parts = sorted(sizes)
    blocks = block_sizes(total, shards)
    matrix = communication_matrix([sizes[p] for p in parts], [b[2] for b in blocks], seed)
    plan = spark.createDataFrame(
        pd.DataFrame({"part": pd.Series(parts, dtype="int32"), "counts": [m.tobytes() for m in matrix]}),
        "part int, counts binary",
    )

    def send(key: tuple, part: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row_id", ignore_index=True)
        order = np.random.Generator(np.random.PCG64([seed, 1, int(key[0])])).permutation(len(part))
        sent = part.iloc[order].drop(columns="part")
        each = np.frombuffer(counts["counts"].iloc[0], dtype=np.int64)
        return sent.assign(block=np.repeat(np.arange(len(each), dtype=np.int32), each))

    def arrange(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("row_id", ignore_index=True)
        order = np.random.Generator(np.random.PCG64([seed, 2, int(key[0])])).permutation(len(block))
        shard, start, _ = blocks[int(key[0])]
        out = block[["doc_id", "size", "text_crc32"]].iloc[order]
        return out.assign(law="rows", shard=shard, slot=np.arange(start, start + len(block)), grown_shard=None)

    sent = (
        rows.groupBy("part")
        .cogroup(plan.groupBy("part"))
        .applyInPandas(send, "doc_id long, size long, text_crc32 long, row_id long, block int")
    )
    return sent.groupBy("block").applyInPandas(arrange, OUT)
