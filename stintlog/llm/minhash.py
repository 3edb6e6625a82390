"""Near-duplicates by HyperMinHash: sketches, bands, a corrected estimate, then the full sets.

A register keeps, of the smallest hash of its bucket, the count of leading zeros and the mantissa
bits that follow, 16 bits in all. Bands of registers give candidates, the share of equal registers
corrected for chance collisions sifts them, and the sets of shingles decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlog.llm.common import documents, written
from stintlog.llm.components import components

SHINGLE = 5  # words
PERCENT = 75  # of the union that two sets must share to be linked

# 32 bands of 4 registers: two sets that share exactly three quarters meet in no band with a
# probability of (1 - 0.75 ** 4) ** 32 = 5e-6, and sets that share more with less.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10

# A pair at the limit has an estimate under this with a probability of about 1e-6.
LEAST_ESTIMATE = 0.55

# Classes around a centre that are compared in one go; more are split into pairs of blocks.
BLOCK = 512
_CELL = ["centre", "block_a", "block_b"]

_rng = np.random.Generator(np.random.PCG64(9))
PLACES = _rng.integers(1 << 63, size=SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIXES = _rng.integers(1 << 63, size=REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text; one of all words if they are few."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only 0x20 and 0x09-0x0D
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    width = min(n, SHINGLE)
    mixed = np.full(n - width + 1, width * int(PLACES[SHINGLE]) % 2**64, dtype=np.uint64)
    for i in range(width):
        mixed += hashes[i : n - width + 1 + i] * PLACES[i]
    mixed ^= mixed >> np.uint64(33)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(33)
    return np.unique(mixed)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The registers of a set that is not empty: leading zeros of the smallest hash, then its mantissa."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(low, (hashes[i : i + 512, None] * MIXES).min(axis=0), out=low)
    fraction, exponent = np.frexp((low >> np.uint64(11)).astype(np.float64))
    mantissa = np.maximum((fraction * 2 - 1) * (1 << MANTISSA), 0).astype(np.uint16)
    return (53 - exponent).astype(np.uint16) << np.uint16(MANTISSA) | mantissa


def corrected(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, less those equal by chance.

    Smallest hashes of different sets share leading zeros and mantissa about as often as two
    exponential variables fall into one of the cells, whose widths follow their position.
    """
    n_a, n_b = n_a.astype(np.float64), n_b.astype(np.float64)
    chance = 0.72 * 2.0**-MANTISSA * n_a * n_b / (n_a + n_b) ** 2
    return np.maximum((equal / REGISTERS - chance) / (1 - chance), 0)


def _may_link(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    sizes = 100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b)
    return sizes & (corrected(equal, n_a, n_b) >= LEAST_ESTIMATE)


def _sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sets = [shingle_set(t) for t in frame["text"]]
        yield pd.DataFrame(
            {
                "doc_id": frame["doc_id"],
                "text_key": frame["text_key"],
                "n_shingles": [len(s) for s in sets],
                "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "sketch": [sketch(s).tobytes() if len(s) else None for s in sets],
            }
        )


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sets = [shingle_set(t) for t in frame["text"]]
        same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == k for s, k in zip(sets, frame["set_key"])]
        out = pd.DataFrame({"class_id": frame["class_id"], "hashes": [s.view(np.int64) for s in sets]})
        yield out[same]


def _estimated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            a, b = (np.frombuffer(b"".join(frame[c]), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b"))
            yield frame.loc[_may_link((a == b).sum(axis=1), frame["n_a"].to_numpy(), frame["n_b"].to_numpy()), ["a", "b"]]


def _links_in(cell: pd.DataFrame) -> pd.DataFrame:
    """Links that join the labels of a cell, each confirmed on the full sets.

    What a link joins is one label from there on, so a cell gives fewer links than it has labels,
    however many of its pairs are near.
    """
    regs = np.frombuffer(b"".join(cell["sketch"]), dtype=np.uint16).reshape(-1, REGISTERS)
    ids, labels, sizes = cell["class_id"].to_numpy(), cell["label"].to_numpy().copy(), cell["n"].to_numpy()
    block, first = cell["block"].to_numpy(), int(cell["block_a"].iloc[0])
    inside = first == int(cell["block_b"].iloc[0])
    words, flat = np.unique(np.concatenate(cell["hashes"].tolist()), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)]
    mark = np.zeros(len(words), dtype=np.int32)
    out = []
    for i in np.flatnonzero(block == first):
        others = (np.arange(len(ids)) > i) if inside else (block != first)
        others = np.flatnonzero(others & (labels != labels[i]))
        if not len(others):
            continue
        equal = (regs[others] == regs[i]).sum(axis=1)
        others = others[_may_link(equal, np.full(len(others), sizes[i]), sizes[others])]
        own = flat[starts[i] : starts[i + 1]]
        mark[own] = 1
        for j in others.tolist():
            if labels[j] != labels[i]:
                both = int(mark[flat[starts[j] : starts[j + 1]]].sum())
                if 100 * both >= PERCENT * (sizes[i] + sizes[j] - both):
                    out.append((ids[i], ids[j]))
                    labels[labels == labels[j]] = labels[i]
        mark[own] = 0
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _across(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of each run of equal (centre, block_a, block_b); rows come sorted so."""
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        for key, cell in frame.groupby(_CELL, sort=False):
            if key != last and held:
                yield _links_in(pd.concat(held, ignore_index=True))
                held = []
            last = key
            held.append(cell)
    if held:
        yield _links_in(pd.concat(held, ignore_index=True))


def _sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """class_id, hashes: the full sets of some classes, made from the text of the row that stands for each."""
    wanted = ids.distinct().join(classes, "class_id").select("class_id", "set_key", "text_key", "rep")
    texts = docs.join(wanted, (docs["text_key"] == wanted["text_key"]) & docs["doc_id"].eqNullSafe(wanted["rep"]))
    return written(
        texts.select("class_id", "set_key", "text")
        .mapInPandas(_sets, "class_id long, hashes array<long>")
        .dropDuplicates(["class_id"]),
        "sets",
    )


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets share enough."""
    sets = _sets_of(docs, classes, pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")))
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", (F.size("set_a") + F.size("set_b")).alias("sizes"), shared.alias("shared"))
    return both.filter(100 * F.col("shared") >= PERCENT * (F.col("sizes") - F.col("shared"))).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, text_key (a hash of the text).

    Rows with equal sets form a class, so copies cost one sketch from there on. In every band the
    classes of a key are compared with the key's smallest class, its centre, which settles most
    groups. What is still apart after that is compared among the classes of a centre, in blocks of
    bounded size, however many they are; no pairs leave a block but links that join components.
    Links are confirmed on full sets of 64-bit shingle hashes.

    component_id is the smallest doc_id reachable over links, and kept is doc_id = component_id.
    A null or empty text, or one without words, has no shingles and is linked with nothing. Rows
    that repeat a doc_id are one document: they share a component. A row without id joins what its
    text links it to, and is kept only where no id is reachable. An empty table gives no rows.
    """
    rows = documents(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    made = "doc_id long, text_key long, n_shingles long, set_key binary, sketch binary"
    sketched = written(rows.mapInPandas(_sketched, made), "sketches")
    classes = written(
        sketched.filter("set_key is not null")
        .groupBy("set_key")
        # The row that stands for the class, one with an id if there is any.
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", F.col("n_shingles").alias("n"), "sketch")).alias("r"))
        .select(
            F.monotonically_increasing_id().alias("class_id"), "set_key", F.col("r.doc_id").alias("rep"),
            "r.text_key", "r.n", "r.sketch",
        ),
        "classes",
    )
    bits = F.sequence(F.lit(0), F.lit(BANDS - 1))
    keys = F.transform(bits, lambda i: F.xxhash64(i, F.col("sketch").substr(i * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    banded = classes.select("class_id", F.explode(keys).alias("band_key"))
    centres = (
        banded.groupBy("band_key")
        .agg(F.min("class_id").alias("centre"), F.count(F.lit(1)).alias("in_band"))
        .filter("in_band > 1")
    )
    # Members of shared keys; everything after reads these only.
    shared = written(banded.join(centres, "band_key"), "shared-bands")

    parts = classes.select("class_id", "n", "sketch")
    pairs = shared.filter("class_id <> centre").select(F.col("centre").alias("a"), F.col("class_id").alias("b")).distinct()
    pairs = pairs.join(parts.toDF("a", "n_a", "sketch_a"), "a").join(parts.toDF("b", "n_b", "sketch_b"), "b")
    pairs = written(pairs.mapInPandas(_estimated, "a long, b long"), "pairs")
    links = written(_linked(rows, classes, pairs), "links")

    labels = components(links)
    label = F.coalesce("label", "class_id").alias("label")
    # Classes that share a key share its centre: a cell holds all that may be near each other.
    member = shared.select("centre", "class_id").distinct()
    member = member.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select("centre", "class_id", label)
    member = written(member, "cell-members")
    mixed = (
        member.groupBy("centre")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
        .filter("low <> high")
        .select("centre", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    member = member.join(mixed, "centre")
    cells = (
        member.withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "class_id", "centre", "label", "block",
            F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"),
        )
        .join(parts, "class_id")
        .join(_sets_of(rows, classes, member.select("class_id")), "class_id")
    )
    across = written(
        cells.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInPandas(_across, "a long, b long"),
        "links",
    )
    # Rows of one document are linked whatever their texts are.
    known = sketched.filter("set_key is not null and doc_id is not null").select("doc_id", "set_key").distinct()
    known = known.join(classes.select("set_key", "class_id"), "set_key")
    first = known.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).filter("a <> b")
    same_doc = known.join(first, "doc_id").select("a", F.col("class_id").alias("b")).filter("a <> b")

    labels = components(links.union(across).union(same_doc))
    of_class = classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select("set_key", "rep", label)
    lowest = of_class.groupBy("label").agg(F.min("rep").alias("lowest"))
    of_class = of_class.join(lowest, "label").select("set_key", "lowest")
    component = F.coalesce("lowest", "doc_id")
    return sketched.join(of_class, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, one document of each component, with all their columns."""
    kept = near_duplicates(docs, id_col, text_col).filter("kept").select("doc_id", "text_key").distinct()
    kept = kept.toDF("__kept_id", "__kept_key")
    marked = docs.withColumn("__key", F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
    same = docs[id_col].cast("long").eqNullSafe(kept["__kept_id"]) & (marked["__key"] == kept["__kept_key"])
    return marked.join(kept, same, "left_semi").select(*docs.columns)
