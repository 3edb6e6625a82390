"""Suffix-array dedup: removes every byte that a repeated string of 200 bytes covers.

Windows of 200 bytes are dealt by an anchor: the smallest hash of the k-grams in the window. Equal
windows have equal anchors at equal places, so they meet under one key, and the windows of a
document that share an anchor are one chunk of text. Chunks whose anchor occurs once are done.
Equal chunks are repeats as they stand. What is left, chunks that share an anchor but differ,
goes through a Burrows-Wheeler transform in batches: intervals are extended backwards breadth
first, which yields common prefixes by increasing length and stops at 200.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlog.llm.common import documents, remove, work_folder, written, written_at

LENGTH = 200  # bytes of a string that counts as a repeat
GRAM = 24  # bytes of an anchor

# Text is chunked in pieces of at most this many window starts, which bounds the memory of a task.
STRETCH = 1 << 22
_PLACE_BITS = 24

# Different chunks of an anchor that go into one batch together; beyond that the anchor is
# extended, which splits the windows of each chunk between two keys.
GROUP = 2_048
BATCH_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(10))
_OF_BYTE = _rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 60)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_hashes(data: np.ndarray, up: np.ndarray, down: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the k-gram at each place; ``up`` and ``down`` are powers of the base and its inverse."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_OF_BYTE[data] * up[:n], out=sums[1:])
    out = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def anchors(hashes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each window start the place of the smallest gram in the window, the leftmost of equals."""
    span = length - gram + 1
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < span:
        keys = np.minimum(keys[: len(keys) - (span - width)], keys[span - width :])
    return (keys & low).astype(np.int64)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open spans, in order, as maximal runs."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def chunks(data: bytes, up: np.ndarray, down: np.ndarray) -> tuple[list[tuple], list[tuple[int, int]]]:
    """Chunks of a text as (anchor hash, content hash, start, bytes, anchor place in it), and its local repeats.

    Chunks that a text holds twice are spans of the second list; one of them stays in the first.
    """
    found: dict[tuple[int, int], tuple] = {}
    again: list[tuple[int, int]] = []
    text = np.frombuffer(data, dtype=np.uint8)
    for base in range(0, max(0, len(text) - LENGTH + 1), STRETCH):
        part = text[base : base + STRETCH + LENGTH - 1]
        hashes = gram_hashes(part, up, down)
        place = anchors(hashes)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        at = place[first]
        for h, s, e, a in zip(hashes[at].tolist(), first.tolist(), last.tolist(), at.tolist()):
            s, e, a = s + base, e + base + LENGTH, a + base
            c = xxhash.xxh3_64_intdigest(data[s:e])
            if (h, c) in found:
                one = found[h, c]
                if one[5]:
                    again.append((one[2], one[2] + one[3]))
                    found[h, c] = (*one[:5], False)
                again.append((s, e))
            else:
                found[h, c] = (h, c, s, e - s, a - s, True)
    return list(found.values()), merged(again)


_SIGN = 1 << 63


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGN else x


CHUNKS = "doc_id long, text_key long, h long, c long, s int, n int, a int, fresh boolean"


def _chunked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunk rows; rows without h are local repeats [s, s + n)."""
    up, down = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)
    names = ["doc_id", "text_key", "h", "c", "s", "n", "a", "fresh"]
    for frame in frames:
        rows = []
        for doc_id, key, text in zip(frame["doc_id"], frame["text_key"], frame["text"]):
            data = text.encode("utf-8", "surrogatepass")
            if (need := min(len(data), STRETCH + LENGTH)) > len(up):
                up, down = _powers(_BASE, 2 * need), _powers(_INVERSE, 2 * need)
            found, again = chunks(data, up, down)
            rows += [(doc_id, key, _signed(h), _signed(c), s, n, a, fresh) for h, c, s, n, a, fresh in found]
            rows += [(doc_id, key, None, None, s, e - s, 0, False) for s, e in again]
            if len(rows) > 100_000:
                yield _frame(rows, names)
                rows = []
        if rows:
            yield _frame(rows, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "h": "Int64", "c": "Int64"})


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; the last symbol, or each end of a text, must be unique."""
    n, top = len(symbols), int(symbols.max()) + 1
    rank = symbols.astype(np.int64)
    step = 1
    while True:
        behind = np.zeros(n, dtype=np.int64)
        behind[: n - step] = rank[step:] + 1 if step < n else 0
        keys = rank * (top + 1) + behind
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        new = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        top, step = int(new[-1]) + 1, 2 * step
        if top == n:
            return order


def repeated_suffixes(symbols: np.ndarray, length: int) -> np.ndarray:
    """Places whose next ``length`` symbols occur elsewhere too.

    From the interval of the empty string, each interval is extended backwards by every symbol
    before its suffixes. An extension to [lo, hi) at depth d has common prefix d with what follows
    at hi, unless a shorter one has been found there; only new entries are extended further. What
    has no entry when ``length`` is reached shares at least so much with its predecessor.
    """
    n = len(symbols)
    order = suffix_array(symbols)
    before = symbols[order - 1].astype(np.int64)  # the Burrows-Wheeler transform
    by_symbol = np.argsort(before, kind="stable")
    forward = np.empty(n, dtype=np.int64)  # from a suffix to the one that is a symbol longer
    forward[by_symbol] = np.arange(n)
    top = int(symbols.max()) + 1
    known = np.zeros(n + 1, dtype=bool)
    known[0] = known[n] = True
    lo, hi = np.array([0]), np.array([n])
    for depth in range(length):
        if not len(lo):
            break
        sizes = hi - lo
        ends = np.cumsum(sizes)
        number = np.repeat(np.arange(len(lo)), sizes)
        at = np.arange(ends[-1]) + np.repeat(lo - (ends - sizes), sizes)
        keys = number * top + before[at]
        by_key = np.argsort(keys, kind="stable")
        keys = keys[by_key]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        count = np.diff(np.r_[first, len(keys)])
        new_lo = forward[at[by_key[first]]]
        new_hi = new_lo + count
        fresh = ~known[new_hi]
        known[new_hi] = True
        # Intervals of single symbols all start off, also the last one, which ends at a known place.
        lo, hi = (new_lo, new_hi) if depth == 0 else (new_lo[fresh], new_hi[fresh])
    same = np.flatnonzero(~known[:n])
    return np.unique(np.r_[order[same], order[same - 1]])


def repeats_between(texts: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each text the spans covered by strings of ``length`` bytes that start elsewhere too."""
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.empty(int(sizes.sum()) + len(texts), dtype=np.int64)
    for i, (t, s) in enumerate(zip(texts, starts.tolist())):
        symbols[s : s + len(t)] = np.frombuffer(t, dtype=np.uint8)
        symbols[s + len(t)] = -1 - i  # its own end mark, so nothing matches across texts
    symbols += len(texts)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    places = repeated_suffixes(symbols, length)
    if len(places):
        of = np.searchsorted(starts, places, side="right") - 1
        cut = np.flatnonzero(np.r_[True, (places[1:] != places[:-1] + 1) | (of[1:] != of[:-1])])
        for i, j in zip(cut, np.r_[cut[1:], len(places)] - 1):
            t = int(of[i])
            out[t].append((int(places[i] - starts[t]), int(places[j] - starts[t]) + length))
        out = [merged(spans) for spans in out]
    return out


def _transformed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans (id, off, n) within the chunks of each batch; rows come sorted by h."""

    def batch(held: list[tuple[int, bytes]]) -> pd.DataFrame:
        spans = repeats_between([t for _, t in held])
        rows = [(i, s, e - s) for (i, _), found in zip(held, spans) for s, e in found]
        return pd.DataFrame(rows, columns=["id", "off", "n"])

    held: list[tuple[int, bytes]] = []
    size, last = 0, None
    for frame in frames:
        for h, i, data in zip(frame["h"].tolist(), frame["id"].tolist(), frame["data"]):
            if h != last and size > BATCH_BYTES:
                yield batch(held)
                held, size = [], 0
            last = h
            held.append((i, bytes(data)))
            size += len(data)
    if held:
        yield batch(held)


def _extended(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks under an anchor that is longer by half of what a window leaves around it.

    A window has half of that at least on one side of the anchor, so it goes with the anchor
    extended to that side, and no window is lost or doubled.
    """
    for frame in frames:
        rows = []
        for row in frame.itertuples(index=False):
            data, a, g = bytes(row.data), row.a, row.g
            slack = LENGTH - g
            half = (slack + 1) // 2
            # Window starts w run from a - slack to a; at least half lies left of the anchor if w <= a - half.
            for left in (True, False):
                lo, hi = (0, min(a - half, len(data) - LENGTH)) if left else (max(0, a - half + 1), len(data) - LENGTH)
                if lo > hi:
                    continue
                start, grown = (a - half, g + half) if left else (a, g + slack - half + 1)
                grown = min(grown, LENGTH)
                part = data[lo : hi + LENGTH]
                h = _signed(xxhash.xxh3_64_intdigest(data[start : start + grown] + bytes([left]), seed=row.h & (_SIGN - 1)))
                c = _signed(xxhash.xxh3_64_intdigest(part))
                rows.append((row.id, row.off + lo, h, c, part, start - lo, grown))
        if rows:
            yield pd.DataFrame(rows, columns=["id", "off", "h", "c", "data", "a", "g"])


_PARTS = "id long, off int, h long, c long, data binary, a int, g int"


def _spans_between(parts: DataFrame) -> DataFrame:
    """Spans (id, off, n) of chunks ``parts`` that repeat; equal anchors h, different contents c.

    Anchors are extended once for all chunks, which tells most of them apart, and again for those
    that too many different chunks share. Rounds are bounded by the logarithm of ``LENGTH``.
    """
    spark = parts.sparkSession
    found = None
    used: list[str] = []
    while True:
        folders = [work_folder(spark, name) for name in ("extended", "extended-kinds", "parts")]
        grown = written_at(parts.mapInPandas(_extended, _PARTS), folders[0])
        remove(spark, *used)
        used = folders
        each = grown.groupBy("h", "c").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "off")).alias("one"))
        each = written_at(each, folders[1])
        equal = grown.join(each.filter("copies > 1").select("h", "c"), ["h", "c"], "left_semi")
        equal = equal.select("id", "off", F.octet_length("data").alias("n"))
        several = each.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
        # One part for each content; copies of the same part are found by (h, c).
        ones = each.join(several, "h").select("h", "c", "kinds", F.col("one.id").alias("id"), F.col("one.off").alias("off"))
        kept = grown.join(ones, ["h", "c", "id", "off"]).withColumn("part", F.monotonically_increasing_id())
        kept = written_at(kept, folders[2])
        calm = kept.filter(F.col("kinds") <= GROUP)
        spans = (
            calm.select("h", F.col("part").alias("id"), "data")
            .repartition("h")
            .sortWithinPartitions("h")
            .mapInPandas(_transformed, "id long, off int, n int")
            .select(F.col("id").alias("part"), F.col("off").alias("inside"), "n")
            .join(calm.select("part", "h", "c"), "part")
        )
        spans = grown.select("h", "c", "id", "off").join(spans, ["h", "c"])
        made = written(equal.union(spans.select("id", (F.col("off") + F.col("inside")).alias("off"), "n")), "spans")
        found = made if found is None else found.union(made)
        crowded = kept.filter(F.col("kinds") > GROUP)
        if crowded.isEmpty():
            remove(spark, *used)
            return found
        # The parts that share a crowded anchor, copies too: each keeps its own place.
        parts = grown.join(crowded.select("h").distinct(), "h", "left_semi")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, s, n: byte spans of each text that are repeats; they may overlap."""
    rows = _keyed(docs, id_col, text_col)
    spark = docs.sparkSession
    folders = [work_folder(spark, name) for name in ("chunks", "parts")]
    dealt = written_at(rows.mapInPandas(_chunked, CHUNKS), folders[0])
    local = written(dealt.filter("h is null").select("doc_id", "text_key", "s", "n"), "local")
    chunk = dealt.filter("h is not null")
    anchor = (
        chunk.groupBy("h")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("c").alias("low"), F.max("c").alias("high"))
        .filter("rows > 1")
        .select("h", (F.col("low") != F.col("high")).alias("several"))
    )
    shared = written(chunk.join(anchor, "h"), "shared")
    remove(spark, folders[0])
    whole = shared.filter("not several").select("doc_id", "text_key", "s", "n")
    mixed = shared.filter("several")
    kinds = written(
        mixed.groupBy("h", "c")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_key", "s", "n", "a")).alias("one"))
        .withColumn("id", F.monotonically_increasing_id()),
        "kinds",
    )
    wanted = kinds.select("id", "h", "c", "one.*").withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_key"})
    data = F.substring(F.col("text").cast("binary"), F.col("s") + 1, F.col("n"))
    parts = written_at(
        rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["of_doc"]) & (rows["text_key"] == wanted["of_key"]))
        .select("id", F.lit(0).alias("off"), "h", "c", data.alias("data"), "a", F.lit(GRAM).alias("g"))
        .dropDuplicates(["id"]),
        folders[1],
    )
    apart = _spans_between(parts)
    remove(spark, folders[1])
    inside = apart.join(kinds.select("id", "h", "c"), "id").select("h", "c", "off", F.col("n").alias("m"))
    equal = kinds.filter("copies > 1").select("h", "c", F.lit(0).alias("off"), F.col("one.n").alias("m"))
    inside = inside.union(equal)
    between = mixed.join(inside, ["h", "c"]).select("doc_id", "text_key", (F.col("s") + F.col("off")).alias("s"), F.col("m").alias("n"))
    return local.union(whole).union(between)


_CUT = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept", T.BinaryType())]
)


@F.pandas_udf(_CUT)
def _cut(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    rows = []
    for text, at, n in zip(texts, starts, sizes):
        data = text.encode("utf-8", "surrogatepass")
        spans = merged([*zip(at.tolist(), (at + n).tolist())]) if at is not None else []
        ends = [0, *(e for _, e in spans)]
        kept = b"".join([data[e:s] for e, s in zip(ends, [*(s for s, _ in spans), len(data)])])
        rows.append((len(data), len(data) - len(kept), len(spans), kept))
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])


def _with_cut(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a column __cut: n_bytes, n_removed, n_spans, kept."""
    spans = repeated_spans(docs, id_col, text_col)
    # A set, so that repeated rows do not add up; it is bounded by the bytes of one text.
    spans = spans.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("s", "n")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("__of_doc"), F.col("text_key").alias("__of_key"), F.col("spans").alias("__spans"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    marked = docs.withColumn("__text", text).withColumn("__key", F.xxhash64("__text"))
    same = docs[id_col].cast("long").eqNullSafe(spans["__of_doc"]) & (marked["__key"] == spans["__of_key"])
    both = marked.join(spans, same, "left")
    return both.withColumn("__cut", _cut("__text", "__spans.s", "__spans.n"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay).

    A byte goes if a string of 200 bytes that covers it starts anywhere else as well, in the same
    text or another, repeats that overlap included; strings are judged on the input. n_spans
    counts maximal removed runs. Texts are UTF-8; null counts as empty, shorter texts stay whole.
    Rows that repeat a doc_id and a text are repeats of each other. Null ids are rows like others.
    An empty table gives no rows.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return _with_cut(rows, "doc_id", "text").select(F.col("doc_id").cast("long"), "__cut.*")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns and what stays of the text; a character that is cut in two becomes U+FFFD."""
    kept = F.make_valid_utf8(F.col("__cut.kept").cast("string"))
    return _with_cut(docs, id_col, text_col).withColumn(text_col, kept).select(*docs.columns)
