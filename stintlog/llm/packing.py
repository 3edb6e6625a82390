"""Packing: Karmarkar-Karp multiway differencing of document pieces into windows of equal length.

A document longer than a window gives full windows and a rest. Rests are dealt into groups of
bounded size; in each, differencing merges partial partitions whose imbalances oppose each other,
and the number of windows rises whenever one of them exceeds the capacity.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlog.llm.common import documents, per_worker, written

# Pieces of a group, on average. A group is packed by one call; more pieces waste less, since
# what is lost is about one window a group.
PIECES_PER_GROUP = 1_024

# Bytes of words and of their ids, with what Python adds to each, that a Python worker remembers; a
# full memory is emptied. An executor has a worker for each core beside its heap; with what is looked
# up, this takes a worker some 230 MB. Longer words are not remembered.
REMEMBERED, EACH, LONGEST = 192 << 20, 150, 256
# Characters of the texts whose new words are looked up together.
TOGETHER = 1 << 18

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordEncoder:
    """Ids of whole texts by the tokenizers library, which sees every different word once.

    For vocabularies that drop white space, never merge across it and mark the end of a word, so
    that the ids of a text are those of its words in order. A new word is cut by the vocabulary's
    own pattern into pieces, and only new pieces are given to the library.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(vocabulary)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        model = json.loads(vocabulary)
        suffix = model["model"]["end_of_word_suffix"]
        self._ends = np.zeros(self._tokenizer.get_vocab_size(), dtype=bool)
        self._ends[[i for token, i in model["model"]["vocab"].items() if token.endswith(suffix)]] = True
        steps = model["pre_tokenizer"]["pretokenizers"]
        self._pieces = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # Unicode's white space, which is narrower than what str.split() takes.
        self._words = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
        # Letters whose lower case and composed form are the same in every version of Unicode.
        self._plain = re.compile(r"[\x21-\x7e\xa1-\u012f\u0131-\u017e]+")
        # Whether a word of letters only is one piece, so that it need not be cut.
        self._letters = all(self._pieces.findall(w) == [w] for w in ("a", "zoo", "éß", "abcdefghijklmnopqrstuvwxyz" * 4))
        self._of_word: dict[str, bytes] = {}
        self._held = 0

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _cut(self, word: str) -> list[str] | None:
        """The pieces of a word; None where only the library knows them."""
        if word.isalpha() and self._letters:
            return [word.lower()] if word.isascii() or self._plain.fullmatch(word) else None
        return self._pieces.findall(word.lower()) if self._plain.fullmatch(word) else None

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of new words. A piece is a word too: it has the same ids on its own."""
        known = self._of_word
        # Most new words are one piece as they stand.
        new = {w for w in words if w.islower() and w.isascii() and w.isalpha()} if self._letters else set()
        cut = {w: self._cut(w) for w in words.difference(new)}
        new.update(p for pieces in cut.values() if pieces for p in pieces if p not in known)
        if new:
            listed = list(new)
            # The library's call without places in the text, which takes a list.
            ids = self._tokenizer.encode_batch_fast([" ".join(listed)], add_special_tokens=False)[0].ids
            ids = np.array(ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
            data = ids.tobytes()
            assert len(ends) == len(listed), "one end of word for each piece"
            known.update((p, data[a:b]) for p, a, b in zip(listed, [0, *ends], ends))
            self._held += sum(map(len, listed)) + len(data) + EACH * len(listed)
        for w, pieces in cut.items():
            if w not in known:
                known[w] = self._whole(w) if pieces is None else known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])
                self._held += len(w) + len(known[w]) + EACH

    def _words_of(self, text: str) -> list[str] | None:
        """The words of a text; None for one that the library takes as a whole."""
        if any(s in text for s in self._special):
            return None
        # str.split takes four control characters for white space that the vocabulary does not.
        odd = "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
        return self._words.findall(text) if odd else text.split()

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        seen = self._of_word
        if self._held > REMEMBERED:
            seen.clear()
            self._held = 0
        words = [self._words_of(t) for t in texts]
        new: set[str] = set()
        for ws in words:
            if ws:
                new |= set(ws).difference(seen)
        if new:
            self._learn(new)
        for text, ws in zip(texts, words):
            yield self._whole(text) if ws is None else b"".join(map(seen.__getitem__, ws))
        for w in [w for w in seen.keys() & new if len(w) > LONGEST] if any(len(w) > LONGEST for w in new) else ():
            self._held -= len(w) + len(seen.pop(w)) + EACH

    def ids(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; few texts are held at a time."""
        part: list[str] = []
        size = 0
        for text in texts:
            part.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._together(part)
                part, size = [], 0
        yield from self._together(part)


def _encoder(spark: SparkSession, vocabulary_path: str):
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    sent = spark.sparkContext.broadcast(vocabulary)
    key = ("words", hashlib.md5(vocabulary.encode()).hexdigest())
    return lambda: per_worker(key, lambda: WordEncoder(sent.value))


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32, doc_tokens.

    A document is its ids followed by ``end_id``, cut at multiples of ``capacity``; a null or
    empty text has the one id ``end_id``. ids_crc32 is that of the ids as little-endian unsigned
    32-bit integers.
    """
    encoder = _encoder(docs.sparkSession, vocabulary_path)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder()
        for batch in batches:
            rows = []
            # One text after the other becomes a string; a whole batch of them need not fit beside the memory.
            texts = (text.as_py() for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), made.ids(texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
            if rows:
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names)

    return documents(docs, id_col, text_col).mapInArrow(run, PIECES)


def difference(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, int]:
    """Karmarkar-Karp: the window of each size, and the largest sum of a window.

    Every size starts as a partial partition of its own. The two partitions with the largest
    imbalance are merged, the fullest window of one with the emptiest of the other, until one is
    left. Only differences to the emptiest window are kept, largest first.
    """
    n = len(sizes)
    if windows == 1:
        return np.zeros(n, dtype=np.int64), int(sizes.sum())
    sums = np.zeros((1, windows), dtype=np.int64)
    state: dict[int, np.ndarray] = {}
    queue = []
    for i, size in enumerate(sizes.tolist()):
        sums = np.zeros(windows, dtype=np.int64)
        sums[0] = size
        state[i] = sums
        queue.append((-size, i))
    heapq.heapify(queue)
    merges: list[tuple[int, int, np.ndarray]] = []  # children, and where the slots went
    while len(queue) > 1:
        _, a = heapq.heappop(queue)
        _, b = heapq.heappop(queue)
        both = state.pop(a) + state.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        both -= both[-1]
        state[made := n + len(merges)] = both
        merges.append((a, b, order))
        heapq.heappush(queue, (-int(both[0]), made))
    # From the last merge back: the window that each slot of a partition ends in.
    place = {queue[0][1]: np.arange(windows)}
    out = np.zeros(n, dtype=np.int64)
    for made in range(n + len(merges) - 1, n - 1, -1):
        a, b, order = merges[made - n]
        of_slot = np.empty(windows, dtype=np.int64)
        of_slot[order] = place.pop(made)
        for child, slots in ((a, of_slot), (b, of_slot[::-1])):
            if child < n:
                out[child] = slots[0]
            else:
                place[child] = slots
    return out, int(np.bincount(out, weights=sizes, minlength=windows).max())


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A window for each size, none fuller than ``capacity``; no size may exceed it.

    Starts with as few windows as the sum allows; each failure adds one. As many windows as
    sizes always do.
    """
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        placed, fullest = difference(sizes, windows)
        if fullest <= capacity:
            return placed
        windows += 1


def pack_documents(
    docs: DataFrame, vocabulary_path: str, capacity: int = 4096, end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text", pieces_per_group: int = PIECES_PER_GROUP,
) -> DataFrame:
    """Every document's pieces with their sequence and offset in it; no sequence exceeds ``capacity``.

    Offsets of a sequence are gapless from 0, each id lies in one piece. Pieces are written once,
    so that groups stay the same when tasks are repeated; only numbers are shuffled. A group is
    dealt by row number, never by id or text, so equal rows spread. Null ids and repeated rows are
    packed like others; an empty table gives no rows. ``sequence_id`` is unique, not gapless.
    """
    pieces = written(
        token_pieces(docs, vocabulary_path, capacity, end_id, id_col, text_col)
        .withColumn("row_id", F.monotonically_increasing_id()),
        "pieces",
    )
    rests = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // pieces_per_group))

    def packed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_id", ignore_index=True)
        placed = pack(group["length"].to_numpy(dtype=np.int64), capacity)
        order = np.argsort(placed, kind="stable")
        group, placed = group.iloc[order], placed[order]
        length = group["length"].to_numpy(dtype=np.int64)
        before = np.cumsum(length) - length
        first = np.r_[True, placed[1:] != placed[:-1]]
        offset = before - np.maximum.accumulate(np.where(first, before, 0))
        return group.drop(columns=["row_id", "part"]).assign(sequence_id=(int(key[0]) << 24) + placed, offset=offset)

    part = F.pmod(F.xxhash64("row_id"), F.lit(groups)).cast("int")
    full = pieces.filter(F.col("length") == capacity).select(
        *[c for c in pieces.columns if c != "row_id"],
        # Above every group's numbers.
        (F.col("row_id") + F.lit(1 << 61)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return rests.withColumn("part", part).groupBy("part").applyInPandas(packed, PACKED).unionByName(full)
