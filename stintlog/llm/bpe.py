"""Byte-level BPE: encoding by a queue of merge ranks over a linked symbol list, and decoding.

The vocabulary file is read on the driver, from a path that is a parameter, and broadcast (its
size is fixed). Texts are encoded where they lie: no shuffle.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession

from stintlog.llm.common import documents, per_worker

# Unicode's white space, which is narrower than what Python's \s takes.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Units remembered by a Python worker at once; the memory is emptied when it is full.
REMEMBERED = 700_000

# Bits of an id in a pair's number, and of a symbol's place in a queue entry.
_BITS = 20
_PLACE = 40
_PLACES = (1 << _PLACE) - 1

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Fixed by the format: printable bytes of Latin-1 stand for themselves, the others take the
    characters from 256 on, in order.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairCodec:
    """A byte-level BPE vocabulary, given as the text of its JSON file."""

    def __init__(self, vocabulary: str, pattern: str):
        model = json.loads(vocabulary)
        ids: dict[str, int] = model["model"]["vocab"]
        symbols = byte_symbols()
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.strings = {i: bytes(symbols[c] for c in s) for s, i in ids.items()}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.of_byte = [0] * 256
        for char, byte in symbols.items():
            self.of_byte[byte] = ids[char]
        # Merges by rank, and the rank of each pair of ids, which are one number as a key.
        self.rank: dict[int, int] = {}
        self.merged: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merged.append((ids[left], ids[right], ids[left + right]))
            self.rank.setdefault(ids[left] << _BITS | ids[right], rank)
        self._decimal = {i: b"%d" % i for i in self.strings}
        self._split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._units = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
        self._pieces = regex.compile(pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]"))
        self._seen: dict[str, tuple[bytes, int, bytes]] = {}

    def merge(self, data: bytes) -> list[int]:
        """The ids of one piece: the merge of lowest rank first, the leftmost of equal ranks."""
        ids = [self.of_byte[b] for b in data]
        n, rank, merged = len(ids), self.rank, self.merged
        if n == 1:
            return ids
        # Rank and place of a pair are one number, in the order in which pairs are merged.
        queue = []
        for i in range(n - 1):
            if (r := rank.get(ids[i] << _BITS | ids[i + 1])) is not None:
                queue.append(r << _PLACE | i)
        if not queue:
            return ids
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            first = heapq.heappop(queue)
            i = first & _PLACES
            left, right, made = merged[first >> _PLACE]
            if ids[i] != left or (j := after[i]) >= n or ids[j] != right:
                continue  # stale: one of its symbols has been merged since
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(made << _BITS | ids[k])) is not None:
                    heapq.heappush(queue, r << _PLACE | i)
            if (h := before[i]) >= 0 and (r := rank.get(ids[h] << _BITS | made)) is not None:
                heapq.heappush(queue, r << _PLACE | h)
        return [i for i in ids if i >= 0]

    def _parts(self, text: str) -> Iterator[str]:
        """Special tokens and the text between them, in order."""
        if self._split_special is None or not any(s in text for s in self.special):
            yield text
        else:
            yield from self._split_special.split(text)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self._parts(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                for piece in self._pieces.findall(part):
                    out += self.merge(piece.encode())
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.strings[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """The strings of the vocabulary one after the other; what is no UTF-8 becomes U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def _unit(self, unit: str) -> tuple[bytes, int, bytes]:
        """Of a word with its leading space, or a run of spaces: ids as decimal text, their number, decoded bytes."""
        pieces = self._pieces.findall(unit)
        if len(pieces) == 1:
            ids = self.merge(unit.encode())
            out = (b",".join([self._decimal[i] for i in ids]), len(ids), self.decode_bytes(ids))
        else:
            found = [self._seen.get(p) or self._unit(p) for p in pieces]
            out = (b",".join([f[0] for f in found]), sum([f[1] for f in found]), b"".join([f[2] for f in found]))
        if len(self._seen) >= REMEMBERED:
            self._seen.clear()
        self._seen[unit] = out
        return out

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text.

        The pattern never lets a piece cross a space that precedes a word, so a text is encoded
        unit by unit and each unit only once as long as it is remembered.
        """
        found: list[tuple[bytes, int, bytes]] = []
        seen = self._seen
        for part in self._parts(text):
            if part in self.special:
                found.append((b"%d" % self.special[part], 1, part.encode()))
            else:
                found += [seen.get(u) or self._unit(u) for u in self._units.findall(part)]
        decoded = b"".join([f[2] for f in found]).decode("utf-8", "replace")
        return (
            sum([f[1] for f in found]),
            hashlib.sha256(b",".join([f[0] for f in found])).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


def _codec(spark: SparkSession, vocabulary_path: str, pattern: str):
    """A function that gives the codec in a worker; the vocabulary travels as a broadcast."""
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    sent = spark.sparkContext.broadcast(vocabulary)
    key = ("codec", hashlib.md5((vocabulary + pattern).encode()).hexdigest())
    return lambda: per_worker(key, lambda: BytePairCodec(sent.value, pattern))


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every whole text. Null text counts as empty and has no ids.

    The string of a special token becomes its id, as the tokenizers library does by default.
    Null and repeated ids pass through; an empty table gives no rows.
    """
    codec = _codec(docs.sparkSession, vocabulary_path, pattern)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = codec()
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [made.encode(t) for t in frame["text"]]})

    return documents(docs, id_col, text_col).mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """doc_id and text of every row with ids; null ids give an empty text, unknown ids fail."""
    codec = _codec(encoded.sparkSession, vocabulary_path, pattern)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = codec()
        for frame in frames:
            texts = ["" if ids is None else made.decode(list(ids)) for ids in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "text": texts})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ids and of the text decoded from them, one row per row of ``docs``.

    Encoding and decoding happen in the same pass, so ids are never moved. Null text counts as
    empty: no ids, digests of the empty string.
    """
    codec = _codec(docs.sparkSession, vocabulary_path, pattern)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = codec()
        for frame in frames:
            found = [made.digests(t) for t in frame["text"]]
            columns = pd.DataFrame(found, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield columns.assign(doc_id=frame["doc_id"])[["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]]

    return documents(docs, id_col, text_col).mapInPandas(run, DIGESTS)
