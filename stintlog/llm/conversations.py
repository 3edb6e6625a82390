"""Conversation structure repair: faults of a conversation's rows and the cheapest edits.

Faults are column expressions; the edits come from ``survivors`` while the rows of a partition pass
by in the order of their conversations, so no conversation is ever held as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlog.llm.survivors import Survivors

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
CONVERSATIONS = 2_000  # results of a batch that a task returns

REPAIRED = {
    "gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long",
    "cost": "long", "audit": "string", "repaired_sha256": "string",
}


def turns(rows: DataFrame) -> DataFrame:
    """The columns that count, so that no other can clash: conv_id, turn, role, text; null text and role are a space."""
    return rows.select(
        rows["conv_id"].alias("conv_id"),
        rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows["text"].cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``turns`` with faults made by a hash of conv_id and turn; a dropped row has 0 copies."""
    def name(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", name("conv_id"), name("turn")).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2) * F.col("copies")).otherwise(F.col("copies")).alias("copies"),
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds blank, unfinished, and seen: the same role and text at an earlier turn of the conversation.

    Which turn has a text first is found from digests that combine before the shuffle; only texts of
    several turns are looked up, so one text or conversation with many rows fills no task.
    """
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.withColumn("blank", F.length(shown) == 0)
    rows = rows.withColumn("unfinished", ~F.col("blank") & ~F.substring(shown, -1, 1).isin(*ENDS))
    rows = rows.withColumn("digest", F.when(~F.col("blank") & (F.col("copies") > 0), F.sha2("text", 256)))
    at = F.struct(F.col("turn"))  # in a struct a null is least and counts
    several = (
        rows.where(F.col("digest").isNotNull())
        .groupBy("conv_id", "role", "digest")
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    seen = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return rows.join(several, same, "left").select(
        "conv_id", "turn", "role", "text", "copies", "blank", "unfinished", seen.alias("seen")
    )


class _Conversation:
    """What is known of the conversation that is passing by."""

    def __init__(self, key: object):
        self.key = key
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.last: tuple | None = None  # the last row's turn, role and text
        self.audit: list[str] = []
        self.sha = hashlib.sha256()
        self.lines = 0
        self.path = Survivors(self._edited)

    def _edited(self, letter: str, row: tuple | None, role: str | None) -> None:
        self.audit.append(letter)
        if letter == "D":
            return
        line = f"{role or row[0]}:{row[1] if row else ''}"
        self.sha.update(("\n" + line if self.lines else line).encode())
        self.lines += 1

    def add(self, turn: int | None, role: str, text: str, copies: int, blank: bool, unfinished: bool, seen: bool) -> None:
        for _ in range(copies):
            if turn is not None and turn != self.last_turn:
                self.turns += 1
                self.last_turn = turn
                if self.first_turn is None:
                    self.first_turn = turn
            if self.last is not None and self.last[1][:1] + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            # Equal rows of one turn are neighbours.
            again = not blank and (seen or self.last == (turn, role, text))
            self.last = (turn, role, text)
            self.blank += blank
            self.duplicate += again
            self.truncated += unfinished and not again
            gone = blank or again
            self.path.add(None if gone else (role, text), role, gone, unfinished)

    def result(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        cost = self.path.finish()
        audit = "".join(self.audit)
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, self.sha.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, and the cheapest edits to `(s?(ua)+)?` by roles' initials.

    ``rows`` as ``turns`` or ``damaged`` return them. Rows of a conversation follow by turn, nulls
    first; rows of one turn by role and text. A row is blank (no visible character), else a
    duplicate (its role and text were there before), else truncated (its last visible character
    ends no sentence). Keeping a row costs 0, another role 2, deleting 3 (a must for blank and
    duplicate rows), an inserted empty turn 2, a truncated row that stays 1 more; of edits that cost
    the same the ASCII-least initials win.

    Columns: conv_id, gaps (missing turns), blank, duplicate, truncated, illegal (neighbours whose
    initials are not su, ua or au), cost, audit (the edits' initials), repaired_sha256 (of the
    repaired rows as role:text lines). A conversation whose rows are all dropped (0 copies) has
    zeros and empty text; a null conv_id is a conversation like others; an empty table gives no rows.

    All rows of a conversation pass through one task, since the hash of the repaired text is one
    chain, but are never held together: a task keeps the undecided edits and their rows.
    """
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in REPAIRED.items()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: _Conversation | None = None
        types = None

        def batch_of(results: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*results), types)], names)

        for batch in batches:
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "blank", "unfinished", "seen")]
            for key, *row in zip(*columns):
                if now is None or key != now.key:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(key)
                now.add(*row)
            if len(done) >= CONVERSATIONS:
                yield batch_of(done)
                done = []
        if now is not None:
            yield batch_of([*done, now.result()])

    ordered = with_faults(rows).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return ordered.mapInArrow(run, schema)
