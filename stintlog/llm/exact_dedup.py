"""Exact dedup: groups by 128-bit content hash, with the texts themselves compared.

Only DataFrame functions. Texts are equal when they are identical after lower-casing A to Z; a
null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlog.llm.common import ascii_lower, documents


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents(docs, id_col, text_col).select("doc_id", ascii_lower(F.col("text")).alias("text"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` names the id that stays in a group of equal texts: "smallest" or "largest".

    Rows are counted per (content hash, id) before they are shuffled, so a group of copies of any
    size crosses the network as one row per task and id. Groups come from a grouping on hash and
    text: equal hashes with unequal bytes end up in different groups. The groups are looked up by
    both digests, so a collision of the 128-bit hash alone joins no unequal texts.

    A null id stays only where a group has no other id (keep_id is then null). Rows that repeat
    both id and text all return, each counts in group_size, and one of them is kept. An empty
    table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    rows = _hashed(docs, id_col, text_col)
    best = F.min if keep == "smallest" else F.max
    groups = (
        rows.groupBy(F.unhex(F.md5("text")).alias("hash"), "text")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    copies = (
        rows.select("doc_id", F.unhex(F.md5("text")).alias("hash"), F.sha2("text", 256).alias("text_sha256"))
        .groupBy("doc_id", "hash", "text_sha256")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        copies.join(groups, ["hash", "text_sha256"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, one for each different text, with all their columns.

    A row is chosen by its id as in ``exact_groups``; of rows that repeat an id and a text, any
    one stays.
    """
    kept = exact_groups(docs, id_col, text_col, keep).filter("kept").select("doc_id", "text_sha256")
    kept = kept.toDF("__kept_id", "__kept_sha256")
    sha256 = F.sha2(ascii_lower(F.coalesce(docs[text_col].cast("string"), F.lit(""))), 256)
    marked = docs.withColumn("__sha256", sha256)
    same = docs[id_col].cast("long").eqNullSafe(kept["__kept_id"]) & (marked["__sha256"] == kept["__kept_sha256"])
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, "__sha256"]).select(*docs.columns)
