"""Small inputs for the operators, with nulls, repeats, ties, long texts and clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Extra columns named like what operators make on their way.
CLASHING = ["keep_id", "kept", "hash", "text_key", "label", "part", "row_id", "score", "h", "c", "n", "class_id", "spans"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def texts(seed: int = 1, n: int = 30) -> list[tuple]:
    """(doc_id, text): plain texts, copies, near copies, shared passages, empty, null and long ones."""
    rng = random.Random(seed)
    plain = [words(rng, rng.randrange(1, 120)) for _ in range(n)]
    passage = words(rng, 70)
    rows = [(i, t) for i, t in enumerate(plain)]
    rows += [(100 + i, plain[i].upper()) for i in range(5)]
    for i in range(8):
        own = plain[i + 6].split()
        own[len(own) // 2] = "changed"
        rows.append((200 + i, " ".join(own)))
    rows += [(300 + i, f"{words(rng, 40)} {passage} {words(rng, 30)}") for i in range(5)]
    rows += [(400, None), (401, ""), (402, "   \n\t"), (403, "one"), (404, "one two"), (405, "ß Ω 漢字 🙂 naïve é")]
    rows += [(406, "ab " * 4000), (407, "x" * 9000), (408, words(rng, 3000))]
    rows += [(None, plain[0]), (None, None), (3, plain[3]), (3, plain[3]), (4, "another text of the same id")]
    return rows


def frame(spark, rows: list[tuple], clash: bool = False):
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(-7).alias(c) for c in CLASHING])
    return df


def plain_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
