"""Licence scan: sentences to licence-sentence ids, id sequences against ordered licence rules.

Only DataFrame functions. A rule is a licence's notice as a sequence of sentences; a document has
the licence when the rule's sentences all occur in its text, in this order. Sentences are compared
without case, marks and line breaks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlog.llm.common import LOWER, UPPER, documents

Rule = tuple[str, tuple[str, ...]]

#: Licence and its sentences. A licence with several notices has several rules.
RULES: tuple[Rule, ...] = (
    ("Apache-2.0", ("Licensed under the Apache License, Version 2.0",)),
    ("Apache-2.0", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
        "You may obtain a copy of the License at",
        "http://www.apache.org/licenses/LICENSE-2.0",
    )),
    ("CC-BY-NC-4.0", ("Licensed under CC BY-NC 4.0",)),
    ("GPL-3.0", ("This work is licensed under the GNU General Public License, version 3",)),
    ("GPL-3.0", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program",
    )),
    ("MIT", ("Released under the MIT License",)),
    ("MIT", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    )),
)

# Typographic marks count as marks, other characters beyond ASCII as letters. The patterns mean
# the same in Java, in Python and in RE2.
_TYPOGRAPHIC = "“”„‘’«»–—…•·©®  "
_END = "[.!?]+[\"')\\]]*[ \\t\\r\\n\\f]+"
_BLANK = "\\n[ \\t\\r\\f]*\\n"
_MARKS = "[\\x01-\\x09\\x0b-\\x2f\\x3a-\\x60\\x7b-\\x7f\\x00]+"


def normalised(sentence: str) -> str:
    """A rule's sentence as ``_segments`` leaves it: words in lower case, one space between them."""
    plain = sentence.translate(str.maketrans(UPPER + _TYPOGRAPHIC, LOWER + " " * len(_TYPOGRAPHIC)))
    return re.sub(_MARKS, " ", plain).strip()


def sentence_ids(rules: tuple[Rule, ...]) -> dict[str, int]:
    """The number of each different normalised sentence; rules share the sentences they share."""
    return {s: i for i, s in enumerate(dict.fromkeys(normalised(s) for _, rule in rules for s in rule))}


def _segments(text: Column) -> Column:
    """The normalised, non-empty lines of each piece of text between sentence ends and blank lines."""
    plain = F.translate(text, UPPER + _TYPOGRAPHIC, LOWER + " " * len(_TYPOGRAPHIC))
    cut = F.split(F.regexp_replace(F.regexp_replace(plain, _END, "\n\n"), _BLANK, "\n\n"), "\n\n+")
    lines = F.transform(cut, lambda s: F.transform(F.split(s, "\n"), lambda line: F.trim(F.regexp_replace(line, _MARKS, " "))))
    return F.transform(lines, lambda ls: F.filter(ls, lambda line: line != ""))


def _candidates(lines: Column, at: Column, most: int) -> Column:
    """What may be a sentence: each line, and what is left of a wrapped piece from each line on.

    Every line holds a word, so a rest of more lines than the longest rule sentence has words
    (``most``) is none.
    """
    n = F.size(lines)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    line = F.transform(places, lambda i: F.struct(at.alias("piece"), i.alias("line"), F.lit(1).alias("whole"), F.element_at(lines, i).alias("sentence")))
    wrapped = F.filter(places, lambda i: (i < n) & (n - i < most))
    rest = F.transform(wrapped, lambda i: F.struct(at.alias("piece"), i.alias("line"), F.lit(2).alias("whole"), F.array_join(F.slice(lines, i, n - i + 1), " ").alias("sentence")))
    return F.concat(line, rest)


def _has(ids: Column, rule: list[int]) -> Column:
    """Whether ``ids`` has the rule's ids in order: each id is waited for in turn."""
    wanted = F.array(*[F.lit(i) for i in rule])
    met = F.aggregate(ids, F.lit(0), lambda k, i: F.when((k < len(rule)) & (F.get(wanted, k) == i), k + 1).otherwise(k))
    return met == len(rule)


def licenses_of(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, licenses, n_sentences.

    ``licenses`` lists the different licences of the text in order of their names, with commas,
    and is empty where there is none; ``n_sentences`` counts the licence sentences found. Null and
    repeated ids pass through, a null text counts as empty, an empty table gives no rows.

    The sentence table is made of literals, so Spark knows its size and broadcasts it. Only
    sentences that are in it leave the task; they are brought together by the text's digest, so
    copies of a text are matched once.
    """
    known = sentence_ids(rules)
    spark = docs.sparkSession
    table = ", ".join(f"('{s}', {i})" for s, i in known.items())  # normalised: no quotes
    sentences = spark.sql(f"select * from values {table} as t(sentence, sentence_id)")
    most = max(len(s.split()) for s in known)
    rows = documents(docs, id_col, text_col)
    key = F.sha2("text", 256).alias("text_key")
    pieces = rows.select(key, F.posexplode(_segments(F.col("text"))).alias("piece", "lines"))
    found = pieces.select("text_key", F.explode(_candidates(F.col("lines"), F.col("piece"), most)).alias("c")).select("text_key", "c.*")
    hits = found.join(sentences, "sentence").select("text_key", "piece", "line", "whole", "sentence_id").distinct()
    in_order = F.array_sort(F.collect_list(F.struct("piece", "line", "whole", "sentence_id")))
    ids = hits.groupBy("text_key").agg(F.transform(in_order, lambda h: h["sentence_id"]).alias("ids"))
    names = [F.when(_has(F.col("ids"), [known[normalised(s)] for s in rule]), F.lit(name)) for name, rule in rules]
    listed = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))), ",")
    matched = ids.select("text_key", listed.alias("licenses"), F.size("ids").cast("long").alias("n_sentences"))
    return rows.select("doc_id", key).join(matched, "text_key", "left").select(
        "doc_id",
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_sentences", F.lit(0).cast("long")).alias("n_sentences"),
    )


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB text of ``licenses_of`` over documents; ids in order are found by LIKE."""
    known = sentence_ids(rules)
    most = max(len(s.split()) for s in known)
    sentences = ", ".join(f"('{s}', {i})" for s, i in known.items())
    patterns = ", ".join(f"('{name}', '%{'%'.join(f',{known[normalised(s)]},' for s in rule)}%')" for name, rule in rules)

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    plain = f"translate(text, {quoted(UPPER + _TYPOGRAPHIC)}, {quoted(LOWER + ' ' * len(_TYPOGRAPHIC))})"
    return f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
known(sentence, sentence_id) as (values {sentences}),
rules(name, pattern) as (values {patterns}),
cut as (
    select r, unnest(ps) as piece_text, generate_subscripts(ps, 1) as piece
    from (select r, regexp_split_to_array(regexp_replace(regexp_replace({plain}, {quoted(_END)}, chr(10) || chr(10), 'g'),
                                                         {quoted(_BLANK)}, chr(10) || chr(10), 'g'), '\\n\\n+') as ps from docs)),
lines as (
    select r, piece, list_filter(list_transform(string_split(piece_text, chr(10)),
               lambda x: trim(regexp_replace(x, {quoted(_MARKS)}, ' ', 'g'))), lambda x: x <> '') as ls
    from cut),
places as (select r, piece, ls, unnest(range(1, len(ls) + 1)) as line from lines),
candidates as (
    select r, piece, line, 1 as whole, ls[line] as sentence from places
    union all
    select r, piece, line, 2, array_to_string(ls[line:], ' ') from places where line < len(ls) and len(ls) - line < {most}),
ids as (
    select r, count(*) as n, string_agg(',' || sentence_id || ',', '' order by piece, line, whole) as ids
    from candidates join known using (sentence) group by r),
named as (
    select r, string_agg(name, ',' order by name) as licenses
    from (select distinct r, name from ids join rules on ids like pattern) group by r)
select doc_id, coalesce(licenses, '') as licenses, coalesce(n, 0)::bigint as n_sentences
from docs left join ids using (r) left join named using (r)
"""
