"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlog.llm import (
    bpe, conversations, exact_dedup, html_text, licenses, minhash, neighbours, packing, quality, sharding, suffix_dedup,
    toxicity, whitening,
)
from stintlog.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses_of(_table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), most=20, every=20)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), keep="largest")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary, capacity=4096, end_id=2)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"), html_text.trained())


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffle_to_shards(_table(spark, sf_dir, "documents"), shards=24)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    # Null where 64 bits cannot hold it; deviation_exact has up to 38 digits.
    return rows.withColumnRenamed("deviation", "deviation_exact").withColumn("deviation", F.expr("try_cast(deviation_exact as bigint)"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(conversations.turns(_table(spark, sf_dir, "conversations"))))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP4_SQL = """
with rows as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id is not distinct from max(doc_id) over same
           and row_number() over (partition by t, doc_id) = 1 as kept,
       sha256(t) as text_sha256
from rows window same as (partition by t)
"""

# Four columns walk the rows: the cheapest edits to each state a repaired conversation may be in.
OP12_SQL = """
with recursive texts as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
    from conversations),
keys as (select distinct key, encode(key) as bytes from texts),
crcs as (  -- bit by bit; before each eighth bit the next byte comes in
    select key, xor(4294967295, list_reduce(list_concat([4294967295::bigint], range(0, 8 * octet_length(bytes))),
        lambda c, i: xor(
            xor(c, case when i % 8 = 0 then ascii(substr(key, cast(i // 8 + 1 as bigint), 1)) else 0 end) // 2,
            case when xor(c, case when i % 8 = 0 then ascii(substr(key, cast(i // 8 + 1 as bigint), 1)) else 0 end) % 2 = 1
                then 3988292384 else 0 end))) % 20 as kind
    from keys),
hurt as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
        unnest(case when kind = 3 then [1, 2] else [1] end) as copy
    from texts join crcs using (key) where kind <> 0),
faults as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as k,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as shown
    from hurt),
marked as (
    select *, shown = '' as blank,
        shown <> '' and row_number() over (partition by conv_id, role, text order by k) > 1 as again,
        left(role, 1) as r, lag(left(role, 1)) over (partition by conv_id order by k) as r_before
    from faults),
rows as (
    select *, blank or again as gone, not blank and not again and right(shown, 1) not in ('.', '!', '?') as late
    from marked),
-- Cost, edits and text of the best way to each state: at the start, after s, after u, after a.
walk as (
    select distinct conv_id, 0::bigint as k, {'c': 0::bigint, 'a': '', 't': ''} as v0,
        {'c': 1000000000000, 'a': '', 't': ''} as vs,
        {'c': 2::bigint, 'a': 'I', 't': chr(10) || 'user:'} as vu,
        {'c': 4::bigint, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} as va
    from rows
    union all
    select conv_id, k, w0 as v0, ws as vs, vu,
        list_min([wa, {'c': vu.c + 2, 'a': vu.a || 'I', 't': vu.t || chr(10) || 'assistant:'}]) as va
    from (select *, list_min([wu,
            {'c': w0.c + 2, 'a': w0.a || 'I', 't': w0.t || chr(10) || 'user:'},
            {'c': ws.c + 2, 'a': ws.a || 'I', 't': ws.t || chr(10) || 'user:'},
            {'c': wa.c + 2, 'a': wa.a || 'I', 't': wa.t || chr(10) || 'user:'}]) as vu
        from (select o.conv_id, o.k,
                {'c': w.v0.c + 3, 'a': w.v0.a || 'D', 't': w.v0.t} as w0,
                list_min([{'c': w.vs.c + 3, 'a': w.vs.a || 'D', 't': w.vs.t},
                    {'c': w.v0.c + case when gone or r <> 's' then 1000000000000 else late::bigint end,
                     'a': w.v0.a || 'K', 't': w.v0.t || chr(10) || role || ':' || text}]) as ws,
                list_min(list_concat([{'c': w.vu.c + 3, 'a': w.vu.a || 'D', 't': w.vu.t}],
                    list_transform([w.v0, w.vs, w.va], lambda v:
                        {'c': v.c + case when gone then 1000000000000 when r = 'u' then 0 else 2 end + late::bigint,
                         'a': v.a || case when r = 'u' then 'K' else 'R' end,
                         't': v.t || chr(10) || case when r = 'u' then role else 'user' end || ':' || text}))) as wu,
                list_min([{'c': w.va.c + 3, 'a': w.va.a || 'D', 't': w.va.t},
                    {'c': w.vu.c + case when gone then 1000000000000 when r = 'a' then 0 else 2 end + late::bigint,
                     'a': w.vu.a || case when r = 'a' then 'K' else 'R' end,
                     't': w.vu.t || chr(10) || case when r = 'a' then role else 'assistant' end || ':' || text}]) as wa
            from walk w join rows o on o.conv_id is not distinct from w.conv_id and o.k = w.k + 1))),
ends as (
    select conv_id, list_min([v0, va]) as best
    from walk w join (select conv_id as id, max(k) as k from rows group by conv_id) e
        on e.id is not distinct from w.conv_id and e.k = w.k),
counts as (
    select conv_id as id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (blank) as blank, count(*) filter (again) as duplicate, count(*) filter (late) as truncated,
        count(*) filter (r_before is not null and r_before || r not in ('su', 'ua', 'au')) as illegal
    from rows group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.c, 0) as cost,
    coalesce(best.a, '') as audit, sha256(coalesce(substr(best.t, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join ends e on e.conv_id is not distinct from c.conv_id
left join counts n on n.id is not distinct from c.conv_id
"""

QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_neighbours": op3_neighbours,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_bpe": op5_bpe,
    "op6_packing": op6_packing,
    "op7_html_text": op7_html_text,
    "op8_sharding": op8_sharding,
    "op9_minhash": op9_minhash,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_whitening": op11_whitening,
    "op12_conversations": op12_conversations,
    "op13_quality": op13_quality,
}
ORACLES: dict[str, str] = {
    "op2_licenses": licenses.oracle_sql(),
    "op4_exact_dedup": OP4_SQL,
    "op12_conversations": OP12_SQL,
}
