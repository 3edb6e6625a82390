from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp
from stintlog.llm import queries
from tests.llm.frames import frame, words
from tests.llm.test_minhash import brute as near
from tests.llm.test_suffix_dedup import brute as repeats


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())
    assert [name for name, _ in cp.STAGES] == ["toxicity", "exact dedup", "near dedup", "suffix dedup", "packing"]
    assert cp.ORACLE_SQL is None


def test_stages_equal_brute_force(spark, tmp_path):
    rng = random.Random(11)
    passage = words(rng, 60)
    rows = [(i, words(rng, rng.randrange(20, 60))) for i in range(60)]
    rows += [(100 + i, f"{words(rng, 8)} idiot {words(rng, 8)} moron {words(rng, 8)}") for i in range(20)]
    rows += [(200 + i, rows[i][1].upper()) for i in range(5)] + [(300 + i, f"{words(rng, 60)} {passage} {words(rng, 50)}") for i in range(4)]
    rows += [(400 + i, rows[i + 10][1] + " tail") for i in range(5)] + [(500, None), (501, "")]
    docs = frame(spark, rows)
    labels = [(i, int(100 <= i < 120)) for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    left = {}
    now = docs
    for name, stage in cp.STAGES[:-1]:
        now = cp.written(stage(spark, now, str(tmp_path)), "stage")
        assert now.columns == docs.columns
        left[name] = {r.doc_id: r.text for r in now.collect()}
    assert set(left["toxicity"]) == {i for i, _ in rows if not 100 <= i < 120}
    best = {}
    for i, t in left["toxicity"].items():
        key = (t or "").lower()
        best[key] = max(i, best.get(key, i))
    assert set(left["exact dedup"]) == set(best.values())
    kept = [i for i, _, _, k in near([*left["exact dedup"].items()]) if k]
    assert sorted(left["near dedup"]) == sorted(kept)
    ids = list(left["near dedup"])
    datas = [(left["near dedup"][i] or "").encode() for i in ids]
    for i, data, spans in zip(ids, datas, repeats(datas, 200)):
        stays = b"".join(data[e:s] for e, s in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)]))
        assert left["suffix dedup"][i] == stays.decode()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = cp.run(spark, str(tmp_path)).collect()
    want = {}
    for i, t in left["suffix dedup"].items():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want[i] = (len(ids), zlib.crc32(ids.tobytes()))
    assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packed} == want


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
