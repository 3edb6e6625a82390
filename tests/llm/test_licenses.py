from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from stintlog.llm import licenses
from tests.llm.frames import frame, plain_rows, texts

APACHE = 'Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in\n# compliance with the License.\n'
AT = "# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n"


@pytest.mark.parametrize("text, want, n", [
    ("Some words. Licensed under the Apache License, Version 2.0.", "Apache-2.0", 1),
    ("no end\nReleased   under the “MIT” license!\nmore", "MIT", 1),
    ("one line\nThis work is licensed under the GNU\n * General Public License, version 3. More", "GPL-3.0", 1),
    ("Released under the MIT License. Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,MIT", 2),
    ("Not released under the MIT License.", "", 0),
    (f"# head\n# {APACHE}{AT}", "Apache-2.0", 3),
    (f"{AT}\n\n# {APACHE}", "", 3),
    (APACHE, "", 1),
    ("word\n" * 300 + "Licensed under\nCC BY-NC 4.0", "CC-BY-NC-4.0", 1),
    ("", "", 0),
    (None, "", 0),
])
def test_found(spark, text, want, n):
    docs = frame(spark, [(1, text), (1, text), (None, text)], clash=True)
    assert plain_rows(licenses.licenses_of(docs)) == [(1, want, n), (1, want, n), (None, want, n)]


def test_empty_table(spark):
    assert licenses.licenses_of(frame(spark, [])).count() == 0


def test_registered_with_oracle(spark):
    sf = "/root/testdata/sf0.01"
    query, sql = entry.queries()["op2_licenses"], entry.oracle_sql()["op2_licenses"]
    got = query(spark, sf)
    assert difference(got, connect(sf), sql) is None
    assert got.filter("n_sentences > 0").count() > 0


def test_oracle_on_made_rows(spark, tmp_path):
    sentences = ["Released under the MIT License.", APACHE, AT, "x\nLicensed under\nCC BY-NC 4.0"]
    rows = texts() + [(600 + i, f"{a}\n\n{b} {a}") for i, a in enumerate(sentences) for b in sentences]
    folder = tmp_path / "documents.parquet"
    frame(spark, rows).coalesce(1).write.parquet(str(folder))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"create or replace view documents as select * from read_parquet('{folder}/*.parquet')")
    assert difference(licenses.licenses_of(spark.read.parquet(str(folder))), con, licenses.oracle_sql()) is None
