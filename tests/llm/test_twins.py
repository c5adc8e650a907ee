"""The registered queries against their SQL twins, and workers that do not have the package."""

import os
import subprocess
import sys
import tempfile

import duckdb
import pytest

import __spark_entry__ as registered
from tillwatch.llm.oracle import ORACLE
from tillwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLE) <= set(registered.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF}/{file}'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    relation = con.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    assert got == sorted(repr([row[i] for i in order]) for row in relation.fetchall())


def test_functions_reach_workers_that_do_not_have_the_package():
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
import __spark_entry__ as registered
from tillwatch.session import local_session
spark = local_session(2, "elsewhere")
for name in ("op1_url_filter", "op2_quality", "op4_near_vectors", "op5_warc", "op6_bpe", "op10_main_text"):
    print(name, registered.queries()[name](spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, timeout=300,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "op10_main_text" in done.stdout
