import duckdb
import pytest

import __spark_entry__ as entry
from logtally.plans.catalog import ORACLE_SQL, QUERIES
from scripts.check_oracle import TABLES, canonical

SF = "/root/testdata/sf0.001"


def test_entry_runs_and_is_ordered(spark):
    df = entry.entry(spark)
    assert df.columns == ["fileName", "name", "occurrenceCount"]
    got = [tuple(r) for r in df.collect()]
    assert got and [r[0] for r in got] == sorted(r[0] for r in got)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_works_without_the_optional_queries(tmp_path):
    """A copy without the training-data folders still imports and lists the rest."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    root = Path(entry.__file__).parent
    shutil.copytree(root / "logtally", tmp_path / "logtally", ignore=shutil.ignore_patterns("llm"))
    (tmp_path / "logtally" / "llm" / "__pycache__").mkdir(parents=True)      # what a deletion may leave
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                         cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE_SQL))], out.stderr


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE_SQL[name])
    d_cols, d_rows = canonical([c[0] for c in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


# Plan shapes no registered query may take: pair products, row-at-a-time
# Python, and row caps.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit",
             "GlobalLimit", "LocalLimit")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_plan_has_no_forbidden_nodes(spark, name):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF).explain("formatted")
    plan = buf.getvalue()
    assert not [node for node in FORBIDDEN if node in plan]
