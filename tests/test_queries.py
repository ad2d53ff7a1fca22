"""Every query of the knowledge base against its oracle on the smallest tables, and the entry module without llm."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from florispark import plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def shown(x):
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, con, name):
    df = plans.QUERIES[name](spark, DATA)
    got = [[shown(r[c]) for c in sorted(df.columns)] for r in df.collect()]
    result = con.execute(plans.ORACLES[name])
    names = [d[0] for d in result.description]
    at = [names.index(c) for c in sorted(names)]
    assert sorted(names) == sorted(df.columns)
    assert sorted(got) == sorted([shown(r[i]) for i in at] for r in result.fetchall())


def test_entry_without_llm(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert e.llm is None and e.queries().keys() == e.oracle_sql().keys(); print(len(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=env, capture_output=True, text=True, timeout=120)
    assert int(out.stdout) == len(plans.QUERIES), out.stderr
