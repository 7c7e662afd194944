"""Registered queries against their SQL at the smallest scale, with and without the folder of text operators."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

REPO = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"
sys.path.insert(0, str(REPO))

from hearthline.plans import oracles, queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return repr(float(f"{v:.11g}")) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data here")
@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_query_matches_sql(spark, name):
    df = queries.REGISTRY[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        assert cols
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()) == got


def test_entry_imports_without_the_text_folder(tmp_path):
    for f in ("__spark_entry__.py", "corpus_pipeline.py", "hearthline"):
        subprocess.run(["cp", "-r", str(REPO / f), str(tmp_path)], check=True)
    subprocess.run([sys.executable, "-c", f"import shutil; shutil.rmtree({str(tmp_path / 'hearthline/llm')!r}, ignore_errors=True)"], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [x for x in q if x.startswith('op') or x == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join(p for p in sys.path if "site-packages" in p or "python" in p)})
