"""Every query of the catalogue against its SQL in DuckDB, and the contract of the entry module."""

import math
import os
import shutil
import subprocess
import sys

import pytest

from seqloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, duck, data, name):
    frame = catalogue.QUERIES[name](spark, data)
    found = duck.sql(catalogue.ORACLES[name])
    assert sorted(frame.columns) == sorted(found.columns)
    order = sorted(frame.columns)
    assert plain(tuple(r[c] for c in order) for r in frame.collect()) == plain(found.select(*(f'"{c}"' for c in order)).fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_other_queries_give_rows(spark, data, name):
    assert catalogue.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_works_without_the_corpus_part(tmp_path):
    skip = lambda folder, names: [n for n in names if n in ("llm", ".git", "corpus_pipeline.py", "__pycache__", ".pytest_cache", "spark-warehouse")]
    shutil.copytree(REPO, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'seq_gc_stats' in q and not any(n.startswith('op1') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_nothing_else_imports_the_corpus_part():
    for folder, _, files in os.walk(f"{REPO}/seqloom"):
        if not folder.endswith("llm"):
            for f in files:
                if f.endswith(".py"):
                    text = open(f"{folder}/{f}").read()
                    assert "llm" not in text and "corpus_pipeline" not in text
