"""The driver contract of __spark_entry__."""

import pytest

import __spark_entry__ as entry_mod
from cohortlens.plans.queries import QUERIES


def test_contract_shapes(spark):
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert qs and set(sql) <= set(qs)
    assert set(QUERIES) <= set(sql)
    assert all(callable(f) for f in qs.values())


def test_entry_schema_is_stable(spark):
    a = entry_mod.entry(spark)
    b = entry_mod.entry(spark)
    assert a.schema == b.schema
    assert len(a.columns) == len(set(a.columns))


def test_query_columns_unique(spark):
    for name, fn in QUERIES.items():
        cols = fn(spark, "/root/testdata/sf0.001").columns
        assert len(cols) == len(set(cols)), name


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_entry_works_without_the_llm_subpackage(tmp_path, also):
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(entry_mod.__file__).parent
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", *also, "*.md", "*.json")
    shutil.copytree(root, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(QUERIES)), "True"]
