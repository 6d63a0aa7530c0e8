"""The driver's contract, with and without the training-data package."""

import decimal
import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent
from brightwater import catalog_queries  # noqa: E402


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_the_rest_works_without_the_training_data_package(tmp_path, also):
    """Both folders deleted, with and without the pipeline's file."""
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *also))
    assert not (tmp_path / "r/brightwater/llm").exists() and not (tmp_path / "r/tests/llm").exists()
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not [k for k in q if k.startswith('op') or k == 'pipeline']"
    env = os.environ | {"PYTHONPATH": ""}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env=env)
    if also:
        subprocess.run([sys.executable, "-m", "pytest", "-q", "tests/test_sources.py"], cwd=tmp_path / "r", check=True, env=env)


def test_nothing_else_imports_it():
    for f in (ROOT / "brightwater").rglob("*.py"):
        if "llm" not in f.parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", f.read_text(), re.M), f


def plain(v):
    """A value as text that is the same whichever engine it comes from: nine digits of a number."""
    if v is None or isinstance(v, (bool, str)):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.9g}"
    return v.isoformat().removesuffix("T00:00:00").removesuffix("+00:00") if hasattr(v, "isoformat") else str(v)


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    found.execute("SET TimeZone = 'UTC'")
    for f in Path(SF).glob("*.parquet"):
        found.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return found


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(catalog_queries.oracle_sql()))
def test_same_rows_as_its_sql(spark, con, name):
    got, want = catalog_queries.queries()[name](spark, SF), con.execute(catalog_queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    text = lambda rows: sorted("|".join(map(plain, r)) for r in rows)
    assert text(map(tuple, got.select(*[f"`{c}`" for c in names]).collect())) == text(want.fetchall())
