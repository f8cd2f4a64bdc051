"""Every registered query: against its SQL, or at least rows."""

import os
import pathlib
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from check_oracles import compare, duck

WITH_SQL = sorted(entry.oracle_sql())
ROWS_ONLY = sorted(set(entry.queries()) - set(WITH_SQL))


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_has_rows(spark, sf, name):
    assert not entry.queries()[name](spark, sf).isEmpty()


def test_flagship(spark):
    assert entry.entry(spark).count() == 10


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _entry_of(folder, code):
    """What a fresh interpreter prints with the repository at ``folder``."""
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True)
    return run.stdout.strip() or run.stderr


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    root = pathlib.Path(__file__).resolve().parents[1]
    ignore = shutil.ignore_patterns("llm", "tests", ".git", "__pycache__", "corpus_pipeline.py")
    shutil.copytree(root, tmp_path / "repo", ignore=ignore)
    names = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n == 'pipeline' or n[:2] == 'op' and n[2].isdigit()), set(e.oracle_sql()) <= set(e.queries()))"
    assert _entry_of(tmp_path / "repo", names) == "[] True"


def test_an_operator_that_cannot_be_imported_is_an_error(tmp_path):
    root = pathlib.Path(__file__).resolve().parents[1]
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns("tests", ".git", "__pycache__"))
    own = ["claimflow.llm.no_such_module"] if (root / "claimflow" / "llm").exists() else []
    for missing in ("no_such_package", *own):
        (tmp_path / "repo" / "corpus_pipeline.py").write_text(f"import {missing}\n")
        assert "ModuleNotFoundError" in _entry_of(tmp_path / "repo", "import __spark_entry__")
