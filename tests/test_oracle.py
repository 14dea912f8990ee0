"""Every query of the catalogue against DuckDB on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__
from __spark_entry__ import entry
from checks.catalogue import queries
from checks.compare import difference, duck
from checks.oracle import oracle_sql

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not available")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_all_are_registered():
    assert set(queries()) <= set(__spark_entry__.queries())
    assert oracle_sql().items() <= __spark_entry__.oracle_sql().items()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    assert difference(queries()[name](spark, SF), con.sql(oracle_sql()[name])) is None


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "a missing library"])
def test_the_rest_works_without_the_corpus_operators(tmp_path, left):
    """As after deleting ``corpus_pipeline.py`` and the ``llm`` folders, or without a library that they need."""
    here = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    skip = ["tests"] if left == "a missing library" else ["tests", "llm", "corpus_pipeline.py"]
    shutil.copytree(here, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", *skip))
    if left == "an empty folder":
        os.makedirs(tmp_path / "copy/creditloom/llm/__pycache__")
    script = "import sys; {}; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    missing = "sys.modules['ahocorasick'] = None" if left == "a missing library" else "pass"
    run = subprocess.run(
        [sys.executable, "-c", script.format(missing)], cwd=tmp_path / "copy", capture_output=True, text=True, check=True
    )
    assert run.stdout.split() == [str(len(queries())), str(len(oracle_sql()))]
    assert "corpus operators" in run.stderr


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "member_id" and df.columns[-1] == "loan_final_grade"
    assert df.count() == 10_202
