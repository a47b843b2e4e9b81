"""Every registered query with check SQL equals it on whole tables; the rest return rows."""

import subprocess
import sys
from pathlib import Path

import check
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Whole results that are empty on the smallest tables, where the check SQL is empty as well.
EMPTY = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    status, n, _, note = check.compare(spark, con, sf_dir, name)
    if name in SQL:
        assert status == "ok" or (status == "EMPTY" and name in EMPTY), note
    else:
        assert n > 0


def test_entry_has_rows_and_schema(spark):
    df = entry.entry(spark)
    assert df.count() == 1
    assert "median_after" in df.columns


def test_check_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_core_queries_remain_without_the_libraries_of_the_text_operators():
    """The entry is imported anew where one library is missing."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; from tabsift.plans import QUERIES; assert e.queries() == QUERIES"
    subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, check=True, timeout=120)
