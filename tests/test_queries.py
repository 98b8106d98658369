"""Every registered query against its SQL."""

import pytest
from compare import check, connect

import __spark_entry__ as entry
from tickertide.registry.base import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    problem, rows, _, _ = check(spark, duck, sf_dir, name, QUERIES[name], ORACLES.get(name))
    assert problem is None, problem
    assert rows >= 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["subreddit", "message_count", "avg_sentiment"]
    assert df.count() == 5


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_staged_documents_are_smaller_than_their_texts(spark, sf_dir):
    """Each document is in several messages, which lie side by side in compressed files."""
    from pathlib import Path

    from tickertide.registry.base import raw
    from tickertide.registry.scans import staged_path

    folder = staged_path(spark, sf_dir).removeprefix("file:")
    chars = raw(spark, sf_dir).selectExpr("sum(length(content))").first()[0]
    assert sum(f.stat().st_size for f in Path(folder).iterdir()) * 2 < chars
