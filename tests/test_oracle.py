"""Registered queries against DuckDB on the smallest tables; ``python -m checks.compare`` does all of them at any scale."""

import pytest

import __spark_entry__ as driver
from checks.compare import connect, differences

ORACLE = driver.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", [name for name in ORACLE if name != "layers_run"])
def test_same_rows(spark, small, db, name):
    rows, diff = differences(driver.queries()[name](spark, small), db, ORACLE[name])
    assert not diff, diff


def test_entry(spark):
    assert driver.entry(spark).count() == 10


def test_every_query_of_the_library_has_an_oracle():
    from checks.queries import QUERIES

    assert set(QUERIES) <= set(ORACLE)


def test_sample_is_a_part_of_whole_books(spark, small):
    sample, full = (driver.queries()[name](spark, small) for name in ("src_sample", "src_layer_table"))
    picked = sample.groupBy("book_id").count()
    assert picked.join(full.groupBy("book_id").count(), ["book_id", "count"]).count() == picked.count() > 0
