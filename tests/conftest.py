import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session("8", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture()
def facts(spark):
    """Cleaned observations from partial rows: facts({"book_id": "b", ...}, ...)."""
    from datetime import date

    from rankhouse.schema import DWD_TYPES

    defaults = {
        "book_id": "b1",
        "title": "t",
        "author": "a",
        "category1_name": "c",
        "category2_name": "s",
        "rank_name": "大热",
        "status": "连载中",
        "gender_type": "male",
        "number": "1",
        "unit": "万",
        "rank_date": date(2024, 1, 1),
        "created_at": None,
        "updated_at": None,
        "numeric_popularity": 1000.0,
        "numeric_read_count": 100.0,
        "numeric_score": 7.0,
        "numeric_words": 100000.0,
    }
    schema = ", ".join(f"{name} {kind}" for name, kind in DWD_TYPES.items())

    def build(*partials):
        return spark.createDataFrame([[(defaults | p)[name] for name in DWD_TYPES] for p in partials], schema)

    return build


def values(df, *columns):
    """Sorted tuples of the given columns."""
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)
