"""Nothing that an operator stages outlives the run that owns it."""

import os
import re

import pytest
from rankhouse.sources import staging

import __spark_entry__ as driver

OPERATORS = [name for name in driver.queries() if re.match(r"op\d+_|pipeline", name)]


def shared(spark):
    folder = re.sub("^file:(//)?", "", staging.shared_folder(spark))
    return {os.path.join(top, name) for top, _, names in os.walk(folder) for name in names}


@pytest.mark.parametrize("name", OPERATORS)
def test_an_owned_run_leaves_nothing(spark, small, name):
    before = shared(spark)
    with staging.owned(spark):
        rows = driver.queries()[name](spark, small)
        rows.write.format("noop").mode("overwrite").save()
    assert shared(spark) == before


def test_the_pipeline_keeps_the_last_stage_only(spark, small):
    before = shared(spark)
    with staging.owned(spark):
        rows = driver.queries()["pipeline"](spark, small)
        left = {f.split("/rankhouse_")[1].split("/")[1] for f in shared(spark) - before}
        assert rows.count() > 0 and left == {"llm-suffix_dedup", "llm-pieces"}
