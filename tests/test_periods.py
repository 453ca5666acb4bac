"""The queries that publish by period have rows on both sides of each border."""

import pytest
from pyspark.sql import functions as F

from catalogue import batch
from catalogue.fixtures import sparse
from catalogue.jobs import PARTS, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_every_part_has_events(spark):
    month = F.date_format("local_start_ts", "yyyy-MM")
    events = sparse(spark, SMALL).select(month.alias("month")).distinct().collect()
    months = {r.month for r in events}
    assert all(any(a <= m <= b for m in months) for a, b in PARTS)
    assert all(any(a <= m <= b for a, b in PARTS) for m in months)


@pytest.mark.parametrize(
    "name, whole",
    [("monthly_trend_by_period", "monthly_trend_by_type"), ("winter_phenology_by_period", "winter_phenology")],
)
def test_parts_equal_the_full_run(spark, name, whole):
    made, full = QUERIES[name](spark, SMALL), batch.QUERIES[whole](spark, SMALL)
    columns = sorted(full.columns)
    assert sorted(made.columns) == columns
    rows = [sorted((tuple(map(str, r)) for r in f.select(*columns).collect())) for f in (made, full)]
    assert rows[0] == rows[1] and rows[0]
