"""Publishing by period where ends lie before their starts, and the partitions it reads."""

import pytest
from pyspark.sql import functions as F

from stormgauge.operators.sequences import FREEZE_PATTERN
from stormgauge.plans.publish import JOBS, publish
from tests.helpers import events

ROWS = [
    {"type": "RAIN", "s": "2016-01-05 10:00:00", "e": "2016-01-05 12:00:00"},
    {"type": "RAIN", "s": "2016-01-20 10:00:00", "e": "2015-12-01 10:00:00"},
    {"type": "RAIN", "s": "2016-02-03 10:00:00", "e": "2016-02-03 12:00:00"},
    {"type": "SNOW", "s": "2016-02-03 23:00:00", "e": "2016-02-03 23:30:00"},
    {"type": "COLD", "s": "2016-01-31 20:00:00", "e": "2015-11-01 10:00:00"},
    {"type": "RAIN", "s": "2016-01-31 19:00:00", "e": "2016-01-31 19:30:00"},
    {"type": "FOG", "s": "2016-01-31 21:00:00", "e": "2016-02-01 01:00:00"},
]
# spelled out on the 10th; on the 20th a row whose end lies long before stands in between
for day, hours in ((10, (1, 2, 3, 4)), (20, (1, 3, 4, 5))):
    for hour, kind in zip(hours, FREEZE_PATTERN):
        at = f"2016-02-{day} 0{hour}:00:00"
        ROWS.append({"type": kind, "s": at, "e": at.replace(":00:00", ":30:00")})
ROWS.append({"type": "HAIL", "s": "2016-02-20 02:00:00", "e": "2015-12-20 02:00:00"})


@pytest.mark.parametrize("name", ["monthly_risk_trend_by_type", "risky_sequences", "exposure_hours_daily"])
def test_a_month_alone_equals_the_full_run(spark, tmp_path, name):
    job, source = JOBS[name], events(spark, *ROWS)
    whole, part = str(tmp_path / "whole"), str(tmp_path / "part")
    publish(job, source, str(tmp_path / "s1"), whole)
    publish(job, source, str(tmp_path / "s2"), part, months=("2016-02", "2016-02"))

    def rows(path):
        # a job without rows in the month leaves no files
        frame = spark.read.schema(spark.read.parquet(whole).schema).parquet(path)
        return sorted(tuple(map(str, r)) for r in frame.where("period = 201602").collect())

    assert rows(part) == rows(whole)


def test_later_partitions_are_not_read(spark, tmp_path):
    source = events(spark, *ROWS).withColumns(
        {"event_year": F.year("local_start_ts"), "event_month": F.month("local_start_ts")}
    )
    later = source.withColumns({"event_year": F.lit(2019), "event_month": F.lit(1)})
    path = str(tmp_path / "clean")
    source.union(later).write.partitionBy("event_year", "event_month").parquet(path)
    read = spark.read.parquet(path)
    kept = JOBS["monthly_risk_trend_by_type"].partitions_for(read, ("2016-01", "2016-02"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_year" in plan
    assert kept.count() == len(ROWS) and read.count() == 2 * len(ROWS)
