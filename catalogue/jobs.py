"""Jobs run as a whole over the test tables, read back from what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.batch_oracles import ORACLES as BATCH
from catalogue.fixtures import flawed_raw_events, sparse
from catalogue.scratch import shared_folder
from stormgauge.plans.publish import JOBS, publish
from stormgauge.sinks.merge import merge_events
from stormgauge.sources.files import read_events

# both borders lie inside the orders' months, 1995-01 to 2001-08
PARTS = (("1995-01", "1997-06"), ("1997-07", "1997-12"), ("1998-01", "2001-12"))


def _by_period(spark, sf_dir, name):
    """A table published part by part, latest first, one part twice."""
    path = shared_folder(spark, name)
    for part in (*reversed(PARTS), PARTS[1]):
        publish(JOBS[name], sparse(spark, sf_dir), shared_folder(spark, "staged"), path, months=part)
    return spark.read.parquet(path).drop("period")


def monthly_trend_by_period(spark, sf_dir):
    return _by_period(spark, sf_dir, "monthly_risk_trend_by_type").withColumn(
        "total_events", F.col("total_events").cast("bigint")
    )


def winter_phenology_by_period(spark, sf_dir):
    return _by_period(spark, sf_dir, "winter_fenology")


def clean_events_by_run_date(spark, sf_dir):
    """Raw rows dealt over three run dates, copies of an id apart, merged last date first.

    The middle date is merged again in the end, which changes nothing.
    """
    raw = flawed_raw_events(spark, sf_dir)
    at = F.pmod(F.xxhash64("EventId", "`StartTime(UTC)`"), F.lit(3))
    target = f"{shared_folder(spark, 'merged')}/events_clean"
    for date in (2, 1, 0, 1):
        merge_events(spark, raw.where(at == date), target, shared_folder(spark, "merge"))
    return read_events(spark, target)


QUERIES = {
    f.__name__: f
    for f in (monthly_trend_by_period, winter_phenology_by_period, clean_events_by_run_date)
}
ORACLES = {
    "monthly_trend_by_period": BATCH["monthly_trend_by_type"],
    "winter_phenology_by_period": BATCH["winter_phenology"],
    "clean_events_by_run_date": BATCH["clean_events"],
}
