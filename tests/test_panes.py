"""Sliding KPIs from panes against Spark's own sliding windows."""

import random

import pytest
from pyspark.sql import functions as F

from stormgauge.streaming import kpis

FIELDS = "precip_in temp_c humidity cloud wind_kph pressure_mb vis_km dewpoint_c uv gust_kph gti".split()


def frame(spark, seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = rng.choice([None, *(rng.randint(-20_000, 60_000) for _ in range(40))])
        key = rng.choice(["K1", "K1", "K2", "K3", None])
        values = [rng.choice([None, 1013.25, 1013.25, rng.uniform(-5, 1100)]) for _ in FIELDS]
        rows.append((key, rng.choice("ST"), rng.choice("CD"), at, rng.choice([0, 1, None]), *values))
    schema = "airport_code string, state string, county string, at long, is_day int, "
    made = spark.createDataFrame(rows, schema + ", ".join(f"{f} double" for f in FIELDS))
    return made.withColumn("start_time_utc", F.timestamp_seconds("at")).drop("at")


def rows(result):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in result.collect()),
        key=str,
    )


@pytest.mark.parametrize("kpi", [kpis.sliding_kpis, kpis.radiation_kpis, kpis.instability])
def test_panes_give_what_sliding_windows_give(spark, kpi, monkeypatch):
    source = frame(spark, kpi.__name__)
    paned = kpi(source)
    plan = paned._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan

    def at_once(readings, airports, measures, late="15 minutes", width=7200, slide=1800):
        columns = [m.at_once.alias(m.name) for m in measures]
        spans = f"{width} seconds", f"{slide} seconds"
        return kpis._windowed(readings, airports, kpis.AIRPORT, late, *spans, columns)

    monkeypatch.setattr(kpis, "_sliding", at_once)
    plain = kpi(source)
    assert plain.columns == paned.columns
    assert [f.dataType for f in plain.schema] == [f.dataType for f in paned.schema]
    assert rows(paned) == rows(plain) and len(rows(plain)) > 50
    assert rows(kpi(source.limit(0))) == []


def test_equal_readings_have_no_deviation(spark):
    source = frame(spark, 1).where("airport_code is not null and start_time_utc is not null")
    source = source.withColumns({"pressure_mb": F.lit(1013.1), "cloud": F.lit(0.1)})
    made = kpis.instability(source).collect()
    assert all(r.stddev_pressure_mb < 1e-9 for r in made if r.event_count > 1)
    assert {r.stddev_pressure_mb for r in made if r.event_count == 1} <= {None}
