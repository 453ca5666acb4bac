"""Reading KPIs, feed parsing and keyed sinks over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgauge.contracts import TABLES
from catalogue.scratch import shared_folder
from catalogue.fixtures import airports, dense, readings
from stormgauge.functions.calendar import DAY_SECONDS, HOUR_SECONDS, bucket_number, utc_wall_time, wall_seconds
from stormgauge.operators import ranking
from stormgauge.operators.asof import as_of_join
from stormgauge.sinks.changelog import changelog_sink, read_latest
from stormgauge.sinks.ranged import RangedTable
from stormgauge.sinks.versions import ensure_folder
from stormgauge.sources import readings as feed
from stormgauge.sources.files import read_airports
from stormgauge.sources.schemas import CURRENT_FIELDS
from stormgauge.streaming import kpis
from stormgauge.streaming.late import Span, late_rows, late_split_sink, on_time_rows
from stormgauge.streaming.runner import start
from stormgauge.plans.live import LIVE_JOBS

WINDOW_KEY = list(TABLES["weather_realtime_sliding"].key)


def _comparable(df: DataFrame) -> DataFrame:
    """UTC wall-clock times, and doubles to six digits (sums depend on row order)."""
    plain = {"timestamp": utc_wall_time, "double": lambda c: F.round(c, 6)}
    return df.select(
        *[plain[t](F.col(c)).alias(c) if t in plain else F.col(c) for c, t in df.dtypes]
    )


def stream_tumbling_5h(spark, sf_dir):
    return _comparable(kpis.tumbling_means(readings(spark, sf_dir)))


def stream_sliding_kpi(spark, sf_dir):
    return _comparable(kpis.sliding_kpis(readings(spark, sf_dir)))


def stream_sliding_kpi_with_airports(spark, sf_dir):
    return _comparable(kpis.sliding_kpis(readings(spark, sf_dir), airports(spark, sf_dir)))


def stream_state_6h(spark, sf_dir):
    return _comparable(kpis.state_volatility(readings(spark, sf_dir)))


def stream_radiation(spark, sf_dir):
    return _comparable(kpis.radiation_kpis(readings(spark, sf_dir)))


def stream_instability(spark, sf_dir):
    return _comparable(kpis.instability(readings(spark, sf_dir)))


def stream_static_join(spark, sf_dir):
    joined = kpis.attach_airports(readings(spark, sf_dir), airports(spark, sf_dir))
    return joined.select(
        "event_id", "airport_code", "state", "county", "timezone", "location_lat", "location_lng"
    )


def _event_starts(spark, sf_dir):
    events = dense(spark, sf_dir).where("severity <> 'Light'")
    return events.select(
        "airport_code", F.col("event_id").alias("last_event"), "type", "severity", wall_seconds("local_start_ts").alias("start_s")
    )


def as_of_event_state(spark, sf_dir):
    """Each reading with the last event of its airport that began before it, up to an hour."""
    rows = readings(spark, sf_dir).select("event_id", "airport_code", F.unix_seconds("start_time_utc").alias("sec"))
    events = _event_starts(spark, sf_dir)
    return as_of_join(
        rows, events, ["airport_code"], "sec", "start_s", ["last_event", "type", "severity"],
        tolerance=3600, exact=False,
    )


def as_of_next_event(spark, sf_dir):
    """Each reading with the event of its airport that begins next, at the same second or later."""
    rows = readings(spark, sf_dir).select("event_id", "airport_code", F.unix_seconds("start_time_utc").alias("sec"))
    events = _event_starts(spark, sf_dir)
    return as_of_join(
        rows, events, ["airport_code"], "sec", "start_s", ["last_event", "type"], direction="forward"
    )


def latest_by_key(spark, sf_dir):
    """Upsert view over a log with one version of each airport hour per reading."""
    log = readings(spark, sf_dir).select(
        "airport_code",
        bucket_number(F.unix_seconds("start_time_utc"), HOUR_SECONDS).alias("hour_number"),
        F.col("event_id").alias("version"),
        "temp_c",
        "humidity",
    )
    return ranking.latest_by_key(log, ["airport_code", "hour_number"], "version")


def changelog_upsert(spark, sf_dir):
    """Two epochs written to a changelog, the first replayed, then the latest view.

    The first holds windows of half the time, with counts that are too high from
    an hour on; the second, as an update does, only windows that end later than that.
    """
    source = readings(spark, sf_dir)
    path = shared_folder(spark, "changelog")
    sink = changelog_sink(path)
    border = F.timestamp_seconds(F.lit(1705276800))
    result = kpis.sliding_kpis(source)
    early = result.where(F.col("event_window_start") < border)
    changed = F.col("event_window_end") >= border
    first = early.withColumn("event_count", F.col("event_count") + F.when(changed, 1).otherwise(0))
    sink(first, 0)
    sink(first, 0)
    sink(result.where(changed), 1)
    return _comparable(read_latest(spark, path, WINDOW_KEY))


def _ranged_kpis(spark, sf_dir):
    """The sliding KPI in four epochs of places of a day, compacted between two of them.

    The first epoch holds every window with counts that are too high; each further one puts a
    third of them right, the second of them twice, as after a replay.
    """
    result = kpis.sliding_kpis(readings(spark, sf_dir))
    place = bucket_number(F.unix_seconds("event_window_start"), DAY_SECONDS)
    table = RangedTable(spark, shared_folder(spark, "ranged"), WINDOW_KEY, place)
    table.add_epoch(result.withColumn("event_count", F.col("event_count") + 1), 0)
    third = F.pmod(F.unix_seconds("event_window_start") / 1800, F.lit(3))
    for epoch in (1, 2):
        table.add_epoch(result.where(third == epoch), epoch)
    table.add_epoch(result.where(third == 1), 2)
    table.compact()
    table.add_epoch(result.where(third == 0), 3)
    return table


def merge_on_read(spark, sf_dir):
    """All current rows of a table of base files and changes."""
    return _comparable(_ranged_kpis(spark, sf_dir).read())


def merge_on_read_asked_keys(spark, sf_dir):
    """Some airports and windows of it, after another compaction; other files stay unread."""
    table = _ranged_kpis(spark, sf_dir)
    table.compact(at_least=1)
    windows = tuple(F.timestamp_seconds(F.lit(s)) for s in (1705276800, 1705449600))
    return _comparable(table.read({"airport_code": ("K3", "K5"), "event_window_start": windows}))


def stream_run_sliding_kpi(spark, sf_dir):
    """The sliding KPI as a streaming query over JSON files into a changelog."""
    folder, path = shared_folder(spark, "feed"), shared_folder(spark, "live")
    # one airport reports a second county now and then, some messages are cut off or lack a key
    moved = F.when(F.expr("airport_code = 'K3' and event_id % 4 = 1"), "D3").otherwise(F.col("county"))
    rows = readings(spark, sf_dir).withColumn("county", moved).drop("event_id")
    whole = F.to_json(F.struct("*"), {"timeZone": "UTC"})
    broken = F.substring(whole, 1, 40)
    # valid JSON with an event time, but without the airport that keys the table
    keyless = F.to_json(F.struct(*[c for c in rows.columns if c != "airport_code"]), {"timeZone": "UTC"})
    three = [F.struct(m.alias("value")) for m in (whole, broken, keyless)]
    messages = rows.select(F.inline(F.array(*three)))
    messages.write.text(folder)
    job, source = LIVE_JOBS["weather_realtime_sliding"], feed.file_messages(spark, folder)
    sink = changelog_sink(path)
    job.start(
        source, None, [sink], shared_folder(spark, "checkpoint"), available_now=True
    ).awaitTermination()
    return _comparable(read_latest(spark, path, WINDOW_KEY).drop("created_at")).withColumn(
        "event_count", F.col("event_count").cast("bigint")
    )


def late_readings_aside(spark, sf_dir):
    """Three landings by time, every tenth reading one landing late, split by a live query.

    One row per reading: whether it went on, and how many of its windows were closed.
    """
    rows, at = readings(spark, sf_dir), F.unix_seconds("start_time_utc")
    due = F.when(at < 1704931200, 0).when(at < 1705795200, 1).otherwise(2)
    part = F.least(F.lit(2), due + F.when(F.expr("event_id % 10 = 0"), 1).otherwise(0))
    landing, folder = shared_folder(spark, "landing"), shared_folder(spark, "split")
    checkpoint, sink = shared_folder(spark, "checkpoint"), late_split_sink(folder, Span(900, 7200, 1800))
    ensure_folder(spark, landing)
    stream = spark.readStream.schema(rows.schema).parquet(landing)
    for n in range(3):
        rows.where(part == n).write.mode("append").parquet(landing)
        start(stream, [sink], checkpoint, mode="append", available_now=True).awaitTermination()
    passed = on_time_rows(spark, folder).select("event_id", F.lit(True).alias("passed"))
    aside = late_rows(spark, folder).select("event_id", "n_closed")
    both = passed.join(aside, "event_id", "full")
    return both.select(
        "event_id", F.coalesce("passed", F.lit(False)).alias("passed"), F.coalesce("n_closed", F.lit(0)).alias("n_closed")
    )


def dead_letter_split(spark, sf_dir):
    """Every 50th message is cut off, every 70th has no event time; both must fail."""
    fields = [c for c in readings(spark, sf_dir).columns if c != "event_id"]
    whole = F.to_json(F.struct(*fields), {"timeZone": "UTC"})
    timeless = F.to_json(F.struct(*[c for c in fields if c != "start_time_utc"]))
    messages = readings(spark, sf_dir).select(
        "event_id",
        F.when(F.expr("event_id % 50 = 0"), F.substring(whole, 1, 40))
        .when(F.expr("event_id % 70 = 0"), timeless)
        .otherwise(whole)
        .alias("value"),
    )
    routed = feed.route_readings(messages)
    kept = F.when(~F.col("failed"), F.col("data"))
    return routed.select(
        "event_id",
        F.when(F.col("failed"), "failed").otherwise("good").alias("branch"),
        kept["airport_code"].alias("airport_code"),
        kept["temp_c"].alias("temp_c"),
        kept["is_day"].alias("is_day"),
    )


def parsed_readings(spark, sf_dir):
    """JSON messages back to typed columns (struct star expansion)."""
    messages = readings(spark, sf_dir).select(
        F.to_json(F.struct("*"), {"timeZone": "UTC"}).alias("value")
    )
    return _comparable(feed.parse_readings(messages))


def flatten_payload(spark, sf_dir):
    """Nested responses to flat readings with the airport's place and zone."""
    measures = [field.split()[0] for field in CURRENT_FIELDS.split(", ")]
    payloads = readings(spark, sf_dir).select(
        "airport_code",
        F.col("start_time_utc").alias("seen"),
        F.to_json(F.struct(F.struct(*measures).alias("current"))).alias("body"),
    )
    return _comparable(
        feed.flatten_payload(payloads, airports(spark, sf_dir), observed_at=F.col("seen"))
    )


def airport_csv_scan(spark, sf_dir):
    """The airport dimension written as CSV and its first five rows read back.

    One file in order is what is read here, so one task writes this small dimension.
    """
    path = shared_folder(spark, "airports")
    airports(spark, sf_dir).orderBy("airport_code").coalesce(1).write.option("header", True).csv(
        path
    )
    return read_airports(spark, path, limit=5)


QUERIES = {
    f.__name__: f
    for f in (
        stream_tumbling_5h,
        stream_sliding_kpi,
        stream_sliding_kpi_with_airports,
        stream_state_6h,
        stream_radiation,
        stream_instability,
        stream_static_join,
        as_of_event_state,
        as_of_next_event,
        latest_by_key,
        changelog_upsert,
        merge_on_read,
        merge_on_read_asked_keys,
        stream_run_sliding_kpi,
        late_readings_aside,
        dead_letter_split,
        parsed_readings,
        flatten_payload,
        airport_csv_scan,
    )
}
