"""Small literal frames for the tests."""

from pyspark.sql import functions as F

DEFAULTS = {
    "event_id": None,
    "type": "SNOW",
    "severity": "Heavy",
    "airport_code": "K1",
    "state": "S",
    "county": "C",
    "season": "DJF",
    "is_night": False,
}


def events(spark, *rows):
    """Events from dicts with ``s`` and ``e`` as text and any other columns."""
    full = [{**DEFAULTS, "event_id": i, **row} for i, row in enumerate(rows)]
    names = [*DEFAULTS, "s", "e"]
    schema = (
        "event_id bigint, type string, severity string, airport_code string, state string, "
        "county string, season string, is_night boolean, s string, e string"
    )
    frame = spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], schema)
    start, end = (F.col(c).cast("timestamp_ntz") for c in ("s", "e"))
    return frame.withColumns(
        {
            "local_start_ts": start,
            "local_end_ts": end,
            "duration_min": (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60.0,
        }
    ).drop("s", "e")


def rows(frame, *columns):
    """Sorted tuples, times as text."""
    picked = frame.select(*columns).collect() if columns else frame.collect()
    return sorted(
        (
            tuple(
                str(v) if hasattr(v, "isoformat") else v
                for v in row
            )
            for row in picked
        ),
        key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r),
    )
