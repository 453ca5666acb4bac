"""Extendible hashing of rows into shards of bounded size.

A directory is indexed by the leading bits of a hash of the key.  Starting from one bucket
at depth 0, only buckets above the byte limit split on one more bit, until every bucket
fits; a bucket is named by its depth and prefix.  Sizes are summed natively: a depth that
leaves buckets of a fraction of the limit is summed once and folded upwards, and only rows
of cells that are still too large are summed again, a few bits deeper each time.

Rows with equal keys share all bits of the key's hash.  Where such a group alone is above
the limit, the bits go on with a hash of the row's own number, so even identical rows
spread.  A single row above the limit is a shard by itself, marked ``oversized``.

A null key is a key like others, null and empty values have 0 bytes, all rows are kept
with their columns, and an empty table gives an empty result.  The operator's own columns
replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgauge.llm.common import staged

# bits of the key's hash, and of the row's own hash behind them
KEY_BITS, ROW_BITS = 40, 22
# bits that a directory is refined by, and how much finer the first sums are than the limit
STEP_BITS, FINER_BITS = 6, 3
OWN = ("shard_id", "shard_depth", "shard_bytes", "shard_rows", "oversized")


def key_hash(key: str) -> Column:
    """The leading ``KEY_BITS`` bits of the md5 of the key as text (null: empty text)."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def _buckets(cells: DataFrame, bits: int, limit: int, least: int) -> DataFrame:
    """For each cell of ``bits`` bits its bucket: the shallowest prefix that fits.

    ``least`` is the shallowest depth to look at.  A cell without a fitting prefix has a
    null depth.  Prefixes are summed once per depth, from the cells and not from the rows.
    """
    up = cells.select(
        "cell", "bytes", "n", F.explode(F.sequence(F.lit(least), F.lit(bits))).alias("depth")
    )
    prefix = F.expr(f"shiftright(cell, cast({bits} - depth as int))")
    up = up.withColumn("prefix", prefix)
    sums = up.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fits = sums.where((F.col("bytes") <= limit) | (F.col("n") == 1))
    found = up.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
    chosen = found.groupBy("cell").agg(
        F.min(F.struct("depth", "prefix", "bytes", "n")).alias("bucket")
    )
    return cells.select("cell").join(chosen, "cell", "left").select("cell", "bucket.*")


def extendible_shards(rows: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """All rows with their shard: id, depth, bytes, row count and whether it is oversized.

    ``size`` is a row's size in bytes, a condition over its columns.  ``shard_id`` is the
    prefix as a bit string, empty for a table that fits one shard.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    kept = [c for c in rows.columns if c not in OWN]
    body = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.lit(None)
    slim = rows.select(
        body.alias("row"),
        key_hash(key).alias("h"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("number"),
    )
    # written once, so that a row's number stays its own
    slim = staged(slim, "shard-rows")
    own = F.pmod(F.xxhash64("number"), F.lit(1 << ROW_BITS))
    slim = slim.withColumn("h", F.shiftleft("h", ROW_BITS) + own)

    total = slim.agg(F.sum("size")).first()[0] or 0
    full = KEY_BITS + ROW_BITS
    bits = min(KEY_BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + FINER_BITS)
    open_rows, least, done = slim.select("h", "size"), 0, None
    while True:
        cell = F.shiftright("h", full - bits).alias("cell")
        cells = open_rows.groupBy(cell).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        cells = staged(cells, "shard-cells")
        found = staged(_buckets(cells, bits, limit, least), "shard-buckets")
        if bits == full:
            # no further bit: such rows share a number's hash, which is as good as never
            whole = cells.select("cell", F.lit(full).alias("depth"), F.col("cell").alias("prefix"), "bytes", "n")
            found = found.where("depth is not null").union(
                whole.join(found.where("depth is null").select("cell"), "cell", "left_semi")
            )
        fits = found.where("depth is not null").select(
            F.lit(bits).alias("bits"), "cell", "depth", "prefix", "bytes", "n"
        )
        done = fits if done is None else done.union(fits)
        left = found.where("depth is null").select("cell")
        if left.isEmpty():
            break
        open_rows = open_rows.withColumn("cell", F.shiftright("h", full - bits))
        open_rows = staged(open_rows.join(left, "cell", "left_semi").select("h", "size"), "shard-open")
        least, bits = bits + 1, min(full, bits + STEP_BITS)

    directory = staged(done, "shard-directory")
    depths = [r.bits for r in directory.select("bits").distinct().orderBy("bits").collect()]
    out = None
    for bits in depths:
        # the cells of each refinement are apart from those before, so every row joins once
        part = slim.withColumn("cell", F.shiftright("h", full - bits)).join(
            directory.where(F.col("bits") == bits).drop("bits"), "cell"
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = slim.withColumn("cell", F.col("h")).join(directory.drop("bits"), "cell")
    bit_string = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.expr("lpad(bin(prefix), depth, '0')")
    )
    return out.select(
        *(F.col(f"row.`{c}`") for c in kept),
        bit_string.alias("shard_id"),
        F.col("depth").cast("int").alias("shard_depth"),
        F.col("bytes").alias("shard_bytes"),
        F.col("n").alias("shard_rows"),
        (F.col("bytes") > limit).alias("oversized"),
    )
