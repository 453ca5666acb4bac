"""What the operators of this subpackage share: tables, folds, scratch tables, components."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormgauge.session import remove_folder

# rows handed to Python at once; texts may be long, so far fewer than Spark's default
ARROW_ROWS = 1000
# parts in which the rows of a group are ranked first
PARTS = 64
# text of a shard, of which one task trains a model before the models are averaged
SHARD_BYTES = 16 << 20
# one in so many training rows is held back for thresholds
HELD = 5
# numbers in a slice of a model
SLICE = 1 << 13
# whether Spark deletes the shuffle files of a query when the query ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# files a task writes at once before it sorts its rows by bucket
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_local: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column: str, folds: int = 5) -> Column:
    """Remainder of crc32 of the id as text; a row without an id has remainder 0."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def small_batches(spark: SparkSession) -> None:
    """Lower the number of rows per Arrow batch, so that a batch of long texts fits a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; only a local master may do without one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local.setdefault("base", tempfile.mkdtemp(prefix="stormgauge-llm-"))
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage.

    The write is planned anew, so nothing else reads its shuffle files: they go with its end,
    or the passes of a loop would keep the files of all passes before.
    """
    spark = frame.sparkSession
    path = scratch(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, True)
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def staged_buckets(frame: DataFrame, by: str, buckets: int, purpose: str) -> DataFrame:
    """``staged`` in so many buckets of a column, or as many as Spark allows: grouped by it, the
    table needs no shuffle.

    The table leaves the catalogue at once, as only the frame reads its files.
    """
    spark = frame.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, 8)
    try:
        writer = frame.write.option("path", scratch(spark, purpose)).option("compression", "zstd")
        writer.bucketBy(buckets, by).saveAsTable(name)
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def discard(frame: DataFrame) -> None:
    """Delete a table that ``staged`` or ``staged_buckets`` wrote; nothing may read it any more."""
    for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        remove_folder(frame.sparkSession, folder)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``(a, b)`` edges: one row ``(node, root)`` per node.

    The root is the smallest node.  Alternates large-star and small-star steps, each of
    which hangs nodes below the smallest neighbour they see, until nothing changes.  A
    step groups by node for a minimum only, so a node with very many edges is combined
    map-side; the second use of the minimum is a join, which adaptive execution splits.
    """
    edges = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = staged(edges, "edges")
    before = _digest(edges)
    for _ in range(max_rounds):
        # large star: greater neighbours move to the smallest neighbour
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        before_edges = edges
        large = staged(large.union(least).where("a <> b"), "edges")
        # small star: smaller neighbours and the node itself move there as well
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).where("a <> b")
        edges = staged(small.distinct(), "edges")
        discard(before_edges)
        discard(large)
        now = _digest(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.union(roots)


def _digest(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def first_rows_per(frame: DataFrame, group: str, order: list, count: int) -> DataFrame:
    """The first ``count`` rows of each group.

    Rows are ranked within parts of a group first, as Spark limits a rank per task before the
    shuffle up to ``spark.sql.optimizer.windowGroupLimitThreshold`` only; one task ranks no
    more than ``count`` rows of each part.
    """
    rows = frame.withColumn("_part", F.pmod(F.xxhash64(*frame.columns), F.lit(PARTS)))
    for keys in ((group, "_part"), (group,)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("_rank", rank).where(F.col("_rank") <= count).drop("_rank")
    return rows.drop("_part")


def text_keys(doc_id: str, text: str) -> list[Column]:
    """``doc_id``, ``content`` and ``bytes`` of the rows that :func:`bounded_sample` ranks."""
    return [
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("content"),
        F.octet_length(text).cast("long").alias("bytes"),
    ]


def bounded_sample(ids: DataFrame, texts: DataFrame, per_label: int, label_bytes: int):
    """Training rows ``(doc_id, label, text)`` as an Arrow table, ordered by id and label.

    Of each label the rows whose hashed ids come first are taken: at most ``per_label`` of
    them, and none behind ``label_bytes`` bytes of text.  Only ``ids``, rows ``(doc_id, label,
    content, bytes)``, are ranked; ``texts``, rows ``(doc_id, text)``, are picked by the chosen
    ids.  Of a repeated id the text with the least hash is taken, so that a task that runs
    again finds the same rows.
    """
    ids = ids.where("bytes is not null").groupBy("doc_id", "label")
    ids = ids.agg(F.min(F.struct("content", "bytes")).alias("t")).select("doc_id", "label", "t.*")
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = first_rows_per(ids, "label", order, per_label)
    before = Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    chosen = chosen.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    chosen = chosen.where(F.col("before") < label_bytes).select("doc_id", "label", "content")
    found = texts.where("text is not null").withColumn("content", F.xxhash64("text"))
    found = found.join(F.broadcast(chosen), ["doc_id", "content"])
    return found.select("doc_id", "label", "text").distinct().orderBy("doc_id", "label").toArrow()


def training_rows(rows: DataFrame, deal: bool = True) -> DataFrame:
    """All rows ``(doc_id, label, text, bytes)`` in shards, as ``(shard, held, doc_id, label, text)``.

    Shards hold about ``SHARD_BYTES`` of text and are dealt by the hashed id; a part of the rows,
    also by the id, is ``held`` back from training.  Rows without id, label or text are left
    out; of an id and label that repeat the text with the least hash is taken.  Without ``deal``
    rows stay where they are by id, which spares those that are written next a shuffle.
    """
    rows = rows.where("doc_id is not null and label is not null and bytes is not null")
    size = rows.agg(F.sum("bytes")).first()[0] or 0
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, math.ceil(size / SHARD_BYTES)))).cast("int")
    text = F.struct(F.xxhash64("text").alias("content"), "text").alias("t")
    placed = rows.select(shard.alias("shard"), "doc_id", "label", text)
    placed = placed.repartition("shard") if deal else placed
    placed = placed.groupBy("shard", "doc_id", "label").agg(F.min("t").alias("t"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(HELD)), F.lit(HELD)) == 0
    return placed.select("shard", held.alias("held"), "doc_id", "label", "t.text")


PARTS_SCHEMA = "shard int, slot int, weight double, part binary"


def sliced(shard: int, weight: float, vector: np.ndarray) -> pa.Table:
    """Rows that hand the parameters a shard has trained to :func:`averaged`."""
    parts = [vector[i : i + SLICE].astype(np.float32).tobytes() for i in range(0, len(vector), SLICE)]
    n = len(parts)
    columns = [pa.array([shard] * n, pa.int32()), pa.array(range(n), pa.int32())]
    columns += [pa.array([float(weight)] * n), pa.array(parts, pa.binary())]
    return pa.Table.from_arrays(columns, ["shard", "slot", "weight", "part"])


def averaged(parts: DataFrame) -> np.ndarray:
    """Weighted mean of the vectors of all shards; only the mean comes to the driver."""

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, total, weight = None, None, 0.0

        def made():
            part = (total / weight).astype(np.float32).tobytes()
            return pa.RecordBatch.from_pydict({"slot": pa.array([slot], pa.int32()), "part": [part]})

        for batch in batches:
            for _, own, w, part in zip(*(c.to_pylist() for c in batch.columns)):
                if own != slot:
                    if slot is not None:
                        yield made()
                    slot, total, weight = own, 0.0, 0.0
                total, weight = total + w * np.frombuffer(part, np.float32).astype(float), weight + w
        if slot is not None:
            yield made()

    # sorted by shard, so that sums do not depend on the order of arrival
    placed = parts.repartition("slot").sortWithinPartitions("slot", "shard")
    # staged, as that deletes the shuffled texts behind it
    made = staged(placed.mapInArrow(mean, "slot int, part binary"), "model")
    rows = made.toArrow().sort_by("slot")
    discard(made)
    return np.concatenate([np.frombuffer(p, np.float32) for p in rows["part"].to_pylist()])
