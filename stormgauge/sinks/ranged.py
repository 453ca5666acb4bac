"""Keyed table merged when it is read: base files, later changes, and a list of both.

An epoch adds files of changed rows and touches nothing else.  The list of files holds for each
its *place* (a function of the keys, such as the day of a window), whether it belongs to the base
or to an epoch, and the least and greatest value of each key column.  A reader opens only
files whose values can hold the asked keys.  Compaction merges the files of some places into a
new base for them; other places keep their files.

A version of the table is a list of files (:mod:`stormgauge.sinks.versions`), so readers see an
epoch or a compaction whole or not at all, and both may run at the same time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stormgauge.operators.ranking import top_per_group
from stormgauge.session import remove_folder
from stormgauge.sinks.versions import Conflict, commit, forget, version_text, versions

EPOCH, PLACE = "__epoch", "__place"
BASE, DELTA = "base", "delta"
TRIES = 20  # writers that meet at the same version try again

Bounds = Mapping[str, tuple[object, object]]


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the last epoch per key; of several in one epoch the least one."""
    rest = [c for c in rows.columns if c not in {*keys, EPOCH}]
    return top_per_group(rows, keys, [F.col(EPOCH).desc(), *rest])


def _same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])


def _within(bounds: Bounds, least: Callable[[str], Column], greatest: Callable[[str], Column]) -> Column:
    """Whether values from ``least`` to ``greatest`` can lie in the bounds; None leaves a side open."""
    tests = [greatest(c) >= F.lit(low) for c, (low, _) in bounds.items() if low is not None]
    tests += [least(c) <= F.lit(high) for c, (_, high) in bounds.items() if high is not None]
    return reduce(Column.__and__, tests, F.lit(True))


class RangedTable:
    """A table of one row per key in a folder.

    ``place`` is computed from the key columns alone, so that all rows of a key share a place;
    a place should hold a few files' worth of rows, and changes should fall into few of them.
    NULL keys are keys like others.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], place: Column) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.place = F.coalesce(place.cast("bigint"), F.lit(0))

    # versions

    def _at(self, version: int | None) -> tuple[int, dict]:
        held = versions(self.spark, self.path)
        if version is None:
            version = held[-1] if held else 0
        if version not in held:
            raise ValueError(f"{self.path} has no version {version or ''}".rstrip())
        return version, json.loads(version_text(self.spark, self.path, version))

    def files(self, version: int | None = None) -> DataFrame:
        """The list of files: path, kind, place, last epoch, rows, ``least`` and ``greatest`` keys."""
        return self.spark.read.parquet(f"{self.path}/{self._at(version)[1]['files']}")

    def last_epoch(self) -> int | None:
        """The last epoch that is part of the table."""
        return self._at(None)[1]["epoch"] if versions(self.spark, self.path) else None

    def _commit(self, added: DataFrame, gone: DataFrame | None, schema: str, epoch: int | None) -> int:
        """Next version: the newest list without ``gone`` and with ``added``."""
        for _ in range(TRIES):
            held = versions(self.spark, self.path)
            files, done = added, epoch
            if held:
                number, state = self._at(held[-1])
                if epoch is not None and state["epoch"] is not None and epoch <= state["epoch"]:
                    return number
                kept = self.files(number)
                if gone is not None:
                    if not gone.join(kept, "path", "left_anti").isEmpty():
                        raise Conflict(f"{self.path}: another compaction merged the same files")
                    kept = kept.join(gone, "path", "left_anti")
                files = kept.unionByName(added)
                done = state["epoch"] if epoch is None else epoch
            name = f"files-{uuid.uuid4().hex}"
            files.write.parquet(f"{self.path}/{name}")
            number = (held[-1] if held else 0) + 1
            text = json.dumps({"files": name, "schema": schema, "epoch": done})
            try:
                commit(self.spark, self.path, number, text)
                return number
            except Conflict:
                remove_folder(self.spark, f"{self.path}/{name}")
        raise Conflict(f"{self.path}: other writers were faster {TRIES} times")

    # writing

    def _write(self, rows: DataFrame, kind: str) -> DataFrame:
        """Write rows to a fresh folder and list its files; large places are split by key."""
        folder = f"{self.path}/data-{uuid.uuid4().hex}"
        placed = rows.withColumn(PLACE, self.place)
        if kind == BASE:
            # neighbouring keys share a file, so that a reader of few keys opens few files
            placed = placed.repartitionByRange(PLACE, *self.keys)
        else:
            placed = placed.hint("rebalance", PLACE)
        # sorted by all that a file is split by, or Spark would sort by place alone
        ordered = placed.sortWithinPartitions(PLACE, *self.keys)
        ordered.write.partitionBy(PLACE).parquet(folder)
        schema = StructType([f for f in placed.schema.fields if f.name != PLACE]).add(PLACE, LongType())
        written = self.spark.read.schema(schema).parquet(folder)
        edges = [
            F.struct(*[how(k).alias(k) for k in self.keys]).alias(name)
            for how, name in ((F.min, "least"), (F.max, "greatest"))
        ]
        return (
            written.groupBy(F.col("_metadata.file_path").alias("path"), F.col(PLACE).alias("place"))
            .agg(F.max(EPOCH).alias("epoch"), F.count(F.lit(1)).alias("n_rows"), *edges)
            .withColumn("kind", F.lit(kind))
        )

    def add_epoch(self, changes: DataFrame, epoch_id: int) -> int:
        """Add an epoch's changed rows and return the table's version.

        An epoch that is part of the table already (a replay) changes nothing.  Epochs come in
        ascending order.  Usable as a micro-batch sink.
        """
        done = self.last_epoch()
        if done is not None and epoch_id <= done:
            return self._at(None)[0]
        schema = StructType([StructField(f.name, f.dataType) for f in changes.schema.fields])
        if done is not None and self._at(None)[1]["schema"] != schema.json():
            raise ValueError("the columns differ from the table's")
        files = self._write(changes.withColumn(EPOCH, F.lit(epoch_id).cast("bigint")), DELTA)
        return self._commit(files, None, schema.json(), epoch_id)

    def compact(self, at_least: int = 2) -> int:
        """Merge the files of each place that has changes in ``at_least`` files; returns the version.

        Epochs that come in the meantime stay as changes beside the new base.
        """
        version, state = self._at(None)
        files = self.files(version)
        many = files.groupBy("place").agg(F.count_if(F.col("kind") == DELTA).alias("n")).where(F.col("n") >= at_least)
        merged = files.join(many, "place", "left_semi")
        paths = [r["path"] for r in merged.select("path").collect()]  # names of files, no rows
        if not paths:
            return version
        rows = self._merge(merged, state["schema"], {})
        return self._commit(self._write(rows, BASE), merged.select("path"), state["schema"], None)

    def expire(self, keep: int = 2) -> None:
        """Drop versions before the last ``keep`` and the files that only they list.

        Readers of a dropped version fail.  What a writer that was cut off left is not found.
        """
        held = versions(self.spark, self.path)
        dropped, kept = held[:-keep], held[-keep:]
        if keep < 1 or not dropped:
            return

        def paths(numbers: list[int]) -> DataFrame:
            return reduce(DataFrame.union, [self.files(n).select("path") for n in numbers])

        names = [self._at(n)[1]["files"] for n in dropped]
        unlisted = paths(dropped).distinct().join(paths(kept), "path", "left_anti").collect()
        for number in dropped:
            forget(self.spark, self.path, number)
        for row in unlisted:
            remove_folder(self.spark, row["path"])
        for name in names:
            remove_folder(self.spark, f"{self.path}/{name}")

    # reading

    def _rows(self, files: DataFrame, schema: str) -> DataFrame:
        fields = StructType.fromJson(json.loads(schema)).add(EPOCH, LongType())
        paths = [r["path"] for r in files.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(*paths)

    def _merge(self, files: DataFrame, schema: str, bounds: Bounds) -> DataFrame:
        """Changes, and those base rows whose keys have none; the base is not sorted or grouped."""
        asked = _within(bounds, F.col, F.col)
        base = self._rows(files.where(F.col("kind") == BASE), schema).where(asked)
        changed = _latest(self._rows(files.where(F.col("kind") == DELTA), schema).where(asked), self.keys)
        touched = changed.select(*self.keys)
        return base.join(touched, _same_keys(base, touched, self.keys), "left_anti").unionByName(changed)

    def read(self, bounds: Bounds | None = None, version: int | None = None) -> DataFrame:
        """The current row of each key, or of a pinned version.

        ``bounds`` gives key columns a least and greatest value, both included, None for open;
        files that hold no such keys are not opened.
        """
        bounds = bounds or {}
        if not set(bounds) <= set(self.keys):
            raise ValueError(f"bounds are for key columns: {self.keys}")
        version, state = self._at(version)
        listed = self.files(version).where(
            _within(bounds, lambda c: F.col("least")[c], lambda c: F.col("greatest")[c])
        )
        return self._merge(listed, state["schema"], bounds).drop(EPOCH)
