"""Daily landing folders as a file stream (the arrival trigger of the batch DAG).

``stream_landing`` reads ``<incoming>/*/<prefix>_*.csv`` as a Structured
Streaming file source with the entity's all-string schema and the landing CSV
options, runs with ``Trigger.AvailableNow`` (every file present is processed,
then the query stops), and folds each micro-batch into the bronze table with
the entity's load rule through ``foreachBatch``, under the same checks as the
batch loader: a key that stands twice in one file, a NULL key or an over-long
text raises, and nothing of that batch is stored.  Of a key in several files of
a batch the earliest file wins for event logs, the latest for upserted entities.

**Exactly once.**  A batch is one step (:mod:`tidemark.sources.commits`): its rows
and the mark "stream so-and-so is folded up to batch n" become visible together.
A batch the stream runs again, after a crash between the commit and its own
checkpoint, finds the mark and changes nothing; a batch that broke off earlier left
nothing and is folded afresh.

The checkpoint lies beside the table unless the caller names another place, so a
restart goes on where the last run stopped.  The file source remembers processed
paths: a file re-landed at the same path is not read again, so corrections go
through the batch loader (``tidemark.plans.jobs.load_entity``).

Event streams that need no files are deduplicated by ``dedupe_events`` (Spark's own
state) or ``first_of_each`` (state with a time to live, backed by the log).
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.load import DuplicateKeyError, inspect_batch, new_rows, stamp_load, utc
from tidemark.operators.quality import QualityError
from tidemark.operators.sizing import BROADCAST_MAX_ROWS, fits
from tidemark.schemas import INSERT_ABSENT, MAX_TEXT_LENGTH, Entity
from tidemark.schemas import entity as _entity
from tidemark.sources import commits
from tidemark.sources.landing import CSV_OPTIONS
from tidemark.sources.tables import append_log, loads_with_keys, read_loads, table_path, upsert_buckets


def landing_stream(spark: SparkSession, entity, pattern: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over landing CSV files matching ``pattern`` (a glob)."""
    ent = _entity(entity)
    reader = spark.readStream.schema(ent.schema).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(pattern)


def _stream_id(checkpoint: str) -> str:
    """The id Spark gave the stream when its checkpoint began."""
    fs, p = commits.filesystem(os.path.join(checkpoint, "metadata"))
    stream = fs.open(p)
    try:
        return json.loads(commits._session()._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def fold_batch(batch: DataFrame, batch_id: int, stream_id: str, root: str, layer: str, entity: Entity, stamp: _dt.datetime, *,
               file_column: str = "_file", max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Fold one micro-batch (with the file each row came from) into its table, as one step.

    Returns False, and changes nothing, if the stream's batch was folded before.
    """
    table, cols = f"{layer}/{entity.name}", list(entity.columns)
    with commits.step(root, f"fold batch {batch_id} of {stream_id} into {table}") as step:
        if step.tables.get(table, {}).get("streams", {}).get(stream_id, -1) >= batch_id:
            return False
        batch = batch.persist()         # checked, probed and written
        try:
            n_keys, bad, lengths = inspect_batch(batch, [file_column, entity.key], cols)
            if bad is not None:
                raise DuplicateKeyError(f"{entity.name} landing file: key {entity.key!r} not unique or NULL, e.g. {bad}")
            too_long = {c: n for c, n in lengths.items() if n is not None and n > MAX_TEXT_LENGTH}
            if too_long:
                raise QualityError(f"{entity.name} landing files: text longer than {MAX_TEXT_LENGTH}: {too_long}")
            pick = F.min_by if entity.mode == INSERT_ABSENT else F.max_by
            rows = (batch.groupBy(entity.key).agg(pick(F.struct(*cols), F.col(file_column)).alias("_r"))
                    .select(*[F.col(f"_r.{c}").alias(c) for c in cols]))
            rows, small = stamp_load(rows, stamp), n_keys <= max_broadcast_rows
            if entity.mode == INSERT_ABSENT:
                spark = batch.sparkSession
                loads = loads_with_keys(spark, root, layer, entity.name, rows, entity.key, broadcast_keys=small)
                if loads:
                    rows = new_rows(read_loads(spark, root, layer, entity.name, loads), rows, entity.key,
                                    check_unique=False, small_batch=small)
                append_log(rows, root, layer, entity.name, f"stream-{stream_id}-{batch_id:09d}", key=entity.key)
            else:
                upsert_buckets(rows, root, layer, entity.name, entity.key, small_batch=small)
            entry = step.tables[table]
            step.set(table, {**entry, "streams": {**entry.get("streams", {}), stream_id: batch_id}})
        finally:
            batch.unpersist()
    return True


def stream_landing(spark: SparkSession, entity, pattern: str, root: str, *,
                   layer: str = "bronze", run_ts=None, checkpoint: str | None = None,
                   max_files_per_trigger: int | None = None) -> str:
    """Ingest every landing file matching ``pattern`` into ``<root>/<layer>/<entity>``.

    Returns the streaming checkpoint folder: by default the table's own (its next run processes
    only new files); a stream over another ``pattern`` needs another one.
    """
    ent = _entity(entity)
    checkpoint = checkpoint or os.path.join(table_path(root, layer, ent.name), "_stream")
    stream = (landing_stream(spark, entity, pattern, max_files_per_trigger=max_files_per_trigger)
              .withColumn("_file", F.input_file_name()))

    def fold(batch: DataFrame, batch_id: int) -> None:
        stamp = utc(run_ts if run_ts is not None else _dt.datetime.now(_dt.timezone.utc))
        fold_batch(batch, batch_id, _stream_id(checkpoint), root, layer, ent, stamp)

    query = (stream.writeStream.foreachBatch(fold)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return checkpoint


def dedupe_events(stream: DataFrame, key: str, event_time: str | None = None,
                  watermark: str | None = None) -> DataFrame:
    """First-wins dedupe of an event stream on ``key``.

    Without a watermark the state keeps every key (exact, unbounded state).
    With ``event_time`` and ``watermark`` the state is bounded by
    ``dropDuplicatesWithinWatermark``: exact only for duplicates that arrive
    within the watermark delay; late duplicates must be caught by the
    ``insert_absent`` sink.
    """
    if event_time and watermark:
        return stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


class _First(StatefulProcessor):
    """Lets the first row of a key through and remembers the key for a while."""

    def __init__(self, ttl_ms: int, order: str, columns: list[str]):
        self.ttl_ms, self.order, self.columns = ttl_ms, order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            if len(part):
                part = part if first is None else pd.concat([first, part])
                first = part.sort_values(self.order, kind="stable", na_position="last").iloc[:1]
        if first is not None and not self.seen.exists():
            self.seen.update((int(timerValues.getCurrentProcessingTimeInMs()),))
            yield first[self.columns]

    def close(self) -> None:
        pass


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_of_each(stream: DataFrame, key: str, order: str, ttl: _dt.timedelta) -> DataFrame:
    """The first row of each key of an event stream: within a micro-batch the least ``order``, over batches the earliest batch.

    Keys are remembered in the RocksDB state store for ``ttl`` after they were seen, so the
    state holds the keys of that time and no more.  A key that comes again later passes once
    more; the log it is written to must catch it (:func:`stream_first`).
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    processor = _First(int(ttl.total_seconds() * 1000), order, stream.columns)
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=stream.schema, outputMode="Append", timeMode="ProcessingTime")


def stream_first(stream: DataFrame, key: str, order: str, root: str, layer: str, name: str, checkpoint: str, *,
                 ttl: _dt.timedelta | None = None) -> None:
    """Write the first row of each key of an event stream to a log table, exactly once, late rows kept.

    Within a micro-batch the least ``order`` wins; the batch's keys are then held against the
    log's key index, which knows all older ones.  Every micro-batch is one step.  With ``ttl``,
    state filters what came a short while ago before the table is touched
    (:func:`first_of_each`): worth it where most rows are repeats within that time, as state is
    asked key by key in Python; without it all of the work stays in Spark's own operators.
    """
    table = f"{layer}/{name}"

    def fold(batch: DataFrame, batch_id: int) -> None:
        stream_id = _stream_id(checkpoint)
        with commits.step(root, f"fold batch {batch_id} of {stream_id} into {table}") as step:
            if step.tables.get(table, {}).get("streams", {}).get(stream_id, -1) >= batch_id:
                return
            firsts = batch if ttl is not None else (
                batch.groupBy(key).agg(F.min_by(F.struct(*stream.columns), order).alias("_r")).select("_r.*"))
            held = rows = firsts.persist()      # probed and written
            try:
                small, spark = fits(rows.select(key)), batch.sparkSession
                loads = loads_with_keys(spark, root, layer, name, rows, key, broadcast_keys=small)
                if loads:
                    rows = new_rows(read_loads(spark, root, layer, name, loads), rows, key, check_unique=False, small_batch=small)
                append_log(rows, root, layer, name, f"stream-{stream_id}-{batch_id:09d}", key=key)
                entry = step.tables[table]
                step.set(table, {**entry, "streams": {**entry.get("streams", {}), stream_id: batch_id}})
            finally:
                held.unpersist()

    query = ((stream if ttl is None else first_of_each(stream, key, order, ttl)).writeStream.foreachBatch(fold)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
