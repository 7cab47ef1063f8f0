"""Tables of a warehouse: which folders each one consists of, how they are read and written.

Three kinds of table, all resolved through the commits of :mod:`tidemark.sources.commits`:

* *versioned* (rebuilt per run): ``publish`` writes the whole table to a new folder;
* *log* (append-only event tables): ``append_log`` adds the new rows of one load, so
  a daily load writes one day of data instead of rewriting the history; with a key,
  each load gets a key index (:mod:`tidemark.operators.keyindex`);
* *bucketed* (current-state tables maintained by key): rows live in the bucket their
  key hashes to, and ``upsert_buckets`` reads and writes only the buckets a batch
  touches; all others keep their folders.

Nothing overwrites a folder that is being read.
"""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import entity as _entity
from tidemark.sources import commits

DEFAULT_LAYER = "main"
BUCKETS = 64            # of a new bucketed table; aim at 128 MB to 1 GB a bucket (see rebucket)
CODEC = "zstd"          # of all tables' files: about half of what Parquet's default takes where keys are hashes


def layer_name(custom: str | None, default: str = DEFAULT_LAYER) -> str:
    """The layer a table goes to: a custom layer name verbatim (trimmed), else the default."""
    return default if custom is None else custom.strip()


def table_path(root: str, layer: str | None, name: str) -> str:
    """Folder of a table under its layer (:func:`layer_name` routing)."""
    return os.path.join(root, layer_name(layer), name)


def _key(layer: str | None, name: str) -> str:
    return f"{layer_name(layer)}/{name}"


def table_entry(root: str, layer: str, name: str) -> dict | None:
    """What a table consists of now (None: it does not exist)."""
    return commits.tables(root).get(_key(layer, name))


def path_exists(path: str) -> bool:
    """Whether a file or folder is there, through the Hadoop FileSystem."""
    fs, p = commits.filesystem(path)
    return bool(fs.exists(p))


def log_path(root: str, layer: str, name: str) -> str:
    return os.path.join(table_path(root, layer, name), "log")


def _as_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def read_entry(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """The rows of a table as one of its entries names them (the entry of an earlier commit shows it as it was)."""
    if entry["kind"] == "version":
        return spark.read.parquet(os.path.join(root, entry["path"]))
    schema = T.StructType.fromJson(entry["schema"])
    if entry["kind"] == "log":
        if not entry["loads"]:
            return spark.createDataFrame([], schema.add("load_id", "string"))
        base = os.path.join(root, entry["base"])
        paths = [os.path.join(root, load["path"]) for load in entry["loads"].values()]
        # Partitions are w=.../load_id=...; the first level tells writes apart and is no column.
        df = spark.read.schema(schema.add("load_id", "string")).option("basePath", base).parquet(*paths)
        return df.select(*schema.fieldNames(), "load_id") if "load_id" in df.columns else df
    if not entry["buckets"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[os.path.join(root, p) for p in entry["buckets"].values()])


def read_table(spark: SparkSession, root: str, layer: str, name: str,
               schema: T.StructType | None = None) -> DataFrame | None:
    """The table as the open step sees it, else as committed last; a table that does not exist
    is an empty DataFrame of ``schema`` (None without one).  A log has the column ``load_id``."""
    entry = table_entry(root, layer, name)
    if entry is not None and (entry["kind"] != "log" or entry["loads"]):
        return read_entry(spark, root, entry)
    if schema is not None:
        return spark.createDataFrame([], schema)
    return None


def empty_table(spark: SparkSession, entity: str) -> DataFrame:
    """An empty bronze table of a landing entity (the absent target)."""
    return spark.createDataFrame([], _entity(entity).bronze_schema)


def table_writer(df: DataFrame) -> DataFrameWriter:
    """The writer of a new folder of a table."""
    return df.write.mode("errorifexists").option("compression", CODEC)


# ------------------------------------------------------------------ versioned tables
def publish(df: DataFrame, root: str, layer: str, name: str, *, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the whole table; returns its folder.

    Older versions stay on disk for readers that still use them, until :func:`commits.expire`.
    """
    with commits.step(root, f"publish {_key(layer, name)}") as step:
        folder = commits.new_folder(root, _key(layer, name), "version")
        writer = table_writer(df)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(os.path.join(root, folder))
        step.set(_key(layer, name), {"kind": "version", "path": folder})
    return os.path.join(root, folder)


# ------------------------------------------------------------------ log tables
def log_partitions(root: str, layer: str, name: str) -> list[str]:
    """``load_id`` values of a log table, oldest first (names sort by time)."""
    entry = table_entry(root, layer, name)
    return sorted(entry["loads"]) if entry is not None and entry["kind"] == "log" else []


def load_folder(root: str, layer: str, name: str, load_id: str) -> str:
    """A fresh folder, relative to the root, for the rows of partition ``load_id=<load_id>`` of a log table."""
    entry = table_entry(root, layer, name) or {"base": f"{_key(layer, name)}/log"}
    return f"{commits.new_folder(root, entry['base'])}/load_id={load_id}"


def append_log(df: DataFrame, root: str, layer: str, name: str, load_id: str, *, key: str | None = None,
               stored: str | None = None) -> str:
    """Add new rows to a log table under partition ``load_id=<load_id>``; a load that is there already is added to.

    With ``key`` the load's keys are indexed.  A load without rows adds nothing.  ``stored`` names a
    folder (:func:`load_folder`) that holds exactly ``df`` already: a new load is then not written again.
    """
    return _write_load(df, root, layer, name, load_id, key, False, stored)


def replace_log(df: DataFrame, root: str, layer: str, name: str, load_id: str, *, key: str | None = None) -> str:
    """Write ``df`` as the whole content of partition ``load_id=<load_id>`` of a log table.

    A load run again replaces what an earlier attempt wrote; without rows the partition goes.
    """
    return _write_load(df, root, layer, name, load_id, key, True)


def _write_load(df: DataFrame, root: str, layer: str, name: str, load_id: str, key: str | None, replace: bool,
                stored: str | None = None) -> str:
    from tidemark.operators.keyindex import build_index
    table, spark = _key(layer, name), df.sparkSession
    df = df.drop("load_id")
    with commits.step(root, f"write load {load_id} of {table}") as step:
        entry = step.tables.get(table) or {"kind": "log", "base": f"{table}/log", "schema": df.schema.jsonValue(), "loads": {}}
        old = entry["loads"].get(load_id)
        if old is not None and not replace:
            here = read_entry(spark, root, {**entry, "loads": {load_id: old}}).drop("load_id")
            df, key, stored = here.unionByName(df.select(*here.columns)), key or old.get("key"), None
        folder = stored or load_folder(root, layer, name, load_id)
        path = os.path.join(root, folder)
        if stored is None:
            table_writer(df).parquet(path)
        loads = {k: v for k, v in entry["loads"].items() if k != load_id}
        written = spark.read.schema(df.schema).parquet(path)
        if written.take(1):
            load = {"path": folder}
            if key is not None:
                index = f"{commits.new_folder(root, table + '/index')}/load_id={load_id}"
                table_writer(build_index(written, key)).parquet(os.path.join(root, index))
                load |= {"index": index, "key": key}
            loads[load_id] = load
        step.set(table, {**entry, "loads": loads})
    return path


def rewrite_loads(rows: DataFrame, root: str, layer: str, name: str, loads: Sequence[str]) -> None:
    """Replace what the named loads of a log table hold by ``rows`` (with load_id), some of their own rows; a load
    without rows goes.  Their indexes stay: they name every key that is left."""
    table, spark = _key(layer, name), rows.sparkSession
    with commits.step(root, f"rewrite {len(loads)} loads of {table}") as step:
        entry = step.tables[table]
        columns = T.StructType.fromJson(entry["schema"]).fieldNames()
        folder = commits.new_folder(root, entry["base"])
        table_writer(rows.select(*columns, "load_id")).partitionBy("load_id").parquet(os.path.join(root, folder))
        left = {c[len("load_id="):] for c in commits.children(os.path.join(root, folder)) if c.startswith("load_id=")}
        kept = {k: v for k, v in entry["loads"].items() if k not in set(loads)}
        kept |= {k: {**entry["loads"][k], "path": f"{folder}/load_id={k}"} for k in left}
        step.set(table, {**entry, "loads": kept})


def read_loads(spark: SparkSession, root: str, layer: str, name: str, loads: Sequence[str]) -> DataFrame | None:
    """The named loads of a log table alone (None if there is no such table)."""
    entry = table_entry(root, layer, name)
    if entry is None or entry["kind"] != "log":
        return None
    return read_entry(spark, root, {**entry, "loads": {k: v for k, v in entry["loads"].items() if k in set(loads)}})


def loads_with_keys(spark: SparkSession, root: str, layer: str, name: str, keys: DataFrame, key: str, *,
                    broadcast_keys: bool) -> list[str]:
    """Loads of a log table that may hold one of ``keys``: those whose index says so, and those without an index."""
    from tidemark.operators.keyindex import loads_that_may_hold
    entry = table_entry(root, layer, name)
    if entry is None or entry["kind"] != "log":
        return []
    indexed = {k: v["index"] for k, v in entry["loads"].items() if v.get("index") and v.get("key") == key}
    rest = [k for k in entry["loads"] if k not in indexed]
    if not indexed:
        return rest
    base = os.path.join(root, _key(layer, name), "index")
    index = (spark.read.option("basePath", base).parquet(*[os.path.join(root, p) for p in indexed.values()])
             .withColumn("load_id", F.col("load_id").cast("string")))
    found = loads_that_may_hold(index, keys.select(key), key, broadcast_keys=broadcast_keys)
    return sorted(rest + [r["load_id"] for r in found.collect()])      # a row a load


# ------------------------------------------------------------------ bucketed tables
def bucket_of(key: str | Sequence[str], buckets: int) -> Column:
    """The bucket a key lives in."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in _as_columns(key)]), F.lit(buckets)).cast("int")


def upsert_buckets(batch: DataFrame, root: str, layer: str, name: str, key: str | Sequence[str], *,
                   buckets: int = BUCKETS, small_batch: bool | None = None) -> list[int]:
    """INSERT ... ON CONFLICT (key) DO UPDATE into a bucketed table (created with ``buckets`` buckets if it is not there).

    Keys of ``batch`` must be unique.  Reads and writes the buckets the batch touches, and
    returns them.  Stored rows stream past the keys of a small batch, broadcast, without a
    shuffle; only batch rows move.  With a large one the rows of both move once, to the
    bucket they are written in (:func:`_merged`).
    """
    from tidemark.operators.load import upsert_latest
    from tidemark.operators.sizing import fits
    keys, table, spark = _as_columns(key), _key(layer, name), batch.sparkSession
    with commits.step(root, f"upsert {table}") as step:
        entry = step.tables.get(table) or {"kind": "buckets", "key": keys, "n": buckets, "buckets": {},
                                           "schema": batch.schema.jsonValue()}
        if entry["kind"] != "buckets" or entry["key"] != keys:
            raise ValueError(f"{table} is not bucketed by {keys}")
        bucket = bucket_of(keys, entry["n"])
        touched = sorted(r["b"] for r in batch.select(bucket.alias("b")).distinct().collect())      # n rows at most
        if touched:
            columns = T.StructType.fromJson(entry["schema"]).fieldNames()
            held = {str(b): entry["buckets"][str(b)] for b in touched if str(b) in entry["buckets"]}
            target = read_entry(spark, root, {**entry, "buckets": held}) if held else None
            if target is None or (fits(batch.select(*keys)) if small_batch is None else small_batch):
                rows = upsert_latest(target, batch.select(*columns).repartition(bucket), keys, check_unique=False, small_batch=True)
            else:
                rows, bucket = _merged(target, batch.select(*columns), keys, bucket), F.col("bucket")
            step.set(table, {**entry, "buckets": {**entry["buckets"], **_write_buckets(rows, root, table, bucket, touched)}})
        elif table not in step.tables:
            step.set(table, entry)
    return touched


def _merged(target: DataFrame, batch: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    """Batch rows and the stored rows whose key is not among theirs, with their ``bucket``: one shuffle of both, and a
    bucket's rows lie in one task, sorted as its files need them."""
    both = target.select(*batch.columns, F.lit(False).alias("_new")).unionByName(batch.withColumn("_new", F.lit(True)))
    held = Window.partitionBy("bucket", *keys)
    rows = both.withColumn("bucket", bucket).repartition("bucket").withColumn("_replaced", F.max("_new").over(held))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()         # equal to no other key
    return rows.filter(F.col("_new") | ~F.col("_replaced") | no_key).drop("_new", "_replaced")


def _write_buckets(rows: DataFrame, root: str, table: str, bucket: Column, touched: list[int]) -> dict[str, str]:
    folder = commits.new_folder(root, f"{table}/buckets")
    table_writer(rows.withColumn("bucket", bucket)).partitionBy("bucket").parquet(os.path.join(root, folder))
    return {str(b): f"{folder}/bucket={b}" for b in touched}


def read_buckets(spark: SparkSession, root: str, layer: str, name: str, keys: DataFrame) -> DataFrame:
    """The buckets of a bucketed table in which ``keys`` (its key columns) live."""
    entry = table_entry(root, layer, name)
    wanted = {str(r["b"]) for r in keys.select(bucket_of(entry["key"], entry["n"]).alias("b")).distinct().collect()}
    return read_entry(spark, root, {**entry, "buckets": {b: p for b, p in entry["buckets"].items() if b in wanted}})


def changed_buckets(spark: SparkSession, root: str, layer: str, name: str, since: dict[str, str]) -> DataFrame:
    """The buckets of a bucketed table whose folder is another one than in ``since`` (bucket to folder)."""
    entry = table_entry(root, layer, name)
    return read_entry(spark, root, {**entry, "buckets": {b: p for b, p in entry["buckets"].items() if since.get(b) != p}})


def rebucket(spark: SparkSession, root: str, layer: str, name: str, buckets: int) -> None:
    """Write a bucketed table anew with another number of buckets (once it has outgrown the old one)."""
    table = _key(layer, name)
    with commits.step(root, f"rebucket {table}") as step:
        entry = step.tables[table]
        bucket = bucket_of(entry["key"], buckets)
        rows = read_entry(spark, root, entry)
        held = sorted(r["b"] for r in rows.select(bucket.alias("b")).distinct().collect())
        step.set(table, {**entry, "n": buckets, "buckets": _write_buckets(rows, root, table, bucket, held) if held else {}})


# ------------------------------------------------------------------ intermediate tables
@contextlib.contextmanager
def materialized(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """:func:`materialize` for the length of a block: its files go when the block ends."""
    from tidemark.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    yield df.sparkSession.read.parquet(path)
    commits.delete(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but computes the plan only once (an
    eager checkpoint of an uncached plan computes it twice: count, then write).
    """
    from tidemark.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
