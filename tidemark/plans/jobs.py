"""User-facing jobs: bootstrap, the daily run and layer rebuilds.

Storage layout under ``root``: ``bronze/``, ``silver/``, ``gold/`` with one
folder per table (:mod:`tidemark.sources.tables`).  Event logs (bronze
transactions and customer changes, their silver models, the gold fact) and the
closed part of each snapshot only receive new rows; bronze current-state tables and
silver accounts and cards are bucketed by key, and a load rewrites the buckets it
touches; other current-state tables and the open part of each snapshot are published
as new versions.  Each load, the silver build, the snapshots and the gold build are one
step each (:mod:`tidemark.sources.commits`): a run that breaks off inside one leaves
nothing of it.  The newest
change per customer and the customer dimension are maintained from what changed
since they were last written, and the daily checks cover whole tables.
Clocks are arguments: ``run_ts`` stamps loads, log partitions and snapshot
versions (one value shared by both snapshots), ``as_of`` dates the age bracket.
A clock without a zone is UTC, whatever the machine's zone.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.load import DuplicateKeyError, clock, from_micros, inspect_batch, new_rows, stamp_load, text_lengths, utc
from tidemark.operators.quality import Check, QualityError, enforce, run_checks
from tidemark.operators.history import snapshot_step
from tidemark.operators.incremental import after_high_water
from tidemark.operators.sizing import BROADCAST_MAX_ROWS, fits
from tidemark.plans import gold, silver
from tidemark.plans.checks import GOLD_CHECKS, SILVER_CHECKS
from tidemark.plans.parallel import concurrently
from tidemark.schemas import DAILY_FILES, ENTITIES, INSERT_ABSENT, MAX_TEXT_LENGTH
from tidemark.schemas import entity as _entity
from tidemark.session import scratch_path, shuffle_files_freed
from tidemark.sources.landing import read_landing
from tidemark.sources.commits import delete, expire, step
from tidemark.sources.tables import (append_log, changed_buckets, load_folder, loads_with_keys, log_partitions, materialize, materialized,
                                    path_exists, publish, read_loads, read_table, replace_log, rewrite_loads, table_entry,
                                    table_writer, upsert_buckets)

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


def load_id(run_ts: _dt.datetime) -> str:
    """Partition name of a load: the run clock in UTC as sortable text (one clock for every log)."""
    return utc(run_ts).strftime("%Y%m%dT%H%M%S")


def _stamp(run_ts: _dt.datetime | None) -> str:
    """Partition stamp of a layer build: the run clock when given (so it is never
    earlier than the load stamps of the rows it appends), else the clock now."""
    return load_id(run_ts if run_ts is not None else _dt.datetime.now(_dt.timezone.utc))


def bronze_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Current bronze table of an entity (empty when never loaded)."""
    df = read_table(spark, root, BRONZE, name, schema=_entity(name).bronze_schema)
    return df.drop("load_id") if "load_id" in df.columns else df


def _table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame | None:
    df = read_table(spark, root, layer, name)
    if df is not None and "load_id" in df.columns:
        df = df.drop("load_id")
    return df


def load_entity(spark: SparkSession, entity: str, path: str, root: str, run_ts: _dt.datetime, *,
                strict_header: bool = False, check_lengths: bool = True,
                max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> None:
    """One landing file into bronze: read, enforce the key (and text width), stamp,
    upsert or insert-if-absent.

    The file is parsed once, into Parquet.  One aggregation over the stored keys gives their
    count (broadcast decision) and the first duplicate or NULL key, another, which moves no
    rows, the longest value of every column.  A log's rows are stored where its load lies,
    and if no earlier load may hold one of their keys they are that load; else, and for other
    entities, the parsed rows go once they are loaded.
    """
    ent = _entity(entity)
    log = ent.mode == INSERT_ABSENT
    folder = load_folder(root, BRONZE, ent.name, load_id(run_ts)) if log else None
    stored = os.path.join(root, folder) if log else scratch_path(spark, f"landed-{ent.name}")
    batch = stamp_load(read_landing(spark, ent, path, strict_header=strict_header), run_ts)
    table_writer(batch).parquet(stored)
    batch = spark.read.schema(batch.schema).parquet(stored)
    n_keys, bad, _ = inspect_batch(batch, ent.key)
    lengths = text_lengths(batch, ent.columns) if check_lengths else {}
    if bad is not None:
        raise DuplicateKeyError(f"{ent.name} landing file {path}: key {ent.key!r} not unique or NULL, e.g. {bad}")
    too_long = {c: n for c, n in lengths.items() if n is not None and n > MAX_TEXT_LENGTH}
    if too_long:
        raise QualityError(f"{ent.name} landing file {path}: text longer than {MAX_TEXT_LENGTH}: {too_long}")
    small = n_keys <= max_broadcast_rows
    with step(root, f"load {ent.name} from {path}"):
        if log:
            rows = _unloaded(spark, root, BRONZE, ent.name, batch, ent.key, small)
            at = append_log(rows, root, BRONZE, ent.name, load_id(run_ts), key=ent.key, stored=folder if rows is batch else None)
        else:
            at = upsert_buckets(batch, root, BRONZE, ent.name, ent.key, small_batch=small)
    if at != stored:
        delete(stored)


def _unloaded(spark: SparkSession, root: str, layer: str, name: str, batch: DataFrame, key: str, small: bool) -> DataFrame:
    """Batch rows whose key no load of the log holds; only loads whose index says they may are opened."""
    loads = loads_with_keys(spark, root, layer, name, batch, key, broadcast_keys=small)
    if not loads:
        return batch
    return new_rows(read_loads(spark, root, layer, name, loads), batch, key, check_unique=False, small_batch=small)


# The current-state entities have a seed file; event logs begin with the first day.
SEED_ENTITIES = tuple(name for name, e in ENTITIES.items() if e.mode != INSERT_ABSENT)


def bootstrap(spark: SparkSession, seed_dir: str, root: str, run_ts: _dt.datetime,
              entities: Sequence[str] = SEED_ENTITIES) -> list[str]:
    """Load the seed file of every entity named (``<seed_dir>/<entity>.csv``) into bronze.

    Files are looked up through the Hadoop FileSystem (any store Spark reads);
    a missing one raises before anything is loaded.
    """
    paths = {name: os.path.join(seed_dir, f"{name}.csv") for name in entities}
    missing = [p for p in paths.values() if not path_exists(p)]
    if missing:
        raise FileNotFoundError(f"seed files not found: {missing}")
    with shuffle_files_freed(spark):
        concurrently(spark, {name: lambda name=name, path=path: load_entity(spark, name, path, root, run_ts)
                             for name, path in paths.items()})
    return list(paths)


def load_day(spark: SparkSession, day: str, incoming_dir: str, root: str, run_ts: _dt.datetime) -> None:
    """The day's five landing files (a missing file raises); each is a step of its own, and none needs another."""
    folder = os.path.join(incoming_dir, day)
    concurrently(spark, {name: lambda name=name, prefix=prefix: load_entity(
        spark, name, os.path.join(folder, f"{prefix}_{day}.csv"), root, run_ts) for prefix, name in DAILY_FILES.items()})


def log_mark(spark: SparkSession, root: str, layer: str, name: str, column: str = "dwh_load_date"):
    """High-water mark of a log table from its newest load partition only.

    Loads append in time order, so the newest partition holds the greatest
    stamp; reading one partition replaces a scan of the whole history.
    """
    parts = log_partitions(root, layer, name)
    if not parts:
        return None
    return _max_instant(read_table(spark, root, layer, name).filter(F.col("load_id") == parts[-1]), column)


def _max_instant(df: DataFrame, column: str = "dwh_load_date") -> _dt.datetime | None:
    """The greatest timestamp of a column as an aware UTC instant (read as a number: no zone moves it)."""
    return from_micros(df.agg(F.max(F.unix_micros(F.col(column))).alias("m")).first()["m"])


def log_since(spark: SparkSession, root: str, layer: str, name: str, mark) -> DataFrame | None:
    """A log table restricted to load partitions that can hold rows stamped after ``mark``.

    Every load partition is named by a stamp no earlier than the load stamps of
    its rows, so ``load_id >= stamp(mark)`` prunes whole partitions; the exact
    ``> mark`` filter is applied by the incremental model.
    """
    df = read_table(spark, root, layer, name)
    if df is None:
        return None
    if mark is not None and "load_id" in df.columns:
        df = df.filter(F.col("load_id") >= F.lit(load_id(mark)))
    return df.drop("load_id") if "load_id" in df.columns else df


def build_silver(spark: SparkSession, root: str, as_of: _dt.date, run_ts: _dt.datetime | None = None) -> None:
    """All silver models from the current bronze tables, as one step."""
    with step(root, "build silver"):
        _build_silver(spark, root, as_of, run_ts)


def merge_current(spark: SparkSession, root: str, name: str, typed: Callable[[DataFrame], DataFrame], key: str) -> list[int]:
    """M1, M2: bronze rows loaded after the last run, typed and merged by key; returns the silver buckets written.

    Of the bronze table only the buckets written since the last merge are read (the
    silver table's entry names the folders it has seen), and of those the rows above
    the high-water mark.
    """
    with step(root, f"merge {name}") as own:
        bronze, mine = table_entry(root, BRONZE, name), table_entry(root, SILVER, name)
        if bronze is None:
            return upsert_buckets(typed(bronze_table(spark, root, name)), root, SILVER, name, key)
        mark = None if mine is None else _max_instant(_table(spark, root, SILVER, name))
        seen = {} if mine is None or mark is None else mine.get("seen", {})
        new = changed_buckets(spark, root, BRONZE, name, seen)
        touched = upsert_buckets(typed(after_high_water(new, None, mark=mark)), root, SILVER, name, key)
        own.set(f"{SILVER}/{name}", {**table_entry(root, SILVER, name), "seen": bronze["buckets"]})
        return touched


# The silver models, in the order of the layer; none reads another one.
SILVER_MODELS = (*silver.PASSTHROUGH, "accounts", "cards", "transactions", "customer_changes", "customer_contacts",
                 "customers_current", "addresses_current")


def _build_silver(spark: SparkSession, root: str, as_of: _dt.date, run_ts: _dt.datetime | None) -> None:
    concurrently(spark, {name: lambda name=name: build_model(spark, root, name, as_of, run_ts) for name in SILVER_MODELS})


def build_model(spark: SparkSession, root: str, name: str, as_of: _dt.date, run_ts: _dt.datetime | None = None) -> None:
    """One silver model from the current bronze tables."""
    if name in silver.PASSTHROUGH:
        publish(silver.passthrough(name, bronze_table(spark, root, name)), root, SILVER, name)
    elif name == "accounts":
        merge_current(spark, root, name, silver.typed_accounts, "account_id")
    elif name == "cards":
        merge_current(spark, root, name, silver.typed_cards, "card_id")
    elif name in ("transactions", "customer_changes"):
        model = silver.new_transactions if name == "transactions" else silver.new_customer_changes
        mark = log_mark(spark, root, SILVER, name)
        source = log_since(spark, root, BRONZE, name, mark)
        if source is None:
            source = bronze_table(spark, root, name)
        append_log(model(source, mark=mark) if mark is not None else model(source), root, SILVER, name, _stamp(run_ts))
    elif name == "customer_contacts":
        publish(silver.customer_contacts(bronze_table(spark, root, name)), root, SILVER, name)
    elif name == "customers_current":
        latest = maintain_latest_changes(spark, root, "status")
        publish(silver.customers_current(bronze_table(spark, root, "customers"), None, as_of, latest=latest), root, SILVER, name)
    elif name == "addresses_current":
        latest = maintain_latest_changes(spark, root, "address")
        publish(silver.addresses_current(bronze_table(spark, root, "customer_addresses"), None, latest=latest), root, SILVER, name)
    else:
        raise KeyError(f"unknown silver model {name!r}; known: {SILVER_MODELS}")


def maintain_latest_changes(spark: SparkSession, root: str, change_type: str) -> DataFrame:
    """The newest change per customer of one type, maintained from new log partitions only.

    The previous state (one row per customer) is merged with the changes loaded
    after its greatest load stamp; a maximum over a total order, so the result
    equals the newest change over the whole history.  Published as
    ``latest_<type>_changes`` and returned (read back from its new version).
    """
    name = f"latest_{change_type}_changes"
    prev = _table(spark, root, SILVER, name)
    mark = None if prev is None else _max_instant(prev)
    source = log_since(spark, root, BRONZE, "customer_changes", mark)
    if source is None:
        source = bronze_table(spark, root, "customer_changes")
    new = after_high_water(source, None, mark=mark) if mark is not None else source
    merged = new if prev is None else prev.unionByName(new.select(*prev.columns))
    publish(silver.latest_change(merged, change_type), root, SILVER, name)
    return _table(spark, root, SILVER, name)


SNAPSHOTS = [("customers_snapshot", "customers_current", ["status"]),
             ("addresses_snapshot", "addresses_current", ["address_line", "city", "country"])]


def take_snapshots(spark: SparkSession, root: str, run_ts: _dt.datetime) -> None:
    """Both check snapshots with one shared clock."""
    take_snapshots_for(spark, root, run_ts, SNAPSHOTS)


def take_snapshots_for(spark: SparkSession, root: str, run_ts: _dt.datetime,
                       snapshots: list[tuple[str, str, list[str]]]) -> None:
    """Check snapshots ``(name, current-state table, check columns)`` with one clock.

    A snapshot is stored in two parts: ``<name>_open`` (versioned, the open
    versions, rewritten each run) and ``<name>_closed`` (a log, closed
    versions, one partition per run).  A run reads and rewrites the open set only.

    All of it is one step.  A version still open was not closed by any finished run, so
    a run under the same clock once more drops such rows from its own closed partition
    and writes the partition anew.
    """
    with step(root, f"snapshots of {load_id(run_ts)}"):
        _take_snapshots(spark, root, clock(run_ts), load_id(run_ts), snapshots)


def _take_snapshots(spark: SparkSession, root: str, run, part: str, snapshots: list[tuple[str, str, list[str]]]) -> None:
    for name, current, check in snapshots:
        opened = _table(spark, root, SILVER, f"{name}_open")
        touched = snapshot_step(opened, _table(spark, root, SILVER, current), "customer_id", check, run)
        with materialized(touched, f"{name}-run") as touched:      # written twice below: compute once
            closed = touched.filter(F.col("valid_to").isNotNull())
            if part in log_partitions(root, SILVER, f"{name}_closed"):
                earlier = read_table(spark, root, SILVER, f"{name}_closed").filter(F.col("load_id") == part)
                if opened is None:
                    earlier = earlier.limit(0)
                else:
                    earlier = earlier.join(opened.select("scd_id"), "scd_id", "left_anti")
                closed = materialize(closed.unionByName(earlier.select(*closed.columns)), f"{name}-closed")
            replace_log(closed, root, SILVER, f"{name}_closed", part)
            publish(touched.filter(F.col("valid_to").isNull()), root, SILVER, f"{name}_open")


def snapshot_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A whole snapshot: closed history plus open versions."""
    opened = _table(spark, root, SILVER, f"{name}_open")
    closed = _table(spark, root, SILVER, f"{name}_closed")
    if opened is None:
        return closed
    return opened if closed is None else closed.unionByName(opened)


def silver_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    names = list(silver.PASSTHROUGH) + ["accounts", "cards", "transactions", "customer_changes",
                                        "customer_contacts"]
    tables = {n: _table(spark, root, SILVER, n) for n in names}
    for name, _, _ in SNAPSHOTS:
        tables[name] = snapshot_table(spark, root, name)
    return tables


def build_gold(spark: SparkSession, root: str, run_ts: _dt.datetime | None = None, *,
               full: bool = False, max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> None:
    """Account, card and merchant dimensions (rebuilt), the customer dimension
    (maintained from the snapshot clock it was last merged at) and the fact
    (delta appended; replaced keys rewritten).  ``full=True`` builds the customer
    dimension and the fact again from all of silver.

    All of it is one step: readers see the dimensions and the fact of one build.
    """
    with step(root, "build gold"):
        _build_gold(spark, root, run_ts, full, max_broadcast_rows)


def _build_gold(spark: SparkSession, root: str, run_ts: _dt.datetime | None, full: bool, max_broadcast_rows: int) -> None:
    s = silver_tables(spark, root)
    concurrently(spark, {name: lambda name=name: build_dimension(spark, root, name) for name in DIMENSIONS}
                 | {"dim_customers": lambda: _build_dim_customers(spark, root, s, full)})
    target = _table(spark, root, GOLD, "fact_transactions")
    mark = None if full else log_mark(spark, root, GOLD, "fact_transactions")
    source = log_since(spark, root, SILVER, "transactions", mark)
    delta = gold.fact_rows(source, s["transaction_types"], s["currencies"],
                           _table(spark, root, GOLD, "dim_accounts"), _table(spark, root, GOLD, "dim_customers"),
                           None if full or mark is not None else target, mark=mark)
    _write_fact(spark, root, target, delta, max_broadcast_rows, _stamp(run_ts))


# Dimensions rebuilt from two silver tables each.
DIMENSIONS = {"dim_accounts": (gold.dim_accounts, "accounts", "account_products"),
              "dim_cards": (gold.dim_cards, "cards", "card_bin_ranges"),
              "dim_merchants": (gold.dim_merchants, "merchants", "merchant_categories")}


def build_dimension(spark: SparkSession, root: str, name: str) -> None:
    """One dimension rebuilt from silver."""
    model, main, lookup = DIMENSIONS[name]
    publish(model(_table(spark, root, SILVER, main), _table(spark, root, SILVER, lookup)), root, GOLD, name)


def _build_dim_customers(spark: SparkSession, root: str, s: dict[str, DataFrame], full: bool) -> None:
    previous = _table(spark, root, GOLD, "dim_customers")
    merged_at = _table(spark, root, GOLD, "dim_customers_mark")
    merged_at = None if merged_at is None else _max_instant(merged_at, "merged_at")
    histories = s["customers_snapshot"], s["addresses_snapshot"]
    reached = max(filter(None, (_max_instant(h.select(F.greatest("valid_from", "valid_to").alias("t")), "t")
                                for h in histories)), default=None)
    if full or previous is None or merged_at is None:
        dim = gold.dim_customers(*histories, s["customer_contacts"])
    else:
        dim = gold.dim_customers_incremental(previous, *histories, s["customer_contacts"], clock(merged_at))
    publish(dim, root, GOLD, "dim_customers")
    if reached is not None:
        publish(spark.range(1).select(clock(reached).alias("merged_at")), root, GOLD, "dim_customers_mark")


def _write_fact(spark, root, target, delta, max_broadcast_rows, stamp: str | None = None) -> None:
    """delete+insert by transaction_id without rewriting the history in the common case.

    The delta is written once, to the folder of its load (its keys are probed and it is
    then named a load of the table).  The key index names the loads that may hold one of its keys;
    only those are opened, and of them only the ones that do are written anew (all in
    one job; a load without a kept row goes).  The delta is then appended.  One step.
    """
    stamp = stamp or _stamp(None)
    folder = load_folder(root, GOLD, "fact_transactions", stamp)
    table_writer(delta).parquet(os.path.join(root, folder))
    delta = spark.read.schema(delta.schema).parquet(os.path.join(root, folder))
    with step(root, "write fact_transactions"):
        if target is not None:
            keys = delta.select("transaction_id")
            small = fits(keys, max_broadcast_rows)
            probe = F.broadcast(keys) if small else keys
            logged = read_loads(spark, root, GOLD, "fact_transactions", loads_with_keys(
                spark, root, GOLD, "fact_transactions", keys, "transaction_id", broadcast_keys=small))
            # One row per load touched: bounded by the number of loads.
            hit = [] if logged is None else [r["load_id"] for r in logged.select("transaction_id", "load_id").join(
                probe, "transaction_id", "left_semi").select("load_id").distinct().collect()]
            if hit:
                kept = logged.filter(F.col("load_id").isin(hit)).join(probe, "transaction_id", "left_anti")
                rewrite_loads(kept, root, GOLD, "fact_transactions", hit)
        append_log(delta, root, GOLD, "fact_transactions", stamp, key="transaction_id", stored=folder)


def gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {n: _table(spark, root, GOLD, n)
            for n in ["dim_accounts", "dim_cards", "dim_merchants", "dim_customers", "fact_transactions"]}


# Event-log tables whose rows never change once appended.
LOG_TABLES = {SILVER: ["transactions", "customer_changes"], GOLD: ["fact_transactions"]}


def check_layer(tables: dict[str, DataFrame], checks: list[Check], on_fail: str = "error",
                unique_scope: dict[str, DataFrame] | None = None) -> list[dict]:
    present = [c for c in checks if c.table in tables and tables[c.table] is not None
               and (c.to_table is None or tables.get(c.to_table) is not None)]
    return enforce(run_checks(tables, present, unique_scope), present, on_fail)


def scope_to_run(spark: SparkSession, root: str, layer: str, tables: dict[str, DataFrame], checks: list[Check],
                 passed: str | None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Restrict log-table checks to the loads after ``passed``, the last load that passed them.

    Rows of a load that passed never change, so the row-level and relationship
    checks need the later partitions only, and a uniqueness check needs the new
    rows plus the older rows that share their keys (a semi join on the key
    column, the new keys broadcast when small).  Loads that failed stay in the
    scope of every later run until they pass; ``None`` restricts nothing.
    """
    scoped, unique_scope = dict(tables), {}
    if passed is None:
        return scoped, unique_scope
    for name in LOG_TABLES.get(layer, []):
        full = read_table(spark, root, layer, name)
        if full is None or "load_id" not in full.columns:
            continue
        new = full.filter(F.col("load_id") > passed).drop("load_id")
        older = full.filter(F.col("load_id") <= passed).drop("load_id")
        scoped[name] = new
        for ch in checks:
            if ch.table == name and ch.kind == "unique":
                keys = new.select(*ch.columns)
                small = fits(keys)
                if len(ch.columns) == 1:
                    loads = loads_with_keys(spark, root, layer, name, keys, ch.columns[0], broadcast_keys=small)
                    older = read_loads(spark, root, layer, name, [x for x in loads if x <= passed]).drop("load_id")
                unique_scope[name] = new.unionByName(older.join(F.broadcast(keys) if small else keys, list(ch.columns), "left_semi")
                                                     .select(*new.columns))
    return scoped, unique_scope


def run_day(spark: SparkSession, day: str, incoming_dir: str, root: str, run_ts: _dt.datetime, *,
            as_of: _dt.date | None = None, on_fail: str = "error", full_checks: bool = True,
            consume: bool = False, keep: int | None = None) -> dict[str, list[dict]]:
    """The daily run: bronze loads -> silver -> snapshots -> silver checks -> gold -> gold checks.

    With ``on_fail='error'`` a failing silver check stops the run before gold,
    and every later run until the rows it objects to are mended.  Checks cover
    whole tables; ``full_checks=False`` checks event logs from the last load that
    passed on (:func:`scope_to_run`).  With ``consume`` the day's landing files are deleted
    once all are loaded.  With ``keep``, what the last ``keep`` commits do not name is deleted
    after every layer: only for a warehouse without other readers and writers, as the folders
    a running one uses may be among it.  Returns the failing checks per layer.
    """
    with shuffle_files_freed(spark):
        return _run_day(spark, day, incoming_dir, root, run_ts, as_of, on_fail, full_checks, consume, keep)


def _run_day(spark: SparkSession, day: str, incoming_dir: str, root: str, run_ts: _dt.datetime, as_of: _dt.date | None,
             on_fail: str, full_checks: bool, consume: bool, keep: int | None) -> dict[str, list[dict]]:
    def drop_superseded() -> None:
        if keep is not None:
            expire(root, keep, _dt.timedelta(0))

    load_day(spark, day, incoming_dir, root, run_ts)
    if consume:
        delete(os.path.join(incoming_dir, day))
    drop_superseded()
    build_silver(spark, root, as_of or utc(run_ts).date(), run_ts)
    take_snapshots(spark, root, run_ts)
    drop_superseded()
    failed = {}
    for layer, tables_of, checks, build in [
            (SILVER, silver_tables, SILVER_CHECKS, None),
            (GOLD, gold_tables, GOLD_CHECKS, lambda: build_gold(spark, root, run_ts))]:
        if build is not None:
            build()
            drop_superseded()
        tables, scope = tables_of(spark, root), {}
        if not full_checks:
            tables, scope = scope_to_run(spark, root, layer, tables, checks, last_passed(spark, root, layer))
        failed[layer] = check_layer(tables, checks, on_fail, scope)
        if not failed[layer]:
            publish(spark.range(1).select(F.lit(_stamp(run_ts)).alias("passed")), root, layer, PASSED)
    return failed


PASSED = "checks_passed"


def last_passed(spark: SparkSession, root: str, layer: str) -> str | None:
    """The newest load whose checks of a layer all passed (None: none yet)."""
    table = _table(spark, root, layer, PASSED)
    return None if table is None else table.first()["passed"]
