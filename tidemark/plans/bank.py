"""The bank warehouse over the driver's tables: every load and model, run by the jobs themselves.

Landing files are derived from the driver's tables by the queries of ``LANDING`` (a
seed and two days, written as CSV in the landing format); the library's own loaders
and models then do all the work, day by day.  Each registered query builds what its
table needs and returns that table as it stands after the second day.  The SQL
oracles (:mod:`tidemark.plans.bank_oracles`) start from the same landing queries and
take another route: one window over all landed rows instead of loads and merges.

Timestamps are returned as text, so that no time zone is involved in a comparison.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality as Q
from tidemark.plans import jobs
from tidemark.plans.checks import SILVER_CHECKS
from tidemark.schemas import DAILY_FILES, ENTITIES
from tidemark.session import scratch_path, shuffle_files_freed
from tidemark.sources import commits

DAYS = ("2026-07-13", "2026-07-14")
SEED_RUN = _dt.datetime(2026, 7, 12, 23, 0)
RUNS = (_dt.datetime(2026, 7, 14, 0, 30), _dt.datetime(2026, 7, 15, 0, 30))
AS_OF = (_dt.date(2026, 7, 13), _dt.date(2026, 7, 14))

_TYPE = ("CASE l_linenumber % 6 WHEN 0 THEN 'purchase' WHEN 1 THEN 'transfer_out' WHEN 2 THEN 'transfer_in'"
         " WHEN 3 THEN 'withdrawal' WHEN 4 THEN 'deposit' ELSE 'fee' END")


def _customers(status: str, where: str) -> str:
    return f"""SELECT 'C' || CAST(c_custkey AS STRING) AS customer_id, substr(c_name, 1, 8) AS first_name,
       CASE WHEN c_custkey % 13 <> 0 THEN substr(c_name, 10) END AS last_name,
       CAST(DATE '1950-01-01' + CAST(c_custkey * 17 % 20000 AS INT) AS STRING) AS dob, {status} AS status,
       '2025-05-01 08:00:00' AS created_at FROM customer WHERE {where}"""


def _accounts(status: str, where: str) -> str:
    return f"""SELECT 'AC' || CAST(o_orderkey AS STRING) AS account_id, 'C' || CAST(o_custkey AS STRING) AS customer_id,
       'P' || CAST(o_orderkey % 3 AS STRING) AS product_id, 'K' || CAST(o_orderkey % 5 AS STRING) AS currency_code,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS opened_date, {status} AS status FROM orders WHERE {where}"""


def _cards(status: str, where: str) -> str:
    return f"""SELECT 'CD' || CAST(o_orderkey AS STRING) AS card_id, 'AC' || CAST(o_orderkey AS STRING) AS account_id,
       'B' || CAST(o_orderkey % 4 AS STRING) AS bin, CAST(CAST(o_orderdate AS DATE) AS STRING) AS issued_date,
       {status} AS status FROM orders WHERE {where}"""


def _transactions(day: str, extra: str, where: str) -> str:
    return f"""SELECT 'T' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS transaction_id,
       '{day} ' || lpad(CAST(l_linenumber AS STRING), 2, '0') || ':' || lpad(CAST(part % 60 AS STRING), 2, '0') || ':00'
         AS transaction_timestamp,
       'AC' || CAST(l_orderkey AS STRING) AS account_id,
       CASE WHEN l_linenumber % 6 = 0 THEN 'CD' || CAST(l_orderkey AS STRING) END AS card_id,
       CASE WHEN l_linenumber % 6 = 0 THEN 'M' || CAST(supp AS STRING) END AS merchant_id, {_TYPE} AS transaction_type,
       'K' || CAST(l_orderkey % 5 AS STRING) AS currency_code, CAST(CAST(price + {extra} AS DECIMAL(12, 2)) AS STRING) AS amount,
       CASE WHEN part % 50 = 0 THEN 'declined' ELSE 'approved' END AS status
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part, min(l_suppkey) AS supp, min(l_extendedprice) AS price
      FROM lineitem GROUP BY l_orderkey, l_linenumber) AS lines WHERE {where}"""


def _changes(day: str, where: str) -> str:
    return f"""SELECT 'CH' || CAST(event_id AS STRING) AS change_id, 'C' || CAST(user_id AS STRING) AS customer_id,
       CASE WHEN event_type = 'error' THEN 'status' ELSE 'address' END AS change_type,
       CASE WHEN event_type = 'error' THEN 'blocked' END AS status,
       CASE WHEN event_type <> 'error' THEN CAST(event_id AS STRING) || ' New Street, "' || event_type || '"' END AS address_line,
       CASE WHEN event_type <> 'error' THEN 'York' END AS city, CASE WHEN event_type <> 'error' THEN 'England' END AS country,
       '{day} ' || lpad(CAST(event_id % 24 AS STRING), 2, '0') || ':' || lpad(CAST(event_id % 60 AS STRING), 2, '0') || ':00'
         AS change_timestamp
FROM events WHERE event_type IN ('error', 'click') AND {where}"""


#: Landing files: entity -> queries of the seed, the first and the second day (None: no file).  Plain SQL that
#: both Spark and the oracles' engine run.
LANDING: dict[str, tuple[str | None, str | None, str | None]] = {
    "currencies": ("""SELECT 'K' || CAST(r_regionkey AS STRING) AS currency_code, r_name AS currency_name,
       CASE WHEN r_regionkey = 0 THEN '' ELSE lower(substr(r_name, 1, 1)) END AS symbol FROM region""", None, None),
    "account_products": ("""SELECT DISTINCT 'P' || CAST(o_orderkey % 3 AS STRING) AS product_id,
       'Product, ' || CAST(o_orderkey % 3 AS STRING) AS product_name, 'K' || CAST(o_orderkey % 3 AS STRING) AS default_currency
       FROM orders""", None, None),
    "card_bin_ranges": ("""SELECT DISTINCT 'B' || CAST(o_orderkey % 4 AS STRING) AS bin,
       'Card "' || CAST(o_orderkey % 4 AS STRING) || '"' AS product_name, 'NET' || CAST(o_orderkey % 2 AS STRING) AS network
       FROM orders WHERE o_orderkey % 4 < 3""", None, None),
    "merchant_categories": ("SELECT 'MC' || CAST(n_nationkey AS STRING) AS category_id, n_name AS category_name FROM nation", None, None),
    "merchants": ("""SELECT 'M' || CAST(s_suppkey AS STRING) AS merchant_id, s_name AS name,
       'MC' || CAST(s_nationkey AS STRING) AS category_id, 'City ' || CAST(s_nationkey AS STRING) AS city FROM supplier""", None, None),
    "transaction_types": (f"""SELECT DISTINCT {_TYPE} AS transaction_type, 'kind ' || CAST(l_linenumber % 6 AS STRING) AS description
       FROM lineitem""", None, None),
    "customers": (_customers("CASE WHEN c_custkey % 10 = 0 THEN 'blocked' ELSE 'active' END", "c_custkey % 4 <> 1"),
                  _customers("'active'", "c_custkey % 4 = 1"), _customers("'closed'", "c_custkey % 7 = 0")),
    "customer_addresses": ("""SELECT 'A' || CAST(c_custkey AS STRING) AS address_id, 'C' || CAST(c_custkey AS STRING) AS customer_id,
       CAST(c_custkey AS STRING) || ' Mill Lane, flat ' || CAST(c_nationkey AS STRING) AS address_line,
       'City ' || CAST(c_nationkey AS STRING) AS city, 'England' AS country, '2025-05-01' AS valid_from,
       CAST(NULL AS STRING) AS valid_to FROM customer""", None, None),
    "customer_contacts": ("""SELECT 'CT' || CAST(c_custkey AS STRING) AS contact_id, 'C' || CAST(c_custkey AS STRING) AS customer_id,
       '44' || CAST(c_custkey * 37 AS STRING) AS phone,
       CASE WHEN c_custkey % 9 = 0 THEN lower(c_mktsegment) ELSE lower(c_mktsegment) || CAST(c_custkey AS STRING) || '@post.example' END AS email,
       '2025-05-01' AS valid_from, CASE WHEN c_custkey % 8 = 0 THEN '2026-01-31' END AS valid_to FROM customer""", None, None),
    "accounts": (_accounts("'active'", "o_orderkey % 6 <> 0"), _accounts("'dormant'", "o_orderkey % 6 <= 1"),
                 _accounts("'closed'", "o_orderkey % 18 = 0")),
    "cards": (_cards("'active'", "o_orderkey % 5 <> 0"), _cards("'active'", "o_orderkey % 5 = 0"),
              _cards("'blocked'", "o_orderkey % 11 = 0")),
    "transactions": (None, _transactions(DAYS[0], "0", "l_orderkey % 2 = 0"),
                     _transactions(DAYS[1], "1", "l_orderkey % 2 = 1 OR l_orderkey % 10 = 0")),
    "customer_changes": (None, _changes(DAYS[0], "event_id % 2 = 0"), _changes(DAYS[1], "event_id % 2 = 1 OR event_id % 20 = 0")),
}


PART_ROWS = 500_000


def land(spark: SparkSession, sf_dir: str, entity: str, step: int, path: str) -> None:
    """Write one landing file of an entity (a folder of CSV parts in the landing format, gzipped, which no reader
    splits: a part holds ``PART_ROWS`` rows at most)."""
    sql = LANDING[entity][step]
    views = {}
    for table in ("region", "nation", "customer", "orders", "supplier", "lineitem", "events"):
        if f" {table}" in sql:
            views[table] = spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))
    (spark.sql(_bound(sql, views), **views).select(*ENTITIES[entity].columns)
     .write.option("header", "true").option("escape", '"').option("compression", "gzip")
     .option("maxRecordsPerFile", PART_ROWS).csv(path))


def _bound(sql: str, tables: dict[str, DataFrame]) -> str:
    """The query with its tables as parameters (no view is left behind in the session)."""
    for table in tables:
        sql = sql.replace(f"FROM {table}", f"FROM {{{table}}}")
    return sql


_BUILT: dict[tuple, str] = {}       # warehouses of this application, by what was built


def warehouse(spark: SparkSession, sf_dir: str, *entities: str, models: tuple[str, ...] = (), snapshots: tuple[str, ...] = (),
              dimensions: tuple[str, ...] = ()) -> str:
    """A warehouse with these entities, silver models, snapshots and dimensions, built day by day; its root."""
    key = (spark.sparkContext.applicationId, sf_dir, entities, models, snapshots, dimensions)
    if key not in _BUILT:
        area = scratch_path(spark, "bank")
        root = os.path.join(area, "warehouse")
        for step, run in enumerate((SEED_RUN, *RUNS)):
            for entity in entities:
                if LANDING[entity][step] is not None:
                    path = os.path.join(area, str(step), f"{entity}.csv")
                    land(spark, sf_dir, entity, step, path)
                    jobs.load_entity(spark, entity, path, root, run)
            if step == 0:
                continue
            for model in models:
                jobs.build_model(spark, root, model, AS_OF[step - 1], run)
            if snapshots:
                jobs.take_snapshots_for(spark, root, run, [s for s in jobs.SNAPSHOTS if s[0] in snapshots])
            for dimension in dimensions:
                jobs.build_dimension(spark, root, dimension)
        _BUILT[key] = root
    return _BUILT[key]


def _text_clocks(df: DataFrame) -> DataFrame:
    return df.select(*[F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema])


def _bronze(entity: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = warehouse(spark, sf_dir, entity)
        return _text_clocks(jobs.bronze_table(spark, root, entity))
    query.__name__ = f"bronze_{entity}"
    query.__doc__ = f"The loader of {entity}: every landed file in turn, checked, stamped and folded in."
    return query


def _silver(model: str, *entities: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = warehouse(spark, sf_dir, *entities, models=(model,))
        return _text_clocks(jobs._table(spark, root, jobs.SILVER, model))
    query.__name__ = f"model_{model}"
    query.__doc__ = f"The silver model {model}, built after each day's loads."
    return query


def _snapshot(name: str, model: str, *entities: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = warehouse(spark, sf_dir, *entities, models=(model,), snapshots=(name,))
        return _text_clocks(jobs.snapshot_table(spark, root, name))
    query.__name__ = f"snapshot_{name.removesuffix('_snapshot')}"
    query.__doc__ = f"The check snapshot {name}, taken after each day."
    return query


def _dimension(name: str, *entities: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = warehouse(spark, sf_dir, *entities, models=entities, dimensions=(name,))
        return _text_clocks(jobs._table(spark, root, jobs.GOLD, name))
    query.__name__ = f"gold_{name}"
    query.__doc__ = f"The dimension {name}, rebuilt after each day."
    return query


def warehouse_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrap and two whole daily runs (gate in warn mode), then every silver check's count."""
    key = (spark.sparkContext.applicationId, sf_dir, "runs")
    if key not in _BUILT:
        area = scratch_path(spark, "bank-runs")
        root = os.path.join(area, "warehouse")
        prefix = {entity: p for p, entity in DAILY_FILES.items()}

        def land_step(step: int) -> str:
            where = os.path.join(area, "seed") if step == 0 else os.path.join(area, "incoming", DAYS[step - 1])
            with shuffle_files_freed(spark):
                for entity in ENTITIES:
                    if LANDING[entity][step] is not None:
                        file = f"{entity}.csv" if step == 0 else f"{prefix[entity]}_{DAYS[step - 1]}.csv"
                        land(spark, sf_dir, entity, step, os.path.join(where, file))
            return where

        # Files are landed when their run is due and go once they are loaded, as do versions that later ones supersede.
        seed = land_step(0)
        jobs.bootstrap(spark, seed, root, SEED_RUN)
        commits.delete(seed)
        for step, (day, run, as_of) in enumerate(zip(DAYS, RUNS, AS_OF), 1):
            land_step(step)
            jobs.run_day(spark, day, os.path.join(area, "incoming"), root, run, as_of=as_of, on_fail="warn", consume=True, keep=1)
        _BUILT[key] = root
    return Q.run_checks(jobs.silver_tables(spark, _BUILT[key]), SILVER_CHECKS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in [
    *[_bronze(entity) for entity in LANDING],
    *[_silver(name, name) for name in jobs.silver.PASSTHROUGH],
    *[_silver(name, name) for name in ("accounts", "cards", "transactions", "customer_changes", "customer_contacts")],
    _snapshot("customers_snapshot", "customers_current", "customers", "customer_changes"),
    _snapshot("addresses_snapshot", "addresses_current", "customer_addresses", "customer_changes"),
    *[_dimension(name, main, lookup) for name, (_, main, lookup) in jobs.DIMENSIONS.items()],
    warehouse_checks]}
