"""The operators shown on the driver's tables.

The bank entities do not exist in the driver's data, so each operator runs on
an analogue built from the given tables (customer/orders/lineitem/events/...)
over the whole tables.  Every query has an equivalent plain SQL text
(``tidemark.plans.oracles``) used as an independent check: the SQL takes
another route (interval joins with range conditions, LAG/LEAD) while the Spark
side goes through the library's operators.

Stand-in inputs (e.g. a birth date derived from a customer key) only give rows
in the schema an operator expects; the operator does all of its work on them.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import (age_bracket, completed_years, mask_email, mask_name, mask_phone,
                                nullable_key, redact_digits, surrogate_key, to_amount, to_date,
                                to_text, versioned_key)
from tidemark.operators import quality as Q
from tidemark.operators.history import lookup_version, merge_timelines, replay_snapshots, snapshot_check
from tidemark.operators.incremental import after_high_water, append_new, merge_by_key, replace_by_key
from tidemark.operators.latest import (eligible, latest_by_key, next_ids, number_within_key,
                                       overlay_latest, state_as_of)
from tidemark.operators.load import insert_absent, upsert_latest
from tidemark.operators.sizing import lookup_join
from tidemark.schemas import INSERT_ABSENT, UPSERT, Entity
from tidemark.session import scratch_path
from tidemark.sources.tables import materialize

# Fixed parameters of the analogues.
SPLIT_SHIPDATE = "1998-01-01"          # lineitem: base before, batch from this date
EVENTS_FIRST_HALF_END = "2024-01-16"   # events: target holds events before this instant
RUN_1, RUN_2 = "2024-01-15", "2024-01-30"
STATE_CUTOFF = "2024-01-20"
AS_OF_DATE = _dt.date(2026, 7, 13)
DOB_ORIGIN = "1940-01-01"
DOB_SPAN_DAYS = 25000


# The events table landed as an append-only event log (first wins on event_id).
EVENTS_LANDING = Entity("events", "event_id", ("event_id", "ts", "user_id", "event_type", "props"), INSERT_ABSENT)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --------------------------------------------------------------------------- history
def order_priority_versions(spark, sf_dir) -> DataFrame:
    """Customer versions: a customer's order priority, a new version when it changes (H6)."""
    orders = load(spark, sf_dir, "orders")
    return replay_snapshots(orders.select("o_custkey", "o_orderdate", F.col("o_orderpriority").alias("priority")),
                            "o_custkey", "o_orderdate", ["priority"], order=["priority"])


def asof_fact(spark, sf_dir) -> DataFrame:
    """H3 (+W1/W2/H7/H8): each line item gets the customer version in force at ship date."""
    versions = order_priority_versions(spark, sf_dir).withColumn(
        "customer_sk", versioned_key("o_custkey", "valid_from"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    facts = (load(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey"))
    out = lookup_version(facts, versions, "o_custkey", "l_shipdate",
                         columns=["customer_sk", "priority"], backdate_first=True)
    return out.withColumnRenamed("priority", "cust_priority")


def asof_fact_join(spark, sf_dir) -> DataFrame:
    """H3 in the literal join form (equi + range left join); same result as ``asof_fact``."""
    versions = order_priority_versions(spark, sf_dir).withColumn(
        "customer_sk", versioned_key("o_custkey", "valid_from"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    facts = (load(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey"))
    out = lookup_version(facts, versions, "o_custkey", "l_shipdate",
                         columns=["customer_sk", "priority"], backdate_first=True, method="join")
    return out.withColumnRenamed("priority", "cust_priority")


HOT_CUSTOMER = 7               # the customer that receives a third of all line items
HOT_ROWS_PER_SEGMENT = 2000    # rows per task for hot keys in the skewed variant


def asof_fact_skewed(spark, sf_dir) -> DataFrame:
    """H3 under skew: line items 1 and 2 of every order (over a quarter of all rows)
    belong to one customer; once its rows exceed the per-task target the lookup
    cuts them into time segments."""
    versions = order_priority_versions(spark, sf_dir).withColumn(
        "customer_sk", versioned_key("o_custkey", "valid_from"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    facts = (load(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey")
             .withColumn("o_custkey", F.when(F.col("l_linenumber") <= 2, F.lit(HOT_CUSTOMER).cast("long"))
                         .otherwise(F.col("o_custkey"))))
    out = lookup_version(facts, versions, "o_custkey", "l_shipdate", columns=["customer_sk", "priority"],
                         backdate_first=True, rows_per_segment=HOT_ROWS_PER_SEGMENT)
    return out.withColumnRenamed("priority", "cust_priority")


def signup_versions(events: DataFrame) -> DataFrame:
    signups = events.filter(F.col("event_type") == "signup").select(
        "user_id", "ts", F.col("event_id").alias("signup_id"))
    return replay_snapshots(signups, "user_id", "ts", ["signup_id"], order=["signup_id"])


def asof_no_backdate(spark, sf_dir) -> DataFrame:
    """Purchases get the signup version in force; none before the first signup."""
    events = load(spark, sf_dir, "events")
    purchases = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return lookup_version(purchases, signup_versions(events), "user_id", "ts",
                          columns=["signup_id"], backdate_first=False)


def status_bucket(value) -> F.Column:
    v = F.col(value)
    return F.when(v < 25, "low").when(v < 100, "mid").otherwise("high")


def user_histories(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two independently timed histories per user: status (signups) and address (clicks)."""
    status = replay_snapshots(
        events.filter(F.col("event_type") == "signup").select("user_id", "ts", "event_id",
                                                              status_bucket("value").alias("status")),
        "user_id", "ts", ["status"], order=["event_id"])
    address = replay_snapshots(
        events.filter(F.col("event_type") == "click").select("user_id", "ts", "event_id",
                                                             F.col("props").alias("address")),
        "user_id", "ts", ["address"], order=["event_id"])
    return status, address


def merged_timeline(spark, sf_dir) -> DataFrame:
    """H2 (+U1/J6/J7/W1/P8): one timeline per user from the status and address histories."""
    status, address = user_histories(load(spark, sf_dir, "events"))
    merged = merge_timelines([(status, ["status"]), (address, ["address"])], "user_id")
    return merged.select(versioned_key("user_id", "valid_from").alias("customer_sk"), "user_id", "status",
                         "address", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def merged_timeline_join(spark, sf_dir) -> DataFrame:
    """H2 in the literal join form (range joins + LEAD); same result as ``merge_timelines``."""
    status, address = user_histories(load(spark, sf_dir, "events"))
    merged = merge_timelines([(status, ["status"]), (address, ["address"])], "user_id", method="join")
    return merged.select(versioned_key("user_id", "valid_from").alias("customer_sk"), "user_id", "status",
                         "address", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def replayed_snapshots(spark, sf_dir) -> DataFrame:
    """H6: last event type per user and day; a version opens whenever it changes."""
    events = load(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return replay_snapshots(events.select("user_id", "day", "ts", "event_id", "event_type"),
                            "user_id", "day", ["event_type"], order=["ts", "event_id"])


def user_state_before(events: DataFrame, cutoff: str) -> DataFrame:
    last = latest_by_key(events.filter(F.col("ts") < _ntz(cutoff)), "user_id", "ts", tiebreak=["event_id"])
    return last.select("user_id", F.col("event_type").alias("status"), F.col("event_id").alias("last_event_id"))


def snapshot_two_runs(spark, sf_dir) -> DataFrame:
    """H1: a check snapshot (on status) taken on two run dates."""
    events = load(spark, sf_dir, "events")
    snap = snapshot_check(None, user_state_before(events, RUN_1), "user_id", ["status"], _ntz(RUN_1))
    return snapshot_check(snap, user_state_before(events, RUN_2), "user_id", ["status"], _ntz(RUN_2))


def latest_overlay(spark, sf_dir) -> DataFrame:
    """H4 (A2 + J5): the newest signup's props overlay each customer's segment."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    signups = load(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    latest = latest_by_key(signups.select(F.col("user_id").alias("c_custkey"), "ts", "event_id", "props"),
                           "c_custkey", "ts", tiebreak=["event_id"])
    return overlay_latest(customer, latest, "c_custkey", {"c_mktsegment": "props"})


def state_before_cutoff(spark, sf_dir) -> DataFrame:
    """H5: customer state from all batches strictly before a date (re-registrations + status changes)."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("status"))
    events = load(spark, sf_dir, "events").withColumn("batch_date", F.to_date("ts"))
    additions = events.filter(F.col("event_type") == "signup").select(
        F.col("user_id").alias("c_custkey"), F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("c_name"),
        F.lit("active").alias("status"), "batch_date", "ts", "event_id")
    changes = events.filter(F.col("event_type") == "error").select(
        F.col("user_id").alias("c_custkey"), F.lit("blocked").alias("new_status"), "batch_date", "ts", "event_id")
    return state_as_of(customer, "c_custkey", F.lit(STATE_CUTOFF).cast("date"), additions=additions,
                       changes=changes, change_columns={"status": "new_status"},
                       addition_order=["ts", "event_id"], change_order=["ts", "event_id"])


def _order_histories(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two customer histories from orders: priority and order status, each a new version on change."""
    orders = load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "customer_id")
    prio = replay_snapshots(orders.select("customer_id", "o_orderdate", F.col("o_orderpriority").alias("priority")),
                            "customer_id", "o_orderdate", ["priority"], order=["priority"])
    stat = replay_snapshots(orders.select("customer_id", "o_orderdate", F.col("o_orderstatus").alias("order_status")),
                            "customer_id", "o_orderdate", ["order_status"], order=["order_status"])
    return prio, stat


def _contacts(spark, sf_dir) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"),
                    mask_phone(F.col("c_custkey").cast("string")).alias("phone"),
                    mask_email(F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@mail.example")))
                    .alias("email"))


def gold_dim_customers(spark, sf_dir) -> DataFrame:
    """G4 (gold model): customer dimension from two histories plus contacts."""
    from tidemark.plans import gold
    prio, stat = _order_histories(spark, sf_dir)
    # Snapshots are stored tables in the daily job; stored the same way here.
    prio, stat = materialize(prio, "hist-priority"), materialize(stat, "hist-status")
    return gold.dim_customers(prio, stat, _contacts(spark, sf_dir),
                              customer_attrs=["priority"], address_attrs=["order_status"])


def gold_fact_transactions(spark, sf_dir) -> DataFrame:
    """G1 + G5 (gold models): line items as transactions resolved to account, card, merchant
    and customer-version keys through the gold account and customer dimensions."""
    from tidemark.plans import gold
    orders = load(spark, sf_dir, "orders")
    li = load(spark, sf_dir, "lineitem")
    accounts = orders.select(F.col("o_orderkey").cast("string").alias("account_id"),
                             F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("product_id"),
                             F.col("o_orderstatus").alias("currency_code"),
                             F.to_date("o_orderdate").alias("opened_date"), F.lit("active").alias("status"),
                             F.col("o_orderdate").alias("dwh_load_date"))
    products = orders.select(F.col("o_orderpriority").alias("product_id")).distinct().select(
        "product_id", F.concat(F.lit("priority "), F.col("product_id")).alias("product_name"),
        F.lit("USD").alias("default_currency"))
    # The daily job stores the dimensions before the fact reads them; here they
    # are written once to the shared checkpoint folder for the same effect.
    dim_acc = materialize(gold.dim_accounts(accounts, products), "dim-accounts")
    dim_cust = materialize(gold_dim_customers(spark, sf_dir), "dim-customers")
    tx = li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("l_shipdate").alias("transaction_timestamp"), F.col("l_orderkey").cast("string").alias("account_id"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_partkey").cast("string")).alias("card_id"),
        F.col("l_suppkey").cast("string").alias("merchant_id"), F.col("l_returnflag").alias("transaction_type"),
        F.col("l_linestatus").alias("currency_code"), to_amount(F.col("l_quantity").cast("string")).alias("amount"),
        F.lit("approved").alias("status"), F.col("l_shipdate").alias("dwh_load_date"))
    types = li.select(F.col("l_returnflag").alias("transaction_type")).distinct().select(
        "transaction_type", F.concat(F.lit("flag "), F.col("transaction_type")).alias("description"))
    currencies = li.select(F.col("l_linestatus").alias("currency_code")).distinct().select(
        "currency_code", F.concat(F.lit("status "), F.col("currency_code")).alias("currency_name"))
    return gold.fact_rows(tx, types, currencies, dim_acc, dim_cust)


def overlapping_order_versions(spark, sf_dir) -> DataFrame:
    """Overlap guard (H2/H3 precondition): each customer's order opens a 60-day
    version; report versions starting before an earlier one has ended."""
    orders = load(spark, sf_dir, "orders")
    versions = (orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderkey").alias("o_orderkey"))
                .select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from"),
                        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("valid_to")))
    from tidemark.operators.history import overlapping_versions
    return overlapping_versions(versions, "o_custkey")


def _bronze_customers(spark, sf_dir) -> DataFrame:
    """customer as bronze customer text rows."""
    c = load(spark, sf_dir, "customer")
    dob = F.date_add(F.lit(DOB_ORIGIN).cast("date"), ((F.col("c_custkey") * 17) % DOB_SPAN_DAYS).cast("int"))
    return c.select(F.col("c_custkey").cast("string").alias("customer_id"),
                    F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
                    F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
                    dob.cast("string").alias("dob"), F.lit("active").alias("status"),
                    F.lit("2024-01-01 00:00:00").alias("created_at"))


def _bronze_changes(spark, sf_dir) -> DataFrame:
    """events as bronze customer_changes text rows: errors block, clicks move the address."""
    e = load(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "click"))
    is_status = F.col("event_type") == "error"
    return e.select(F.col("event_id").cast("string").alias("change_id"),
                    F.col("user_id").cast("string").alias("customer_id"),
                    F.when(is_status, "status").otherwise("address").alias("change_type"),
                    F.when(is_status, "blocked").alias("status"),
                    F.when(~is_status, F.col("props")).alias("address_line"),
                    F.when(~is_status, F.col("user_id").cast("string")).alias("city"),
                    F.when(~is_status, F.lit("KZ")).alias("country"),
                    to_text("ts").alias("change_timestamp"))


def silver_customers_current(spark, sf_dir) -> DataFrame:
    """M6 (silver model): masked names, age bracket, status from the newest status change."""
    from tidemark.plans import silver
    out = silver.customers_current(_bronze_customers(spark, sf_dir), _bronze_changes(spark, sf_dir), AS_OF_DATE)
    return out.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def silver_addresses_current(spark, sf_dir) -> DataFrame:
    """M7 (silver model): base address overlaid by the newest address change, digits redacted."""
    from tidemark.plans import silver
    c = load(spark, sf_dir, "customer")
    addresses = c.select(F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("address_id"),
                         F.col("c_custkey").cast("string").alias("customer_id"),
                         F.col("c_name").alias("address_line"), F.col("c_nationkey").cast("string").alias("city"),
                         F.lit("KZ").alias("country"), F.lit("2024-01-01").alias("valid_from"),
                         F.lit(None).cast("string").alias("valid_to"))
    return silver.addresses_current(addresses, _bronze_changes(spark, sf_dir))


# --------------------------------------------------------------------------- loads
def _order_rollup(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("quantity"),
        F.max("l_shipdate").alias("last_ship"))


def _split(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    before = F.col("l_shipdate") < _ntz(SPLIT_SHIPDATE)
    return li.filter(before), li.filter(~before)


def upsert_orders(spark, sf_dir) -> DataFrame:
    """Per-order rollups; the later batch replaces stored keys, adds new ones."""
    base, batch = _split(spark, sf_dir)
    return upsert_latest(_order_rollup(base), _order_rollup(batch), "l_orderkey")


def insert_absent_orders(spark, sf_dir) -> DataFrame:
    """Per-order rollups; stored keys win, only new keys are added."""
    base, batch = _split(spark, sf_dir)
    return insert_absent(_order_rollup(base), _order_rollup(batch), "l_orderkey")


def replace_lines(spark, sf_dir) -> DataFrame:
    """delete+insert by order key; all batch lines of an order replace its stored lines."""
    base, batch = _split(spark, sf_dir)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]
    return replace_by_key(base.select(*cols), batch.select(*cols), "l_orderkey")


def merge_orders(spark, sf_dir) -> DataFrame:
    """S9 (+S12/A1): full-history rollups above the target's high-water mark are merged by key."""
    base, _ = _split(spark, sf_dir)
    source = _order_rollup(load(spark, sf_dir, "lineitem"))
    return merge_by_key(_order_rollup(base), source, "l_orderkey", column="last_ship")


def high_water_events(spark, sf_dir) -> DataFrame:
    """S12 (+A1): events strictly above the target's greatest timestamp."""
    events = load(spark, sf_dir, "events")
    target = events.filter(F.col("ts") < _ntz(EVENTS_FIRST_HALF_END))
    return after_high_water(events, target, "ts")


def append_events(spark, sf_dir) -> DataFrame:
    """Incremental append of the rows above the high-water mark."""
    events = load(spark, sf_dir, "events")
    target = events.filter(F.col("ts") < _ntz(EVENTS_FIRST_HALF_END))
    return append_new(target, events, "ts")


# --------------------------------------------------------------------------- lookups, keys, masks
def dim_orders(spark, sf_dir) -> DataFrame:
    """J1 + H7: orders with their customer's attributes (like accounts with products)."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customer = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    out = lookup_join(orders, customer, "o_custkey", "left")
    return out.select(surrogate_key("o_orderkey").alias("order_sk"), "o_orderkey", "o_custkey", "o_orderstatus",
                      "c_name", "c_mktsegment")


def dim_customer_nation(spark, sf_dir) -> DataFrame:
    """J2 + P2: customers with their nation name (like cards with BIN ranges)."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    nation = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation_name"))
    out = lookup_join(customer, nation, "n_nationkey", "left")
    return out.select(surrogate_key("c_custkey").alias("customer_sk"), "c_custkey", "c_name", "nation_name")


def dim_supplier(spark, sf_dir) -> DataFrame:
    """Suppliers with their nation name (like merchants with categories)."""
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    nation = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation_name"))
    out = lookup_join(supplier, nation, "n_nationkey", "left")
    return out.select(surrogate_key("s_suppkey").alias("supplier_sk"), "s_suppkey",
                      F.col("s_name").alias("supplier_name"), "nation_name")


def null_safe_key(spark, sf_dir) -> DataFrame:
    """H9: a key only where the source id is set (NULL and '' give NULL)."""
    events = load(spark, sf_dir, "events")
    merchant = (F.when(F.col("event_type") == "purchase", F.col("props"))
                .when(F.col("event_type") == "click", F.lit("")))
    return events.select("event_id", nullable_key(merchant).alias("merchant_sk"),
                         surrogate_key("user_id").alias("account_sk"))


def _customer_name(df: DataFrame) -> F.Column:
    return F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None)).otherwise(F.col("c_name"))


def mask_names(spark, sf_dir) -> DataFrame:
    """K1: first letter plus one mask character per remaining letter."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", mask_name(_customer_name(c)).alias("masked_name"))


def mask_phones(spark, sf_dir) -> DataFrame:
    """K2: all but the last four characters masked (phone = the customer key's digits)."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", mask_phone(F.col("c_custkey").cast("string")).alias("masked_phone"))


def mask_emails(spark, sf_dir) -> DataFrame:
    """K3: first character, mask, domain; an address without '@' keeps an empty domain."""
    c = load(spark, sf_dir, "customer")
    local = F.lower(F.regexp_replace("c_name", "#", "."))
    email = F.when(F.col("c_mktsegment") == "BUILDING", local).otherwise(
        F.concat(local, F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")))
    return c.select("c_custkey", mask_email(email).alias("masked_email"))


def redacted_documents(spark, sf_dir) -> DataFrame:
    """K4: every digit run of every whole document text replaced."""
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", redact_digits("text").alias("text"))


def age_brackets(spark, sf_dir) -> DataFrame:
    """K5 + X13: completed years (calendar form) and bracket as of a fixed date."""
    c = load(spark, sf_dir, "customer")
    dob = F.date_add(F.lit(DOB_ORIGIN).cast("date"), ((F.col("c_custkey") * 17) % DOB_SPAN_DAYS).cast("int"))
    dob = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(None).cast("date")).otherwise(dob)
    c = c.select("c_custkey", dob.alias("dob"))
    return c.select("c_custkey", "dob", completed_years("dob", AS_OF_DATE).alias("age"),
                    age_bracket("dob", AS_OF_DATE).alias("age_bracket"))


def typed_casts(spark, sf_dir) -> DataFrame:
    """Text <-> timestamp, text -> date, text -> decimal(12,2) (half-up)."""
    e = load(spark, sf_dir, "events")
    ts_text = to_text("ts")
    amount_text = F.concat(F.col("user_id").cast("string"), F.lit("."), F.col("event_id").cast("string"))
    return e.select("event_id", ts_text.alias("ts_text"),
                    ts_text.cast("timestamp_ntz").alias("ts_back"),
                    to_date(F.substring(ts_text, 1, 10)).alias("day"),
                    to_amount(amount_text).alias("amount"))


# --------------------------------------------------------------------------- quality
def quality_tables(spark, sf_dir) -> dict[str, DataFrame]:
    li = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    return {
        "lineitem": li,
        "orders": orders,
        "customer": load(spark, sf_dir, "customer"),
        "lineitem_orders": li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner"),
    }


QUALITY_CHECKS = [
    Q.not_null("lineitem", "l_orderkey"),
    Q.not_null("orders", "o_custkey"),
    Q.unique("lineitem", "l_orderkey", "l_linenumber"),
    Q.unique("orders", "o_orderkey"),
    Q.accepted_values("orders", "o_orderstatus", ["F", "O"]),
    Q.accepted_values("lineitem", "l_returnflag", ["A", "N", "R"]),
    Q.relationships("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Q.relationships("orders", "o_custkey", "customer", "c_custkey"),
    Q.rule("lineitem_orders", "ship_before_order", "l_shipdate < o_orderdate", ["l_shipdate", "o_orderdate"]),
    Q.max_length("customer", "c_name", 255),
]


def quality_report(spark, sf_dir) -> DataFrame:
    """Every check's failure count in one small table."""
    return Q.run_checks(quality_tables(spark, sf_dir), QUALITY_CHECKS)


def quality_report_one_by_one(spark, sf_dir) -> DataFrame:
    """D1-D8 with one job per check (the alternative the single pass is measured against)."""
    return Q.run_checks_one_by_one(quality_tables(spark, sf_dir), QUALITY_CHECKS)


def duplicate_line_keys(spark, sf_dir) -> DataFrame:
    """The (order, line number) keys a landing load would reject, with their counts."""
    from tidemark.operators.load import duplicate_keys
    li = load(spark, sf_dir, "lineitem")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def failing_ship_rows(spark, sf_dir) -> DataFrame:
    """D5-D7 style singular test: the rows it reports (lines shipped before their order date)."""
    check = next(c for c in QUALITY_CHECKS if c.label == "ship_before_order")
    rows = Q.failing_rows(quality_tables(spark, sf_dir), check)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_orderdate")


# --------------------------------------------------------------------------- generator re-aims
def eligible_lines(spark, sf_dir) -> DataFrame:
    """Open lines of open orders whose customer has a positive balance (two semi joins)."""
    customer = load(spark, sf_dir, "customer")
    orders = load(spark, sf_dir, "orders")
    li = load(spark, sf_dir, "lineitem")
    open_orders = eligible(orders, customer, "o_custkey", "c_custkey",
                           child_filter=F.col("o_orderstatus") == "O", parent_filter=F.col("c_acctbal") > 0)
    lines = eligible(li, open_orders, "l_orderkey", "o_orderkey", child_filter=F.col("l_linestatus") == "O")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def lines_per_order(spark, sf_dir) -> DataFrame:
    """A5: each line's ordinal within its order and the order's line count."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return number_within_key(li, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"])


def lines_per_order_sorted(spark, sf_dir) -> DataFrame:
    """A5 by the global-sort form (splits keys tied on the first order column); same result."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return number_within_key(li, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], method="sort")


def new_customer_ids(spark, sf_dir) -> DataFrame:
    """Customers with a negative balance get new ids after the current greatest key."""
    customer = load(spark, sf_dir, "customer")
    start = customer.select(F.max("c_custkey")).scalar()
    fresh = customer.filter(F.col("c_acctbal") < 0).select("c_custkey")
    return next_ids(fresh, start, ["c_custkey"])


# --------------------------------------------------------------------------- streaming
def stream_events(spark, sf_dir) -> DataFrame:
    """T1 + T2: events landed as daily CSV folders (plus a re-landed day) streamed into
    an event log with first-wins dedupe; returns the resulting bronze table."""
    from tidemark.sources.tables import read_table
    from tidemark.streaming.landing import stream_landing
    events = load(spark, sf_dir, "events")
    landing = scratch_path(spark, "landing-events")
    root = scratch_path(spark, "bronze-events")
    text = events.select(F.col("event_id").cast("string").alias("event_id"), to_text("ts").alias("ts"),
                         F.col("user_id").cast("string").alias("user_id"), "event_type", "props",
                         F.date_format("ts", "yyyy-MM-dd").alias("day"))
    # Daily folders (CSV, landing options) and one replayed day in a later folder.
    text.write.partitionBy("day").option("header", "true").option("escape", '"').csv(os.path.join(landing, "incoming"))
    first_day = text.select(F.min("day")).scalar()
    (text.filter(F.col("day") == first_day).drop("day").write.option("header", "true").option("escape", '"')
     .csv(os.path.join(landing, "incoming", "day=9999-12-31")))
    stream_landing(spark, EVENTS_LANDING, os.path.join(landing, "incoming", "day=*", "*.csv"), root,
                   run_ts=_dt.datetime(2024, 2, 1))
    return read_table(spark, root, "bronze", "events").select("event_id", "ts", "user_id", "event_type", "props")


# A customer-like entity landed daily: one row per user and day (the day's last event).
USERS_LANDING = Entity("users", "user_id", ("user_id", "status", "last_event"), UPSERT)


def stream_users(spark, sf_dir) -> DataFrame:
    """T1 with upserts: each day's user states landed as a daily folder and streamed
    into a current-state table where the latest day wins; returns that table."""
    from tidemark.sources.tables import read_table
    from tidemark.streaming.landing import stream_landing
    events = load(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    daily = latest_by_key(events, ["user_id", "day"], "ts", tiebreak=["event_id"])
    text = daily.select(F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("status"),
                        F.col("event_id").cast("string").alias("last_event"), "day")
    landing = scratch_path(spark, "landing-users")
    root = scratch_path(spark, "bronze-users")
    text.write.partitionBy("day").option("header", "true").option("escape", '"').csv(os.path.join(landing, "incoming"))
    stream_landing(spark, USERS_LANDING, os.path.join(landing, "incoming", "day=*", "*.csv"), root,
                   run_ts=_dt.datetime(2024, 2, 1))
    return read_table(spark, root, "bronze", "users").select("user_id", "status", "last_event")


def stream_first_events(spark, sf_dir) -> DataFrame:
    """T2 + T3: events arriving in four deliveries, each with rows of earlier ones; the log keeps the first of each."""
    from tidemark.sources.tables import read_table
    from tidemark.streaming.landing import stream_first
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    src, root = scratch_path(spark, "event-deliveries"), scratch_path(spark, "first-events")
    deliveries = [F.col("event_id") % 3 == 0, F.col("event_id") % 3 <= 1, F.col("event_id") % 2 == 0, F.lit(True)]
    for which in deliveries:        # a delivery is one micro-batch
        events.where(which).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(src)
    stream_first(stream, "event_id", "ts", root, "bronze", "events", os.path.join(root, "_checkpoint"))
    return read_table(spark, root, "bronze", "events").select("event_id", "ts", "user_id", "event_type")


def bucketed_upsert(spark, sf_dir) -> DataFrame:
    """S4 + S8 (+S9): the rollups of ``upsert_latest`` kept in a bucketed table; the batch rewrites the buckets it touches."""
    from tidemark.sources.tables import read_table, upsert_buckets
    base, batch = _split(spark, sf_dir)
    root = scratch_path(spark, "bucketed")
    for rows in (base, batch):
        upsert_buckets(_order_rollup(rows), root, "bronze", "rollups", "l_orderkey", buckets=16)
    return read_table(spark, root, "bronze", "rollups")


def indexed_insert(spark, sf_dir) -> DataFrame:
    """S5 + J11: the rollups of ``insert_absent`` kept in a log with a key index, which names the loads to probe."""
    from tidemark.operators.load import new_rows
    from tidemark.operators.sizing import fits
    from tidemark.sources.tables import append_log, loads_with_keys, read_loads, read_table
    base, batch = (materialize(_order_rollup(rows), "rollups") for rows in _split(spark, sf_dir))
    root = scratch_path(spark, "indexed")
    where = ("bronze", "rollups")
    for part in range(4):
        append_log(base.where(F.pmod("l_orderkey", F.lit(4)) == part), root, *where, f"2026070{part + 1}T000000", key="l_orderkey")
    small = fits(batch.select("l_orderkey"))
    loads = loads_with_keys(spark, root, *where, batch, "l_orderkey", broadcast_keys=small)
    fresh = new_rows(read_loads(spark, root, *where, loads), batch, "l_orderkey", check_unique=False, small_batch=small)
    append_log(fresh, root, *where, "20260705T000000", key="l_orderkey")
    return read_table(spark, root, *where).drop("load_id")


def sql_functions(spark, sf_dir) -> DataFrame:
    """K1-K5, H7-H9 as SQL functions over customers."""
    from tidemark.functions.sql import register
    register(spark)
    c = load(spark, sf_dir, "customer")
    dob = F.date_add(F.lit(DOB_ORIGIN).cast("date"), ((F.col("c_custkey") * 17) % DOB_SPAN_DAYS).cast("int"))
    rows = c.select("c_custkey", "c_name", F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@post.example")).alias("email"),
                    F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(None).cast("date")).otherwise(dob).alias("dob"),
                    F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment")).alias("segment"))
    return rows.sparkSession.sql(f"""
        SELECT c_custkey, mask_name(c_name) AS masked_name, mask_phone(CAST(c_custkey AS STRING)) AS masked_phone,
               mask_email(email) AS masked_email, redact_digits(c_name) AS redacted, completed_years(dob, DATE '{AS_OF_DATE}') AS age,
               age_bracket(dob, DATE '{AS_OF_DATE}') AS age_bracket, surrogate_key(CAST(c_custkey AS STRING)) AS sk,
               versioned_key(CAST(c_custkey AS STRING), TIMESTAMP '{RUN_1} 00:00:00') AS version_sk,
               nullable_key(segment) AS segment_sk, scd_id(CAST(c_custkey AS STRING), TIMESTAMP '{RUN_2} 00:00:00') AS scd
        FROM {{rows}}""", rows=rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "asof_fact": asof_fact,
    "asof_fact_join": asof_fact_join,
    "asof_fact_skewed": asof_fact_skewed,
    "asof_no_backdate": asof_no_backdate,
    "merge_timelines": merged_timeline,
    "merge_timelines_join": merged_timeline_join,
    "replay_snapshots": replayed_snapshots,
    "snapshot_two_runs": snapshot_two_runs,
    "latest_overlay": latest_overlay,
    "state_as_of": state_before_cutoff,
    "upsert_latest": upsert_orders,
    "insert_absent": insert_absent_orders,
    "replace_by_key": replace_lines,
    "merge_by_key": merge_orders,
    "high_water": high_water_events,
    "append_new": append_events,
    "dim_orders": dim_orders,
    "dim_customer_nation": dim_customer_nation,
    "dim_supplier": dim_supplier,
    "null_safe_key": null_safe_key,
    "mask_name": mask_names,
    "mask_phone": mask_phones,
    "mask_email": mask_emails,
    "redact_digits": redacted_documents,
    "age_bracket": age_brackets,
    "typed_casts": typed_casts,
    "quality_checks": quality_report,
    "duplicate_keys": duplicate_line_keys,
    "failing_rows": failing_ship_rows,
    "quality_checks_one_by_one": quality_report_one_by_one,
    "eligible": eligible_lines,
    "lines_per_order": lines_per_order,
    "lines_per_order_sort": lines_per_order_sorted,
    "next_ids": new_customer_ids,
    "stream_landing": stream_events,
    "stream_upsert": stream_users,
    "overlapping_versions": overlapping_order_versions,
    "silver_customers_current": silver_customers_current,
    "silver_addresses_current": silver_addresses_current,
    "gold_dim_customers": gold_dim_customers,
    "gold_fact_transactions": gold_fact_transactions,
    "stream_first": stream_first_events,
    "bucketed_upsert": bucketed_upsert,
    "indexed_insert": indexed_insert,
    "sql_functions": sql_functions,
}
