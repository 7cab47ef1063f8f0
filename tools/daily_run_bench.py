"""Time bootstrap + one daily run of the bank warehouse on landing files built from driver tables.

Usage: python tools/daily_run_bench.py [sf_dir]
The landing area (a fresh folder under the session's checkpoint folder) is stand-in
input only: customer -> customers/addresses/contacts, orders -> accounts and cards,
supplier -> merchants, lineitem -> one day's transactions, events -> customer
changes.  The job itself (loads, silver, snapshots, checks, gold) runs unchanged.
Prints one JSON line with the seconds per phase of day one, the whole second
day, and the row counts of gold.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans import jobs  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402

DAY = "2026-07-13"
DAY2 = "2026-07-14"
TYPES = ["purchase", "transfer_out", "transfer_in", "withdrawal", "deposit", "fee"]


def write_csv(df, folder: str, name: str) -> None:
    """One CSV file ``<folder>/<name>.csv`` in the landing format."""
    tmp = os.path.join(folder, f"_{name}")
    df.coalesce(1).write.option("header", "true").option("escape", '"').csv(tmp)
    part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
    os.replace(os.path.join(tmp, part), os.path.join(folder, f"{name}.csv"))


def s(c):
    return F.col(c).cast("string")


def write_day(spark, sf_dir: str, incoming: str, day: str, tag: str) -> None:
    """One day's landing folder: every line item as a transaction, clicks/errors as changes."""
    load = lambda t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
    li, ev = load("lineitem"), load("events")
    day_dir = os.path.join(incoming, day)
    os.makedirs(day_dir)
    tx_type = F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col("l_linenumber") % 6 + 1).cast("int"))
    purchase = tx_type == "purchase"
    ts = F.concat(F.lit(day + " "), F.lpad(s("l_linenumber"), 2, "0"), F.lit(":"),
                  F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0"), F.lit(":00"))
    tx = li.withColumn("_i", F.monotonically_increasing_id()).select(
        F.concat(F.lit(f"TX{tag}"), s("_i")).alias("transaction_id"), ts.alias("transaction_timestamp"),
        F.concat(F.lit("AC"), s("l_orderkey")).alias("account_id"),
        F.when(purchase, F.concat(F.lit("CD"), s("l_orderkey"))).alias("card_id"),
        F.when(purchase, F.concat(F.lit("M"), s("l_suppkey"))).alias("merchant_id"),
        tx_type.alias("transaction_type"), F.lit("GBP").alias("currency_code"),
        F.regexp_replace(F.format_number("l_extendedprice", 2), ",", "").alias("amount"),
        F.lit("approved").alias("status"))
    write_csv(tx, day_dir, f"transactions_{day}")
    ch = ev.filter(F.col("event_type").isin("error", "click"))
    status_change = F.col("event_type") == "error"
    write_csv(ch.select(F.concat(F.lit(f"CH{tag}"), s("event_id")).alias("change_id"),
                        F.concat(F.lit("C"), F.lpad(s("user_id"), 7, "0")).alias("customer_id"),
                        F.when(status_change, "status").otherwise("address").alias("change_type"),
                        F.when(status_change, "blocked").alias("status"),
                        F.when(~status_change, F.concat(s("user_id"), F.lit(f" New Street {tag}"))).alias("address_line"),
                        F.when(~status_change, F.lit("York")).alias("city"),
                        F.when(~status_change, F.lit("England")).alias("country"),
                        F.concat(F.lit(day + " "), F.date_format("ts", "HH:mm:ss")).alias("change_timestamp")),
              day_dir, f"customer_changes_{day}")
    for prefix, cols in [("new_customers", "customer_id string, first_name string, last_name string, dob string, "
                                           "status string, created_at string"),
                         ("new_accounts", "account_id string, customer_id string, product_id string, "
                                          "currency_code string, opened_date string, status string"),
                         ("new_cards", "card_id string, account_id string, bin string, issued_date string, status string")]:
        write_csv(spark.createDataFrame([], cols), day_dir, f"{prefix}_{day}")


def build_landing(spark, sf_dir: str, root: str) -> tuple[str, str]:
    load = lambda t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
    seed, incoming = os.path.join(root, "seed"), os.path.join(root, "incoming")
    os.makedirs(seed)
    cust, orders, supp = (load(t) for t in ["customer", "orders", "supplier"])
    cid = F.concat(F.lit("C"), F.lpad(s("c_custkey"), 7, "0"))
    write_csv(cust.select(cid.alias("customer_id"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
                          F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
                          F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 18000).cast("int"))
                          .cast("string").alias("dob"),
                          F.lit("active").alias("status"), F.lit("2025-05-01 00:00:00").alias("created_at")),
              seed, "customers")
    write_csv(cust.select(F.concat(F.lit("A"), s("c_custkey")).alias("address_id"), cid.alias("customer_id"),
                          F.concat(s("c_nationkey"), F.lit(" Mill Lane")).alias("address_line"),
                          F.concat(F.lit("city"), s("c_nationkey")).alias("city"), F.lit("England").alias("country"),
                          F.lit("2025-05-01").alias("valid_from"), F.lit(None).cast("string").alias("valid_to")),
              seed, "customer_addresses")
    write_csv(cust.select(F.concat(F.lit("CT"), s("c_custkey")).alias("contact_id"), cid.alias("customer_id"),
                          F.concat(F.lit("4411"), F.lpad(s("c_custkey"), 7, "0")).alias("phone"),
                          F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@post.example")).alias("email"),
                          F.lit("2025-05-01").alias("valid_from"), F.lit(None).cast("string").alias("valid_to")),
              seed, "customer_contacts")
    acc = F.concat(F.lit("AC"), s("o_orderkey"))
    write_csv(orders.select(acc.alias("account_id"), F.concat(F.lit("C"), F.lpad(s("o_custkey"), 7, "0")).alias("customer_id"),
                            F.lit("everyday").alias("product_id"), F.lit("GBP").alias("currency_code"),
                            F.to_date("o_orderdate").cast("string").alias("opened_date"), F.lit("active").alias("status")),
              seed, "accounts")
    write_csv(orders.select(F.concat(F.lit("CD"), s("o_orderkey")).alias("card_id"), acc.alias("account_id"),
                            F.lit("990011").alias("bin"), F.to_date("o_orderdate").cast("string").alias("issued_date"),
                            F.lit("active").alias("status")), seed, "cards")
    write_csv(supp.select(F.concat(F.lit("M"), s("s_suppkey")).alias("merchant_id"), F.col("s_name").alias("name"),
                          F.concat(F.lit("MC"), s("s_nationkey")).alias("category_id"), F.lit("Leeds").alias("city")),
              seed, "merchants")
    mk = lambda rows, schema: spark.createDataFrame(rows, schema)
    write_csv(mk([("GBP", "Pound", "£")], "currency_code string, currency_name string, symbol string"), seed, "currencies")
    write_csv(mk([(f"MC{i}", f"Category {i}") for i in range(25)], "category_id string, category_name string"),
              seed, "merchant_categories")
    write_csv(mk([(t, t.replace("_", " ")) for t in TYPES], "transaction_type string, description string"),
              seed, "transaction_types")
    write_csv(mk([("everyday", "Everyday", "GBP")], "product_id string, product_name string, default_currency string"),
              seed, "account_products")
    write_csv(mk([("990011", "Blue card", "ORCA")], "bin string, product_name string, network string"),
              seed, "card_bin_ranges")
    write_day(spark, sf_dir, incoming, DAY, "A")
    write_day(spark, sf_dir, incoming, DAY2, "B")
    return seed, incoming


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    area = scratch_path(spark, "bank-landing")
    seed, incoming = build_landing(spark, sf_dir, area)
    root = os.path.join(area, "warehouse")
    t = {}
    t0 = time.perf_counter()
    jobs.bootstrap(spark, seed, root, dt.datetime(2026, 7, 12, 23))
    t["bootstrap"] = time.perf_counter() - t0
    run_ts = dt.datetime(2026, 7, 14, 0, 30)
    steps = [("load_day", lambda: jobs.load_day(spark, DAY, incoming, root, run_ts)),
             ("build_silver", lambda: jobs.build_silver(spark, root, dt.date(2026, 7, 13), run_ts)),
             ("take_snapshots", lambda: jobs.take_snapshots(spark, root, run_ts)),
             ("silver_checks", lambda: jobs.check_layer(jobs.silver_tables(spark, root), jobs.SILVER_CHECKS)),
             ("build_gold", lambda: jobs.build_gold(spark, root, run_ts)),
             ("gold_checks", lambda: jobs.check_layer(jobs.gold_tables(spark, root), jobs.GOLD_CHECKS))]
    for name, step in steps:
        t0 = time.perf_counter()
        step()
        t[name] = time.perf_counter() - t0
    # Day two: the incremental steps read only the new log partitions.
    t0 = time.perf_counter()
    failed = jobs.run_day(spark, DAY2, incoming, root, dt.datetime(2026, 7, 15, 0, 30), as_of=dt.date(2026, 7, 14))
    t["day2_run_day"] = time.perf_counter() - t0
    assert failed == {"silver": [], "gold": []}, failed
    gold = jobs.gold_tables(spark, root)
    print(json.dumps({"sf": os.path.basename(sf_dir), "seconds": {k: round(v, 2) for k, v in t.items()},
                      "total": round(sum(t.values()), 2),
                      "rows": {k: v.count() for k, v in gold.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
