"""Silver layer: typed, masked and "current state" models over bronze tables.

Every model is a function of DataFrames (plus the clock it needs), so a run
can be repeated and compared.  Incremental models take the current silver table
as ``target`` (None on the first run) and return its next version.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (age_bracket, mask_email, mask_name, mask_phone, redact_digits, to_amount,
                                to_date, to_timestamp)
from tidemark.operators.incremental import after_high_water, merge_by_key
from tidemark.operators.latest import latest_by_key, overlay_latest

# Pass-through models and their columns (reference column order).
PASSTHROUGH = {
    "account_products": ["product_id", "product_name", "default_currency", "dwh_load_date"],
    "card_bin_ranges": ["bin", "product_name", "network", "dwh_load_date"],
    "currencies": ["currency_code", "currency_name", "symbol", "dwh_load_date"],
    "merchant_categories": ["category_id", "category_name", "dwh_load_date"],
    "merchants": ["merchant_id", "name", "category_id", "city", "dwh_load_date"],
    "transaction_types": ["transaction_type", "description", "dwh_load_date"],
}


def passthrough(name: str, bronze: DataFrame) -> DataFrame:
    """The listed columns as they are."""
    return bronze.select(*PASSTHROUGH[name])


def typed_accounts(bronze: DataFrame) -> DataFrame:
    return bronze.select("account_id", "customer_id", "product_id", "currency_code",
                         to_date("opened_date").alias("opened_date"), "status", "dwh_load_date")


def accounts(bronze: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M1: accounts loaded after the last run, merged by account_id."""
    return merge_by_key(target, typed_accounts(bronze), "account_id")


def typed_cards(bronze: DataFrame) -> DataFrame:
    return bronze.select("card_id", "account_id", "bin", to_date("issued_date").alias("issued_date"),
                         "status", "dwh_load_date")


def cards(bronze: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M2: cards loaded after the last run, merged by card_id."""
    return merge_by_key(target, typed_cards(bronze), "card_id")


def typed_transactions(bronze: DataFrame) -> DataFrame:
    return bronze.select("transaction_id", to_timestamp("transaction_timestamp").alias("transaction_timestamp"),
                         "account_id", "card_id", "merchant_id", "transaction_type", "currency_code",
                         to_amount("amount").alias("amount"), "status", "dwh_load_date")


def new_transactions(bronze: DataFrame, target: DataFrame | None = None, *, mark=None) -> DataFrame:
    """M3: transactions loaded after the last run (appended; keys are not re-checked)."""
    return typed_transactions(after_high_water(bronze, target, mark=mark))


def customer_changes(bronze: DataFrame) -> DataFrame:
    """M4: change events with a typed timestamp (address text is not masked here)."""
    return bronze.select("change_id", "customer_id", "change_type", "status", "address_line", "city", "country",
                         to_timestamp("change_timestamp").alias("change_timestamp"), "dwh_load_date")


def new_customer_changes(bronze: DataFrame, target: DataFrame | None = None, *, mark=None) -> DataFrame:
    """M4, stored as a log: the change events loaded after the last run, typed."""
    return customer_changes(after_high_water(bronze, target, mark=mark))


def customer_contacts(bronze: DataFrame) -> DataFrame:
    """M5: contacts with masked phone and email, typed validity dates."""
    return bronze.select("contact_id", "customer_id", mask_phone("phone").alias("phone"),
                         mask_email("email").alias("email"), to_date("valid_from").alias("valid_from"),
                         to_date("valid_to").alias("valid_to"), "dwh_load_date")


def latest_change(changes: DataFrame, change_type: str) -> DataFrame:
    """Newest change of a type per customer (ORDER BY change_timestamp DESC: NULL first; ties -> change_id).

    A maximum over a total order, so it can be maintained incrementally:
    ``latest_change(previous_latest.unionByName(new_changes), type)``.
    """
    chosen = changes.filter(F.col("change_type") == change_type)
    return latest_by_key(chosen, "customer_id", "change_timestamp", tiebreak=["change_id"])


_latest_change = latest_change


def customers_current(customers: DataFrame, changes: DataFrame | None, as_of: _dt.date | Column, *,
                      latest: DataFrame | None = None) -> DataFrame:
    """M6: masked names, age bracket as of ``as_of``, status overlaid by the newest status change
    (``latest``: the newest status change per customer, if already maintained)."""
    base = customers.select("customer_id", mask_name("first_name").alias("first_name"),
                            mask_name("last_name").alias("last_name"),
                            age_bracket(to_date("dob"), as_of).alias("age_bracket"), "status",
                            to_timestamp("created_at").alias("created_at"))
    latest = latest if latest is not None else _latest_change(changes, "status")
    latest = latest.select("customer_id", F.col("status").alias("latest_status"))
    return overlay_latest(base, latest, "customer_id", {"status": "latest_status"})


def addresses_current(addresses: DataFrame, changes: DataFrame | None, *,
                      latest: DataFrame | None = None) -> DataFrame:
    """M7: base address overlaid by the newest address change, digits redacted.

    Grain is one row per *address* (a customer with two addresses gets two rows,
    which the address snapshot's key check rejects, as in the reference).
    """
    base = addresses.select("address_id", "customer_id", "address_line", "city", "country",
                            to_date("valid_from").alias("created_at"))
    latest = latest if latest is not None else _latest_change(changes, "address")
    latest = latest.select(
        "customer_id", F.col("address_line").alias("new_line"), F.col("city").alias("new_city"),
        F.col("country").alias("new_country"))
    merged = overlay_latest(base, latest, "customer_id",
                            {"address_line": "new_line", "city": "new_city", "country": "new_country"})
    return merged.select("customer_id", redact_digits("address_line").alias("address_line"), "city", "country",
                         "created_at")
