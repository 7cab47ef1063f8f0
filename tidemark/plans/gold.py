"""Gold layer: star-schema dimensions and the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nullable_key, surrogate_key, versioned_key
from tidemark.operators.history import lookup_version, merge_timelines
from tidemark.operators.incremental import after_high_water, replace_by_key
from tidemark.operators.sizing import lookup_join

CUSTOMER_ATTRS = ["first_name", "last_name", "age_bracket", "status"]
ADDRESS_ATTRS = ["address_line", "city", "country"]


def dim_accounts(accounts: DataFrame, products: DataFrame) -> DataFrame:
    """G1: accounts with their product."""
    p = products.select("product_id", "product_name", "default_currency")
    return lookup_join(accounts, p, "product_id", "left").select(
        surrogate_key("account_id").alias("account_sk"), "account_id", "customer_id", "currency_code",
        "opened_date", "status", "product_name", "default_currency", "dwh_load_date")


def dim_cards(cards: DataFrame, bins: DataFrame) -> DataFrame:
    """Cards with their BIN range."""
    b = bins.select("bin", F.col("product_name").alias("card_product_name"), "network")
    return lookup_join(cards, b, "bin", "left").select(
        surrogate_key("card_id").alias("card_sk"), "card_id", "account_id", "issued_date", "status",
        "card_product_name", "network", "dwh_load_date")


def dim_merchants(merchants: DataFrame, categories: DataFrame) -> DataFrame:
    """Merchants with their category name."""
    c = categories.select("category_id", "category_name")
    return lookup_join(merchants, c, "category_id", "left").select(
        surrogate_key("merchant_id").alias("merchant_sk"), "merchant_id", F.col("name").alias("merchant_name"),
        "city", "category_name", "dwh_load_date")


def dim_customers(customers_snapshot: DataFrame, addresses_snapshot: DataFrame, contacts: DataFrame, *,
                  customer_attrs: list[str] = CUSTOMER_ATTRS, address_attrs: list[str] = ADDRESS_ATTRS,
                  **seg_opts) -> DataFrame:
    """One row per customer and change point of either history (H2), keyed by
    md5(customer_id || valid_from text) (H8), with contact data attached (J9) and ``is_current``."""
    merged = merge_timelines([(customers_snapshot, customer_attrs), (addresses_snapshot, address_attrs)],
                             "customer_id", **seg_opts)
    ct = contacts.select("customer_id", "phone", "email")
    joined = merged.join(ct, "customer_id", "left")
    return joined.select(versioned_key("customer_id", "valid_from").alias("customer_sk"), "customer_id",
                         *customer_attrs, *address_attrs, "phone", "email", "valid_from", "valid_to",
                         F.col("valid_to").isNull().alias("is_current"))


def changed_customers(previous: DataFrame, customers_snapshot: DataFrame, addresses_snapshot: DataFrame,
                      contacts: DataFrame, merged_at) -> DataFrame:
    """Customers whose dimension rows can differ from ``previous``, merged at the snapshot clock ``merged_at``.

    Those with a snapshot version opened or closed at that clock (a run may have
    been repeated under it) or later, and those
    whose contacts changed: per (customer, phone, email) the current rows of
    ``previous`` are counted against the contact rows (one current row per
    contact; a customer without contacts counts as one NULL contact).
    """
    mark = merged_at if isinstance(merged_at, F.Column) else F.lit(merged_at)
    touched = None
    for snap in (customers_snapshot, addresses_snapshot):
        k = snap.filter((F.col("valid_from") >= mark) | (F.col("valid_to") >= mark)).select("customer_id")
        touched = k if touched is None else touched.unionByName(k)
    current = previous.filter(F.col("is_current")).select("customer_id", "phone", "email")
    seen = current.groupBy("customer_id", "phone", "email").agg(F.count(F.lit(1)).alias("_seen"))
    now = (current.select("customer_id").distinct()
           .join(contacts.select("customer_id", "phone", "email"), "customer_id", "left")
           .groupBy("customer_id", "phone", "email").agg(F.count(F.lit(1)).alias("_now")))
    s, n = seen.alias("s"), now.alias("n")
    same_contact = ((F.col("s.customer_id") == F.col("n.customer_id")) & F.col("s.phone").eqNullSafe(F.col("n.phone"))
                    & F.col("s.email").eqNullSafe(F.col("n.email")))
    differs = (s.join(n, same_contact, "full")
               .filter(~F.coalesce(F.col("_seen") == F.col("_now"), F.lit(False)))
               .select(F.coalesce(F.col("s.customer_id"), F.col("n.customer_id")).alias("customer_id")))
    return touched.unionByName(differs).distinct()


def dim_customers_incremental(previous: DataFrame | None, customers_snapshot: DataFrame,
                              addresses_snapshot: DataFrame, contacts: DataFrame, merged_at, *,
                              customer_attrs: list[str] = CUSTOMER_ATTRS,
                              address_attrs: list[str] = ADDRESS_ATTRS) -> DataFrame:
    """G4 maintained across runs: rows of unchanged customers are kept as they are, the
    changed customers (:func:`changed_customers`) are merged again.  Equal to
    :func:`dim_customers` over the whole snapshots (the merge of one customer
    depends on that customer's versions and contacts only)."""
    if previous is None:
        return dim_customers(customers_snapshot, addresses_snapshot, contacts,
                             customer_attrs=customer_attrs, address_attrs=address_attrs)
    changed = changed_customers(previous, customers_snapshot, addresses_snapshot, contacts, merged_at)
    redo = dim_customers(customers_snapshot.join(changed, "customer_id", "left_semi"),
                         addresses_snapshot.join(changed, "customer_id", "left_semi"),
                         contacts.join(changed, "customer_id", "left_semi"),
                         customer_attrs=customer_attrs, address_attrs=address_attrs)
    kept = previous.join(changed, "customer_id", "left_anti").select(*previous.columns)
    return kept.unionByName(redo.select(*previous.columns))


def fact_rows(transactions: DataFrame, types: DataFrame, currencies: DataFrame, accounts_dim: DataFrame,
              customers_dim: DataFrame, target: DataFrame | None = None, *, method: str = "scan",
              mark=None) -> DataFrame:
    """G5 delta: transactions above the fact's high-water mark resolved to surrogate keys.

    Card and merchant keys are computed (md5, NULL for a missing id), not looked
    up; the customer key is the customer version in force at the transaction
    (first version back-dated), through the account's owner.
    """
    t = after_high_water(transactions, target, mark=mark)
    ty = types.select("transaction_type", F.col("description").alias("transaction_type_description"))
    cur = currencies.select("currency_code", "currency_name")
    acc = accounts_dim.select("account_id", "customer_id")
    facts = t.select("account_id", "transaction_id", "transaction_timestamp", "card_id", "merchant_id", "transaction_type",
                     "currency_code", "amount", "status", "dwh_load_date").join(acc, "account_id", "left")
    versions = customers_dim.select("customer_id", "customer_sk", "valid_from", "valid_to")
    owners = lambda fraction: t.select("account_id").sample(False, fraction, seed=17).join(acc, "account_id")
    resolved = lookup_version(facts, versions, "customer_id", "transaction_timestamp", columns=["customer_sk"],
                              backdate_first=True, method=method, **({"sample_facts": owners} if method == "scan" else {}))
    # Texts of the lookup tables come last: no shuffle carries them.
    resolved = lookup_join(lookup_join(resolved, ty, "transaction_type"), cur, "currency_code")
    return resolved.select(
        "transaction_id", "transaction_timestamp", surrogate_key("account_id").alias("account_sk"),
        nullable_key("card_id").alias("card_sk"), nullable_key("merchant_id").alias("merchant_sk"),
        "customer_sk", "transaction_type", "transaction_type_description", "currency_code", "currency_name",
        "amount", "status", "dwh_load_date")


def fact_transactions(transactions: DataFrame, types: DataFrame, currencies: DataFrame, accounts_dim: DataFrame,
                      customers_dim: DataFrame, target: DataFrame | None = None, *,
                      method: str = "scan") -> DataFrame:
    """The fact after delete+insert of the delta by transaction_id."""
    rows = fact_rows(transactions, types, currencies, accounts_dim, customers_dim, target, method=method)
    return replace_by_key(target, rows, "transaction_id")
