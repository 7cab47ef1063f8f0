"""The 13 landing entities: all-string columns, the conflict key and the load rule.

Landing files are read with these schemas verbatim (never inferred).  Every
business column is text on landing; typing happens in the silver layer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

UPSERT = "upsert"          # latest wins: the batch row replaces the stored row
INSERT_ABSENT = "insert"   # first wins: a stored key is never touched again


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    columns: tuple[str, ...]
    mode: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType(self.schema.fields + [T.StructField("dwh_load_date", T.TimestampType(), True)])


# Entity names, key columns and column order of the landing files.
ENTITIES: dict[str, Entity] = {e.name: e for e in [
    Entity("account_products", "product_id", ("product_id", "product_name", "default_currency"), UPSERT),
    Entity("accounts", "account_id", ("account_id", "customer_id", "product_id", "currency_code", "opened_date", "status"), UPSERT),
    Entity("card_bin_ranges", "bin", ("bin", "product_name", "network"), UPSERT),
    Entity("cards", "card_id", ("card_id", "account_id", "bin", "issued_date", "status"), UPSERT),
    Entity("currencies", "currency_code", ("currency_code", "currency_name", "symbol"), UPSERT),
    Entity("customer_addresses", "address_id", ("address_id", "customer_id", "address_line", "city", "country", "valid_from", "valid_to"), UPSERT),
    Entity("customer_contacts", "contact_id", ("contact_id", "customer_id", "phone", "email", "valid_from", "valid_to"), UPSERT),
    Entity("customers", "customer_id", ("customer_id", "first_name", "last_name", "dob", "status", "created_at"), UPSERT),
    Entity("merchant_categories", "category_id", ("category_id", "category_name"), UPSERT),
    Entity("merchants", "merchant_id", ("merchant_id", "name", "category_id", "city"), UPSERT),
    Entity("transaction_types", "transaction_type", ("transaction_type", "description"), UPSERT),
    Entity("transactions", "transaction_id", ("transaction_id", "transaction_timestamp", "account_id", "card_id", "merchant_id", "transaction_type", "currency_code", "amount", "status"), INSERT_ABSENT),
    Entity("customer_changes", "change_id", ("change_id", "customer_id", "change_type", "status", "address_line", "city", "country", "change_timestamp"), INSERT_ABSENT),
]}

# Daily landing file prefix -> entity (files are <prefix>_<date>.csv).
DAILY_FILES: dict[str, str] = {
    "new_customers": "customers",
    "new_accounts": "accounts",
    "new_cards": "cards",
    "transactions": "transactions",
    "customer_changes": "customer_changes",
}

# Longest text a landing column may hold (VARCHAR(255) on landing).
MAX_TEXT_LENGTH = 255


def entity(name: "str | Entity") -> Entity:
    """Look up a landing entity by name (an :class:`Entity` is returned as is)."""
    if isinstance(name, Entity):
        return name
    try:
        return ENTITIES[name]
    except KeyError:
        raise KeyError(f"unknown entity {name!r}; known: {sorted(ENTITIES)}") from None
