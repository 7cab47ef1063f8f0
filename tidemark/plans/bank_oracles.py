"""SQL for the bank queries (:mod:`tidemark.plans.bank`): the same landed rows, another route.

A load is one window over all landed rows of an entity; snapshots are a comparison of the
two days' states; checks are one count each.
"""

from __future__ import annotations

from tidemark.operators.quality import Check
from tidemark.plans.bank import AS_OF, LANDING, RUNS, SEED_RUN
from tidemark.plans.checks import SILVER_CHECKS
from tidemark.plans.silver import PASSTHROUGH
from tidemark.schemas import ENTITIES, INSERT_ABSENT

_STAMPS = [str(t) for t in (SEED_RUN, *RUNS)]


def _landed(entity: str, last: int = 2) -> str:
    """The bronze table of an entity after load ``last``."""
    ent = ENTITIES[entity]
    rows = " UNION ALL ".join(f"SELECT *, {i} AS ord, '{_STAMPS[i]}' AS dwh_load_date FROM ({sql}) AS f{i}"
                              for i, sql in enumerate(LANDING[entity]) if sql is not None and i <= last)
    order = "ASC" if ent.mode == INSERT_ABSENT else "DESC"
    return (f"SELECT {', '.join(ent.columns)}, dwh_load_date FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {ent.key} ORDER BY ord {order}) AS place FROM ({rows}) AS landed) AS ranked WHERE place = 1")


_TYPED = {
    "accounts": "account_id, customer_id, product_id, currency_code, CAST(opened_date AS DATE) AS opened_date, status, dwh_load_date",
    "cards": "card_id, account_id, bin, CAST(issued_date AS DATE) AS issued_date, status, dwh_load_date",
    "transactions": "transaction_id, transaction_timestamp, account_id, card_id, merchant_id, transaction_type, currency_code, "
                    "CAST(amount AS DECIMAL(12, 2)) AS amount, status, dwh_load_date",
    "customer_changes": "change_id, customer_id, change_type, status, address_line, city, country, change_timestamp, dwh_load_date",
    "customer_contacts": "contact_id, customer_id, repeat('*', greatest(length(phone) - 4, 0)) || right(phone, 4) AS phone, "
                         "left(email, 1) || '***@' || split_part(email, '@', 2) AS email, CAST(valid_from AS DATE) AS valid_from, "
                         "CAST(valid_to AS DATE) AS valid_to, dwh_load_date",
} | {name: ", ".join(columns) for name, columns in PASSTHROUGH.items()}


def _model(name: str) -> str:
    return f"SELECT {_TYPED[name]} FROM ({_landed(name)}) AS b"


def _newest(kind: str, last: int) -> str:
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY change_timestamp DESC, change_id DESC) AS r "
            f"FROM ({_landed('customer_changes', last)}) AS c WHERE change_type = '{kind}') AS q WHERE r = 1")


def _mask(c: str) -> str:
    return f"left({c}, 1) || repeat('*', greatest(length({c}) - 1, 0))"


def _customers_current(last: int) -> str:
    as_of = f"DATE '{AS_OF[last - 1]}'"
    return f"""SELECT customer_id, first_name, last_name,
  CASE WHEN years < 25 THEN '18-24' WHEN years < 35 THEN '25-34' WHEN years < 45 THEN '35-44' WHEN years < 55 THEN '45-54'
       WHEN years < 65 THEN '55-64' ELSE '65+' END AS age_bracket, status, created_at
FROM (SELECT b.customer_id, {_mask('first_name')} AS first_name, {_mask('last_name')} AS last_name,
             date_part('year', age({as_of}, CAST(dob AS DATE))) AS years, coalesce(n.status, b.status) AS status, created_at
      FROM ({_landed('customers', last)}) AS b LEFT JOIN ({_newest('status', last)}) AS n ON n.customer_id = b.customer_id) AS m"""


def _addresses_current(last: int) -> str:
    return f"""SELECT b.customer_id, regexp_replace(coalesce(n.address_line, b.address_line), '[0-9]+', '###', 'g') AS address_line,
  coalesce(n.city, b.city) AS city, coalesce(n.country, b.country) AS country, CAST(b.valid_from AS DATE) AS created_at
FROM ({_landed('customer_addresses', last)}) AS b LEFT JOIN ({_newest('address', last)}) AS n ON n.customer_id = b.customer_id"""


def _snapshot(state, columns: list[str], check: list[str]) -> str:
    first, second = _STAMPS[1], _STAMPS[2]
    own = lambda s: ", ".join(f"{s}.{c}" for c in columns)
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM s.{c}" for c in check)
    version = lambda s, run, end: (f"SELECT {own(s)}, md5({s}.customer_id || '|{run}') AS scd_id, '{run}' AS updated_at, "  # noqa: E731
                                   f"'{run}' AS valid_from, {end} AS valid_to")
    return f"""WITH o AS ({state(1)}), s AS ({state(2)})
{version('o', first, f"CASE WHEN s.customer_id IS NOT NULL AND ({differs}) THEN '{second}' END")} FROM o LEFT JOIN s ON s.customer_id = o.customer_id
UNION ALL
{version('s', second, 'CAST(NULL AS STRING)')} FROM s LEFT JOIN o ON o.customer_id = s.customer_id
WHERE o.customer_id IS NULL OR ({differs})"""


_CUSTOMERS_SNAPSHOT = _snapshot(_customers_current, ["customer_id", "first_name", "last_name", "age_bracket", "status", "created_at"], ["status"])
_ADDRESSES_SNAPSHOT = _snapshot(_addresses_current, ["customer_id", "address_line", "city", "country", "created_at"],
                                ["address_line", "city", "country"])

_DIMENSIONS = {
    "gold_dim_accounts": f"""SELECT md5(a.account_id) AS account_sk, a.account_id, a.customer_id, a.currency_code, a.opened_date, a.status,
  p.product_name, p.default_currency, a.dwh_load_date
FROM ({_model('accounts')}) AS a LEFT JOIN ({_model('account_products')}) AS p ON p.product_id = a.product_id""",
    "gold_dim_cards": f"""SELECT md5(c.card_id) AS card_sk, c.card_id, c.account_id, c.issued_date, c.status,
  b.product_name AS card_product_name, b.network, c.dwh_load_date
FROM ({_model('cards')}) AS c LEFT JOIN ({_model('card_bin_ranges')}) AS b ON b.bin = c.bin""",
    "gold_dim_merchants": f"""SELECT md5(m.merchant_id) AS merchant_sk, m.merchant_id, m.name AS merchant_name, m.city, k.category_name,
  m.dwh_load_date
FROM ({_model('merchants')}) AS m LEFT JOIN ({_model('merchant_categories')}) AS k ON k.category_id = m.category_id""",
}


def _count(check: Check) -> str:
    """How many rows (or keys) fail a check."""
    column = check.columns[0] if check.columns else ""
    rows = f"SELECT count(*) FROM {check.table} WHERE "
    if check.kind == "not_null":
        return rows + f"{column} IS NULL"
    if check.kind == "accepted_values":
        return rows + f"{column} NOT IN ({', '.join(repr(v) for v in check.values)})"
    if check.kind == "rule":
        return rows + f"({check.condition})"
    if check.kind == "unique":
        return (f"SELECT count(*) FROM (SELECT {column} FROM {check.table} WHERE {column} IS NOT NULL "
                f"GROUP BY {column} HAVING count(*) > 1) AS twice")
    return rows + (f"{column} IS NOT NULL AND {column} NOT IN (SELECT {check.to_column} FROM {check.to_table} "
                   f"WHERE {check.to_column} IS NOT NULL)")


_TABLES = {name: _model(name) for name in _TYPED} | {"customers_snapshot": _CUSTOMERS_SNAPSHOT, "addresses_snapshot": _ADDRESSES_SNAPSHOT}
_CHECKS = ("WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in _TABLES.items()) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c.table}' AS \"table\", '{c.column}' AS \"column\", '{c.label}' AS \"check\", CAST(({_count(c)}) AS BIGINT) AS failures"
    for c in SILVER_CHECKS))

ORACLES: dict[str, str] = ({f"bronze_{entity}": _landed(entity) for entity in LANDING}
                           | {f"model_{name}": _model(name) for name in _TYPED}
                           | {"snapshot_customers": _CUSTOMERS_SNAPSHOT, "snapshot_addresses": _ADDRESSES_SNAPSHOT}
                           | _DIMENSIONS | {"warehouse_checks": _CHECKS})
