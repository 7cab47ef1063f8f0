"""Landing files of a tiny bank, written by hand: a seed and three days, a case per row.

Column names, file names and accepted values are the fixed ones of ``tidemark.schemas``
and ``tidemark.plans.checks``; everything else is made up for these tests.
"""

from __future__ import annotations

import csv
import os

from tidemark.plans.checks import TRANSACTION_TYPES
from tidemark.schemas import DAILY_FILES, ENTITIES

SEED = {
    "currencies": [("GBP", "Pound", "£"), ("NOK", "Krone", "kr")],
    "account_products": [("everyday", "Everyday", "GBP"), ("nest", "Nest egg, fixed", "GBP"),
                         ("purse", "Krone purse", "NOK")],
    "card_bin_ranges": [("990011", "Blue card", "ORCA"), ("990022", 'Green "eco" card', "HERON")],
    "merchant_categories": [("books", "Books"), ("bikes", "Bicycles")],
    "merchants": [("shop-1", "Paper Moon", "books", "Leeds"), ("shop-2", "Two Wheels", "bikes", "Bergen")],
    "transaction_types": [(t, f"kind: {t}") for t in TRANSACTION_TYPES],
    "customers": [("cu-1", "Ida", "Holt", "1961-03-09", "active", "2025-05-01 08:00:00"),
                  ("cu-2", "Øyvind", "Berg", "1987-11-30", "active", "2025-05-02 08:00:00"),
                  ("cu-3", "Mei", "O'Hara", "2004-02-29", "active", "2025-06-01 08:00:00")],
    "customer_addresses": [("ad-1", "cu-1", "1 Mill Lane", "Leeds", "England", "2025-05-01", None),
                           ("ad-2", "cu-2", "2 Havn, floor 3", "Bergen", "Norway", "2025-05-02", None),
                           ("ad-3", "cu-3", "3 Kirk Road", "Leeds", "England", "2025-06-01", None)],
    "customer_contacts": [("ct-1", "cu-1", "441130001111", "ida@post.example", "2025-05-01", None),
                          ("ct-2", "cu-2", "475500002222", "berg@post.example", "2025-05-02", None),
                          ("ct-3", "cu-3", "441130003333", "mei@post.example", "2025-06-01", None)],
    "accounts": [("ac-1", "cu-1", "everyday", "GBP", "2025-05-01", "active"),
                 ("ac-2", "cu-2", "purse", "NOK", "2025-05-02", "active"),
                 ("ac-3", "cu-2", "nest", "GBP", "2025-05-03", "dormant"),
                 ("ac-4", "cu-3", "everyday", "GBP", "2025-06-01", "active")],
    "cards": [("cd-1", "ac-1", "990011", "2025-05-01", "active"),
              ("cd-2", "ac-2", "990022", "2025-05-02", "active")],
}

# Per day: transactions, changes, and the day's new customers, accounts and cards.
DAYS = {
    "2026-07-13": {
        "transactions": [
            ("t-1", "2026-07-13 07:05:00", "ac-1", "cd-1", "shop-1", "purchase", "GBP", "12.50", "approved"),
            ("t-2", "2026-07-13 09:00:00", "ac-2", None, None, "deposit", "NOK", "400.005", "approved"),
            ("t-3", "2026-07-13 23:59:59", "ac-4", None, None, "fee", "GBP", "1.00", "declined")],
        "customer_changes": [
            ("ch-1", "cu-1", "status", "blocked", None, None, None, "2026-07-13 10:00:00"),
            ("ch-2", "cu-2", "address", None, "8 Kai, left", "Oslo", "Norway", "2026-07-13 11:15:00")],
        "customers": [("cu-4", "Ana", "Reis", "1990-05-05", "active", "2026-07-13 09:00:00")],
        "accounts": [("ac-5", "cu-4", "everyday", "GBP", "2026-07-13", "active")],
        "cards": [],
    },
    "2026-07-14": {
        "transactions": [
            ("t-4", "2026-07-14 00:00:00", "ac-2", "cd-2", "shop-2", "purchase", "NOK", "2300.00", "approved"),
            ("t-5", "2026-07-14 12:30:00", "ac-5", None, None, "transfer_in", "GBP", "75.00", "approved"),
            ("t-6", "2026-07-14 12:30:00", "ac-1", None, None, "transfer_out", "GBP", "75.00", "approved")],
        "customer_changes": [
            ("ch-3", "cu-1", "status", "active", None, None, None, "2026-07-14 08:00:00"),
            ("ch-4", "cu-1", "status", "closed", None, None, None, "2026-07-14 09:00:00"),
            ("ch-5", "cu-3", "address", None, "5 New Street", "York", "England", "2026-07-14 10:00:00")],
        "customers": [],
        "accounts": [],
        "cards": [("cd-3", "ac-5", "990011", "2026-07-14", "active")],
    },
    "2026-07-15": {
        "transactions": [
            ("t-7", "2026-07-15 06:00:00", "ac-5", "cd-3", "shop-1", "purchase", "GBP", "9.99", "approved"),
            ("t-8", "2026-07-15 18:45:10", "ac-3", None, None, "withdrawal", "GBP", "20.00", "approved"),
            ("t-9", "2026-07-15 18:45:11", "ac-4", None, None, "deposit", "GBP", "20.00", "approved")],
        "customer_changes": [
            ("ch-6", "cu-2", "status", "blocked", None, None, None, "2026-07-15 07:00:00"),
            ("ch-7", "cu-2", "address", None, "9 Bru", "Oslo", "Norway", "2026-07-15 07:00:00")],
        "customers": [],
        "accounts": [],
        "cards": [],
    },
}


def write_file(path: str, entity: str, rows: list[tuple]) -> None:
    """A landing file of an entity (None is an empty field)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([ENTITIES[entity].columns, *rows])


def daily_file(incoming: str, day: str, entity: str) -> str:
    prefix = next(p for p, name in DAILY_FILES.items() if name == entity)
    return os.path.join(incoming, day, f"{prefix}_{day}.csv")


def build(root: str, days: list[str]) -> tuple[str, str]:
    """The seed folder and the incoming folder with the files of ``days``."""
    seed_dir, incoming = os.path.join(root, "seed"), os.path.join(root, "incoming")
    for entity, rows in SEED.items():
        write_file(os.path.join(seed_dir, f"{entity}.csv"), entity, rows)
    for day in days:
        for entity, rows in DAYS[day].items():
            write_file(daily_file(incoming, day, entity), entity, rows)
    return seed_dir, incoming
