import os

import pytest

from tidemark.sources.landing import read_landing


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_empty_quoted_doubled_and_unicode(spark, tmpdir_path):
    p = write(tmpdir_path, "currencies.csv",
              'currency_code,currency_name,symbol\nUSD,,$\nEUR,"",€\nKZT,"Tenge ""new"", KZ",₸\n')
    got = {r["currency_code"]: (r["currency_name"], r["symbol"]) for r in read_landing(spark, "currencies", p).collect()}
    assert got == {"USD": (None, "$"), "EUR": ("", "€"), "KZT": ('Tenge "new", KZ', "₸")}


@pytest.mark.parametrize("line", ["USD,US Dollar", "USD,US Dollar,$,extra"])
def test_short_or_long_row_aborts(spark, tmpdir_path, line):
    p = write(tmpdir_path, "c.csv", "currency_code,currency_name,symbol\n" + line + "\n")
    with pytest.raises(Exception):
        read_landing(spark, "currencies", p).collect()


def test_header_only_is_empty(spark, tmpdir_path):
    p = write(tmpdir_path, "h.csv", "currency_code,currency_name,symbol\n")
    assert read_landing(spark, "currencies", p).count() == 0


def test_swapped_header(spark, tmpdir_path):
    p = write(tmpdir_path, "s.csv", "currency_name,currency_code,symbol\nUS Dollar,USD,$\n")
    # Positional by default (the header row is skipped, not compared) ...
    assert read_landing(spark, "currencies", p).first()["currency_code"] == "US Dollar"
    # ... and rejected when asked to check it.
    with pytest.raises(Exception):
        read_landing(spark, "currencies", p, strict_header=True).collect()


def test_missing_path_raises(spark, tmpdir_path):
    with pytest.raises(Exception):
        read_landing(spark, "currencies", os.path.join(tmpdir_path, "nope.csv")).collect()


def test_load_rejects_overlong_text(spark, tmpdir_path):
    import datetime as dt
    from tidemark.operators.quality import QualityError
    from tidemark.plans.jobs import load_entity
    p = write(tmpdir_path, "currencies.csv", "currency_code,currency_name,symbol\nUSD," + "x" * 256 + ",$\n")
    with pytest.raises(QualityError):
        load_entity(spark, "currencies", p, tmpdir_path + "/wh", dt.datetime(2026, 7, 13))


def test_read_landing_batches_tags_the_folder_date(spark, tmpdir_path):
    import datetime as dt
    from tidemark.sources.landing import read_landing_batches
    for day in ["2026-07-13", "2026-07-14"]:
        os.makedirs(os.path.join(tmpdir_path, day))
        write(os.path.join(tmpdir_path, day), f"currencies_{day}.csv", f"currency_code,currency_name,symbol\nUSD,{day},$\n")
    got = sorted((r["currency_name"], r["batch_date"]) for r in read_landing_batches(spark, "currencies", tmpdir_path, "currencies").collect())
    assert got == [("2026-07-13", dt.date(2026, 7, 13)), ("2026-07-14", dt.date(2026, 7, 14))]


def test_layer_routing():
    from tidemark.sources.tables import layer_name, table_path
    assert layer_name(None) == "main" and layer_name(" silver ") == "silver"
    assert table_path("/wh", "gold", "dim") == "/wh/gold/dim" and table_path("/wh", None, "t") == "/wh/main/t"


def test_readers_ignore_an_incomplete_version(spark, tmpdir_path):
    from tidemark.sources.tables import publish, read_table, table_path
    root = tmpdir_path + "/wh"
    schema = "k string"
    assert read_table(spark, root, "silver", "t") is None
    assert read_table(spark, root, "silver", "t", schema=spark.createDataFrame([], schema).schema).count() == 0
    publish(spark.createDataFrame([("a",)], schema), root, "silver", "t")
    # an interrupted write: a newer version folder without the _SUCCESS marker
    broken = os.path.join(table_path(root, "silver", "t"), "v=29991231T000000000000-999999")
    spark.createDataFrame([("b",)], schema).write.parquet(broken)
    os.remove(os.path.join(broken, "_SUCCESS"))
    assert [r["k"] for r in read_table(spark, root, "silver", "t").collect()] == ["a"]
