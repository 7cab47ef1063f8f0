import datetime as dt
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError
from tidemark.plans import gold, jobs
from tidemark.sources import commits
from tests import bank_fixture

DAYS = ["2026-07-13", "2026-07-14", "2026-07-15"]


def test_bootstrap_and_three_days(spark, tmpdir_path):
    seed_dir, incoming = bank_fixture.build(tmpdir_path, DAYS)
    root = tmpdir_path + "/warehouse"
    loaded = jobs.bootstrap(spark, "file:" + seed_dir, root, dt.datetime(2026, 7, 12, 23, 0))
    assert len(loaded) == 11
    for i, day in enumerate(DAYS):
        run_ts = dt.datetime(2026, 7, 14 + i, 0, 30)
        if i == 2:
            # a contact changes between runs: its customer's dimension rows must follow
            path = tmpdir_path + "/contacts_fix.csv"
            bank_fixture.write_file(path, "customer_contacts",
                                    [("ct-1", "cu-1", "441130009999", "new@post.example", "2025-05-01", None)])
            jobs.load_entity(spark, "customer_contacts", path, root, run_ts - dt.timedelta(minutes=10))
        failed = jobs.run_day(spark, day, incoming, root, run_ts, as_of=dt.date(2026, 7, 13), full_checks=i != 1)
        assert failed == {"silver": [], "gold": []}
    g = jobs.gold_tables(spark, root)
    fact = g["fact_transactions"]
    assert fact.count() == 9                                      # every transaction once
    assert fact.filter(F.col("customer_sk").isNull()).count() == 0
    dim = g["dim_customers"]
    from tidemark.plans import gold as G
    s0 = jobs.silver_tables(spark, root)
    full = G.dim_customers(s0["customers_snapshot"], s0["addresses_snapshot"], s0["customer_contacts"])
    assert dim.exceptAll(full).count() == 0 and full.exceptAll(dim).count() == 0   # incremental == full
    assert dim.filter("customer_id = 'cu-1'").select("email").distinct().first()["email"] == "n***@post.example"
    assert dim.groupBy("customer_id").agg(F.sum(F.col("is_current").cast("int")).alias("n")) \
              .filter("n != 1").count() == 0                        # one current row per customer
    # an idempotent re-run of the last day (same files, later clock) adds no facts
    jobs.run_day(spark, DAYS[-1], incoming, root, dt.datetime(2026, 7, 17, 0, 30), as_of=dt.date(2026, 7, 13))
    before = jobs.gold_tables(spark, root)["fact_transactions"].collect()
    assert len(before) == 9
    s = jobs.silver_tables(spark, root)
    assert s["transactions"].count() == 9
    # building gold again from all of silver gives the same rows
    jobs.build_gold(spark, root, dt.datetime(2026, 7, 18, 0, 30), full=True)
    assert sorted(jobs.gold_tables(spark, root)["fact_transactions"].collect(), key=str) == sorted(before, key=str)
    # blocked customers show up as new snapshot versions
    assert s["customers_snapshot"].filter(F.col("status") == "blocked").count() >= 1
    masked = s["customer_contacts"].select("phone", "email").first()
    assert masked["phone"].startswith("*******") and "***@" in masked["email"]
    # incrementally maintained current state == recomputed from the whole change history
    from tidemark.plans import silver
    changes = jobs.bronze_table(spark, root, "customer_changes")
    full_c = silver.customers_current(jobs.bronze_table(spark, root, "customers"), changes, dt.date(2026, 7, 13))
    full_a = silver.addresses_current(jobs.bronze_table(spark, root, "customer_addresses"), changes)
    for name, full in [("customers_current", full_c), ("addresses_current", full_a)]:
        stored = jobs._table(spark, root, jobs.SILVER, name)
        assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0


ORPHAN = ("t-orphan", "2026-07-13 10:00:00", "ac-late", None, None, "deposit", "GBP", "10.00", "approved")


def _with_orphan(incoming, day):
    """The day's transactions and one whose account does not exist."""
    bank_fixture.write_file(bank_fixture.daily_file(incoming, day, "transactions"), "transactions",
                            [*bank_fixture.DAYS[day]["transactions"], ORPHAN])


def test_failing_silver_check_stops_before_gold(spark, tmpdir_path):
    seed_dir, incoming = bank_fixture.build(tmpdir_path, DAYS[:1])
    root = tmpdir_path + "/warehouse"
    jobs.bootstrap(spark, seed_dir, root, dt.datetime(2026, 7, 12, 23, 0))
    _with_orphan(incoming, DAYS[0])
    # with the gate in warn mode the run completes and reports the failure
    failed = jobs.run_day(spark, DAYS[0], incoming, root, dt.datetime(2026, 7, 14, 0, 30),
                          as_of=dt.date(2026, 7, 13), on_fail="warn")
    assert any(f["check"] == "relationships" and f["table"] == "transactions" for f in failed["silver"])
    assert jobs.last_passed(spark, root, jobs.SILVER) is None


@pytest.mark.parametrize("full_checks", [True, False])
def test_a_failed_day_stays_failed_until_it_is_mended(spark, tmpdir_path, full_checks):
    seed_dir, incoming = bank_fixture.build(tmpdir_path, DAYS)
    root, as_of = tmpdir_path + "/warehouse", dt.date(2026, 7, 13)
    jobs.bootstrap(spark, seed_dir, root, dt.datetime(2026, 7, 12, 23, 0))
    run = lambda i, hour=0: jobs.run_day(spark, DAYS[i], incoming, root, dt.datetime(2026, 7, 14 + i, hour, 30),
                                         as_of=as_of, full_checks=full_checks)
    run(0)
    _with_orphan(incoming, DAYS[1])
    for i in (1, 2):                                       # day 3 has good files, but day 2 is not mended
        with pytest.raises(QualityError):
            run(i)
        assert jobs.gold_tables(spark, root)["fact_transactions"].count() == 3
    path = tmpdir_path + "/late_account.csv"
    bank_fixture.write_file(path, "accounts", [("ac-late", "cu-1", "everyday", "GBP", "2026-07-13", "active")])
    jobs.load_entity(spark, "accounts", path, root, dt.datetime(2026, 7, 16, 1, 0))
    assert run(2, hour=2) == {"silver": [], "gold": []}
    g, s = jobs.gold_tables(spark, root), jobs.silver_tables(spark, root)
    assert g["fact_transactions"].count() == 10
    # versions of the runs that never reached gold are in the dimension
    full = gold.dim_customers(s["customers_snapshot"], s["addresses_snapshot"], s["customer_contacts"])
    assert g["dim_customers"].exceptAll(full).count() == 0 and full.exceptAll(g["dim_customers"]).count() == 0


def test_a_missing_seed_file_raises(spark, tmpdir_path):
    seed_dir, _ = bank_fixture.build(tmpdir_path, [])
    with pytest.raises(FileNotFoundError, match="merchants"):
        jobs.bootstrap(spark, seed_dir + "/none", tmpdir_path + "/wh", dt.datetime(2026, 7, 12))
    assert jobs.bootstrap(spark, seed_dir, tmpdir_path + "/wh", dt.datetime(2026, 7, 12), ["currencies"]) == ["currencies"]


def test_a_retried_snapshot_run_stores_closed_versions_once(spark, tmpdir_path, monkeypatch):
    root, spec = tmpdir_path + "/wh", [("customers_snapshot", "customers_current", ["status"])]
    state = lambda *rows: jobs.publish(spark.createDataFrame(rows, "customer_id string, status string"), root,
                                       jobs.SILVER, "customers_current")
    closed = lambda: sorted(r["customer_id"] for r in jobs.snapshot_table(spark, root, "customers_snapshot")
                            .filter("valid_to is not null").collect())
    state(("C1", "active"), ("C2", "active"))
    jobs.take_snapshots_for(spark, root, dt.datetime(2026, 7, 14), spec)
    state(("C1", "blocked"), ("C2", "closed"))
    publish = jobs.publish

    def broken(*args, **kwargs):
        raise OSError("lost")
    monkeypatch.setattr(jobs, "publish", broken)
    with pytest.raises(OSError):
        jobs.take_snapshots_for(spark, root, dt.datetime(2026, 7, 15), spec)
    monkeypatch.setattr(jobs, "publish", publish)
    state(("C1", "blocked"), ("C2", "active"))             # C2's change was taken back before the retry
    for _ in range(2):                                     # the retry, and a run of the same clock once more
        jobs.take_snapshots_for(spark, root, dt.datetime(2026, 7, 15), spec)
        assert closed() == ["C1"]
    ids = [r["scd_id"] for r in jobs.snapshot_table(spark, root, "customers_snapshot").collect()]
    assert len(ids) == len(set(ids)) == 3


@pytest.mark.parametrize("zone", ["UTC", "Asia/Almaty", "America/New_York"])
def test_clocks_do_not_follow_the_machines_zone(spark, tmpdir_path, monkeypatch, zone):
    import time
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        root, path = tmpdir_path + "/wh", tmpdir_path + "/tx.csv"
        kinds = [dt.datetime(2026, 7, 14, 0, 30), dt.datetime(2026, 7, 14, 1, 30, tzinfo=dt.timezone.utc),
                 dt.datetime(2026, 7, 14, 7, 30, tzinfo=dt.timezone(dt.timedelta(hours=5)))]
        for n, run_ts in enumerate(kinds):                 # loads an hour apart, naive and aware: nothing is pruned
            bank_fixture.write_file(path, "transactions", [(f"t{n}", "2026-07-13 10:00:00", *ORPHAN[2:])])
            jobs.load_entity(spark, "transactions", path, root, run_ts)
            mark = jobs.log_mark(spark, root, jobs.SILVER, "transactions")
            assert mark == (None if n == 0 else dt.datetime(2026, 7, 14, n - 1, 30, tzinfo=dt.timezone.utc))
            source = jobs.log_since(spark, root, jobs.BRONZE, "transactions", mark)
            jobs.append_log(jobs.silver.new_transactions(source, mark=mark), root, jobs.SILVER, "transactions",
                            jobs.load_id(run_ts))
        got = jobs._table(spark, root, jobs.SILVER, "transactions").select(
            "transaction_id", F.date_format("dwh_load_date", "HH:mm").alias("t")).collect()
        assert sorted(map(tuple, got)) == [("t0", "00:30"), ("t1", "01:30"), ("t2", "02:30")]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_split_snapshot_storage_equals_snapshot_check(spark, tmpdir_path):
    from tidemark.operators.history import snapshot_check
    root = tmpdir_path + "/wh"
    states = [
        [("C1", "active"), ("C2", "active")],
        [("C1", "blocked"), ("C2", "active"), ("C3", "active")],
        [("C1", "blocked"), ("C3", "closed")],
        [("C1", "active"), ("C2", "blocked"), ("C3", "closed")],
    ]
    plain = None
    for i, st in enumerate(states):
        run = dt.datetime(2026, 7, 14 + i)
        cur = spark.createDataFrame(st, "customer_id string, status string")
        jobs.publish(cur, root, jobs.SILVER, "customers_current")
        jobs.take_snapshots_for(spark, root, run, [("customers_snapshot", "customers_current", ["status"])])
        plain = snapshot_check(plain, cur, "customer_id", ["status"], F.lit(run).cast("timestamp"))
    stored = jobs.snapshot_table(spark, root, "customers_snapshot")
    cols = ["customer_id", "status", "scd_id", "valid_from", "valid_to"]
    assert sorted(map(tuple, stored.select(*cols).collect()), key=str) == \
        sorted(map(tuple, plain.select(*cols).collect()), key=str)


def test_fact_correction_rewrites_only_touched_loads(spark, tmpdir_path):
    root = tmpdir_path + "/wh"
    s = "transaction_id string, amount long, dwh_load_date timestamp"
    day1 = spark.createDataFrame([("T1", 1, dt.datetime(2026, 7, 1)), ("T2", 2, dt.datetime(2026, 7, 1))], s)
    day2 = spark.createDataFrame([("T3", 3, dt.datetime(2026, 7, 2))], s)
    jobs._write_fact(spark, root, None, day1, 1000)
    jobs._write_fact(spark, root, jobs._table(spark, root, jobs.GOLD, "fact_transactions"), day2, 1000)
    # a correction replaces T1 (day-1 load) and T3 (day-2 load, which then has no row left)
    fix = spark.createDataFrame([("T1", 10, dt.datetime(2026, 7, 3)), ("T3", 30, dt.datetime(2026, 7, 3))], s)
    jobs._write_fact(spark, root, jobs._table(spark, root, jobs.GOLD, "fact_transactions"), fix, 1000)
    got = sorted((r["transaction_id"], r["amount"]) for r in jobs._table(spark, root, jobs.GOLD, "fact_transactions").collect())
    assert got == [("T1", 10), ("T2", 2), ("T3", 30)]


def test_log_mark_and_partition_pruning(spark, tmpdir_path):
    from tidemark.sources.tables import append_log
    root = tmpdir_path + "/wh"
    s = "k string, dwh_load_date timestamp"
    for day in (1, 2, 3):
        stamp = dt.datetime(2026, 7, day, 1, 0, tzinfo=dt.timezone.utc)
        append_log(spark.createDataFrame([(f"k{day}a", stamp), (f"k{day}b", stamp)], s), root, jobs.BRONZE, "ev",
                   jobs.load_id(stamp))
    mark = jobs.log_mark(spark, root, jobs.BRONZE, "ev")
    assert mark == dt.datetime(2026, 7, 3, 1, 0, tzinfo=dt.timezone.utc)
    since = jobs.log_since(spark, root, jobs.BRONZE, "ev", dt.datetime(2026, 7, 2, 1, 0))
    text = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_id" in text and "load_id#" in text
    assert sorted(r["k"] for r in since.collect()) == ["k2a", "k2b", "k3a", "k3b"]   # day 1 pruned


def test_command_line(spark, tmpdir_path, capsys):
    from tidemark.__main__ import main
    seed_dir, incoming = bank_fixture.build(tmpdir_path, DAYS[:1])
    root = tmpdir_path + "/wh"
    assert main(["bootstrap", "--seed-dir", seed_dir, "--root", root, "--run-ts", "2026-07-12T23:00:00"]) == 0
    assert main(["run-day", "--day", DAYS[0], "--incoming", incoming, "--root", root,
                 "--run-ts", "2026-07-14T00:30:00", "--as-of", "2026-07-13"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert out[-1] == '{"silver": [], "gold": []}'
    assert jobs.gold_tables(spark, root)["fact_transactions"].count() == 3
    assert main(["rebuild", "gold", "--root", root, "--run-ts", "2026-07-14T01:30:00"]) == 0
    assert jobs.gold_tables(spark, root)["fact_transactions"].count() == 3


def test_scoped_checks_see_keys_repeated_from_older_loads(spark, tmpdir_path):
    from tidemark.operators import quality as Q
    from tidemark.sources.tables import append_log
    root = tmpdir_path + "/wh"
    s = "transaction_id string, account_id string"
    day1, day2 = dt.datetime(2026, 7, 14, 0, 30), dt.datetime(2026, 7, 15, 0, 30)
    append_log(spark.createDataFrame([("T1", "A"), ("T2", None)], s), root, jobs.SILVER, "transactions",
               jobs.load_id(day1))
    append_log(spark.createDataFrame([("T3", "A"), ("T1", "B")], s), root, jobs.SILVER, "transactions",
               jobs.load_id(day2))
    checks = [Q.unique("transactions", "transaction_id"), Q.not_null("transactions", "account_id")]
    tables = {"transactions": jobs._table(spark, root, jobs.SILVER, "transactions")}
    def failures(passed):
        scoped, scope = jobs.scope_to_run(spark, root, jobs.SILVER, tables, checks, passed)
        return {(f["check"], f["failures"]) for f in jobs.check_layer(scoped, checks, "warn", scope)}
    # T1 repeats a day-1 key (caught); day 1's NULL account is checked again unless day 1 passed
    assert failures(jobs.load_id(day1)) == {("unique", 1)}
    assert failures(None) == {("unique", 1), ("not_null", 1)}


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def test_runs_keep_no_more_on_disk_than_the_tables_need(spark, tmpdir_path):
    """Nothing is written twice: no parsed copy, no fact delta, no shuffle file, no superseded version and, when
    asked for, no landing file is left after a run; the tables hold what they hold without."""
    from tidemark.session import _scratch_root
    rows = {}
    for name, opts in (("kept", {}), ("lean", {"consume": True, "keep": 1})):
        area = os.path.join(tmpdir_path, name)
        os.makedirs(area)
        seed_dir, incoming = bank_fixture.build(area, DAYS[:2])
        root = area + "/warehouse"
        scratch = lambda: set(os.listdir(_scratch_root(spark).removeprefix("file:"))) if os.path.exists(
            _scratch_root(spark).removeprefix("file:")) else set()
        before = scratch()
        jobs.bootstrap(spark, seed_dir, root, dt.datetime(2026, 7, 12, 23, 0))
        for i, day in enumerate(DAYS[:2]):
            assert jobs.run_day(spark, day, incoming, root, dt.datetime(2026, 7, 14 + i, 0, 30), as_of=dt.date(2026, 7, 13), **opts) == {
                "silver": [], "gold": []}
            assert os.path.exists(os.path.join(incoming, day)) == (name == "kept")
        left = {re.sub(r"-\d+$", "", x) for x in scratch() - before}
        assert not left & {"fact-delta", "customers_snapshot-run", "addresses_snapshot-run"}
        assert not any(x.startswith("landed-") for x in left)
        rows[name] = {t: sorted(map(str, df.drop("dwh_load_date").collect()))
                      for t, df in {**jobs.silver_tables(spark, root), **jobs.gold_tables(spark, root)}.items()}
        if opts:
            numbers = commits._numbers(root)
            assert len(numbers) <= 2                # the last layer's, and the mark of its passed checks
            named = {f for n in numbers for entry in commits.tables_at(root, n).values() for f in commits._folders(entry)}
            assert all(any(f == at or f.startswith(at + "/") for f in named) for at in commits._data_folders(root))
    assert rows["kept"] == rows["lean"]
    assert _size(os.path.join(tmpdir_path, "lean")) < _size(os.path.join(tmpdir_path, "kept"))


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    from tidemark.session import shuffle_files_freed

    def files():
        tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for top in tops for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, before = spark.conf.get(key), files()
    with shuffle_files_freed(spark):
        assert spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().collect()
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.1)
        assert not files() - before
    assert spark.conf.get(key) == own


def test_landing_files_are_gzipped_in_bounded_parts(spark, tmpdir_path, monkeypatch):
    from tidemark.plans import bank
    from tidemark.sources.landing import read_landing
    monkeypatch.setattr(bank, "PART_ROWS", 100)
    path = tmpdir_path + "/accounts.csv"
    bank.land(spark, "/root/testdata/sf0.001", "accounts", 0, path)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) > 10 and all(f.endswith(".csv.gz") for f in parts)
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter("o_orderkey % 6 <> 0")
    assert read_landing(spark, "accounts", path).count() == orders.count()
