"""Steps, bucketed tables and the key index: what is visible when, what is read and written, what is kept."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests import bank_fixture
from tidemark.operators import keyindex
from tidemark.plans import jobs
from tidemark.plans.parallel import concurrently
from tidemark.sources import commits
from tidemark.sources import tables as S

KV = "k string, v int"


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), KV)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_step_shows_all_or_nothing(spark, tmpdir_path):
    root = tmpdir_path + "/wh"
    S.publish(kv(spark, ("a", 1)), root, "x", "one")
    with pytest.raises(OSError):
        with commits.step(root, "breaks off"):
            S.publish(kv(spark, ("b", 2)), root, "x", "one")
            S.append_log(kv(spark, ("c", 3)), root, "x", "two", "20260701T000000")
            assert content(S.read_table(spark, root, "x", "one")) == [("b", 2)]        # its own writes
            assert S.read_table(spark, root, "x", "two").count() == 1
            raise OSError("lost")
    assert content(S.read_table(spark, root, "x", "one")) == [("a", 1)] and S.read_table(spark, root, "x", "two") is None
    with commits.step(root, "both"):
        S.publish(kv(spark, ("b", 2)), root, "x", "one")
        S.append_log(kv(spark, ("c", 3)), root, "x", "two", "20260701T000000")
        before = commits.history(root)
    assert [c["changed"] for c in commits.history(root)[len(before):]] == [["x/one", "x/two"]]
    assert content(S.read_entry(spark, root, commits.tables_at(root, 1)["x/one"])) == [("a", 1)]     # as it was


def test_steps_over_other_tables_both_succeed_and_over_one_table_conflict(spark, tmpdir_path):
    root = tmpdir_path + "/wh"
    S.publish(kv(spark, ("a", 1)), root, "x", "one")
    first, second, third = (commits.Step(root, n) for n in ("first", "second", "third"))
    first.set("x/one", {"kind": "version", "path": "p"})
    second.set("x/two", {"kind": "version", "path": "q"})
    third.set("x/one", {"kind": "version", "path": "r"})
    second.commit()
    first.commit()
    with pytest.raises(commits.CommitConflict):
        third.commit()
    assert {t: e["path"] for t, e in commits.tables(root).items()} == {"x/one": "p", "x/two": "q"}


def buckets_read(df):
    return {f.split("bucket=")[1].split("/")[0] for f in df.inputFiles()}


def test_an_upsert_reads_and_writes_the_buckets_it_touches(spark, tmpdir_path):
    root = tmpdir_path + "/wh"
    S.upsert_buckets(kv(spark, *((f"k{i}", 0) for i in range(400))), root, "x", "t", "k", buckets=32)
    before = S.table_entry(root, "x", "t")["buckets"]
    assert len(before) == 32
    # Whatever else is there is not even readable: only the touched buckets may be opened.
    batch = kv(spark, ("k7", 1), ("k8", 1), ("new", 1))
    mine = {str(r["b"]) for r in batch.select(S.bucket_of("k", 32).alias("b")).collect()}
    hidden = {b: p for b, p in before.items() if b not in mine}
    for p in hidden.values():
        os.rename(os.path.join(root, p), os.path.join(root, p) + ".hidden")
    touched = S.upsert_buckets(batch, root, "x", "t", "k")
    for p in hidden.values():
        os.rename(os.path.join(root, p) + ".hidden", os.path.join(root, p))
    after = S.table_entry(root, "x", "t")["buckets"]
    assert {str(b) for b in touched} == mine == {b for b in after if after[b] != before.get(b)}
    rows = dict(content(S.read_table(spark, root, "x", "t")))
    assert len(rows) == 401 and {k for k, v in rows.items() if v} == {"k7", "k8", "new"}
    assert buckets_read(S.read_buckets(spark, root, "x", "t", kv(spark, ("k7", 0)).select("k"))) < mine
    assert buckets_read(S.changed_buckets(spark, root, "x", "t", before)) == mine
    S.rebucket(spark, root, "x", "t", 5)
    assert S.table_entry(root, "x", "t")["n"] == 5 and dict(content(S.read_table(spark, root, "x", "t"))) == rows
    with pytest.raises(ValueError, match="not bucketed by"):
        S.upsert_buckets(batch, root, "x", "t", "v")


def test_upsert_of_nothing_and_null_values(spark, tmpdir_path):
    root = tmpdir_path + "/wh"
    assert S.upsert_buckets(kv(spark), root, "x", "t", "k") == []
    assert S.read_table(spark, root, "x", "t").count() == 0 and S.read_table(spark, root, "x", "t").columns == ["k", "v"]
    S.upsert_buckets(kv(spark, ("a", None), ("", 2)), root, "x", "t", "k")
    S.upsert_buckets(kv(spark, ("a", 1), ("", None)), root, "x", "t", "k")
    assert content(S.read_table(spark, root, "x", "t")) == [("", None), ("a", 1)]


def test_expire_keeps_what_the_last_commits_name(spark, tmpdir_path):
    root = tmpdir_path + "/wh"
    for i in range(4):
        S.publish(kv(spark, ("a", i)), root, "x", "one")
        S.upsert_buckets(kv(spark, (f"k{i}", i), ("k0", i)), root, "x", "cur", "k", buckets=8)
        S.append_log(kv(spark, (f"e{i}", i)), root, "x", "log", f"2026070{i}T000000", key="k")
    state = {t: content(S.read_table(spark, root, "x", t)) for t in ("one", "cur", "log")}
    assert commits.expire(root, keep=3) == []                       # all folders are younger than a day
    gone = commits.expire(root, keep=1, grace=dt.timedelta(0))
    assert any("one/version" in g for g in gone) and any("bucket=" in g for g in gone) and not any("/log/" in g for g in gone)
    assert {t: content(S.read_table(spark, root, "x", t)) for t in state} == state
    assert len(commits.history(root)) == 1
    assert commits.expire(root, keep=1, grace=dt.timedelta(0)) == []
    S.append_log(kv(spark, ("e9", 9)), root, "x", "log", "20260709T000000", key="k")        # and it goes on from there
    assert S.read_table(spark, root, "x", "log").count() == 5


def test_key_index_never_misses_and_seldom_errs(spark, monkeypatch):
    monkeypatch.setattr(keyindex, "KEYS_A_PART", 2000)
    rows = spark.range(9000).select(F.concat(F.lit("k"), F.col("id") * 7).alias("k"))
    index = keyindex.build_index(rows.union(kv(spark, (None, 0)).select("k")), "k").withColumn("load_id", F.lit("L")).cache()
    stats = index.agg(F.count("*"), F.sum("n"), F.max("parts")).first()
    assert tuple(stats) == (8, 9000, 8)
    assert keyindex.may_hold(index, rows, "k").count() == 9000
    others = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id") * 7 + 3).alias("k"))
    wrong = keyindex.may_hold(index, others, "k").join(rows, "k", "left_anti").count()
    assert wrong <= 5                                               # of 200,000: about 1 in a million is expected
    assert keyindex.may_hold(index, kv(spark, (None, 0)).select("k"), "k").count() == 0
    assert keyindex.may_hold(index.where("false"), rows, "k").count() == 0
    single = keyindex.build_index(kv(spark, ("a", 1), ("a", 2)), "k").collect()
    assert len(single) == 1 and (single[0]["low"], single[0]["high"]) == ("a", "a")
    assert keyindex.build_index(kv(spark), "k").count() == 0


def test_a_load_opens_only_loads_that_may_hold_its_keys(spark, tmpdir_path):
    root, path = tmpdir_path + "/wh", tmpdir_path + "/tx.csv"
    tx = lambda n, amount="10.00": (f"t{n}", "2026-07-13 10:00:00", "ac-1", None, None, "deposit", "GBP", amount, "approved")
    for day in range(3):
        bank_fixture.write_file(path, "transactions", [tx(100 * day + i) for i in range(50)])
        jobs.load_entity(spark, "transactions", path, root, dt.datetime(2026, 7, 14 + day, 1))
    keys = spark.createDataFrame([("t105",), ("t9999",)], "transaction_id string")
    day2 = jobs.load_id(dt.datetime(2026, 7, 15, 1))
    assert S.loads_with_keys(spark, root, "bronze", "transactions", keys, "transaction_id", broadcast_keys=True) == [day2]
    # The other loads may even be gone: a day of known and new keys does not open them.
    loads = S.table_entry(root, "bronze", "transactions")["loads"]
    hidden = [os.path.join(root, v["path"]) for k, v in loads.items() if k != day2]
    for p in hidden:
        os.rename(p, p + ".hidden")
    bank_fixture.write_file(path, "transactions", [tx(105, "99.00"), tx(9999)])
    jobs.load_entity(spark, "transactions", path, root, dt.datetime(2026, 7, 17, 1))
    for p in hidden:
        os.rename(p + ".hidden", p)
    table = jobs.bronze_table(spark, root, "transactions")
    assert table.count() == 151 and table.where("transaction_id = 't105'").first()["amount"] == "10.00"
    # A false positive costs a look and changes nothing.
    monkey = S.loads_with_keys
    try:
        jobs.loads_with_keys = lambda *a, **k: list(S.table_entry(root, "bronze", "transactions")["loads"])
        bank_fixture.write_file(path, "transactions", [tx(7, "99.00"), tx(5000)])
        jobs.load_entity(spark, "transactions", path, root, dt.datetime(2026, 7, 18, 1))
    finally:
        jobs.loads_with_keys = monkey
    assert jobs.bronze_table(spark, root, "transactions").count() == 152


WRITES = ["publish", "append_log", "replace_log", "rewrite_loads", "upsert_buckets"]


class _Breaks:
    """Lets ``n`` writes of the jobs through and breaks off at the next."""

    def __init__(self, monkeypatch, n):
        self.left = n
        for name in WRITES:
            monkeypatch.setattr(jobs, name, self.wrap(getattr(S, name)))

    def wrap(self, fn):
        def write(*args, **kwargs):
            if self.left == 0:
                raise OSError("lost")
            self.left -= 1
            return fn(*args, **kwargs)
        return write


def whole(spark, root):
    """All tables' rows, as text."""
    return {name: sorted(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True)
                         for r in S.read_entry(spark, root, entry).collect()) for name, entry in commits.tables(root).items()}


@pytest.mark.parametrize("stage", ["silver", "snapshots", "gold"])
def test_a_run_that_breaks_off_between_two_writes_leaves_no_trace(spark, tmpdir_path, monkeypatch, stage):
    days = ["2026-07-13", "2026-07-14"]
    seed_dir, incoming = bank_fixture.build(tmpdir_path, days)
    root, as_of = tmpdir_path + "/wh", dt.date(2026, 7, 13)
    jobs.bootstrap(spark, seed_dir, root, dt.datetime(2026, 7, 12, 23))
    work = {"silver": lambda ts: jobs.build_silver(spark, root, as_of, ts), "snapshots": lambda ts: jobs.take_snapshots(spark, root, ts),
            "gold": lambda ts: jobs.build_gold(spark, root, ts)}
    first, second = dt.datetime(2026, 7, 14, 0, 30), dt.datetime(2026, 7, 15, 0, 30)
    jobs.load_day(spark, days[0], incoming, root, first)
    for name in work:
        work[name](first)
    jobs.load_day(spark, days[1], incoming, root, second)
    for name in work:
        if name == stage:
            break
        work[name](second)
    monkeypatch.setattr(jobs, "concurrently", lambda spark, work: {k: f() for k, f in work.items()})      # one after another
    before, broke = whole(spark, root), 0
    for n in range(0, 100, 1 if stage != "silver" else 5):
        with monkeypatch.context() as m:
            _Breaks(m, n)
            try:
                work[stage](second)
                break
            except OSError:
                broke += 1
        assert whole(spark, root) == before, n
    assert broke >= 2
    done = whole(spark, root)
    assert done != before
    if stage == "gold":
        assert len(done["gold/fact_transactions"]) == 6


def test_concurrent_pieces_stop_after_a_failure(spark):
    done = []

    def fails():
        raise KeyError("second")
    with pytest.raises(KeyError, match="second"):
        concurrently(spark, {"first": lambda: done.append(1), "second": fails, "third": lambda: done.append(3)}, width=1)
    assert done == [1]
    assert concurrently(spark, {"a": lambda: spark.range(3).count(), "b": lambda: spark.range(4).count()}) == {"a": 3, "b": 4}


def test_fits_bounds_rows_and_bytes(spark):
    from tidemark.operators.sizing import fits
    before = spark.conf.getAll
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert fits(df, 100) and not fits(df, 99) and not fits(df, 100, max_bytes=50_000) and fits(df.where("false"), 0)
    assert spark.conf.getAll == before


def test_loads_are_found_without_a_row_a_key(spark, monkeypatch):
    monkeypatch.setattr(keyindex, "KEYS_A_PART", 500)
    name = lambda a, b: spark.range(a, b).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    index = keyindex.build_index(name(0, 3000), "k").withColumn("load_id", F.lit("A")).unionByName(
        keyindex.build_index(name(5000, 5200), "k").withColumn("load_id", F.lit("B"))).cache()
    many = name(2999, 5000).unionByName(kv(spark, (None, 0)).select("k"))
    for few in (False, True):
        found = lambda keys: sorted(r[0] for r in keyindex.loads_that_may_hold(index, keys, "k", broadcast_keys=few).collect())
        assert found(many) == ["A"] and found(name(0, 6000)) == ["A", "B"] and found(many.where("k IS NULL")) == []
    assert keyindex.loads_that_may_hold(index.where("false"), many, "k").count() == 0


def test_a_load_of_new_keys_is_stored_once(spark, tmpdir_path, monkeypatch):
    root, path = tmpdir_path + "/wh", tmpdir_path + "/tx.csv"
    tx = lambda n: (f"t{n}", "2026-07-13 10:00:00", "ac-1", None, None, "deposit", "GBP", "1.00", "approved")
    stored = []
    real = jobs.append_log
    monkeypatch.setattr(jobs, "append_log", lambda *a, **k: stored.append(k["stored"]) or real(*a, **k))
    for day, ids in enumerate([range(5), range(10, 15), range(13, 18)]):
        bank_fixture.write_file(path, "transactions", [tx(i) for i in ids])
        jobs.load_entity(spark, "transactions", path, root, dt.datetime(2026, 7, 14 + day, 1))
    assert stored[0] and stored[1] and stored[2] is None      # the third holds known keys
    loads = S.table_entry(root, "bronze", "transactions")["loads"]
    assert [v["path"] for v in loads.values()][:2] == stored[:2]
    assert jobs.bronze_table(spark, root, "transactions").count() == 13


def test_a_large_batch_moves_stored_rows_once_to_their_buckets(spark, tmpdir_path):
    """Like the join of a small batch, also with keys that are NULL or repeat; a bucket is one file again."""
    schema = "k string, v int"
    held = [(f"k{i}", 0) for i in range(200)] + [("k0", 1), (None, 2)]
    batch = [(f"k{i}", 9) for i in range(150, 250)] + [(None, 3)]
    found = {}
    for small in (True, False, None):
        root = f"{tmpdir_path}/{small}"
        S.upsert_buckets(spark.createDataFrame(held, schema), root, "x", "t", "k", buckets=8)
        S.upsert_buckets(spark.createDataFrame(batch, schema).repartition(6), root, "x", "t", "k", small_batch=small)
        table = S.read_table(spark, root, "x", "t")
        found[small] = sorted(map(tuple, table.collect()), key=str)
    assert len(table.inputFiles()) > 8
    assert len(S.read_table(spark, f"{tmpdir_path}/False", "x", "t").inputFiles()) == 8
    assert found[False] == found[True] == found[None]
    assert found[False] == sorted([*held[:150], ("k0", 1), (None, 2), *batch], key=str)
    # a column of the name the files are dealt by is the table's own
    both = S._merged(spark.createDataFrame([("a", 1), ("b", 2)], schema), spark.createDataFrame([("b", 3)], schema), ["k"], S.bucket_of("k", 4))
    assert sorted(map(tuple, both.select("k", "v").collect())) == [("a", 1), ("b", 3)]


def test_the_large_batchs_keys_move_without_their_hashes(spark):
    from tidemark.operators import keyindex
    keys = kv(spark, *((f"k{i}", i) for i in range(100)))
    index = keyindex.build_index(keys, "k").withColumn("load_id", F.lit("a"))
    found = keyindex.loads_that_may_hold(index, keys.select("k"), "k")
    assert [r["load_id"] for r in found.collect()] == ["a"]
    moved = keyindex._dealt(keys.select("k"), "k", 1, 1, moved=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in moved.split("RepartitionByExpression")[0] and "AS _h" not in moved.split("RepartitionByExpression")[1]
