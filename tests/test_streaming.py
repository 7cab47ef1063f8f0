import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.plans.jobs import bronze_table
from tidemark.schemas import INSERT_ABSENT, UPSERT, Entity
from tidemark.sources import commits
from tidemark.sources.tables import read_table
from tidemark.streaming.landing import dedupe_events, fold_batch, stream_first, stream_landing


def _csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


CH = "change_id,customer_id,change_type,status,address_line,city,country,change_timestamp"


def test_stream_landing_first_wins_and_new_files_only(spark, tmpdir_path):
    inc, root = os.path.join(tmpdir_path, "incoming"), os.path.join(tmpdir_path, "wh")
    _csv(os.path.join(inc, "2026-07-13", "customer_changes_2026-07-13.csv"), CH,
         ["CH1,C1,status,blocked,,,,2026-07-13 10:00:00", 'CH2,C2,address,,"1 Quay, 2",Bergen,Norway,2026-07-13 11:00:00'])
    _csv(os.path.join(inc, "2026-07-14", "customer_changes_2026-07-14.csv"), CH,
         ["CH1,C1,status,closed,,,,2026-07-14 10:00:00", "CH3,C3,status,blocked,,,,2026-07-14 10:00:00"])
    pattern = os.path.join(inc, "*", "customer_changes_*.csv")
    ckpt = stream_landing(spark, "customer_changes", pattern, root)
    t = bronze_table(spark, root, "customer_changes")
    got = {r["change_id"]: (r["status"], r["address_line"]) for r in t.collect()}
    assert got == {"CH1": ("blocked", None), "CH2": (None, "1 Quay, 2"), "CH3": ("blocked", None)}
    # a new day only: the same checkpoint processes just the new file
    _csv(os.path.join(inc, "2026-07-15", "customer_changes_2026-07-15.csv"), CH,
         ["CH4,C4,status,closed,,,,2026-07-15 10:00:00", "CH2,C2,status,closed,,,,2026-07-15 10:00:00"])
    stream_landing(spark, "customer_changes", pattern, root, checkpoint=ckpt)
    t = bronze_table(spark, root, "customer_changes")
    assert t.count() == 4 and t.filter(F.col("change_id") == "CH2").first()["status"] is None


def test_stream_upsert_latest_wins(spark, tmpdir_path):
    inc, root = os.path.join(tmpdir_path, "incoming"), os.path.join(tmpdir_path, "wh")
    hdr = "customer_id,first_name,last_name,dob,status,created_at"
    _csv(os.path.join(inc, "2026-07-13", "new_customers_2026-07-13.csv"), hdr, ["C1,Ann,Lee,1990-01-01,active,2026-07-13 09:00:00"])
    _csv(os.path.join(inc, "2026-07-14", "new_customers_2026-07-14.csv"), hdr, ["C1,Ann,Lee,1990-01-01,blocked,2026-07-13 09:00:00"])
    stream_landing(spark, "customers", os.path.join(inc, "*", "new_customers_*.csv"), root)
    assert [r["status"] for r in bronze_table(spark, root, "customers").collect()] == ["blocked"]


def test_dedupe_events_memory_sink(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "ev")
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, v string").write.parquet(src)
    stream = spark.readStream.schema("id long, v string").parquet(src)
    q = dedupe_events(stream, "id").writeStream.format("memory").queryName("dedup_test") \
        .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT count(*) AS n FROM dedup_test").first()["n"] == 2


def test_dedupe_within_watermark(spark, tmpdir_path):
    import datetime as dt
    src = os.path.join(tmpdir_path, "evw")
    t = dt.datetime(2026, 7, 13, 10, 0)
    spark.createDataFrame([(1, t, "a"), (1, t + dt.timedelta(seconds=5), "dup"), (2, t, "c")],
                          "id long, ts timestamp, v string").write.parquet(src)
    stream = spark.readStream.schema("id long, ts timestamp, v string").parquet(src)
    q = dedupe_events(stream, "id", "ts", "1 hour").writeStream.format("memory").queryName("dedup_wm") \
        .option("checkpointLocation", os.path.join(tmpdir_path, "ckw")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT count(*) AS n FROM dedup_wm").first()["n"] == 2


def test_stream_one_file_per_micro_batch(spark, tmpdir_path):
    inc, root = os.path.join(tmpdir_path, "incoming"), os.path.join(tmpdir_path, "wh")
    _csv(os.path.join(inc, "2026-07-13", "customer_changes_2026-07-13.csv"), CH,
         ["CH1,C1,status,blocked,,,,2026-07-13 10:00:00"])
    _csv(os.path.join(inc, "2026-07-14", "customer_changes_2026-07-14.csv"), CH,
         ["CH1,C1,status,closed,,,,2026-07-14 10:00:00", "CH2,C2,status,blocked,,,,2026-07-14 10:00:00"])
    _csv(os.path.join(inc, "2026-07-15", "customer_changes_2026-07-15.csv"), CH,
         ["CH2,C2,status,closed,,,,2026-07-15 10:00:00", "CH3,C3,status,closed,,,,2026-07-15 10:00:00"])
    stream_landing(spark, "customer_changes", os.path.join(inc, "*", "customer_changes_*.csv"), root,
                   max_files_per_trigger=1)
    got = {r["change_id"]: r["status"] for r in bronze_table(spark, root, "customer_changes").collect()}
    assert got == {"CH1": "blocked", "CH2": "blocked", "CH3": "closed"}     # first wins across batches


def _one_file(inc, name, lines):
    _csv(os.path.join(inc, "2026-07-13", name), CH, lines)


@pytest.mark.parametrize("line", ["CH1,C2,status,closed,,,,2026-07-13 11:00:00", ",C2,status,closed,,,,2026-07-13 11:00:00",
                                  f"CH2,C2,address,,{'x' * 256},,,2026-07-13 11:00:00"])
def test_a_bad_file_raises_and_nothing_of_its_batch_is_stored(spark, tmpdir_path, line):
    """A key twice in one file, a NULL key, an over-long text: as in the batch loader."""
    inc, root = os.path.join(tmpdir_path, "incoming"), os.path.join(tmpdir_path, "wh")
    _one_file(inc, "customer_changes_a.csv", ["CH1,C1,status,blocked,,,,2026-07-13 10:00:00", line])
    with pytest.raises(StreamingQueryException):
        stream_landing(spark, "customer_changes", os.path.join(inc, "*", "customer_changes_*.csv"), root)
    assert bronze_table(spark, root, "customer_changes").count() == 0


def test_a_batch_run_again_changes_nothing(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "wh")
    s = "user_id string, status string, last_event string, _file string"
    for entity, table in ((Entity("users", "user_id", ("user_id", "status", "last_event"), UPSERT), "users"),
                          (Entity("seen", "user_id", ("user_id", "status", "last_event"), INSERT_ABSENT), "seen")):
        fold = lambda n, *rows: fold_batch(spark.createDataFrame(list(rows), s), n, "stream-1", root, "bronze", entity,
                                           dt.datetime(2026, 7, 14 + n, tzinfo=dt.timezone.utc))
        assert fold(0, ("u1", "a", "e1", "f1"), ("u1", "b", "e2", "f2"), ("u2", "a", "e1", "f1"))
        assert fold(1, ("u1", "c", "e3", "f3"), ("u3", "a", "e1", "f3"))
        state = lambda: sorted((r["user_id"], r["status"]) for r in read_table(spark, root, "bronze", table).collect())
        want = [("u1", "c" if table == "users" else "a"), ("u2", "a"), ("u3", "a")]
        assert state() == want
        before = len(commits.history(root))
        assert not fold(1, ("u1", "z", "e9", "f9"), ("u9", "z", "e9", "f9")) and not fold(0, ("u8", "z", "e9", "f9"))
        assert state() == want and len(commits.history(root)) == before


def test_a_restart_goes_on_from_the_tables_own_checkpoint(spark, tmpdir_path):
    inc, root = os.path.join(tmpdir_path, "incoming"), os.path.join(tmpdir_path, "wh")
    pattern = os.path.join(inc, "*", "customer_changes_*.csv")
    _one_file(inc, "customer_changes_a.csv", ["CH1,C1,status,blocked,,,,2026-07-13 10:00:00"])
    stream_landing(spark, "customer_changes", pattern, root)
    _one_file(inc, "customer_changes_b.csv", ["CH2,C1,status,closed,,,,2026-07-13 10:00:00"])
    stream_landing(spark, "customer_changes", pattern, root)
    entry = commits.tables(root)["bronze/customer_changes"]
    assert len(entry["loads"]) == 2 and set(entry["streams"].values()) == {1}
    assert bronze_table(spark, root, "customer_changes").count() == 2


@pytest.mark.parametrize("ttl", [None, dt.timedelta(milliseconds=1), dt.timedelta(hours=1)])
def test_first_of_each_with_state_and_log(spark, tmpdir_path, ttl):
    """State drops repeats of the last hours, the log those of any age; late rows are kept."""
    src, root, ck = (os.path.join(tmpdir_path, x) for x in ("ev", "wh", "ck"))
    schema = "id string, at long, v string"
    put = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)
    run = lambda: stream_first(spark.readStream.schema(schema).parquet(src), "id", "at", root, "bronze", "ev", ck, ttl=ttl)
    put(("a", 2, "second"), ("a", 1, "first"), ("b", 5, "b"), ("b", 5, "b2"))
    run()
    put(("a", 0, "earlier but late"), ("c", -100, "late"))
    run()       # a short-lived state has forgotten a, the log has not
    got = {r["id"]: r["v"] for r in read_table(spark, root, "bronze", "ev").collect()}
    assert got["a"] == "first" and got["b"] in ("b", "b2") and got["c"] == "late" and len(got) == 3
    assert read_table(spark, root, "bronze", "ev").count() == 3
