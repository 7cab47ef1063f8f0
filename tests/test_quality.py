import pytest

from tidemark.operators import quality as Q


def test_checks_semantics(spark):
    parent = spark.createDataFrame([("p1",), ("p2",)], "id string")
    child = spark.createDataFrame([("c1", "p1", "a"), ("c2", None, None), ("c3", "zz", "b"), ("c3", "p2", "x"),
                                   (None, "p1", "a")], "id string, pid string, kind string")
    tables = {"parent": parent, "child": child}
    checks = [Q.not_null("child", "id"), Q.unique("child", "id"), Q.accepted_values("child", "kind", ["a", "b"]),
              Q.relationships("child", "pid", "parent", "id"),
              Q.rule("child", "no_x", "kind = 'x'", ["kind"]), Q.max_length("child", "id", 1)]
    got = {(r["check"], r["column"]): r["failures"] for r in Q.run_checks(tables, checks).collect()}
    assert got == {("not_null", "id"): 1,
                   ("unique", "id"): 1,                 # one duplicated value; NULL ignored
                   ("accepted_values", "kind"): 1,      # NULL passes
                   ("relationships", "pid"): 1,         # orphan 'zz'; NULL passes
                   ("no_x", "kind"): 1,
                   ("max_length", "id"): 4}
    assert Q.failing_rows(tables, checks[3]).first()["pid"] == "zz"
    with pytest.raises(Q.QualityError):
        Q.enforce(Q.run_checks(tables, checks), checks)
    warned = Q.enforce(Q.run_checks(tables, checks), checks, on_fail="warn")
    assert len(warned) == 6
    ok = [Q.not_null("parent", "id"), Q.unique("parent", "id")]
    assert Q.enforce(Q.run_checks(tables, ok), ok) == []


def test_relationships_share_one_pass(spark):
    """Several children, parents and key types: equal to a join of each check's own; every child is scanned once."""
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([("a", "z", 1, 1.0), ("q", "b", 9, 3.0), ("q", None, None, None), (None, "q", 2, 2.0)],
                                  "x string, y string, n int, f double")
    grand = spark.createDataFrame([("z",), ("z",), ("a",)], "x string")
    dec = spark.createDataFrame([(1.0,), (2.0,)], "f double")
    tables = {"parent": parent, "other": other, "child": child, "grand": grand, "dec": dec}
    checks = [Q.relationships("child", "x", "parent", "k"), Q.relationships("child", "y", "parent", "k"),
              Q.relationships("child", "n", "other", "id"), Q.relationships("grand", "x", "parent", "k"),
              Q.relationships("child", "f", "dec", "f")]
    got = {(r["table"], r["column"]): r["failures"] for r in Q.run_checks(tables, checks).collect()}
    assert got == {("child", "x"): 2, ("child", "y"): 2, ("child", "n"): 1, ("grand", "x"): 2, ("child", "f"): 1}
    one = {(r["table"], r["column"]): r["failures"] for r in Q.run_checks_one_by_one(tables, checks).collect()}
    assert one == got
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    many = [Q.relationships("orders", "o_custkey", "customer", "c_custkey"), Q.relationships("orders", "o_orderkey", "customer", "c_custkey")]
    text = Q.run_checks({"orders": orders, "customer": customer}, many)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftAnti") == 1 and text.count("Relation [") == 2


def test_keys_are_shuffled_once_for_uniqueness_and_relationships(spark):
    """Text of any form, hashes among it: equal to a query a check; the parents' keys move once, counted keys not again."""
    import hashlib
    md5 = lambda x: hashlib.md5(str(x).encode()).hexdigest()
    texts = [md5(1), md5(2).upper(), md5(3)[:31], md5(4) + "0", "0" * 32, "é" * 16, "", "g" * 32, bytes.fromhex(md5(1)).decode("latin-1")]
    parent = spark.createDataFrame([(t, 1) for t in [*texts, texts[0], texts[-1]]] + [(None, 2)], "k string, n int")
    child = spark.createDataFrame([(t, t) for t in [*texts, *texts]] + [(md5(1).upper(), md5(2)), (None, "G" * 32)], "x string, y string")
    other = spark.createDataFrame([(t,) for t in texts[:3]], "k string")
    tables = {"parent": parent, "child": child, "other": other}
    checks = [Q.unique("parent", "k"), Q.unique("parent", "n"), Q.unique("other", "k"), Q.relationships("child", "x", "parent", "k"),
              Q.relationships("child", "y", "parent", "k"), Q.relationships("child", "x", "other", "k"), Q.unique("child", "x")]
    result = Q.run_checks(tables, checks)
    assert sorted(result.collect()) == sorted(Q.run_checks_one_by_one(tables, checks).collect())
    got = {(r["table"], r["column"], r["check"]): r["failures"] for r in result.collect()}
    assert got["parent", "k", "unique"] == 2 and got["child", "y", "relationships"] == 2
    # a uniqueness check with rows of its own does not take the parents' keys
    scope = {"parent": parent.limit(0)}
    got = {(r["table"], r["column"]): r["failures"] for r in Q.run_checks(tables, checks[:1] + checks[3:4], scope).collect()}
    assert got == {("parent", "k"): 0, ("child", "x"): 1}

    stored = "/root/testdata/sf0.001/"
    tables = {t: spark.read.parquet(f"{stored}{t}.parquet") for t in ("orders", "customer", "lineitem")}
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = Q.run_checks(tables, [Q.unique("customer", "c_custkey"), Q.unique("orders", "o_orderkey"),
                                     Q.relationships("orders", "o_orderkey", "customer", "c_custkey"),
                                     Q.relationships("lineitem", "l_orderkey", "orders", "o_orderkey")])
        many.collect()
        plan = many._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(p" in line and ", k" in line]
    assert len([line for line in shuffles if "ReusedExchange" not in line]) == 2 and len(shuffles) == 3
