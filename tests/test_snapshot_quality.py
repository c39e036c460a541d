"""SCD2 over several loads; data tests; dedup and dimension edge rows."""

from pyspark.sql import functions as F

from etalage.operators import quality as Q
from etalage.operators.dedup import dedup_first
from etalage.operators.snapshot import scd2_replay
from etalage.plans import dims


def batch(spark, d):
    return spark.createDataFrame(list(d.items()), "k string, v long")


def test_scd2_four_loads(spark):
    loads = [{"a": 1, "b": 2}, {"a": 1, "b": 3, "c": 4}, {"a": 1, "c": 4}, {"a": 1, "b": 3, "c": 4}]
    stamps = [f"2024-01-0{i + 1} 00:00:00" for i in range(4)]
    snap = scd2_replay([(t, batch(spark, d)) for t, d in zip(stamps, loads)], "k")
    rows = sorted((r.k, r.v, str(r.valid_from)[:10], str(r.valid_to)[:10] if r.valid_to else None)
                  for r in snap.collect())
    assert rows == [
        ("a", 1, "2024-01-01", None),
        ("b", 2, "2024-01-01", "2024-01-02"),
        ("b", 3, "2024-01-02", "2024-01-03"),
        ("b", 3, "2024-01-04", None),
        ("c", 4, "2024-01-02", None),
    ]


def test_scd2_null_is_not_a_change(spark):
    b1 = spark.createDataFrame([("a", None)], "k string, v long")
    snap = scd2_replay([("2024-01-01 00:00:00", b1), ("2024-01-02 00:00:00", b1)], "k")
    assert snap.count() == 1 and snap.first().valid_to is None


def test_scd2_new_and_missing_columns_and_null_key(spark):
    b1 = spark.createDataFrame([("a", 1, "x"), (None, 5, "y")], "k string, v long, w string")
    b2 = spark.createDataFrame([("a", 1, 7), (None, 5, None)], "k string, v long, z int")
    snap = scd2_replay([("2024-01-01 00:00:00", b1), ("2024-01-02 00:00:00", b2), ("2024-01-03 00:00:00", b2)], "k")
    rows = {(r.k, r.v, r.w, r.z, r.valid_to is None) for r in snap.collect()}
    assert snap.count() == 4
    assert rows == {(None, 5, None, None, True), (None, 5, "y", None, False), ("a", 1, None, 7, True), ("a", 1, "x", None, False)}


STAMPS = [f"2024-01-0{i + 1} 00:00:00" for i in range(6)]
SHOWN = ["k", "v", "valid_from", "valid_to"]


def files(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("part-*")}


def shown(df):
    return sorted(map(tuple, df.select(SHOWN).collect()), key=str)


def replayed(spark, loads):
    return shown(scd2_replay([(t, batch(spark, d)) for t, d in zip(STAMPS, loads)], "k"))


def test_stored_snapshot_rewrites_touched_parts_only(spark, tmp_path):
    from etalage.operators.snapshot import SnapshotTable

    table = SnapshotTable(spark, str(tmp_path), "t", "k", parts=16)
    many = {f"k{i}": i for i in range(200)}
    loads = [many, {**many, "k7": -1}, {**many, "k7": -1}, {k: v for k, v in many.items() if k != "k9"}]
    table.apply(batch(spark, loads[0]), STAMPS[0])
    opened, closed = tmp_path / "snapshots" / "t_open", tmp_path / "snapshots" / "t_closed"
    before = files(opened)
    assert len({f.split("/")[0] for f in before}) == 16
    table.apply(batch(spark, loads[1]), STAMPS[1])  # one key changed: one part is written anew
    after = files(opened)
    assert len({f.split("/")[0] for f, _ in set(before.items()) ^ set(after.items())}) == 1
    history = files(closed)
    assert {f.split("/")[0] for f in history} == {"_run=2"}
    table.apply(batch(spark, loads[2]), STAMPS[2])  # nothing changed: nothing is written
    assert files(opened) == after and files(closed) == history
    table.apply(batch(spark, loads[3]), STAMPS[3])
    assert history.items() <= files(closed).items()
    assert table.runs() == 4 and shown(table.read()) == replayed(spark, loads)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2  # whatever the number of runs


def test_stopped_snapshot_run_is_finished(spark, tmp_path, monkeypatch):
    from etalage.operators.snapshot import SnapshotTable

    loads = [{"a": 1, "b": 2, "c": 3}, {"a": 1, "b": 3}, {"a": 2, "b": 3}, {"a": 2}, {}, {"z": 1}]
    for stop in ("closed", "open"):
        table = SnapshotTable(spark, str(tmp_path / stop), "t", "k", parts=4)
        table.apply(batch(spark, loads[0]), STAMPS[0])
        replace = SnapshotTable._replace

        def lost(self, df, part, column, stop=stop, replace=replace):
            replace(self, df, part, column)
            if part == stop:
                raise RuntimeError("lost")  # after it was written, before the run was marked as done

        monkeypatch.setattr(SnapshotTable, "_replace", lost)
        try:
            table.apply(batch(spark, loads[1]), STAMPS[1])
        except RuntimeError:
            pass
        monkeypatch.undo()
        assert table.runs() == 1
        for load, stamp in list(zip(loads, STAMPS))[2:]:
            table.apply(batch(spark, load) if load else batch(spark, loads[0]).limit(0), stamp)
        assert table.runs() == 6
        snap = scd2_replay([(t, batch(spark, d) if d else batch(spark, loads[0]).limit(0)) for t, d in zip(STAMPS, loads)], "k")
        assert shown(table.read()) == shown(snap)


def test_dense_tests_agree_with_rows(spark):
    import random

    rnd = random.Random(4)
    parent = spark.createDataFrame([(i,) for i in range(1, 70_001)], "id long")
    good = spark.createDataFrame([(rnd.randint(1, 70_000),) for _ in range(3000)] + [(None,)], "id long")
    twice = parent.union(spark.createDataFrame([(5,), (5,), (40_000,), (None,)], "id long"))
    stray = good.union(spark.createDataFrame([(70_001,), (70_001,), (0,), (-3,)], "id long"))
    tables = {"parent": parent, "good": good, "twice": twice, "stray": stray, "none": parent.limit(0)}
    tests = [Q.DataTest(t, "id", "unique", dense=d) for t in tables for d in (False, True)]
    tests += [Q.DataTest(t, "id", "relationships", to=("parent", "id"), dense=d) for t in tables for d in (False, True)]
    tests += [Q.DataTest("good", "id", "relationships", to=("none", "id"), dense=d) for d in (False, True)]
    plain = [(t.name, t.to) for t in tests if not t.dense]
    a = Q.test_report(tables, [t for t in tests if not t.dense]).collect()
    b = Q.test_report(tables, [t for t in tests if t.dense]).collect()
    assert len(a) == len(b) == len(plain) and sorted(map(tuple, a)) == sorted(map(tuple, b))
    got = {r.test: r.failures for r in Q.test_report(tables, [t for t in tests if t.dense][:-1]).collect()}
    assert got["twice.id.unique"] == 2 and got["stray.id.relationships"] == 4 and got["parent.id.unique"] == 0
    assert Q.dense_unique(parent, "id") and not Q.dense_unique(twice, "id")
    # bits are shuffled, not rows
    p = Q._bitmaps(parent, "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in p


def test_row_wise_tests_are_counted_while_a_table_is_written(spark):
    rows = spark.createDataFrame([(1, 5.0), (None, 1.0), (3, None), (None, -2.0)], "k long, v double").repartition(3)
    tests = [Q.DataTest("t", "k", "not_null"), Q.DataTest("t", "v", "at_least", low=2), Q.DataTest("t", "k", "unique"), Q.DataTest("u", "k", "not_null")]
    out, counted = Q.stored_and_counted(rows, "t", tests)
    assert counted == {"t.k.not_null": 2, "t.v.at_least": 2} and out.count() == 4
    report = Q.test_report({"t": out, "u": rows}, tests, counted)
    assert {r.test: r.failures for r in report.collect()} == {"t.k.not_null": 2, "t.v.at_least": 2, "t.k.unique": 0, "u.k.not_null": 2}
    assert Q.stored_and_counted(rows, "x", tests)[1] == {}


def test_brand_and_picture_win_over_null(spark):
    silver = spark.createDataFrame(
        [("f1", 1, "n", None, "c", "s", "img", "st"), ("f2", 1, "n", "brand", "c", "s", "img", "st")],
        "feed string, product_id long, name string, marque string, category string, section string, image_url string, store string")
    imgs = spark.createDataFrame([("st", None), ("st", "pic")], "store string, image_str string")
    sto = dims.dim_store(silver, imgs)
    assert sto.first().image_str == "pic"
    assert dims.dim_product(silver, dims.dim_category(silver), dims.dim_picture(silver), sto).first().marque == "brand"


def test_unique_and_relationships(spark):
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    assert [r.k for r in Q.unique(keys, "k").collect()] == [1]
    child = spark.createDataFrame([(1,), (9,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert [r.k for r in Q.relationships(child, "k", parent, "id").collect()] == [9]
    report = Q.test_report({"t": keys, "p": parent}, [
        Q.DataTest("t", "k", "unique"), Q.DataTest("t", "k", "not_null"), Q.DataTest("t", "k", "at_least", low=2),
        Q.DataTest("t", "k", "relationships", to=("p", "id")), Q.DataTest("p", "id", "unique"), Q.DataTest("p", "id", "not_null")])
    got = {r.test: (r.failures, r.status) for r in report.collect()}
    assert got["t.k.unique"] == (1, "fail") and got["t.k.not_null"] == (2, "fail")
    assert got["t.k.relationships"][1] == "fail" and got["t.k.at_least"][1] == "fail"
    assert got["p.id.unique"] == got["p.id.not_null"] == (0, "pass")


def test_dedup_desc_nulls_last(spark):
    df = spark.createDataFrame([("k", None), ("k", 4), ("k", 9)], "k string, s long")
    assert dedup_first(df, ["k"], [F.col("s").desc_nulls_last()]).first().s == 9


def test_dim_product_uncategorised_keeps_null(spark):
    silver = spark.createDataFrame(
        [(1, "n", None, "c1", "s1", "img", "st"), (1, "n", None, None, "s1", "img", "st")],
        "product_id long, name string, marque string, category string, section string, image_url string, store string",
    )
    cat = dims.dim_category(silver)
    pic = dims.dim_picture(silver)
    sto = dims.dim_store(silver, spark.createDataFrame([("st", "x")], "store string, image_str string"))
    prod = dims.dim_product(silver, cat, pic, sto).collect()
    assert len(prod) == 1 and prod[0].id_category is None


def test_fact_unmatched_products_share_the_null_key(spark):
    import datetime as dt

    from etalage.plans import facts

    d0 = dt.date(2024, 1, 1)
    rows = []
    for pid, pic, stocks in [(1, "a", [5.0, 3.0]), (2, "b", [9.0, 8.0]), (3, "c", [4.0, 7.0])]:
        for i, st in enumerate(stocks):
            rows.append(("f", pid, pic, "n", d0 + dt.timedelta(days=i), 1.0, st, 1.0, 1.0, "g"))
    silver = spark.createDataFrame(
        rows, "feed string, product_id long, image_url string, name string, date date, price double, "
              "stock double, quantity double, price_per_quantity double, unit string")
    dim_product = spark.createDataFrame([(1,)], "product_id long")  # 2 and 3 are missing
    dim_date = spark.createDataFrame([(1, d0), (2, d0 + dt.timedelta(days=1))], "date_id long, date date")
    out = sorted((r.product_id or 0, r.date_id, r.stock, r.id)
                 for r in facts.fact_sales(silver, dim_product, dim_date).collect())
    # NULL product rows collapse to the highest stock per day: 9 on day 1, 8 on day 2
    assert out == [(0, 1, 9.0, 1), (0, 2, 8.0, 2), (1, 1, 5.0, 3), (1, 2, 3.0, 4)]
