"""What a query moves, keeps and reads again, and that its rows are the same for it."""

import random
import time

from pyspark.sql import functions as F

from etalage.operators import quality as Q
from etalage.operators.rank import global_rank
from etalage.operators.ranges import range_of, sampled_bounds, with_range
from etalage.operators.sales import estimate_sales
from etalage.operators.series import THROUGH, fill_series, fill_spans
from etalage.operators.sort import interleaved, zorder_for_write
from etalage.plans import feeds as K
from etalage.queries import REGISTRY
from etalage.sources import bindings as B
from etalage.sources.io import SHUFFLES_GO, stored

from conftest import SF_SMALL
from test_plans import keyed_by, plan


def observed(spark):
    rnd = random.Random(8)
    rows = [(f"p{rnd.randint(0, 12)}", f"n{rnd.randint(0, 1)}", rnd.randint(0, 300), float(rnd.randint(0, 50))) for _ in range(900)]
    df = spark.createDataFrame(rows, "image_url string, name string, d int, stock double").dropDuplicates(["image_url", "d"])
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("date")
    return df.select("image_url", "name", day, "stock", *[F.col("stock").alias(c) for c in ("price", "quantity", "price_per_quantity", "unit")])


def test_ranges_are_searched_in_compiled_steps(spark):
    """The search was a higher-order function, interpreted for each row."""
    rows = [(None if i % 7 == 0 else f"k{i % 23}", None if i % 11 == 0 else i % 31, i % 3) for i in range(1500)]
    df = spark.createDataFrame(rows, "a string, b int, c int")
    for ranges in (1, 2, 3, 8, 33, 64):
        bounds = sampled_bounds(df, ["a", "b", "c"], ranges, 1500)
        found = with_range(df, ["a", "b", "c"], bounds, "r")
        assert found.columns == ["a", "b", "c", "r"]
        assert found.filter(~F.col("r").eqNullSafe(range_of(df, ["a", "b", "c"], bounds))).count() == 0
    assert "lambdafunction" not in plan(global_rank(df, ["a", "b", "c"], ranges=8))
    spans = stored(fill_spans(observed(spark), ["image_url", "name"], ["stock", "price", "quantity", "price_per_quantity", "unit"]), "t")
    hot = estimate_sales(spans, series_key=["image_url"], tie_break=["name"], chunks=16, through=THROUGH)
    assert "lambdafunction" not in plan(hot)


def test_zorder_cuts_the_spans_once(spark):
    """a range partitioner cut all spans a second time for its sample."""
    spans = stored(fill_spans(observed(spark), ["image_url", "name"], ["stock"]), "t")
    laid = zorder_for_write(spans, ["image_url", "date"], num_partitions=7, bits=3, date="date", through=THROUGH)
    assert "rangepartitioning" not in plan(laid)
    dense = fill_series(observed(spark), ["image_url", "name"], ["stock"])
    assert sorted(map(tuple, laid.select(dense.columns).collect())) == sorted(map(tuple, dense.collect()))
    parts = [p for p in laid.select("image_url", "date").rdd.glom().collect() if p]
    assert len(parts) > 3 and max(map(len, parts)) < 0.6 * dense.count()
    # a partition runs through 8 x 8 places, a picture's days of a place are in order
    assert all(sum(a.image_url == b.image_url and a.date > b.date for a, b in zip(p, p[1:])) < 64 for p in parts)


def test_interleaved_bits(spark):
    for bits in (1, 3, 8, 11):
        df = spark.range(60).select((F.col("id") * 37 % (1 << bits)).cast("int").alias("a"), (F.col("id") * 11 % (1 << bits)).cast("int").alias("b"))
        for r in df.select("a", "b", interleaved([F.col("a"), F.col("b")], bits).alias("z")).collect():
            assert r.z == sum((r.a >> i & 1) << 2 * i | (r.b >> i & 1) << 2 * i + 1 for i in range(bits))


def test_words_of_ids_are_not_sorted(spark):
    """bitmaps of 32,768 ids had all rows sorted, and a relationship moved every row of the child."""
    fact = spark.createDataFrame([(i, i % 5 if i % 9 else None) for i in range(-70, 400)], "id long, p int")
    p = plan(Q._words(fact, "id"))
    assert "SortAggregate" not in p and "HashAggregate" in p
    assert Q.dense_unique(fact, "id") and not Q.dense_unique(fact.union(fact.limit(1)), "id")
    parent = spark.createDataFrame([(0,), (1,), (1,), (3,)], "p int")
    assert not Q.dense_relationships(fact, "p", parent.distinct(), "p")
    assert Q.dense_relationships(parent, "p", parent.distinct(), "p")
    test = Q.DataTest("fact", "p", "relationships", to=("dim", "p"))
    report = Q.test_report({"fact": fact, "dim": parent}, [test])
    assert report.first().failures == fact.filter("p in (2, 4)").count() > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(report).split("LeftAnti")[-1]
        assert "partial_count" in shown  # rows are counted by key before they move
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert Q.test_report({"fact": fact.filter("p = 1"), "dim": parent}, [test]).first().failures == 0


def test_numbering_a_filled_table_shuffles_written_spans(spark):
    """counting, sampling and numbering each shuffled the observations again."""
    p = plan(fill_series(observed(spark), ["image_url", "name"], ["stock"], id_col="id"))
    assert set(keyed_by(p)) <= {"_range"} and "Scan parquet" in p


def test_stored_frames_leave_no_shuffle_files(spark):
    """they stayed until the driver collected its garbage."""
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if blocks.apply(i).isShuffle()}

    before, kept = shuffles(), spark.conf.get(SHUFFLES_GO, "false")
    df = spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 100).alias("k")).count()
    out, until = stored(df, "t"), time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(SHUFFLES_GO, "false") == kept
    assert out.count() == df.count() == 100  # the frame itself can still be run


def test_stacked_feeds_are_written_one_by_one(spark):
    """what all four feeds shuffle was on the disk at once."""
    for name in ("union_all", "union_pad_missing", "bronze_rejects"):
        assert "Exchange" not in plan(REGISTRY[name](spark, SF_SMALL)), name


def test_rejects_are_listed_for_rows_that_have_some(spark):
    """the list was filtered by an interpreted function for every row."""
    rows = [("2024-01-01", "p1", "1,00 €", "5", 1), ("2024-01-02", "p1", "x €", "n/a", 2), ("soon", "p2", None, " ", 3), (None, "p3", "2 €", None, 4)]
    raw = spark.createDataFrame(rows, "date string, image_url string, price string, quantity_stock string, k int").select(
        "*", F.lit("n").alias("name"), F.lit("m").alias("marque"), F.lit("s").alias("store"))
    cat = spark.createDataFrame([("n", "c")], "product_name string, category string")
    sec = cat.withColumnRenamed("category", "section")
    norm = spark.createDataFrame([("n", "2", "g")], "name string, quantity string, unit string")
    for keep in (False, True):
        feed = K.bronze_feed_norm_left(raw, cat, sec, norm, ["k"], keep=keep)
        assert sorted(map(tuple, feed.rejects.collect())) == [
            ("auchan", 3, "p1", "price", "x €"), ("auchan", 3, "p1", "quantity_stock", "n/a"), ("auchan", 4, "p2", "date", "soon")]
        assert sorted(r.id for r in feed.clean.collect()) == [1, 2, 3]
    assert "Exchange" not in plan(feed.rejects)  # with keep, numbered rows are read by both
    unlisted = K._parsed(raw, "f", ["k"], "image_url", {"name": F.col("name")}, {"price": (F.col("price"), F.col("price").try_cast("double"))})
    p = plan(unlisted[1])
    assert "CASE WHEN" in p.split("filter(array(")[0].splitlines()[-1]


def test_lines_are_shuffled_once_for_days_and_names(spark, tmp_path):
    """Days and names each shuffled the lines. Repeated and odd keys of part multiply as before."""
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    rows = [(i, i % 5 if i % 6 else None, i % 4 if i % 7 else None, i % 3, 1.0, 2.0, "AR"[i % 2], "OF"[i % 3 % 2] if i % 5 else None, None) for i in range(120)]
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(k, f"part {k} {n}", "b", "t", 3, 1.5) for k in (-1, 0, 1, 2, 3, 4, 5, 6, None) for n in range(2 if k == 4 else 1)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(
        f"{tmp_path}/part.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = B.raw_lines(spark, str(tmp_path))
        assert sorted(keyed_by(plan(lines))) == ["l_partkey", "l_suppkey", "n_suppkey", "p_partkey"]
        got = sorted((r.l_orderkey, str(r.name)) for r in lines.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = []
    for k, part, sup, *_, status, _ in rows:
        wanted = None if sup is None else 2 * sup - (status == "O")
        names = [n for p, n, *_ in parts if p is not None and p == wanted] or [None]
        want += [(k, str(n)) for n in names for _ in range(2 if part == 4 else 1)]
    assert got == sorted(want)
