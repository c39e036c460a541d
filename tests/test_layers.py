"""The chained build: every layer written once, and a second run on the same root."""

import pytest
from pyspark.sql import functions as F

from etalage.operators import quality as Q
from etalage.plans.layers import FEEDS, Lakehouse, bronze_feeds
from etalage.queries import GOLD_TESTS, REGISTRY
from etalage.sources import bindings as B
from etalage.sources.io import read_model, write_layer

from conftest import SF_SMALL

STAMPS = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    out = Lakehouse(spark, str(tmp_path_factory.mktemp("lake")), "parquet")
    out.build_all(B.raw_tables(spark, SF_SMALL), B.RAW_TIEBREAK, STAMPS[0])
    return out


def test_build_matches_the_query_and_passes_its_tests(spark, lake):
    fact = lake.read("gold", "fact_sales")
    cols = ["id", "stock", "price", "quantity", "unit", "product_id", "date_id"]
    assert rows(fact.select(cols)) == rows(REGISTRY["lakehouse_build"](spark, SF_SMALL).select(cols))
    tables = {t: lake.read("gold", t) for t in ("dim_category", "dim_picture", "dim_store", "dim_date", "dim_product", "fact_sales")}
    report = Q.test_report(tables, GOLD_TESTS).collect()
    assert len(report) == 17 and {r.status for r in report} == {"pass"}
    assert {r.feed for r in lake.read("silver", "silver").select("feed").distinct().collect()} == set(FEEDS)


def test_second_build_leaves_every_layer_whole(spark, lake):
    names = [("bronze", f) for f in FEEDS] + [("bronze", f"{f}_rejects") for f in FEEDS] + [("silver", "silver"), ("gold", "dim_product"), ("gold", "fact_sales")]
    before = {n: rows(lake.read(*n)) for n in names}
    lake.build_all(B.raw_tables(spark, SF_SMALL), B.RAW_TIEBREAK, STAMPS[1])
    for n in names:
        assert rows(lake.read(*n)) == before[n], n
    snap = lake.read("gold", "dim_product").count()
    versions = lake.snapshot_products("2024-03-01 00:00:00")
    assert versions.count() == snap and versions.filter("valid_to is not null").count() == 0


def test_every_valid_observation_has_a_day_of_its_own(spark, tmp_path):
    """No day is folded onto another, in the bench's build either; the daily rule keeps all rows of a valid picture."""
    import bench

    built, raw = Lakehouse(spark, str(tmp_path), "parquet"), B.raw_tables(spark, SF_SMALL)
    bench.land(built, SF_SMALL)
    for feed in FEEDS:
        assert rows(built.read("landing", feed).groupBy("date").count()) == rows(raw[feed].groupBy("date").count()), feed
    landed = {n: built.read("landing", n) for n in raw}
    bronze = bronze_feeds(landed, B.RAW_TIEBREAK)["auchan"].clean
    valid = landed["auchan"].filter("image_url is not null and lower(image_url) not in ('', 'nan')")
    assert bronze.count() == valid.count() > 5000
    assert valid.groupBy("image_url").agg(F.countDistinct("name").alias("n")).agg(F.max("n")).first()[0] == 2


def test_written_bronze_equals_the_query(spark, lake, tmp_path):
    raw = B.raw_tables(spark, SF_SMALL)
    direct = REGISTRY["bronze_feed_unit_price"](spark, SF_SMALL)
    assert rows(bronze_feeds(raw, B.RAW_TIEBREAK)["carrefour"].clean) == rows(direct)


def test_a_table_is_rebuilt_from_itself_and_survives_a_failed_write(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(5), root, "bronze", "t", "parquet")
    t = read_model(spark, root, "bronze", "t", "parquet")
    write_layer(t.selectExpr("id + 1 as id"), root, "bronze", "t", "parquet")
    assert rows(read_model(spark, root, "bronze", "t", "parquet")) == [(i,) for i in range(1, 6)]
    with pytest.raises(Exception):
        write_layer(spark.range(3).selectExpr("raise_error('lost') as id"), root, "bronze", "t", "parquet")
    assert read_model(spark, root, "bronze", "t", "parquet").count() == 5


def test_writers_at_the_same_time_do_not_meet_and_old_versions_go(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from etalage.sources.io import drop_versions, layer_path, published_versions

    root = str(tmp_path)
    write_layer(spark.range(1), root, "bronze", "t")
    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(lambda k: write_layer(spark.range(10 * k, 10 * k + 5), root, "bronze", "t"), range(4)))
    assert len(set(paths)) == 4
    table = layer_path(root, "bronze", "t")
    assert len(published_versions(spark, table)) == 5
    assert read_model(spark, root, "bronze", "t").count() == 5
    newest = rows(read_model(spark, root, "bronze", "t"))
    assert len(drop_versions(spark, root, "bronze", "t", keep=2)) == 3
    assert len(published_versions(spark, table)) == 2 and rows(read_model(spark, root, "bronze", "t")) == newest


def test_declared_schema_rescues_what_does_not_fit(spark, tmp_path):
    from etalage.sources.io import read_declared

    spark.createDataFrame([(1, "2.5", 7)], "id int, price string, extra int").write.parquet(str(tmp_path / "feed.parquet"))
    df = read_declared(spark, str(tmp_path), "feed", "id bigint, price double, stock double")
    assert [tuple(r) for r in df.collect()] == [(1, 2.5, None, {"extra": "7"})]
    later = [(2**40, 3.5, 9, None, None), (5, 1.0, None, "new", None), (None, None, None, None, None)]
    spark.createDataFrame(later, "id bigint, price double, Stock long, brand string, n int").write.parquet(str(tmp_path / "later.parquet"))
    df = read_declared(spark, str(tmp_path), "later", "id int, price decimal(3,1), stock double")
    assert [(r.id, str(r.price), r.stock, r._rescued) for r in df.collect()] == [
        (None, "3.5", 9.0, {"id": str(2**40)}), (5, "1.0", None, {"brand": "new"}), (None, "None", None, None)]
    rejects = Q.unparsed(df, F.col("_rescued")["id"], "id")
    assert rejects.count() == 1


def test_days_beyond_the_calendar_are_rejected(spark):
    raw = B.raw_tables(spark, SF_SMALL)
    odd = raw["auchan"].limit(3).withColumn("date", F.lit("9999-01-01 00:00:00").cast("timestamp_ntz"))
    raw["auchan"] = raw["auchan"].unionByName(odd)
    feed = bronze_feeds(raw, B.RAW_TIEBREAK, ("2019-01-01", "2030-01-01"))["auchan"]
    assert feed.clean.agg(F.max("date")).first()[0].year < 2030
    assert feed.rejects.filter("column = 'date' and text like '9999%'").count() == 3


def test_zorder_serves_both_keys(spark, tmp_path):
    import pyarrow.parquet as pq

    from etalage.operators.sort import sort_for_write, zorder_for_write

    silver = stored_silver(spark)

    def skipped(df, name):
        """Share of files that a read of one picture, and one of a week, can leave out by min and max."""
        df.write.parquet(str(tmp_path / name))
        spans = []
        for f in (tmp_path / name).glob("*.parquet"):
            g = pq.ParquetFile(f).metadata
            cols = {g.row_group(0).column(i).path_in_schema: [g.row_group(r).column(i).statistics for r in range(g.num_row_groups)] for i in range(g.num_columns)}
            spans.append({c: (min(s.min for s in cols[c]), max(s.max for s in cols[c])) for c in ("image_url", "date")})
        picture = silver.select("image_url").distinct().orderBy("image_url").collect()[11][0]
        days = silver.agg(F.min("date"), F.max("date")).first()
        start = days[0] + (days[1] - days[0]) / 2
        end = start + (days[1] - days[1]) + type(days[1] - days[0])(days=6)
        one = sum(not s["image_url"][0] <= picture <= s["image_url"][1] for s in spans) / len(spans)
        week = sum(s["date"][1] < start or s["date"][0] > end for s in spans) / len(spans)
        return len(spans), one, week

    files, one, week = skipped(zorder_for_write(silver, ["image_url", "date"], 64, bits=6), "z")
    assert files > 40 and one > 0.6 and week > 0.6, (files, one, week)
    _, _, plain = skipped(sort_for_write(silver, ["image_url", "name", "date"], 64), "plain")
    assert plain < 0.4 < week
    assert spark.read.parquet(str(tmp_path / "z")).count() == silver.count()


def stored_silver(spark):
    from etalage.sources.io import stored

    return stored(B.obs_silver(spark, SF_SMALL).select("image_url", "name", "date", "stock"), "silver")
