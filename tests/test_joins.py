import pytest
from pyspark.sql import functions as F

from helpers import aircrafts, airlines, flights, physical, tuples
from tarmac.operators import joins

NEVER = "-1"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", NEVER)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "setting, size", [("10MB", 10 << 20), ("10485760b", 10 << 20), ("1k", 1024), ("2GB", 2 << 30), ("77", 77), ("-1", -1)]
)
def test_broadcast_limit(spark, setting, size):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
    try:
        assert joins.broadcast_limit(spark) == size
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fit_is_measured(spark):
    def texts(rows, length):
        return spark.range(rows).select(F.lpad(F.col("id").cast("string"), length, "x").alias("k"))

    wide, long, empty = texts(10, 10_000), texts(1000, 1), texts(0, 1)
    assert joins.fit_broadcast([wide, long, empty], 99_000) == [False, True, True]
    assert joins.fit_broadcast([wide, long, empty], 110_000) == [True, True, True]
    assert joins.fit_broadcast([wide, empty], 0) == [False, False]
    # What a filter removes does not count.
    assert joins.fit_broadcast([wide.where("k like '%3'")], 20_000) == [True]
    nulls = spark.range(10).select(F.lit(None).cast("string").alias("k"))
    assert joins.fit_broadcast([nulls], 10_000) == [True]


def test_row_joins(spark):
    f = flights(spark, [("A", "2004", "N1", "", ""), ("A", "2004", "", "", ""), ("B", "2004", "N9", "", ""), (None,) * 5])
    a = aircrafts(spark, [("N1", "CESSNA", "1"), ("N1", "CESSNA", "2"), ("", "X", ""), ("N2", "Y", "3")])
    for limit in (None, 0):
        inner = joins.with_aircraft(f, a, limit=limit).select("carrier_code", "tail_number", "aircraft_type")
        assert sorted(tuples(inner)) == [("A", "", "X "), ("A", "N1", "CESSNA 1"), ("A", "N1", "CESSNA 2")]
        semi = joins.with_aircraft(f, a, how="left_semi", limit=limit)
        assert semi.columns == f.columns
        assert sorted(r.tail_number for r in semi.collect()) == ["", "N1"]
        named = joins.with_airline(f, airlines(spark, [("A", "Alpha", "US")]), limit=limit)
        assert [r.airline for r in named.collect()] == ["Alpha", "Alpha"]


def test_broadcast_when_it_fits(spark):
    f = flights(spark, [("A", "2004", "N1", "", "")])
    a = aircrafts(spark, [("N1", "CESSNA", "1")])
    assert "BroadcastHashJoin" in physical(joins.with_aircraft(f, a))


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_hot_keys_are_cut(spark, no_broadcast, how):
    # A third of the flights belong to one aircraft, another third to two more.
    tails = "case when id % 3 = 0 then 'HOT' when id % 3 = 1 then concat('W', id % 2) else concat('N', id % 1000) end"
    f = spark.range(12_000).selectExpr("cast(id as string) flight", f"{tails} tail_number")
    d = spark.range(1000).selectExpr("concat('N', id) tail_number", "cast(id as string) model")
    d = d.unionAll(spark.sql("values ('HOT', 'a'), ('HOT', 'b'), ('W0', 'c'), (null, 'd')"))
    cut = joins.spread_join(f, d, "tail_number", how)
    plan = physical(cut)
    assert "SortMergeJoin [tail_number" in plan and "piece" in plan
    assert sorted(tuples(cut.select(*sorted(cut.columns)))) == sorted(
        tuples(f.join(d, "tail_number", how).select(*sorted(cut.columns)))
    )
    # A partition's share is 1500 flights. HOT has 4000 and W0 and W1 2000 each, with 4 pieces for each share.
    assert sorted(joins.hot_keys(f, "tail_number")) == [("HOT", 11), ("W0", 6), ("W1", 6)]


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_equal_rows_are_cut_and_kept_whole(spark, no_broadcast, how):
    f = spark.range(9001).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('N', id % 50)) tail_number", "if(id % 2 = 0, 'A', null) carrier_code"
    ).unionAll(spark.sql("select null, 'A' from range(5000)"))
    d = spark.range(40).selectExpr("concat('N', id) tail_number").unionAll(spark.sql("values ('HOT'), ('HOT'), (null)"))
    cut = joins.spread_join(f, d, "tail_number", how)
    keys = ["tail_number", "carrier_code"]
    plain = f.join(d, "tail_number", how)
    assert sorted(map(str, tuples(cut.groupBy(*keys).count()))) == sorted(map(str, tuples(plain.groupBy(*keys).count())))


def test_no_rows_and_no_hot_keys(spark, no_broadcast):
    f = spark.range(100).selectExpr("cast(id as string) tail_number")
    assert joins.hot_keys(f.where("false"), "tail_number") == []
    assert joins.spread_join(f.where("false"), f, "tail_number").count() == 0
    assert "piece" not in physical(joins.spread_join(f, f.select("tail_number"), "tail_number"))


def test_cutting_spreads_the_rows(spark, no_broadcast):
    f = spark.range(16_000).selectExpr("cast(id as string) flight", "if(id % 3 = 0, 'HOT', concat('N', id)) tail_number")
    d = spark.range(16_000).selectExpr("concat('N', id) tail_number").unionAll(spark.sql("select 'HOT'"))
    joined = joins.spread_join(f, d, "tail_number")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joins.spread_join(f, d, "tail_number").groupBy(F.spark_partition_id()).count()
        counts = [r["count"] for r in sizes.collect()]
        plain = [r["count"] for r in f.join(d, "tail_number").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(counts) == sum(plain) == joined.count() == 16_000
    assert max(plain) > 16_000 / 3 > max(counts)


def test_cutting_spreads_equal_rows(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        f = spark.range(16_000).selectExpr("if(id % 3 = 0, 'HOT', concat('N', id)) tail_number", "'S' carrier_code")
        d = spark.range(16_000).selectExpr("concat('N', id) tail_number").unionAll(spark.sql("select 'HOT'"))
        sizes = joins.spread_join(f, d, "tail_number").groupBy(F.spark_partition_id()).count()
        counts = [r["count"] for r in sizes.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(counts) == 16_000
    assert max(counts) < 16_000 / 4


def test_flights_are_read_twice_at_most(spark, no_broadcast, tmp_path):
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, 'HOT', concat('N', id)) tail_number", "'S' carrier_code")
    rows.write.parquet(str(tmp_path / "flights"))
    f = spark.read.parquet(str(tmp_path / "flights"))
    d = spark.sql("values ('HOT'), ('N1') as t(tail_number)")
    spark.sparkContext.setJobGroup("measure", "hot keys")
    try:
        joined = joins.spread_join(f, d, "tail_number")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("measure")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One reading for the hot keys (a job for each stage), one in the join.
    assert len(jobs) <= 2
    assert len([line for line in physical(joined).splitlines() if "FileScan parquet" in line]) == 1


def output_sizes(spark, rows):
    return [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("equal", [False, True])
def test_both_sides_hot(spark, no_broadcast, equal):
    """A key with a third of the flights that is listed 10,000 times."""
    f = spark.range(900).selectExpr("if(id % 3 = 0, 'HOT', concat('N', id % 30)) tail_number", "cast(id as string) flight")
    d = spark.range(30).selectExpr("concat('N', id) tail_number", "'m' model").unionAll(
        spark.range(10_000).selectExpr("'HOT'", "'same'" if equal else "cast(id as string)")
    )
    joined = joins.spread_join(f, d, "tail_number")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = output_sizes(spark, joins.spread_join(f, d, "tail_number"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 300 * 10_000 + 600
    assert max(sizes) <= 2 * sum(sizes) / 8
    plain = f.join(d, "tail_number")
    total = lambda rows: rows.agg(F.count("*"), F.sum(F.xxhash64("tail_number", "flight", "model") % 1_000_003)).first()
    assert tuple(total(joined)) == tuple(total(plain))


def test_grids(spark, no_broadcast):
    f = spark.range(8000).selectExpr("if(id % 2 = 0, 'HOT', concat('N', id)) tail_number")
    once = spark.range(8000).selectExpr("concat('N', id) tail_number").unionAll(spark.sql("select 'HOT'"))
    often = once.unionAll(spark.sql("select 'HOT' from range(999)"))
    assert joins.hot_cells(f, once, "tail_number") == [("HOT", 16, 1)]
    [(key, pieces, slices)] = joins.hot_cells(f, often, "tail_number")
    assert key == "HOT" and slices > 1 and pieces >= 16 and pieces * slices >= 127
    # Hot by what it is joined with alone.
    rare = spark.range(8000).selectExpr("concat('N', id) tail_number")
    listed = rare.unionAll(spark.sql("select 'N5' from range(100000)"))
    [(key, pieces, slices)] = joins.hot_cells(rare, listed, "tail_number")
    assert (key, pieces) == ("N5", 1) and slices > 100


@pytest.mark.parametrize("limit", [None, 0])
def test_no_column_name_clashes(spark, limit):
    names = ["copies", "piece", "pieces", "slice", "row", "listing", "value", "n", "joined", "tail_number piece", "tail_number copies"]
    columns = ["if(id % 3 = 0, 'N1', concat('N', id % 9)) tail_number", "'S1' carrier_code"]
    f = spark.range(90).selectExpr(*columns, *[f"cast(id as string) `{n}`" for n in names], "'flights' model", "'f' country")
    a = spark.range(9).selectExpr("concat('N', id) tail_number", "'M' manufacturer", "concat('m', id) model")
    l = spark.sql("select 'S1' carrier_code, 'Air' name, 'X' country")
    joined = joins.with_airline(joins.with_aircraft(f, a, limit=limit), l, limit=limit)
    assert joined.columns == ["tail_number", "carrier_code", *names, "manufacturer", "model", "aircraft_type", "airline", "country"]
    rows = joined.collect()
    assert len(rows) == 90
    assert all(r.model == f"m{r.tail_number[1:]}" and r.country == "X" and r.copies == r["tail_number piece"] for r in rows)
    assert joins.with_aircraft(f, a, "left_semi", limit).columns == f.columns


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_only_what_spark_does_not_know_to_be_small_is_measured(spark, tmp_path):
    spark.range(500).selectExpr("concat('N', id) tail_number").write.parquet(str(tmp_path / "d"))
    d = spark.read.parquet(str(tmp_path / "d"))
    assert jobs_of(spark, "files", lambda: joins.fit_broadcast([d, d])) == ([True, True], 0)
    # The estimate of a join is a product; a limit of the caller's is always held against the measured size.
    other, third = (d.withColumnRenamed("tail_number", name) for name in ("other", "third"))
    product = d.join(other, F.col("tail_number") == F.col("other")).join(third, F.col("third") == F.col("other"))
    fits, jobs = jobs_of(spark, "join", lambda: joins.fit_broadcast([d, product.select("tail_number")]))
    assert fits == [True, True] and jobs > 0
    fits, jobs = jobs_of(spark, "limit", lambda: joins.fit_broadcast([d], limit=1000))
    assert fits == [False] and jobs > 0
    assert joins.fit_broadcast([d], limit=10**6) == [True] and joins.fit_broadcast([d], limit=0) == [False]
