"""Tables that are stored: safe replacement, buckets, and totals that grow."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import helpers
from helpers import physical, tuples
from tarmac import departure_delay, read_relation, write_flights_by_year, write_tuple_text
from tarmac.model import AIRLINES, FLIGHTS
from tarmac.plans import totals
from tarmac.sources import read_parquet
from tarmac.sources.bucketed import join_in_buckets, read_in_buckets, write_dimension_in_buckets, write_flights_in_buckets


def failing(spark):
    return spark.range(10).select(F.when(F.col("id") < 9, "x").otherwise(F.raise_error(F.lit("broken"))).alias("a"))


@pytest.mark.parametrize("single", [False, True])
def test_a_write_that_fails_leaves_the_old_result(spark, tmp_path, single):
    path = str(tmp_path / "out")
    write_tuple_text(spark.range(5), path, single)
    with pytest.raises(Exception, match="broken"):
        write_tuple_text(failing(spark), path, single)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == [f"({i})" for i in range(5)]
    with pytest.raises(Exception, match="broken"):
        write_flights_by_year(failing(spark).withColumn("flight_date", F.col("a")), path)
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    # A result may be made of what it replaces.
    write_tuple_text(spark.read.text(path), path, single)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == [f"(({i}))" for i in range(5)]


def test_one_ordered_file_of_parts_of_many_tasks(spark, tmp_path):
    n = 2_000_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(n).select(((F.col("id") * 1_000_003) % n).alias("n"))
        write_tuple_text(rows, str(tmp_path / "out"), single_file=True, order_by=["n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "".join(f"({i})\n" for i in range(n))
    # The order comes from ranges, so no task has all rows.
    assert "rangepartitioning" in physical(rows.orderBy("n")) and "SinglePartition" not in physical(rows.orderBy("n"))


def test_an_empty_result_is_an_empty_file(spark, tmp_path):
    write_tuple_text(spark.range(0), str(tmp_path / "out"), single_file=True)
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == ""


def flights(spark, n=3000, hot=3, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        tail = "HOT" if i % hot == 0 else f"N{draw.randrange(40)}"
        actual = draw.choice(["", "10:20:00", "11:30:00", "09:00:00", "10:00:30", "bad", "12:59:59"])
        rows.append((f"C{draw.randrange(4)}", f"{draw.choice([2003, 2004])}-01-0{draw.randrange(1, 9)}", tail, "10:00:00", actual))
    return helpers.flights(spark, rows)


def test_replacing_a_year_leaves_the_files_of_others(spark, tmp_path):
    path = str(tmp_path / "flights")
    f = flights(spark)
    write_flights_by_year(f, path)
    files = lambda year: {p.name: p.stat().st_mtime_ns for p in (tmp_path / "flights" / f"flight_year={year}").glob("part-*")}
    before, old = files(2003), files(2004)
    write_flights_by_year(f.where("flight_date like '2004%' and carrier_code = 'C1'"), path, replace="years")
    assert files(2003) == before and not old.keys() & files(2004).keys()
    expected = f.where("flight_date like '2003%' or carrier_code = 'C1'")
    assert sorted(tuples(read_parquet(spark, path, FLIGHTS).select(*FLIGHTS.columns))) == sorted(tuples(expected))
    with pytest.raises(ValueError):
        write_flights_by_year(f, path, replace="month")


@pytest.mark.parametrize("how", ["inner", "left_semi"])
@pytest.mark.parametrize("hot", [3, 10**9])
def test_joins_in_buckets(spark, tmp_path, how, hot):
    f = flights(spark, hot=hot).unionAll(helpers.flights(spark, [("C1", "2004", None, "", "")]))
    d = spark.range(30).selectExpr("concat('N', id) tail_number", "'m' model", "'replaced' carrier_code")
    d = d.unionAll(spark.sql("values ('HOT', 'a', 'x'), ('HOT', 'b', 'y'), (null, 'c', 'z')"))
    if how == "left_semi":
        d = d.select("tail_number").distinct()
    write_flights_in_buckets(f, str(tmp_path / "f"), "tail_number", 8)
    stored = read_in_buckets(spark, str(tmp_path / "f"))
    assert [k for k, _ in stored.hot] == (["HOT"] if hot == 3 else [])
    write_dimension_in_buckets(d, str(tmp_path / "d"), stored)
    both = join_in_buckets(stored, read_in_buckets(spark, str(tmp_path / "d")), how)
    one = join_in_buckets(stored, d, how)
    facts = f if how == "left_semi" else f.drop("carrier_code")
    plain = facts.join(d, "tail_number", how)
    expected = sorted(map(str, tuples(plain.select(*both.columns))))
    assert sorted(map(str, tuples(both))) == sorted(map(str, tuples(one))) == expected
    plan = physical(both)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    # Another dimension is dealt out to the buckets; the flights stay where they are.
    plan = physical(join_in_buckets(stored, spark.range(9).selectExpr("concat('N', id) tail_number"), how))
    branch = plan[plan.index("SortMergeJoin") :]
    assert branch.count("Exchange hashpartitioning(tail_number") == 1
    assert "Exchange" not in branch[: branch.index("Bucketed: true")]
    # No bucket has much more than its share.
    if hot == 3:
        sizes = [r[1] for r in stored.rows.groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) == 3001 and max(sizes) < 3 * 3001 / 8
    # A dimension in other buckets is joined all the same.
    write_flights_in_buckets(f.where("carrier_code = 'C1'"), str(tmp_path / "g"), "tail_number", 5)
    write_dimension_in_buckets(d, str(tmp_path / "e"), read_in_buckets(spark, str(tmp_path / "g")))
    other = join_in_buckets(stored, read_in_buckets(spark, str(tmp_path / "e")), how)
    assert sorted(map(str, tuples(other.select(*both.columns)))) == expected


@pytest.mark.parametrize("minutes", ["of_hour", "total"])
@pytest.mark.parametrize("known", ["inner", "left_semi"])
def test_states_answer_as_the_flights_do(spark, tmp_path, minutes, known):
    path = str(tmp_path / "states")
    f = flights(spark)
    aircrafts = helpers.aircrafts(spark, [(f"N{i % 25}", "M", "1") for i in range(50)] + [("HOT", "M", "2")])
    airlines = helpers.airlines(spark, [("C0", "Zero", "US"), ("C1", "One", "US"), ("C2", "One", "US"), ("C3", "X", "F"), ("C4", "Y", "US")])
    parts = [f.where(f"carrier_code = 'C{i}'") for i in range(4)]

    def report():
        states = totals.read_states(spark, path)
        return tuples(totals.departure_delay_of_states(states, aircrafts, airlines, "2004", "US", minutes, known))

    done = None
    for i, part in enumerate(parts):
        totals.add_flights(part, path, f"d{i}")
        totals.add_flights(part, path, f"d{i}")
        done = part if done is None else done.unionAll(part)
        expected = departure_delay(done, aircrafts, airlines, "2004", "US", minutes, known, cancelled=True).where("delayed_flights > 0")
        assert report() == tuples(expected)
    assert report() and totals.deliveries(spark, path) == ["d0", "d1", "d2", "d3"]
    before = report()
    totals.merge_deliveries(spark, path)
    assert report() == before and len(totals.deliveries(spark, path)) == 1
    totals.add_flights(parts[0], path, "again")
    twice = departure_delay(f.unionAll(parts[0]), aircrafts, airlines, "2004", "US", minutes, known, cancelled=True)
    assert report() == tuples(twice.where("delayed_flights > 0"))
    # A report reads the states of its year only.
    plan = physical(totals.departure_delay_of_states(totals.read_states(spark, path), aircrafts, airlines, "2004", "US"))
    assert "flight_year" in plan[plan.index("PartitionFilters") :].splitlines()[0]


def test_cancelled_flights_are_counted(spark):
    f = helpers.flights(spark, [
        ("A", "2004-01-01", "N1", "10:00:00", "10:30:00"), ("A", "2004-01-01", "N1", "10:00:00", ""), ("A", "2004-01-01", "N1", "x", "10:30:00"),
        ("B", "2004-01-01", "N1", "10:00:00", None), ("C", "2004-01-01", "N1", "10:00:00", "10:00:00"), ("A", "2003-01-01", "N1", "", ""),
    ])
    a = helpers.aircrafts(spark, [("N1", "M", "1"), ("N1", "M", "1")])
    l = helpers.airlines(spark, [("A", "Alpha", "X"), ("B", "Beta", "X"), ("C", "Gamma", "X")])
    for limit in (None, 0):
        rows = tuples(departure_delay(f, a, l, "2004", "X", limit=limit, cancelled=True))
        assert rows == [("Alpha", 2, 30, 30, 30, 4), ("Beta", 0, None, None, None, 2)]
    assert tuples(departure_delay(f, a, l, "2004", "X", known_aircraft="left_semi", cancelled=True))[0][-1] == 2


def test_dropped_lines_are_counted(spark, tmp_path):
    for k in range(3):
        lines = ["h,h,h", *[f"{i},b,c" if i % 7 else f"{i}" for i in range(10_000)]]
        (tmp_path / f"{k}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        for quoted, header in ((False, True), (False, False), (True, True)):
            seen = Observation()
            rows = read_relation(spark, str(tmp_path), AIRLINES, quoted=quoted, header=header, dropped=seen)
            rows.groupBy("name").count().collect()
            extra = 0 if header else 3
            assert seen.get == {"lines": 30_000 + extra, "dropped": 3 * 1429}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
