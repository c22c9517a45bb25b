"""What the physical plans must and must not hold."""

import re

import pytest

from helpers import physical
from tarmac import catalog, departure_delay, popular_types, top_models
from tarmac.sources import read_star

FOLDER = "/root/testdata/sf0.001"
IN_PYTHON = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The relations as parquet tables, as a cluster would keep them."""
    folder = tmp_path_factory.mktemp("tables")
    star = read_star(spark, FOLDER)
    paths = {name: str(folder / name) for name in ("flights", "aircrafts", "airlines")}
    for name, path in paths.items():
        getattr(star, name).write.parquet(path)
    return [spark.read.parquet(path) for path in paths.values()]


# Which line is the first of its file is found by place, for which Python sees one number per line.
FINDS_HEADERS = ["csv_scan", "csv_scan_aircrafts", "csv_scan_airlines"]


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_no_query_runs_python_or_pairs_up_rows(spark, name):
    plan = physical(catalog.queries()[name](spark, FOLDER))
    found = [node for node in [*IN_PYTHON, "CartesianProduct", "BroadcastNestedLoopJoin"] if node in plan]
    assert found == (["ArrowEvalPython"] if name in FINDS_HEADERS else [])
    if name in FINDS_HEADERS:
        [line] = [x for x in plan.splitlines() if "ArrowEvalPython" in x]
        assert "_first_of_run(CASE WHEN" in line and "value#" not in line


def test_top_models(tables):
    f, a, _ = tables
    plan = physical(top_models(f, a, "ECONOMY"))
    assert "TakeOrderedAndProject(limit=3" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ReadSchema: struct<tail_number:string>" in plan
    assert "EqualTo(manufacturer,ECONOMY)" in plan
    # Labels are made on the aircrafts' side: below the exchange that gathers them.
    assert plan.index("regexp_replace") > plan.index("BroadcastExchange")


def test_departure_delay(tables):
    plan = physical(departure_delay(*tables, "1998", "NATION_1"))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert "StringStartsWith(flight_date,1998)" in plan
    assert "StringContains(country,NATION_1)" in plan
    assert plan.count("flight_date:string") == 1
    assert plan.count("hashpartitioning(airline") == 1
    # Times are read once per flight, after the joins.
    assert plan.count("RLIKE(actual_departure") <= 3
    assert len([line for line in plan.splitlines() if "RLIKE" in line]) == 1


@pytest.mark.parametrize("name", ["delayed_flights", "delay_count", "delay_sum", "delay_avg"])
def test_times_are_read_once(spark, name):
    plan = physical(catalog.queries()[name](spark, FOLDER))
    assert len([line for line in plan.splitlines() if "RLIKE" in line]) == 1


def test_popular_types(tables):
    plan = physical(popular_types(*tables))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("BroadcastHashJoin") == 2
    assert "ReadSchema: struct<carrier_code:string,tail_number:string>" in plan
    # One shuffle for the counts, one by airline shared by ranking and list, one for the order.
    assert len(re.findall(r"Exchange hashpartitioning\(airline[^,]*, aircraft_type", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(airline#\d+, \d+\)", plan)) == 1
    assert len(re.findall(r"Exchange rangepartitioning\(airline", plan)) == 1


def test_large_dimensions_meet_totals_only(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(popular_types(*tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
    # The flights' scan lies under a partial and a final total before the first join.
    branch = plan[plan.index("SortMergeJoin", plan.index("SortMergeJoin") + 1) :]
    scan = branch.index("struct<carrier_code:string,tail_number:string>")
    assert branch[:scan].count("HashAggregate(keys=[carrier_code") + branch[:scan].count("HashAggregate(keys=[tail_number") >= 2


def test_generated_code_stays_compilable(spark, tables):
    """The JVM does not compile methods of more than 8000 bytes."""
    star = read_star(spark, FOLDER)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for inputs in (tables, (star.flights, star.aircrafts, star.airlines)):
            for report in (departure_delay(*inputs, "1998", "NATION_1"), popular_types(*inputs)):
                report.createOrReplaceTempView("report")
                code = spark.sql("explain codegen select * from report").first()[0]
                assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", ["departure_delay", "year_filter", "departure_delay_shuffled"])
def test_a_year_reaches_the_scan_of_the_star(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = physical(catalog.queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    [scan] = [line for line in plan.splitlines() if "lineitem" in line]
    pushed = scan[scan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in pushed and "LessThan(l_shipdate,1999-01-01" in pushed
