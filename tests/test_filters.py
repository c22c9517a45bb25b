import pytest

from helpers import aircrafts, airlines, flights, physical, tuples
from tarmac.model import FLIGHTS
from tarmac.operators import filters
from tarmac.sinks import write_flights_by_year
from tarmac.sources import read_parquet


def test_manufacturer_is_exact(spark):
    rows = aircrafts(spark, [("N1", "CESSNA", "172"), ("N2", "Cessna", "172"), ("N3", "CESSNA ", "1"), ("N4", None, "1")])
    assert [r.tail_number for r in filters.by_manufacturer(rows).collect()] == ["N1"]
    assert [r.tail_number for r in filters.by_manufacturer(rows, "Cessna").collect()] == ["N2"]


def test_country_is_contained(spark):
    names = ["United States", "United States Minor Outlying Islands", "the United States", "united states", "", "US"]
    rows = airlines(spark, [(str(i), "x", c) for i, c in enumerate(names)])
    assert [r.carrier_code for r in filters.by_country(rows).collect()] == ["0", "1", "2"]
    assert filters.by_country(rows, "").count() == len(names)
    assert filters.by_country(rows, "%").count() == 0


@pytest.mark.parametrize("year, matches", [("2004", ["2004-01-02", "2004", "2004x"]), ("04", []), ("20045", []), ("", []), ("200%", [])])
def test_year_is_the_first_four_characters(spark, year, matches):
    dates = ["2004-01-02", "2004", "2004x", "2005-01-01", "04", "12004", "", None]
    rows = flights(spark, [("C", d, "N", "", "") for d in dates])
    assert [r.flight_date for r in filters.by_year(rows, year).collect()] == matches


def test_delayed_adds_the_delay(spark):
    rows = flights(spark, [("C", "2004", "N", "10:00:00", a) for a in ("10:05:00", "11:00:00", "09:00:00", "", None)])
    assert [(r.actual_departure, r.delay) for r in filters.delayed(rows).collect()] == [("10:05:00", 5)]
    assert [r.delay for r in filters.delayed(rows, "total").collect()] == [5, 60]


def test_year_table_reads_one_folder(spark, tmp_path):
    dates = ["2004-01-02", "2004-05-06", "2005-01-01", "2006-01-01", "", "99"]
    rows = flights(spark, [("C", d, f"N{i}", "a", "b") for i, d in enumerate(dates)])
    write_flights_by_year(rows, str(tmp_path / "flights"))
    table = read_parquet(spark, str(tmp_path / "flights"), FLIGHTS)
    assert sorted(tuples(table.select(*FLIGHTS.columns))) == sorted(tuples(rows))
    year = filters.by_year(table, "2004")
    assert sorted(r.tail_number for r in year.collect()) == ["N0", "N1"]
    assert len(year.inputFiles()) < len(table.inputFiles()) or "flight_year" in physical(year)
    scan = next(line for line in physical(year).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(flight_year" in scan


def test_filters_reach_the_scan(spark, tmp_path):
    rows = flights(spark, [("C", "2004-01-01", "N", "a", "b")])
    rows.write.parquet(str(tmp_path / "f"))
    plan = physical(filters.by_year(read_parquet(spark, str(tmp_path / "f"), FLIGHTS, ["flight_date"]), "2004"))
    assert "StringStartsWith(flight_date,2004)" in plan
    assert "ReadSchema: struct<flight_date:string>" in plan
    aircrafts(spark, [("N", "CESSNA", "1")]).write.parquet(str(tmp_path / "a"))
    plan = physical(filters.by_manufacturer(spark.read.parquet(str(tmp_path / "a"))))
    assert "EqualTo(manufacturer,CESSNA)" in plan


def test_a_year_that_is_no_number_on_the_year_table(spark, tmp_path):
    rows = flights(spark, [("C", d, "N", "a", "b") for d in ("2004-01-02", "2005-01-01", "", "99")])
    write_flights_by_year(rows, str(tmp_path / "flights"))
    table = read_parquet(spark, str(tmp_path / "flights"), FLIGHTS)
    for year, n in (("2004", 1), ("abcd", 0), ("200%", 0), ("99", 0)):
        assert filters.by_year(table, year).count() == n
