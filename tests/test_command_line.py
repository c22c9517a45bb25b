import pytest

from tarmac.__main__ import run


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "flights.csv").write_text(
        "id,carrier,x,date,x,x,tail,scheduled,x,actual\n"
        "1,AA,-,2004-01-02,-,-,N1,10:00:00,-,10:15:30\n"
        "2,AA,-,2004-01-03,-,-,N1,10:00:00,-,11:20:00,more\n"
        "3,BB,-,2004-01-03,-,-,N2,10:00:00,-,\n"
        "4,BB,-,2003-01-03,-,-,N2,10:00:00,-,10:30:00\n"
        "5,BB,-,2004-01-03,-,-,N2\n"
    )
    (folder / "aircrafts.csv").write_text("tail,x,maker,x,model\nN1,-,CESSNA,-,T210L\nN2,-,CESSNA,-,172N\nN3\n")
    (folder / "airlines.csv").write_text("code,name,country\nAA,Alpha,United States\nBB,Beta,Canada\n")
    return folder


def output(spark, files, tmp_path, report, *options, inputs=("flights", "aircrafts", "airlines")):
    paths = [part for name in inputs for part in (f"--{name}", str(files / f"{name}.csv"))]
    run(spark, [report, *paths, "--output", str(tmp_path / "out"), *options])
    (part,) = (tmp_path / "out").glob("part-*")
    return part.read_text().splitlines()


def test_top_models(spark, files, tmp_path):
    # The flight that ends after its tail number counts here.
    lines = output(spark, files, tmp_path, "top-models", inputs=("flights", "aircrafts"))
    assert lines == ["(Cessna 172,3)", "(Cessna 210,2)"]
    lines = output(spark, files, tmp_path, "top-models", "--n", "1", "--label", "C", inputs=("flights", "aircrafts"))
    assert lines == ["(C172,3)"]


def test_departure_delay(spark, files, tmp_path):
    assert output(spark, files, tmp_path, "departure-delay", "--year", "2004") == ["(Alpha,2,17,15,20)"]
    lines = output(spark, files, tmp_path, "departure-delay", "--year", "2004", "--minutes", "total")
    assert lines == ["(Alpha,2,47,15,80)"]
    lines = output(spark, files, tmp_path, "departure-delay", "--year", "2003", "--country", "Canada")
    assert lines == ["(Beta,1,30,30,30)"]


def test_popular_types(spark, files, tmp_path):
    assert output(spark, files, tmp_path, "popular-types") == ["(Alpha,[CESSNA T210L])", "(Beta,[CESSNA 172N])"]
    assert output(spark, files, tmp_path, "popular-types", "--country", "Canada") == ["(Beta,[CESSNA 172N])"]


def test_ingested_flights(spark, files, tmp_path):
    run(spark, ["ingest-flights", "--flights", str(files / "flights.csv"), "--output", str(tmp_path / "flights")])
    folders = {p.name for p in (tmp_path / "flights").glob("flight_year=*")}
    assert folders == {"flight_year=2003", "flight_year=2004"}
    dimensions = ["--aircrafts", str(files / "aircrafts.csv"), "--airlines", str(files / "airlines.csv")]
    year = ["--year", "2004", "--parquet", "flights", "--output", str(tmp_path / "out")]
    run(spark, ["departure-delay", "--flights", str(tmp_path / "flights"), *dimensions, *year])
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text().splitlines() == ["(Alpha,2,17,15,20)"]


def test_limit_and_replaced_years(spark, files, tmp_path):
    assert output(spark, files, tmp_path, "popular-types", "--limit", "0", "--country", "Canada") == ["(Beta,[CESSNA 172N])"]
    target = ["--output", str(tmp_path / "flights")]
    run(spark, ["ingest-flights", "--flights", str(files / "flights.csv"), *target])
    (tmp_path / "more.csv").write_text("h\n9,CC,-,2004-05-05,-,-,N1,10:00:00,-,10:05:00\n")
    run(spark, ["ingest-flights", "--flights", str(tmp_path / "more.csv"), "--replace", "years", *target])
    rows = spark.read.parquet(str(tmp_path / "flights")).select("carrier_code", "flight_date").collect()
    assert sorted(map(tuple, rows)) == [("BB", "2003-01-03"), ("CC", "2004-05-05")]


def test_year_is_required(spark, files, tmp_path):
    with pytest.raises(SystemExit):
        output(spark, files, tmp_path, "departure-delay")
