from helpers import tuples
from tarmac import tuple_lines, write_tuple_text


def test_lines(spark):
    rows = spark.createDataFrame([("X", 3), (None, 0)], "a string, b bigint")
    assert tuples(tuple_lines(rows)) == [("(X,3)",), ("(null,0)",)]


def test_text_replaces_and_keeps_order(spark, tmp_path):
    path = str(tmp_path / "out")
    for size in (500, 200):
        rows = spark.range(size).selectExpr("cast(id as string) a", "(id * 37) % 1000 n").orderBy("n")
        write_tuple_text(rows, path, single_file=True)
    parts = list((tmp_path / "out").glob("part-*"))
    assert len(parts) == 1
    expected = sorted((i * 37 % 1000, i) for i in range(200))
    assert parts[0].read_text().splitlines() == [f"({i},{n})" for n, i in expected]


def test_files_are_in_order_too(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_tuple_text(spark.range(1000).orderBy("id"), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) > 1
    assert [line for p in parts for line in p.read_text().splitlines()] == [f"({i})" for i in range(1000)]


def test_a_single_file_is_sorted_by_its_own_task(spark, tmp_path):
    rows = spark.range(3000).selectExpr("(id * 37) % 3000 n").repartition(9)
    write_tuple_text(rows, str(tmp_path / "out"), single_file=True, order_by=["n"])
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text().splitlines() == [f"({i})" for i in range(3000)]
