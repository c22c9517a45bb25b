from pyspark.sql import functions as F

from helpers import physical, tuples
from tarmac.operators import ranking


def counts(spark, rows):
    return spark.createDataFrame(rows, "g string, name string, n bigint")


def test_top_n_breaks_ties_by_name(spark):
    rows = counts(spark, [("x", "b", 5), ("x", "a", 5), ("x", "c", 9), ("x", "d", 5), ("x", "e", 1)])
    assert [r.name for r in ranking.top_n(rows, "n", ["name"], 3).collect()] == ["c", "a", "b"]
    assert ranking.top_n(rows, "n", ["name"], 100).count() == 5
    assert "TakeOrderedAndProject" in physical(ranking.top_n(rows, "n", ["name"], 3))


def test_top_n_per_group(spark):
    rows = counts(spark, [("x", "b", 5), ("x", "a", 5), ("x", "c", 9), ("y", "z", 1)])
    top = ranking.top_n_per_group(rows, "g", "n", "name", 2)
    assert sorted(tuples(top)) == [("x", "a", 5, 2), ("x", "c", 9, 1), ("y", "z", 1, 1)]


def test_ordered_list_follows_the_rank(spark):
    rows = spark.range(500).selectExpr("concat('g', id % 3) g", "cast(id as string) name", "(id * 7919) % 500 rank")
    listed = ranking.ordered_list(rows.repartition(7), "g", "name", "names").orderBy("g").collect()
    for r in listed:
        members = [i for i in range(500) if f"g{i % 3}" == r.g]
        members.sort(key=lambda i: i * 7919 % 500)
        assert r.names == "[" + ", ".join(map(str, members)) + "]"
    assert [r.g for r in listed] == ["g0", "g1", "g2"]


def test_one_name_lists_alone(spark):
    rows = spark.createDataFrame([("Alpha", "A B", 1)], "g string, name string, rank bigint")
    assert tuples(ranking.ordered_list(rows, "g", "name", "names")) == [("Alpha", "[A B]")]


def test_top_n_per_group_for_large_n(spark):
    rows = spark.range(40_000).selectExpr("concat('g', id % 2) g", "concat('t', id) name", "(id * 7919) % 977 n")
    top = ranking.top_n_per_group(rows, "g", "n", "name", 5000)
    for g in ("g0", "g1"):
        members = [(-(i * 7919 % 977), f"t{i}") for i in range(40_000) if f"g{i % 2}" == g]
        best = [(name, -n) for n, name in sorted(members)[:5000]]
        found = sorted(tuples(top.where(f"g = '{g}'").select("rank", "name", "n")))
        assert found == [(k, *pair) for k, pair in enumerate(best, 1)]
    assert physical(top).count("hashpartitioning(g") == 2
    assert "_pmod" in physical(top) or "pmod(" in physical(top)
