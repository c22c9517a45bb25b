"""Frequent names in bounded memory against exact counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import physical, tuples
from tarmac.operators import frequent, ranking


def exact(rows, n):
    counts = rows.groupBy("g", "name").agg(F.count("*").alias("flights"))
    return sorted(tuples(ranking.top_n_per_group(counts, "g", "flights", "name", n).select("g", "rank", "name", "flights")))


@pytest.mark.parametrize("limit", [None, 0])
def test_exact_as_long_as_there_are_counters_for_all_names(spark, limit):
    rows = spark.range(20_000).selectExpr("concat('g', id % 200) g", "concat('t', cast(sqrt(id) as int)) name")
    found = frequent.approx_top_n(rows, "g", "name", 5, limit=limit)
    assert sorted(tuples(found.drop("sure"))) == exact(rows, 5)


def test_gaps_above_the_error_are_found_with_few_counters(spark):
    # 40,000 names with one row each beside five frequent ones; 64 counters a group.
    often = " ".join(f"when id % 20 = {k} and id % {k + 2} = 0 then 'often{k}'" for k in range(5))
    rows = spark.range(80_000).selectExpr("concat('g', id % 2) g", f"case {often} else concat('t', id) end name").repartition(16)
    found = frequent.approx_top_n(rows, "g", "name", 1, counters=64)
    assert sorted(tuples(found.drop("sure"))) == exact(rows, 1)
    # Every name with more rows than may be left out is there with its exact count, and marked as sure.
    bound = spark.range(1).select(frequent.most_left_out(F.lit(40_000), 1024)).first()[0]
    some = frequent.approx_top_n(rows, "g", "name", 40, counters=1024).collect()
    true = Counter({(r.g, r.name): r.flights for r in rows.groupBy("g", "name").agg(F.count("*").alias("flights")).collect()})
    heavy = {key for key, n in true.items() if n > bound}
    assert heavy and heavy == {(r.g, r.name) for r in some if r.sure}
    assert all(true[r.g, r.name] == r.flights for r in some)
    assert Counter(r.g for r in some) == {"g0": 40, "g1": 40}


def test_groups_of_many_equal_names_are_filled_up(spark):
    equal = spark.range(200_000).selectExpr("'g' g", "concat('t', id % 20000) name")
    other = spark.createDataFrame([("h", "a"), ("h", "b"), ("h", "b"), (None, "a"), ("h", None)], "g string, name string")
    found = frequent.approx_top_n(equal.unionAll(other), "g", "name", 5, counters=256)
    rows = sorted(tuples(found))
    assert rows == [("g", i, name, 10, False) for i, name in enumerate(["t0", "t1", "t10", "t100", "t1000"], 1)] + [
        ("h", 1, "b", 2, True), ("h", 2, "a", 1, True)
    ]


def test_no_rows(spark):
    assert frequent.approx_top_n(spark.createDataFrame([], "g string, name string"), "g", "name", 3).collect() == []


def test_helper_names_do_not_clash(spark):
    rows = spark.createDataFrame([("x", "a", 1), ("x", "a", 2), ("x", "b", 3)], "name string, group string, total int")
    assert sorted(tuples(frequent.approx_top_n(rows, "name", "group", 1))) == [("x", 1, "a", 2, True)]


def test_tasks_send_summaries_and_candidates_only(spark):
    rows = spark.range(10_000).selectExpr("concat('g', id % 3) g", "concat('t', id) name")
    # Summaries are made below the first exchange, and merged in two steps.
    plan = physical(frequent.summaries(rows, "g", "name"))
    first = plan.rindex("Exchange hashpartitioning(group")
    assert plan.count("Exchange") == 2 and "partial_approx_top_k_accumulate" in plan[first:]
    # Names are looked up below the only exchange of the exact counts.
    candidates = spark.createDataFrame([("g0", "t0")], "group string, name string")
    plan = physical(frequent.exact_counts(rows.toDF("group", "name"), candidates))
    below = plan[plan.index("Exchange hashpartitioning(group") :]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below and "partial_count" in below
