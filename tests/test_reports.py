import random
import re
from collections import Counter

import pytest

import brute_force
from benchmarks import naive_forms
from helpers import aircrafts, airlines, flights, physical, tuples
from tarmac import catalog, departure_delay, popular_types, top_models
from tarmac.operators import rollups
from tarmac.operators.joins import fit_broadcast
from tarmac.plans import top_types, type_counts
from tarmac.sources import read_star

FOLDER = "/root/testdata/sf0.001"

# How the joins are made: by the session's limit, shuffled throughout, or only one of the
# dimensions broadcast (the airlines measure about 300 bytes, the aircrafts about 1700).
LIMITS = [None, 0, 900]


def messy_rows(seed):
    """Few distinct values, so that keys repeat on both sides, with a hot aircraft and odd times."""
    pick = random.Random(seed)
    tails = ["", "N1", "N2", "N3", "N4", "N5", "N9"]
    clock = ["", "abc", "10:00", "1:2:3", "25:10:00", "23:50:00", "00:10:00", "10:00:30", "12:34:56x", " 9:05:00"]
    clock += [f"{h:02}:{m:02}:00" for h in (9, 10, 11) for m in (0, 1, 15, 59)]
    dates = ["2004-01-02", "2004-12-31", "2005-01-01", "04", "", "2004"]
    fact = [
        (
            pick.choice(["AA", "AB", "BB", "CC", "ZZ"]),
            pick.choice(dates),
            "N1" if pick.random() < 0.35 else pick.choice(tails),
            pick.choice(clock),
            pick.choice(clock),
        )
        for _ in range(300)
    ]
    fleet = [
        (pick.choice(tails[:-1]), pick.choice(["CESSNA", "BOE%ING", "cessna", ""]), pick.choice(["T210L", "172N", "U1 50X", "T-41A", ""]))
        for _ in range(20)
    ]
    carriers = [
        ("AA", "Alpha", "United States"),
        ("AB", "Alpha", "United States Minor Outlying Islands"),
        ("BB", "Beta, Inc.", "Canada"),
        ("CC", "Gamma", "the United States"),
        ("CC", "Gamma", "the United States"),
    ]
    return fact, fleet, carriers


@pytest.fixture(scope="module", params=[1, 2])
def messy(request, spark):
    rows = messy_rows(request.param)
    frames = tuple(make(spark, r) for make, r in zip((flights, aircrafts, airlines), rows))
    return rows, frames


def test_limits_mix_the_joins(messy):
    _, (_, a, c) = messy
    dimensions = [c.select("carrier_code", "name"), a.select("tail_number", "manufacturer")]
    assert [fit_broadcast(dimensions, limit) for limit in LIMITS] == [[True, True], [False, False], [True, False]]


@pytest.mark.parametrize("limit", LIMITS)
def test_top_models_by_brute_force(messy, limit):
    (f, a, _), (df, da, _) = messy
    for n in (1, 3, 100):
        expected = brute_force.top_models(f, a, "CESSNA", n)
        assert tuples(top_models(df, da, n=n, limit=limit)) == expected


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("minutes", ["of_hour", "total"])
@pytest.mark.parametrize("known", ["inner", "left_semi"])
def test_departure_delay_by_brute_force(messy, limit, minutes, known):
    rows, frames = messy
    expected = brute_force.departure_delay(*rows, "2004", "United States", minutes, known == "left_semi")
    assert expected
    result = departure_delay(*frames, "2004", minutes=minutes, known_aircraft=known, limit=limit)
    assert tuples(result) == expected


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("country", [None, "United States"])
@pytest.mark.parametrize("measure", ["flights", "distinct_tails"])
def test_popular_types_by_brute_force(messy, limit, country, measure):
    rows, frames = messy
    expected = brute_force.popular_types(*rows, country, 5, measure)
    assert tuples(popular_types(*frames, country, measure=measure, limit=limit)) == expected


def test_duplicate_aircraft(spark):
    f = flights(spark, [("A", "2004-01-01", "N1", "10:00:00", "10:05:00"), ("A", "2004-01-01", "N2", "10:00:00", "10:08:00")])
    a = aircrafts(spark, [("N1", "CESSNA", "172")] * 2 + [("N2", "CESSNA", "172")])
    c = airlines(spark, [("A", "Alpha", "United States")])
    assert tuples(top_models(f, a)) == [("Cessna 172", 3)]
    assert tuples(departure_delay(f, a, c, "2004")) == [("Alpha", 3, 6, 5, 8)]
    assert tuples(departure_delay(f, a, c, "2004", known_aircraft="left_semi")) == [("Alpha", 2, 6, 5, 8)]
    assert tuples(type_counts(f, a, c)) == [("Alpha", "CESSNA 172", 3)]
    assert tuples(type_counts(f, a, c, measure="distinct_tails")) == [("Alpha", "CESSNA 172", 2)]


def test_average_is_cut(spark):
    times = [("10:00:00", "10:01:00"), ("10:00:00", "10:02:00")]
    f = flights(spark, [("A", "2004", "N1", *t) for t in times])
    c = airlines(spark, [("A", "Alpha", "United States")])
    assert tuples(departure_delay(f, aircrafts(spark, [("N1", "x", "y")]), c, "2004")) == [("Alpha", 2, 1, 1, 2)]


def test_single_type_and_ties(spark):
    f = flights(spark, [("A", "", t, "", "") for t in ("N1", "N2", "N3")] + [("B", "", "N1", "", "")])
    a = aircrafts(spark, [("N1", "M", "b"), ("N2", "M", "a"), ("N3", "M", "c")])
    c = airlines(spark, [("A", "Alpha", "x"), ("B", "Beta", "x")])
    assert tuples(popular_types(f, a, c, n=2)) == [("Alpha", "[M a, M b]"), ("Beta", "[M b]")]


def test_empty_inputs(spark):
    f, a, c = flights(spark, []), aircrafts(spark, []), airlines(spark, [])
    assert tuples(top_models(f, a)) == []
    assert tuples(departure_delay(f, a, c, "2004")) == []
    assert tuples(popular_types(f, a, c)) == []


def test_choices_are_checked(spark):
    f, a, c = flights(spark, []), aircrafts(spark, []), airlines(spark, [])
    with pytest.raises(ValueError):
        departure_delay(f, a, c, "2004", minutes="hours")
    with pytest.raises(ValueError):
        departure_delay(f, a, c, "2004", known_aircraft="outer")
    with pytest.raises(ValueError):
        popular_types(f, a, c, measure="seats")


def test_report_schemas(spark):
    registered = catalog.queries()
    assert registered["top_models"](spark, FOLDER).dtypes == [("model", "string"), ("flights", "bigint")]
    assert registered["departure_delay"](spark, FOLDER).dtypes == [
        ("airline", "string"),
        ("delayed_flights", "bigint"),
        ("avg_delay", "bigint"),
        ("min_delay", "bigint"),
        ("max_delay", "bigint"),
    ]
    assert registered["popular_types_all"](spark, FOLDER).dtypes == [("airline", "string"), ("aircraft_types", "string")]


def test_plain_forms_agree(spark):
    s = read_star(spark, FOLDER)
    dims = (s.flights, s.aircrafts, s.airlines)
    pairs = [
        (top_models(s.flights, s.aircrafts, "ECONOMY"), naive_forms.top_models(s.flights, s.aircrafts, "ECONOMY")),
        (departure_delay(*dims, "1998", "NATION_1"), naive_forms.departure_delay(*dims, "1998", "NATION_1")),
        (popular_types(*dims), naive_forms.popular_types(*dims)),
        (popular_types(*dims, "NATION_1"), naive_forms.popular_types(*dims, "NATION_1")),
    ]
    for ours, plain in pairs:
        rows = tuples(ours)
        assert rows and rows == tuples(plain)


@pytest.fixture
def tiny_parts(monkeypatch):
    """Tasks may hold no group, and parts have 20 rows each."""
    monkeypatch.setattr(rollups, "GROUPS", 0)
    monkeypatch.setattr(rollups, "ROWS", 20)


@pytest.mark.parametrize("limit", [0, 900])
@pytest.mark.parametrize("measure", ["flights", "distinct_tails"])
def test_dealt_rows_by_brute_force(messy, tiny_parts, limit, measure):
    rows, frames = messy
    expected = brute_force.popular_types(*rows, None, 5, measure)
    assert tuples(popular_types(*frames, measure=measure, limit=limit)) == expected
    f, a, c = rows
    assert tuples(top_models(*frames[:2], limit=limit)) == brute_force.top_models(f, a, "CESSNA", 3)
    delays = brute_force.departure_delay(f, a, c, "2004", "United States", "of_hour", False)
    assert tuples(departure_delay(*frames, "2004", limit=limit)) == delays


def test_null_keys_and_hot_keys_dealt(spark, tiny_parts):
    """Half of the flights are one pair of keys, and others have no key."""
    rows = [("A", "", "N1", "", "")] * 100 + [(c, "", t, "", "") for c in "AB" for t in map("N{}".format, range(50))]
    f = flights(spark, rows + [(None, "", "N1", "", "")] * 30 + [("A", "", None, "", "")] * 30)
    a = aircrafts(spark, [(f"N{i}", "M", str(i % 2)) for i in range(50)] + [(None, "M", "1"), ("N1", "M", "1")])
    c = airlines(spark, [("A", "Alpha", "x"), ("B", None, "x"), (None, "None", "x")])
    counted = {(None, "M 0", 25), (None, "M 1", 26), ("Alpha", "M 0", 25), ("Alpha", "M 1", 226)}
    assert set(tuples(type_counts(f, a, c, limit=0))) == counted
    assert {n for *_, n in tuples(type_counts(f, a, c, measure="distinct_tails", limit=0))} == {25}


@pytest.mark.parametrize("measure", ["flights", "distinct_tails"])
def test_parts_grow_with_the_flights(spark, monkeypatch, measure):
    """What a task holds stays the same: twice the pairs of keys, twice the parts, whatever the session's number is."""
    monkeypatch.setattr(rollups, "GROUPS", 100)
    monkeypatch.setattr(rollups, "ROWS", 100)
    c = spark.range(40).selectExpr("concat('C', id) as carrier_code", "concat('Line ', id) as name", "'x' as country")
    a = spark.range(200).selectExpr("concat('N', id) as tail_number", "'M' as manufacturer", "cast(id as string) as model")
    for number in (3000, 6000):
        f = spark.range(number).selectExpr("concat('C', id % 40) as carrier_code", "concat('N', id div 40) as tail_number")
        counts = type_counts(f, a, c, measure=measure, limit=0)
        plan = physical(counts)
        dealt = re.findall(r"hashpartitioning\((.+?), (\d+)\), REPARTITION_BY_NUM", plan)
        assert [int(n) for _, n in dealt] == [number // 100] * 3
        assert "ENSURE_REQUIREMENTS" not in re.sub(r"hashpartitioning\((carrier_code|tail_number)#[^)]*\), ENSURE_REQUIREMENTS", "", plan)
        assert counts.count() == number
    # Few pairs of keys are added up in each task before they are shuffled.
    f = spark.range(6000).selectExpr("concat('C', id % 4) as carrier_code", "'N1' as tail_number")
    assert "REPARTITION" not in physical(type_counts(f, a, c, measure=measure, limit=0))


@pytest.mark.parametrize("measure", ["flights", "distinct_tails"])
def test_parts_of_ranked_types_grow_with_the_flights(spark, monkeypatch, measure):
    """Types are ranked and listed where they were dealt to, not in as many tasks as the session says."""
    monkeypatch.setattr(rollups, "GROUPS", 100)
    monkeypatch.setattr(rollups, "ROWS", 100)
    c = spark.range(40).selectExpr("concat('C', id) as carrier_code", "concat('Line ', id) as name", "'x' as country")
    a = spark.range(200).selectExpr("concat('N', id) as tail_number", "'M' as manufacturer", "cast(id as string) as model")
    for number in (3000, 6000):
        f = spark.range(number).selectExpr("concat('C', id % 40) as carrier_code", "concat('N', id div 40) as tail_number")
        for n in (3, 2000):
            types = popular_types(f, a, c, n=n, measure=measure, limit=0)
            by_airline = re.findall(r"hashpartitioning\(airline#[^)]*?, (\d+)\), (\w+)", physical(types))
            assert by_airline == [(str(number // 100), "REPARTITION_BY_NUM")] * 2
        assert types.count() == 40


@pytest.mark.parametrize("n", [1, 3, 2000])
@pytest.mark.parametrize("measure", ["flights", "distinct_tails"])
def test_dealt_types_are_ranked_as_a_whole(spark, tiny_parts, measure, n):
    """Half of the carriers share a name, which has many types with equal counts; others have no name or one type."""
    pick = random.Random(7)
    rows = [(f"C{pick.randrange(12)}", "", f"N{pick.randrange(150)}", "", "") for _ in range(1500)]
    rows += [("C12", "", "N7", "", "")] * 3
    names = {f"C{i}": "Shared" if i < 6 else None if i < 8 else f"Line {i}" for i in range(13)}
    f = flights(spark, rows)
    a = aircrafts(spark, [(f"N{i}", "M", f"{i % 100:03}") for i in range(150)])
    c = airlines(spark, [(code, name, "x") for code, name in names.items()])
    used = [(names[code], f"M {int(tail[1:]) % 100:03}", tail) for code, _, tail, _, _ in rows]
    used = used if measure == "flights" else set(used)
    expected = []
    for airline in set(names.values()):
        counts = Counter(kind for name, kind, _ in used if name == airline)
        best = sorted(counts.items(), key=lambda pair: (-pair[1], pair[0]))[:n]
        expected += [(airline, kind, number, rank) for rank, (kind, number) in enumerate(best, 1)]
    found = top_types(f, a, c, n=n, measure=measure, limit=0)
    assert found.columns == ["airline", "aircraft_type", "n", "rank"]
    assert sorted(tuples(found), key=str) == sorted(expected, key=str)
    assert type_counts(f, a, c, measure=measure, limit=0).columns == ["airline", "aircraft_type", "n"]
