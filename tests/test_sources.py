import gzip
import random

import pytest

from helpers import tuples
from tarmac import columns_from_mask, read_relation
from tarmac.model import AIRCRAFTS, AIRLINES, FLIGHTS, RELATIONS, Relation
from tarmac.sources.lines import lines_below_headers, quoted_records
from tarmac.sources.scratch import scratch_folder


def write(path, *lines, newline="\n"):
    path.write_bytes(newline.join([*lines, ""]).encode())
    return str(path)


def test_masks():
    assert columns_from_mask("0101", ["b", "d"]) == {1: "b", 3: "d"}
    assert columns_from_mask("010000100000", ["carrier_code", "tail_number"]) == {1: "carrier_code", 6: "tail_number"}
    for mask, names in (("01", ["a", "b"]), ("11", ["a"]), ("0x1", ["a"])):
        with pytest.raises(ValueError):
            columns_from_mask(mask, names)
    assert FLIGHTS.positions == {
        1: "carrier_code",
        3: "flight_date",
        6: "tail_number",
        7: "scheduled_departure",
        9: "actual_departure",
    }
    assert AIRCRAFTS.positions == {0: "tail_number", 2: "manufacturer", 4: "model"}
    assert AIRLINES.positions == {0: "carrier_code", 1: "name", 2: "country"}
    assert {r.schema().simpleString() for r in RELATIONS.values()} == {
        "struct<carrier_code:string,flight_date:string,tail_number:string,"
        "scheduled_departure:string,actual_departure:string>",
        "struct<tail_number:string,manufacturer:string,model:string>",
        "struct<carrier_code:string,name:string,country:string>",
    }


def test_lines(spark, tmp_path):
    path = write(
        tmp_path / "airlines.csv",
        "carrier,name,country",
        "AA,American,United States",
        "short,line",
        "x",
        "",
        "LL,long,line,with,more",
        ",,",
        'Q,"q,2",9',
        "  B , b  ,c ",
        "back\\slash,a\\,b",
        "Ü,é,日本",
        "#,not a,comment",
    )
    assert tuples(read_relation(spark, path, AIRLINES)) == [
        ("AA", "American", "United States"),
        ("LL", "long", "line"),
        ("", "", ""),
        ("Q", '"q', '2"'),
        ("  B ", " b  ", "c "),
        ("back\\slash", "a\\", "b"),
        ("Ü", "é", "日本"),
        ("#", "not a", "comment"),
    ]


def test_quotes_do_not_join_fields(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h", '1,x,"q,2",9')
    fields = Relation("fields", dict(enumerate("abcde")))
    assert tuples(read_relation(spark, path, fields)) == [("1", "x", '"q', '2"', "9")]
    assert tuples(read_relation(spark, path, fields, ["a", "d"], quoted=True)) == [("1", "9")]


def test_wanted_columns_decide_which_lines_are_too_short(spark, tmp_path):
    lines = ["h", "0,AA,2,2004-01-01,4,5,N1", "0,BB,2,2004-01-02,4,5,N2,10:00:00,8,10:05:00", "0,CC"]
    path = write(tmp_path / "flights.csv", *lines)
    assert tuples(read_relation(spark, path, FLIGHTS, ["carrier_code", "tail_number"])) == [("AA", "N1"), ("BB", "N2")]
    assert tuples(read_relation(spark, path, FLIGHTS, ["carrier_code"])) == [("AA",), ("BB",), ("CC",)]
    assert tuples(read_relation(spark, path, FLIGHTS)) == [("BB", "2004-01-02", "N2", "10:00:00", "10:05:00")]


def test_result_does_not_depend_on_the_columns_used(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h", "a,b,c", "short,x", "l,m,n,o")
    rows = read_relation(spark, path, AIRLINES)
    assert rows.count() == 2
    assert [r[0] for r in rows.select("carrier_code").collect()] == ["a", "l"]
    assert [r[0] for r in rows.select("country").collect()] == ["c", "n"]


def test_header_of_each_file_is_skipped(spark, tmp_path):
    write(tmp_path / "1.csv", "h,h,h", "a,b,c")
    write(tmp_path / "2.csv", "other,header,line", "d,e,f")
    assert sorted(tuples(read_relation(spark, str(tmp_path), AIRLINES))) == [("a", "b", "c"), ("d", "e", "f")]
    both = [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")]
    assert read_relation(spark, both, AIRLINES).count() == 2


def test_header_is_skipped_once_in_a_file_of_many_splits(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h,h,h", *[f"{i},b,c" for i in range(50_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = read_relation(spark, path, AIRLINES)
        assert rows.rdd.getNumPartitions() > 4
        assert sorted(int(r[0]) for r in rows.collect()) == list(range(50_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_ends_and_compression(spark, tmp_path):
    path = write(tmp_path / "crlf.csv", "h,h,h", "a,b,c", "d,e,", newline="\r\n")
    assert tuples(read_relation(spark, path, AIRLINES)) == [("a", "b", "c"), ("d", "e", "")]
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("h,h,h\na,b,c\n")
    assert tuples(read_relation(spark, str(tmp_path / "z.csv.gz"), AIRLINES)) == [("a", "b", "c")]


def test_quoted(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "h,h,h",
        'AA,"American, Inc.",United States',
        'BB,"",x',
        '"C","d",',
        'short,"a,b"',
        'long,"a,b",c,d',
        "plain,b,c",
    )
    assert tuples(read_relation(spark, path, AIRLINES, quoted=True)) == [
        ("AA", "American, Inc.", "United States"),
        ("BB", "", "x"),
        ("C", "d", ""),
        ("long", "a,b", "c"),
        ("plain", "b", "c"),
    ]


def test_scratch_folder_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first.startswith(f"{shared}/") and first != second


def test_files_without_header_keep_their_first_line(spark, tmp_path):
    lines = ["A1,one,X", "A2,two,Y"]
    (tmp_path / "airlines.csv").write_text("\n".join(lines) + "\n")
    read = read_relation(spark, str(tmp_path), AIRLINES, header=False)
    assert sorted(tuple(r) for r in read.collect()) == [("A1", "one", "X"), ("A2", "two", "Y")]


ODD_LINES = [
    "\0N1,x,y", "a\0b,\0,", "   ", "", "\t", "\x01\x02,\x01,\x1f", "h,h,h", "\ufeffq,w,e", '"', '""', "\ufffe,\uffff,x", "x\x0by,\x0c,\x85",
    ",,", "é,ü,\U0001f600", "\\,\\n,'",
]


def in_splits(spark, size, build):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        rows = build()
        return rows.rdd.getNumPartitions(), tuples(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", ["7", "64", "1m"])
@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_lines_are_those_of_a_line_by_line_reading(spark, tmp_path, size, newline):
    files = {"a": ["h,h,h", *ODD_LINES], "b": ["", "h,h,h", *ODD_LINES * 3], "c": ["only"], "d": ["h,h,h", "h,h,h"], "e": ["  ", *ODD_LINES]}
    for name, lines in files.items():
        (tmp_path / f"{name}.csv").write_bytes(newline.join([*lines, ""]).encode())
    (tmp_path / "f.csv").write_bytes(b"")
    parts, found = in_splits(spark, size, lambda: lines_below_headers(spark, str(tmp_path)))
    assert sorted(x for x, in found) == sorted(x for lines in files.values() for x in lines[1:])
    assert parts > 5 or size == "1m"
    # A column before the first comma is there in every line.
    tails = in_splits(spark, size, lambda: read_relation(spark, str(tmp_path), AIRCRAFTS, ["tail_number"]))[1]
    assert sorted(x for x, in tails) == sorted(x.split(",")[0] for lines in files.values() for x in lines[1:])


def test_a_file_listed_twice_is_read_twice(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h,h,h", "a,b,c")
    assert tuples(read_relation(spark, [path, path], AIRLINES)) == [("a", "b", "c")] * 2


def test_filters_do_not_move_below_the_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", "header without commas", "a,b,c", "d,e,f")
    assert tuples(read_relation(spark, path, AIRLINES).where("carrier_code > 'a'")) == [("d", "e", "f")]
    assert read_relation(spark, path, AIRLINES).count() == 2


def records(content, header):
    """A reading by characters: quotes toggle, a line break outside of them ends a record."""
    found, record, inside = [], "", False
    for c in content:
        inside ^= c == '"'
        if c == "\n" and not inside:
            found.append(record.removesuffix("\r"))
            record = ""
        else:
            record += c
    if record:
        found.append(record.removesuffix("\n").removesuffix("\r") if inside else record.removesuffix("\r"))
    return found[1:] if header else found


@pytest.mark.parametrize("size", ["5", "40", "1m"])
@pytest.mark.parametrize("header", [False, True])
def test_quoted_records_over_line_breaks(spark, tmp_path, size, header):
    draw = random.Random(7)
    contents = ["".join(draw.choices('ab,"\n', weights=[5, 3, 3, 2, 3], k=n)) for n in (0, 1, 30, 200, 1500)]
    contents += ['h,"h\nh"\na,"b\r\nc",d\r\n', 'x,"never closed\n\n\nto the end\n', '"' + "long\n" * 100 + '",z\nq', "\n\n"]
    for i, content in enumerate(contents):
        (tmp_path / f"{i}.csv").write_bytes(content.encode())
    parts, found = in_splits(spark, size, lambda: quoted_records(spark, str(tmp_path), header))
    assert sorted(x for x, in found) == sorted(r for content in contents for r in records(content, header))


def test_quoted_fields_with_line_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h,h,h", 'AA,"American,\nInc.",U', 'BB,"say ""hi""\n\n",x', "short,b", "c,d,e")
    expected = [("AA", "American,\nInc.", "U"), ("BB", 'say "hi"\n\n', "x"), ("c", "d", "e")]
    for size in ("9", "1m"):
        assert sorted(in_splits(spark, size, lambda: read_relation(spark, path, AIRLINES, quoted=True))[1]) == expected
