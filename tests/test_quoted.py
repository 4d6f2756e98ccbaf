"""Quoted line breaks across splits, against the csv module of the standard library and against brute force."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.sources import quoted, readers
from cohortlens.sources.schemas import all_text


def scan(text, inside=False):
    """Whether the end lies inside quotes, character by character; doubled quotes need no rule of their own but adjacency."""
    start, closed = not inside, False
    for c in text:
        if c == '"':
            if inside:
                inside, closed = False, True
            elif start or closed:
                inside, closed = True, False
            start = False
        else:
            closed = False
            start = c == "," and not inside
    return inside


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet='a," \\\r', max_size=12), min_size=1, max_size=40))
def test_state_after_a_line(spark, lines):
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    ends = rows.select("line", *[quoted.ends_inside(F.col("line"), s).alias(str(s)) for s in (False, True)]).collect()
    for r in ends:
        assert (r["False"], r["True"]) == (scan(r["line"]), scan(r["line"], True))


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes, so that records lie across several."""
    keys = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "0"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def field(rng):
    kind = rng.random()
    if kind < 0.2:
        return ""
    if kind < 0.5:
        return "".join(rng.choice("abc d") for _ in range(rng.randint(1, 8))).strip() or "x"
    if kind < 0.9:
        return "".join(rng.choice('ab",\n') for _ in range(rng.randint(1, 30)))
    return "\n".join("line " * rng.randint(0, 9) for _ in range(rng.randint(2, 120)))


def written(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("seed", range(2))
def test_records_across_splits(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    expected = []
    for n in range(3):
        rows = [(f"{n}-{i}", field(rng), field(rng)) for i in range(40)]
        (tmp_path / f"f{n}.csv").write_text(written([("id", "a", "b"), *rows]), encoding="utf-8")
        expected += rows
    path = str(tmp_path / "*.csv")
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    found = readers.read_raw_csv(spark, path, multi_line=True).collect()
    assert sorted(tuple(x or "" for x in r) for r in found) == sorted(expected)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    rows = [(str(i), f'say "{i}"\nand on') for i in range(200)]
    (tmp_path / "a.csv").write_text(written([("id", "t"), *rows]), encoding="utf-8")
    lines = quoted.read_lines(spark, str(tmp_path / "a.csv"))
    assert lines.rdd.getNumPartitions() > 10 and lines.select("file", "start").distinct().count() > 10
    found = readers.read_raw_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert sorted((int(r.id), r.t) for r in found.collect()) == [(i, f'say "{i}"\nand on') for i in range(200)]


def test_split_states_are_those_of_the_text_before(spark, tmp_path, small_splits):
    rng = random.Random(9)
    text = written([("id", "a"), *[(str(i), field(rng)) for i in range(150)]])
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    lines = quoted.read_lines(spark, str(tmp_path / "a.csv"))
    maps = {"from_out": quoted.ends_inside(F.col("line"), False), "from_in": quoted.ends_inside(F.col("line"), True)}
    states = quoted.split_states(lines.withColumns(maps)).collect()
    firsts = {r.start: r.line for r in lines.groupBy("start").agg(F.min_by("line", "place").alias("line")).collect()}
    assert len(states) == len(firsts) > 10 and {r.inside for r in states} == {True, False}
    # A split reads the lines that begin after its first byte; before them the state is that of all text so far.
    for r in states:
        at = 0 if r.start == 0 else text.encode().index(b"\n", r.start - 1) + 1
        inside = False
        for line in text.encode()[:at].decode().splitlines():
            inside = scan(line, inside)
        assert r.inside == inside, r


def test_states_of_splits_put_no_lines_in_order(spark, tmp_path):
    """Only the splits, few, are sorted: no task holds the lines of several of them."""
    (tmp_path / "a.csv").write_text('id,a\n1,"x\ny"\n')
    lines = quoted.read_lines(spark, str(tmp_path / "a.csv"))
    maps = {"from_out": quoted.ends_inside(F.col("line"), False), "from_in": quoted.ends_inside(F.col("line"), True)}
    text = quoted.split_states(lines.withColumns(maps))._jdf.queryExecution().optimizedPlan().toString()
    assert "place" not in "".join(line for line in text.splitlines() if line.lstrip(" :+-").startswith(("Window", "Sort")))


@pytest.mark.parametrize("multi_line", [False, True])
def test_quotes_inside_unquoted_fields_are_plain(spark, tmp_path, multi_line):
    path = tmp_path / "a.csv"
    path.write_text('id,size,note\n1,5" pipe,x\n2,3"x4","a, b"\n3,"6""",\n4,a"b"c,"\n"\n' if multi_line else 'id,size,note\n1,5" pipe,x\n2,3"x4","a, b"\n3,"6""",\n')
    rows = [tuple(r) for r in readers.read_raw_csv(spark, str(path), all_text(("id", "size", "note")), multi_line=multi_line).orderBy("id").collect()]
    assert rows[:3] == [("1", '5" pipe', "x"), ("2", '3"x4"', "a, b"), ("3", '6"', None)]
    assert not multi_line or rows[3] == ("4", 'a"b"c', "\n")


@pytest.mark.parametrize("text", ['a,b\n1,"x\n2,y\n', 'a,b\n1,"x""\n', 'a,b\n"', 'a,b\n1,"x"\n2,"y\n3,"z"\n'])
def test_open_fields_raise(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text('a,b\n1,"fine\nhere"\n')
    (tmp_path / "b.csv").write_text(text)
    inside = False
    for line in text.splitlines():
        inside = scan(line, inside)
    load = lambda: readers.read_raw_csv(spark, str(tmp_path / "*.csv"), all_text("ab"), multi_line=True)
    if inside:
        with pytest.raises(readers.BrokenQuotes, match="b.csv"):
            load()
    else:
        assert load().count() > 1
    with pytest.raises(readers.BrokenQuotes, match="multi_line=True"):
        readers.read_raw_csv(spark, str(tmp_path / "*.csv"), all_text("ab"))


def test_blank_lines_headers_and_carriage_returns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\r\na,"b\r\nb"\r\n\r\n1,"x\r\n\r\ny"\r\n\r\n2\r\n3,4,5,6\r\n')
    (tmp_path / "b.csv").write_bytes(b"a,b\n")
    (tmp_path / "c.csv").write_bytes(b"")
    (tmp_path / "header_file.csv").write_bytes(b"a,b\n7,7\n")
    rows = readers.read_glob(spark, str(tmp_path / "*.csv"), "header_file", all_text("ab"), multi_line=True).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [("1", "x\r\n\r\ny"), ("2", None), ("3", "4")]
