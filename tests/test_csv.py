"""Quoted CSV read in splits, against the reader that takes a file whole; and listings that follow their prefix."""

import random
from collections import Counter

import pytest

from beaconfold.sources.files import csv_records, list_files, read_name_rows

PIECES = ["a", "name", ",", '""', "\n", "\r\n", "\n\n", " ", "é", '"",""', "x" * 30, ',"",', "\n,"]


def quoted_file(rng, rows):
    """Records with and without quotes; stray quotes inside bare fields are characters."""
    lines = ["id,name"]
    for k in range(rows):
        bare = rng.choice(["plain", 'five" screen', "", 'a "b" c', "é", 'x""y'])
        quoted = '"' + "".join(rng.choice(PIECES) for _ in range(rng.randrange(6))) + '"'
        lines.append(f"{k},{rng.choice([bare, quoted, quoted])}{rng.choice(['', ',more'])}")
    return lines


def whole(spark, path):
    """One task a file: Spark's own reader of quoted line breaks."""
    read = spark.read.schema("id string, name string, _raw string").options(header=True, escape='"', multiLine=True, columnNameOfCorruptRecord="_raw")
    return [(int(r.id), r.name or "") for r in read.csv(path).collect()]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_split_files_have_the_rows_of_whole_ones(spark, tmp_path, small_splits, end):
    rng = random.Random(11)
    want = Counter()
    for n in range(3):
        path = tmp_path / f"f{n}.csv"
        text = end.join(quoted_file(rng, 150)) + (end if n else "")
        path.write_bytes(text.encode())
        want.update((path.name, *row) for row in whole(spark, str(path)))
    read = read_name_rows(spark, str(tmp_path), multi_line=True)
    got = read.collect()
    assert Counter((r.key.rsplit("/", 1)[1], r.id, r.name) for r in got) == want
    assert sum("\n" in r.name for r in got) > 50 and sum('"' in r.name for r in got) > 50
    # In file order, over many splits.
    for n in range(3):
        own = sorted((r for r in got if r.key.endswith(f"f{n}.csv")), key=lambda r: r.row_no)
        assert [r.id for r in own] == list(range(150)) and len({r.row_no.block for r in own}) > 10
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 30


def test_a_record_over_several_splits_and_an_open_end(spark, tmp_path, small_splits):
    long = "\n".join(f"line {k}, with commas" for k in range(100))
    (tmp_path / "a.csv").write_text(f'id,name\n1,"{long}"\n\n2,two\n3,"never closed\n4,four\n')
    rows = {r.id: r.name for r in read_name_rows(spark, str(tmp_path), multi_line=True).collect()}
    assert rows.keys() == {1, 2, 3} and rows[1] == long and rows[2] == "two"
    assert "4,four" in rows[3]


def test_headers_alone_and_quoted_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n")
    (tmp_path / "b.csv").write_text('id,"na\nme"\n1,x')
    (tmp_path / "c.csv").write_text("")
    assert [(r.key.rsplit("/", 1)[1], r.record) for r in csv_records(spark, [str(tmp_path)]).collect()] == [("b.csv", "1,x")]


def test_other_prefixes_are_not_opened(spark, tmp_path):
    (tmp_path / "advertiser_x" / "deep").mkdir(parents=True)
    (tmp_path / "advertiser_x" / "deep" / "f.csv").write_text("x")
    (tmp_path / "advertiser_1.csv").write_text("x")
    (tmp_path / "campaign" / "deep").mkdir(parents=True)
    (tmp_path / "campaign" / "deep" / "g.csv").write_text("x")
    # inputFiles is what was listed, before any filter.
    assert len(list_files(spark, str(tmp_path)).inputFiles()) == 3

    def keys(prefix):
        listed = list_files(spark, str(tmp_path), prefix)
        found = {r.key.split(f"{tmp_path}/")[1] for r in listed.collect()}
        assert len(listed.inputFiles()) == len(found)
        return found

    assert keys("advertiser_") == {"advertiser_x/deep/f.csv", "advertiser_1.csv"}
    assert keys("advertiser_x/de") == {"advertiser_x/deep/f.csv"}
    assert keys("nobody_") == set()
    (tmp_path / "odd[1]*{a}").mkdir()
    (tmp_path / "odd[1]*{a}" / "g").write_text("x")
    assert keys("odd[1]*{") == {"odd[1]*{a}/g"}
