"""Split reading of quoted CSV against Spark's reader of whole files, and against Python's csv module."""

import csv
import io
import random

import pytest

from touchledger.sources import landing, split_csv


@pytest.fixture
def ranges(spark):
    """Byte ranges of a few bytes, so that every file is cut within rows, cells and quotes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def use(size):
        for name in names:
            spark.conf.set(name, str(size))
    yield use
    for name in names:
        spark.conf.unset(name)


def text_of(rows, newline="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=newline, quoting=csv.QUOTE_MINIMAL).writerows(rows)
    return out.getvalue()


def land(spark, folder, how):
    return landing.land_raw(spark, str(folder), multi_line=how)["t"].drop(landing.LOADED_AT)


def cell(rng):
    return "".join(rng.choice(["a", "bc", '"', ",", "\n", "\n\n", "é", " ", "\r\n", ""]) for _ in range(rng.randint(0, 6)))


@pytest.mark.parametrize("size", [7, 40, 300])
def test_equal_to_the_one_task_reading(spark, tmp_path, ranges, size):
    rng = random.Random(size)
    rows = [[str(i), "x" + cell(rng), "y" + cell(rng)] for i in range(60)]
    (tmp_path / "t.csv").write_text(text_of([["id", "b", "c"], *rows]), newline="")
    whole = sorted(map(tuple, land(spark, tmp_path, True).collect()))
    assert whole == sorted(map(tuple, rows))
    ranges(size)
    split = land(spark, tmp_path, "split")
    assert split.columns == ["id", "b", "c"] and sorted(map(tuple, split.collect())) == whole


def test_many_tasks_read_one_file(spark, tmp_path, ranges):
    (tmp_path / "t.csv").write_text(text_of([["id", "b"], *[[str(i), "two\nlines"] for i in range(400)]]))
    ranges(500)
    assert split_csv._lines(spark, str(tmp_path / "t.csv")).rdd.getNumPartitions() > 10
    assert land(spark, tmp_path, "split").count() == 400


def test_a_large_file_is_split_by_itself(spark, tmp_path, ranges):
    (tmp_path / "t.csv").write_text(text_of([["id", "b"], *[[str(i), "two\nlines"] for i in range(50)]]))
    assert "from_csv" not in land(spark, tmp_path, True)._jdf.queryExecution().toString()
    ranges(64)
    large = land(spark, tmp_path, True)
    assert "from_csv" in large._jdf.queryExecution().toString() and large.count() == 50


def test_part_files_windows_line_ends_empty_cells_and_blank_lines(spark, tmp_path, ranges):
    parts = tmp_path / "t.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text('a,b\r\n1,""\r\n2,\r\n\r\n3,"x\r\ny"\r\n', newline="")
    (parts / "part-1.csv").write_text('"a",b\n4,"z"', newline="")
    (parts / "part-2.csv").write_text("a,b\n", newline="")
    ranges(5)
    got = sorted(map(tuple, land(spark, tmp_path, "split").collect()))
    assert got == [("1", ""), ("2", None), ("3", "x\r\ny"), ("4", "z")]


@pytest.mark.parametrize("line", ["4,5", "6,7,8,9", '4,"5\n6"', '4,"5\n6",7,8'])
def test_a_short_or_long_row_stops_the_load(spark, tmp_path, ranges, line):
    (tmp_path / "t.csv").write_text(f"x,y,z\n1,2,3\n{line}\n1,2,3\n")
    ranges(6)
    with pytest.raises(Exception, match="MALFORMED"):
        land(spark, tmp_path, "split").collect()


@pytest.mark.parametrize("line", ['4,5" pipe\n6,7" rod', '4,5" by 6"', '4, "5"', '4,"5" x', '4,"5\n6" x', '4,"5\n6",x"y"', '4,"5'])
def test_stray_quotes_stop_the_load(spark, tmp_path, line):
    (tmp_path / "t.csv").write_text(f"x,y\n1,2\n{line}\n1,2\n")
    with pytest.raises(Exception, match="MALFORMED"):
        land(spark, tmp_path, "split").collect()


def test_another_header_stops_the_load(spark, tmp_path):
    parts = tmp_path / "t.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("x,y\n1,2\n")
    (parts / "part-1.csv").write_text("y,x\n4,5\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        land(spark, tmp_path, "split").collect()


def test_a_row_of_too_many_lines_stops_the_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(split_csv, "LONGEST_ROW", 3)
    (tmp_path / "t.csv").write_text('x,y\n1,"a\nb\nc"\n')
    assert land(spark, tmp_path, "split").count() == 1
    (tmp_path / "t.csv").write_text('x,y\n1,"a\nb\nc\nd"\n')
    with pytest.raises(Exception, match="more than 3 lines"):
        land(spark, tmp_path, "split").collect()


def test_a_cell_over_many_ranges_stops_the_load_before_it_is_collected(spark, tmp_path, ranges, monkeypatch):
    (tmp_path / "t.csv").write_text("x,y\n1,2\n" + '3,"' + "line\n" * 200 + '",4\n')
    ranges(40)
    monkeypatch.setattr(split_csv, "LONGEST_ROW", 100)
    found = split_csv._ranges(split_csv._lines(spark, str(tmp_path / "t.csv")))
    with pytest.raises(Exception, match="more than 100 lines"):
        found.collect()


def test_only_rows_of_several_lines_are_brought_together(spark, tmp_path):
    (tmp_path / "t.csv").write_text("x,y\n1,2\n")
    text = land(spark, tmp_path, "split")._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "CartesianProduct", "SortMergeJoin", "BroadcastNestedLoopJoin"):
        assert bad not in text
    assert "collect_list" in text and "_file_block_start" in text.lower() or "file_block_start" in text
