"""Multi-line CSV files that several tasks read, against Python's own reader."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from dispatchlens.schemas import RAW_COLUMNS
from dispatchlens.sources import csv_files, split_csv

HEADER = RAW_COLUMNS["reviews"]


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "300")
    yield
    spark.conf.set(key, before)


def write(path, rows, ending="\n") -> str:
    with path.open("w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=ending).writerows(rows)
    return str(path)


def body(n: int, seed: int = 1) -> list[list[str]]:
    pick = random.Random(seed)
    pieces = ["fine", "\n", '"', ",", "é", "\r\n", "\n\n", ' "so" ', "x" * 40]
    def text():
        return "t" + "".join(pick.choice(pieces) for _ in range(pick.randrange(8))) + "."
    return [[f"r{i}", f"o{i}", "5", text(), text(), "2018-01-01", "2018-01-02"] for i in range(n)]


def read(spark, path) -> list[list[str]]:
    return sorted(list(r) for r in csv_files.load_raw(spark, "reviews", path, split=True).collect())


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_splits, ending):
    rows = body(120)
    path = write(tmp_path / "reviews.csv", [HEADER, *rows], ending)
    splits = split_csv._splits(split_csv._lines(spark, path))
    assert splits.count() > 8 and splits.where("inside").count() > 2
    assert read(spark, path) == sorted(rows)


def test_a_record_may_cross_many_splits(spark, tmp_path, small_splits):
    rows = body(5)
    rows[2][4] = "\n".join(f'line {i} "q"' for i in range(200))
    rows[4][4] = "\n" * 700 + "end"
    path = write(tmp_path / "reviews.csv", [HEADER, *rows])
    assert read(spark, path) == sorted(rows)


def test_lines_joined_by_a_shuffle_give_the_same(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(split_csv, "MOST_BROADCAST", 0)
    rows = body(60, seed=2)
    assert read(spark, write(tmp_path / "reviews.csv", [HEADER, *rows])) == sorted(rows)


def test_same_records_as_the_reader_of_whole_files(spark, tmp_path, small_splits):
    rows = body(40, seed=3)
    rows[3][3] = rows[7][4] = ""
    folder = tmp_path / "reviews"
    folder.mkdir()
    write(folder / "1.csv", [HEADER, *rows[:25]])
    write(folder / "2.csv", [HEADER, *rows[25:]])
    (folder / "3.csv").write_text(",".join(HEADER) + "\n", encoding="utf-8")
    (folder / "4.csv").write_text("﻿" + ",".join(HEADER) + "\n\n\n", encoding="utf-8")
    frames = [csv_files.load_raw(spark, "reviews", str(folder), split=s) for s in (True, False)]
    mine, other = (sorted(map(str, f.na.fill("").collect())) for f in frames)
    assert len(mine) == 40 and mine == other


def test_faulty_files_fail(spark, tmp_path):
    folder = tmp_path / "reviews"
    folder.mkdir()
    write(folder / "1.csv", [HEADER, *body(2)])
    write(folder / "2.csv", [HEADER[::-1], *body(2)])
    with pytest.raises(Exception, match="does not conform"):
        csv_files.load_raw(spark, "reviews", str(folder), split=True).collect()
    short = write(tmp_path / "short.csv", [HEADER, ["r1", "o1"]])
    with pytest.raises(Exception):
        csv_files.load_raw(spark, "reviews", short, split=True).collect()


def test_a_file_without_records(spark, tmp_path):
    path = write(tmp_path / "reviews.csv", [HEADER])
    frame = csv_files.load_raw(spark, "reviews", path, split=True)
    assert frame.columns == HEADER and frame.agg(F.count("*")).first()[0] == 0
