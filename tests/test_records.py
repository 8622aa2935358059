"""CSV records read in splits, against the reader of the standard library."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from chorale.sources import files, records
from chorale.sources.records import _lines, fixed_splits, header_of, read_records

NASTY = (
    "n,text\n"
    '1,"a ""quoted"" word, and\na break"\n'
    "2,plain\n"
    "\n"
    '3,stray "quotes" in a plain field\n'
    '4,"""starts, with quotes\n\n\nand empty lines"""\n'
    '5,"' + "long line é " * 30 + "\n" * 40 + 'end"\n'
    '6,"1,""2\n7,3"",4"\n'
    '8,""\n'
    '9,"\n"\n'
    "10,' \n"
    '"11","x"\n'
    "12,tail without a line end"
)


def plain(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    return [tuple(r) for r in rows[1:]]


def read(spark, path, split_bytes):
    rows = files.read_csv_splits(spark, str(path), "n STRING, text STRING", split_bytes).orderBy("position")
    return [(r.n, r.text) for r in rows.collect()]


@pytest.mark.parametrize("split_bytes", [7, 24, 61, 150, 1 << 20])
def test_splits_anywhere_give_the_same_records(spark, tmp_path, split_bytes):
    (tmp_path / "a.csv").write_bytes(NASTY.encode())
    assert read(spark, tmp_path, split_bytes) == plain(NASTY)


def test_many_splits_means_many_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(NASTY.encode())
    with fixed_splits(spark, 100):
        assert _lines(spark, str(tmp_path)).rdd.getNumPartitions() == -(-len(NASTY.encode()) // 100)


def test_random_files_in_random_splits(spark, tmp_path):
    rng = random.Random(8)
    expected = []
    for name in "abc":
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
        writer.writerow(["n", "text"])
        for i in range(rng.randint(0, 60)):
            text = "".join(rng.choice(['"', ",", "\n", "é", "x", " ", '""', "\r\n"]) for _ in range(rng.randint(0, 25)))
            writer.writerow([f"{name}{i}", text])
        (tmp_path / f"{name}.csv").write_bytes(out.getvalue().encode())
        expected += plain(out.getvalue())
    for split_bytes in (37, 90, 400):
        assert read(spark, tmp_path, split_bytes) == expected


def test_open_quotes_end_with_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,text\n1,"never closed\n2,x\n')
    (tmp_path / "b.csv").write_text("n,text\n3,y\n")
    assert read(spark, tmp_path, 9) == [("1", "never closed\n2,x"), ("3", "y")]


def test_positions_rise_and_settings_are_put_back(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + NASTY.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    records = read_records(spark, str(tmp_path), 30)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert header_of(records) == ["n", "text"]
    assert records.agg(F.countDistinct("position") == F.count("*")).first()[0]


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,text\n1,x\n")
    (tmp_path / "b.csv").write_text("text,n\n1,x\n")
    with pytest.raises(ValueError, match="headers"):
        read(spark, tmp_path, 1000)


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    texts = [f'{i},"a\n""b"" {"x" * (i % 40)},\n"\n' for i in range(2_000)]
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(texts))
    with records.fixed_splits(spark, 256):
        lines = records._lines(spark, str(tmp_path))
        shared = records._in_tasks(lines, 256)
        assert lines.rdd.getNumPartitions() > 100
        assert shared.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        monkeypatch.setattr(records, "TASK_BYTES", 256 * 20)
        assert spark.sparkContext.defaultParallelism < records._in_tasks(lines, 256).rdd.getNumPartitions() < 20
    found = records.read_records(spark, str(tmp_path), 256).orderBy("position").collect()
    assert [r.record + "\n" for r in found[1:]] == texts
