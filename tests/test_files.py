import glob
import json

import pytest

from chorale.operators.corpus import with_row_index
from chorale.sources import files
from chorale.sources.checks import require_columns
from chorale.session import shared_dir, spread

AWKWARD = ['a "b", c', "line\nbreak", " blanks ", "", 'back\\slash "', "é😀;x", "tab\tx", "''"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(AWKWARD)), "id long, text string")
    files.write_csv(df.coalesce(2), str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), files.MESSAGE_SCHEMA).orderBy("id").collect()
    assert [r.text for r in back] == AWKWARD


def test_csv_reads_by_header_name_and_fills_missing_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('likes,text,id\n3,"x ""y""",1\n4,,2\n', encoding="utf-8")
    rows = files.read_csv(spark, str(tmp_path), files.MESSAGE_SCHEMA).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'x "y"'), (2, "")]
    with pytest.raises(ValueError, match="polarite"):
        files.read_csv(spark, str(tmp_path), files.FORMATTED_SCHEMA)


def test_raw_corpus_follows_file_order(spark, tmp_path):
    expected = []
    for part, n in (("a", 40), ("b", 1), ("c", 300), ("d", 0)):
        texts = [f"{part}{i}\nsecond line" for i in range(n)]
        body = "".join(f'{i},"{t}"\n' for i, t in enumerate(texts))
        (tmp_path / f"{part}.csv").write_text("n,text\n" + body, encoding="utf-8")
        expected += texts
    raw = files.read_raw_corpus(spark, str(tmp_path))
    rows = with_row_index(raw, "position").orderBy("id").collect()
    assert [r.text for r in rows] == expected
    assert [r.id for r in rows] == list(range(len(expected)))
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="text"):
        files.read_raw_corpus(spark, str(tmp_path / "x"))


def test_json_lines_keep_accents_and_lists(spark, tmp_path):
    row = (1, "é", "Neutre", 0.5, ["Question", "Autres"], 0.75, "Sécurité", 1.0)
    df = spark.createDataFrame([row], files.PREDICTION_SCHEMA)
    files.write_json_lines(df, str(tmp_path / "p"))
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{tmp_path}/p/*.json"))
    assert "Sécurité" in text and json.loads(text)["tonPred"] == ["Question", "Autres"]
    assert tuple(files.read_predictions(spark, str(tmp_path / "p")).first()) == row


def test_multi_label_cells_are_joined_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, ton array<string>")
    files.write_csv(df, str(tmp_path / "c"))
    assert files.read_csv(spark, str(tmp_path / "c"), "id long, ton string").first().ton == "a;b"


def test_report(spark, tmp_path):
    counts = spark.createDataFrame([("b", 2), ("a", 1)], "label string, count long")
    empty = counts.where("count > 9")
    files.write_report(str(tmp_path / "r"), counts=counts, nothing=empty)
    (part,) = glob.glob(f"{tmp_path}/r/*.json")
    report = json.loads(open(part, encoding="utf-8").read())
    assert report["counts"] == [{"label": "a", "count": 1}, {"label": "b", "count": 2}]
    assert report["nothing"] == [] and report["generatedAt"].count("T") == 1


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(spark.range(1), ["id", "text"], "corpus")


def test_small_inputs_are_spread_and_fine_ones_left_alone(spark):
    one = spark.range(10).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 64)
    assert spread(many) is many


def test_shared_dir_is_stable(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    from chorale.session import shared_dir

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs://name/folder"}
    assert shared_dir(Session()) == "hdfs://name/folder"
