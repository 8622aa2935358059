import pytest
from pyspark.sql import functions as F

from chorale.functions import labels
from chorale.operators import evaluation, scoring


def abc():
    return F.array(*map(F.lit, "ABC"))


@pytest.mark.parametrize(
    "p,tones,confidence,flags,best",
    [
        ([0.5, 0.2, 0.9], ["A", "C"], 0.9, [1, 0, 1], "C"),
        ([0.4, 0.2, 0.1], ["Autres"], 0.4, [0, 0, 0], "A"),
        ([0.3, 0.3, 0.3], ["Autres"], 0.3, [0, 0, 0], "A"),
        ([0.1, 0.7, 0.7], ["B", "C"], 0.7, [0, 1, 1], "B"),
    ],
)
def test_decoding(spark, p, tones, confidence, flags, best):
    df = spark.createDataFrame([(p,)], "p array<double>")
    t, c = labels.decode_tones("p", abc())
    row = df.select(t.alias("t"), c.alias("c"), labels.threshold_indicators("p").alias("f"), labels.argmax_label("p", abc()).alias("b")).first()
    assert (row.t, row.c, row.f, row.b) == (tones, confidence, flags, best)


def test_label_values(spark):
    df = spark.createDataFrame([("B; A ;;B",), (None,), ("",), (" ; ",)], "s string")
    listed = [r[0] for r in df.select(labels.split_labels("s")).collect()]
    as_set = [r[0] for r in df.select(labels.label_set("s")).collect()]
    assert listed == [["B", "A", "B"], [], [], []]
    assert as_set == [["A", "B"], [], [], []]
    arrays = spark.createDataFrame([([" b", "a", None, "a"],), (None,)], "s array<string>")
    assert [r[0] for r in arrays.select(labels.label_set("s", True)).collect()] == [["a", "b"], []]


def records(spark):
    df = spark.createDataFrame(
        [(1, "x", [0.2, 0.7, 0.1], [0.6, 0.5, 0.0], [0.1, 0.1, 0.8]), (2, "y", [0.9, 0.1, 0.0], [0.1, 0.2, 0.3], [0.4, 0.4, 0.2])],
        "id long, text string, polariteProb array<double>, tonProb array<double>, targetProb array<double>",
    )
    return scoring.assemble_predictions(df, dict.fromkeys(("polarite", "ton", "target"), abc()))


def test_records_and_statistics(spark):
    rows = [tuple(r) for r in records(spark).orderBy("id").collect()]
    assert rows == [
        (1, "x", "B", 0.7, ["A", "B"], 0.6, "C", 0.8),
        (2, "y", "A", 0.9, ["Autres"], 0.3, "A", 0.4),
    ]
    shares = {(r.axis, r.label): (r["count"], r.total) for r in scoring.prediction_distribution(records(spark)).collect()}
    assert shares[("ton", "Autres")] == (1, 3) and shares[("polarite", "A")] == (1, 2)
    means = scoring.confidence_means(records(spark)).first()
    assert (means.totalPredictions, means.polariteMean, means.tonMean, means.targetMean) == pytest.approx((2, 0.8, 0.45, 0.6))
    nothing = scoring.confidence_means(records(spark).where("id > 5")).first()
    assert tuple(nothing) == (0, 0.0, 0.0, 0.0)


def evaluate(spark, gold, pred):
    n = max(len(gold), len(pred))
    g = spark.createDataFrame(
        [(i, "t", v, v, v) for i, v in enumerate(gold)],
        "id long, text string, polariteGold string, tonGold string, targetGold string",
    )
    p = spark.createDataFrame(
        [(i, "t", ";".join(v), v, ";".join(v)) for i, v in enumerate(pred)],
        "id long, text string, polaritePred string, tonPred array<string>, targetPred string",
    )
    compared = evaluation.compare(g, p)
    counts = evaluation.compared_counts(g, p, compared).first()
    assert tuple(counts) == (len(gold), len(pred), min(len(gold), len(pred)))
    rows = {r.axis: tuple(r)[1:] for r in evaluation.evaluate(compared).collect()}
    assert set(rows) == {"polarite", "ton", "target"} and len(set(rows.values())) == 1
    return rows["ton"]


@pytest.mark.parametrize(
    "gold,pred,expected",
    [
        (["A;B"], [["A"]], (1, 0.5, 2 / 3, 0, 1)),
        (["A", ""], [["A"], []], (1, 1, 1, 1, 0.5)),
        ([""], [[]], (0, 0, 0, 0, 0)),
        (["A"], [["B"]], (0, 0, 0, 0, 0)),
        (["A", None], [["B"], []], (0, 0, 0, 0.5, 0)),
        ([], [], (0, 0, 0, 0, 0)),
        (["B;A", "C"], [["A", "B"]], (1, 1, 1, 1, 1)),
    ],
)
def test_evaluation(spark, gold, pred, expected):
    assert evaluate(spark, gold, pred) == pytest.approx(expected)


def test_duplicate_ids_multiply(spark):
    g = spark.createDataFrame([(1, "A", "A", "A")] * 2, "id long, polariteGold string, tonGold string, targetGold string")
    p = spark.createDataFrame([(1, "A", ["A"], "A")] * 3, "id long, polaritePred string, tonPred array<string>, targetPred string")
    assert evaluation.compare(g, p).count() == 6
    with pytest.raises(ValueError, match="tonGold"):
        evaluation.compare(g.drop("tonGold"), p)


def test_single_label_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    df = spark.createDataFrame(pairs, "t string, p string")
    got = {r.label: tuple(r)[1:] for r in evaluation.classification_report(df, "t", "p").collect()}
    assert got["a"] == pytest.approx((0.75, 0.75, 0.75, 4))
    assert got["b"] == pytest.approx((2 / 3, 1, 0.8, 2))
    assert got["c"] == pytest.approx((0, 0, 0, 1))
    assert got["accuracy"] == (None, None, pytest.approx(5 / 7), 7)
    assert got["macro avg"] == pytest.approx(((0.75 + 2 / 3) / 3, 1.75 / 3, 1.55 / 3, 7))
    assert got["weighted avg"] == pytest.approx(((3 + 4 / 3) / 7, 5 / 7, 4.6 / 7, 7))


def test_multilabel_report(spark):
    rows = [(["a", "b"], ["a"]), (["b"], ["b", "c"]), ([], []), (["a"], [])]
    df = spark.createDataFrame(rows, "t array<string>, p array<string>")
    got = {r.label: tuple(r)[1:] for r in evaluation.multilabel_report(df, "t", "p").collect()}
    assert got["a"] == pytest.approx((1, 0.5, 2 / 3, 2))
    assert got["b"] == pytest.approx((1, 0.5, 2 / 3, 2))
    assert got["c"] == pytest.approx((0, 0, 0, 0))
    assert got["micro avg"] == pytest.approx((2 / 3, 0.5, 4 / 7, 4))
    assert got["macro avg"] == pytest.approx((2 / 3, 1 / 3, 4 / 9, 4))
    assert got["samples avg"] == pytest.approx((1.5 / 4, 1.5 / 4, (2 / 3 * 2) / 4, 4))


def test_report_holds_classes_without_a_row(spark):
    df = spark.createDataFrame([(["a"], ["a"])], "t array<string>, p array<string>")
    rows = {r.label: r for r in evaluation.multilabel_report(df, "t", "p", ["a", "b"]).collect()}
    assert (rows["b"].f1, rows["b"].support) == (0.0, 0)
    assert rows["macro avg"].f1 == 0.5 and rows["micro avg"].f1 == 1.0
