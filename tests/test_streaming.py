from chorale.operators.labeling import build_matcher, label_corpus
from chorale.operators.learning import MessageClassifier, TrainingParams, prepare_labels
from chorale.operators.lexicon import demo_lexicon
from chorale.operators.scoring import assemble_predictions
from chorale.operators.tfidf import TfidfModel, TfidfParams
from chorale.streaming import messages as stream

TEXTS = ["ravi !", "quel gâchis", "lequel ¿ d'où", "rien", None, "l'urne, le cortège"]


def put(spark, path, texts, start):
    rows = [(start + i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "id long, text string").coalesce(1).write.mode("append").json(path)


def test_labels_equal_batch_and_reruns_take_new_files_only(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    matcher = build_matcher(demo_lexicon(spark))

    def run():
        feed = stream.read_messages(spark, source, "id long, text string")
        stream.write_available(stream.label_messages(feed, matcher), out, state).awaitTermination()

    put(spark, source, TEXTS, 0)
    run()
    run()
    put(spark, source, TEXTS, 100)
    run()
    schema = "id long, text string, polarite string, ton string, target string"
    got = spark.read.schema(schema).parquet(out)
    whole = spark.read.schema("id long, text string").json(source)
    expected = label_corpus(whole, demo_lexicon(spark)).collect()
    assert sorted(map(str, got.collect())) == sorted(map(str, expected)) and len(expected) == 12


def test_running_counts(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    put(spark, source, TEXTS, 0)
    seen = {}

    def publish(counts, batch_id):
        seen[batch_id] = {(r.axis, r.label): r["count"] for r in counts.collect()}

    for _ in range(2):
        feed = stream.read_messages(spark, source, "id long, text string")
        labelled = stream.label_messages(feed, build_matcher(demo_lexicon(spark)))
        stream.write_running(stream.running_distribution(labelled), state, publish).awaitTermination()
        put(spark, source, TEXTS, 100)
    last = seen[max(seen)]
    assert last[("polarite", "Favorable")] == 2 and last[("target", "Politique")] == 2
    assert sum(n for (axis, _), n in last.items() if axis == "ton") == 12


def test_predictions_equal_batch(spark, tmp_path):
    texts = ["ravi", "quel gâchis", "chouette", "pénible pénible"] * 20
    df = spark.createDataFrame(
        [(i, t, "Favorable" if i % 2 == 0 else "Défavorable", "Autres" if i % 4 else "Question", "Autre" if i % 3 else "Politique") for i, t in enumerate(texts)],
        "id long, text string, polarite string, ton string, target string",
    )
    prepared = prepare_labels(df)
    space = TfidfModel.fit(prepared, params=TfidfParams(max_features=50))
    model = MessageClassifier.fit(space.features(prepared), TrainingParams(max_iter=4, step=2))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(spark, source, texts[:10], 0)
    feed = stream.read_messages(spark, source, "id long, text string", partitions=2)
    stream.write_available(stream.predict_messages(feed, space, model), out, state, "json").awaitTermination()
    batch = assemble_predictions(
        model.score(space.features(spark.read.schema("id long, text string").json(source))), model.class_arrays()
    )
    got = spark.read.schema(batch.schema).json(out)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() == 10
