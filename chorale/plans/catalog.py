"""The registered queries: each operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chorale.functions.labels import argmax_label, decode_tones, label_set, split_labels, threshold_indicators
from chorale.functions.text import char_ngrams, normalize_text, spaced_line, strip_accents, word_count
from chorale.operators import corpus, evaluation, labeling, learning, sampling, scoring, tfidf
from chorale.operators.lexicon import demo_lexicon
from chorale.plans.inputs import documents, messages, table, turns
from chorale.plans.workflow import Workflow, evaluate_files, read_evaluation
from chorale.session import scratch_path, shared_dir, small_batches, spread
from chorale.sources import files
from chorale.sources.checks import audited_write
from chorale.streaming import batches
from chorale.streaming import messages as stream

Query = Callable[[SparkSession, str], DataFrame]

GOLD_SQL = """
SELECT doc_id AS id,
       CASE WHEN quality = 1 THEN 'Favorable' WHEN toxic = 1 THEN 'Défavorable' ELSE 'Neutre' END AS polariteGold,
       CASE WHEN toxic = 1 AND quality = 1 THEN 'Ironique; Question;' WHEN quality = 1 THEN 'Informatif'
            WHEN toxic = 1 THEN 'Question' END AS tonGold,
       CASE WHEN doc_id % 7 = 0 THEN 'Education' WHEN toxic = 1 THEN 'Politique' ELSE 'Autre' END AS targetGold
FROM labels
"""
PREDICTED_SQL = """
SELECT doc_id AS id,
       CASE WHEN n_chars % 4 = 0 THEN 'Défavorable' WHEN n_chars % 4 = 1 THEN 'Neutre' ELSE 'Favorable' END AS polaritePred,
       CASE WHEN n_chars % 3 = 0 THEN 'Informatif; Question' WHEN n_chars % 3 = 1 THEN 'Informatif' ELSE '' END AS tonPred,
       CASE WHEN lang = 'en' THEN 'Autre' WHEN lang = 'fr' THEN 'Education' ELSE 'International' END AS targetPred
FROM documents
"""


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    frames = {n: table(spark, sf_dir, n) for n in ("labels", "documents") if f"FROM {n}" in text}
    return spark.sql(text.replace("FROM ", "FROM {").rstrip() + "}", **frames)


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, GOLD_SQL)


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, PREDICTED_SQL)


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.compare(_gold(spark, sf_dir), _predicted(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeling.label_corpus(messages(spark, sf_dir), demo_lexicon(spark))


# --- text -------------------------------------------------------------------


def normalize_messages(spark, sf_dir):
    return messages(spark, sf_dir).select("id", normalize_text("text").alias("text"))


def normalize_turns(spark, sf_dir):
    return turns(spark, sf_dir).select("id", normalize_text("text").alias("text"))


def normalize_pages(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select(
        F.col("page_id").alias("id"),
        normalize_text(F.concat_ws(" ", "url", "html")).alias("text"),
    )


def fold_accents(spark, sf_dir):
    return documents(spark, sf_dir).select("id", strip_accents(F.col("text")).alias("text"))


# --- corpus -----------------------------------------------------------------


def row_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return corpus.with_row_index(events, "event_id", "row_id", "n_rows")


def formatted_corpus(spark, sf_dir):
    return corpus.format_corpus(messages(spark, sf_dir), "id")


def positional_split(spark, sf_dir):
    return corpus.split_corpus(messages(spark, sf_dir), "id")


def corpus_report_raw(spark, sf_dir):
    return corpus.corpus_report(messages(spark, sf_dir), "messages")


def corpus_report_formatted(spark, sf_dir):
    return corpus.corpus_report(normalize_turns(spark, sf_dir), "turns")


def message_sizes(spark, sf_dir):
    return messages(spark, sf_dir).select(
        "id", F.length("text").alias("chars"), word_count("text").alias("words")
    )


def vocabulary_size(spark, sf_dir):
    return corpus.vocabulary_size(documents(spark, sf_dir))


def vocabulary_estimate(spark, sf_dir):
    """Vocabulary size from stored sketches of the languages: whether the merged estimate is within 2 % of the count."""
    path = scratch_path(spark, "sketches")
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    corpus.vocabulary_sketches(docs, "lang").write.parquet(path)
    merged = corpus.merged_vocabulary(spark.read.parquet(path))
    exact = corpus.vocabulary_size(documents(spark, sf_dir))
    size = exact.columns[0]
    return exact.select(
        F.col(size).alias("vocabSize"),
        (F.abs(merged.scalar() - F.col(size)) <= F.col(size) * 0.02).alias("within"),
    )


def audited_input(spark, sf_dir):
    """Rows, nulls and unknown labels of the gold table, counted while it is written."""
    rows = _gold(spark, sf_dir).withColumn("text", F.when(F.col("id") % 5 > 0, F.repeat(F.lit(" "), (F.col("id") % 3).cast("int"))))
    labels = {"polariteGold": ["Favorable", "Neutre"], "tonGold": ["Informatif", "Question"]}
    return audited_write(rows, scratch_path(spark, "audited"), labels=labels).drop("distinct_ids")


# --- weak labelling ---------------------------------------------------------


def label_scores(spark, sf_dir):
    scored = labeling.score_corpus(messages(spark, sf_dir), demo_lexicon(spark))
    return labeling.score_rows(scored)


def label_scores_joined(spark, sf_dir):
    scored = labeling.score_corpus(messages(spark, sf_dir), demo_lexicon(spark), inline_terms=0)
    return labeling.score_rows(scored)


def label_scores_large(spark, sf_dir):
    """Documents scored with thousands of terms: all words and pairs of words of the conversations."""
    clean = turns(spark, sf_dir).select(normalize_text("text").alias("line"))
    found = F.regexp_extract_all("line", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    gaps = F.split("line", r"[\p{L}\p{N}_]+")
    words = clean.select(found.alias("words"), F.slice(gaps, 2, F.size(found)).alias("gaps"))
    following = F.slice("words", 2, F.greatest(F.size("words"), F.lit(1)))
    pairs = F.filter(
        F.arrays_zip(F.col("words").alias("a"), following.alias("b"), F.col("gaps").alias("gap")),
        lambda p: (p["gap"] == " ") & p["b"].isNotNull(),
    )
    terms = words.select(F.explode(F.concat("words", F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"])))).alias("term"))
    even = F.length("term") % 2 == 0
    lexicon = terms.distinct().select(
        F.when(even, "polarite").otherwise("target").alias("family"),
        F.when(even, "Favorable").otherwise("Politique").alias("label"),
        F.lit(0).alias("label_pos"),
        F.lit(1).alias("priority"),
        "term",
    )
    return labeling.score_rows(labeling.score_corpus(documents(spark, sf_dir), lexicon))


def labelled_messages(spark, sf_dir):
    return _labelled(spark, sf_dir).select("id", "polarite", "ton", "target")


def labelled_turns(spark, sf_dir):
    labelled = labeling.label_corpus(turns(spark, sf_dir), demo_lexicon(spark))
    return labelled.select("id", "polarite", "ton", "target")


def label_distribution(spark, sf_dir):
    return labeling.label_distribution(_labelled(spark, sf_dir)).withColumn(
        "percentage", F.round("percentage", 6)
    )


# --- TF-IDF -----------------------------------------------------------------


def term_counts(spark, sf_dir):
    return tfidf.term_counts(turns(spark, sf_dir))


def tfidf_weights_joined(spark, sf_dir):
    """The same weights by the plan for vocabularies of any size."""
    rows = _space(spark, sf_dir).weight_rows(turns(spark, sf_dir), inline_vocabulary=0)
    return rows.withColumn("weight", F.round("weight", 6))


def filtered_labels(spark, sf_dir):
    """Messages of one polarity: a filter on a label column."""
    labelled = _labelled(spark, sf_dir).where("polarite = 'Favorable'")
    return labelled.select("id", "polarite", "ton", "target")


def ngram_totals(spark, sf_dir):
    lines = documents(spark, sf_dir).select("id", spaced_line("text").alias("line"))
    small_batches(spark)
    grams = lines.select("id", char_ngrams("line", counted=True).alias("grams"))
    return grams.select(
        "id",
        F.aggregate("grams.counts", F.lit(0).cast("long"), lambda a, n: a + n).cast("int").alias("ngrams"),
        F.size("grams.terms").alias("distinct_ngrams"),
    )


def tfidf_vocabulary(spark, sf_dir):
    return tfidf.fit_vocabulary(documents(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


def _space(spark, sf_dir):
    return tfidf.TfidfModel.fit(documents(spark, sf_dir))


def tfidf_weights(spark, sf_dir):
    """The space learned on the documents, applied to the conversation turns."""
    rows = _space(spark, sf_dir).weight_rows(turns(spark, sf_dir))
    return rows.withColumn("weight", F.round("weight", 6))


def tfidf_profile(spark, sf_dir):
    """Every document in the space: number of terms, sum and maximum of the weights."""
    weighed = _space(spark, sf_dir).weigh(documents(spark, sf_dir))
    return weighed.select(
        "id",
        F.size("weights").alias("terms"),
        F.round(F.aggregate("weights", F.lit(0.0), lambda a, w: a + w), 6).alias("total"),
        F.round(F.coalesce(F.array_max("weights"), F.lit(0.0)), 6).alias("highest"),
    )


def tfidf_vectors(spark, sf_dir):
    """ML vectors of the turns, unpacked again."""
    v = F.unwrap_udt("features")
    model = _space(spark, sf_dir)
    return model.features(turns(spark, sf_dir)).select(
        "id",
        v["size"].alias("size"),
        F.size(v["indices"]).alias("entries"),
        F.round(F.aggregate(v["values"], F.lit(0.0), lambda a, w: a + w * w), 6).alias("squared_length"),
    )


def stored_vocabulary(spark, sf_dir):
    """A vocabulary learned on the turns, saved and loaded."""
    path = scratch_path(spark, "stored-vocabulary")
    tfidf.TfidfModel.fit(turns(spark, sf_dir)).save(path)
    loaded = tfidf.TfidfModel.load(spark, path).vocabulary
    return loaded.withColumn("idf", F.round("idf", 6))


# --- label preparation and splits -------------------------------------------


def label_lists(spark, sf_dir):
    return _gold(spark, sf_dir).select(
        "id",
        F.concat_ws("|", split_labels("tonGold")).alias("listed"),
        F.concat_ws("|", label_set("tonGold")).alias("as_set"),
    )


def prepared_labels(spark, sf_dir):
    raw = _gold(spark, sf_dir).select(
        "id",
        F.lit("").alias("text"),
        F.when(F.col("polariteGold") != "Neutre", F.col("polariteGold")).alias("polarite"),
        F.col("tonGold").alias("ton"),
        F.when(F.col("targetGold") != "Autre", F.col("targetGold")).otherwise("").alias("target"),
    )
    prepared = learning.prepare_labels(raw)
    indexed = learning.class_indexer(prepared, "polarite").transform(prepared)
    return learning.tone_indicators(indexed).select(
        "id",
        "polarite",
        "target",
        F.col("polariteIndex").cast("int").alias("polarite_index"),
        F.concat_ws("", F.transform("tonIndicators", lambda x: x.cast("string"))).alias("tone_flags"),
    )


def stratified_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.stratified_split(docs, "lang", "doc_id").select("doc_id", "lang", "is_test")


def validation_tail(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sampling.validation_tail(docs, "doc_id").select("doc_id", "is_validation")


# --- scoring ----------------------------------------------------------------

CLASS_COUNT = 64


def _probabilities(spark, sf_dir):
    """Embedding components stand in for class scores; they are whole vectors."""
    scores = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("label").cast("string").alias("text"),
        scores.alias("polariteProb"),
        scores.alias("tonProb"),
        F.reverse(scores).alias("targetProb"),
    )


def _class_names():
    return F.array(*[F.lit(f"c{i:02d}") for i in range(CLASS_COUNT)])


def _records(spark, sf_dir):
    names = dict.fromkeys(("polarite", "ton", "target"), _class_names())
    return scoring.assemble_predictions(_probabilities(spark, sf_dir), names, threshold=0.25)


def prediction_records(spark, sf_dir):
    rounded = {c: F.round(c, 6) for c in ("polariteAcc", "tonAcc", "targetAcc")}
    return _records(spark, sf_dir).withColumns({"tonPred": F.concat_ws(";", "tonPred"), **rounded})


def prediction_distribution(spark, sf_dir):
    return scoring.prediction_distribution(_records(spark, sf_dir)).withColumn(
        "percentage", F.round("percentage", 6)
    )


def confidence_means(spark, sf_dir):
    means = scoring.confidence_means(_records(spark, sf_dir))
    return means.select(
        "totalPredictions",
        *[F.round(c, 6).alias(c) for c in ("polariteMean", "tonMean", "targetMean")],
    )


def threshold_flags(spark, sf_dir):
    """Plain threshold and threshold with fallback, side by side."""
    flags = threshold_indicators("tonProb", 0.25)
    tones, _ = decode_tones("tonProb", _class_names(), 0.25)
    return _probabilities(spark, sf_dir).select(
        "id",
        F.aggregate(flags, F.lit(0), lambda a, x: a + x).alias("flags"),
        F.size(tones).alias("tones"),
    )


# --- evaluation -------------------------------------------------------------


def gold_sample(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return sampling.gold_sample(docs)


def axis_scores(spark, sf_dir):
    scores = evaluation.evaluate(_compared(spark, sf_dir))
    return scores.select("axis", *[F.round(c, 6).alias(c) for c in scores.columns[1:]])


def compared_counts(spark, sf_dir):
    gold, predicted = _gold(spark, sf_dir), _predicted(spark, sf_dir)
    return evaluation.compared_counts(gold, predicted, evaluation.compare(gold, predicted))


def tone_universe(spark, sf_dir):
    return evaluation.label_universe(_compared(spark, sf_dir), "ton")


def _rounded_report(report: DataFrame) -> DataFrame:
    return report.select(
        "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def polarity_report(spark, sf_dir):
    pairs = _gold(spark, sf_dir).join(_predicted(spark, sf_dir), "id")
    return _rounded_report(evaluation.classification_report(pairs, "polariteGold", "polaritePred"))


def tone_report(spark, sf_dir):
    return _rounded_report(
        evaluation.multilabel_report(_compared(spark, sf_dir), "tonGold", "tonPred")
    )


# --- sources and sinks ------------------------------------------------------


def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(messages(spark, sf_dir), path)
    return files.read_csv(spark, path, files.MESSAGE_SCHEMA)


def raw_csv_order(spark, sf_dir):
    """A raw CSV with line breaks inside quotes, written in id order, read in splits by file position and re-indexed."""
    path = scratch_path(spark, "raw-csv")
    rows = messages(spark, sf_dir)
    parts = max(4, rows.rdd.getNumPartitions())  # files grow in number with the table, not in size
    rows = rows.repartitionByRange(parts, "id").sortWithinPartitions("id")
    files.write_csv(rows.select("id", "text"), path)
    raw = files.read_raw_corpus(spark, path, split_bytes=256 * 1024)
    return corpus.format_corpus(raw, "position").select("id", "text")


def json_round_trip(spark, sf_dir):
    path = scratch_path(spark, "json-lines")
    files.write_json_lines(_records(spark, sf_dir), path)
    stored = files.read_predictions(spark, path)
    return stored.select("id", "text", "polaritePred", F.concat_ws(";", "tonPred").alias("tonPred"), "targetPred")


def label_report(spark, sf_dir):
    """The label distribution written as one JSON report and read back."""
    path = scratch_path(spark, "label-report")
    files.write_report(path, distribution=labeling.label_distribution(_labelled(spark, sf_dir)))
    schema = (
        "generatedAt string, distribution array<struct<axis:string,label:string,count:long,"
        "total:long,percentage:double>>"
    )
    rows = spark.read.schema(schema).json(path).select(F.inline("distribution"))
    return rows.select("axis", "label", "count", "total", F.round("percentage", 6).alias("percentage"))


# --- streaming and the whole chain ------------------------------------------

_DOCUMENT_SCHEMA = "doc_id LONG, text STRING"


def _message_stream(spark, sf_dir):
    raw = stream.read_messages(
        spark,
        f"{sf_dir}/documents*.parquet",
        _DOCUMENT_SCHEMA,
        "parquet",
        partitions=spark.sparkContext.defaultParallelism,
    )
    return raw.withColumnRenamed("doc_id", "id")


def stream_labels(spark, sf_dir):
    """Documents labelled as a stream into files, then read back."""
    root = scratch_path(spark, "stream-labels")
    labelled = stream.label_messages(
        _message_stream(spark, sf_dir), labeling.build_matcher(demo_lexicon(spark))
    )
    stream.write_available(labelled, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.schema("id LONG, polarite STRING, ton STRING, target STRING").parquet(f"{root}/out")


def stream_distribution(spark, sf_dir):
    """Running label counts of the stream after its last batch."""
    root = scratch_path(spark, "stream-counts")
    labelled = stream.label_messages(
        _message_stream(spark, sf_dir), labeling.build_matcher(demo_lexicon(spark))
    )
    stream.write_running(
        stream.running_distribution(labelled),
        f"{root}/state",
        lambda counts, _: counts.coalesce(1).write.mode("overwrite").parquet(f"{root}/out"),
    ).awaitTermination()
    counts = spark.read.schema("axis STRING, label STRING, count LONG").parquet(f"{root}/out")
    return labeling.percentages(counts, ["axis"]).withColumn("percentage", F.round("percentage", 6))


def _chain(spark, sf_dir):
    """The whole chain over the messages. Runs share a folder, so that a step already committed is not run again."""
    chain = Workflow(
        spark,
        f"{shared_dir(spark)}/workflow",
        demo_lexicon(spark),
        tfidf.TfidfParams(),
        learning.TrainingParams(),
    )
    source = messages(spark, sf_dir)
    return chain, chain.run(source, source, order_col="id")


def workflow_predictions(spark, sf_dir):
    """Format, label, learn the space, train and predict in one run."""
    return _chain(spark, sf_dir)[1]


def workflow_messages(spark, sf_dir):
    """What the chain predicts: ids and cleaned texts, and whether each record is well-formed.

    ``known``: every predicted label is one of its axis. ``reproduced``: the models as stored give the same record.
    """
    chain, predictions = _chain(spark, sf_dir)
    classifier = chain.classifier()
    names = classifier.class_arrays()
    scored = classifier.score(chain.space().features(corpus.api_part(chain.table("split"))))
    again = scoring.assemble_predictions(scored, names).select(
        "id",
        *[F.col(f"{a}Pred").alias(a) for a in ("polarite", "ton", "target")],
    )
    known = (
        F.array_contains(names["polarite"], F.col("polaritePred"))
        & F.array_contains(names["target"], F.col("targetPred"))
        & (F.size(F.array_except("tonPred", F.array_append(names["ton"], F.lit("Autres")))) == 0)
    )
    same = (F.col("polaritePred") == F.col("polarite")) & (F.col("tonPred") == F.col("ton")) & (F.col("targetPred") == F.col("target"))
    return predictions.join(again, "id").select("id", "text", known.alias("known"), same.alias("reproduced"))


def workflow_parts(spark, sf_dir):
    """Rows of every class in the fitting, validation and held-out part of the training messages."""
    chain, _ = _chain(spark, sf_dir)
    part = F.when(F.col("is_test"), "held out").when(F.col("is_validation"), "validation").otherwise("fitting")
    single = [F.struct(F.lit(a).alias("axis"), F.col(a).alias("label")) for a in ("polarite", "target")]
    tones = F.transform("ton", lambda t: F.struct(F.lit("ton").alias("axis"), t.alias("label")))
    rows = chain.table("training/parts").select(part.alias("part"), F.inline(F.concat(F.array(*single), tones)))
    return rows.groupBy("part", "axis", "label").agg(F.count("*").alias("n"))


def workflow_accuracy(spark, sf_dir):
    """Per single axis: whether probabilities sum to one, and held-out accuracy reaches the share of the largest class."""
    chain, _ = _chain(spark, sf_dir)
    held = chain.table("training/held-out")
    names = chain.classifier().class_arrays()
    stacked = held.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("axis"),
                        F.col(a).alias("label"),
                        (argmax_label(f"{a}Prob", names[a]) == F.col(a)).alias("hit"),
                        F.aggregate(f"{a}Prob", F.lit(0.0), lambda t, x: t + x).alias("mass"),
                    )
                    for a in ("polarite", "target")
                ]
            )
        )
    )
    per_label = stacked.groupBy("axis", "label").agg(
        F.count("*").alias("n"), F.sum(F.col("hit").cast("long")).alias("hits"), F.max(F.abs(F.col("mass") - 1)).alias("off")
    )
    return per_label.groupBy("axis").agg(
        F.sum("n").alias("held_out"),
        (F.max("off") < 1e-9).alias("sums_to_one"),
        (F.sum("hits") >= F.max("n")).alias("beats_majority"),
    )


def training_rounds(spark, sf_dir):
    """Per axis: whether the fitting loss fell from look to look, and the look kept has the least validation loss."""
    chain, _ = _chain(spark, sf_dir)
    looks = chain.table("training/rounds")
    before = F.lag("loss").over(Window.partitionBy("axis").orderBy("round"))  # a few looks for each axis
    return looks.withColumn("before", before).groupBy("axis").agg(
        F.coalesce(F.max(F.col("loss") - F.col("before")) <= 0, F.lit(True)).alias("loss_falls"),
        (F.min("validation") == F.min(F.when(F.col("kept"), F.col("validation")))).alias("least_is_kept"),
        (F.max("iteration") <= learning.TrainingParams().max_iter).alias("within_limit"),
    )


def stored_models(spark, sf_dir):
    """Held-out rows: whether the stored models give the probabilities that the fitted ones gave."""
    chain, _ = _chain(spark, sf_dir)
    fitted = chain.table("training/held-out").select("id", "polariteProb", "tonProb", "targetProb")
    classifier, space = chain.classifier(), chain.space()
    again = classifier.score(space.features(chain.table("labelled").select("id", "text")))
    close = lambda a: F.forall(F.zip_with(f"f.{a}", f"g.{a}", lambda x, y: F.abs(x - y)), lambda d: d < 1e-12)
    both = fitted.alias("f").join(again.alias("g"), "id")
    return both.select("id", (close("polariteProb") & close("tonProb") & close("targetProb")).alias("equal"))


def stream_counts(spark, sf_dir):
    """Label counts stored by batch, summed when read."""
    root = scratch_path(spark, "stream-batches")
    labelled = stream.label_messages(
        _message_stream(spark, sf_dir), labeling.build_matcher(demo_lexicon(spark))
    )
    batches.write_batches(labelled, f"{root}/out", f"{root}/state", batches.label_counts).awaitTermination()
    return batches.running_counts(spark, f"{root}/out").withColumn("percentage", F.round("percentage", 6))


def stream_predictions(spark, sf_dir):
    """Documents predicted as a stream by the stored models: whether each record equals the batch result."""
    chain, _ = _chain(spark, sf_dir)
    space, classifier = chain.space(), chain.classifier()
    root = scratch_path(spark, "stream-predictions")
    predicted = stream.predict_messages(_message_stream(spark, sf_dir), space, classifier)
    batches.write_batches(predicted, f"{root}/out", f"{root}/state", batches.prediction_counts).awaitTermination()
    streamed = batches.read_batches(spark, f"{root}/out", predicted.schema).drop("batch")
    whole = scoring.assemble_predictions(classifier.score(space.features(documents(spark, sf_dir))), classifier.class_arrays())
    record = F.struct(*[c for c in whole.columns if c != "id"])
    both = streamed.select("id", record.alias("streamed")).join(whole.select("id", record.alias("whole")), "id")
    return both.select("id", F.col("streamed").eqNullSafe(F.col("whole")).alias("equals_batch"))


def stored_evaluation(spark, sf_dir):
    """Gold CSV and predictions JSON lines, as files, to the evaluation report and back."""
    root = scratch_path(spark, "evaluation")
    gold = _gold(spark, sf_dir).withColumns({"text": F.lit("a, \"b\"\nc"), "commentaireGold": F.lit("")})
    predicted = _predicted(spark, sf_dir).select(
        "id",
        F.lit("").alias("text"),
        "polaritePred",
        F.lit(1.0).alias("polariteAcc"),
        F.split("tonPred", ";").alias("tonPred"),
        F.lit(1.0).alias("tonAcc"),
        "targetPred",
        F.lit(1.0).alias("targetAcc"),
    )
    columns = [c.split()[0] for c in files.GOLD_SCHEMA.split(", ")]
    files.write_csv(gold.select(*columns), f"{root}/gold")
    files.write_json_lines(predicted, f"{root}/predictions")
    evaluate_files(spark, f"{root}/gold", f"{root}/predictions", f"{root}/report")
    scores = read_evaluation(spark, f"{root}/report")
    return scores.select(
        "axis",
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "exactMatch", "partialMatch")],
        "totalGoldRows",
        "totalPredictionRows",
        "totalComparedRows",
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_messages,
        normalize_turns,
        normalize_pages,
        fold_accents,
        row_index,
        formatted_corpus,
        positional_split,
        corpus_report_raw,
        corpus_report_formatted,
        message_sizes,
        vocabulary_size,
        vocabulary_estimate,
        audited_input,
        label_scores,
        label_scores_joined,
        label_scores_large,
        labelled_messages,
        labelled_turns,
        filtered_labels,
        label_distribution,
        term_counts,
        ngram_totals,
        tfidf_vocabulary,
        tfidf_weights,
        tfidf_weights_joined,
        tfidf_profile,
        tfidf_vectors,
        stored_vocabulary,
        label_lists,
        prepared_labels,
        stratified_split,
        validation_tail,
        prediction_records,
        prediction_distribution,
        confidence_means,
        threshold_flags,
        gold_sample,
        axis_scores,
        compared_counts,
        tone_universe,
        polarity_report,
        tone_report,
        csv_round_trip,
        raw_csv_order,
        json_round_trip,
        label_report,
        stream_labels,
        stream_distribution,
        workflow_predictions,
        workflow_messages,
        workflow_parts,
        workflow_accuracy,
        training_rounds,
        stored_evaluation,
        stored_models,
        stream_counts,
        stream_predictions,
    )
}

