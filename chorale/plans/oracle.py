"""The registered queries in SQL that DuckDB runs on the same tables.

Written from the rules, not from the Spark plans: keyword counts come from
string replacement, squeezing from three literal patterns, ranks from plain
windows over everything.
"""

from __future__ import annotations

from chorale.functions.text import emoji_class
from chorale.operators.lexicon import DEMO_TERMS, LABEL_RANKS
from chorale.plans.catalog import CLASS_COUNT, GOLD_SQL, PREDICTED_SQL
from chorale.plans.inputs import DOCUMENTS_SQL, TURNS_SQL, messages_sql

# Spelled out here, so that a wrong class in the code under test shows.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
NON_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
SPLIT_SPACE = SPACE + "+"


def _norm(x: str) -> str:
    for curly, straight in (("’", "''"), ("‘", "''"), ("“", '"'), ("”", '"')):
        x = f"replace({x if curly != '’' else f'''lower(coalesce({x}, ''))'''}, '{curly}', '{straight}')"
    steps = (
        (f"https?://{NON_SPACE}+", ""),
        (f"www{NON_SPACE}+", ""),
        (f"@{WORD}+", "@USER"),
    )
    for pattern, into in steps:
        x = f"regexp_replace({x}, '{pattern}', '{into}', 'g')"
    # strip_accents also drops the variation selector, which is no combining mark.
    x = f"replace(strip_accents(replace({x}, chr(65039), chr(57344))), chr(57344), chr(65039))"
    for pattern, into in (
        (emoji_class(), ""),
        ("!{2,}", "!"),
        (r"\?{2,}", "?"),
        (r"\.{2,}", "."),
        (SPLIT_SPACE, " "),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{into}', 'g')"
    return f"trim({x})"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SPLIT_SPACE}'), lambda w: w <> '')"


def _lexicon() -> str:
    rows = [
        f"({_quote(family)}, {_quote(label)}, {pos}, {rank}, {_quote(term)})"
        for family, labels in LABEL_RANKS.items()
        for pos, (label, rank) in enumerate(labels.items())
        for term in DEMO_TERMS[label]
    ]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(family, label, pos, prio, term)"


MESSAGES = messages_sql()


def _wrapped(x: str) -> str:
    return f"regexp_replace({x}, '({WORD}+)', chr(1) || '\\1' || chr(2), 'g')"


def _scores(source: str) -> str:
    return f"""
lexicon AS ({_lexicon()}),
terms AS (
    SELECT family, label, pos, prio, t, {_wrapped('t')} AS k, NOT regexp_matches(t, '[\\p{{L}}\\p{{N}}]') AS symbol
    FROM (SELECT family, label, pos, prio, {_norm('term')} AS t FROM lexicon) WHERE t <> ''),
clean AS (SELECT id, {_norm('text')} AS c FROM ({source})),
marked AS (SELECT id, c, {_wrapped('c')} AS d FROM clean),
scores AS (
    SELECT id, family, label, pos, prio, CAST(sum(CASE
        WHEN symbol THEN (length(c) - length(replace(c, t, ''))) // length(t)
        ELSE (length(d) - length(replace(d, k, ''))) // length(k) END) AS BIGINT) AS score
    FROM marked CROSS JOIN terms GROUP BY ALL HAVING score > 0)"""


def _labels(source: str) -> str:
    return f"""{_scores(source)},
best AS (
    SELECT id, family, label FROM scores WHERE family <> 'ton'
    QUALIFY row_number() OVER (PARTITION BY id, family ORDER BY score DESC, prio) = 1),
tones AS (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM scores WHERE family = 'ton'),
kept AS (
    SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY score DESC, prio) AS r
    FROM tones WHERE score >= 2 AND score >= 0.5 * top),
lone AS (
    SELECT id, label FROM tones WHERE id NOT IN (SELECT id FROM kept)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, pos) = 1),
ton AS (
    SELECT id, string_agg(label, ';' ORDER BY r) AS ton FROM kept WHERE r <= 2 GROUP BY id
    UNION ALL SELECT id, label FROM lone),
labelled AS (
    SELECT c.id, coalesce(p.label, 'Neutre') AS polarite, coalesce(t.ton, 'Autres') AS ton,
           coalesce(g.label, 'Autre') AS target
    FROM clean c
    LEFT JOIN (SELECT * FROM best WHERE family = 'polarite') p ON p.id = c.id
    LEFT JOIN ton t ON t.id = c.id
    LEFT JOIN (SELECT * FROM best WHERE family = 'target') g ON g.id = c.id)"""


def _distribution(source: str) -> str:
    return f"""WITH {_labels(source)},
stacked AS (
    SELECT 'polarite' AS axis, polarite AS label FROM labelled
    UNION ALL SELECT 'ton', ton FROM labelled UNION ALL SELECT 'target', target FROM labelled),
counted AS (SELECT axis, label, count(*) AS count FROM stacked GROUP BY ALL)
SELECT axis, label, count, CAST(sum(count) OVER (PARTITION BY axis) AS BIGINT) AS total,
       round(count / sum(count) OVER (PARTITION BY axis) * 100, 6) AS percentage
FROM counted"""


def _report(source: str, name: str) -> str:
    return f"""WITH m AS (SELECT coalesce(text, '') AS text FROM ({source})),
sized AS (SELECT text, length(text) AS chars, len({_words('text')}) AS words FROM m)
SELECT '{name}' AS file, count(*) AS totalLines, avg(chars) AS averageTextLength,
       min(chars) AS minTextLength, max(chars) AS maxTextLength, min(words) AS minWord, max(words) AS maxWord,
       avg(words) AS averageWordsPerText, count(*) FILTER (WHERE words = 0) AS emptyTexts,
       round_even(avg(CASE WHEN words = 0 THEN 1.0 ELSE 0.0 END) * 100, 2) AS emptyTextsPercentage,
       (SELECT count(DISTINCT w) FROM (SELECT unnest({_words('text')}) AS w FROM m)) AS vocabSize
FROM sized"""


def _grams(w: str) -> str:
    return (
        f"flatten([[substr(' ' || {w} || ' ', i, n) FOR i IN range(1, length({w}) + 4 - n)] "
        "FOR n IN range(1, 5)])"
    )


def _term_counts(source: str) -> str:
    return f"""
    SELECT id, term, CAST(sum(n) AS BIGINT) AS tf FROM (
        SELECT id, n, unnest({_grams('w')}) AS term FROM (
            SELECT id, w, count(*) AS n FROM (SELECT id, unnest({_words('text')}) AS w FROM ({source})) GROUP BY ALL))
    GROUP BY ALL"""


def _vocabulary(source: str, size: int = 20_000) -> str:
    return f"""counts AS ({_term_counts(source)}),
total AS (SELECT count(*) AS n FROM ({source})),
frequent AS (
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM counts GROUP BY term
    HAVING df >= 3 AND df <= 0.95::DOUBLE * (SELECT n FROM total)
    ORDER BY ctf DESC, term LIMIT {size}),
vocabulary AS (
    SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, term, df, ctf,
           ln((1 + n) / (1 + df)) + 1 AS idf
    FROM frequent, total)"""


def _weights(source: str) -> str:
    return f"""WITH {_vocabulary(DOCUMENTS_SQL)},
cells AS (
    SELECT id, term, (1 + ln(tf)) * idf AS w FROM ({_term_counts(source)}) JOIN vocabulary USING (term)),
weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM cells)"""


_HASH = "md5('42:' || {0}) || ':' || {0}"
_CLASSES = "[format('c{:02d}', i) FOR i IN range(0, " + str(CLASS_COUNT) + ")]"

_PROBABILITIES = """
SELECT vec_id AS id, CAST(label AS VARCHAR) AS text, CAST(embedding AS DOUBLE[]) AS p,
       list_reverse(CAST(embedding AS DOUBLE[])) AS q
FROM embeddings"""

_RECORDS = f"""
SELECT id, text,
       {_CLASSES}[list_position(p, list_max(p))] AS polaritePred, list_max(p) AS polariteAcc,
       CASE WHEN list_max(p) >= 0.25
            THEN list_transform(list_filter(list_zip(p, {_CLASSES}), lambda z: z[1] >= 0.25), lambda z: z[2])
            ELSE ['Autres'] END AS tonPred,
       list_max(p) AS tonAcc,
       {_CLASSES}[list_position(q, list_max(q))] AS targetPred, list_max(q) AS targetAcc
FROM ({_PROBABILITIES})"""


def _set(col: str) -> str:
    return (
        f"list_sort(list_distinct(list_filter(list_transform(string_split(coalesce({col}, ''), ';'), "
        "lambda x: trim(x)), lambda x: x <> '')))"
    )


_COMPARED = f"""gold AS ({GOLD_SQL}), predicted AS ({PREDICTED_SQL}),
pairs AS (SELECT * FROM gold JOIN predicted USING (id)),
sets AS (
    SELECT id, unnest(['polarite', 'ton', 'target']) AS axis,
           unnest([{_set('polariteGold')}, {_set('tonGold')}, {_set('targetGold')}]) AS g,
           unnest([{_set('polaritePred')}, {_set('tonPred')}, {_set('targetPred')}]) AS p
    FROM pairs)"""

_SPLIT_TABLE = """
WITH sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
total AS (SELECT sum(n) AS n FROM sizes),
shares AS (
    SELECT s.lang, s.n, t.n - ceil(0.2::DOUBLE * t.n) AS train,
           s.n * (t.n - ceil(0.2::DOUBLE * t.n)) / t.n AS ideal
    FROM sizes s, total t),
ranked AS (
    SELECT *, floor(ideal) AS whole,
           row_number() OVER (ORDER BY round(ideal - floor(ideal), 9) DESC, lang) AS r,
           train - sum(floor(ideal)) OVER () AS short FROM shares),
quotas AS (SELECT lang, n - whole - CASE WHEN r <= short THEN 1 ELSE 0 END AS quota FROM ranked)
"""

_PER_LABEL = """
    SELECT label, tp, predicted, support,
           CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
           CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
           CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1
    FROM counts"""


def _report_rows(parts: list[str]) -> str:
    rows = " UNION ALL ".join(parts)
    return (
        "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
        f"round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM ({rows})"
    )


_MACRO = "SELECT 'macro avg' AS label, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1, sum(support) AS support FROM per_label"
_WEIGHTED = (
    "SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
    "sum(f1 * support) / sum(support), sum(support) FROM per_label"
)
_ROWS = "SELECT label, precision, recall, f1, support FROM per_label"


def _indexed(source: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS n, text FROM ({source})"


ORACLES: dict[str, str] = {
    "normalize_messages": f"SELECT id, {_norm('text')} AS text FROM ({MESSAGES})",
    "normalize_turns": f"SELECT id, {_norm('text')} AS text FROM ({TURNS_SQL})",
    "normalize_pages": (
        f"SELECT id, {_norm('text')} AS text FROM "
        "(SELECT page_id AS id, concat_ws(' ', url, html) AS text FROM pages)"
    ),
    "fold_accents": f"SELECT id, strip_accents(text) AS text FROM ({DOCUMENTS_SQL})",
    "row_index": (
        "SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_id, event_id, user_id, "
        "count(*) OVER () AS n_rows FROM events"
    ),
    "formatted_corpus": (
        f"SELECT i AS id, {_norm('text')} AS text, '' AS polarite, '' AS ton, '' AS target "
        f"FROM ({_indexed(MESSAGES)})"
    ),
    "positional_split": (
        f"SELECT CASE WHEN i < cut THEN 'train' ELSE 'api' END AS split, "
        f"CASE WHEN i < cut THEN i ELSE i - cut END AS id, {_norm('text')} AS text FROM "
        f"(SELECT *, CAST(floor(0.7::DOUBLE * n) AS BIGINT) AS cut FROM ({_indexed(MESSAGES)}))"
    ),
    "corpus_report_raw": _report(MESSAGES, "messages"),
    "corpus_report_formatted": _report(
        f"SELECT id, {_norm('text')} AS text FROM ({TURNS_SQL})", "turns"
    ),
    "message_sizes": (
        f"SELECT id, length(text) AS chars, len({_words('text')}) AS words FROM ({MESSAGES})"
    ),
    "vocabulary_size": (
        f"SELECT count(DISTINCT w) AS vocabSize FROM (SELECT unnest({_words('text')}) AS w FROM documents)"
    ),
    "label_scores": f"WITH {_scores(MESSAGES)} SELECT id, family, label, score FROM scores",
    "label_scores_joined": f"WITH {_scores(MESSAGES)} SELECT id, family, label, score FROM scores",
    "labelled_messages": f"WITH {_labels(MESSAGES)} SELECT * FROM labelled",
    "labelled_turns": f"WITH {_labels(TURNS_SQL)} SELECT * FROM labelled",
    "filtered_labels": f"WITH {_labels(MESSAGES)} SELECT * FROM labelled WHERE polarite = 'Favorable'",
    "label_distribution": _distribution(MESSAGES),
    "term_counts": _term_counts(TURNS_SQL),
    "ngram_totals": (
        f"SELECT d.id, coalesce(CAST(sum(tf) AS BIGINT), 0) AS ngrams, count(tf) AS distinct_ngrams "
        f"FROM ({DOCUMENTS_SQL}) d LEFT JOIN ({_term_counts(DOCUMENTS_SQL)}) t USING (id) GROUP BY d.id"
    ),
    "tfidf_vocabulary": (
        f"WITH {_vocabulary(DOCUMENTS_SQL)} SELECT idx, term, df, ctf, round(idf, 6) AS idf FROM vocabulary"
    ),
    "tfidf_weights": f"{_weights(TURNS_SQL)} SELECT id, term, round(weight, 6) AS weight FROM weights",
    "tfidf_weights_joined": f"{_weights(TURNS_SQL)} SELECT id, term, round(weight, 6) AS weight FROM weights",
    "tfidf_profile": (
        f"{_weights(DOCUMENTS_SQL)} SELECT d.id, count(weight) AS terms, "
        "round(coalesce(sum(weight), 0), 6) AS total, round(coalesce(max(weight), 0), 6) AS highest "
        f"FROM ({DOCUMENTS_SQL}) d LEFT JOIN weights USING (id) GROUP BY d.id"
    ),
    "tfidf_vectors": (
        f"{_weights(TURNS_SQL)} SELECT d.id, (SELECT CAST(count(*) AS INTEGER) FROM vocabulary) AS size, "
        "count(weight) AS entries, round(coalesce(sum(weight * weight), 0), 6) AS squared_length "
        f"FROM ({TURNS_SQL}) d LEFT JOIN weights USING (id) GROUP BY d.id"
    ),
    "stored_vocabulary": (
        f"WITH {_vocabulary(TURNS_SQL)} SELECT idx, term, df, ctf, round(idf, 6) AS idf FROM vocabulary"
    ),
    "label_lists": (
        "SELECT id, array_to_string(list_filter(list_transform(string_split(coalesce(tonGold, ''), ';'), "
        "lambda x: trim(x)), lambda x: x <> ''), '|') AS listed, "
        f"array_to_string({_set('tonGold')}, '|') AS as_set FROM ({GOLD_SQL})"
    ),
    "prepared_labels": f"""
WITH gold AS ({GOLD_SQL}),
lists AS (SELECT *, {_set('tonGold')} AS tones FROM gold),
classes AS (SELECT list_sort(list_distinct(flatten(list(tones)))) AS names FROM lists),
ranked AS (SELECT polariteGold, row_number() OVER (ORDER BY polariteGold) - 1 AS r FROM gold GROUP BY polariteGold)
SELECT id, polariteGold AS polarite, targetGold AS target, CAST(r AS INTEGER) AS polarite_index,
       array_to_string(list_transform(names, lambda c: CASE WHEN list_contains(tones, c) THEN '1' ELSE '0' END), '') AS tone_flags
FROM lists JOIN ranked USING (polariteGold), classes""",
    "stratified_split": f"""{_SPLIT_TABLE}
SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_HASH.format('doc_id')}) <= quota AS is_test
FROM documents JOIN quotas USING (lang)""",
    "validation_tail": """
SELECT doc_id, row_number() OVER (ORDER BY md5('42/order:' || doc_id) || ':' || doc_id)
       > floor(count(*) OVER () * 0.9::DOUBLE) AS is_validation FROM documents""",
    "prediction_records": (
        "SELECT id, text, polaritePred, round(polariteAcc, 6) AS polariteAcc, "
        "array_to_string(tonPred, ';') AS tonPred, round(tonAcc, 6) AS tonAcc, targetPred, "
        f"round(targetAcc, 6) AS targetAcc FROM ({_RECORDS})"
    ),
    "prediction_distribution": f"""
WITH records AS ({_RECORDS}),
stacked AS (
    SELECT 'polarite' AS axis, polaritePred AS label FROM records
    UNION ALL SELECT 'target', targetPred FROM records
    UNION ALL SELECT 'ton', unnest(tonPred) FROM records),
counted AS (SELECT axis, label, count(*) AS count FROM stacked GROUP BY ALL)
SELECT axis, label, count, CAST(sum(count) OVER (PARTITION BY axis) AS BIGINT) AS total,
       round(count / sum(count) OVER (PARTITION BY axis) * 100, 6) AS percentage FROM counted""",
    "confidence_means": (
        "SELECT count(*) AS totalPredictions, round(avg(polariteAcc), 6) AS polariteMean, "
        f"round(avg(tonAcc), 6) AS tonMean, round(avg(targetAcc), 6) AS targetMean FROM ({_RECORDS})"
    ),
    "threshold_flags": (
        "SELECT id, CAST(len(list_filter(p, lambda x: x >= 0.25)) AS INTEGER) AS flags, "
        "CAST(greatest(len(list_filter(p, lambda x: x >= 0.25)), 1) AS INTEGER) AS tones "
        f"FROM ({_PROBABILITIES})"
    ),
    "gold_sample": (
        "SELECT doc_id AS id, text, '' AS polariteGold, '' AS tonGold, '' AS targetGold, "
        f"'' AS commentaireGold FROM documents ORDER BY {_HASH.format('doc_id')} LIMIT 200"
    ),
    "axis_scores": f"""
WITH {_COMPARED},
sums AS (
    SELECT axis, sum(len(list_intersect(g, p))) AS tp, sum(len(p)) AS np, sum(len(g)) AS ng,
           avg(CASE WHEN g = p THEN 1.0 ELSE 0.0 END) AS exact,
           avg(CASE WHEN len(list_intersect(g, p)) > 0 THEN 1.0 ELSE 0.0 END) AS part
    FROM sets GROUP BY axis)
SELECT axis, round(CASE WHEN np = 0 THEN 0 ELSE tp / np END, 6) AS precision,
       round(CASE WHEN ng = 0 THEN 0 ELSE tp / ng END, 6) AS recall,
       round(CASE WHEN np + ng = 0 THEN 0 ELSE 2 * tp / (np + ng) END, 6) AS f1,
       round(CASE WHEN np + ng = 0 THEN 0 ELSE exact END, 6) AS exactMatch,
       round(CASE WHEN np + ng = 0 THEN 0 ELSE part END, 6) AS partialMatch
FROM sums""",
    "compared_counts": f"""
WITH {_COMPARED}
SELECT (SELECT count(*) FROM gold) AS totalGoldRows, (SELECT count(*) FROM predicted) AS totalPredictionRows,
       (SELECT count(*) FROM pairs) AS totalComparedRows""",
    "tone_universe": f"""
WITH {_COMPARED}
SELECT DISTINCT unnest(list_concat(g, p)) AS label FROM sets WHERE axis = 'ton'""",
    "polarity_report": f"""
WITH {_COMPARED},
names AS (SELECT polariteGold AS label FROM pairs UNION SELECT polaritePred FROM pairs),
counts AS (
    SELECT label, count(*) FILTER (WHERE polariteGold = label AND polaritePred = label) AS tp,
           count(*) FILTER (WHERE polaritePred = label) AS predicted,
           count(*) FILTER (WHERE polariteGold = label) AS support
    FROM names, pairs GROUP BY label),
per_label AS ({_PER_LABEL})
"""
    + _report_rows(
        [
            _MACRO,
            _ROWS,
            _WEIGHTED,
            "SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM per_label",
        ]
    ),
    "tone_report": f"""
WITH {_COMPARED},
tones AS (SELECT * FROM sets WHERE axis = 'ton'),
names AS (SELECT DISTINCT unnest(list_concat(g, p)) AS label FROM tones),
counts AS (
    SELECT label, count(*) FILTER (WHERE list_contains(g, label) AND list_contains(p, label)) AS tp,
           count(*) FILTER (WHERE list_contains(p, label)) AS predicted,
           count(*) FILTER (WHERE list_contains(g, label)) AS support
    FROM names, tones GROUP BY label),
per_label AS ({_PER_LABEL}),
samples AS (SELECT len(list_intersect(g, p)) AS s, len(p) AS np, len(g) AS ng FROM tones)
"""
    + _report_rows(
        [
            _MACRO,
            _ROWS,
            _WEIGHTED,
            "SELECT 'micro avg', sum(tp) / sum(predicted), sum(tp) / sum(support), "
            "2 * sum(tp) / (sum(predicted) + sum(support)), sum(support) FROM per_label",
            "SELECT 'samples avg', avg(CASE WHEN np = 0 THEN 0 ELSE s / np END), "
            "avg(CASE WHEN ng = 0 THEN 0 ELSE s / ng END), "
            "avg(CASE WHEN np + ng = 0 THEN 0 ELSE 2 * s / (np + ng) END), sum(ng) FROM samples",
        ]
    ),
    "csv_round_trip": MESSAGES,
    "raw_csv_order": f"SELECT i AS id, {_norm('text')} AS text FROM ({_indexed(MESSAGES)})",
    "json_round_trip": (
        "SELECT id, text, polaritePred, array_to_string(tonPred, ';') AS tonPred, targetPred "
        f"FROM ({_RECORDS})"
    ),
    "label_report": _distribution(MESSAGES),
    "stream_labels": f"WITH {_labels(DOCUMENTS_SQL)} SELECT * FROM labelled",
    "stream_distribution": _distribution(DOCUMENTS_SQL),
}

_API = (
    f"SELECT i - cut AS id, {_norm('text')} AS text FROM "
    f"(SELECT *, CAST(floor(0.7::DOUBLE * n) AS BIGINT) AS cut FROM ({_indexed(MESSAGES)})) WHERE i >= cut"
)
_TRAINING = (
    f"SELECT i AS id, {_norm('text')} AS text FROM "
    f"(SELECT *, CAST(floor(0.7::DOUBLE * n) AS BIGINT) AS cut FROM ({_indexed(MESSAGES)})) WHERE i < cut"
)
# The split of the documents, by polarity instead of language; the last tenth of the training rows validates.
_QUOTAS = _SPLIT_TABLE.replace("lang", "polarite").replace("documents", "labelled").replace("WITH sizes", ",\nsizes")
_PARTS = f"""WITH {_labels(_TRAINING)}{_QUOTAS.rstrip()},
tested AS (
    SELECT l.*, row_number() OVER (PARTITION BY polarite ORDER BY {_HASH.format('id')}) <= quota AS is_test
    FROM labelled l JOIN quotas USING (polarite)),
parted AS (
    SELECT *, CASE WHEN is_test THEN 'held out'
                   WHEN row_number() OVER (PARTITION BY is_test ORDER BY md5('42/order:' || id) || ':' || id)
                        > floor(count(*) OVER (PARTITION BY is_test) * 0.9::DOUBLE) THEN 'validation'
                   ELSE 'fitting' END AS part FROM tested)"""

ORACLES |= {
    "workflow_messages": f"SELECT id, text, true AS known, true AS reproduced FROM ({_API})",
    "workflow_parts": f"""{_PARTS},
stacked AS (
    SELECT part, 'polarite' AS axis, polarite AS label FROM parted
    UNION ALL SELECT part, 'target', target FROM parted
    UNION ALL SELECT part, 'ton', unnest(string_split(ton, ';')) FROM parted)
SELECT part, axis, label, count(*) AS n FROM stacked GROUP BY ALL""",
    "workflow_accuracy": f"""{_PARTS}
SELECT unnest(['polarite', 'target']) AS axis, count(*) AS held_out, true AS sums_to_one, true AS beats_majority
FROM parted WHERE is_test""",
    "training_rounds": (
        "SELECT unnest(['polarite', 'target', 'ton']) AS axis, true AS loss_falls, true AS least_is_kept, true AS within_limit"
    ),
    "stored_evaluation": f"SELECT * FROM ({ORACLES['axis_scores']}) a, ({ORACLES['compared_counts']}) c",
    "stored_models": f"{_PARTS} SELECT id, true AS equal FROM parted WHERE is_test",
    "stream_counts": ORACLES["stream_distribution"],
    "stream_predictions": "SELECT doc_id AS id, true AS equals_batch FROM documents",
    "vocabulary_estimate": f"SELECT *, true AS within FROM ({ORACLES['vocabulary_size']})",
    "audited_input": """
WITH gold AS (
    SELECT doc_id % 5 = 0 AS missing, doc_id % 3 AS blanks, quality = 0 AND toxic = 1 AS unfavourable, quality = 1 AND toxic = 1 AS mixed
    FROM labels)
SELECT count(*) AS rows, 0::BIGINT AS null_ids, count(*) FILTER (missing) AS null_texts, count(*) FILTER (NOT missing) AS empty_texts,
       count(*) FILTER (unfavourable) AS bad_polariteGold, count(*) FILTER (mixed) AS bad_tonGold
FROM gold""",
    "label_scores_large": rf"""
WITH lines AS (SELECT {_norm('text')} AS line FROM conversations),
cut AS (SELECT regexp_extract_all(line, '[\p{{L}}\p{{N}}_]+') AS words, regexp_split_to_array(line, '[\p{{L}}\p{{N}}_]+') AS gaps FROM lines),
singles AS (SELECT unnest(words) AS term FROM cut),
doubles AS (SELECT words[i] || ' ' || words[i + 1] AS term
            FROM (SELECT words, gaps, unnest(range(1, len(words))) AS i FROM cut) WHERE gaps[i + 1] = ' '),
terms AS (SELECT * FROM singles UNION SELECT * FROM doubles),
clean AS (SELECT doc_id AS id, {_norm('text')} AS line FROM documents),
runs AS (SELECT id, regexp_extract_all(line, '[\p{{L}}\p{{N}}_]+') AS words, regexp_split_to_array(line, '[\p{{L}}\p{{N}}_]+') AS gaps FROM clean),
pairs AS (
    SELECT id, i, words[i] || gaps[i + 1] || words[i + 1] AS term, gaps[i + 1] = ' ' AND words[i] = words[i + 1] AS twin
    FROM (SELECT id, words, gaps, unnest(range(1, len(words))) AS i FROM runs)),
islands AS (SELECT id, i, term, i - row_number() OVER (PARTITION BY id, term ORDER BY i) AS island FROM pairs WHERE twin),
spans AS (
    SELECT id, unnest(words) AS term FROM runs
    UNION ALL SELECT id, term FROM pairs WHERE NOT twin
    -- a word said over and over: pairs do not share words, so every second one of a run counts
    UNION ALL SELECT id, term FROM (
        SELECT id, term, row_number() OVER (PARTITION BY id, term, island ORDER BY i) AS place FROM islands) WHERE place % 2 = 1),
hits AS (SELECT id, length(term) % 2 = 0 AS even FROM spans JOIN terms USING (term))
SELECT id, CASE WHEN even THEN 'polarite' ELSE 'target' END AS family,
       CASE WHEN even THEN 'Favorable' ELSE 'Politique' END AS label, count(*) AS score
FROM hits GROUP BY id, even""",
}
