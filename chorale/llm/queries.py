"""The registered queries of this package. Each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm.common import table
from chorale.llm.html import extract_text
from chorale.llm.minhash import near_duplicates
from chorale.llm.mixing import mix_sources
from chorale.llm.neighbours import near_vectors
from chorale.llm.phrases import collocations
from chorale.llm.pii import AGAINST, AROUND, BASE, FOR, scan_pii
from chorale.llm.secrets import KINDS, scan_secrets
from chorale.llm.sentencepiece import Vocabulary, decode, encode
from chorale.llm.sharding import shard_by_bytes
from chorale.llm.topk import top_k
from chorale.llm.toxicity import THRESHOLD, fit_toxicity, held_out, score_toxicity
from chorale.llm.trie import paths, prefix_trie, rebuild
from chorale.llm.urls import Rule, filter_urls


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and whether they decode to its text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = Vocabulary.load()
    coded = decode(encode(documents, vocabulary), vocabulary)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), same.alias("round_trip"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors of highest inner product for every fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5)


SHARDS = 24


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes, copies together."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32("text").alias("text_crc32"))
    sharded = shard_by_bytes(documents, SHARDS, keep=["doc_id", "text_crc32"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts of the fixed patterns, a digest of their spans, all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"] != "noise")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.expr(f"filter(secrets, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("mix.size") * F.col("mix.copies")).cast("long").alias("taken")
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", taken)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a model fitted on the labels outside the held-out quarter."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = score_toxicity(documents, fit_toxicity(documents, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("toxicity.segments").cast("long").alias("n_passages"),
    )


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that decides on every page's url, and its verdict."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and groups of all vectors."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of the base kinds, a digest of their spans, all spans."""
    found = scan_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.expr(f"filter(pii, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("pii")).alias("spans"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie over the rebuilt conversations."""
    return prefix_trie(rebuild(paths(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_sentencepiece": op1_sentencepiece,
    "op2_topk": op2_topk,
    "op3_sharding": op3_sharding,
    "op4_secrets": op4_secrets,
    "op5_mixing": op5_mixing,
    "op6_minhash": op6_minhash,
    "op7_toxicity": op7_toxicity,
    "op8_html": op8_html,
    "op9_urls": op9_urls,
    "op10_near_vectors": op10_near_vectors,
    "op11_phrases": op11_phrases,
    "op12_pii": op12_pii,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op2_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id != c.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op9_urls": r"""
        WITH cut AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
        parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut),
        judged AS (
            SELECT *, CASE
                WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM parts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged""",
    "op10_near_vectors": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x != 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.vec_id != b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
        reached(vec_id, root) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.vec_id),
        roots AS (SELECT vec_id, min(root) AS component_id FROM reached GROUP BY vec_id),
        counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM roots LEFT JOIN counts USING (vec_id)""",
    "op11_phrases": r"""
        WITH docs AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
        lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w != '') AS words FROM pieces),
        sizes AS (SELECT lang, sum(len(words))::BIGINT AS n FROM lists GROUP BY lang),
        starts AS (SELECT lang, words, d, unnest(range(1, len(words) - d + 2)) AS s FROM lists, range(1, 5) t(d) WHERE len(words) >= d),
        counts AS (
            SELECT lang, d, words[s:s + d - 1] AS words, count(*) AS f FROM starts GROUP BY ALL HAVING count(*) >= 30),
        listed AS (SELECT lang, d, words, f AS a FROM counts WHERE d > 1),
        cuts AS (SELECT lang, d, words, a, unnest(range(1, d)) AS k FROM listed),
        scored AS (
            SELECT c.lang, c.d, c.words, c.a, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score, k
            FROM cuts c JOIN counts x ON x.lang = c.lang AND x.words = c.words[1:k]
                        JOIN counts y ON y.lang = c.lang AND y.words = c.words[k + 1:]),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, words[s:s + m - 1] AS words, max(a) AS longer
            FROM (SELECT lang, words, a, m, unnest(range(1, d - m + 2)) AS s FROM listed, range(2, 4) t(m) WHERE m < d) GROUP BY ALL),
        kept AS (
            SELECT w.lang, array_to_string(w.words, ' ') AS phrase, a, l, r, score
            FROM lowest w LEFT JOIN inside i ON i.lang = w.lang AND i.words = w.words WHERE longer IS NULL OR 100 * longer < 80 * a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
    # matches and the gaps between them give the offsets; rules and scores as in the operator, scores in tenths
    "op12_pii": rf"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        kinds(kind, rank, pattern, worth, favour, doubt) AS (VALUES
            ('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+', 9, '{FOR["email"]}', NULL),
            ('ip', 1, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)', 6, '{FOR["ip"]}', '{AGAINST["ip"]}'),
            ('card', 2, '[0-9]([\x20-]?[0-9])+', 8, '{FOR["card"]}', '{AGAINST["card"]}'),
            ('phone', 3, '\+[0-9][\x20().0-9-]+[0-9]', 5, '{FOR["phone"]}', '{AGAINST["phone"]}'),
            ('iban', 4, '\b[A-Z]{{2}}[0-9]{{2}}([A-Z0-9]{{11,30}}|(\x20[A-Z0-9]{{4}}){{2,7}}(\x20[A-Z0-9]{{1,3}})?)\b', 7, '{FOR["iban"]}', '{AGAINST["iban"]}'),
            ('ssn', 5, '\b[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}\b', 3, '{FOR["ssn"]}', '{AGAINST["ssn"]}')),
        cut AS (
            SELECT doc_id, kind, rank, worth, favour, doubt, text, regexp_extract_all(text, pattern) AS found,
                   regexp_split_to_array(text, pattern) AS gaps
            FROM docs, kinds),
        listed AS (
            SELECT doc_id, kind, rank, worth, favour, doubt, text, generate_subscripts(found, 1) AS i,
                   unnest(found) AS m, unnest(gaps[1:len(found)]) AS gap FROM cut),
        placed AS (
            SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop FROM listed),
        marked AS (
            SELECT *, stop - length(m) AS start, regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS plain FROM placed),
        ruled AS (
            SELECT * FROM marked WHERE CASE kind
                WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3
                                               OR coalesce(try_cast(ltrim(p, '0') AS INT), 0) > 255)) = 0
                WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(
                    range(1, length(digits) + 1), lambda j: CASE WHEN j % 2 = 1 THEN reverse(digits)[j]::INT
                        WHEN reverse(digits)[j]::INT > 4 THEN reverse(digits)[j]::INT * 2 - 9 ELSE reverse(digits)[j]::INT * 2 END)) % 10 = 0
                WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
                WHEN 'iban' THEN list_reduce(list_transform(string_split(substring(plain, 5) || plain[1:4], ''),
                        lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN ascii(c) - 55 ELSE c::INT END),
                    lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97, 0) = 1
                WHEN 'ssn' THEN NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$') ELSE true END),
        near AS (
            SELECT *, lower(substring(text, greatest(start - {AROUND}, 0) + 1, least(start, {AROUND})) || ' '
                            || substring(text, stop + 1, {AROUND})) AS words FROM ruled),
        kept AS (
            SELECT * FROM near WHERE rank < 4 OR worth + CASE WHEN regexp_matches(words, favour) THEN 3 ELSE 0 END
                                               - CASE WHEN regexp_matches(words, doubt) THEN 3 ELSE 0 END >= 5),
        spans AS (SELECT doc_id, kind, rank, start, kind || ':' || start || ':' || stop AS span FROM kept)
        SELECT d.doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
               count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
               sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 4), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
        FROM docs d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id""",
    # crc32 has no function in the dialect: its shift register runs over the bits of the decimal id
    "op13_prefix_trie": """
        WITH ids AS (SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
        crcs AS (
            SELECT c, xor(4294967295, list_reduce(
                flatten(list_transform(range(1, length(s) + 1), lambda i:
                    list_transform(range(0, 8), lambda b: (ascii(substring(s, i::BIGINT, 1)) >> b) & 1))),
                lambda r, m: xor(r >> 1, 3988292384 * (xor(r, m) & 1)), 4294967295)) % 9 AS h
            FROM (SELECT c, s FROM ids)),
        told AS (
            SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
            FROM conversations WHERE conv_id IS NOT NULL),
        lists AS (SELECT c, list({'role': role, 'text': text} ORDER BY i) AS turns FROM told GROUP BY c),
        rebuilt AS (
            SELECT o.c, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
            FROM crcs k JOIN lists o USING (c) LEFT JOIN lists b ON b.c = o.c - o.c % 5),
        members AS (
            SELECT c, unnest(range(0, len(turns) + 1)) AS depth, turns, len(turns) AS n FROM rebuilt),
        keyed AS (SELECT c, depth, turns[1:depth] AS path, turns[1:depth - 1] AS above, n, turns[depth].text AS last FROM members),
        nodes AS (
            SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs,
                   CASE depth WHEN 0 THEN NULL ELSE any_value(above) END AS above,
                   CASE depth WHEN 0 THEN 0 ELSE (count(*) - 1) * any_value(strlen(last)) END AS own,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
            FROM keyed GROUP BY path, depth),
        children AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
        counted AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON n.path = k.path),
        upward AS (SELECT path[1:unnest(range(0, depth + 1))] AS path, own, (n_children = 0)::BIGINT AS leaf FROM counted),
        totals AS (SELECT path, sum(own)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM upward GROUP BY path)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM counted n JOIN totals t ON n.path = t.path LEFT JOIN nodes p ON p.path = n.above""",
}
