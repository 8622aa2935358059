"""The pipeline's stages in order, each against a plain version of its decision, and the columns of the queries."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chorale.llm.common import materialize, table
from chorale.llm.mixing import WEIGHTS
from chorale.llm.queries import QUERIES
from chorale.llm.secrets import scan_secrets
from chorale.llm.sentencepiece import Vocabulary

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")


def shingled(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_stages_do_what_they_say(spark):
    documents = table(spark, SF_DIR, "documents")
    extra = [(-1, "a few words that stand here twice", "en", "src0", 33)] * 2 + [(None, None, None, None, None), (-2, "", "en", None, 0)]
    secret = "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" stands in this text of its own"
    extra += [(-3, secret, "en", "src1", len(secret))]
    docs = documents.unionByName(spark.createDataFrame(extra, documents.schema))
    before = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF_DIR), "stage")
        before[name], docs = docs, after
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == documents.columns
    clean, single, masked, mixed = (before[n].collect() for n in ("near duplicates", "secret scans", "mixing", "sentencepiece"))
    toxic = {r.doc_id for r in table(spark, SF_DIR, "labels").where("toxic = 0").collect()}
    assert len(toxic - {r.doc_id for r in clean}) <= 0.02 * len(toxic)

    texts = [(r.doc_id, shingled(r.text)) for r in single if r.text]
    for i, (_, s) in enumerate(texts):
        assert not any(100 * len(s & t) >= 75 * len(s | t) for _, t in texts[i + 1 :])
    kept = [shingled(r.text) for r in single if r.text]
    for r in clean:
        if r.text:  # every document is, or is linked by a chain to, one that stays
            s = shingled(r.text)
            assert any(100 * len(s & t) >= 75 * len(s | t) for t in kept) or r.doc_id is not None
    assert {r.doc_id for r in clean if not r.text} == {r.doc_id for r in single if not r.text}

    assert len(masked) == len(single)
    spans = {r.doc_id: r.secrets for r in scan_secrets(before["secret scans"]).collect()}
    text = {r.doc_id: r.text for r in single}
    for r in masked:
        if not spans[r.doc_id]:
            assert r.text == text[r.doc_id]
        else:
            assert "[SECRET]" in r.text and r.n_chars == len(r.text)
            assert all(text[r.doc_id][x.start : x.end] not in r.text for x in spans[r.doc_id])
    assert {r.text for r in masked if r.doc_id == -3} == {"[SECRET]\" stands in this text of its own"}

    copies = {}
    for r in mixed:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2 and set(copies) <= {r.doc_id for r in masked} and len(WEIGHTS) == 3

    vocabulary = Vocabulary.load()
    assert docs.count() == len(mixed)
    for r in docs.collect():
        text = next(m.text for m in mixed if m.doc_id == r.doc_id)
        assert list(r.ids) == vocabulary.encode(text) and vocabulary.decode(r.ids) == (text or "")


def test_columns_of_the_queries(spark):
    expected = {
        "op2_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
        "op3_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
        "op4_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
        "op5_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
        "op6_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
        "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op8_html": "page_id bigint, url string, text string, n_chars bigint",
        "op9_urls": "page_id bigint, host string, path string, rule string, verdict string",
        "op10_near_vectors": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    }
    for name, columns in expected.items():
        frame = QUERIES[name](spark, SF_DIR)
        own = dict(frame.dtypes)
        assert {c.split()[0]: c.split()[1] for c in columns.split(", ")}.items() <= own.items(), name
        source = {"op2": "embeddings", "op8": "pages", "op9": "pages", "op10": "embeddings"}.get(name.split("_")[0], "documents")
        rows = table(spark, SF_DIR, source)
        rows = rows.where(F.col("vec_id") % 50 == 0).count() * 5 if name == "op2_topk" else rows.count()
        assert frame.count() == rows, name


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words), " ".join([*words, "end"]), " ".join(["start", *words])]
    other = [" ".join(f"x{i}" for i in range(60)) + end for end in ("", " end")]
    rows = [(None, t, "en", "a") for t in near]  # no id at all
    rows += [(5, other[0], "en", "a"), (5, other[1], "de", "b"), (7, other[0], "en", "a")]  # the smallest id twice
    rows += [(None, None, "en", "a"), (None, None, "de", "b"), (None, None, "de", "b"), (8, "", "en", "a")]  # no words
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "unused").collect()
    assert len([r for r in out if r.text in near]) == 1
    assert [r.doc_id for r in out if r.text in other] == [5]
    assert sorted((r.lang, r.source) for r in out if not r.text) == [("de", "b"), ("de", "b"), ("en", "a"), ("en", "a")]


def test_only_documents_left_out_are_looked_up(spark, monkeypatch):
    stored = {}

    def kept(df, name, store=corpus_pipeline.materialize):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(corpus_pipeline, "materialize", kept)
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(12)), "en", "x", 1) for k in range(40)]
    rows += [(100 + k, rows[k % 2][1], "en", "x", 1) for k in range(10)] + [(None, rows[3][1], "de", "y", 2), (7, "", "de", "y", 2), (7, None, "de", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "unused").collect()
    left = rows[:40] + rows[-2:]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, left))
    assert stored["dropped-documents"].count() == 11
