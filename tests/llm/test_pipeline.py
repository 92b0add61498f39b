"""The pipeline against its stages' decisions in memory."""

import re

import public_tokenizers

import corpus_pipeline
from leadloom.llm import bpe, pii
from leadloom.llm.queries import ranks
from tests.conftest import FOLDER
from tests.llm.conftest import words
from tests.llm.test_operators import CHECK_WORDS, plain_components


def five(text):
    w = CHECK_WORDS.findall(text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    bench = [five(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, FOLDER))
        made[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "byte-level BPE":
            assert docs.columns == columns
    kept = made["quality classifier"]
    assert sum(labels[i] == (i in kept) for i in labels) >= 0.98 * len(labels)
    groups = plain_components([(i, r["text"]) for i, r in kept.items()])
    distinct = made["n-gram Jaccard join"]
    assert set(distinct) == {root for _, _, root in groups}
    clean = made["benchmark decontamination"]
    for i, r in distinct.items():
        own = five(r["text"] or "")
        assert (i in clean) == (not any(100 * len(own & b) >= 75 * len(b) for b in bench if b))
    safe = made["PII"]
    assert set(safe) == set(clean)
    for i, r in clean.items():
        if pii.base_spans(r["text"] or ""):
            assert safe[i]["text"] != r["text"] and not pii.base_spans(safe[i]["text"])
        elif not re.search("[0-9@+]", r["text"] or ""):
            assert safe[i]["text"] == r["text"]
        assert safe[i]["n_chars"] == len(safe[i]["text"])
    enc = bpe.encoding(ranks(), public_tokenizers.PATTERN)
    for i, r in made["byte-level BPE"].items():
        assert r["exact"] and r["token_ids"] == enc.encode_ordinary(safe[i]["text"])


def test_repeated_rows_and_rows_without_id_are_copies_too(spark):
    x, y, z = (words(k, 60) for k in (1, 2, 3))
    rows = [(7, y), (7, y), (8, x), (None, x), (None, x), (None, z), (None, z + " end"), (9, z.upper()), (5, None), (5, None), (6, words(4, 50)), (6, x + " and")]
    docs = spark.createDataFrame([(i, t, "en", "web", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(7, y), (8, x), (9, z.upper()), (5, None), (5, None), (6, words(4, 50))], key=str
    )


def test_run_on_no_documents(spark, no_docs, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_on_odd_rows(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, FOLDER))
    assert set(odd_docs.columns) <= set(docs.columns)
