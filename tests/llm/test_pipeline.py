"""Each stage of the pipeline against what its operator says, on the whole small table."""

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stormgauge.llm import langid, mixing, toxicity
from stormgauge.llm.common import fold
from stormgauge.llm.queries import WORD_VOCABULARY
from tests.llm.test_jaccard import brute

SMALL = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clash = docs.where("doc_id < 6").selectExpr("doc_id + 9000 doc_id", "text", "lang", "source", "n_chars")
    bad = spark.createDataFrame(
        [(9100, None, None, None, None), (9101, "", "en", "src0", 0), (9102, "1 2 3", "en", None, 5)],
        docs.schema,
    )
    return docs.unionByName(clash).unionByName(bad).cache()


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_order_of_stages():
    names = ["toxicity", "language", "near_duplicates", "mixing", "bpe"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names


def test_toxic_documents_go(spark, documents):
    kept = STAGES["toxicity"](spark, documents, SMALL)
    assert kept.columns == documents.columns
    usable = fold("doc_id") != 0
    languages = langid.fit_language_model(documents, usable)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit_toxicity_model(documents, labels, usable, languages)
    scores = documents.select("doc_id", toxicity.rate(model, languages, documents).alias("s")).collect()
    assert ids(kept) == sorted(r.doc_id for r in scores if r.s < 0.5)
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(clean - set(ids(kept))) <= 0.05 * len(clean)


def test_documents_without_language_go(spark, documents):
    kept = STAGES["language"](spark, documents, SMALL)
    assert kept.columns == documents.columns
    gone = set(ids(documents)) - set(ids(kept))
    assert {9100, 9101, 9102} <= gone and len(gone) <= 8


def test_one_document_of_each_group_stays(spark, documents):
    kept = STAGES["near_duplicates"](spark, documents, SMALL)
    assert kept.columns == documents.columns
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = sorted(d for d, n, c in brute(rows) if d == c)
    assert ids(kept) == want


def test_sampled_documents_are_those_drawn(spark, documents):
    kept = STAGES["mixing"](spark, documents, SMALL)
    assert kept.columns == documents.columns
    made = mixing.mixed(documents).select("row.doc_id", "kept", "tokens").collect()
    assert ids(kept) == sorted(r.doc_id for r in made if r.kept)
    share = sum(r.tokens for r in made if r.kept) / sum(r.tokens for r in made)
    assert abs(share - mixing.KEEP) < 0.2


def test_encoded_ids_equal_the_library(spark, documents):
    library = Tokenizer.from_file(WORD_VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in STAGES["bpe"](spark, documents, SMALL).collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)


def test_empty_table_runs_through(spark, documents):
    docs = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
