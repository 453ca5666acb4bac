"""Language identification: held-out accuracy and its special cases."""

from stormgauge.llm import langid
from stormgauge.llm.common import fold
from stormgauge.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def test_held_out_accuracy_of_the_query(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    made = QUERIES["op2_hashed_subword_language"](spark, MIDDLE)
    rows = made.where("held_out").join(docs, "doc_id").collect()
    assert made.count() == docs.count()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_texts_without_letters_are_undetermined(spark):
    words = {"aa": "the house of a man and the tree", "bb": "das Haus von dem Mann und der Baum"}
    model = langid.train([words[x] for x in "aa bb".split() * 10], ["aa", "bb"] * 10)
    rows = [(1, None), (2, ""), (3, " 12 .,! \n"), (4, words["aa"] * 20_000), (5, words["bb"]), (5, words["bb"])]
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    made = frame.select("doc_id", langid.identify(model, frame).alias("m")).collect()
    assert [r.m.lang_pred for r in made] == ["und", "und", "und", "aa", "bb", "bb"]
    assert [r.m.score for r in made[:3]] == [0.0] * 3 and not any(r.m.accepted for r in made[:3])
    empty = frame.where("false")
    assert empty.select(langid.identify(model, empty).alias("m")).collect() == []


def test_without_labels_everything_is_undetermined(spark):
    frame = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    model = langid.fit_language_model(frame, fold("doc_id") != 0)
    made = frame.select(langid.identify(model, frame).alias("m")).first().m
    assert (made.lang_pred, made.score, made.accepted) == ("und", 0.0, False)
