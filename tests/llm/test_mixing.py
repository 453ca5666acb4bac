"""Raking: margins, probabilities, and documents drawn."""

import numpy as np
import pytest

from stormgauge.llm import mixing


def cells(seed):
    rng = np.random.default_rng(seed)
    grid = np.stack(np.meshgrid(range(6), range(4), range(3), indexing="ij"), -1).reshape(-1, 3)
    tokens = rng.integers(0, 1000, len(grid)) * (rng.random(len(grid)) < 0.8)
    names = {m: list("abcdef"[:n]) for m, n in zip(mixing.MARGINS, (6, 4, 3))}
    return mixing.Cells({m: grid[:, k] for k, m in enumerate(mixing.MARGINS)}, names, tokens)


@pytest.mark.parametrize("seed", range(5))
def test_all_margins_hold_after_raking(seed):
    table = cells(seed)
    targets = mixing.default_targets(table)
    raked = mixing.rake(table, targets, 200)
    for m, code in table.codes.items():
        share = np.bincount(code, weights=raked, minlength=len(table.names[m])) / raked.sum()
        assert np.allclose(share, targets[m], atol=1e-6)
    assert (raked[table.tokens == 0] == 0).all()


@pytest.mark.parametrize("keep", [0.05, 0.6, 0.95, 1.0])
def test_expected_tokens_meet_the_budget(keep):
    table = cells(9)
    raked = mixing.rake(table, mixing.default_targets(table))
    p = mixing.probabilities(table.tokens, raked, keep)
    assert ((p >= 0) & (p <= 1)).all()
    assert np.isclose((p * table.tokens).sum(), keep * table.tokens.sum(), rtol=1e-6)


def test_documents_are_drawn_and_columns_kept(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 5 if i % 3 else 0}", "ab"[i % 2], i) for i in range(3000)]
    rows += [(None, "x y", None, None, 0), (5000, None, "s0", "a", 0), (5001, " \n", "s0", "a", 0)]
    rows += [(7, rows[7][1], rows[7][2], rows[7][3], 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens int")
    made = mixing.mixed(frame)
    found = made.select("row.*", "kept", "probability").collect()
    assert len(found) == len(rows) and found[0].asDict().keys() >= set(frame.columns)
    assert not any(r.kept for r in found if r.doc_id in (5000, 5001))
    assert len({r.kept for r in found if r.doc_id == 7}) == 1
    total = sum(len(r.text.split()) for r in found if r.text)
    kept = sum(len(r.text.split()) for r in found if r.kept)
    assert abs(kept / total - mixing.KEEP) < 0.04
    assert mixing.mixed(frame.where("false")).count() == 0


def test_forms_and_tokens(spark):
    texts = ["a|b|c", "x = 1;\ny", "- one\n- two", "a\nb\nc\nd\ne", "Some prose.", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [tuple(r) for r in frame.select(mixing.form_topic(), mixing.token_count()).collect()]
    assert [g[0] for g in got] == ["table", "code", "list", "lines", "prose", "prose", "prose"]
    assert [g[1] for g in got] == [1, 4, 4, 5, 2, 0, 0]
