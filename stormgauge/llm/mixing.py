"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic.  Raking scales the cells' token
weights to the target share of each source, each language and each topic in turn, until
all margins hold; the ratio of raked to present tokens of a cell, times a factor that sets
the size of the sample, is the probability by which its documents are drawn.  Where a
probability would exceed 1 the cell is taken whole and the factor makes up for it in the
others.  A document is drawn if a hash of its id falls below its probability.

The table of cells is small: it has one row for each combination that occurs, and is raked
on the driver below a checked bound, above which the call fails and asks for coarser
sources.  Documents are only counted, native and pre-aggregated, so a source with a third
of all rows is no hot key, and drawing is a map-side lookup.

A null source, language or topic is a value of its own.  Documents without text have no
tokens and take no part in the weights; they are kept out of the sample.  Rows without id
are drawn by a hash of their text, repeated rows share a fate, other columns pass through,
and an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARGINS = ("source", "lang", "topic")
MAX_CELLS = 500_000
# present shares are raised to these powers and normalised: below 1 lifts the small ones
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.8}
KEEP = 0.6
ITERATIONS = 50


def token_count(text: str = "text") -> Column:
    """Number of runs of bytes other than blank and 0x09-0x0D."""
    runs = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(runs, r"[\x20\x09-\x0D]+", "")).cast("long")


def form_topic(text: str = "text") -> Column:
    """A topic by the form of a text, where no better one is known.

    ``table`` (bars between columns), ``code`` (braces or semicolons at line ends), ``list``
    (lines that begin with a dash, star or number), ``lines`` (many short lines) or
    ``prose``.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(t.rlike(r"\|[^|\n]*\|"), "table")
        .when(t.rlike(r"[;{}][ \t]*\n"), "code")
        .when(t.rlike(r"(^|\n)[ \t]*([-*]|[0-9]+[.)]) "), "list")
        .when(t.rlike(r"(\n[^\n]{1,40}){4}"), "lines")
        .otherwise("prose")
    )


@dataclass
class Cells:
    """Contingency table: codes of each margin's value, tokens, and the names of the values."""

    codes: dict[str, np.ndarray]
    names: dict[str, list]
    tokens: np.ndarray


def default_targets(cells: Cells) -> dict[str, np.ndarray]:
    out = {}
    for margin, code in cells.codes.items():
        share = np.bincount(code, weights=cells.tokens, minlength=len(cells.names[margin]))
        share = (share / max(share.sum(), 1)) ** POWERS.get(margin, 1.0)
        out[margin] = share / max(share.sum(), 1e-300)
    return out


def rake(cells: Cells, targets: dict[str, np.ndarray], iterations: int = ITERATIONS) -> np.ndarray:
    """Raked tokens of each cell, with the present total.

    Values without tokens cannot be reached; their target goes to the others in proportion.
    """
    total = cells.tokens.sum()
    weight = cells.tokens.astype(float)
    for _ in range(iterations):
        worst = 0.0
        for margin, code in cells.codes.items():
            now = np.bincount(code, weights=weight, minlength=len(cells.names[margin])).astype(float)
            goal = np.where(now > 0, targets[margin], 0)
            goal = goal / max(goal.sum(), 1e-300) * total
            factor = np.divide(goal, now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, float(np.abs(factor[now > 0] - 1).max(initial=0)))
            weight = weight * factor[code]
        if worst < 1e-9:
            break
    return weight


def probabilities(tokens: np.ndarray, raked: np.ndarray, keep: float) -> np.ndarray:
    """Probability of each cell so that a share ``keep`` of the tokens is expected.

    With cells in falling order of their ratio, the first few are taken whole; the factor
    for the others follows from what is left of the budget.
    """
    some = tokens > 0
    ratio = np.divide(raked, tokens, out=np.zeros(len(tokens)), where=some)
    budget = keep * tokens.sum()
    order = np.argsort(-ratio, kind="stable")
    r, t = ratio[order], tokens[order].astype(float)
    before = np.concatenate(([0.0], np.cumsum(t)[:-1]))
    rest = np.cumsum((t * r)[::-1])[::-1]
    factor = np.divide(budget - before, rest, out=np.zeros(len(t)), where=rest > 0)
    fits = np.flatnonzero(factor * r <= 1)
    best = factor[fits[0]] if len(fits) else np.inf
    with np.errstate(invalid="ignore"):
        return np.where(some, np.minimum(1.0, ratio * best), 0.0)


def _codes(values) -> tuple[np.ndarray, list]:
    names = sorted(set(values), key=lambda v: (v is not None, v))
    place = {v: k for k, v in enumerate(names)}
    return np.array([place[v] for v in values], np.int64), names


def fit(tagged: DataFrame) -> tuple[Cells, np.ndarray]:
    """Cells of a frame with the margins and ``tokens``, and their probabilities."""
    counts = tagged.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    rows = counts.limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells: use coarser sources")
    rows.sort(key=lambda r: tuple((r[m] is not None, str(r[m])) for m in MARGINS))
    codes, names = {}, {}
    for m in MARGINS:
        codes[m], names[m] = _codes([None if r[m] is None else str(r[m]) for r in rows])
    cells = Cells(codes, names, np.array([r.tokens or 0 for r in rows], np.int64))
    raked = rake(cells, default_targets(cells))
    return cells, probabilities(cells.tokens, raked, KEEP)


def mixed(
    docs: DataFrame,
    topic: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """All rows as ``(row, source, lang, topic, tokens, probability, kept)``; ``row`` is whole."""
    tagged = docs.select(
        F.struct("*").alias("row"),
        F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"),
        (form_topic(text) if topic is None else topic).cast("string").alias("topic"),
        token_count(text).alias("tokens"),
        draw(doc_id, text).alias("draw"),
    )
    cells, p = fit(tagged)
    rows = [
        (*(cells.names[m][cells.codes[m][k]] for m in MARGINS), float(p[k])) for k in range(len(p))
    ]
    schema = "source_c string, lang_c string, topic_c string, probability double"
    # at most MAX_CELLS rows, as checked
    found = F.broadcast(docs.sparkSession.createDataFrame(rows, schema))
    same = [F.col(m).eqNullSafe(F.col(f"{m}_c")) for m in MARGINS]
    joined = tagged.join(found, same, "left")
    kept = (F.col("tokens") > 0) & (F.col("draw") < F.col("probability"))
    return joined.select("row", *MARGINS, "tokens", "probability", kept.alias("kept"))


def draw(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A number in [0, 1) from the md5 of the id as text, or of the text where it is null."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit(""))
    return F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double") / float(1 << 48)
