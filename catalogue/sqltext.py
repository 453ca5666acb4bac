"""Text helper for the oracle SQL."""

from __future__ import annotations

import re

_CALL = re.compile(r"\br(\d)\(")


def exact_rounds(sql: str) -> str:
    """Spell out ``r2(x)``: round the shortest decimal form of a double half up.

    DuckDB rounds the binary value, which turns 38.605 into 38.6; going through
    the decimal text gives 38.61, as rounding does on Spark's side.
    """
    while match := _CALL.search(sql):
        depth, end = 1, match.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[match.end() : end - 1]
        exact = (
            f"cast(round(cast(cast({inner} as varchar) as decimal(38, 24)), {match.group(1)})"
            " as double)"
        )
        sql = sql[: match.start()] + exact + sql[end:]
    return sql
