"""Plan inspection helpers for tests and tuning (no execution)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_SHUFFLE = re.compile(r"(?<!Broadcast)Exchange \(\d+\)")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text: what ``df.explain(mode)`` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def plan_tree(df: DataFrame) -> str:
    """Just the operator tree of the formatted plan."""
    return plan_text(df).split("\n\n")[0]


def count_shuffles(df: DataFrame) -> int:
    """Shuffle exchanges in the operator tree (before adaptive re-planning)."""
    return len(_SHUFFLE.findall(plan_tree(df)))
