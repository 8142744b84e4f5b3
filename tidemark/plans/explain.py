"""Plan inspection helpers (for tests and tuning): the formatted physical plan
as text and counts of the operators that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_ops(df: DataFrame, pattern: str) -> int:
    """Number of physical-plan nodes whose name matches ``pattern`` (formatted
    plan tree lines such as ``+- Exchange (12)``)."""
    txt = plan_text(df, "formatted").split("\n\n")[0]
    return len(re.findall(rf"(?m)^[\s:+\-|]*{pattern}\b", txt))
