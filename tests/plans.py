"""Count operators in the physical plan of a DataFrame."""

import contextlib
import io
import re


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def count(df, operator: str) -> int:
    """Occurrences of an operator, e.g. ``Exchange hashpartitioning``."""
    return len(re.findall(rf"(?m)^[^A-Za-z\n]*(?:\(\d+\) )?{operator}", plan(df)))


def mentions(df, expression: str) -> int:
    """How often the optimized plan holds an expression, e.g. ``regexp_extract_all``."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(expression)
