"""Helpers for comparing frames and reading plans."""

from contextlib import redirect_stdout
from io import StringIO


def rows(df):
    """Rows as plain tuples, sorted by text so that nulls do not matter."""
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df, run=False):
    """Physical plan text; with ``run`` what adaptive execution made of it."""
    if not run:
        out = StringIO()
        with redirect_stdout(out):
            df.explain()
        return out.getvalue().split("== Initial Plan ==")[0]
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().executedPlan().toString()
    return "\n".join(_without_initial_plans(executed.splitlines()))


def _without_initial_plans(lines):
    """The plan of a subquery lists its initial form after the final one, indented at least
    as far as its heading."""
    skipped_from = None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*"))
        if "== Initial Plan ==" in line:
            skipped_from = depth
        elif skipped_from is not None and (depth < skipped_from or "== Final Plan ==" in line):
            skipped_from = None
        if skipped_from is None:
            yield line
