"""The physical plan of a DataFrame as text."""

from __future__ import annotations

import contextlib
import io


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
