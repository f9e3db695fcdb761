"""Small helper for pandas frames that tasks hand back to Spark."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd


def no_rows(names: Sequence[str]) -> pd.DataFrame:
    """An empty result; untyped columns, since empty number columns do not convert to text."""
    return pd.DataFrame(columns=list(names), dtype=object)
