"""Python-literal dict cells (``{'a': True, 'b': None}``) -> JSON text.

Used only as the fallback of :func:`sentimart.operators.projection.
parse_struct_column` for cells the JVM JSON reader cannot read faithfully
(booleans, ``None``, backslash escapes).  A vectorised (Arrow) pandas UDF;
the per-cell work is one ``ast.literal_eval`` + ``json.dumps``.
"""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_to_json_text(cell: str | None) -> str | None:
    """One cell: Python literal -> JSON; unreadable input -> NULL.  A cell too
    large or too deep to parse fails the task instead of losing its fields."""
    if cell is None:
        return None
    try:
        value = ast.literal_eval(cell)
    except (ValueError, SyntaxError, TypeError):
        return None
    try:
        return json.dumps(value, ensure_ascii=False, allow_nan=True)
    except (TypeError, ValueError):
        return None


@F.pandas_udf(T.StringType())
def literal_to_json(cells: pd.Series) -> pd.Series:
    return cells.map(literal_to_json_text, na_action="ignore")
