"""Batch prompts and classifier responses as Catalyst expressions:
prompt building (A4 + X14), response line parsing (X15) and batch-size
validation (X16).

These operate on tables of stored prompts / responses (one row per batch,
group size bounded by the batch size), so re-parsing a response log never
needs Python.  The in-task classifier (``sentimart.operators.classify``)
applies the same rules per call, inside its retry loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..schemas import SENTINEL


def prompt_line(pos: Column, text: Column) -> Column:
    """``Comment <pos>: <text>`` (``pos`` 1-based within the batch)."""
    return F.format_string("Comment %d: %s", pos, text)


def batch_prompt(df: DataFrame, batch_keys: list[str], pos: str, text: str,
                 out: str = "prompt") -> DataFrame:
    """A4: one row per batch with its lines joined by ``\\n`` in ``pos``
    order, plus ``n_comments``.  Each group holds one batch, so its size
    is bounded by the batch size."""
    lines = df.select(*batch_keys, F.struct(F.col(pos).alias("p"),
                                            prompt_line(F.col(pos), F.col(text)).alias("l"))
                      .alias("__pl"))
    g = lines.groupBy(*batch_keys).agg(
        F.count(F.lit(1)).cast("int").alias("n_comments"),
        F.array_sort(F.collect_list("__pl")).alias("__ls"))
    return g.select(*batch_keys, "n_comments",
                    F.array_join(F.transform("__ls", lambda x: x["l"]), "\n").alias(out))


def response_labels(response: Column) -> Column:
    """Array of labels, one per response line: the text after the
    first ``:`` with all surrounding whitespace removed, or the sentinel
    for a line without ``:``.  The response is stripped first, then split
    on ``\\n`` (so an empty response is one unparseable line)."""
    lines = F.split(strip_ws(response), "\n")
    return F.transform(lines, lambda ln: F.when(
        F.instr(ln, ":") > 0,
        strip_ws(F.substr(ln, F.instr(ln, ":") + 1)))
        .otherwise(F.lit(SENTINEL)))


def validated_labels(response: Column, n: Column) -> Column:
    """The parsed labels when there is exactly one line per comment,
    otherwise ``n`` sentinels (the whole batch fails)."""
    labels = response_labels(response)
    return F.when(F.size(labels) == n, labels).otherwise(
        F.array_repeat(F.lit(SENTINEL), n))


def explode_labels(df: DataFrame, keys: list[str], response: str, n: str,
                   label: str = "label") -> DataFrame:
    """Validated labels back to one row per comment: ``(keys, pos, label)``
    with ``pos`` 1..n."""
    # labels are computed once per batch into a column; the per-position
    # lambda then only indexes it (an inlined expression would be
    # re-evaluated for every position)
    with_arr = df.select(*keys, F.col(n).alias("__n"),
                         validated_labels(F.col(response), F.col(n)).alias("__labels"))
    rows = F.transform(F.sequence(F.lit(1), F.col("__n")), lambda i: F.struct(
        i.cast("int").alias("pos"), F.element_at(F.col("__labels"), i).alias(label)))
    return with_arr.select(*keys, F.inline(rows))
