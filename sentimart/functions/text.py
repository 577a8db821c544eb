"""Scalar string functions (all built-in Catalyst expressions, codegen'd).

Each function maps Column(s) to a Column and never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (GUEST_SEP, NO_GUEST,
                       TITLE_SEP, VIDEO_LINK_PREFIX)

# --- fixed values ---
# Characters Python's ``str.strip()`` removes (``str.isspace``), as one
# regex class valid in both Java regex and RE2.
PY_WHITESPACE = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}"
                 r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# --- end of fixed values ---
_STRIP_RE = f"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    """SQL ``trim`` - removes ASCII spaces only, keeps tabs/newlines."""
    return F.trim(_c(c))


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()`` - removes every kind of whitespace."""
    return F.regexp_replace(_c(c), _STRIP_RE, "")


def iso_date_prefix(c: Column | str) -> Column:
    """First 10 characters of an ISO-8601 timestamp (``YYYY-MM-DD``)."""
    return F.substring(_c(c), 1, 10)


def to_date_lenient(c: Column | str) -> Column:
    """String to DATE; malformed text becomes NULL (``try_to_date``)."""
    return F.try_to_date(iso_date_prefix(c), "yyyy-MM-dd")


def split_pair(c: Column | str, sep: str = ",") -> tuple[Column, Column]:
    """``"joy, positive"`` -> (``joy``, ``positive``).

    Out-of-range elements are NULL (``get`` never raises under ANSI), and
    both halves are trimmed explicitly instead of relying on a CSV writer
    to drop the blank after the comma.
    """
    parts = F.split(_c(c), sep)
    return F.trim(F.get(parts, 0)), F.trim(F.get(parts, 1))


def title_prefix(c: Column | str) -> Column:
    """Text before the first ``|`` (whole string when absent); the
    result is deliberately not re-trimmed."""
    return F.substring_index(_c(c), TITLE_SEP, 1)


def guest_prefix(c: Column | str) -> Column:
    """Text before the first ``:``, or ``'N/A'`` when there is none."""
    c = _c(c)
    return F.when(c.contains(GUEST_SEP), F.substring_index(c, GUEST_SEP, 1)).otherwise(
        F.when(c.isNotNull(), F.lit(NO_GUEST)))


def remove_newlines(c: Column | str) -> Column:
    """Delete literal ``\\n`` characters (``\\r`` is kept)."""
    return F.replace(_c(c), F.lit("\n"), F.lit(""))


def video_link(videoid: Column | str) -> Column:
    """X11: watch link; NULL id gives NULL link (``concat`` semantics)."""
    return F.concat(F.lit(VIDEO_LINK_PREFIX), _c(videoid))


def video_category(guest: Column | str) -> Column:
    """the video's category by its guest prefix; a NULL guest falls
    through to the last one."""
    g = _c(guest)
    return (F.when(g == NO_GUEST, "Solo").when(g == "Essentials", "Essentials")
            .when(g.startswith("AMA"), "AMA").when(g.startswith("LIVE"), "LIVE EVENT")
            .otherwise("WITH GUEST"))


def _div_half_up(num: Column, den: Column) -> Column:
    """``round_half_up(num / den)`` for non-negative BIGINTs, exactly."""
    n2, d2 = num * 2 + den, den * 2
    return (n2 - F.pmod(n2, d2)) / d2


def percent_of(part: Column, total: Column, scale: int = 2,
               compat_scale6: bool = False) -> Column:
    """``round(100 * part / total, scale)``, half-up on the exact
    rational value.

    Computed in integer arithmetic - ``(2*100*10^s*part + total) div
    (2*total)`` units of ``10^-s`` - so no binary-double artefact can move a
    ``.xx5`` case (23/160 = 14.375 -> 14.38).  The final ``/ 10^s`` is one
    correctly rounded double division, identical in every engine.

    ``compat_scale6`` instead mimics a warehouse that first divides the
    integers to 6 decimals (half-up), then multiplies by 100 and rounds:
    1/113 gives 0.89 there, 0.88 exactly.
    """
    f = 10 ** scale
    p, t = part.cast("bigint"), total.cast("bigint")
    if compat_scale6:
        q6 = _div_half_up(p * 1_000_000, t)                 # part/total in 1e-6 units
        units = _div_half_up(q6.cast("bigint") * (100 * f), F.lit(1_000_000))
    else:
        units = _div_half_up(p * (100 * f), t)
    return units / F.lit(float(f))
