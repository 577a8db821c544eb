"""URL filters with a bit-parallel wildcard automaton.

All patterns are packed side by side into one multiword Shift-And state:
a bit for every gap before, between and after a pattern's characters.  One
character of a URL moves all patterns at once: states advance over the
characters that accept it, and stay where a wildcard may take it.  In
numpy the same step is made for many URLs together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_pieces

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict): the rule holds for the host and its subdomains
#: and for paths that start with the rule's
RULES = (("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK),
         ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK))
#: globs over the canonical URL that are blocked where no rule fits
BLOCKED_GLOBS = ("**spam**", "**casino**", "**porn**", "**viagra**", "**/ads/**", "**.exe")
_CELLS = 1 << 22         # URL bytes (padded) simulated at once


@dataclass(frozen=True)
class _Pattern:
    """Bytes with the wildcards before each of them and after the last:
    0 none, 1 any run without a slash (``*``), 2 any run (``**``)."""
    literal: bytes
    wild: tuple[int, ...]


def glob(text: str) -> _Pattern:
    """``**`` any run, ``*`` any run without a slash; all else is literal.
    It has to match the whole canonical URL ``.host/path``."""
    literal, wild, at = bytearray(), [0], 0
    raw = text.encode()
    while at < len(raw):
        if raw[at] == 42:
            double = raw[at:at + 2] == b"**"
            wild[-1] = max(wild[-1], 2 if double else 1)
            at += 1 + double
        else:
            literal.append(raw[at])
            wild.append(0)
            at += 1
    return _Pattern(bytes(literal), tuple(wild))


def rule_pattern(host: str, path: str) -> _Pattern:
    """A host with its subdomains, and every path that starts with ``path``."""
    literal = b"." + host.encode() + path.encode()
    return _Pattern(literal, (1, *[0] * (len(literal) - 1), 2))


class Automaton:
    """The packed masks of some patterns."""

    def __init__(self, patterns: list[_Pattern]):
        begins = np.concatenate(([0], np.cumsum([len(p.literal) + 1 for p in patterns]))).astype(int)
        self.ends = [int(e) - 1 for e in begins[1:]]
        self.words = max(1, -(-int(begins[-1]) // 64))
        advance = np.zeros((256, self.words), dtype=np.uint64)
        stay = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        for begin, p in zip(begins.tolist(), patterns):
            self._set(self.start, begin)
            for i, symbol in enumerate(p.literal):
                self._set(advance[symbol], begin + i + 1)
            for i, wild in enumerate(p.wild):
                if wild:
                    for symbol in range(256):
                        if wild == 2 or symbol != 47:
                            self._set(stay[symbol], begin + i)
        self._advance, self._stay = advance, stay

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1 << bit % 64)

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Which pattern matches which whole text (texts x patterns)."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        width = int(sizes.max(initial=0))
        flat = np.frombuffer(b"".join(texts[i].ljust(width, b"\0") for i in order), dtype=np.uint8)
        flat = flat.reshape(len(texts), width)
        live = np.searchsorted(-sizes[order], -np.arange(width), side="left")   # texts longer than the column
        state = np.tile(self.start, (len(texts), 1))
        for column in range(width):
            n = live[column]
            symbols, now = flat[:n, column], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self._advance[symbols]) | (now & self._stay[symbols])
        bits = [(state[:, e // 64] >> np.uint64(e % 64)) & np.uint64(1) for e in self.ends]
        out = np.zeros((len(texts), len(self.ends)), dtype=bool)
        if bits:
            out[order] = np.stack(bits, axis=1) == 1
        return out


def url_parts(url):
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased) and path (then up to ``?``, ``#`` or the end) of a URL
    column; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _judge(rules, globs):
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1], r[2] != BLOCK))
    automaton = Automaton([*(rule_pattern(h, p) for h, p, _ in ranked), *(glob(g) for g in globs)])
    names = [h + p for h, p, _ in ranked]
    verdicts = [v for _, _, v in ranked]

    def run(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        rule_of, verdict_of = [], []
        urls = [f".{h}{p}".encode() for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
        order = sorted(range(len(urls)), key=lambda i: len(urls[i]))
        found = np.zeros((len(urls), len(ranked) + len(globs)), dtype=bool)
        # near equal lengths together; a piece is padded to its longest URL
        for piece in in_pieces(order, lambda i: len(urls[i]), _CELLS):
            found[piece] = automaton.matches([urls[i] for i in piece])
        for row in found:
            hit = np.flatnonzero(row[:len(ranked)])
            rule_of.append(names[hit[0]] if len(hit) else None)
            verdict_of.append(verdicts[hit[0]] if len(hit) else BLOCK if row[len(ranked):].any() else ALLOW)
        return pa.StructArray.from_arrays([pa.array(rule_of, pa.string()), pa.array(verdict_of, pa.string())],
                                          names=["rule", "verdict"])
    return F.arrow_udf(run, "rule string, verdict string")


def filter_urls(pages: DataFrame, rules=RULES, globs=BLOCKED_GLOBS) -> DataFrame:
    """(document, host, path, rule, verdict) of every row of ``pages`` (with
    url; ``document`` holds all its columns).  ``rule`` is the longest
    fitting rule as host and path (ties: the smaller string, block first),
    null if none fits; then the globs decide: blocked if any matches.

    A null or unparsable URL has an empty host and path, fits no rule and is
    allowed unless a glob matches ``.``; repeated rows get one row each; an
    empty table gives an empty result."""
    host, path = url_parts(F.col("document.url"))
    parsed = pages.select(F.struct("*").alias("document")).select("document", host.alias("host"), path.alias("path"))
    judged = parsed.withColumn("judged", _judge(tuple(rules), tuple(globs))("host", "path"))
    return judged.select("document", "host", "path", "judged.rule", "judged.verdict")
