"""Secret scans.

Three fixed patterns find credentials with a known shape.  Beside them, every
candidate string (a run of token characters) is scanned with a window that
slides one character at a time; the window's Shannon entropy is kept up to
date from incremental character counts and compared with the threshold of the
window's character class, which incremental counts of kinds of characters give:
hexadecimal digits, letters alone, letters between separators, or any token
characters.  Windows at or above it are joined to one span.  Windows that
overlap what the allow-list knows are dropped, the rest of the candidate is
scanned like any other.

Defined results: a null text is an empty one and has no span; texts are
scanned whole whatever their length; repeated rows give repeated results; an
empty table gives an empty result; other columns pass through untouched.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "entropy")

SPANS_TYPE = "array<struct<kind:string,start:int,end:int>>"

# Fixed patterns of the scan.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

#: Kinds of characters: digits, a-f, A-F, other letters, separators.
KIND_OF = {c: 3 for c in string.ascii_letters} | {c: 4 for c in "+/_=-"}
KIND_OF |= {c: 0 for c in string.digits} | {c: 1 for c in "abcdef"} | {c: 2 for c in "ABCDEF"}


@dataclass(frozen=True)
class EntropyRule:
    """Window length and entropy thresholds in bits per character, by class."""

    window: int = 20
    hex_bits: float = 3.0
    token_bits: float = 3.8
    #: Windows of letters alone, where joined words come near to what random letters reach.
    letter_bits: float = 3.9
    #: Windows of letters and separators without a digit: paths, slugs and names of several words.
    word_bits: float = 4.1
    #: Characters that one of these matches are in no reported window.
    allow: tuple[str, ...] = (
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
        r"(.)\1{7,}",  # filler such as xxxxxxxx
        r"(?i)example|placeholder|changeme|dummy|redacted",
        r"(?i)abcdefgh|01234567|12345678",
    )

    def bits(self, kinds: Sequence[int]) -> float:
        """The threshold of a window's class, from its counts of the kinds of characters."""
        digits, low, high, other, marks = kinds
        if not low + high + other:
            return math.inf  # plain numbers are no tokens
        if digits:
            return self.token_bits if other or marks or (low and high) else self.hex_bits
        return self.word_bits if marks else self.letter_bits


def entropy_windows(run: str, window: int, bits: float | Callable[[Sequence[int]], float]) -> list[tuple[int, int]]:
    """Joined [start, end) spans of the windows with at least ``bits`` of entropy.

    ``bits`` is one threshold, or gives that of each window from the number of
    its characters of each kind.  With n counts c in a window of w characters
    the entropy is log2 w - (sum of c log2 c) / w, so each step changes two
    terms only.
    """
    if len(run) < window:
        return []
    weigh = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    threshold = bits if callable(bits) else lambda kinds: bits
    counts: dict[str, int] = {}
    kinds = [0] * 5
    total = 0.0
    spans: list[tuple[int, int]] = []
    for at, char in enumerate(run):
        have = counts.get(char, 0)
        total += weigh[have + 1] - weigh[have]
        counts[char] = have + 1
        kinds[KIND_OF[char]] += 1
        if at >= window:
            gone = run[at - window]
            have = counts[gone]
            total += weigh[have - 1] - weigh[have]
            counts[gone] = have - 1
            kinds[KIND_OF[gone]] -= 1
        if at >= window - 1 and total <= (math.log2(window) - threshold(kinds)) * window + 1e-9:
            start = at - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((start, at + 1))
    return spans


def token_windows(run: str, rule: EntropyRule) -> list[tuple[int, int]]:
    """Spans of the windows of a candidate that reach their threshold and overlap nothing on the allow-list."""
    known = sorted(m.span() for p in rule.allow for m in re.finditer(p, run))
    spans, at = [], 0
    for start, end in [*known, (len(run), len(run))]:
        spans += [(at + a, at + b) for a, b in entropy_windows(run[at:start], rule.window, rule.bits)]
        at = max(at, end)
    return spans


def find_spans(text: str, rule: EntropyRule = EntropyRule()) -> list[tuple[str, int, int]]:
    """All spans of one text, ordered by start, then kind."""
    spans: list[tuple[int, int, int]] = []
    for found in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII):
        if len(found[2]) >= 12:
            spans.append((found.start(), 0, found.end()))
    if "AKIA" in text:
        for found in re.finditer(ACCESS, text):
            if found.end() - found.start() >= 18:
                spans.append((found.start(), 1, found.end()))
    for found in re.finditer(r"[0-9a-f]{16,}", text):  # a shorter run would be dropped
        spans.append((found.start(), 2, found.end()))
    for found in re.finditer(CANDIDATE, text):
        spans += [(found.start() + a, 3, found.start() + b) for a, b in token_windows(found[0], rule)]
    return [(KINDS[k], start, end) for start, k, end in sorted(spans)]


def spans_of(text: Column, rule: EntropyRule = EntropyRule()) -> Column:
    """Array of (kind, start, end) of a text column."""

    def scan(texts: pa.Array) -> pa.Array:
        kind, start, end, offsets = [], [], [], [0]
        for value in texts:
            for k, a, b in find_spans(value.as_py() or "", rule):
                kind.append(k)
                start.append(a)
                end.append(b)
            offsets.append(len(kind))
        fields = pa.StructArray.from_arrays(
            [pa.array(kind, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["kind", "start", "end"]
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)

    scan.__annotations__ = {"texts": pa.Array, "return": pa.Array}  # read by arrow_udf
    return F.arrow_udf(scan, SPANS_TYPE)(text)


def scan(df: DataFrame, column: str = "text", into: str = "spans", rule: EntropyRule = EntropyRule()) -> DataFrame:
    """``df`` with the spans of every whole text in column ``into``."""
    return df.withColumn(into, spans_of(text_of(column), rule))


def redacted(text: Column, rule: EntropyRule = EntropyRule(), mark: str = "[SECRET]") -> Column:
    """The text with every maximal run of covered characters replaced by ``mark``; null stays null."""

    def cover(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            old = value.as_py()
            spans = sorted((a, b) for _, a, b in find_spans(old, rule)) if old else []
            if spans:
                parts, at = [], 0
                for a, b in spans:
                    if a >= at:
                        parts += [old[at:a], mark]
                    at = max(at, b)
                old = "".join(parts) + old[at:]
            out.append(old)
        return pa.array(out, pa.string())

    cover.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(cover, "string")(text)


def span_digests(df: DataFrame, spans: str = "spans") -> DataFrame:
    """``df`` with counts and digests derived from its spans column."""
    listed = lambda kinds: F.concat_ws(
        ",",
        F.transform(
            F.filter(F.col(spans), lambda s: s["kind"].isin(*kinds)),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
    )
    of_kind = lambda kind: F.filter(F.col(spans), lambda s: s["kind"] == kind)
    counts = {f"n_{k}": F.size(of_kind(k)).cast("long") for k in KINDS}
    return df.withColumns(
        counts | {"base_sha256": F.sha2(listed(KINDS[:3]), 256), "spans_text": listed(KINDS)}
    )
