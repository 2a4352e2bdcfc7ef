"""Secret scans: three patterns, and windows of high Shannon entropy in strings of one character class.

Base patterns (assignments of secrets, access keys, long hexadecimal runs) are matched leftmost and
without overlap per kind.  Candidate strings are also slid over by a window whose entropy is kept by
incremental counts; windows over a class's limit, merged, are spans of kind `entropy`, unless the
string is on the allow-list.  A window's limit is that of the class of the characters it holds, so that
hexadecimal digits joined to a name are judged as such.  Positions count code points; ends are exclusive.

A null text counts as empty: no spans.  Repeated rows give repeated results, an empty table an empty
one.  Texts of any length are read whole, in time linear in their length.  Other columns aren't read
by `scan`; `redacted` keeps them all.
"""

from __future__ import annotations

import re
from hashlib import sha256
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns and least lengths of the base kinds, in the order in which they are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "entropy")
LEAST_VALUE, LEAST_ACCESS = 12, 18

#: Letters that every assignment holds in one of these runs, in lower case.
HINTS = ("passw", "secret", "token", "api")

WINDOW = 20
#: Least bits of entropy of a window by class.  Of 20 random digits of base 16 nearly all windows have 2.9, of base 64 3.6.
LIMITS = {"hex": 2.9, "base64": 3.6}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
#: Characters that no hexadecimal string in small, or in capital letters holds.
NOT_SMALL, NOT_CAPITAL = (frozenset("ghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-" + other) for other in ("ABCDEF", "abcdef"))
#: Strings that look random but are no secrets: one kind of letters or digits, words joined by - or _, paths of words,
#: numbers joined likewise, UUIDs.  No part can begin where another repeats, so matching takes time linear in the length.
ALLOWED = re.compile(r"(?:[A-Za-z]+|[0-9]+|[A-Za-z]*[-_/=+][A-Za-z_/=+-]*[0-9]{0,4}|[0-9]*[-_/=+][0-9_/=+-]*|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})\Z")

#: n log2 n for counts in a window.
TERM = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def high_entropy(string: str, limit: float, wider: float | None = None) -> list[tuple[int, int]]:
    """Merged windows of the string with at least that entropy, or `wider` where a window isn't hexadecimal; each step changes two counts."""
    counts: dict[str, int] = {}
    total, found, others = 0.0, [], [0, 0]
    bound = WINDOW * (log2(WINDOW) - limit) + 1e-9
    bound_wide = bound if wider is None else WINDOW * (log2(WINDOW) - wider) + 1e-9
    for end, c in enumerate(string, 1):
        if end > WINDOW:  # what leaves goes first: no count is ever above WINDOW
            old = string[end - WINDOW - 1]
            n = counts[old]
            total += TERM[n - 1] - TERM[n]
            counts[old] = n - 1
            others[0] -= old in NOT_SMALL
            others[1] -= old in NOT_CAPITAL
        n = counts.get(c, 0)
        total += TERM[n + 1] - TERM[n]
        counts[c] = n + 1
        others[0] += c in NOT_SMALL
        others[1] += c in NOT_CAPITAL
        if end >= WINDOW and total <= (bound_wide if others[0] and others[1] else bound):
            if found and found[-1][1] >= end - WINDOW:
                found[-1] = (found[-1][0], end)
            else:
                found.append((end - WINDOW, end))
    return found


def entropy_spans(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        string = m[0]
        if not (string.isalpha() or ALLOWED.match(string)):
            out += [(m.start() + a, m.start() + b) for a, b in high_entropy(string, LIMITS["hex"], LIMITS["base64"])]
    return out


def spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind, in KINDS' order."""
    low = text.lower()
    assign = [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE] if any(h in low for h in HINTS) else []
    access = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS] if "AKIA" in text else []
    return [assign, access, [m.span() for m in HEX.finditer(text)], entropy_spans(text)]


def listed(by_kind: list[list[tuple[int, int]]]) -> str:
    rows = sorted((a, k, b) for k, found in enumerate(by_kind) for a, b in found)
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in rows)


def scan(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans of every document."""

    def run(batches):
        for batch in batches:
            out = []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = spans(text or "")
                out.append((i, *(len(x) for x in found[:3]), sha256(listed(found[:3]).encode()).hexdigest(), listed(found)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate([pa.int64()] * 4 + [pa.string()] * 2)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def masked(text: str, mask: str) -> str:
    """The text with each maximal run covered by spans replaced by the mask."""
    out, at = [], 0
    for a, b in sorted(s for found in spans(text) for s in found):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns, secrets in text replaced; null stays null."""

    @F.pandas_udf("string")
    def mask_all(texts):
        return texts.map(lambda t: None if t is None else masked(t, mask))

    return docs.withColumn("text", mask_all("text"))
