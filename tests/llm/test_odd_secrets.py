"""Secret scans on texts that used to break them: long runs, long separators, names joined to digits."""

import math
import random
import time
from collections import Counter

import pytest

from pagewright.llm import secret_scan
from tests.llm.test_operators import docs, empty, odd  # noqa: F401


def hot(s, limit, wider):
    """Positions in windows over their limit, by plain computation."""
    out = set()
    for k in range(len(s) - 19):
        w = s[k : k + 20]
        c = Counter(w)
        plain = not set(w) - set("0123456789abcdef") or not set(w) - set("0123456789ABCDEF")
        if -sum(n / 20 * math.log2(n / 20) for n in c.values()) >= (limit if plain else wider) - 1e-9:
            out |= set(range(k, k + 20))
    return out


@pytest.mark.parametrize("c", ["A", "0", "f", "-", "=", "z"])
def test_runs_of_equal_characters(c):
    rng = random.Random(c)
    for n in [*range(1, 61), 200]:
        for tail in ("0a", "12345A", "9fQ2xLr7Zt0vKpB4mWsYhd3G", ""):
            s = "iVBORw0KGgo" + c * n + tail + "".join(rng.choice("0123456789abcdef") for _ in range(30))
            assert {p for a, b in secret_scan.high_entropy(s, 2.9, 3.6) for p in range(a, b)} == hot(s, 2.9, 3.6)


@pytest.mark.parametrize("c", ["-", "-=", "a-", "0_", "=+/"])
def test_time_is_linear_in_separators(c):
    start = time.perf_counter()
    secret_scan.spans(c * 100_000 + "12345A")
    assert time.perf_counter() - start < 5


def test_digits_joined_to_a_name_are_judged_as_digits():
    rng = random.Random(3)
    for _ in range(200):
        s = "".join(rng.choice("0123456789ABCDEF") for _ in range(32))
        if hot(s, 2.9, 3.6):
            assert secret_scan.entropy_spans("key_" + s) and secret_scan.entropy_spans("id=" + s)


def test_allowed_strings():
    for s in ("antidisestablishmentarianism", "hello-world-and-more-words", "a/path/of/several/words", "snake_case_name_of_things_2024", "123e4567-e89b-12d3-a456-426614174000", "2024-01-01-2024-12-31-0000", "=" * 60, "-" * 19 + "1"):
        assert secret_scan.entropy_spans(s) == []


def test_documents_with_runs_and_empty_tables(spark, odd):  # noqa: F811
    rows = [(1, "iVBORw0KGgo" + "A" * 21 + "B="), (2, "0x" + "0" * 24 + "1f"), (3, "f" * 21 + "0a"), (4, "-" * 21 + "12345A"), (5, "-=" * 5000 + "12345A"), (6, "A1b2" * 100_000)]
    d = docs(spark, rows)
    assert secret_scan.scan(d).count() == 6 and secret_scan.redacted(d).count() == 6
    assert secret_scan.redacted(empty(spark)).count() == 0 and secret_scan.redacted(odd).count() == odd.count()
