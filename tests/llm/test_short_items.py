"""Items of one to three shingles are never missed."""

import random

import xxhash

from pagewright.llm import decontamination
from pagewright.llm.common import Memo


def test_short_items_at_the_start_of_long_documents_are_all_found():
    rng = random.Random(31)
    items = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(5 + k % 3)).encode()) for k in range(1500)]
    index = decontamination.Index(items)
    texts = [decontamination.words(t) + [b"x%d" % rng.randrange(10**6) for _ in range(60)] for _, t in items]
    found = {(text, item) for text, item, *_ in index.matches(texts, Memo(xxhash.xxh64_intdigest))}
    assert {(k, k) for k in range(1500)} <= found
