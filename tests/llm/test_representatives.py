"""One row of each component stays, whatever its doc_id."""

import random

from pagewright.llm import simhash
from tests.llm.test_operators import docs, prose


def test_unlike_documents_of_one_id_or_none_stay(spark):
    rng = random.Random(5)
    texts = [prose(rng, 80, 3000) for _ in range(4)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[0]), (8, texts[2]), (8, texts[3]), (8, texts[3]), (9, texts[3])]
    kept = simhash.representatives(docs(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, texts[0]), (0, texts[1]), (8, texts[2]), (8, texts[3])])
