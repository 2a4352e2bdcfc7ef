"""Every query with SQL gives the same rows in DuckDB; the others give rows of a stable schema."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from pagewright.plans.driver_queries import QUERIES
from pagewright.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if hasattr(v, "as_tuple"):
        v = float(v)
    return (None if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(ORACLES[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_rows_without_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert df.columns and rows
    if name == "segment_graph":
        ids = {r.segment_id: r.book_id for r in QUERIES["document_segments"](spark, SF).collect()}
        edges = [(r.source_id, r.target_id, r.edge_type) for r in rows]
        assert len(edges) == len(set(edges)) and all(ids[a] == ids[b] for a, b, _ in edges)
        per_book = Counter(ids.values())
        assert Counter(r.book_id for r in rows if r.edge_type == "NEAR") == {b: n - 1 for b, n in per_book.items() if n > 1}
    if name == "concept_links":
        scores = {(r.segment_id, r.concept_id): r.score for r in QUERIES["concept_score"](spark, SF).collect()}
        per = Counter(r.segment_id for r in rows)
        turns = spark.read.parquet(f"{SF}/conversations.parquet").count()
        assert len(per) == turns and max(per.values()) <= 5 and len({(r.segment_id, r.concept_id) for r in rows}) == len(rows)
        lexical = [r for r in rows if r.link_method in ("exact_match", "alias")]
        assert lexical and all(r.confidence == min(1.0, scores[r.segment_id, r.concept_id]) for r in lexical)
    if name == "document_segments":
        ids = [r.segment_id for r in rows]
        assert len(ids) == len(set(ids)) and rows
        per = {}
        for r in rows:
            per.setdefault(r.book_id, []).append(r)
        for own in per.values():
            own.sort(key=lambda r: r.order_key)
            assert [r.next_segment_id for r in own[:-1]] == [r.segment_id for r in own[1:]] and own[0].prev_segment_id is None
