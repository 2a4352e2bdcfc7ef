"""op7's query scores by more than pairs."""

from pagewright.llm import katz, queries


def test_query_asks_for_order_three(monkeypatch):
    monkeypatch.setattr(queries, "table", lambda spark, d, name: name)
    monkeypatch.setattr(katz, "score", lambda docs, order=2: (docs, order))
    assert queries.op7_katz_scoring(None, "") == ("documents", 3)
