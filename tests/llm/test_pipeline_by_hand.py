"""The pipeline against a plain version of each stage, and on nulls, repeated ids, clashing names and empty tables."""

import random

import pytest

from pagewright.llm import decontamination, quality, secret_scan
from tests.llm.test_near_copies import least_of_each
from tests.llm.test_operators import prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def saved(spark, folder, docs, labels, items):
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_every_row_is_that_of_the_plain_stages(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng = random.Random(41)
    items = [(k, prose(rng, 25, 4000)) for k in range(12)]
    rows, labels = [], []
    for i in range(240):
        t = prose(rng, rng.randint(60, 200), 5000).split()
        bad = i % 11 == 0
        if bad:
            t = [f"{w}##$$" for w in t]
        elif i % 7 == 0:
            t = rng.choice([x for j, x in rows if j % 11]).split()
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = "edited"
        elif i % 13 == 0:
            t[5:5] = items[rng.randrange(12)][1].upper().split()
        elif i % 5 == 0:
            t.insert(9, rng.choice(["password=abcDEF123456xyz", "AKIA" + "Q1" * 8, "iVBORw0KGgo" + "A" * 25 + "B9xK2m="]))
        rows.append((i, " ".join(t)))
        if i % 2:
            labels.append((i, int(not bad), 0))
    rows += [(500, None), (501, ""), (502, "too short")]
    sf = saved(spark, tmp_path, [(i, t, "en", "s", 0) for i, t in rows], labels, items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    forests = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = [(i, t) for i, t in rows if quality.verdicts([(t or "").encode()], forests)[2][0]]
    assert 0 < len(kept) < len(rows) and not {500, 501, 502} & {i for i, _ in kept} and not any(i % 11 == 0 for i, _ in kept)
    texts, left = dict(kept), least_of_each(kept)
    assert len(left) < len(kept)
    shingles = lambda t: decontamination.shingles(decontamination.words(t.encode()))
    asked = [shingles(t) for _, t in items]
    clean = {i for i in left if not any(len(q & shingles(texts[i])) >= 0.8 * len(q) for q in asked)}
    assert got.keys() == clean and len(clean) < len(left)
    library = Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    masked = {i: secret_scan.masked(texts[i], "[SECRET]") for i in clean}
    assert any("[SECRET]" in t for t in masked.values())
    for i, t in masked.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert list(got[i].ids) == ids and got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rng = random.Random(43)
    a, b = prose(rng, 90, 4000), prose(rng, 90, 4000)
    odd = [(None, a, None, None, None), (None, b, None, None, None), (1, a, "en", "s", 1), (1, prose(rng, 80, 4000), "en", "s", 1), (2, None, None, None, None), (3, "", "", "", 0), (4, prose(rng, 60_000, 9000), "en", "s", 1), (5, "x" * 100_000, "en", "s", 1)]
    sf = saved(spark, tmp_path / "odd", odd, [(None, None, None), (1, 1, None)], [(None, None), (1, ""), (2, "never seen words in any text here")])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wide = docs.selectExpr("*", "1 AS label", "2 AS fp", "3 AS root", "4 AS kept", "5 AS digest", "6 AS key", "true AS clean", "7 AS block")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, sf)
        assert out.columns == wide.columns, name
        out.collect()
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    # the first copy of a has the least id that isn't null; two texts without an id stay apart
    near = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert sorted((r.doc_id or 0, r.text == a) for r in near.where("length(text) < 2000 and length(text) > 0").collect()) == [(0, False), (1, False), (1, True)]
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == {None, 1, 4}
    none = saved(spark, tmp_path / "none", [], [], [])
    assert corpus_pipeline.run(spark, none).count() == 0
