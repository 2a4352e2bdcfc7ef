"""The pipeline on the smallest tables: each stage's decisions take effect."""

import pytest

from pagewright.llm import decontamination
from pagewright.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_run_gives_the_same(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    kept, columns = docs, docs.columns
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, kept, SF)
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(kept.count())
        assert name == "bpe_encoding" or kept.columns == columns
        if name == "benchmark_decontamination":
            assert decontamination.contaminated(kept, table(spark, SF, "benchmark")).count() == 0
    assert sizes[0] > sizes[1] and sizes[3] == sizes[4] == sizes[5]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()) == sorted(r.doc_id for r in kept.select("doc_id").collect())
