"""The pipeline as a whole, stage by stage, against what each stage promises."""

import corpus_pipeline
from landcarbon.llm import decontaminate, order_minhash, secret_scan, weak_quality
from landcarbon.llm.common import read, staged

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, FOLDER, "documents")
    first = staged(corpus_pipeline.quality(spark, docs, FOLDER))
    rejected = weak_quality.scored(docs, weak_quality.train(docs)).filter("rejected").count()
    assert first.columns == docs.columns and first.count() == docs.count() - rejected

    second = staged(corpus_pipeline.near_duplicates(spark, first, FOLDER))
    assert second.columns == docs.columns and second.count() == order_minhash.classes(first).select("class_id").distinct().count()

    third = staged(corpus_pipeline.benchmark(spark, second, FOLDER))
    blocks = decontaminate.automata(read(spark, FOLDER, "benchmark"))
    assert third.columns == docs.columns and decontaminate.report(decontaminate.matches(third, blocks)).filter("contaminated").count() == 0

    fourth = staged(corpus_pipeline.secrets(spark, third, FOLDER))
    assert fourth.columns == docs.columns and fourth.count() == third.count()
    assert secret_scan.secrets(fourth).filter("n_assign + n_access + n_hex > 0").count() == 0

    last = corpus_pipeline.run(spark, FOLDER)
    assert last.count() == fourth.count()
