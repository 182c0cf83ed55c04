"""Every stage of the pipeline takes awkward rows, empty tables and extra columns."""

import pytest

from helpers import AWKWARD, documents, with_clashes


def labels(spark, folder):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 0), (12, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("rows", [AWKWARD, []], ids=["awkward", "empty"])
def test_stages(spark, tmp_path, rows):
    import corpus_pipeline

    folder = labels(spark, str(tmp_path))
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = with_clashes(documents(spark, rows))
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{number}")
        back = spark.read.parquet(f"{folder}/{number}")
        if number < 3:
            assert back.columns == docs.columns, name
        assert (back.count() > 0) == bool(rows), name
