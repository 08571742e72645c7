import sys
from pathlib import Path

import pytest
from corpus import empty, frame

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline
from arraymetrics.llm import queries

SF = "/root/testdata/sf0.001"


def _tables(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "seven quiet harbour lights under the copper stone walking nobody market")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_keep_columns_and_decide(spark, tmp_path):
    _tables(spark, frame(spark), tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "benchmarks", "tokens"]
    docs = frame(spark)
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "tokens":
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[3] < sizes[2]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, out.collect())) and run.count() == sizes[-1]


def test_empty_tables(spark, tmp_path):
    _tables(spark, empty(spark), tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_registered_queries_read_whole_tables(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_bpe_codec", "op6_quality_classifier", "op10_language_id"):
        assert queries.QUERIES[name](spark, SF).count() == n
