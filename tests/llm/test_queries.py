"""The registered queries against their SQL twins, and the pipeline."""

import check_all
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from orderloom.llm import mixing, neardup, packing, queries, substrings, toxicity

from .conftest import SF, plain


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert check_all.compare(queries.QUERIES[name](spark, SF), check_all.connect(SF),
                             queries.ORACLE[name]) is None


def test_all_are_registered():
    found = entry.queries()
    assert "pipeline" in found and set(queries.QUERIES) <= set(found)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_is_its_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = toxicity.without_toxic(docs, labels)
    kept = substrings.without_repeats(neardup.one_of_each(kept))
    last = packing.pack(mixing.mixed_documents(kept), queries.tokenizer_file("word_bpe_49k.json"))
    assert plain(corpus_pipeline.run(spark, SF).drop("sequence_id", "offset")) == plain(
        last.drop("sequence_id", "offset"))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near duplicates", "substring dedup", "mixing", "packing"]


def test_pipeline_of_odd_rows(spark, docs, tmp_path):
    found = docs
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, SF)
        if name != "packing":
            assert found.columns == docs.columns, name
        found.write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
    assert found.count() > 0


def test_pipeline_of_nothing(spark, no_docs, tmp_path):
    found = no_docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found, SF).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
    assert found.count() == 0
