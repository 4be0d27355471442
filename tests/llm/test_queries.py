import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import difference, duck  # noqa: E402
from llm import odd  # noqa: E402
from recurra.llm import queries  # noqa: E402
from recurra.llm.common import read  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_all_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql_gives_the_same_rows(spark, name):
    result = queries.queries()[name](spark, SMALL)
    assert difference(result, duck(SMALL), queries.oracle_sql()[name]) is None


def test_pipeline_stages(spark, tmp_path):
    docs = read(spark, SMALL, "documents")
    columns, kept = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "byte_bpe"
    ]
    assert kept[0] >= kept[1] >= kept[2] == kept[3] == kept[4]
    whole = corpus_pipeline.run(spark, SMALL)
    assert odd.same_rows(whole, docs)


def test_stages_take_odd_rows(spark):
    docs = odd.documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).collect()
        assert stage(spark, docs.limit(0), SMALL).collect() == []
