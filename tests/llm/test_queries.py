"""The registered queries: one for each operator, over whole tables, with the agreed columns."""

import pytest

import __spark_entry__ as entry
from tallycast.llm.queries import QUERIES

COLUMNS = {
    "op1_": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op2_": "query_id:bigint rank:int vec_id:bigint score:bigint",
    "op3_": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op4_": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
    "op5_": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op6_": "doc_id:bigint n_shingles:bigint component_id:bigint",
    "op7_": "page_id:bigint status:string",
    "op8_": "doc_id:bigint first_line:int last_line:int",
    "op9_": "doc_id:bigint item_id:bigint similarity:double",
    "op10_": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op11_": "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    "op12_": "item_id:bigint rank:int doc_id:bigint score:bigint",
    "op13_": "lang:string source:string part:string item:string value:bigint rank:int",
}
ONE_EACH = {"op1_", "op3_", "op5_", "op6_", "op10_", "op11_"}


def test_all_are_registered():
    assert len(QUERIES) == len(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert all(sum(q.startswith(p) for q in QUERIES) == 1 for p in COLUMNS)


@pytest.mark.parametrize("prefix", sorted(COLUMNS))
def test_columns_and_rows(spark, sf_dir, prefix):
    (name,) = [q for q in QUERIES if q.startswith(prefix)]
    out = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[prefix].split()) <= {f"{n}:{t}" for n, t in out.dtypes}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    if prefix in ONE_EACH:
        assert out.count() == documents.count() and out.select("doc_id").distinct().count() == documents.count()
