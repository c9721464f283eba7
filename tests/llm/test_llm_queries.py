"""The named queries over whole tables: contract columns, SQL where there is some, the pipeline."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from riskspark.llm import queries
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
    2: "page_id:bigint url:string text:string n_chars:bigint",
    3: "doc_id:bigint n_words:bigint n_removed:bigint kept_sha256:string",
    4: "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    5: "doc_id:bigint held_out:boolean score:double predicted:int",
    6: "doc_id:bigint n_words:bigint n_base:bigint first_word:bigint last_word:bigint base_labels:string labels:string score:double",
    7: "doc_id:bigint n_chars:bigint edited_sha256:string fingerprint:string edited_fingerprint:string near_edited:double near_next:double",
    8: "doc_id:bigint item_id:bigint",
    9: "doc_id:bigint held_out:boolean lang_pred:string score:double",
    10: "doc_id:bigint fingerprint:string component_id:bigint",
    11: "word:string form:string root:string n:bigint n_near:bigint form_n:bigint",
    12: "doc_id:bigint leaf:string subroot:string root:string proof_sha256:string folded_root:string verified:boolean",
    13: "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint",
}
NAMES = {int(re.match(r"op(\d+)_", name)[1]): name for name in queries.QUERIES}


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns_and_one_row_per_row(spark, number):
    df = contract.queries()[NAMES[number]](spark, SF_DIR)
    kinds = dict(df.dtypes)
    for column in COLUMNS[number].split():
        name, kind = column.split(":")
        assert kinds[name] == kind
    if number == 11:
        return
    rows = df.count()
    table = "pages" if number == 2 else "documents"
    whole = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert rows >= whole if number in (1, 13) else 0 < rows < whole if number == 8 else rows == whole


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        rows = {r.doc_id: r for r in after.collect()}
        assert rows.keys() <= before.keys() and len(rows) > 0.7 * len(before), name
        if name != "personal_data":
            assert all(rows[i].text == before[i].text for i in rows), name
        docs = spark.createDataFrame(list(rows.values()), docs.schema)
        before = rows
    assert not any(re.search(r"@mail\d\.example\.com", r.text) for r in before.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == before.keys()
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_package_rules():
    root = Path(__file__).parents[2]
    for path in [*root.glob("riskspark/llm/*.py"), root / "corpus_pipeline.py"]:
        text = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\btempfile\b|\.rdd\b|except ImportError", text), path.name
    others = [p for p in root.glob("riskspark/**/*.py") if "llm" not in p.relative_to(root).parts]
    assert not [p for p in others if "riskspark.llm" in p.read_text()]
