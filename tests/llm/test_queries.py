"""Every query with SQL, compared with DuckDB; contracts of the others on the smallest tables."""

import pytest

from riskmart.llm.queries import ORACLE, QUERIES
from tests.oracle import TESTDATA, compare, connect

FOLDER = str(TESTDATA / "sf0.001")
COLUMNS = {
    "op1_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op2_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7_toxicity": "doc_id held_out score predicted",
}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, FOLDER, QUERIES[name], ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_a_document(spark, duck, name):
    rows = QUERIES[name](spark, FOLDER)
    assert set(COLUMNS[name].split()) <= set(rows.columns)
    ids = sorted(r["doc_id"] for r in rows.collect())
    assert ids == [r[0] for r in duck.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]
