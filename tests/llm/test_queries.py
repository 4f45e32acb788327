"""Every registered query of the subpackage on the smallest tables, and those with SQL against it."""

import pytest

from cohortlens.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op7_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_mixing": ["doc_id", "size", "source_size", "target", "taken"],
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    found = compare(QUERIES[name](spark, SF), con, ORACLE_SQL[name])
    assert found["ok"], found
    assert found["rows_spark"] > 0


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_gives_its_columns_for_every_document(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert df.columns[: len(COLUMNS[name])] == COLUMNS[name]
    rows = df.collect()
    ids = sorted(x[0] for x in con.sql("SELECT doc_id FROM documents").fetchall())
    assert sorted({r.doc_id for r in rows}) == ids
    assert name == "op5_packing" or len(rows) == len(ids)


def test_folds_and_digests(spark, con):
    import hashlib
    import zlib

    from cohortlens.llm import secret_scan

    texts = dict(con.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    for name, n, k in (("op1_toxicity", 5, 0), ("op7_language", 4, 2)):
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == k) for r in QUERIES[name](spark, SF).collect())
    for r in QUERIES["op4_secrets"](spark, SF).collect():
        base = [x for x in secret_scan.spans(texts[r.doc_id]) if x[2] != "lexed"]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[2] == kind for x in base) for kind in secret_scan.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k, _ in base).encode()).hexdigest()
