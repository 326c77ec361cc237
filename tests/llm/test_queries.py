"""The registered queries over the smallest tables."""

import pathlib
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
from marketgrain.llm import common
from marketgrain.llm.registry import ORACLES, QUERIES

FOLDER = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
PROMISED = {
    "op1_repair_ids": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op2_pivot_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op3_prob_minhash": {"doc_id": "bigint", "class_id": "bigint", "kept": "boolean"},
    "op4_co_training": {"doc_id": "bigint", "p_low": "double", "p_toxic": "double", "rejected": "boolean"},
    "op5_kneser_ney_lid": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_pseudonyms": {"doc_id": "bigint", "text": "string", "n_found": "int"},
    "op7_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op8_linear_grouping": {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint",
    },
    "op9_latent_semantic": {"doc_id": "bigint", "item_id": "bigint", "cover": "double"},
    "op10_suffix_tree": {
        "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double",
    },
    "op11_suffix_dawg": {
        "conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string",
    },
    "op12_line_cuckoo": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op13_gnat_codes": {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = entry.queries()[name](spark, str(FOLDER))
    kinds = dict(frame.dtypes)
    assert {c: kinds[c] for c in PROMISED[name]} == PROMISED[name]
    found = frame.collect()
    docs = common.table(spark, str(FOLDER), "documents").count()
    if "doc_id" in kinds and name != "op9_latent_semantic":
        assert len({r["doc_id"] for r in found}) == docs
        assert name == "op8_linear_grouping" or len(found) == docs
    for modulus, operator in ((4, "op5_kneser_ney_lid"), (7, "op10_suffix_tree")):
        if name == operator:
            assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == 2) for r in found)
    if name in ORACLES:
        connection = duckdb.connect()
        for path in FOLDER.glob("*.parquet"):
            connection.sql(f"create view {path.stem} as select * from '{path}'")
        relation = connection.sql(ORACLES[name])
        assert sorted(map(tuple, relation.fetchall())) == sorted(tuple(r[c] for c in relation.columns) for r in found)


def test_all_are_registered():
    assert set(QUERIES) == set(PROMISED) and {*QUERIES, "pipeline"} <= set(entry.queries())
