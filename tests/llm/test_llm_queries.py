"""Queries next to their SQL, and the pipeline stage by stage, on the smallest data."""

from __future__ import annotations

import pytest
from compare import compare, connect

import corpus_pipeline
from ledgerloom.llm import catalog

FOLDER = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert compare(spark, connect(FOLDER), catalog.queries()[name], SQL[name], FOLDER) == ""


#: Columns that each result has, and the table with a row for each of its rows, where there is one.
CONTRACTS = {
    "op1_line_dedup": ("doc_id line class_doc_id class_line links removed", None),
    "op2_latent_decontamination": ("doc_id item_id start words common", None),
    "op3_best_fit_packing": ("doc_id piece start length ids_crc32 sequence_id offset", None),
    "op4_temporal_url_lists": ("page_id day lists n_entries blocked", "pages"),
    "op5_warc_normaliser": ("page_id payload_bytes payload_digest record_type refers_to", "pages"),
    "op6_sampled_splitters": ("doc_id size text_crc32 law shard slot grown_shard", "documents"),
    "op7_simhash_near_dedup": ("doc_id fingerprint component_id", "documents"),
    "op8_risk_controlled_quality": ("doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "documents"),
    "op9_substring_dedup": ("doc_id n_words n_removed kept_sha256", "documents"),
    "op10_recurrent_toxicity": ("doc_id held_out score predicted", "documents"),
    "op11_conversation_repair": ("conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256", None),
    "op12_merkle_manifest": ("doc_id leaf subroot root proof_sha256 folded_root verified", "documents"),
    "op13_bucket_pointer_dedup": ("doc_id n_bytes n_removed n_spans kept_sha256", "documents"),
}


def test_one_query_for_each_operator():
    assert sorted(catalog.queries()) == sorted(CONTRACTS)


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract(spark, name):
    columns, table = CONTRACTS[name]
    got = catalog.queries()[name](spark, FOLDER)
    assert got.columns == columns.split()
    if table:
        assert got.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_pipeline_of_odd_rows(spark):
    words = [f"w{k}" for k in range(400)]
    clean = " ".join(words[:120])
    rows = [(1, clean), (2, clean), (3, " ".join(words[150:260]) + "\n" + clean), (4, None), (5, ""), (None, " ".join(words[270:330])), (6, " ".join(words[350:]))]
    item = next(r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect())
    rows += [(7, " ".join(words[330:350]) + " " + item), (6, rows[6][1])]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left.append({r.doc_id for r in docs.collect()})
    assert left[0] == {1, 2, 3, 4, 5, 6, 7, None}
    assert left[1] == {1, 3, 4, 5, 6, 7, None}
    assert left[2] == {1, 3, 4, 6, 7, None}
    assert left[3] == left[4] == {1, 3, 4, 6, None}


def test_only_the_leaking_row_of_a_number_goes(spark):
    item = next(r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect())
    clean = [" ".join(f"w{k}" for k in range(a, a + 60)) for a in (0, 100, 200)]
    rows = [(None, clean[0]), (None, f"{clean[1]} {item}"), (None, None), (7, clean[1]), (7, f"{clean[0]} {item}"), (7, f"{clean[0]} {item}"), (7, clean[2]), (8, item)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_leaks(spark, docs, FOLDER)
    assert left.columns == docs.columns
    assert {(r.doc_id, r.text) for r in left.collect()} == {(None, clean[0]), (None, None), (7, clean[1]), (7, clean[2])}
