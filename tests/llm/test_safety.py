"""Clashing column names, long texts and hot groups."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from regionloom.llm import secret_scan, similar, simhash, suffix_dedup, text_stats, url_filter

NAMES = ["row", "doc", "txt", "part", "spans", "hash", "base", "weak", "every", "of_doc", "of_hash", "of_part", "none", "c0", "_id", "_hash", "_text", "_doc", "host", "action", "at", "hit", "bucket", "domain", "nth", "fp", "gram", "BLOCKED", "Matched_Domain"]
STAGES = {"redact": secret_scan.redact, "near": simhash.without_near_duplicates, "similar": similar.without_similar, "repeats": suffix_dedup.remove_repeats}


@pytest.mark.parametrize("stage", STAGES)
def test_other_columns_come_back(spark, stage):
    rows = [(1, "password=abcdefgh1234 and so on"), (2, None), (3, "three words here " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in NAMES))
    got = STAGES[stage](docs)
    assert got.columns == docs.columns
    want = {r.doc_id: r for r in docs.collect()}
    found = got.collect()
    assert {r.doc_id for r in found} == {1, 2, 3}
    assert all(r[n] == want[r.doc_id][n] for r in found for n in NAMES)


def test_other_columns_of_captures_come_back(spark):
    captures = spark.sql("SELECT 'http://a.b/' AS url, DATE'2024-02-01' AS fetched").select("*", *(F.lit(n).alias(n) for n in NAMES))
    got = url_filter.filter_captures(captures, spark.sql("SELECT 'a.b' AS domain, 'block' AS action, DATE'2024-01-01' AS dated"))
    row = got.first().asDict()
    assert got.columns == [*captures.columns, "url_host", "url_matched_domain", "url_action", "url_blocked"]
    assert all(row[n] == n for n in NAMES) and row["url_host"] == "a.b" and row["url_action"] == "block" and row["url_blocked"]


def test_redact_is_linear(spark):
    """Thousands of spans in one text."""
    one = "token=abcdefgh12345 é\n"
    docs = spark.createDataFrame([(1, one * 15_000)], "doc_id long, text string")
    began = time.time()
    assert secret_scan.redact(docs).first().text == "[secret] é\n" * 15_000
    assert time.time() - began < 30


def test_redact_merges_overlaps(spark):
    text = "x " + "password: " + "0123456789abcdef" * 2 + " y " + " ".join(f"{k:x}" * 40 for k in range(10, 16)) + " z"
    docs = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in secret_scan.redact(docs).collect()} == {1: "x [secret] y " + " ".join(["[secret]"] * 6) + " z", 2: ""}


def test_hot_buckets_of_repeats(spark, monkeypatch):
    """What is dealt singly gives what the refinement gives."""
    passage = "".join(chr(97 + (k * k * 7 + k * 3) % 26) for k in range(300))
    rows = [(k, f"{k * 7919 % 1000:03d} own text {k}" * 9 + passage + f"{k * 104729} end {k}" * 9) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, suffix_dedup.repeat_report(docs).collect()))
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 5)
    assert sorted(map(tuple, suffix_dedup.repeat_report(docs).collect())) == want
    assert sum(r[2] > 0 for r in want) >= 39


def test_heavy_buckets_of_fingerprints(spark, monkeypatch):
    fps = [(1 << 40) + k for k in range(64)] + [5 << 50]
    distinct = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = simhash.components(simhash.fingerprint_links(distinct)).select("node", "component").collect()
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 8)
    got = simhash.components(simhash.fingerprint_links(distinct)).select("node", "component").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) == 64


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, other int")
    for stage in STAGES.values():
        assert stage(docs).columns == docs.columns and stage(docs).collect() == []


def test_long_texts_in_parts(monkeypatch):
    """Fingerprints and counts don't hang on the parts that a text is taken in."""
    texts = [" ".join(f"W{k * k % 97}\t é{k}" for k in range(n)).encode() for n in (0, 1, 2, 3, 200)] + [b"x" * 500, b" \x0b \n"]
    want = [simhash.fingerprint(t) for t in texts]

    def counted(text):
        raw, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        return np.concatenate([text_stats.class_shares(raw, offsets).ravel(), *(text_stats.hashed_bytes(raw, offsets, n, 256).ravel() for n in (1, 3))])

    counts = [counted(t) for t in texts]
    monkeypatch.setattr(simhash, "PART_BYTES", 7)
    monkeypatch.setattr(text_stats, "PART_BYTES", 5)
    assert [simhash.fingerprint(t) for t in texts] == want
    assert all(np.array_equal(counted(t), c) for t, c in zip(texts, counts, strict=True))
