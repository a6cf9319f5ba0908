"""The pipeline, the registration of the queries, and that each reads its whole table."""

from __future__ import annotations

import base64
import subprocess
import sys

import numpy as np
import public_tokenizers as P
import tiktoken
from llm_fixtures import EDGE_ROWS, LOWER, read_documents, table
from test_mixing_and_minhash import near_by_hand

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMOKE
from tierline.llm import queries


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


def test_every_query_returns_a_row_for_every_input_row(spark):
    counts = {t: spark.read.parquet(f"{SF_SMOKE}/{t}.parquet").count() for t in ("documents", "embeddings")}
    for name, query in queries.QUERIES.items():
        if int(name[2:].split("_")[0]) < 10:  # the others return passages, steps, ranks and nodes
            assert query(spark, SF_SMOKE).count() == counts["embeddings" if name.startswith("op3_") else "documents"], name


def test_pipeline_bounds_its_batches_and_keeps_a_setting(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, docs = spark.conf.get(key, None), spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    try:
        for at in (0, 2, 4):
            spark.conf.unset(key)
            corpus_pipeline.STAGES[at][1](spark, docs, SF_SMOKE)
            assert spark.conf.get(key) == f"{4 << 20}b"
        spark.conf.set(key, "1000000b")
        corpus_pipeline.STAGES[4][1](spark, docs, SF_SMOKE)
        assert spark.conf.get(key) == "1000000b"
    finally:
        spark.conf.unset(key)
        if before is not None:
            spark.conf.set(key, before)


def test_worker_gives_freed_memory_back():
    code = """
import re
from tierline.llm.common import freeing
def mb():
    return int(re.search(r"Anonymous:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
held = [bytearray(b"x" * 60_000) for _ in range(3000)]
del held[:-1]  # the last one keeps the top of the heap
kept = mb()
assert list(freeing(iter([1, 2]))) == [1, 2]
print(kept - mb())
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
    assert float(run.stdout) > 100


def stages_by_hand(rows):
    """All stages but the mix in plain Python."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    last = {}
    for r in rows:
        key = (r[1] or "").translate(LOWER)
        last[key] = max(last.get(key, r), r, key=lambda r: (r[0] is not None, r[0] or 0))
    rows = list(last.values())
    kept = {i for i, _, _, keep in near_by_hand(rows, 5, 80) if keep}
    return [r for r in rows if r[0] in kept]


def test_pipeline_matches_its_stages_by_hand(spark):
    rows = read_documents(SF_SMOKE)
    expected = {r[0]: r[1] for r in stages_by_hand(rows)}
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    columns = docs.columns
    from tierline.llm.common import written
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = written(stage(spark, docs, SF_SMOKE), "test-stage")
        assert docs.columns == columns
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == expected
    mixed = written(corpus_pipeline.STAGES[3][1](spark, docs, SF_SMOKE), "test-stage")
    assert mixed.columns == columns
    got = corpus_pipeline.run(spark, SF_SMOKE)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in mixed.collect())
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tk = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got.collect():
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == tk.encode_ordinary(expected[r["doc_id"]])


def test_stages_on_edge_cases_and_an_empty_table(spark):
    for rows in (EDGE_ROWS, []):
        docs = table(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_SMOKE)
            docs.count()
