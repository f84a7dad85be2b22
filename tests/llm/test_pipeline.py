"""The pipeline's stages against brute force, stage by stage."""

import hashlib
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from tessera.llm import mixing, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert all(before[i] == r for i, r in after.items())
        seen[name] = (before, after)
    before, after = seen["quality rules"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    verdicts = con.execute(f"SELECT doc_id, kept, base_failed FROM ({queries.oracle_sql()['op2_repetition_rules']})").fetchall()
    assert set(after) == {i for i, kept, _ in verdicts if kept}
    assert {i for i, _, failed in verdicts if failed} == {i for i, r in before.items() if brute.base_rules(r.text)[5]}
    before, after = seen["exact dedup"]
    assert set(after) == {i for i, w in brute.exact([(i, r.text) for i, r in before.items()]).items() if w[2]}
    before, after = seen["near dedup"]
    ids = sorted(before)
    assert set(after) == set(brute.components(ids, [brute.fingerprint(before[i].text) for i in ids]))
    before, after = seen["mixing"]
    assert set(before) == set(after)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    whole = brute.tiktoken_encoding()
    expected = {i: whole.encode_ordinary(r.text) for i, r in after.items()}
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in docs.collect())
    for r in last:
        ids = expected[r.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(after[r.doc_id].text.encode()).hexdigest()


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = got.collect()
    assert rows and all(hashlib.sha256(texts[r.doc_id].encode()).hexdigest() == r.decoded_sha256 for r in rows)


def test_mixing_leaves_no_document_out(spark):
    """Every row comes once, and again as its leaf's share of the surplus says; rows outside the tree too."""
    from test_operators import leaf_of, mixing_oracle

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(10**6 + k, "some words here " * (5 + k), lang, source, None) for k, (lang, source) in enumerate(
        [(None, "src1"), ("it", "src0"), ("en", None), ("de", "src25"), (None, None), ("fr", "blog")])]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    tree = queries.mixing_tree()
    rows = [(r.doc_id, leaf_of(tree, queries.domain_of(r.source) if (r.source or "").removeprefix("src").isdigit() else "community", r.lang, r.source),
             len(brute.words(r.text))) for r in docs.collect()]
    drawn = mixing_oracle(rows, mixing.with_others(tree), corpus_pipeline.MIX_SURPLUS, corpus_pipeline.MIX_EPOCHS - 1)[1]
    mixed = corpus_pipeline.mixture(spark, docs, SF)
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) == {i for i, _, _ in rows} and len(set(times.values())) > 1
    assert all(times[i] == 1 - (-drawn.get(i, 0) // n) for i, _, n in rows if n)
    found = {(r.domain, r.lang, r.source): r for r in mixing.shares(mixed, tree, queries.domain_column()).collect()}
    assert set(found) == {k for _, k, _ in rows}
    assert abs(sum(r.share for r in found.values()) - 1) < 1e-9
