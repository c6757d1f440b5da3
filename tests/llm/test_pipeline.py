"""The pipeline, stage by stage, against the stages' SQL twins on each stage's own input."""

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from tabprep.llm import decontaminate, mixing, ngram_join
from tabprep.llm.common import store


def _sql(docs, sf, sql):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{sf}/benchmark.parquet')")
    return con.execute(sql).df()


def test_stages(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, docs, sf), "test-stage")
        seen[name] = (docs.toPandas(), out.toPandas())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == documents.columns
        before, docs = docs, out
    ids = lambda pdf: sorted(pdf["doc_id"])

    before, after = seen["language ID"]
    assert set(ids(after)) <= set(ids(before)) and len(after) >= 0.99 * len(before)

    before, after = seen["n-gram Jaccard join"]
    want = _sql(spark.createDataFrame(before), sf, ngram_join.SQL_OP10)
    assert ids(after) == sorted(want[want["doc_id"] == want["component_id"]]["doc_id"])

    before, after = seen["benchmark decontamination"]
    want = _sql(spark.createDataFrame(before), sf, decontaminate.SQL_OP7)
    assert ids(after) == sorted(want[~want["contaminated"].astype(bool)]["doc_id"]) and len(after) < len(before)

    before, after = seen["mixing sources"]
    want = _sql(spark.createDataFrame(before), sf, mixing.SQL_OP2)
    assert after.groupby("doc_id").size().to_dict() == {i: n for i, n in zip(want["doc_id"], want["draws"]) if n}

    before, after = seen["sharding"]
    columns = list(documents.columns)
    order = lambda pdf: pdf[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(before), order(after))
    size = after.groupby("shard")["size"].sum()
    assert len(size) == 8 and (size - size.mean()).abs().max() < 0.05 * size.mean()
    for _, part in after.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 500


def test_language_stage_rejects_unlearned_scripts_and_keeps_short_texts(spark, sf):
    rng = np.random.default_rng(5)
    scripts = [(0x430, 0x450), (0x3B1, 0x3C9), (0x5D0, 0x5EA), (0x4E00, 0x5000)]
    odd = [" ".join("".join(map(chr, rng.integers(lo, hi, rng.integers(2, 9)))) for _ in range(n))
           for lo, hi in scripts for n in (1, 3, 10, 40, 200) for _ in range(15)]
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [t for r in documents.where("lang IS NOT NULL").limit(400).collect() for t in [r["text"]] if t]
    clean = [" ".join(t.split()[i:i + 6]) for t in texts for i in (0, 12) if len(t.split()) > 40]
    clean = [t for t in clean if sum(c.isalpha() for c in t) > 0.7 * len(t)]
    rows = [(10_000_000 + 4 * i, t, None, "s", len(t)) for i, t in enumerate(odd)] \
        + [(20_000_000 + 4 * i, t, None, "s", len(t)) for i, t in enumerate(clean)]
    both = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    left = corpus_pipeline.known_language(spark, both, sf).select("doc_id").toPandas()["doc_id"]
    kept_odd, kept_clean = ((left >= 10_000_000) & (left < 20_000_000)).sum(), (left >= 20_000_000).sum()
    print(f"kept {kept_odd} of {len(odd)} texts in unlearned scripts, {kept_clean} of {len(clean)} short texts")
    assert kept_odd <= 0.05 * len(odd) and kept_clean >= 0.99 * len(clean)


def test_run_on_odd_tables(spark, sf, tmp_path):
    """An empty table; null ids, repeated rows and clashing columns through all five stages."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    some = documents.limit(60)
    odd = some.unionByName(some.limit(20)).unionByName(some.limit(10).selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars")) \
        .unionByName(spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0)], documents.schema))
    for name, docs in (("none", documents.limit(0)), ("odd", odd.selectExpr("*", "1 as shard", "'x' as _row", "2 as size"))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        items.write.parquet(str(tmp_path / name / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path / "odd"))
    rows = out.collect()
    assert len(rows) > 20 and {"_row", "shard", "size", "slot"} <= set(out.columns)
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 for r in rows)
