"""The pipeline's stages against their operators' brute-force forms, and the registered queries."""

from __future__ import annotations

import corpus_pipeline
import __spark_entry__ as entry
from pyspark.sql import functions as F

from ordertally.llm import decontaminate, near_dup, packing, pii, registry, toxicity
from ordertally.llm.common import words_of


def test_stages(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn("__row", F.lit("mine"))
    items = [r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    windows = set().union(*[decontaminate.item_windows(t) for t in items])
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "personal_data", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_small).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name == "packing":
            break
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "near_dedup":
            ids = sorted(seen)
            for i in set(seen) - set(got):
                assert any(seen[i] == seen[j] or near_dup.similar(seen[i], seen[j]) for j in ids if j != i)
            left = sorted(got)
            assert not any(near_dup.similar(got[i], got[j]) for i in left for j in left if i < j)
        elif name == "decontamination":
            hit = {i for i, t in seen.items() for w in [words_of(t)] if any(tuple(w[s : s + 10]) in windows for s in range(len(w)))}
            assert set(got) == set(seen) - hit
        elif name == "personal_data":
            assert got == {i: pii.redacted(t) for i, t in seen.items()}
        else:
            assert set(got) <= set(seen) and all(got[i] == seen[i] for i in got)
        seen = got
    total = docs.agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert tuple(total) == (sum(len(packing.token_ids(t)) for t in seen.values()), len(seen))


def test_registered(spark, sf_small):
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(registry.queries())
    assert corpus_pipeline.run(spark, sf_small).count() > 0


def test_stages_take_empty_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_small).count() == 0


def test_queries_equal_their_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in registry.oracle_sql().items():
        got = registry.queries()[name](spark, sf)
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(got.columns)
        assert sorted(map(str, (tuple(r) for r in got.select(names).collect()))) == sorted(map(str, want.fetchall()))


def test_toxicity_stage_shuffles_no_text_beyond_the_broadcast(spark, monkeypatch):
    """Its plan has no exchange, and it keeps the same rows, those without an id or text and repeated ones too."""
    texts = ["nice words here"] * 30 + ["awful scum trash"] * 30 + ["nice scum", "zzz nicer", "zzz nicer", None, ""]
    rows = [(None if i == 61 else min(i, 63), t, "en", "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i >= 30)) for i in range(60)], "doc_id long, toxic int")
    want = sorted(map(str, toxicity.drop_toxic(docs, labels).collect()))
    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", 0)
    kept = toxicity.drop_toxic(docs, labels)
    assert "Exchange" not in kept._jdf.queryExecution().toString() and kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == want and 34 <= len(want) < len(texts)
