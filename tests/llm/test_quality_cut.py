"""The ranking's cut covers all training rows, also those beyond the sample the weights are fitted on."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from ordertally.llm import quality_rank


def test_cut_over_all_training_rows(spark, monkeypatch):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    table = quality_rank.feature_table(docs, ["doc_id"]).cache()
    rows = table.join(labels, "doc_id").select("doc_id", "features", "quality").toPandas()
    rows = rows[[zlib.crc32(str(i).encode()) % 5 != 0 for i in rows["doc_id"]]]
    x, y = np.stack(rows["features"].to_numpy()), rows["quality"].to_numpy()
    monkeypatch.setattr(quality_rank, "SAMPLE_ROWS", 500)
    model = quality_rank.train(table, labels)
    s = np.sort(model.rank(x))
    # The share of bad rows, over all of them, lies below the cut.
    assert abs((s < model.cut).mean() - (y == 0).mean()) < 2 / len(s) + 1 / quality_rank.CUT_ACCURACY
    assert len(s) > 2000
    fitted = quality_rank.RankModel(x, y)
    # A small sample's ranking is close to that of all rows.
    assert np.corrcoef(fitted.rank(x), model.rank(x))[0, 1] > 0.9
    table.unpersist()


def test_sample_is_the_same_below_the_hash_bound(spark, monkeypatch):
    monkeypatch.setattr(quality_rank, "SAMPLE_ROWS", 400)
    ids = spark.range(20_000).withColumn("__at", F.xxhash64("id"))
    share = 1.1 * quality_rank.SAMPLE_ROWS / 20_000
    low = ids.filter(F.col("__at") < int(-(2**63) + share * 2**64))
    first = lambda df: [r.id for r in df.orderBy("__at").limit(quality_rank.SAMPLE_ROWS).collect()]
    assert first(low) == first(ids) and low.count() < 600
