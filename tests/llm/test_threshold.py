"""The threshold is the quantile of held-out trusted text itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from llm.queries import op6_quality_perplexity

FOLDER = "/root/testdata/sf0.001"


def test_threshold_is_the_quantile(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    trusted = {r.doc_id for r in good.filter("q = 1 and coalesce(t, 0) <> 1").collect()}
    held = docs.filter("text is not null and pmod(xxhash64(text), 5) = 0")
    held = {r.doc_id for r in held.select("doc_id").collect()} & trusted
    found = op6_quality_perplexity(spark, FOLDER).collect()
    limits = {r.lang: r.threshold for r in found if r.threshold is not None}
    assert limits
    for lang, limit in limits.items():
        own = sorted(r.perplexity for r in found if r.lang == lang and r.doc_id in held)
        assert limit in own and limit >= own[int(0.9 * (len(own) - 1))]
    assert all(r.kept == (r.perplexity <= r.threshold) for r in found if r.threshold is not None and r.perplexity is not None)
