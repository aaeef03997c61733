from pyspark.sql import functions as F

import corpus_pipeline


def test_shards_follow_the_mix(spark, tmp_path):
    """Sharding took no notice of the order that mixing gives."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 900).alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.col("id").alias("row_key"))
    mixed = corpus_pipeline.mixing(spark, docs, str(tmp_path)).cache()
    out = corpus_pipeline.sharding(spark, mixed, str(tmp_path)).join(mixed.select("doc_id", "mix_slot"), "doc_id").orderBy("shard", "slot").collect()
    assert len(out) == 3000
    for shard in range(24):
        rows = [r for r in out if r["shard"] == shard]
        assert len(rows) == 125 and [r["slot"] for r in rows] == list(range(125))
        assert [r["mix_slot"] for r in rows] == sorted(r["mix_slot"] for r in rows)
