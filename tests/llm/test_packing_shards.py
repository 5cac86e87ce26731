"""Shards of the packing stay even when a third of all rows are alike, and bins do not depend on partitions."""

from collections import Counter

from cellhealth.llm import packing
from tests.llm.helpers import documents


def test_alike_rows_spread_over_the_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 500)
    monkeypatch.setattr(packing, "COPIES", 300)
    texts = ["a b c d"] * 1000 + [f"w{i} " * (1 + i % 9) for i in range(2000)]
    df = documents(spark, texts, [7] * 1000 + list(range(1000, 3000)))
    df = df.withColumn("source", df.doc_id.cast("string"))
    got = packing.pack(df, capacity=64).collect()
    sizes = Counter(r.bin_id >> 32 for r in got)
    assert len(got) == 3000 and len(sizes) == 7 and max(sizes.values()) <= 1.3 * 3000 / len(sizes)
    again = packing.pack(df.repartition(13), capacity=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
