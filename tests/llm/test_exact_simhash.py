"""op6 and op8 against brute force."""

import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from cellhealth.llm import common, exact_dedup, simhash
from tests.llm.helpers import TEXTS, documents, odd


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_cuckoo_index_grows_deletes_and_verifies():
    index = exact_dedup.CuckooIndex(2)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, k in enumerate(keys):
        index.insert([k, i])
    assert index.resizes > 0 and index.live == 3000
    assert all(index.find(k, i)[1] == i for i, k in enumerate(keys))
    # same fingerprint and buckets, other content: a hit that verification refuses
    assert index.find(keys[5][:20] + b"\0" * 12, 5) is None and index.find(keys[5], 6) is None
    assert all(index.delete(k, i) for i, k in enumerate(keys) if i % 2)
    assert not index.delete(keys[1], 1) and index.live == 1500
    assert all((index.find(k, i) is None) == bool(i % 2) for i, k in enumerate(keys))
    assert sorted(e[1] for e in index.entries()) == list(range(0, 3000, 2))


def test_exact_groups(spark):
    df = odd(spark)
    rows = [(r.doc_id, lowered(r.text)) for r in df.collect()]
    got = exact_dedup.exact_groups(df).collect()
    assert len(got) == len(rows)
    by = {}
    for i, t in rows:
        by.setdefault(t, []).append(i)
    for r in got:
        ids = next(v for t, v in by.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        known = [i for i in ids if i is not None]
        assert r.doc_id in ids and r.group_size == len(ids) and r.keep_id == (max(known) if known else None)
    assert sum(r.kept for r in got) == len(by)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns and kept.count() == len(by)
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0


def test_repeated_kept_row_stays_once(spark):
    df = documents(spark, ["same", "same", "SAME"], [7, 7, 3])
    got = exact_dedup.exact_groups(df).collect()
    assert sorted(r.kept for r in got) == [False, False, True]
    assert [r.doc_id for r in exact_dedup.drop_copies(df).collect()] == [7]


def fingerprint(text):
    w = lowered(text).encode().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                root[top(i)] = top(j)
    least = {}
    for i in range(len(ids)):
        least[top(i)] = min(least.get(top(i), ids[i]), ids[i])
    return [least[top(i)] for i in range(len(ids))]


def test_simhash_groups(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = list(TEXTS)
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(600)]
        for k in range(4):
            own = list(base)
            for _ in range(k):
                own[rnd.randrange(600)] = rnd.choice(words)
            texts.append(" ".join(own))
    df = documents(spark, texts)
    prints = [fingerprint(t) for t in texts]
    exp = brute_components(list(range(len(texts))), prints)
    got = {r.doc_id: r for r in simhash.simhash_groups(df).collect()}
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i in range(len(texts))] == exp
    assert len(set(exp)) < len(texts) - 5
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(exp))
    assert simhash.simhash_groups(df.limit(0)).count() == 0
    assert simhash.simhash_groups(odd(spark)).count() == odd(spark).count()


def test_links_chain_through_fingerprints(spark):
    base = 0x0123456789ABCDEF
    chain = [base]
    for b in range(0, 60, 2):
        chain.append(chain[-1] ^ (1 << b) ^ (1 << b + 1))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in [*chain, 0xF0F0F0F0F0F0F0F0]]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"))
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in links.collect())
    comp = {r.node: r.component for r in common.components(links, "a", "b").collect()}
    assert len(comp) == len(chain) and len(set(comp.values())) == 1


def test_join_groups_spreads_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2500, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"))
    groups = common.write_stage(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top")), "g")
    for hot in (1000, 2, 10_000_000):
        got = common.join_groups(rows, groups, "key", "n", "id", hot=hot)
        assert got.count() == 3000 and got.filter("top is null").count() == 0
        assert got.filter("key = 'hot' and n = 2500 and top = 2499").count() == 2500
