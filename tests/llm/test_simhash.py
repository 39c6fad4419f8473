import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessella.llm import simhash
from tessella.llm.components import components
from tests.llm.helpers import documents, none_of


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close(values, radius=3):
    found = np.array(values, np.uint64)
    return [(values[i], values[j]) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(found ^ found[i]) <= radius) if i < j]


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_near_duplicates_against_brute_force(spark):
    df = documents(spark)
    rows = simhash.near_duplicates(df).collect()
    texts = df.select("doc_id", "text").collect()
    fps = [fingerprint(r["text"]) for r in texts]
    key = lambda t: (t[0] is None, t)
    assert sorted([(r["doc_id"], r["fp"] % 2**64) for r in rows], key=key) == sorted(zip([r["doc_id"] for r in texts], fps, strict=True), key=key)
    distinct = sorted(set(fps))
    label = groups(close(distinct), distinct)
    lowest = {}
    for r, f in zip(texts, fps, strict=True):
        if r["doc_id"] is not None:
            lowest[label[f]] = min(lowest.get(label[f], r["doc_id"]), r["doc_id"])
    assert all(r["component_id"] == lowest.get(label[r["fp"] % 2**64]) for r in rows)


@pytest.mark.parametrize("same,near", [(2, 2), (2, 64), (1024, 2), (1024, 64)])
def test_links_connect_what_is_close(spark, monkeypatch, same, near):
    """Clusters around centres, over both halves, by pairs and by hubs."""
    monkeypatch.setattr(simhash, "DENSE_SAME", same)
    monkeypatch.setattr(simhash, "DENSE_NEAR", near)
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(200)}
    for centre in list(values)[:6]:
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randint(0, 63)
            values.add(x)
    values = sorted(values)
    table = simhash.cut(spark.createDataFrame([(signed(v),) for v in values], "fp long"))
    edges = simhash.links(table).cache()
    assert edges.filter(F.bit_count(F.col("v").bitwiseXOR(F.col("w"))) > 3).isEmpty()
    found = {r["v"]: r["label"] for r in components(edges).collect()}
    expected = groups([(signed(a), signed(b)) for a, b in close(values)], [signed(v) for v in values])
    assert {v: found.get(v, v) for v in expected} == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 200)] + [(-5, 7), (300, 300)]
    found = {r["v"]: r["label"] for r in components(spark.createDataFrame(edges, "v long, w long")).collect()}
    assert all(found[i] == -5 for i in range(41)) and all(found[i] == 100 for i in range(100, 200)) and 300 not in found
    assert components(spark.createDataFrame([], "v long, w long")).isEmpty()


def survivors(rows):
    """The rows that stay, by plain loops: (id, text) of one row of each group, and rows without an id."""
    prints = [fingerprint(t) for _, t in rows]
    label = groups(close(sorted(set(prints))), sorted(set(prints)))
    best = {}
    for (i, t), f in zip(rows, prints, strict=True):
        if i is not None:
            best.setdefault(label[f], []).append((i, signed(f), t or ""))
    return [(None, t or "") for i, t in rows if i is None], [sorted(g)[:1] + [x for x in sorted(g) if x[:2] == min(g)[:2]] for g in best.values()]


def check_survivors(kept, rows):
    loose, each = survivors(rows)
    kept = [(i, t or "") for i, t in kept]
    assert sorted(t for i, t in kept if i is None) == sorted(t for _, t in loose)
    kept = sorted(x for x in kept if x[0] is not None)
    assert len(kept) == len(each)
    left = list(kept)
    for candidates in each:  # alike in id and fingerprint: any, but one only
        match = [(i, t) for i, _, t in candidates if (i, t) in left]
        assert match
        left.remove(match[0])
    assert not left


def test_deduplicate(spark):
    df = documents(spark)
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    check_survivors([(r["doc_id"], r["text"]) for r in kept.collect()], [(r["doc_id"], r["text"]) for r in df.collect()])
    assert simhash.deduplicate(none_of(df)).isEmpty()


@pytest.mark.parametrize("broadcast_rows", [0, 20_000])
def test_deduplicate_with_shared_ids(spark, monkeypatch, broadcast_rows):
    """Ids that stand for several texts, copies and groups; what stays doesn't depend on partitions."""
    from tessella.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(9)
    a, b, c, d = (" ".join(f"w{rng.randint(0, 9999)}" for _ in range(30)) for _ in range(4))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, b), (7, c), (7, c), (8, d), (8, d), (None, a), (None, a), (9, None), (9, ""), (10, None)]
    df = spark.createDataFrame([(*r, n, "x") for n, r in enumerate(rows)], "doc_id long, text string, n long, fp string")
    kept = simhash.deduplicate(df).collect()
    found = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    assert found in [sorted([(1, a), (5, b), (7, c), (8, d), (None, a), (None, a), (9, empty)], key=str) for empty in (None, "")]
    check_survivors(found, rows)
    assert sorted(kept, key=str) == sorted(simhash.deduplicate(df.repartition(5, "n")).collect(), key=str)


def test_long_texts_in_blocks(monkeypatch):
    from tessella.llm import blocks

    text = " ".join(f"w{i % 37}" for i in range(2000)).encode()
    whole = simhash._fingerprint(text)
    monkeypatch.setattr(simhash, "blocks", lambda t: blocks.blocks(t, 50))
    assert simhash._fingerprint(text) == whole == fingerprint(text.decode())
