import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessella.llm import ann, mixing, quality_bayes, quality_rules, sharding, token_scan, toxicity
from tests.llm.helpers import documents, none_of

# Sharding


@pytest.mark.parametrize("size", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation(size):
    p = sharding.Permutation(size)
    there = p.forward(np.arange(size))
    assert sorted(there) == list(range(size)) and (p.backward(there) == np.arange(size)).all()
    shard, slot = p.place(np.arange(size), 5)
    assert (p.row(shard, slot, 5) == np.arange(size)).all()
    counts = np.bincount(shard, minlength=5)
    assert counts.max() - counts.min() <= 1


@pytest.mark.parametrize("bucket_rows", [3, 250_000])
def test_assign(spark, tmp_path, monkeypatch, bucket_rows):
    """Also where equal rows are numbered by more than one task."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    df = documents(spark)
    df = df.union(df.filter("doc_id = 4 OR doc_id IS NULL").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(10)))).drop("n"))
    rows = sharding.assign(df, shards=7).collect()
    expected = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == expected
    assert sorted(r["row_number"] for r in rows) == list(range(len(rows)))
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.assign(df.repartition(9), shards=7).collect()
    place = lambda found: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in found)
    assert place(rows) == place(again)
    assert sharding.assign(none_of(df)).isEmpty()
    unique = df.filter("doc_id < 1000").dropDuplicates(["doc_id"])
    sharding.write_shards(unique, str(tmp_path / "s"), shards=3)
    assert spark.read.parquet(str(tmp_path / "s")).count() == unique.count()


# Mixing


def targets(sizes, weights=(5, 2, 1), cap=3):
    """By the rule as it is told: share, cut what is above, share the rest again."""
    total, names = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got = dict.fromkeys(names, 0.0)
    free, left = set(names), float(total)
    while free and left > 1e-9:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > cap * sizes[s]}
        for s in full or free:
            got[s] = float(cap * sizes[s]) if full else unit * weight[s]
            left -= got[s]
        free -= full or free
    return got


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500, None: 3}, {"a": 0, "b": 7}, {"a": 1, "b": 1, "c": 1, "d": 1000}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "mix_source string, source_size long")
    found = {r["mix_source"]: r["mix_target"] for r in mixing.source_targets(df).collect()}
    assert found == pytest.approx(targets(sizes))


def draws(seed, i, nth, text):
    import hashlib

    digest = hashlib.md5((text or "").encode()).hexdigest()
    h = hashlib.md5(f"{seed}:{'null' if i is None else i}:{nth}:{digest}".encode()).hexdigest()
    return int(h[:13], 16), int(h[13:26], 16)


def mixed_by_hand(rows, seed=mixing.SEED):
    """copies of (id, text, source) rows, by plain loops; sorted (id, text, source, copies)."""
    sizes, seen, drawn = {}, {}, []
    for i, t, s in rows:
        nth = seen[i, t or "", s] = seen.get((i, t or "", s), -1) + 1
        size = len((t or "").encode().split())
        sizes[s] = sizes.get(s, 0) + size
        drawn.append((i, t, s, size, *draws(seed, i, nth, t)))
    expected, out = targets(sizes), []
    for source in sizes:
        rate = expected[source] / sizes[source] if sizes[source] else 0.0
        hit = lambda r, salt: (r[4] + salt * r[5]) % 16**13 / 16.0**13 < rate - int(rate)  # noqa: B023, E731
        own = [r for r in drawn if r[2] == source]
        off = [abs(int(rate) * sizes[source] + sum(r[3] for r in own if hit(r, salt)) - expected[source]) for salt in range(mixing.SALTS)]
        best = off.index(min(off))
        out += [(r[0], r[1], r[2], int(rate) + hit(r, best)) for r in own]
    return sorted(out, key=str)


def test_mix(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    plan = mixing.mix_plan(df).collect()
    assert sorted([(r["doc"]["doc_id"], r["doc"]["text"], r["doc"]["source"], r["copies"]) for r in plan], key=str) == mixed_by_hand(rows)
    slim = mixing.mix_plan(df, keep=False).collect()
    assert sorted((str(r["mix_id"]), r["target"], r["copies"]) for r in slim) == sorted((str(r["mix_id"]), r["target"], r["copies"]) for r in plan)
    assert sorted(r["size"] for r in slim) == sorted(len((t or "").encode().split()) for _, t, _ in rows)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in plan)
    assert mixing.mix(none_of(df)).isEmpty() and mixing.mix_plan(none_of(df), keep=False).isEmpty()


@pytest.mark.parametrize("broadcast_rows", [0, 20_000])
def test_repeated_rows_and_null_ids_draw_apart(spark, monkeypatch, broadcast_rows):
    """Without ids, with one id for all, and with one text for all: each source still comes near its target."""
    from tessella.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    n = F.col("id")
    text = F.concat(F.lit("a b c "), F.when(n % 4 > 0, n.cast("string")).otherwise(F.lit("same")))
    df = spark.range(0, 3000, numPartitions=3).select(F.when(n % 2 == 0, F.lit(7)).cast("long").alias("doc_id"), text.alias("text"), F.concat(F.lit("s"), n % 3).alias("source"))
    rows = mixing.mix_plan(df, keep=False).groupBy("target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert len(rows) == 3 and all(abs(r["taken"] / r["target"] - 1) < 0.01 for r in rows)
    taken = lambda d: sorted((str(r["doc_id"]), r["text"]) for r in mixing.mix(d).collect())
    assert taken(df) == taken(df.repartition(5))


def test_mix_comes_near_its_targets_with_few_documents(spark):
    """20 sources of 500 documents of very uneven length: within 2 %."""
    n = F.col("id")
    length = F.pmod(F.xxhash64("id"), F.lit(60)) * F.when(n % 40 < 20, 40).otherwise(1) + 1
    df = spark.range(10_000).select(n.alias("doc_id"), F.repeat(F.lit("w "), length.cast("int")).alias("text"), F.concat(F.lit("s"), n % 20).alias("source"))
    rows = mixing.mix_plan(df).select(F.col("doc.source"), F.size(F.split(F.trim("doc.text"), " ")).alias("size"), "target", "copies").groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect()
    assert len(rows) == 20 and max(abs(r["taken"] / r["target"] - 1) for r in rows) < 0.02


# Quality rules


def measured(text):
    """The base measures by plain loops."""
    text = text or ""
    words = [w for w in text.encode().split() if w]
    words = [w.decode() for w in words]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", "a", "a b c d e a b c d e", "x y\nx y\n\n x y", "é# * b | <c>", "a a a a a a a a a a", "one two three four five six\none two three four five six\none two", "\x1c \x0b word", "tab\tsep\rret\x0cff"]


def test_measures(spark):
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string")
    rows = sorted(quality_rules.judge(df).collect(), key=lambda r: r["doc_id"])
    for r, t in zip(rows, TEXTS, strict=True):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == measured(t), repr(t)
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])


def test_rules_keep_clean_documents(spark):
    rng = random.Random(1)
    clean = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(20, 60))) for _ in range(400)]
    junk = [" ".join(w + "***" for w in t.split()) for t in clean[:20]]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(clean + junk)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(r["doc_id"] for r in quality_rules.keep_good(df).collect()) == list(range(400))


@pytest.mark.parametrize("share", [0.05, 0.3])
@pytest.mark.parametrize("metric", sorted(quality_rules.METRICS))
def test_each_metric_rejects(spark, metric, share):
    """Documents that pass the base rules and stand out by one metric go, also where they are 30 % of a group."""
    rng = random.Random(8)
    word = lambda k=5: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    clean = lambda: "\n".join(" ".join(word(rng.randint(3, 7)) for _ in range(10)) for _ in range(8))
    bad = {
        "symbol_rate": lambda: "\n".join(" ".join(word() + "#" * (rng.random() < 0.4) for _ in range(10)) for _ in range(8)),
        "dup_line_rate": lambda: clean() + "\n-" * 9,
        "repeat_rate": lambda: clean() + " " + " ".join([" ".join(f"z{i} y{i} x{i}" for i in range(3))] * 2),
        "word_length": lambda: "\n".join(" ".join(word(9) for _ in range(10)) for _ in range(8)),
    }[metric]
    texts = [bad() if i < share * 400 else clean() for i in range(400)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(1000 + i, clean(), "en", "t") for i in range(300)] + [(2000, bad(), "en", "small"), (2001, clean(), "en", "small")]
    found = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert {i for i, r in found.items() if not r["kept"]} == {i for i in range(400) if i < share * 400} | {2000}


def test_thresholds_are_drawn_to_the_language(spark):
    """No jump at any number of rows, and by the formula."""
    rng = random.Random(2)
    rows = [("en", "big", rng.uniform(4, 6)) for _ in range(1000)] + [("en", "few", rng.uniform(7, 8)) for _ in range(20)] + [("de", "one", 5.0)]
    df = spark.createDataFrame([(lang, s, int(x * 1000), 1000, 0, 1, 0, 0) for lang, s, x in rows], "lang string, source string, word_chars long, n_words long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    got = {(r["t_lang"], r["t_source"]): r["limits"]["word_length"] for r in quality_rules.thresholds(quality_rules.sketch(df)).collect()}

    def fence(xs):
        ends = sorted(1.02 ** np.ceil(np.log(int(x * 1000) / 1000) / np.log(1.02)) for x in xs)
        low, mid = ends[-(-len(ends) // 4) - 1], ends[-(-len(ends) // 2) - 1]
        return mid + 6 * max(mid - low, 0.2), len(ends)

    drawn = lambda own, to: (own[1] * own[0] + 200 * to) / (own[1] + 200)
    everything = fence([x for *_, x in rows])[0]
    for lang, s in got:
        wide = drawn(fence([x for a, _, x in rows if a == lang]), everything)
        assert got[lang, s] == pytest.approx(drawn(fence([x for a, b, x in rows if (a, b) == (lang, s)]), wide), rel=1e-9)
    assert len(got) == 3


def test_rules_on_awkward_rows(spark):
    df = documents(spark)
    kept, judged = quality_rules.keep_good(df), quality_rules.judge(df)
    assert judged.count() == df.count() and kept.columns == df.columns and kept.count() == judged.filter("kept").count()
    assert quality_rules.keep_good(none_of(df)).isEmpty() and quality_rules.judge(none_of(df)).isEmpty()


def test_sketches_merge(spark):
    df = documents(spark)
    measured_ = quality_rules.measure(df)
    parts = quality_rules.sketch(measured_.filter("doc_id % 2 = 0")).union(quality_rules.sketch(measured_.filter("doc_id % 2 = 1")))
    merged = parts.groupBy("lang", "source", "metric", "bucket").agg(F.sum("n").alias("n"))
    assert merged.exceptAll(quality_rules.sketch(measured_.filter("doc_id IS NOT NULL"))).isEmpty()


# Toxicity


def test_learns_an_interaction(spark):
    """An insult, or a mention of a group, is harmless alone."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(3000):
        words = [f"w{rng.randint(0, 50)}" for _ in range(15)]
        insult, group = rng.random() < 0.3, rng.random() < 0.3
        words += ["scoundrel"] * insult + ["villagers"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, known)).withColumn("h", toxicity.held_out(F.col("doc_id"))).join(known, "doc_id").filter("h")
    wrong = scored.filter("predicted <> toxic").count()
    assert scored.count() > 500 and wrong / scored.count() < 0.02


def test_score_by_hand():
    """The sum over all pairs, written out; and a text's places by a plain search."""
    import itertools
    import math

    rng = random.Random(4)
    buckets = tuple(sorted({b for w in (b"insult", b"group", b"villagers") for b in toxicity.terms(w)}))
    n = len(buckets)
    m = toxicity.Model(-1.5, buckets, tuple(rng.gauss(0, 1) for _ in range(n)), tuple(tuple(rng.gauss(0, 1) for _ in range(3)) for _ in range(n)))
    found = [[], [0], list(range(n)), [1, 3, 5], [n - 1]]
    for at, score in zip(found, m.score(found), strict=True):
        z = m.bias + sum(m.weight[i] for i in at) + sum(sum(a * b for a, b in zip(m.factors[i], m.factors[j], strict=True)) for i, j in itertools.combinations(at, 2))
        assert score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)
    for text in ("An INSULT-group!", "insul grou vill", "", "villagers villagers2", "\ud800 insult"):
        plain = {t for w in "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).split() for t in toxicity.terms(w.encode("utf-8", "replace"))}
        assert m.places(text) == [i for i, b in enumerate(buckets) if b in plain]


def test_terms_that_matter_beside_others(spark):
    """A word as frequent in both classes flips what an insult means; no weight of its own would tell."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(4000):
        words = [f"w{rng.randint(0, 50)}" for _ in range(15)]
        insult, praised = rng.random() < 0.4, rng.random() < 0.5
        toxic = insult and not praised or (not insult and praised and rng.random() < 0.4)
        rows.append((i, " ".join(words + ["scoundrel"] * insult + ["lovable"] * praised)))
        labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, known)).filter("doc.text LIKE '%scoundrel%'").join(known, "doc_id")
    assert scored.filter("predicted <> toxic").count() / scored.count() < 0.02


def test_few_labels(spark):
    """Seven toxic documents of 150 are enough for a word that only they hold."""
    rng = random.Random(6)
    text = lambda bad: " ".join([f"w{rng.randint(0, 300)}" for _ in range(30)] + ["scoundrel"] * bad)
    rows = [(i, text(i % 20 == 1)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 20 == 1)) for i in range(200)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, known)).join(known, "doc_id")
    assert scored.filter("predicted <> toxic").isEmpty()


def test_scores_on_awkward_rows(spark):
    df = documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (5, 0), (5, 1)], "doc_id long, toxic int")
    rows = toxicity.score(df, toxicity.fit(df, labels)).collect()
    assert len(rows) == df.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["score"] < 1e-9 for r in toxicity.score(df, toxicity.fit(df, none_of(labels))).collect())
    assert toxicity.keep_civil(df, none_of(labels)).columns == df.columns and toxicity.keep_civil(none_of(df), labels).isEmpty()


def test_labels_of_held_out_rows_are_not_used(spark):
    df = documents(spark, clashing=False).filter("doc_id < 1000")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    assert toxicity.fit(df, labels) == toxicity.fit(df, flipped)
    assert labels.filter(toxicity.held_out(F.col("doc_id"))).count() == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(60))


# Token counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("block_bytes", [50, 1 << 20])
def test_token_scan(spark, tmp_path, block_bytes):
    df, path = documents(spark), str(tmp_path / "t")
    token_scan.write(df, path, RANKS, public_tokenizers.PATTERN)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = token_scan.stitch(token_scan.cut(token_scan.scan(spark, path, block_bytes=block_bytes))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    encode = token_scan._encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(encode(r["text"] or "")) for r in df.collect()) and all(r["ended"] for r in rows)
    by_file = {}
    for r in rows:
        by_file.setdefault(r["file"], []).append(r)
    for found in by_file.values():
        found.sort(key=lambda r: r["doc_index"])
        assert [r["doc_index"] for r in found] == list(range(len(found)))
        assert all(a["start"] + a["n_tokens"] + 1 == b["start"] for a, b in zip(found, found[1:], strict=False)) and found[0]["start"] == 0


def test_counts_by_document(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    encode = token_scan._encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary
    expected = sorted((str(r["doc_id"]), len(encode(r["text"] or ""))) for r in df.collect())
    for _ in range(2):
        rows = token_scan.count_tokens(df, RANKS, public_tokenizers.PATTERN)
        assert rows.columns == ["doc_id", "n_tokens"] and sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows.collect()) == expected


@pytest.mark.parametrize("id_type,end", [("<u4", 2), (">u4", 2), ("<u2", 2), ("u1", 2), ("<u4", 0x50505050), ("<u8", 0x7F)])
@pytest.mark.parametrize("split", [12, 1 << 20])
def test_files_of_others(spark, tmp_path, id_type, end, split):
    """No end at the end, ends in a row, an empty file, blocks and splits without ends or across ids."""
    rng, width = random.Random(7), np.dtype(id_type).itemsize
    cases = {"a": [5, 6, end, end, 7] + [8] * 10 + [end, 9], "b": [], "c": [end], "d": [4] * 9, "e": [rng.choice([end, 80, 0x50, 3]) for _ in range(500)], "f": [0x50] * 30, "g": [end] * 40}
    expected = []
    for name, ids in cases.items():
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, id_type).tobytes())
        start = 0
        for nth, stop in enumerate([i for i, x in enumerate(ids) if x == end] + [len(ids)] * (ids[-1:] != [end] and len(ids) > 0)):
            expected.append((name, nth, start, stop - start, stop < len(ids)))
            start = stop + 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        scanned = token_scan.cut(token_scan.scan(spark, str(tmp_path), end_id=end, id_type=id_type, block_bytes=40, glob="*.bin"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = token_scan.stitch(scanned, width=width).collect()
    assert sorted((r["file"][-5], r["doc_index"], r["start"], r["n_tokens"], r["ended"]) for r in rows) == expected


def test_files_that_are_not_whole(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number"):
        token_scan.stitch(token_scan.scan(spark, str(tmp_path), glob="*.bin")).collect()


def test_no_documents(spark):
    assert token_scan.count_tokens(none_of(documents(spark)), RANKS, public_tokenizers.PATTERN).isEmpty()


# Quality classifier


def test_sparse_groups_stay_near_their_prior(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        bad = rng.random() < (0.7 if i % 3 == 0 else 0.1)
        word = "#*% " if bad else f"w{rng.randint(0, 999)} "
        rows.append((i, "".join(word if rng.random() < 0.8 else f"v{rng.randint(0, 99)} " for _ in range(40)), f"h{i % 3}", "p"))
        labels.append((i, int(not bad)))
    rows.append((9999, rows[0][1], "h-new", "p"))
    df = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    found = {r["doc_id"]: r for r in quality_bayes.classify(df, spark.createDataFrame(labels, "doc_id long, quality int"), F.col("host"), F.col("path")).collect()}
    assert found[0]["host_quality"] < 0.5 < found[1]["host_quality"]
    mean = np.mean([found[i]["host_quality"] for i in range(3)])
    assert abs(found[9999]["path_quality"] - mean) < 0.2
    right = np.mean([found[i]["kept"] == bool(y) for i, y in labels])
    assert right > 0.97


def bayes_by_hand(rows, labels, clip=1e-6):
    """(id, host, path) to (evidence, host rate, path rate without the document, quality), by plain loops."""
    import math

    def features(text):
        text = text or ""
        words, chars, symbols, dup, repeat = measured(text)
        lines = sum(1 for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r"))
        n = max(words, 1)
        values = {
            "words": words, "symbols": symbols / n, "lines": dup / max(lines, 1), "repeats": repeat / n, "length": chars / n,
            "capitals": sum(c.isupper() for c in text) / max(chars, 1), "marks": sum(c in "!?" for c in text) / n,
        }
        return {f: sum(values[f] > end for end in ends) for f, (_, ends) in quality_bayes.FEATURES.items()}

    found = [(i, h, p, features(t)) for i, t, h, p in rows]
    counts, total = {}, {0: 0, 1: 0}
    for i, _, _, bins in found:
        if i in labels:
            total[labels[i]] += 1
            for f, b in bins.items():
                counts[f, b, labels[i]] = counts.get((f, b, labels[i]), 0) + 1
    ratio = {}
    for f, (_, ends) in quality_bayes.FEATURES.items():
        share = lambda b, g: (counts.get((f, b, g), 0) + 1) / (total[g] + len(ends) + 1)  # noqa: B023, E731
        ratio[f] = [math.log(share(b, 1) / share(b, 0)) for b in range(len(ends) + 1)]
    prior = (total[1] + 1) / (total[0] + total[1] + 2)
    logit = lambda p: math.log(min(max(p, clip), 1 - clip) / (1 - min(max(p, clip), 1 - clip)))
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    evidence = [0.7 * sum(ratio[f][b] for f, b in bins.items()) for *_, bins in found]
    own = [sigmoid(logit(prior) + e) for e in evidence]
    hosts, paths = {}, {}
    for (_, h, p, _), x in zip(found, own, strict=True):
        for groups, key in ((hosts, h), (paths, (h, p))):
            n, s = groups.get(key, (0, 0.0))
            groups[key] = n + 1, s + x
    mean = sum(own) / len(own)

    def strength(groups):
        n = sum(g[0] for g in groups.values())
        between = sum(c * (s / c - mean) ** 2 for c, s in groups.values()) / n - mean * (1 - mean) * len(groups) / n
        return min(max(mean * (1 - mean) / max(between, 1e-9) - 1, 2.0), 10_000.0) if len(groups) > 1 else 10_000.0

    a, b, out = strength(hosts), strength(paths), []
    for (i, h, p, _), e, x in zip(found, evidence, own, strict=True):
        (n, s), (m, r) = hosts[h], paths[h, p]
        path = (r - x + b * (s - x + a * mean) / (n - 1 + a)) / (m - 1 + b)
        out.append((i, h, p, e, (s + a * mean) / (n + a), path, sigmoid(logit(path) + e)))
    return out


def test_posteriors_by_hand(spark):
    """Evidence, the strength of both levels, the shrunken rates and the posterior, recomputed."""
    df = documents(spark, clashing=False)
    known = {i: int(i % 4 > 0) for i in range(60)}
    rows = quality_bayes.classify(df, spark.createDataFrame(list(known.items()), "doc_id long, quality int"), F.col("source"), F.col("lang")).collect()
    expected = bayes_by_hand([(r["doc_id"], r["text"], r["source"], r["lang"]) for r in df.collect()], known)
    key = lambda r: (str(r[0]), str(r[1]), str(r[2]), round(r[3], 6))
    assert len(rows) == len(expected)
    for r, e in zip(sorted((tuple(r) for r in rows), key=key), sorted(expected, key=key), strict=True):
        assert r[:3] == e[:3] and r[3:7] == pytest.approx(e[3:7], abs=1e-9) and r[7] == (e[6] >= 0.5)


def test_held_out_accuracy(spark):
    """Fitted on three quarters of the labels of the test table, right on the fourth."""
    from tessella.llm import queries

    docs, labels = (queries.table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = quality_bayes.classify(docs, labels.filter(~out), F.col("source"), F.col("lang"))
    judged = found.join(labels.filter(out).select("doc_id", F.col("quality").alias("label")), "doc_id")
    row = judged.agg(F.count("*").alias("n"), F.count_if(F.col("kept") == (F.col("label") == 1)).alias("right")).first()
    assert row["n"] > 900 and row["right"] / row["n"] > 0.98


def test_classifier_without_labels_or_rows(spark):
    df = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_bayes.classify(df, none, F.col("source"), F.col("lang")).collect()
    assert len(rows) == df.count() and all(r["evidence"] == 0 and r["kept"] for r in rows)
    assert quality_bayes.classify(none_of(df), none, F.col("source"), F.col("lang")).isEmpty()


def test_url_levels(spark):
    df = spark.createDataFrame([("https://www.A.example.com/x/y?q",), ("http://b.org",), (None,)], "u string")
    found = [tuple(r) for r in df.select(*quality_bayes.url_levels(F.col("u"))).collect()]
    assert found == [("a.example.com", "x"), ("b.org", ""), (None, None)]


# Nearest neighbours


def vectors(n, dim, seed=4):
    return np.random.default_rng(seed).normal(size=(n, dim))


def recall(spark, x, k=20, every=20):
    """The share of true neighbours found, with all that must hold of the rows checked."""
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], "vec_id long, embedding array<double>, score string")
    found = {}
    for r in ann.search(df, k, query=F.col("query_id") % every == 0).collect():
        found.setdefault(r["query_id"], []).append(r)
    hits = 0
    for q, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:k]) & {r["vec_id"] for r in rows})
        assert [r["rank"] for r in rows] == list(range(1, k + 1)) and all(abs(r["score"] - scores[r["vec_id"]]) < 1e-12 for r in rows)
    assert len(found) == -(-len(x) // every)
    return hits / (k * len(found))


@pytest.mark.parametrize("block_rows", [300, 8192])
@pytest.mark.parametrize("unit", [True, False])
def test_recall(spark, monkeypatch, unit, block_rows):
    monkeypatch.setattr(ann, "BLOCK_ROWS", block_rows)
    x = vectors(2500, 32)
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x * np.random.default_rng(1).uniform(0.5, 2, (len(x), 1))
    assert recall(spark, x) >= 0.9


@pytest.mark.parametrize("n,most", [(2_000, 0.2), (10_000, 0.12), (40_000, 0.08)])
def test_few_are_verified(n, most):
    """Recall at three sizes without structure, by far fewer steps than the full product has."""
    x = vectors(n, 64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, asked = np.arange(n), np.arange(60)
    pick = np.random.default_rng(3).permutation(n)[:4096]
    plan = ann.make_plan(pick, x[pick], 1.0, n, 20, 1)
    widths = plan.half_widths(asked, x[:60])
    q, found, _, verified = ann.search_block(ids, x, asked, x[:60], widths, plan)
    scores = x[:60] @ x.T
    scores[asked, asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    hits = sum(len(set(best[i]) & set(found[q == i].tolist())) for i in range(60))
    assert hits / 1200 >= 0.9 and verified / (60 * n) < most


def test_clusters_leave_ranges_out(spark, monkeypatch):
    """Queries go only to ranges that their windows touch, and find what is there."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 200)
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(40, 24)), 100, axis=0) + 0.02 * rng.normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    plan = ann.make_plan(np.arange(4000), x, float((x * x).sum(axis=1).max()), 4000, 10, 16)
    at = plan.ranges(plan.project(x))
    assert len(set(at.tolist())) == 16 and recall(spark, x, 10) >= 0.95
    projected, widths = plan.project(x), plan.half_widths(np.arange(4000), x)
    touched = sum(((plan.centres(x) + widths[:, None] >= projected[at == r].min(axis=0)) & (plan.centres(x) - widths[:, None] <= projected[at == r].max(axis=0))).sum(axis=1) >= ann.needed() for r in range(16))
    assert touched.mean() < 6


def test_short_queries_widen(spark, monkeypatch):
    """Windows that are too narrow for k are widened until k are found."""
    monkeypatch.setattr(ann, "WIDTH", 0.6)
    monkeypatch.setattr(ann, "needed", lambda directions=128: 100)
    recall(spark, vectors(400, 16), 20)


def test_unusable_vectors_ties_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in ann.search(df, 20, query=F.col("query_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.0)]
    assert ann.search(none_of(df)).isEmpty()


def test_many_equal_vectors(spark):
    df = spark.createDataFrame([(i, [0.6, 0.8, 0.0]) for i in range(3000)] + [(5000, [0.0, 0.0, 1.0])], "vec_id long, embedding array<double>")
    found = [r["vec_id"] for r in ann.search(df, 5, query=F.col("query_id") == 0).orderBy("rank").collect()]
    assert found == [1, 2, 3, 4, 5]
