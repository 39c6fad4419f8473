import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import intervals as iv


def frame(spark, rows, kind="p long, s double, e double, o long"):
    return spark.createDataFrame(rows, kind)


def test_caption_merge_examples(spark):
    def clips(spans):
        rows = [("v", i, s, e, f"w{i}", f"v-{i}") for i, (s, e) in enumerate(spans)]
        return iv.merge_captions(spark.createDataFrame(rows, "audio_id string, seg int, start_cs long, end_cs long, text string, utt_id string")).orderBy("start_sec").collect()

    found = clips([(0, 250), (300, 700), (850, 900), (2000, 3100)])
    assert [r["duration_sec"] for r in found] == [7.0, 11.0]
    assert found[0]["merged_utt_id"] == "v-00000-00001" and found[0]["merged_from"] == ["v-0", "v-1"] and found[0]["text"] == "w0 w1"
    assert [r["duration_sec"] for r in clips([(0, 1000), (100, 400)])] == [4.0]


def test_chunks_example(spark):
    rows = frame(spark, [(1, 0.0, 65.0, 0), (1, 65.5, 70.0, 1), (1, 75.0, 77.0, 2)])
    assert [(r["s"], r["e"]) for r in iv.chunk(rows, "p", order="o").orderBy("s").collect()] == [(0, 30), (30, 60), (60, 70)]


def test_chunks_keep_their_rules(spark):
    rng = random.Random(4)
    rows, at = [], 0.0
    for i in range(200):
        at += rng.random() * 3
        rows.append((1, at, at + rng.random() * 40, i))
        at = rows[-1][2]
    found = iv.chunk(frame(spark, rows), "p", order="o").orderBy("chunk_index").collect()
    assert found and all(3 <= r["e"] - r["s"] <= 30 + 1e-9 for r in found)
    assert all(a["e"] <= b["s"] + 1e-9 for a, b in zip(found, found[1:], strict=False))


@pytest.mark.parametrize("spans, covered", [([(0, 10), (5, 15), (20, 30)], 25), ([(0, 10), (10, 20)], 20)])
def test_union_length(spark, spans, covered):
    rows = frame(spark, [(1, float(s), float(e), i) for i, (s, e) in enumerate(spans)])
    assert iv.union_length(rows, "p", "s", "e", "o").first()["covered"] == covered


def test_gaps_and_union_make_up_the_length(spark):
    rng = random.Random(1)
    rows = [(p, float(s), float(s + rng.randint(0, 9)), i) for p in range(30) for i, s in enumerate(rng.sample(range(90), 8))]
    df = frame(spark, rows)
    lengths = spark.createDataFrame([(p, 100.0) for p in range(30)], "p long, d double")
    covered = {r["p"]: r["covered"] for r in iv.union_length(df, "p", "s", "e", "o").collect()}
    gaps = {}
    for r in iv.gaps(df, lengths, "p", "s", "e", "o", "d", shortest=0.001).collect():
        gaps[r["p"]] = gaps.get(r["p"], 0) + r["gap_end"] - r["gap_start"]
    assert all(covered[p] + gaps.get(p, 0) == 100 for p in covered)


def test_gaps_example(spark):
    df = frame(spark, [(1, 5.0, 10.0, 0), (1, 8.0, 20.0, 1), (1, 21.0, 30.0, 2)])
    found = iv.gaps(df, spark.createDataFrame([(1, 40.0)], "p long, d double"), "p", "s", "e", "o", "d")
    assert sorted((r["gap_start"], r["gap_end"]) for r in found.collect()) == [(0, 5), (30, 40)]


def test_padding_example(spark):
    df = spark.createDataFrame([(0.1, 3.2, 10.0), (9.0, 10.0, 10.0)], "s double, e double, d double")
    assert [(r["s"], round(r["e"], 6)) for r in iv.pad(df).collect()] == [(0.0, 3.4)]


def test_neighbour_bounds_example(spark):
    df = frame(spark, [(1, 1.0, 5.0, 0), (1, 5.2, 9.0, 1), (1, 9.0, 12.0, 2), (2, None, 4.0, 0)])
    found = {(r["p"], r["o"]): (r["max_left"], r["max_right"]) for r in iv.neighbour_bounds(df, "p", "s", "e", "o", 0.5).collect()}
    assert found[1, 0] == (0.5, pytest.approx(0.199)) and found[1, 1] == (pytest.approx(0.199), 0) and found[1, 2] == (0, 0.5)
    assert found[2, 0] == (None, None)


def test_regions_and_snapping_examples(spark):
    rows = [(1, t, lang, 2.5) for t, lang in ((0.0, "sk"), (0.5, "sk"), (1.0, "hu"), (1.5, "hu"))]
    df = spark.createDataFrame(rows, "p long, t double, lang string, d double")
    found = iv.regions(df, "p", "t", "lang", "d", "t").orderBy("start").collect()
    assert [(r["start"], r["end"], r["lang"]) for r in found] == [(0.0, 1.25, "sk"), (1.25, 2.5, "hu")]
    mids = F.array(F.lit(0.4), F.lit(1.9))
    assert spark.range(1).select(iv.snap(F.lit(1.25), mids).alias("x")).first()["x"] == 1.9
    assert spark.range(1).select(iv.snap(F.lit(1.1), mids, 0.1).alias("x")).first()["x"] == 1.1


def test_leading_run(spark):
    df = spark.createDataFrame([(["sk", "en", "hu", "sk"],), (["hu"],), (["sk", None],), ([],)], "w array<string>")
    assert [r["n"] for r in df.select(iv.leading_run(F.col("w"), "hu").alias("n")).collect()] == [2, 0, 2, 0]


def test_silence_middles(spark):
    df = spark.createDataFrame([([(1.0, 2.0), (2.01, 3.0)], 4.0), ([], 2.0)], "x array<struct<start:double,end:double>>, d double")
    assert [r["m"] for r in df.select(iv.silence_middles(F.col("x"), F.col("d")).alias("m")).collect()] == [[0.5, 3.5], [1.0]]


def test_fold_and_grouping_agree(spark):
    rng = random.Random(2)
    df = frame(spark, [(p, float(s := rng.randint(0, 500)), float(s + rng.randint(1, 50)), i) for p in range(5) for i in range(60)])
    a = iv.merged_groups(df, "p", "s", "e", 10, 100, "o").groupBy("p").agg(F.count("*").alias("n")).orderBy("p").collect()
    b = iv.greedy_groups(df, "p", "s", "e", 10, 100, "o").groupBy("p").agg((F.max("group_no") + 1).alias("n")).orderBy("p").collect()
    assert a == b


def test_empty_tables(spark):
    none = frame(spark, [])
    assert iv.greedy_groups(none, "p", "s", "e", 1, 1, "o").isEmpty() and iv.union_length(none, "p", "s", "e", "o").isEmpty()
    assert iv.hard_split(frame(spark, [(1, 5.0, 5.0, 0)])).isEmpty()


@pytest.mark.parametrize("labels", ["aba", "aab", "baa", "bab"])
def test_labels_of_one_time_count_once_in_order(spark, labels):
    """However the windows lie in their partitions, each label of a time has one region there."""
    from tessella.operators import scorers

    rows = [("u", 0.0, "z", 9.0, 0), *[("u", 4.0, label, 9.0, 1 + n) for n, label in enumerate(labels)], ("u", 6.0, "z", 9.0, 9)]
    windows = spark.createDataFrame(rows, "utterance_id string, t double, lang string, d double, event_id long")
    speech = spark.createDataFrame([], "utterance_id string, segments array<struct<start:double,end:double>>")
    for ordered in (windows, windows.orderBy(F.desc("event_id"))):
        found = scorers.purity_second(ordered, speech, "event_id").first()["language_regions"]
        first, second = dict.fromkeys(labels)
        assert [tuple(r) for r in found] == [(0.0, 2.5, "z"), (2.5, 4.5, first), (4.5, 5.5, second), (5.5, 9.0, "z")]
        plain = scorers.purity_second(ordered, speech).first()["language_regions"]
        assert [r["lang"] for r in plain] == ["z", "a", "b", "z"]
    # Times at the very end, where regions have no length.
    end = spark.createDataFrame([("u", 3.0, "z", 4.0, 0), ("u", 4.0, "b", 4.0, 1), ("u", 4.0, "a", 4.0, 2)], windows.schema)
    assert [tuple(r) for r in scorers.purity_second(end, speech, "event_id").first()["language_regions"]] == [(0.0, 4.0, "z"), (4.0, 4.0, "b"), (4.0, 4.0, "a")]
