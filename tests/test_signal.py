import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import signal
from tessella.operators import scorers
from tessella.sources import readers, writers
from tessella.streaming import incremental


def wav(pcm, rate=16_000, channels=1) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.asarray(pcm) * 32767).astype("<i2").tobytes())
    return out.getvalue()


CASES = [([], (-120.0, -120.0, False, 1.0)), ([0.5] * 1600, (-6.02, -6.02, False, 0.0)), ([0.0] * 1600, (-240.0, -240.0, False, 1.0)), ([1.0] * 10, (0.0, 0.0, True, 0.0))]


def test_tier1(spark):
    df = spark.createDataFrame([(p,) for p, _ in CASES], "x array<float>")
    rows = df.select(signal.tier1(F.col("x"), 16_000).alias("a"), signal.tier1_udf(16_000)(F.col("x")).alias("b")).collect()
    for r, (_, expected) in zip(rows, CASES, strict=True):
        assert tuple(r["b"]) == expected
        assert tuple(r["a"]) == pytest.approx(expected, abs=0.01)


def test_clip_and_resample(spark):
    df = spark.createDataFrame([([float(i) for i in range(10)],)], "x array<float>")
    cut = lambda s, e: df.select(signal.clip(F.col("x"), F.lit(s), F.lit(e), 2).alias("c")).first()["c"]
    assert cut(1.0, 2.0) == [2.0, 3.0] and cut(4.0, 9.0) == [8.0, 9.0] and cut(9.0, 10.0) == []
    assert signal.resample(np.arange(6), 4, 2).tolist() == [0, 2, 4]


def test_wav_round_trip(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav([0.5, -0.5] * 800))
    (tmp_path / "b.wav").write_bytes(b"no")
    found = {r["path"].rsplit("/")[-1]: r["info"] for r in readers.probe(spark, str(tmp_path)).collect()}
    assert found["a.wav"]["duration_sec"] == 0.1 and found["b.wav"] is None
    raw = spark.read.format("binaryFile").load(str(tmp_path / "*.wav")).select("path", "content")
    pcm = readers.audio(raw).filter("pcm IS NOT NULL").select(F.lit("u/1").alias("utterance_id"), "pcm")
    again = writers.wav_clips(pcm, str(tmp_path / "clips")).first()
    assert again["name"] == "u_1.wav" and signal.wav_samples(again["bytes"], 16_000) == pytest.approx([0.5, -0.5] * 800, abs=1e-3)
    assert signal.wav_samples(wav([0.2, 0.4] * 10, channels=2), 16_000) == pytest.approx([0.3] * 10, abs=1e-3)


def test_edges(spark):
    kind = "x array<float>, s array<struct<start:int,end:int>>"
    df = spark.createDataFrame([([0.5] * 1600, [(0, 1600)]), ([0.5] * 1600, [(1000, 1200)]), ([0.5] * 1600, [])], kind)
    a, b, c = [r["e"] for r in df.select(signal.edges(F.col("x"), F.col("s"), 1000).alias("e")).collect()]
    assert a["mid_word_cut_start"] and a["boundary_cut_end"] and not b["boundary_cut_start"] and c["no_speech"] and c["mid_word_cut_end"] is None


def test_scorers(spark):
    tone, quiet = [0.5] * 16_000, [0.0] * 16_000
    clips = spark.createDataFrame([("a", tone), ("b", quiet), ("c", [0.5] * 10), ("d", None)], "utterance_id string, pcm array<float>")
    vad = {r["utterance_id"]: r["vad_speech_ratio"] for r in scorers.score(clips, scorers.SCORERS["vad"]).collect()}
    assert vad == {"a": 1.0, "b": 0.0}
    lid = {r["utterance_id"]: r["lid_error"] for r in scorers.score(clips, scorers.SCORERS["lid"]).collect()}
    assert lid == {"a": None, "b": None, "c": "audio_too_short", "d": "audio_too_short"}

    def broken():
        def run(arrays):
            raise RuntimeError("no model")

        return run

    failing = scorers.Scorer(scorers.SIDECARS["vad"], broken, "vad_error")
    assert {r["vad_error"] for r in scorers.score(clips.filter("utterance_id = 'a'"), failing).collect()} == {"no model"}
    assert set(scorers.run_all(clips, {}, skip=["lid"])) == {"tier1", "vad", "dnsmos"}
    assert len(scorers.fit_window(np.zeros(10, np.float32))) == len(scorers.fit_window(np.zeros(200_000, np.float32))) == scorers.DNSMOS_SAMPLES


def test_refine(spark):
    pcm = [0.0] * 16_000 + [0.5] * 16_000 + [0.0] * 16_000
    rows = [("a", 1.2, 1.8, 0.5, 0.5, pcm), ("b", 0.0, 0.2, 0.0, 0.0, pcm), ("c", 0.0, 1.0, 0.1, 0.1, None)]
    df = spark.createDataFrame(rows, "utterance_id string, start double, end double, max_left double, max_right double, pcm array<float>")
    found = {r["utterance_id"]: r for r in scorers.refine(df).collect()}
    assert found["a"]["refined"] and found["a"]["new_start_sec"] == 0.95 and found["a"]["new_end_sec"] == 2.05
    assert found["b"]["refine_error"] == "no_speech_in_padded_region" and found["c"]["refine_error"] == "parent_load_failed"


def test_purity(spark):
    df = spark.createDataFrame([("a", "sk", 0.2, ["sk", "en", "hu"]), ("b", "hu", 0.9, [])], "utterance_id string, whole_top1 string, whole_prob double, windows array<string>")
    found = {r["utterance_id"]: r for r in scorers.purity_first(df).collect()}
    assert (found["a"]["foreign_prefix_sec"], found["a"]["whole_non_hu"], found["b"]["first_window_top1"]) == (2.0, True, None)
    windows = spark.createDataFrame([("a", t, lang, 2.5) for t, lang in ((0.0, "sk"), (0.5, "sk"), (1.0, "hu"), (1.5, "hu"))], "utterance_id string, t double, lang string, d double")
    speech = spark.createDataFrame([("a", [(0.0, 1.8), (2.0, 2.5)])], "utterance_id string, segments array<struct<start:double,end:double>>")
    (r,) = scorers.purity_second(windows, speech).collect()
    assert [tuple(x) for x in r["language_regions"]] == [(0.0, 1.9, "sk"), (1.9, 2.5, "hu")] and r["n_foreign_regions"] == 1 and r["first_hu_start_sec"] == 1.9


def test_incremental(spark, tmp_path):
    work = spark.createDataFrame([("a",), ("b",)], "utterance_id string")
    scored = lambda df: df.withColumn("x", F.lit(1)).withColumn("vad_error", F.when(F.col("utterance_id") == "b", "bad"))
    path = str(tmp_path / "t")
    incremental.append_new(work.limit(1), scored, path)
    incremental.append_new(work, scored, path)
    incremental.append_new(work, scored, path)
    assert sorted(r[0] for r in spark.read.parquet(path).select("utterance_id").collect()) == ["a", "b"]
    incremental.append_new(work, scored, path, retry_errors="vad_error")
    assert spark.read.parquet(path).count() == 3
    incremental.append_new(work, scored, path, force=True)
    assert spark.read.parquet(path).count() == 2


def test_following_a_folder(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([("a",), ("b",)], "utterance_id string")
    df.write.parquet(source)
    follow = lambda: incremental.follow(spark, source, df.schema, lambda b: b, out, str(tmp_path / "check"))
    assert follow() == 2 and follow() == 0
    df.write.mode("append").parquet(source)
    assert follow() == 2


def test_small_files_are_written_by_many_tasks(spark, tmp_path):
    """A file for each value, though a table's one partition holds them all; folders of these are deleted whole."""
    from tessella.plans import passes
    from tessella.sources import readers, writers

    path = str(tmp_path / "files")
    writers.one_file_each(spark.range(200).coalesce(1).selectExpr("cast(id as string) value"), path)
    found = readers.binary_files(spark, path, "part-*").collect()
    assert sorted(int(r["content"]) for r in found) == list(range(200))
    assert len({r["path"].rsplit("part-", 1)[1].split("-")[0] for r in found}) == writers.FOLDERS
    writers.remove_folders(spark, path)
    assert not readers.exists(spark, path)
    vectors = spark.createDataFrame([(1, [0.5] * 64, 0), (2, [-1.0] * 64, 0), (3, [0.5] * 64, 0)], "vec_id long, embedding array<float>, label int")
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = passes.QUERIES["wav_files"](spark, str(tmp_path)).collect()
    assert sorted(r["first"] for r in rows) == [-32767 / 32768, 16384 / 32768, 16384 / 32768] and {r["n"] for r in rows} == {32}
