import json

import pytest
from pyspark.sql import functions as F

from tessella import schemas
from tessella.operators import aggregates as ag
from tessella.operators import browse, merging, sampling, validation
from tessella.operators import manifest as m
from tessella.sources import readers, writers


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def row(**values):
    return json.dumps(values)


@pytest.fixture
def small(spark, tmp_path):
    lines = [
        row(utterance_id="a", source="s1", duration_sec=10.0, transcripts={"source_caption": "Az 5 alma"}, quality_flags={"too_short": False, "rms_dbfs": -10.0}),
        "",
        row(utterance_id="b", source="s1", duration_sec=2.0, transcripts={"source_caption": ""}, quality_flags={"lid": "sk", "dnsmos_ovrl": 3.5}),
        row(utterance_id="c", source="voxpopuli_hu_labeled", audio_path="/x/test-00000.parquet", quality_flags={}),
    ]
    (tmp_path / "m.jsonl").write_text("\n".join(lines))
    return readers.jsonl(spark, str(tmp_path / "m.jsonl"), schemas.MANIFEST)


def test_expressions(spark):
    lit, null = F.lit, F.lit(None).cast("string")
    assert one(spark, m.license_of(lit("HTTP://creativecommons.org/licenses/by-sa/4.0/"), lit("F"))) == "CC-BY-SA-4.0"
    assert one(spark, m.license_of(null, lit("F"))) == "F"
    assert one(spark, m.parse_id(lit("abc-def-00012-00001250-00001870"))).asDict() == {"video_id": "abc-def", "start_sec": 12.5, "end_sec": 18.7}
    assert one(spark, m.parse_id(lit("a-b"))).asDict() == {"video_id": None, "start_sec": None, "end_sec": None}
    assert one(spark, m.session_of(lit("20160118-0900-PLENARY-10_hu_0"))) == "20160118-0900-PLENARY-10_hu"
    assert one(spark, m.session_of(lit("VoDy7yMW8tU-425964-240"))) == "VoDy7yMW8tU"
    assert one(spark, m.preview(lit("x" * 81))) == "x" * 79 + "…"
    assert one(spark, m.preview(lit(""), null)) == ""
    for seconds, short, long in ((0.5, True, False), (30.0, False, True), (0.0, False, False), (None, False, False)):
        d = F.lit(seconds).cast("double")
        assert (one(spark, m.too_short(d)), one(spark, m.too_long(d))) == (short, long)
    assert one(spark, m.source_url(lit(m.RESEGMENTED), null, lit("20090112-0900_hu"))).endswith("hu_2009.tar")
    assert one(spark, m.split_of_file(lit("/a/validation-0.parquet"))) == "dev"


def test_text_flags(spark, small):
    t = F.col("transcripts")
    found = {r["utterance_id"]: (r["e"], r["h"]) for r in small.select("utterance_id", m.has_transcript_entry(t).alias("e"), m.has_text(t).alias("h")).collect()}
    assert found == {"a": (True, True), "b": (True, False), "c": (False, False)}


def test_flat_and_lean(spark, small):
    flat = m.flatten(small)
    assert len(flat.columns) == 65
    b = flat.filter("utterance_id = 'b'").first()
    assert (b["qf_lid"], json.loads(b["quality_flags_json"])) == ("sk", {"dnsmos_ovrl": 3.5, "lid": "sk"})
    lean = {r["utterance_id"]: r for r in m.lean(small).collect()}
    assert lean["a"]["transcripts"]["source_caption_normalized"] == "az öt alma" and lean["c"]["quality_flags"]["hf_split"] == "test"
    assert m.lean(small).columns == schemas.LEAN.fieldNames()


def test_merge(spark, small):
    v1 = spark.createDataFrame([("a", "sk", 0.5)], "utterance_id string, whole_clip_top1 string, whole_clip_hu_prob double")
    v2 = spark.createDataFrame([("a", "hu")], "utterance_id string, whole_clip_top1 string")
    a = merging.merge_flags(small, {"lang_purity": v1, "lang_purity_v2": v2}).filter("utterance_id = 'a'").first()
    q = a["quality_flags"]
    assert (q["whole_clip_top1"], q["whole_clip_hu_prob"], q["rms_dbfs"], q["too_short"], a["with_lang_purity"]) == ("hu", 0.5, -10.0, False, True)


def test_tolerant_reader(spark, tmp_path):
    path = tmp_path / "s.jsonl"
    path.write_text("\n".join([row(utterance_id="a", rms_dbfs=1.0), "{bad", row(rms_dbfs=2.0), row(utterance_id="a", rms_dbfs=3.0), row(utterance_id="a", other=1)]))
    rows = readers.jsonl_tolerant(spark, str(path), schemas.SIDECARS["tier1"]).collect()
    assert [(r["utterance_id"], r["rms_dbfs"]) for r in rows] == [("a", 3.0)]
    assert validation.schema_sanity(readers.jsonl_checked(spark, str(path), schemas.SIDECARS["tier1"]).cache()).first().asDict() == {"rows": 5, "bad": 1}
    assert [r[0] for r in readers.done_ids(spark, str(path)).collect()] == ["a"]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.jsonl(spark, str(path), schemas.SIDECARS["tier1"]).collect()


def test_tables_of_text(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("path\tsentence\tup_votes\nx.mp3\tone\t1\nx.mp3\ttwo\ny.mp3\n")
    found = {r["path"]: (r["sentence"], r["up_votes"]) for r in readers.tsv_map(spark, str(tmp_path / "t.tsv"), "path", ["sentence", "up_votes", "none"]).collect()}
    assert found == {"x.mp3": ("two", ""), "y.mp3": ("", "")}
    assert readers.tsv_map(spark, str(tmp_path / "none.tsv"), "path", ["sentence"]).isEmpty()
    assert {r[0] for r in readers.tsv_keys(spark, str(tmp_path / "t.tsv"), "nokey").collect()} == {"x.mp3", "y.mp3"}
    (tmp_path / "d.tsv").write_text("clip\tduration[ms]\na\t1200\nb\tx\n")
    assert [tuple(r) for r in readers.tsv_millis(spark, str(tmp_path / "d.tsv")).collect()] == [("a", 1200)]
    (tmp_path / "k.txt").write_text("id1 1.5\n\nid2 x\n")
    assert [tuple(r) for r in readers.key_values(spark, str(tmp_path / "k.txt"), "double").collect()] == [("id1", 1.5)]
    (tmp_path / "c.json").write_text(json.dumps([{"audio_id": "v", "text": {"u1": "x", "u2": "y"}}]))
    assert sorted(tuple(r) for r in readers.captions(spark, str(tmp_path / "c.json")).collect()) == [("v", "u1", "x"), ("v", "u2", "y")]
    (tmp_path / "r.csv").write_text("file,transcription_beam,transcription\nf,,plain\ng,beam,plain\n")
    assert sorted(tuple(r) for r in readers.transcriptions(spark, str(tmp_path / "r.csv")).collect()) == [("f", "plain"), ("g", "beam")]
    (tmp_path / "u.txt").write_text("a\n\n b \n")
    assert sorted(r[0] for r in readers.uid_list(spark, str(tmp_path / "u.txt")).collect()) == ["a", "b"]
    (tmp_path / "y.yaml").write_text("sources:\n  s:\n    license: CC0\n    items:\n      - {identifier: i, title: T}\n")
    assert ("s", "i", "title", "T") in [tuple(r) for r in readers.registry(spark, str(tmp_path / "y.yaml")).collect()]


def test_canonical_variants(spark):
    names = ["t_64kb.mp3", "t.mp3", "t.ogg", "u_VBR.mp3", "u.txt"]
    df = spark.createDataFrame(list(enumerate(names)), "position int, name string")
    assert {r["name"] for r in readers.canonical_variants(df).collect()} == {"t.mp3", "u_VBR.mp3"}


def test_positional_rows(spark, tmp_path):
    spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id int, text string").coalesce(1).write.parquet(str(tmp_path / "p"))
    shards = readers.parquet_rows(spark, str(tmp_path / "p"), ["text"])
    wanted = shards.filter("row_index = 7").select("shard", "row_index")
    assert [r["text"] for r in readers.rows_at(wanted, shards).collect()] == ["t7"]


def test_writers(spark, tmp_path, small):
    out = str(tmp_path / "out")
    writers.flat_parquet(m.flatten(small), out)
    writers.flat_parquet(m.flatten(small).limit(1), out)
    assert spark.read.parquet(out).count() == 1 and not list(tmp_path.glob("out.*"))
    document = writers.stats_document(ag.scorecard(small), before={"sessions": {"kept": 1}})
    assert document["manifest"]["total"]["count"] == 3 and document["sessions"] == {"kept": 1}
    writers.stats(spark, str(tmp_path / "stats.json"), document)
    assert json.loads(writers.read_text(spark, str(tmp_path / "stats.json"))) == document
    assert writers.backup_once(spark, str(tmp_path / "stats.json")) and not writers.backup_once(spark, str(tmp_path / "stats.json"))
    assert "| s1 |" in writers.markdown_report("R", {"sources": browse.facet(small, "source")})


def test_browse_binding(spark, small):
    request = browse.RowsRequest(columns=["utterance_id", "quality_flags.rms_dbfs", "nope"], minimum={"quality_flags.rms_dbfs": -20, "gone": 1})
    page, total = browse.rows(small, request)
    assert page.columns[:2] == ["utterance_id", "quality_flags.rms_dbfs"] and [r[0] for r in page.collect()] == ["a"] and total.first()["total"] == 1
    assert browse.page_bounds(0, 999) == (1, 200) and browse.page_bounds(3, 0) == (3, 50)
    with pytest.raises(browse.RequestError):
        browse.where(small, browse.RowsRequest(minimum={"duration_sec": "x"}))
    with pytest.raises(browse.RequestError):
        browse.projection(spark.range(1).select(F.lit(1).alias("z")))
    df = spark.createDataFrame([("1", None), ("2", True), ("3", False)], "utterance_id string, qf_is_clipped boolean").withColumn("qf_any_hallucination_flag", F.col("qf_is_clipped"))
    ids = lambda a: {r[0] for r in df.filter(browse.flat_where(df, a)).collect()}
    assert ids({"is_clipped": "no"}) == {"3"} and ids({"halluc": "no"}) == {"1", "3"}


def test_pages_are_top_k(spark, small):
    plan = browse.rows(small, browse.RowsRequest())[0]._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan or "CollectLimit" not in plan


def test_quota_and_splits(spark):
    df = spark.createDataFrame([("s", i, 4.0) for i in range(30)], "g string, id int, d double")
    assert sampling.until_quota(df, "g", "id", "d", 7.0).count() == 2
    assert sampling.until_quota(df, "g", "id", "d", {"other": 7.0}).isEmpty()
    rows = [(str(i), "s1", i < 4) for i in range(104)]
    df = spark.createDataFrame(rows, "utterance_id string, source string, bad boolean")
    picked = sampling.stratified(df, "source", "utterance_id", F.col("bad"), 50, 0.2).groupBy("bucket").count().collect()
    assert {r["bucket"]: r["count"] for r in picked} == {"outlier": 4, "normal": 46}


def test_train_and_test_share_nothing(spark, small):
    lean = m.lean(small).cache()
    test = sampling.test_set(lean)
    train = sampling.train_set(lean, test)
    assert {r["utterance_id"] for r in test.collect()} == {"c"} and {r["utterance_id"] for r in train.collect()} == {"a", "b"}


def test_percentiles(spark):
    df = spark.createDataFrame([(x,) for x in (4, 1, 3, 2)], "v int")
    found = ag.at_rank(df, "v", {"p50": ag.nearest_rank(50), "p25": ag.nearest_rank(25)}).first()
    assert (found["p50"], found["p25"]) == (3, 2)
    assert ag.at_rank(df.filter("v > 9"), "v", ag.quarter_ranks()).isEmpty()


def test_emitters(spark):
    chunk = spark.createDataFrame([("f", 3, "/r/a.ogg", 0.0, 5.0, 5.0, "/r/p/ch.mp3", 60.0), ("f", 4, "/r/a.ogg", 0.0, 2.0, 2.0, "/r/p/ch.mp3", 60.0)], "file_id string, chunk_index int, audio_path string, start_sec double, end_sec double, duration_sec double, parent_file_path string, parent_file_duration_sec double")
    rows = m.chunks(chunk.withColumn("session_id", F.lit(None).cast("string")), "librivox_hu", "/r").collect()
    assert [(r["utterance_id"], r["attribution"], r["relative_audio_path"]) for r in rows] == [("librivox_hu/f_000003", "LibriVox HU chapter (PD, chunked from ch.mp3)", "a.ogg")]
    tsv = spark.createDataFrame([("2016-x_hu_0", " hi ", "sk", "True", "False", "False", "3.5", "1.0"), ("", "", "", "", "", "", "", "")], "id string, text string, lid string, hall_repeated_ngrams string, hall_long_word string, hall_frequent_single_word string, duration string, offset string")
    (r,) = m.pseudo_labels(tsv, None, "mosel_hu_voxpopuli", "/seg", "/r").collect()
    assert (r["parent_session_id"], r["segment_end_sec"], r["transcripts"]["whisper_large_v3_pseudo"]) == ("2016-x_hu", 4.5, "hi")
    assert r["quality_flags"]["any_hallucination_flag"] and not r["quality_flags"]["lid_is_hu"] and r["segmentation_status"] == "pending_segmentation"
    bounds = spark.createDataFrame([("2016-x_hu_0", 10.0, 12.0)], "uid string, start_sec double, end_sec double")
    (r,) = m.pseudo_labels(tsv, bounds, "mosel_hu_voxpopuli", "/seg", "/r").collect()
    assert (r["duration_sec"], r["audio_path"]) == (2.0, "/seg/2016/2016-x_hu_0.ogg")
    durations = spark.createDataFrame([("c1.mp3", 1500), ("c2.mp3", 900)], "clip string, duration_ms long")
    voted = {s: spark.createDataFrame([(c, t, v, "0")], "path string, sentence string, up_votes string, down_votes string") for s, c, t, v in (("validated", "c1.mp3", "Jó 2", "3"), ("invalidated", "c1.mp3", "rossz", "9"))}
    splits = {s: spark.createDataFrame([(c,)], "path string") for s, c in (("train", "c1.mp3"), ("dev", "c1.mp3"))}
    rows = {r["source_item_id"]: r for r in m.common_voice(durations, voted, splits, spark.createDataFrame([("c2.mp3",)], "path string"), "/clips").collect()}
    q = rows["c1"]["quality_flags"]
    assert (q["cv25_status"], q["cv25_split"], q["up_votes"], q["cv25_reported"]) == ("validated", "train", 3, False) and rows["c1"]["transcripts"]["source_caption_normalized"] == "jó kettő"
    assert rows["c2"]["quality_flags"]["cv25_status"] == "unknown" and rows["c2"]["quality_flags"]["cv25_reported"]
    shards = spark.createDataFrame([("x-hu-1", "Raw", "raw", "m", "sp", True, "/r/train-0.parquet", 5), ("long", "", "", "m", "sp", False, "/r/test-0.parquet", 6)], "audio_id string, raw_text string, normalized_text string, gender string, speaker_id string, is_gold_transcript boolean, path string, row_index long")
    rows = m.labeled(shards, spark.createDataFrame([("long", 31.0)], "audio_id string, duration_sec double"), "/r").collect()
    assert [(r["utterance_id"], r["parent_session_id"], r["split"], r["confidence_level"], r["duration_sec"]) for r in rows] == [("voxpopuli_hu_labeled/x-hu-1", "x_hu", "train", "HIGH", None)]
    again = spark.createDataFrame([("u", "20090112-0900_hu", 0, "/a.ogg", None, None, None, 4.0, 1.0, 5.0, 0.2)], schemas.RESEGMENTED)
    (r,) = m.resegmented(again).collect()
    assert (r["source"], r["audio_format"], r["quality_flags"]["padding_sec"]) == (m.RESEGMENTED, "ogg", 0.2) and r["source_url"].endswith("hu_2009.tar")


def test_validation(spark, small):
    flagged = small.withColumn("quality_flags", F.col("quality_flags").withField("silence_ratio", F.lit(2.0)))
    found = {r["metric"]: (r["violations"], r["examples"]) for r in validation.range_violations(flagged).collect()}
    assert found == {"silence_ratio": (3, ["a", "b", "c"])}
    side = small.filter("utterance_id = 'a'").select("utterance_id", "quality_flags.rms_dbfs")
    assert validation.spot_check(small, {"tier1": side}).first().asDict() == {"sidecar": "tier1", "field": "rms_dbfs", "compared": 1, "different": 0}
    assert merging.pending(small, side).count() == 2


def test_more_readers(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.tsv.gz", "wt") as f:
        f.write("event_id\tsegment_no\tstart\tend\nx_hu\t0\t1.0\t2.5\nx_hu\t1\tbad\t3\ny_de\t0\t1\t2\n")
    assert [tuple(r)[2:] for r in readers.alignment(spark, str(tmp_path / "a.tsv.gz")).collect()] == [("x_hu_0", 1.0, 2.5)]
    (tmp_path / "q.tsv").write_text('id\ttext\n1\t"two\nlines\tand ""tabs"""\n')
    assert [tuple(r) for r in readers.tsv_quoted(spark, str(tmp_path / "q.tsv")).collect()] == [("1", 'two\nlines\tand "tabs"')]
    assert {r["path"].rsplit("/")[-1] for r in readers.files(spark, str(tmp_path), "*.tsv").collect()} == {"q.tsv"}
    assert readers.first_present(spark, str(tmp_path / "none"), str(tmp_path / "q.tsv")) == str(tmp_path / "q.tsv")
    assert readers.first_present(spark, str(tmp_path / "none")) is None


def test_catalog(spark, tmp_path, small):
    m.flatten(small).write.parquet(str(tmp_path / "flat"))
    catalog = browse.Catalog(spark, {"flat": str(tmp_path / "flat")})
    assert catalog.listing() == [{"name": "flat", "path": str(tmp_path / "flat")}]
    with pytest.raises(browse.RequestError):
        catalog.open("/etc/passwd")
    catalog.open("flat")
    assert catalog.stats().first()["rows"] == 3 and catalog.row("a").first()["source"] == "s1" and catalog.lids().first()["value"] == "sk"
    assert len(catalog.schema()) == 65 and catalog.sources().count() == 2 and catalog.rows(browse.RowsRequest())[1].first()["total"] == 3
    assert spark.sql("SELECT count(*) AS n FROM manifest").first()["n"] == 3


def test_other_emitters(spark):
    info = "path string, info struct<codec:string,sample_rate:bigint,channels:bigint,duration_sec:double>"
    probed = spark.createDataFrame([("/r/2011/x_hu.ogg", ("vorbis", 16000, 1, 60.0)), ("/r/2011/bad.ogg", None)], info)
    (r,) = m.sessions(probed, "/r").collect()
    assert (r["utterance_id"], r["quality_flags"]["year"], r["segmentation_status"]) == ("voxpopuli_hu_unlabeled/x_hu", "2011", "session_level")
    items = spark.createDataFrame([("2011", "Title", "https://creativecommons.org/publicdomain/mark/1.0/")], "identifier string, title string, license_url string")
    (r,) = m.archive_files(probed, items, "librivox_hu", "CC-BY (mixed)", "audiobook", "narrated", "/r").collect()
    assert (r["utterance_id"], r["license"], r["attribution"], r["audio_format"]) == ("2011/x_hu", "PD", "Title (archive.org: 2011)", "ogg")
    (r,) = m.archive_files(probed, items.limit(0), "podcasts_hu_cc", "CC-BY (mixed)", "podcast", "spontaneous", "/r").collect()
    assert (r["license"], r["attribution"], r["license_url"]) == ("CC-BY", "2011 (archive.org: 2011)", None)
    wavs = spark.createDataFrame([("/r/v-00001-00000100-00000350.wav",), ("/r/none.wav",)], "path string")
    texts = spark.createDataFrame([("v-00001-00000100-00000350", "szia")], "uid string, value string")
    (r,) = m.web_segments(wavs, texts, spark.createDataFrame([], "uid string, value double"), "/r").collect()
    assert (r["duration_sec"], r["speaker_id"], r["transcripts"]["source_caption"]) == (2.5, "v", "szia")
    merged = spark.createDataFrame([("v", "v-0-1", 0.0, 5.0, 5.0, "t", ["a"], 60.0), ("w", "w-0-1", 0.0, 5.0, 5.0, "t", ["a"], 60.0)], schemas.MERGED_CAPTIONS)
    (r,) = m.merged_captions(merged, spark.createDataFrame([("/r/v.wav",)], "path string"), "/r").collect()
    assert (r["utterance_id"], r["sample_rate"], r["quality_flags"]["merged_from"]) == ("v-0-1", 24_000, ["a"])


def test_sets(spark, small):
    lean = m.lean(small).cache()
    dev = sampling.dev_set(lean, {"s1": 0.001})
    assert {r["quality_flags"]["set_membership"] for r in dev.collect()} == {"dev"}
    smoke = sampling.smoke_set(lean, 10, 0.2)
    assert smoke.count() == 3 and {r["quality_flags"]["smoke_bucket"] for r in smoke.collect()} == {"normal"}
    checked = readers.jsonl_checked
    assert checked is not None and validation.verdict(lean, spark.createDataFrame([(None,)], f"{readers.CORRUPT} string"), {}, 3, 0.0) == {"A": True, "B": True, "D": True, "F": True}
    assert merging.merge_passes(spark.createDataFrame([("a", "hu", None), ("a", None, 2)], "utterance_id string, x string, y int")).first().asDict() == {"utterance_id": "a", "x": "hu", "y": 2}


def test_quoted_files_keep_texts_as_they_are(spark, tmp_path):
    """Spaces and line breaks around a text, NULs beside quotes, empty texts and nulls come back from quoted files."""
    from tessella.plans import files
    from tests.oracle import check

    texts = ["", None, " a ", "a\n", "\ta", "\r", "a\r\nb\r", "\x00", '\x00"', '"', '""', '"\n"', 'a"\tb', "\\", '\\"', " ", "NULL", "\x1f", "x" * 200_000]
    rows = [(i, text, other) for i, text in enumerate(texts) for other in ("en", text)]
    spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    check(spark, files.QUERIES["tsv_quoted"], files.ORACLES["tsv_quoted"], str(tmp_path))
    turns = [(1, n, role, t) for n, (role, t) in enumerate((role, t) for role in ("user", "other") for t in texts if t)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    check(spark, files.QUERIES["transcriptions"], files.ORACLES["transcriptions"], str(tmp_path))
