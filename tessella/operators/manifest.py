"""Manifest rows: one emitter per kind of source, projections between generations, unions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import text as tx

# Licence stems in order of precedence, source names, texts of emitted rows.
LICENSES = [
    ("creativecommons.org/licenses/by/4.0", "CC-BY-4.0"),
    ("creativecommons.org/licenses/by/3.0", "CC-BY-3.0"),
    ("creativecommons.org/licenses/by-sa/4.0", "CC-BY-SA-4.0"),
    ("creativecommons.org/licenses/by-sa/3.0", "CC-BY-SA-3.0"),
    ("creativecommons.org/publicdomain/mark/1.0", "PD"),
    ("creativecommons.org/publicdomain/zero/1.0", "CC0-1.0"),
    ("creativecommons.org/licenses/publicdomain", "PD"),
]
BY3, BY4, CC0, PD = (
    "https://creativecommons.org/licenses/by/3.0/",
    "https://creativecommons.org/licenses/by/4.0/",
    "https://creativecommons.org/publicdomain/zero/1.0/",
    "https://creativecommons.org/publicdomain/mark/1.0/",
)
DROPPED = ("mosel_hu_voxpopuli", "mosel_hu_ytc", "voxpopuli_unlabeled_gap")
RESEGMENTED = "voxpopuli_resegmented"
COMMON_VOICE = "common_voice_25_0_hu"
WATCH = "https://www.youtube.com/watch?v="
CHUNK_SOURCES = {
    "librivox_hu": ("audiobook", "narrated", "PD", PD, "LibriVox HU chapter (PD, chunked from {})"),
    "podcasts_hu_cc": ("podcast", "spontaneous", "CC-BY", None, "HU podcast (mixed CC, chunked from {})"),
    "voxpopuli_unlabeled_gap": ("parliament", "formal", "CC0-1.0", CC0, "European Parliament HU gap-chunk (VoxPopuli unlabeled, CC0, chunked from {})"),
}

SHORT_SEC, LONG_SEC = 1.0, 30.0
CLIP_MIN_SEC, CLIP_MAX_SEC = 3.0, 30.0
PREVIEW = 80


def structure(kind: T.StructType, **values: Column) -> Column:
    """A struct of the kind; fields without a value are null."""
    return F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


def rows(df: DataFrame, kind: T.StructType, flags: Mapping[str, Column], **values: object) -> DataFrame:
    """Rows of a manifest: columns or constants by name, nulls for the rest."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    given = {k: value(v) for k, v in values.items()} | {"quality_flags": structure(schemas.FLAGS, **flags)}
    given.setdefault("transcripts", structure(schemas.TRANSCRIPTS))
    given.setdefault("language", F.lit("hu"))
    given.setdefault("split", F.lit("train"))
    given.setdefault("confidence_level", F.lit("UNKNOWN"))
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


# Expressions


def too_short(duration: Column, segmented: bool = True) -> Column:
    return F.coalesce(F.lit(segmented) & (duration > 0) & (duration < SHORT_SEC), F.lit(False))


def too_long(duration: Column, segmented: bool = True) -> Column:
    return F.coalesce(F.lit(segmented) & (duration >= LONG_SEC), F.lit(False))


def basic_flags(duration: Column, segmented: bool = True) -> dict[str, Column]:
    return {"too_short": too_short(duration, segmented), "too_long": too_long(duration, segmented)}


def acceptable(duration: Column, unknown: bool = True) -> Column:
    """3 to 30 s, both included; a null duration passes if ``unknown``."""
    return F.coalesce(duration.between(CLIP_MIN_SEC, CLIP_MAX_SEC), F.lit(unknown))


def license_of(url: Column, fallback: Column) -> Column:
    """The licence of the first stem that the URL contains."""
    low = F.rtrim(F.lower(url), F.lit("/"))
    found = F.lit(None).cast("string")
    for stem, name in reversed(LICENSES):
        found = F.when(F.contains(low, F.lit(stem)), F.lit(name)).otherwise(found)
    return F.coalesce(found, fallback)


def source_url(source: Column, item: Column, session: Column) -> Column:
    """Where a row's original is published; null if its source has no such place."""
    item = F.coalesce(F.nullif(item, F.lit("")), session, F.lit(""))
    year = F.substring(F.coalesce(F.nullif(session, F.lit("")), item), 1, 4)
    return (
        F.when(source == "yodas2_hu000", F.concat(F.lit(WATCH), item))
        .when(source.isin("librivox_hu", "podcasts_hu_cc"), F.concat(F.lit("https://archive.org/details/"), item))
        .when(source == "voxpopuli_hu_labeled", F.lit("https://huggingface.co/datasets/facebook/voxpopuli"))
        .when((source == RESEGMENTED) & year.rlike("^[0-9]+$"), F.concat(F.lit("https://dl.fbaipublicfiles.com/voxpopuli/audios/hu_"), year, F.lit(".tar")))
        .when(source == COMMON_VOICE, F.lit("https://commonvoice.mozilla.org/datasets"))
    )


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def split_of_file(path: Column) -> Column:
    """The split that a shard's name begins with."""
    name = F.lower(file_name(path))
    return F.when(name.startswith("test-"), "test").when(name.startswith("validation-"), "dev").when(name.startswith("train-"), "train")


def parse_id(uid: Column) -> Column:
    """video_id, start_sec, end_sec of ``video-seg-start-end`` in hundredths; null where it has fewer parts."""
    part = lambda i: F.regexp_extract(uid, r"(?s)^(.*)-([^-]*)-([^-]*)-([^-]*)$", i)
    whole = uid.rlike(r"(?s)^.*-[^-]*-[^-]*-[^-]*$")
    number = lambda i: F.when(whole & part(3).rlike(r"^\s*[+-]?\d+\s*$") & part(4).rlike(r"^\s*[+-]?\d+\s*$"), F.trim(part(i)).try_cast("long") / 100.0)
    return F.struct(F.when(whole, part(1)).alias("video_id"), number(3).alias("start_sec"), number(4).alias("end_sec"))


def parse_strict_id(uid: Column) -> Column:
    """The same with five and eight digits exactly, and the segment number in between."""
    pattern = r"^(.+)-(\d{5})-(\d{8})-(\d{8})$"
    part = lambda i: F.regexp_extract(uid, pattern, i).try_cast("long")
    return F.when(uid.rlike(pattern), F.struct(F.regexp_extract(uid, pattern, 1).alias("video_id"), part(2).alias("seg"), part(3).alias("start_cs"), part(4).alias("end_cs")))


def session_of(uid: Column) -> Column:
    """The parent of a segment's id: without its number, or up to the first hyphen."""
    return F.when(F.contains(uid, F.lit("_hu_")), F.regexp_replace(uid, r"_[^_]*$", "")).otherwise(F.substring_index(uid, "-", 1))


def labeled_session_of(uid: Column) -> Column:
    return F.when(F.contains(uid, F.lit("-hu")), F.concat(F.substring_index(uid, "-hu", 1), F.lit("_hu")))


def safe_name(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")


def file_id(text: Column) -> Column:
    return F.replace(text, F.lit("/"), F.lit("__"))


def relative(path: Column, root: str) -> Column:
    """A path below ``root``; others as they are."""
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 1 << 30)).otherwise(path)


def within_root(path: Column, root: str) -> Column:
    """A path's place below ``root`` with its dots resolved; null for a path that leaves it, or is no path.

    A relative path is taken from ``root``.  Links aren't followed: that is the store's matter.
    """
    base = root.rstrip("/")
    whole = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base + "/"), path))
    up = lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, part))
    parts = F.filter(F.split(whole, "/"), lambda x: ~x.isin("", "."))
    clean = F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), up), "/"))
    inside = (path != "") & ~F.contains(path, F.lit("\0")) & clean.startswith(base + "/")
    return F.when(inside, F.substring(clean, len(base) + 2, 1 << 30))


def non_empty_values(transcripts: Column, kind: T.StructType = schemas.TRANSCRIPTS) -> list[Column]:
    return [F.nullif(transcripts[f], F.lit("")) for f in kind.fieldNames()]


def has_text(transcripts: Column, kind: T.StructType = schemas.TRANSCRIPTS) -> Column:
    """Whether any transcript isn't empty."""
    return F.coalesce(*non_empty_values(transcripts, kind)).isNotNull()


def has_transcript_entry(transcripts: Column, kind: T.StructType = schemas.TRANSCRIPTS) -> Column:
    """Whether there is any transcript, an empty one included."""
    return F.coalesce(*[transcripts[f] for f in kind.fieldNames()]).isNotNull()


def preview(*texts: Column) -> Column:
    """The first text that isn't empty on one line, at most 80 characters with an ellipsis."""
    line = F.replace(F.trim(F.regexp_replace(F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit("")), r"^\s+|\s+$", "")), F.lit("\n"), F.lit(" "))
    return F.when(F.length(line) > PREVIEW, F.concat(F.substring(line, 1, PREVIEW - 1), F.lit("…"))).otherwise(line)


def sorted_json(value: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(value))))


def sorted_struct_json(value: Column, kind: T.StructType) -> Column:
    """A struct as JSON, keys in order, null fields left out; null and empty as {}."""
    return F.coalesce(F.to_json(F.struct(*[value[f].alias(f) for f in sorted(kind.fieldNames())])), F.lit("{}"))


def lid(flags: Column) -> Column:
    return F.coalesce(flags["lid_top1"], flags["lid"])


def lid_probability(flags: Column) -> Column:
    """The probability, or 1 or 0 by the flag where there is only that."""
    return F.coalesce(flags["lid_is_hu_prob"], F.when(flags["lid_is_hu"], 1.0).when(~flags["lid_is_hu"], 0.0))


# Projections between generations

_PROMOTED = [
    "too_short", "too_long", "rms_dbfs", "peak_dbfs", "is_clipped", "silence_ratio", "vad_speech_ratio", "vad_num_segments", "vad_speech_sec",
    "dnsmos_sig", "dnsmos_bak", "dnsmos_ovrl", "any_hallucination_flag",
]
_PURITY = ["foreign_prefix_sec", "whole_non_hu", "whole_clip_top1", "whole_clip_hu_prob", "first_window_top1", "n_non_hu_windows"]
_REFINED = ["refined", "change_start_ms", "change_end_ms", "new_start_sec", "new_end_sec", "n_vad_segments"]
_PLAIN = [f for f in schemas.MANIFEST.fieldNames() if f not in ("transcripts", "pairwise_wer", "hallucination_flags", "quality_flags", "refined_audio_path")]


def flatten(manifest: DataFrame) -> DataFrame:
    """The flat table of 65 typed columns."""
    t, q = F.col("transcripts"), F.col("quality_flags")
    flag = lambda names: [q[n].cast(schemas.FLAGS[n].dataType).alias(f"qf_{n}") for n in names]
    texts = [t["source_caption"], t["whisper_large_v3_pseudo"], t["source_caption_normalized"]]
    return manifest.select(
        *_PLAIN,
        has_text(t).alias("has_text"),
        t["source_caption"].alias("text_source_caption"),
        t["whisper_large_v3_pseudo"].alias("text_whisper_large_v3_pseudo"),
        preview(*texts).alias("text_preview"),
        sorted_struct_json(t, schemas.TRANSCRIPTS).alias("transcripts_json"),
        *flag(_PROMOTED),
        lid(q).alias("qf_lid"),
        q["lid_top1_label"].alias("qf_lid_label"),
        q["lid_top1_score"].alias("qf_lid_score"),
        lid_probability(q).alias("qf_lid_is_hu_prob"),
        *flag(_PURITY),
        "refined_audio_path",
        *flag(_REFINED),
        sorted_struct_json(q, schemas.FLAGS).alias("quality_flags_json"),
        F.when(F.col("hallucination_flags").isNotNull(), sorted_struct_json(F.col("hallucination_flags"), schemas.HALLUCINATION)).alias("hallucination_flags_json"),
        sorted_json(F.col("pairwise_wer")).alias("pairwise_wer_json"),
    )


def keep_sources(manifest: DataFrame, dropped: tuple[str, ...] = DROPPED) -> DataFrame:
    """Without the dropped sources; rows without a source stay."""
    return manifest.filter(~F.coalesce(F.col("source").isin(*dropped), F.lit(False)))


def override_audio(lean: DataFrame, override: DataFrame, source: str, standalone: bool) -> DataFrame:
    """Point rows of a source to extracted files (utterance_id, audio_path).

    A ``standalone`` file is the whole clip, so its offsets go.
    """
    paths = override.select(F.col("utterance_id").alias("o_id"), F.col("audio_path").alias("o_path")).dropDuplicates(["o_id"])
    hit = F.col("o_path").isNotNull()
    joined = lean.join(paths, (F.col("utterance_id") == F.col("o_id")) & (F.col("source") == source), "left")
    new = {"audio_path": F.col("o_path"), "audio_format": F.lit("ogg"), "codec": F.lit("ogg"), "sample_rate": F.lit(16_000).cast("long"), "channels": F.lit(1).cast("long")}
    if standalone:
        new |= {c: F.lit(None).cast("double") for c in ("segment_start_sec", "segment_end_sec")}
    return joined.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()}).drop("o_id", "o_path")


def lean(manifest: DataFrame, chunks: DataFrame | None = None, extracted: DataFrame | None = None) -> DataFrame:
    """The lean generation: kept sources and columns, captions normalized anew, paths overridden."""
    caption = F.col("transcripts.source_caption")
    fresh = F.when(F.coalesce(caption, F.lit("")) != "", tx.normalize(caption)).otherwise(F.col("transcripts.source_caption_normalized"))
    split = F.when(F.col("source") == "voxpopuli_hu_labeled", split_of_file(F.col("audio_path")))
    q = F.coalesce("quality_flags", structure(schemas.FLAGS))
    out = keep_sources(manifest).select(*schemas.LEAN_COLUMNS).withColumns(
        {
            "quality_flags": q.withField("hf_split", F.coalesce(split, q["hf_split"])),
            "transcripts": F.coalesce("transcripts", structure(schemas.TRANSCRIPTS)).withField("source_caption_normalized", fresh),
        }
    )
    if chunks is not None:
        out = override_audio(out, chunks, "yodas2_hu000", standalone=True)
    if extracted is not None:
        out = override_audio(out, extracted, "voxpopuli_hu_labeled", standalone=False)
    return out.withColumn("source_url", source_url(F.col("source"), F.col("source_item_id"), F.col("parent_session_id")))


def union(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; columns a part lacks are null."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


# Emitters


def web_segments(wavs: DataFrame, texts: DataFrame, durations: DataFrame, root: str) -> DataFrame:
    """Segment files (path) with captions and durations (uid, value); files without a caption are left out."""
    uid = F.regexp_replace(file_name(F.col("path")), r"\.[^.]*$", "")
    joined = wavs.select("path", uid.alias("uid")).join(texts.select("uid", F.col("value").alias("caption")), "uid").join(durations.select("uid", F.col("value").alias("listed")), "uid", "left")
    joined = joined.withColumn("p", parse_id(F.col("uid")))
    listed = F.coalesce("listed", F.lit(0.0))
    seconds = F.when((listed <= 0) & F.col("p.start_sec").isNotNull(), F.col("p.end_sec") - F.col("p.start_sec")).otherwise(listed)
    video = F.col("p.video_id")
    return rows(
        joined, schemas.MANIFEST, basic_flags(seconds), utterance_id=F.col("uid"), source="yodas_hu000", source_item_id=video, audio_path=F.col("path"), audio_format="wav",
        relative_audio_path=relative(F.col("path"), root), sample_rate=16_000, channels=1, codec="wav", duration_sec=seconds, segment_start_sec=F.col("p.start_sec"),
        segment_end_sec=F.col("p.end_sec"), parent_audio_path=F.concat(F.lit(WATCH), video), transcripts=structure(schemas.TRANSCRIPTS, source_caption=F.col("caption")),
        speaker_id=video, domain="youtube", register="unknown", license="CC-BY-3.0", license_url=BY3,
        attribution=F.coalesce(F.concat(F.lit("YouTube video "), video, F.lit(" (CC-BY, YODAS hu000 manual caption)")), F.lit("YODAS hu000 (CC-BY)")), segmentation_status="segmented_file",
    )


def merged_captions(merged: DataFrame, wavs: DataFrame, root: str) -> DataFrame:
    """Merged clips on their recording's file; clips without one are left out."""
    index = wavs.select(F.regexp_replace(file_name(F.col("path")), r"\.[^.]*$", "").alias("audio_id"), "path").groupBy("audio_id").agg(F.min("path").alias("path"))
    joined, video, seconds = merged.join(index, "audio_id"), F.col("audio_id"), F.col("duration_sec")
    return rows(
        joined, schemas.MANIFEST, basic_flags(seconds) | {"merged_from": F.col("merged_from"), "video_duration_sec": F.col("video_duration_sec")},
        utterance_id=F.col("merged_utt_id"), source="yodas2_hu000", source_item_id=video, audio_path=F.col("path"), audio_format="wav", relative_audio_path=relative(F.col("path"), root),
        sample_rate=24_000, channels=1, codec="wav", duration_sec=seconds, segment_start_sec=F.col("start_sec"), segment_end_sec=F.col("end_sec"),
        parent_audio_path=F.concat(F.lit(WATCH), video), transcripts=structure(schemas.TRANSCRIPTS, source_caption=F.col("text")), speaker_id=video, domain="youtube",
        register="unknown", license="CC-BY-3.0", license_url=BY3, attribution=F.concat(F.lit("YouTube video "), video, F.lit(" (CC-BY, YODAS2 hu000)")), segmentation_status="merged",
    )


def archive_files(probed: DataFrame, items: DataFrame, source: str, fallback: str, domain: str, register: str, root: str) -> DataFrame:
    """Whole files of archived items (path, info) with their items' titles and licences (identifier, title, license_url)."""
    ident = F.element_at(F.split("path", "/"), -2)
    stem = F.regexp_replace(file_name(F.col("path")), r"\.[^.]*$", "")
    known = items.select(F.col("identifier").alias("i_id"), "title", F.nullif("license_url", F.lit("")).alias("i_url"))
    joined = probed.filter(F.col("info.duration_sec") > 0).withColumn("ident", ident).join(known, F.col("ident") == F.col("i_id"), "left")
    seconds = F.col("info.duration_sec")
    return rows(
        joined, schemas.MANIFEST, basic_flags(seconds, segmented=False), utterance_id=F.concat_ws("/", "ident", stem), source=source, source_item_id=F.col("ident"), audio_path=F.col("path"),
        audio_format=F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)), relative_audio_path=relative(F.col("path"), root), sample_rate=F.col("info.sample_rate"), channels=F.col("info.channels"),
        codec=F.col("info.codec"), duration_sec=seconds, speaker_id=F.col("ident"), domain=domain, register=register,
        license=license_of(F.col("i_url"), F.lit(fallback.split("(")[0].strip() or "?")), license_url=F.col("i_url"),
        attribution=F.format_string("%s (archive.org: %s)", F.coalesce("title", "ident"), F.col("ident")), segmentation_status="session_level",
    )


def labeled(shards: DataFrame, durations: DataFrame, root: str) -> DataFrame:
    """Rows inside Parquet shards (audio_id, raw_text, ..., path, row_index), of acceptable or unknown length."""
    known = durations.select(F.col("audio_id").alias("d_id"), F.col("duration_sec").alias("seconds"))
    joined = shards.join(known, F.col("audio_id") == F.col("d_id"), "left").filter(acceptable(F.col("seconds")))
    name, uid, gold = file_name(F.col("path")), F.col("audio_id").cast("string"), F.coalesce("is_gold_transcript", F.lit(False))
    split = F.when(F.contains(name, F.lit("train")), "train").when(F.contains(name, F.lit("test")), "test").otherwise("validation")
    texts = structure(schemas.TRANSCRIPTS, source_caption=F.col("raw_text"), source_caption_normalized=F.col("normalized_text"))
    return rows(
        joined, schemas.MANIFEST, {"too_short": F.lit(False), "too_long": F.lit(False), "is_gold_transcript": gold, "gender": F.col("gender")},
        utterance_id=F.concat(F.lit("voxpopuli_hu_labeled/"), uid), source="voxpopuli_hu_labeled", source_item_id=F.col("speaker_id"), parent_session_id=labeled_session_of(uid),
        audio_path=F.col("path"), audio_format="parquet", parquet_row_index=F.col("row_index"), relative_audio_path=relative(F.col("path"), root), sample_rate=16_000, channels=1,
        codec="parquet_internal", duration_sec=F.col("seconds"), transcripts=texts, confidence_level=F.when(gold, "HIGH").otherwise("UNKNOWN"), speaker_id=F.col("speaker_id"),
        domain="parliament", register="formal", license="CC0-1.0", license_url=CC0, attribution="European Parliament VoxPopuli HU (Facebook, CC0)", split=split, segmentation_status="segmented_file",
    )


def sessions(probed: DataFrame, root: str) -> DataFrame:
    """Whole sessions (path, info), filed by year."""
    session = F.regexp_replace(file_name(F.col("path")), r"\.[^.]*$", "")
    year = F.element_at(F.split("path", "/"), -2)
    return rows(
        probed.filter(F.col("info.duration_sec") > 0), schemas.MANIFEST, {"too_short": F.lit(False), "too_long": F.lit(False), "year": year},
        utterance_id=F.concat(F.lit("voxpopuli_hu_unlabeled/"), session), source="voxpopuli_hu_unlabeled", source_item_id=session, parent_session_id=session, audio_path=F.col("path"),
        audio_format="ogg", relative_audio_path=relative(F.col("path"), root), sample_rate=F.col("info.sample_rate"), channels=F.col("info.channels"), codec=F.col("info.codec"),
        duration_sec=F.col("info.duration_sec"), domain="parliament", register="formal", license="CC0-1.0", license_url=CC0,
        attribution=F.concat(F.lit("European Parliament "), year, F.lit(" HU (VoxPopuli unlabeled, CC0)")), segmentation_status="session_level",
    )


def chunks(sidecar: DataFrame, source: str, root: str) -> DataFrame:
    """Chunks of long recordings, of acceptable length."""
    domain, register, license_name, license_url, attribution = CHUNK_SOURCES[source]
    parent = F.col("session_id") if source == "voxpopuli_unlabeled_gap" else F.col("file_id")
    item = F.concat_ws("_", parent, F.lpad(F.col("chunk_index").cast("string"), 6, "0"))
    before, after = attribution.split("{}")
    return rows(
        sidecar.filter(acceptable(F.col("duration_sec"), unknown=False)), schemas.MANIFEST,
        {"too_short": F.lit(False), "too_long": F.lit(False), "chunk_index": F.col("chunk_index"), "parent_file_duration_sec": F.col("parent_file_duration_sec")},
        utterance_id=F.concat(F.lit(f"{source}/"), item), source=source, source_item_id=item, parent_session_id=parent, audio_path=F.col("audio_path"), audio_format="ogg",
        relative_audio_path=relative(F.col("audio_path"), root), sample_rate=16_000, channels=1, codec="vorbis", duration_sec=F.col("duration_sec"), segment_start_sec=F.col("start_sec"),
        segment_end_sec=F.col("end_sec"), parent_audio_path=F.col("parent_file_path"), speaker_id=parent, domain=domain, register=register, license=license_name, license_url=license_url,
        attribution=F.concat(F.lit(before), file_name(F.col("parent_file_path")), F.lit(after)), segmentation_status="chunked",
    )


def pseudo_labels(tsv: DataFrame, alignment: DataFrame | None, source: str, segments_root: str, root: str) -> DataFrame:
    """Pseudo-labelled rows (id, text, lid, hall_*, duration, offset).

    With an ``alignment`` (uid, start_sec, end_sec) the segments exist as files, and its
    bounds replace the listed ones.
    """
    uid = F.col("id")
    cell = lambda c: F.col(c) if c in tsv.columns else F.lit(None).cast("string")
    true = lambda c: F.coalesce(cell(c) == "True", F.lit(False))
    flags = {n: true(f"hall_{n}") for n in schemas.HALLUCINATION.fieldNames()}
    begin, seconds = cell("offset").try_cast("double"), cell("duration").try_cast("double")
    found = tsv.filter(F.coalesce(uid, F.lit("")) != "").withColumns({"begin": begin, "finish": begin + seconds, "seconds": seconds, "file": F.lit(None).cast("string")})
    status = "pending_segmentation"
    if alignment is not None:
        status = "segmented_file"
        bounds = alignment.select(F.col("uid").alias("a_id"), F.col("start_sec").alias("a_start"), F.col("end_sec").alias("a_end"))
        hit = F.col("a_start").isNotNull()
        found = found.join(bounds, uid == F.col("a_id"), "left").withColumns(
            {
                "begin": F.when(hit, F.col("a_start")).otherwise(F.col("begin")),
                "finish": F.when(hit, F.col("a_end")).otherwise(F.col("finish")),
                "seconds": F.when(hit, F.col("a_end") - F.col("a_start")).otherwise(F.col("seconds")),
                "file": F.concat(F.lit(segments_root.rstrip("/") + "/"), F.substring(uid, 1, 4), F.lit("/"), uid, F.lit(".ogg")),
            }
        )
    session, parliament = session_of(uid), source == "mosel_hu_voxpopuli"
    any_flag = flags["repeated_ngrams"] | flags["long_word"] | flags["frequent_single_word"]
    lid_ = F.coalesce(cell("lid"), F.lit(""))
    return rows(
        found, schemas.MANIFEST, {"too_short": F.lit(False), "too_long": F.lit(False), "any_hallucination_flag": any_flag, "lid": lid_, "lid_is_hu": lid_ == "hu"},
        utterance_id=F.concat(F.lit("mosel/"), uid), source=source, source_item_id=session, parent_session_id=session, audio_path=F.col("file"),
        audio_format=F.when(F.col("file").isNotNull(), "ogg"), relative_audio_path=relative(F.col("file"), root), sample_rate=16_000, channels=1, codec="ogg", duration_sec=F.col("seconds"),
        segment_start_sec=F.col("begin"), segment_end_sec=F.col("finish"),
        parent_audio_path=F.when(F.contains(session, F.lit("_hu")), F.concat(F.lit("raw/voxpopuli_hu_unlabeled/raw_audios/hu/*/"), session, F.lit(".ogg"))),
        transcripts=structure(schemas.TRANSCRIPTS, whisper_large_v3_pseudo=F.trim(F.coalesce(cell("text"), F.lit("")))), confidence_level="LOW",
        hallucination_flags=structure(schemas.HALLUCINATION, **flags), domain="parliament" if parliament else "youtube_commons", register="formal" if parliament else "unknown",
        license="CC-BY-4.0", license_url=BY4, attribution=f"MOSEL HU Whisper-pseudo-labels for {'VoxPopuli' if parliament else 'YouTube Commons'} HU (FBK, CC-BY)", segmentation_status=status,
    )


def resegmented(sidecar: DataFrame) -> DataFrame:
    """Lean rows of sessions segmented anew."""
    parent = F.col("parent_session_id")
    return rows(
        sidecar, schemas.LEAN, {"padding_sec": F.col("padding_sec")}, utterance_id=F.col("utterance_id"), source=RESEGMENTED, source_item_id=parent, parent_session_id=parent,
        audio_path=F.col("audio_path"), audio_format=F.coalesce("audio_format", F.lit("ogg")), sample_rate=F.coalesce("sample_rate", F.lit(16_000)), channels=F.coalesce("channels", F.lit(1)),
        codec="ogg", duration_sec=F.col("duration_sec"), segment_start_sec=F.col("segment_start_sec"), segment_end_sec=F.col("segment_end_sec"), license="CC-BY-4.0", license_url=BY4,
        attribution="VoxPopuli HU unlabeled (Facebook AI) — resegmented with Silero VAD", domain="parliament", register="formal", source_url=source_url(F.lit(RESEGMENTED), parent, parent),
    )


VOTED = ("validated", "invalidated", "other")


def prioritized(tables: Mapping[str, DataFrame], key: str, name: str) -> DataFrame:
    """One row per key: that of the first table that has it, and the table's name in ``name``."""
    ranked = union(*[t.select("*", F.lit(i).alias("rank_"), F.lit(n).alias(name)) for i, (n, t) in enumerate(tables.items())])
    rest = [c for c in ranked.columns if c not in (key, "rank_")]
    return ranked.groupBy(key).agg(F.min_by(F.struct(*rest), "rank_").alias("best")).select(key, "best.*")


def common_voice(durations: DataFrame, voted: Mapping[str, DataFrame], splits: Mapping[str, DataFrame], reported: DataFrame, clips_dir: str) -> DataFrame:
    """Lean rows of read-speech clips (clip, duration_ms) with their votes, status and split.

    ``voted`` maps status to clips (path, sentence, ...) and ``splits`` split to clips
    (path), both in order of precedence.
    """
    status = prioritized(voted, "path", "status").withColumnRenamed("path", "v_path")
    split = prioritized(splits, "path", "split_").withColumnRenamed("path", "s_path")
    told = reported.select(F.col("path").alias("r_path")).distinct()
    joined = durations.join(status, F.col("clip") == F.col("v_path"), "left").join(split, F.col("clip") == F.col("s_path"), "left").join(told, F.col("clip") == F.col("r_path"), "left")
    stem, sentence = F.regexp_replace("clip", r"\.[^.]*$", ""), F.trim(F.coalesce("sentence", F.lit("")))
    texts = F.when(sentence != "", structure(schemas.TRANSCRIPTS, source_caption=sentence, source_caption_normalized=tx.normalize(sentence))).otherwise(structure(schemas.TRANSCRIPTS))
    votes = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")).try_cast("int"), F.lit(0))
    return rows(
        joined, schemas.LEAN,
        {"cv25_status": F.coalesce("status", F.lit("unknown")), "cv25_split": F.col("split_"), "cv25_reported": F.col("r_path").isNotNull(), "up_votes": votes("up_votes"), "down_votes": votes("down_votes")},
        utterance_id=F.concat(F.lit(f"{COMMON_VOICE}/"), stem), source=COMMON_VOICE, source_item_id=stem, audio_path=F.concat(F.lit(clips_dir.rstrip("/") + "/"), "clip"), audio_format="mp3",
        sample_rate=48_000, channels=1, codec="mp3", duration_sec=F.col("duration_ms") / 1000.0, transcripts=texts, license="CC0-1.0", license_url=CC0,
        attribution="Mozilla Common Voice 25.0 HU (CC0-1.0)", domain="read_speech", register="read", source_url=source_url(F.lit(COMMON_VOICE), stem, F.lit(None).cast("string")),
    )
