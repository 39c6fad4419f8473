"""Explicit schemas of manifests and sidecars; nothing large is ever inferred.

``quality_flags`` and ``transcripts`` are structs, so a scan reads only the fields that a
query names.
"""

from __future__ import annotations

from pyspark.sql import types as T


_ATOMS = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType()}


def _parts(text: str) -> list[str]:
    """Split at the commas outside angle brackets."""
    parts, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(text[last:i])
            last = i + 1
    return [p.strip() for p in [*parts, text[last:]]]


def _type(text: str) -> T.DataType:
    outer, _, inner = text.partition("<")
    inner = inner.removesuffix(">")
    if outer == "array":
        return T.ArrayType(_type(inner))
    if outer == "map":
        return T.MapType(*map(_type, _parts(inner)))
    if outer == "struct":
        return T.StructType([T.StructField(n, _type(t)) for n, t in (p.split(":", 1) for p in _parts(inner))])
    return _ATOMS[outer]


def schema(text: str) -> T.StructType:
    """A struct from ``name type, ...``, without a session."""
    return T.StructType([T.StructField(n, _type(t)) for n, t in (p.split(" ", 1) for p in _parts(text))])


#: Field families of quality_flags, by the sidecar that fills them.
FLAG_FAMILIES = {
    "basic": "too_short boolean, too_long boolean",
    "extras": "merged_from array<string>, video_duration_sec double, is_gold_transcript boolean, gender string, year string, chunk_index int, parent_file_duration_sec double",
    "pseudo": "any_hallucination_flag boolean, lid string, lid_is_hu boolean",
    "lean": "hf_split string, padding_sec double, cv25_status string, cv25_split string, cv25_reported boolean, up_votes int, down_votes int",
    "tier1": "rms_dbfs double, peak_dbfs double, is_clipped boolean, silence_ratio double",
    "vad": "vad_speech_ratio double, vad_num_segments bigint, vad_speech_sec double, vad_error string",
    "lid": "lid_top1 string, lid_top1_label string, lid_top1_score double, lid_is_hu_prob double, lid_error string",
    "dnsmos": "dnsmos_sig double, dnsmos_bak double, dnsmos_ovrl double, dnsmos_error string",
    "lang_purity": "whole_clip_top1 string, whole_clip_hu_prob double, first_window_top1 string, foreign_prefix_sec double, n_non_hu_windows bigint, whole_non_hu boolean, lid_audit_error string",
    "lang_purity_v2": "whole_clip_top1 string, whole_clip_hu_prob double, needs_pass2 boolean, lid_v2_error string, language_regions array<struct<start:double,end:double,lang:string>>, n_foreign_regions bigint, foreign_duration_sec double, first_hu_start_sec double, last_hu_end_sec double",
    "boundary_refined": "refined boolean, new_start_sec double, new_end_sec double, change_start_ms double, change_end_ms double, n_vad_segments bigint, refine_error string",
    "sets": "set_membership string, test_criterion string, smoke_bucket string",
}


def _union(*families: str) -> T.StructType:
    fields: dict[str, T.StructField] = {}
    for family in families:
        for f in schema(FLAG_FAMILIES[family]).fields:
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))


FLAGS = _union(*FLAG_FAMILIES)
TRANSCRIPTS = schema("source_caption string, source_caption_normalized string, whisper_large_v3_pseudo string")
HALLUCINATION = schema("repeated_ngrams boolean, long_word boolean, frequent_single_word boolean")

_IDENTITY = "utterance_id string, source string, source_item_id string, parent_session_id string"
_AUDIO = "audio_path string, audio_format string, parquet_row_index bigint, relative_audio_path string, sample_rate bigint, channels bigint, codec string, duration_sec double, segment_start_sec double, segment_end_sec double, parent_audio_path string"
_RIGHTS = "license string, license_url string, attribution string"


def _with(fields: T.StructType, **nested: T.DataType) -> T.StructType:
    for name, kind in nested.items():
        fields = T.StructType([*fields.fields, T.StructField(name, kind)])
    return fields


MANIFEST = _with(
    T.StructType(
        [
            *schema(f"{_IDENTITY}, {_AUDIO}").fields,
            T.StructField("transcripts", TRANSCRIPTS),
            *schema("text_consensus string, consensus_method string, confidence_level string, pairwise_wer map<string,double>").fields,
            T.StructField("hallucination_flags", HALLUCINATION),
            *schema(f"speaker_id string, domain string, register string, language string, {_RIGHTS}, split string, segmentation_status string, refined_audio_path string").fields,
        ]
    ),
    quality_flags=FLAGS,
)

LEAN_COLUMNS = [
    "utterance_id", "source", "source_item_id", "parent_session_id", "audio_path", "audio_format", "sample_rate", "channels", "codec",
    "duration_sec", "segment_start_sec", "segment_end_sec", "refined_audio_path", "parquet_row_index", "transcripts", "language",
    "license", "license_url", "attribution", "domain", "register", "split", "quality_flags",
]
LEAN = T.StructType([*[MANIFEST[c] for c in LEAN_COLUMNS], T.StructField("source_url", T.StringType())])

SIDECARS = {
    name: T.StructType([T.StructField("utterance_id", T.StringType()), *schema(FLAG_FAMILIES[name]).fields])
    for name in ("tier1", "vad", "lid", "dnsmos", "lang_purity", "lang_purity_v2", "boundary_refined")
}
SIDECARS["boundary_refined"] = T.StructType([*SIDECARS["boundary_refined"].fields, *schema("refined_audio_path string").fields])
BOUNDARY_AUDIT = schema(
    "utterance_id string, boundary_cut_start boolean, boundary_cut_end boolean, mid_word_cut_start boolean, mid_word_cut_end boolean, "
    "first_speech_offset_ms double, last_speech_to_end_ms double, start_100ms_rms_dbfs double, end_100ms_rms_dbfs double, n_speech_segments int, no_speech boolean, boundary_audit_error string"
)
MERGED_CAPTIONS = schema("audio_id string, merged_utt_id string, start_sec double, end_sec double, duration_sec double, text string, merged_from array<string>, video_duration_sec double")
CHUNKS = schema(
    "source string, file_id string, session_id string, chunk_index int, audio_path string, start_sec double, end_sec double, duration_sec double, parent_file_path string, parent_file_duration_sec double, gap_interval_index int"
)
RESEGMENTED = schema(
    "utterance_id string, parent_session_id string, chunk_idx int, audio_path string, audio_format string, sample_rate bigint, channels bigint, duration_sec double, segment_start_sec double, segment_end_sec double, padding_sec double"
)
PATH_OVERRIDE = schema("utterance_id string, audio_path string, duration_sec double, sample_rate bigint, channels bigint, codec string")
DURATIONS = schema("audio_id string, duration_sec double, sample_rate bigint, channels bigint")
PILLAR = schema("utterance_id string, source string, raw string, normalized string, ref_wer double")
CONSENSUS = schema("utterance_id string, source string, pairwise_wer double, consensus_tier string, duration_bucket string, consensus_text string")
