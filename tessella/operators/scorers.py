"""Scorers of audio: a registry of plug-ins, and defaults that need no model.

A plug-in is made once per task and scores lists of sample arrays.  A failing batch gives
error rows, never a failed job; error rows count as done.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import signal
from ..runtime import ship
from ..schemas import SIDECARS
from . import intervals as iv
from .aggregates import foreign_regions
from .merging import pending

RATE = 16_000
ERROR_CHARS = 120
DNSMOS_SAMPLES = 144_160
LID_CAP_SEC = 10
NEEDS_SECOND = 0.85


@dataclass(frozen=True)
class Scorer:
    """``make`` gives a function from sample arrays to a dict for each; None leaves a row out."""

    schema: T.StructType
    make: Callable[[], Callable[[list], list]]
    error: str
    shortest: float = 0.0
    #: What a clip that is too short gets: an error text, or None for no row at all.
    too_short: str | None = "audio_too_short"
    batch: int = 64


def score(clips: DataFrame, scorer: Scorer, rate: int = RATE) -> DataFrame:
    """Sidecar rows of clips (utterance_id, pcm)."""
    ship(clips.sparkSession)
    names = scorer.schema.fieldNames()

    def run(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        worker = scorer.make()
        for frame in frames:
            for at in range(0, len(frame), scorer.batch):
                part, out, valid = frame.iloc[at : at + scorer.batch], [], []
                for uid, pcm in zip(part["utterance_id"], part["pcm"], strict=True):
                    if pcm is None or len(pcm) < int(scorer.shortest * rate):
                        if scorer.too_short:
                            out.append({"utterance_id": uid, scorer.error: scorer.too_short})
                    else:
                        valid.append((uid, np.asarray(pcm, np.float32)))
                try:
                    found = worker([pcm for _, pcm in valid]) if valid else []
                    out += [{"utterance_id": uid, **r} for (uid, _), r in zip(valid, found, strict=True) if r is not None]
                except Exception as e:  # a plug-in may raise anything; the batch's rows carry it
                    out += [{"utterance_id": uid, scorer.error: str(e)[:ERROR_CHARS]} for uid, _ in valid]
                yield pd.DataFrame([{n: r.get(n) for n in names} for r in out], columns=names).astype(object)

    return clips.select("utterance_id", "pcm").mapInPandas(run, scorer.schema)


def energy_segments(pcm, rate: int, threshold: float = -40.0, shortest: float = 0.1, gap: float = 0.3) -> list[tuple[int, int]]:
    """Speech as (start, end) samples: loud frames, joined over short gaps, without short rests."""
    import numpy as np

    size = max(1, int(signal.FRAME_SEC * rate))
    n = len(pcm) // size
    if not n:
        return []
    level = np.sqrt((np.asarray(pcm[: n * size], np.float64).reshape(n, size) ** 2).mean(axis=1))
    loud = 20 * np.log10(level + signal.TINY) >= threshold
    edges = np.flatnonzero(np.diff(np.concatenate(([0], loud.astype(np.int8), [0]))))
    joined: list[list[int]] = []
    for start, end in edges.reshape(-1, 2) * size:
        if joined and start - joined[-1][1] < gap * rate:
            joined[-1][1] = int(end)
        else:
            joined.append([int(start), int(end)])
    return [(s, e) for s, e in joined if e - s >= shortest * rate]


def _vad():
    def run(arrays: list) -> list:
        out = []
        for pcm in arrays:
            segments = energy_segments(pcm, RATE)
            seconds = sum(e - s for s, e in segments) / RATE
            out.append({"vad_speech_ratio": round(seconds * RATE / len(pcm), 4) if len(pcm) else 0.0, "vad_num_segments": len(segments), "vad_speech_sec": round(seconds, 3)})
        return out

    return run


def language_of(pcm) -> tuple[str, float]:
    """A stand-in for a language model, by the zero-crossing rate: deterministic, and nothing more."""
    import numpy as np

    rate = float(np.mean(np.diff(np.signbit(pcm)) != 0)) if len(pcm) > 1 else 0.0
    p = round(1 / (1 + np.exp((rate - 0.5) * 20)), 4)
    return ("hu" if p >= 0.5 else "xx"), float(p)


def _lid():
    def run(arrays: list) -> list:
        out = []
        for pcm in arrays:
            top, p = language_of(pcm[: LID_CAP_SEC * RATE])
            out.append({"lid_top1": top, "lid_top1_label": f"{top}: {top}", "lid_top1_score": round(max(p, 1 - p), 4), "lid_is_hu_prob": p})
        return out

    return run


def fit_window(pcm, samples: int = DNSMOS_SAMPLES):
    """Padded with silence, or cut around the middle."""
    import numpy as np

    if len(pcm) < samples:
        return np.concatenate([pcm, np.zeros(samples - len(pcm), np.float32)])
    start = (len(pcm) - samples) // 2
    return pcm[start : start + samples]


def _dnsmos():
    """A stand-in for a perceptual model: levels mapped to 1 to 5."""

    def run(arrays: list) -> list:
        out = []
        for pcm in arrays:
            m = signal.tier1_numbers(fit_window(pcm), RATE)
            s, b = 1 + 4 * (1 - m["silence_ratio"]), 1 + 4 * (not m["is_clipped"])
            out.append({"dnsmos_sig": round(s, 3), "dnsmos_bak": round(b, 3), "dnsmos_ovrl": round((s + b) / 2, 3)})
        return out

    return run


SCORERS: dict[str, Scorer] = {
    "tier1": Scorer(SIDECARS["tier1"], lambda: lambda arrays: [signal.tier1_numbers(x, RATE) for x in arrays], "tier1_error", too_short=None),
    "vad": Scorer(SIDECARS["vad"], _vad, "vad_error", shortest=0.1, too_short=None),
    "lid": Scorer(SIDECARS["lid"], _lid, "lid_error", shortest=0.5),
    "dnsmos": Scorer(SIDECARS["dnsmos"], _dnsmos, "dnsmos_error", shortest=0.5),
}


def run_all(clips: DataFrame, done: Mapping[str, DataFrame], only: Sequence[str] = (), skip: Sequence[str] = ()) -> dict[str, DataFrame]:
    """New sidecar rows by metric, for clips that a metric hasn't scored yet."""
    wanted = [m for m in SCORERS if (not only or m in only) and m not in skip]
    return {m: score(pending(clips, done[m]) if m in done else clips, SCORERS[m]) for m in wanted}


def purity_first(labels: DataFrame) -> DataFrame:
    """(utterance_id, whole_top1, whole_prob, windows: labels in order) as the first audit's sidecar rows."""
    run = iv.leading_run(F.col("windows"), "hu")
    return labels.select(
        "utterance_id", F.col("whole_top1").alias("whole_clip_top1"), F.bround("whole_prob", 4).alias("whole_clip_hu_prob"), F.get("windows", F.lit(0)).alias("first_window_top1"),
        (run * 1.0).alias("foreign_prefix_sec"), run.cast("long").alias("n_non_hu_windows"), F.size("windows").cast("long").alias("n_windows_scanned"), (F.col("whole_top1") != "hu").alias("whole_non_hu"),
    )


def needs_second(top1, probability):
    """Whether the cheap pass leaves a clip to the expensive one."""
    return (top1 != "hu") | (probability < NEEDS_SECOND)


def purity_second(windows: DataFrame, speech: DataFrame, order: str = "lang") -> DataFrame:
    """Language regions of flagged clips, snapped to silences.

    ``windows`` (utterance_id, t, lang, d) are labelled windows of a clip of ``d`` seconds,
    ``speech`` (utterance_id, segments) its speech in seconds.  Labels of one time count once
    each, by the smallest ``order`` of their windows, then by name.
    """
    labels = windows.repartition("utterance_id").groupBy("utterance_id", "t", "lang", "d").agg(F.struct(F.min(order), F.col("lang")).alias("nth"))
    found = iv.regions(labels, "utterance_id", "t", "lang", "d", "nth", keep=("t", "nth"))
    lists = found.groupBy("utterance_id").agg(F.array_sort(F.collect_list(F.struct("t", "nth", "start", "end", "lang"))).alias("r"), F.max("end").alias("d"))
    heard = F.coalesce("segments", F.array().cast("array<struct<start:double,end:double>>"))
    # Each array is bound once; named in a lambda only, it would be made anew for each element.
    once = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    bound = lambda m: lambda x, i: F.when((i < F.size("r") - 1) & (F.size(heard) > 0), iv.snap(x["end"], m)).otherwise(x["end"])
    ends = once(iv.silence_middles(heard, F.col("d")), lambda m: F.transform("r", bound(m)))
    region = lambda e: lambda x, i: F.struct(F.bround(F.when(i == 0, x["start"]).otherwise(F.get(e, i - 1)), 3).alias("start"), F.bround(F.get(e, i), 3).alias("end"), x["lang"].alias("lang"))
    snapped = lists.join(speech, "utterance_id", "left").withColumn("language_regions", once(ends, lambda e: F.transform("r", region(e))))
    return snapped.select("utterance_id", "language_regions", foreign_regions(F.col("language_regions")).alias("f")).select("utterance_id", "language_regions", "f.*")


REFINED = T.StructType().add("utterance_id", "string").add("refined", "boolean").add("orig_start_sec", "double").add("orig_end_sec", "double").add("new_start_sec", "double").add(
    "new_end_sec", "double"
).add("change_start_ms", "double").add("change_end_ms", "double").add("n_vad_segments", "long").add("refine_error", "string")
SNAP_SEC = 0.05


def refine(clips: DataFrame, segments: Callable = energy_segments, rate: int = RATE) -> DataFrame:
    """New bounds for clips from the speech around them.

    Rows have utterance_id, start, end, max_left, max_right and pcm, the parent's samples;
    a parent's clips should be partitioned together, as its samples come with each.
    """
    ship(clips.sparkSession)

    def one(r) -> dict:
        out = {"utterance_id": r["utterance_id"], "refined": False}
        pcm = r["pcm"]
        if pcm is None:
            return out | {"refine_error": "parent_load_failed"}
        low, high = max(0.0, r["start"] - r["max_left"]), min(len(pcm) / rate, r["end"] + r["max_right"])
        first, last = int(low * rate), int(high * rate)
        if last <= first:
            return out | {"refine_error": "padded_window_empty"}
        try:
            found = segments(pcm[first:last], rate)
        except Exception as e:  # a plug-in may raise anything
            return out | {"refine_error": f"vad_failed: {str(e)[:80]}"}
        if not found:
            return out | {"refine_error": "no_speech_in_padded_region"}
        reach, margin = int(max(r["max_left"], r["max_right"]) * rate), int(SNAP_SEC * rate)
        begin, end = int((r["start"] - low) * rate), int((r["end"] - low) * rate)
        starts = [s for s, _ in found if max(0, begin - reach) <= s <= min(last - first, begin + reach)]
        ends = [e for _, e in found if max(0, end - reach) <= e <= min(last - first, end + reach)]
        to_begin = max(max(0, begin - reach), starts[0] - margin) if starts else begin
        to_end = min(min(last - first, end + reach), ends[-1] + margin) if ends else end
        if to_end <= to_begin:
            return out | {"refine_error": "refined_window_empty"}
        start, stop = low + to_begin / rate, low + to_end / rate
        return out | {
            "refined": True, "orig_start_sec": round(r["start"], 3), "orig_end_sec": round(r["end"], 3), "new_start_sec": round(start, 3), "new_end_sec": round(stop, 3),
            "change_start_ms": round((start - r["start"]) * 1000, 1), "change_end_ms": round((stop - r["end"]) * 1000, 1), "n_vad_segments": len(found),
        }

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        names = REFINED.fieldNames()
        for frame in frames:
            yield pd.DataFrame([{n: x.get(n) for n in names} for x in map(one, frame.to_dict("records"))], columns=names).astype(object)

    return clips.mapInPandas(run, REFINED)
