"""Metrics of sample arrays: levels, clipping, silence, edges; WAV in and out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SILENCE_DBFS = -40.0
FRAME_SEC = 0.025
CLIPPED = 0.9999
#: Added before a logarithm.
TINY = 1e-12
EDGE_MS = 50
EDGE_WINDOW_SEC = 0.1
MID_WORD_DBFS = -25.0


def dbfs(level: Column) -> Column:
    return 20.0 * F.log10(level + F.lit(TINY))


def rms(pcm: Column) -> Column:
    total = F.aggregate(pcm, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.sqrt(total / F.size(pcm))


def peak(pcm: Column) -> Column:
    return F.array_max(F.transform(pcm, lambda x: F.abs(x).cast("double")))


def frames(pcm: Column, size: int) -> Column:
    """Whole frames of ``size`` samples; a rest is left out."""
    n = F.floor(F.size(pcm) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(pcm, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<array<float>>"))


def frame_size(rate: int) -> int:
    return max(1, int(FRAME_SEC * rate))


def tier1(pcm: Column, rate: int) -> Column:
    """rms_dbfs, peak_dbfs, is_clipped, silence_ratio, unrounded; an empty array has fixed values."""
    size = frame_size(rate)
    level, quiet = dbfs(rms(pcm)), F.lit(SILENCE_DBFS)
    n = F.floor(F.size(pcm) / size)
    silent = F.size(F.filter(frames(pcm, size), lambda f: dbfs(rms(f)) < quiet)) / n
    ratio = F.when(n == 0, F.when(level < quiet, 1.0).otherwise(0.0)).otherwise(silent)
    empty = F.size(pcm) == 0
    return F.when(
        empty, F.struct(F.lit(-120.0).alias("rms_dbfs"), F.lit(-120.0).alias("peak_dbfs"), F.lit(False).alias("is_clipped"), F.lit(1.0).alias("silence_ratio"))
    ).otherwise(F.struct(level.alias("rms_dbfs"), dbfs(peak(pcm)).alias("peak_dbfs"), (peak(pcm) >= CLIPPED).alias("is_clipped"), ratio.alias("silence_ratio")))


TIER1 = T.StructType().add("rms_dbfs", "double").add("peak_dbfs", "double").add("is_clipped", "boolean").add("silence_ratio", "double")


def tier1_numbers(pcm, rate: int) -> dict:
    """The same of a numpy array, in single precision and rounded, for long arrays."""
    import numpy as np

    pcm = np.asarray(pcm, np.float32)
    if not len(pcm):
        return {"rms_dbfs": -120.0, "peak_dbfs": -120.0, "is_clipped": False, "silence_ratio": 1.0}
    db = lambda x: 20.0 * np.log10(x + TINY)
    top, level, size = float(np.abs(pcm).max()), db(float(np.sqrt(np.mean(pcm**2)))), frame_size(rate)
    whole = pcm[: len(pcm) // size * size].reshape(-1, size)
    ratio = float((db(np.sqrt((whole**2).mean(axis=1))) < SILENCE_DBFS).mean()) if len(whole) else float(level < SILENCE_DBFS)
    return {"rms_dbfs": round(float(level), 2), "peak_dbfs": round(float(db(top)), 2), "is_clipped": top >= CLIPPED, "silence_ratio": round(ratio, 4)}


def tier1_udf(rate: int):
    @F.pandas_udf(TIER1)
    def run(column):
        import pandas as pd

        return pd.DataFrame([tier1_numbers(x, rate) for x in column], columns=TIER1.fieldNames())

    return run


def clip(pcm: Column, start: Column, end: Column, rate: int) -> Column:
    """Samples from ``start`` to ``end`` seconds, cut at the array's end; empty if there are none."""
    low = F.greatest((start * rate).cast("int"), F.lit(0))
    high = F.least((end * rate).cast("int"), F.size(pcm))
    return F.slice(pcm, low + 1, F.greatest(high - low, F.lit(0)))


def edges(pcm: Column, speech: Column, rate: int, edge_ms: int = EDGE_MS) -> Column:
    """Whether speech touches an array's edges, and with what level there.

    ``speech`` is an array of (start, end) samples.  Without speech only ``no_speech`` and
    false cuts are set.
    """
    edge, window = int(edge_ms * rate / 1000), int(EDGE_WINDOW_SEC * rate)
    n = F.size(pcm)
    first, last = F.get(speech, F.lit(0))["start"], F.try_element_at(speech, F.lit(-1))["end"]
    level = lambda part: F.when(F.coalesce(rms(part), F.lit(0.0)) <= TINY, -240.0).otherwise(20.0 * F.log10(rms(part)))
    head, tail = level(F.slice(pcm, 1, window)), level(F.slice(pcm, F.greatest(n - window, F.lit(0)) + 1, F.lit(window)))
    cut_start, cut_end = first < edge, n - last < edge
    silent = F.size(speech) == 0
    heard = lambda c: F.when(~silent, c)
    return F.struct(
        (~silent & cut_start).alias("boundary_cut_start"),
        (~silent & cut_end).alias("boundary_cut_end"),
        heard(cut_start & (head > MID_WORD_DBFS)).alias("mid_word_cut_start"),
        heard(cut_end & (tail > MID_WORD_DBFS)).alias("mid_word_cut_end"),
        heard(first * 1000.0 / rate).alias("first_speech_offset_ms"),
        heard((n - last) * 1000.0 / rate).alias("last_speech_to_end_ms"),
        heard(head).alias("start_100ms_rms_dbfs"),
        heard(tail).alias("end_100ms_rms_dbfs"),
        F.size(speech).alias("n_speech_segments"),
        F.when(silent, True).alias("no_speech"),
    )


def mono(samples):
    """Channels averaged."""
    return samples.mean(axis=1) if samples.ndim > 1 else samples


def resample(samples, rate: int, target: int):
    """Every so many samples, the nearest earlier one: the rule where no filter is at hand."""
    import numpy as np

    if rate == target or not len(samples):
        return samples
    if rate % target == 0:
        return samples[:: rate // target]
    return samples[(np.arange(int(len(samples) * target / rate)) * rate / target).astype(np.int64)]


def wav_samples(content: bytes, target: int):
    """Mono floats at ``target`` of WAV bytes, or None if they can't be read."""
    import io
    import wave

    import numpy as np

    try:
        with wave.open(io.BytesIO(content)) as w:
            rate, width, channels, raw = w.getframerate(), w.getsampwidth(), w.getnchannels(), w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        return None
    if width == 1:
        data = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width in (2, 4):
        data = np.frombuffer(raw, f"<i{width}").astype(np.float32) / float(1 << (8 * width - 1))
    else:
        return None
    return resample(mono(data[: len(data) // channels * channels].reshape(-1, channels)), rate, target)


def decode_wav(rate: int = 16_000):
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(column):
        import pandas as pd

        return pd.Series([wav_samples(x, rate) for x in column])

    return run


def encode_wav(rate: int = 16_000):
    @F.pandas_udf(T.BinaryType())
    def run(column):
        import io
        import wave

        import numpy as np
        import pandas as pd

        def one(pcm) -> bytes:
            out = io.BytesIO()
            with wave.open(out, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(2)
                w.setframerate(rate)
                w.writeframes((np.clip(np.asarray(pcm, np.float64), -1, 1) * 32767).round().astype("<i2").tobytes())
            return out.getvalue()

        return pd.Series([None if x is None else one(x) for x in column])

    return run
