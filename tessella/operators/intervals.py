"""Interval algebra on parent timelines.

Folds whose next step depends on the group so far (a gap and a span limit) stream over a
parent's sorted intervals and hold the open group only; everything else is window
functions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship

MIN_CLIP, MAX_CLIP, CHUNK_GAP = 3.0, 30.0, 1.0
#: Captions are in hundredths of a second.
CAPTION_GAP, CAPTION_SPAN = 100, 3000
PAD = 0.2
MARGIN = 0.001
SNAP_RADIUS = 0.75
SILENCE_GAP = 0.05
WINDOW_SEC, STRIDE_SEC = 1.0, 0.5


def greedy_groups(df: DataFrame, parent: str | Sequence[str], start: str, end: str, gap: float, span: float, order: str) -> DataFrame:
    """``df`` with group_no: intervals in order join the group before them while the gap to
    its last interval's end is at most ``gap`` and they end within ``span`` of its start.

    A group ends where its last interval does, also if an earlier one ends later.  ``order``
    breaks ties of ``start``.  An interval without a bound is a group of its own.

    A parent's rows come to one task in order, as each step depends on the one before; the
    fold holds the open group only, and rows pass through it as they are.
    """
    keys = [parent] if isinstance(parent, str) else list(parent)
    number = T.StructType([*df.schema.fields, T.StructField("group_no", T.LongType())])
    ship(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        owner, at, opened, ended = None, -1, None, None
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*keys, start, end)]
            numbers = []
            for *own, s, e in zip(*columns, strict=True):
                if own != owner:
                    owner, at, opened = own, -1, None
                if s is None or e is None:
                    at, opened = at + 1, None
                else:
                    if opened is None or s - ended > gap or e - opened > span:
                        at, opened = at + 1, s
                    ended = e
                numbers.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], number.fieldNames())

    return df.repartition(*keys).sortWithinPartitions(*keys, start, order, end).mapInArrow(run, number)


def merged_groups(df: DataFrame, parent: str, start: str, end: str, gap: float, span: float, order: str) -> DataFrame:
    """(parent, gs, ge, n, first_id, last_id) of the same groups."""
    slim = df.select(parent, F.col(start).alias("s_"), F.col(end).alias("e_"), F.col(order).alias("o_"))
    place = F.struct("s_", "o_", "e_")
    groups = greedy_groups(slim, parent, "s_", "e_", gap, span, "o_").groupBy(parent, "group_no")
    return groups.agg(F.min("s_").alias("gs"), F.max(place)["e_"].alias("ge"), F.count("*").cast("int").alias("n"), F.min(place)["o_"].alias("first_id"), F.max(place)["o_"].alias("last_id")).drop("group_no")


def merge_captions(captions: DataFrame, gap: int = CAPTION_GAP, span: int = CAPTION_SPAN) -> DataFrame:
    """Merged clips of captions (audio_id, seg, start_cs, end_cs, text, utt_id).

    Clips from 3 to 30 s with text: merged_utt_id, start_sec, end_sec, duration_sec, text,
    merged_from.
    """
    grouped = greedy_groups(captions, "audio_id", "start_cs", "end_cs", gap, span, "seg")
    parts = F.array_sort(F.collect_list(F.struct("start_cs", "seg", "end_cs", "utt_id", "text")))
    rows = grouped.groupBy("audio_id", "group_no").agg(parts.alias("p"))
    first, last = F.get("p", F.lit(0)), F.element_at("p", -1)
    texts = F.filter(F.transform("p", lambda x: F.trim(x["text"])), lambda t: F.coalesce(t, F.lit("")) != "")
    made = rows.select(
        "audio_id",
        F.concat_ws("-", "audio_id", F.lpad(first["seg"].cast("string"), 5, "0"), F.lpad(last["seg"].cast("string"), 5, "0")).alias("merged_utt_id"),
        first["start_cs"].alias("s"),
        last["end_cs"].alias("e"),
        F.array_join(texts, " ").alias("text"),
        F.transform("p", lambda x: x["utt_id"]).alias("merged_from"),
    ).filter((F.col("e") - F.col("s")).between(100 * MIN_CLIP, 100 * MAX_CLIP) & (F.col("text") != ""))
    sec = lambda c: F.round(c / 100.0, 3)
    return made.select("audio_id", "merged_utt_id", sec(F.col("s")).alias("start_sec"), sec(F.col("e")).alias("end_sec"), sec(F.col("e") - F.col("s")).alias("duration_sec"), "text", "merged_from")


def drop_outliers(captions: DataFrame, lengths: DataFrame) -> DataFrame:
    """Captions of positive length, at most 1.1 times their recording's if that is known (audio_id, video_sec)."""
    limit = (F.col("video_sec") * 100 * 1.1).cast("long")
    length = F.col("end_cs") - F.col("start_cs")
    unknown = F.coalesce(F.col("video_sec") <= 0, F.lit(True))
    return captions.join(lengths, "audio_id", "left").filter((length > 0) & (unknown | (length <= limit))).drop("video_sec")


def hard_split(df: DataFrame, start: str = "s", end: str = "e", longest: float = MAX_CLIP, part: str = "part") -> DataFrame:
    """Pieces of at most ``longest``; the last may be shorter, an interval without length has none."""
    pieces = F.ceil((F.col(end) - F.col(start)) / longest).cast("int")
    rest = [c for c in df.columns if c not in (start, end)]
    rows = df.filter(F.col(end) > F.col(start)).select("*", F.explode(F.sequence(F.lit(0), pieces - 1)).alias(part))
    begin = F.col(start) + F.col(part) * longest
    return rows.select(*rest, part, begin.alias(start), F.least(F.col(end), begin + longest).alias(end))


def chunk(segments: DataFrame, parent: str, start: str = "s", end: str = "e", order: str = "seg", gap: float = CHUNK_GAP, longest: float = MAX_CLIP, shortest: float = MIN_CLIP) -> DataFrame:
    """(parent, chunk_index, start, end): split, then merge while gap and span allow, from ``shortest`` on."""
    split = hard_split(segments, start, end, longest)
    ordered = split.withColumn("piece", F.struct(order, "part"))
    groups = merged_groups(ordered, parent, start, end, gap, longest, "piece").filter(F.col("ge") - F.col("gs") >= shortest)
    nth = F.row_number().over(Window.partitionBy(parent).orderBy("gs", "first_id")) - 1
    return groups.select(parent, nth.alias("chunk_index"), F.col("gs").alias(start), F.col("ge").alias(end), "n")


def _reach(parent: Sequence[str], start: str, end: str, order: str) -> Column:
    """The largest end of the intervals before."""
    before = Window.partitionBy(*parent).orderBy(start, end, order).rowsBetween(Window.unboundedPreceding, -1)
    return F.max(end).over(before)


def union_length(df: DataFrame, parent: str, start: str, end: str, order: str) -> DataFrame:
    """(parent, covered): the length of the union of intervals."""
    reach = df.withColumn("reach_", _reach([parent], start, end, order))
    fresh = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce("reach_", start)))
    return reach.groupBy(parent).agg(F.sum(fresh).alias("covered"))


def gaps(df: DataFrame, lengths: DataFrame, parent: str, start: str, end: str, order: str, length: str, shortest: float = MIN_CLIP) -> DataFrame:
    """(parent, gap_start, gap_end) of at least ``shortest`` between intervals, before and after them."""
    last = lengths.select(parent, F.col(length).alias(start), F.col(length).alias(end), F.lit(None).cast(df.schema[order].dataType).alias(order), F.lit(1).alias("last_"))
    rows = df.select(parent, start, end, order, F.lit(0).alias("last_")).unionByName(last)
    before = Window.partitionBy(parent).orderBy("last_", start, end, order).rowsBetween(Window.unboundedPreceding, -1)
    cursor = F.coalesce(F.max(end).over(before), F.lit(0))
    found = rows.select(parent, cursor.alias("gap_start"), F.col(start).alias("gap_end"))
    return found.filter(F.col("gap_end") - F.col("gap_start") >= shortest)


def pad(df: DataFrame, start: str = "s", end: str = "e", length: str = "d", by: float = PAD, shortest: float = MIN_CLIP) -> DataFrame:
    """Intervals widened on both sides within [0, length]; those still under ``shortest`` go."""
    wide = df.withColumns({start: F.greatest(F.lit(0.0), F.col(start) - by), end: F.least(F.col(length), F.col(end) + by)})
    return wide.filter(F.col(end) - F.col(start) >= shortest)


def neighbour_bounds(df: DataFrame, parent: str, start: str, end: str, order: str, by: float) -> DataFrame:
    """``df`` with max_left and max_right: how far an interval may widen before its neighbours.

    A null start sorts as 0; intervals without a start or end get nulls.
    """
    w = Window.partitionBy(parent).orderBy(F.coalesce(F.col(start), F.lit(0)), order)
    first, last = F.lag(F.lit(1)).over(w).isNull(), F.lead(F.lit(1)).over(w).isNull()
    prev_end, next_start = F.lag(end).over(w), F.lead(start).over(w)
    left = F.when(first | prev_end.isNull(), F.col(start)).otherwise(F.greatest(F.lit(0.0), F.col(start) - prev_end))
    right = F.when(last | next_start.isNull(), F.lit(2.0 * by)).otherwise(F.greatest(F.lit(0.0), next_start - F.col(end)))
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    room = lambda gap: F.when(known, F.greatest(F.lit(0.0), F.least(F.lit(by), gap - MARGIN)))
    return df.select("*", room(left).alias("max_left"), room(right).alias("max_right"))


def regions(df: DataFrame, parent: str, at: str, label: str, length: str, order: str, width: float = WINDOW_SEC, keep: Sequence[str] = ()) -> DataFrame:
    """(parent, start, end, label): runs of equal labels of windows at ``at``, over the whole length.

    Two runs meet in the middle between the end of the one window and the start of the next.
    ``keep`` names columns of a run's first window that follow.
    """
    w = Window.partitionBy(parent).orderBy(at, order)
    marked = df.select(*dict.fromkeys((parent, at, label, length, order, *keep)), F.lag(label).over(w).alias("before_"), F.lag(at).over(w).alias("at_before_"), F.lag(F.lit(1)).over(w).isNull().alias("first_"))
    turn = marked.filter(F.col("first_") | ~F.col(label).eqNullSafe(F.col("before_")))
    begin = F.when(F.col("first_"), F.lit(0.0)).otherwise(F.least((F.col("at_before_") + width + F.col(at)) / 2, F.col(length)))
    turn = turn.withColumn("start", begin)
    return turn.select(parent, "start", F.coalesce(F.lead("start").over(w), F.col(length)).alias("end"), label, *keep)


def silence_middles(speech: Column, length: Column) -> Column:
    """Middles of the silences around an array of (start, end), those over ``SILENCE_GAP``."""
    before = lambda i: F.when(i == 0, F.lit(0.0)).otherwise(F.get(speech, i - 1)["end"])
    inner = F.filter(F.transform(speech, lambda x, i: F.when(x["start"] > before(i) + SILENCE_GAP, (before(i) + x["start"]) / 2)), lambda m: m.isNotNull())
    last = F.coalesce(F.try_element_at(speech, F.lit(-1))["end"], F.lit(0.0))
    return F.when(length > last + SILENCE_GAP, F.array_append(inner, (last + length) / 2)).otherwise(inner)


def snap(boundary: Column, middles: Column, radius: float = SNAP_RADIUS) -> Column:
    """The middle nearest to a boundary if it is within ``radius``; of equally near ones the first."""
    near = F.array_sort(F.transform(middles, lambda m, i: F.struct(F.abs(m - boundary).alias("far"), i.alias("i"), m.alias("m"))))
    best = F.get(near, F.lit(0))
    return F.when(best["far"] <= radius, best["m"]).otherwise(boundary)


def first_start(segments: Column, low: Column, high: Column) -> Column:
    """The start of the first segment that starts within [low, high]."""
    return F.get(F.filter(segments, lambda s: s["start"].between(low, high)), F.lit(0))["start"]


def last_end(segments: Column, low: Column, high: Column) -> Column:
    """The end of the last segment that ends within [low, high]."""
    return F.try_element_at(F.filter(segments, lambda s: s["end"].between(low, high)), F.lit(-1))["end"]


def hopping(length: Column, window: int, stride: int) -> Column:
    """Starts of windows every ``stride`` samples, one at least; a last partial stride has none."""
    return F.sequence(F.lit(0), F.greatest(length - window, F.lit(0)), F.lit(stride))


def tumbling(length: Column, window: int, most: int, shortest: int) -> Column:
    """Starts of up to ``most`` windows in a row that hold at least ``shortest`` samples."""
    return F.filter(F.sequence(F.lit(0), F.lit((most - 1) * window), F.lit(window)), lambda s: length - s >= shortest)


def leading_run(labels: Column, target: str) -> Column:
    """How many labels stand before the first ``target``; all if it isn't there."""
    at = F.array_position(F.transform(labels, lambda x: F.coalesce(x == target, F.lit(False))), True)
    return F.when(at > 0, at - 1).otherwise(F.size(labels)).cast("int")


def drop_overlaps(df: DataFrame, parent: str, start: str, end: str, order: str) -> DataFrame:
    """Intervals in order, without those that start before the end of the last one kept."""
    kind = df.select(F.struct(F.col(start).alias("s"), F.col(order).alias("o"), F.col(end).alias("e"))).schema[0].dataType
    ordered = F.array_sort(F.collect_list(F.struct(F.col(start).alias("s"), F.col(order).alias("o"), F.col(end).alias("e"))))
    fits = lambda kept, x: (F.size(kept) == 0) | (x["s"] >= F.try_element_at(kept, F.lit(-1))["e"])
    kept = F.aggregate(ordered, F.array().cast(T.ArrayType(kind)), lambda a, x: F.when(fits(a, x), F.array_append(a, x)).otherwise(a))
    return df.groupBy(parent).agg(kept.alias("kept")).select(parent, F.inline("kept").alias(start, order, end))
