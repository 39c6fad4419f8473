"""Browsing a manifest: projections, filters, sorting and paging bound to what columns exist.

A request names columns as strings; they are resolved against the schema, and what the
table lacks is left out.  The result is a plan, so filters and projections reach the scan
and a page is a top-k.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_COLUMNS = ("utterance_id", "source", "duration_sec", "audio_path", "transcripts.source_caption")
#: Always fetched, as playing a row needs them.
HELPER_COLUMNS = ("audio_path", "refined_audio_path", "source", "parquet_row_index")
KEY = "utterance_id"
PAGE_SIZE, MAX_PAGE_SIZE = 50, 200


class RequestError(ValueError):
    """A request that can't be bound."""


@dataclass(frozen=True)
class RowsRequest:
    """What a page of rows is asked by; values are as they come from a query string."""

    columns: Sequence[str] = ()
    sources: Sequence[str] = ()
    search: str = ""
    minimum: Mapping[str, object] = field(default_factory=dict)
    maximum: Mapping[str, object] = field(default_factory=dict)
    equal: Mapping[str, object] = field(default_factory=dict)
    sort: str = KEY
    direction: str = "asc"
    page: int = 1
    page_size: int = PAGE_SIZE


def describe(df: DataFrame) -> list[dict]:
    """Columns with their types and one level of struct fields."""
    inner = lambda t: [{"name": f.name, "type": f.dataType.simpleString()} for f in t.fields] if isinstance(t, T.StructType) else []
    return [{"name": f.name, "type": f.dataType.simpleString(), "subfields": inner(f.dataType)} for f in df.schema.fields]


def kind_of(df: DataFrame, path: str) -> T.DataType | None:
    """The type at ``column`` or ``column.field``; None if there is none."""
    name, _, sub = path.partition(".")
    if name not in df.columns:
        return None
    kind = df.schema[name].dataType
    if not sub:
        return kind
    return kind[sub].dataType if isinstance(kind, T.StructType) and sub in kind.fieldNames() else None


def resolve(df: DataFrame, path: str) -> Column | None:
    if kind_of(df, path) is None:
        return None
    return F.col(".".join(f"`{p}`" for p in path.split(".", 1)))


def projection(df: DataFrame, columns: Sequence[str] = (), key: str = KEY) -> list[Column]:
    """The asked or default columns that exist, with helpers and the key; dotted names stay whole."""
    names = dict.fromkeys([*(columns or DEFAULT_COLUMNS), *HELPER_COLUMNS, key])
    found = [(n, c) for n in names if (c := resolve(df, n)) is not None]
    if not found:
        raise RequestError("none of the columns exist")
    return [c.alias(n) for n, c in found]


def _number(name: str, value: object) -> float:
    try:
        return float(value)
    except (TypeError, ValueError):
        raise RequestError(f"{name}: {value!r} isn't a number") from None


def _equals(column: Column, kind: T.DataType, value: object) -> Column:
    """Equality with text: true and false as booleans, else cast to the column's type; what can't be cast matches nothing."""
    text = str(value)
    if text.lower() in ("true", "false") and isinstance(kind, T.BooleanType):
        return column == F.lit(text.lower() == "true")
    return column == F.lit(text).try_cast(kind)


def search(df: DataFrame, text: str, key: str = KEY, within: str = "transcripts") -> Column:
    """Whether the id or any text holds ``text`` in any case; % and _ are wildcards."""
    kind = kind_of(df, within)
    paths = [key, *([f"{within}.{f}" for f in kind.fieldNames()] if isinstance(kind, T.StructType) else [within])]
    found = [c for p in paths if (c := resolve(df, p)) is not None]
    return any_of(F.coalesce(c.ilike(f"%{text}%"), F.lit(False)) for c in found)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.or_, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions, F.lit(True))


def where(df: DataFrame, request: RowsRequest, key: str = KEY) -> Column:
    """All of a request's conditions; those on columns that don't exist are left out."""
    conditions = []
    if request.sources and "source" in df.columns:
        conditions.append(F.col("source").isin(*request.sources))
    if request.search.strip():
        conditions.append(search(df, request.search.strip(), key))
    for bounds, compare in ((request.minimum, operator.ge), (request.maximum, operator.le)):
        conditions += [compare(c, F.lit(_number(n, v))) for n, v in bounds.items() if (c := resolve(df, n)) is not None]
    conditions += [_equals(c, kind_of(df, n), v) for n, v in request.equal.items() if (c := resolve(df, n)) is not None]
    return all_of(conditions)


def sort_column(df: DataFrame, name: str, key: str = KEY) -> str:
    """``name`` if rows can be sorted by it, else the key, else the first column."""
    kind = kind_of(df, name)
    if kind is not None and not isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return name
    return key if key in df.columns else df.columns[0]


def page_bounds(page: int, size: int) -> tuple[int, int]:
    """(page, size) within their limits; a size of 0 is the default."""
    return max(1, int(page)), max(1, min(MAX_PAGE_SIZE, int(size) or PAGE_SIZE))


def rows(df: DataFrame, request: RowsRequest, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(the page, a one-row table with the total); nulls sort last, the key breaks ties."""
    found = df.filter(where(df, request, key))
    by = resolve(df, sort_column(df, request.sort, key))
    order = [by.desc_nulls_last() if str(request.direction).lower() == "desc" else by.asc_nulls_last()]
    if key in df.columns:
        order.append(F.col(key).asc_nulls_last())
    page, size = page_bounds(request.page, request.page_size)
    # Sorted before it is projected, as the sort column may not be asked for.
    shown = found.orderBy(*order).offset((page - 1) * size).limit(size).select(*projection(df, request.columns, key))
    return shown, found.agg(F.count("*").alias("total"))


def row(df: DataFrame, value: object, key: str = KEY) -> DataFrame:
    return df.filter(F.col(key) == value).limit(1)


# The flat table's fixed filters

# The columns that it has, lists, sorts and searches by, and its ranges.
RANGES = {
    "duration": "duration_sec", "dnsmos": "qf_dnsmos_ovrl", "vad": "qf_vad_speech_ratio", "lid_hu": "qf_lid_is_hu_prob", "qc_wer": "qc_pairwise_wer",
}
SORTABLE = (
    "utterance_id", "source", "duration_sec", "has_text", "qf_dnsmos_ovrl", "qf_vad_speech_ratio", "qf_lid", "qf_lid_is_hu_prob", "qf_silence_ratio",
    "qf_is_clipped", "qc_pairwise_wer", "qc_exact_match",
)
LISTED = (
    "utterance_id", "source", "duration_sec", "has_text", "text_preview", "qf_dnsmos_ovrl", "qf_vad_speech_ratio", "qf_lid", "qf_lid_is_hu_prob", "qf_is_clipped",
    "relative_audio_path", "audio_path", "refined_audio_path", "qc_pairwise_wer", "qc_exact_match", "text_qwen_ft_greedy", "text_canary_v2_greedy",
)
SEARCHED = ("utterance_id", "text_source_caption", "text_whisper_large_v3_pseudo")


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of an allow-list that the table has."""
    return [n for n in names if n in df.columns]


def tri_state(column: Column, choice: str | None, unknown_is_no: bool = False) -> Column:
    """yes, no, or anything; whether no takes in nulls differs by flag."""
    if choice == "yes":
        return column
    if choice == "no":
        return ~F.coalesce(column, F.lit(False)) if unknown_is_no else ~column
    return F.lit(True)


def lid_is(column: Column, choice: str | None, target: str = "hu") -> Column:
    options = {target: column == target, f"non_{target}": column.isNotNull() & (column != target), "unknown": column.isNull()}
    return options.get(choice, F.lit(True))


def foreign(prefix: Column, whole: Column, choice: str | None) -> Column:
    """Leading foreign speech, wholly foreign clips, either, or neither (nulls count as neither)."""
    no_prefix, not_whole = F.coalesce(prefix == 0, F.lit(True)), ~F.coalesce(whole, F.lit(False))
    options = {"with_prefix": prefix > 0, "whole_non_hu": whole, "any_foreign": (prefix > 0) | whole, "clean_hu": no_prefix & not_whole}
    return options.get(choice, F.lit(True))


def flat_where(df: DataFrame, args: Mapping[str, object]) -> Column:
    """The flat table's conditions from query arguments; those on missing columns are left out."""
    has = lambda c: c in df.columns
    conditions = []
    if args.get("source"):
        wanted = args["source"]
        conditions.append(F.col("source").isin(*([wanted] if isinstance(wanted, str) else wanted)))
    for name, column in RANGES.items():
        if has(column):
            for side, compare in (("min", operator.ge), ("max", operator.le)):
                if args.get(f"{name}_{side}") is not None:
                    conditions.append(compare(F.col(column), F.lit(_number(f"{name}_{side}", args[f"{name}_{side}"]))))
    for argument, column, unknown_is_no in (
        ("has_text", "has_text", False), ("qc_exact", "qc_exact_match", True), ("is_clipped", "qf_is_clipped", False), ("halluc", "qf_any_hallucination_flag", True),
    ):
        if has(column):
            conditions.append(tri_state(F.col(column), args.get(argument), unknown_is_no))
    if has("qf_lid"):
        conditions.append(lid_is(F.col("qf_lid"), args.get("lid")))
    if has("qf_foreign_prefix_sec"):
        if has("qf_whole_non_hu"):
            conditions.append(foreign(F.col("qf_foreign_prefix_sec"), F.col("qf_whole_non_hu"), args.get("foreign")))
        if args.get("foreign_prefix_min") is not None:
            conditions.append(F.col("qf_foreign_prefix_sec") >= _number("foreign_prefix_min", args["foreign_prefix_min"]))
    text = str(args.get("q") or "").strip()
    if text:
        conditions.append(any_of(F.coalesce(F.col(c).ilike(f"%{text}%"), F.lit(False)) for c in present(df, SEARCHED)))
    return all_of(conditions)


def flat_rows(df: DataFrame, args: Mapping[str, object]) -> tuple[DataFrame, DataFrame]:
    """A page of the flat table's list columns, and the total."""
    found = df.filter(flat_where(df, args))
    sort = args.get("sort") if args.get("sort") in present(df, SORTABLE) else KEY
    by = F.col(sort).desc_nulls_last() if args.get("dir") == "desc" else F.col(sort).asc_nulls_last()
    page, size = page_bounds(int(args.get("page", 1)), int(args.get("page_size", PAGE_SIZE)))
    shown = found.orderBy(by, F.col(KEY).asc_nulls_last()).offset((page - 1) * size).limit(size)
    return shown.select(*present(df, LISTED)), found.agg(F.count("*").alias("total"))


def score_class(value: Column, good: float, warn: float, lower_is_better: bool = False) -> Column:
    """good, warn or bad by two thresholds; na for null."""
    better = (lambda t: value <= t) if lower_is_better else (lambda t: value >= t)
    return F.when(value.isNull(), "na").when(better(good), "good").when(better(warn), "warn").otherwise("bad")


def stats(df: DataFrame, duration: str = "duration_sec") -> DataFrame:
    """(rows, hours), hours rounded to hundredths."""
    return df.agg(F.count("*").alias("rows"), F.round(F.coalesce(F.sum(duration), F.lit(0.0)) / 3600.0, 2).alias("hours"))


def facet(df: DataFrame, column: str, by_count: bool = False) -> DataFrame:
    """(value, count) of a column: all by value, or those not null by count."""
    rows_ = df.filter(F.col(column).isNotNull()) if by_count else df
    counts = rows_.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "value") if by_count else counts.orderBy("value")


class Catalog:
    """Named tables that may be browsed; anything else is refused."""

    def __init__(self, spark, tables: Mapping[str, str]):
        self.spark, self.tables, self.active, self._open = spark, dict(tables), None, {}

    def listing(self) -> list[dict]:
        return [{"name": n, "path": p} for n, p in sorted(self.tables.items())]

    def open(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise RequestError(f"no table {name!r}")
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(self.tables[name])
            self._open[name].createOrReplaceTempView("manifest")
        self.active = name
        return self._open[name]

    def schema(self) -> list[dict]:
        return describe(self.open(self.active))

    def stats(self) -> DataFrame:
        return stats(self.open(self.active))

    def sources(self) -> DataFrame:
        return facet(self.open(self.active), "source")

    def lids(self) -> DataFrame:
        return facet(self.open(self.active), "qf_lid", by_count=True)

    def rows(self, request: RowsRequest) -> tuple[DataFrame, DataFrame]:
        return rows(self.open(self.active), request)

    def row(self, value: object) -> DataFrame:
        return row(self.open(self.active), value)
