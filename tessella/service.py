"""The browser's HTTP interface over a catalog of tables: a WSGI application, for any WSGI server.

Pages, facets and totals are Spark queries of ``operators.browse``; only a page of rows, or
a facet, comes to the driver.  Audio is read from under one root, by byte ranges, through
Hadoop's file system, so any store will do.
"""

from __future__ import annotations

import json
import mimetypes
import re
from collections.abc import Callable, Iterable, Iterator
from datetime import date, datetime
from decimal import Decimal
from urllib.parse import parse_qs, unquote

from pyspark.sql import functions as F

from .operators import browse
from .operators.manifest import relative, within_root
from .sources import readers
from .sources.writers import at

READ_BYTES = 1 << 18
HIDDEN = re.compile(r"(filter_min|filter_max|filter_eq)\[(.+)\]")
STATUS = {200: "OK", 206: "Partial Content", 400: "Bad Request", 403: "Forbidden", 404: "Not Found", 405: "Method Not Allowed", 416: "Range Not Satisfiable"}


class Refused(Exception):
    def __init__(self, status: int, why: str, headers: Iterable[tuple[str, str]] = ()):
        super().__init__(why)
        self.status, self.headers = status, list(headers)


def plain(value: object) -> object:
    """What JSON has no form for, as text; numbers that aren't finite as nothing."""
    if isinstance(value, float) and (value != value or value in (float("inf"), float("-inf"))):
        return None
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (bytes, bytearray)):
        return f"<{len(value)} bytes>"
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def byte_range(header: str | None, size: int) -> tuple[int, int] | None:
    """(first, last) byte of a single range; None for the whole; a range beyond the end is refused."""
    found = re.fullmatch(r"bytes=(\d*)-(\d*)", (header or "").strip())
    if not found or found[1] == found[2] == "":
        return None
    if found[1] == "":
        first, last = max(0, size - int(found[2])), size - 1
    else:
        first, last = int(found[1]), min(int(found[2]) if found[2] else size - 1, size - 1)
    if first > last or first >= size:
        raise Refused(416, "range", [("Content-Range", f"bytes */{size}")])
    return first, last


class App:
    """``catalog`` names the tables that may be browsed, ``root`` is where audio lies."""

    def __init__(self, catalog: browse.Catalog, root: str):
        self.catalog, self.root, self.spark = catalog, root.rstrip("/"), catalog.spark
        self.routes: list[tuple[str, Callable]] = [
            (r"/", self.index), (r"/api/parquets", self.parquets), (r"/api/load", self.load), (r"/api/schema", self.schema), (r"/api/stats", self.stats), (r"/api/sources", self.sources),
            (r"/api/lid_values", self.lid_values), (r"/api/rows", self.rows), (r"/api/row/(.+)", self.row), (r"/audio/(.*)", self.audio), (r"/audio_parquet", self.audio_parquet),
        ]

    def __call__(self, environ: dict, start_response: Callable) -> Iterable[bytes]:
        try:
            if environ.get("REQUEST_METHOD", "GET") not in ("GET", "HEAD"):
                raise Refused(405, "only GET")
            path = unquote(environ.get("PATH_INFO", "/")) or "/"
            for pattern, handler in self.routes:
                if found := re.fullmatch(pattern, path, re.DOTALL):
                    status, headers, body = handler(parse_qs(environ.get("QUERY_STRING", ""), keep_blank_values=True), environ, *found.groups())
                    break
            else:
                raise Refused(404, "no such page")
        except Refused as e:
            status, headers, body = self.json({"error": str(e)}, e.status, e.headers)
        except browse.RequestError as e:
            status, headers, body = self.json({"error": str(e)}, 400)
        start_response(f"{status} {STATUS[status]}", headers)
        return [] if environ.get("REQUEST_METHOD") == "HEAD" else body

    @staticmethod
    def json(value: object, status: int = 200, headers: Iterable[tuple[str, str]] = ()) -> tuple:
        body = json.dumps(plain(value), ensure_ascii=False).encode()
        return status, [("Content-Type", "application/json"), ("Content-Length", str(len(body))), *headers], [body]

    def table(self, asked: dict):
        """The table a request names, else the active one."""
        name = (asked.get("parquet") or [self.catalog.active])[0]
        if name is None:
            raise Refused(400, "no table is loaded")
        if name not in self.catalog.tables:
            raise Refused(404, f"no table {name!r}")
        return name, self.catalog.open(name)

    def index(self, asked: dict, environ: dict) -> tuple:
        body = PAGE.encode()
        return 200, [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))], [body]

    def parquets(self, asked: dict, environ: dict) -> tuple:
        return self.json({"parquets": self.catalog.listing(), "active": self.catalog.active})

    def load(self, asked: dict, environ: dict) -> tuple:
        if "parquet" not in asked:
            raise Refused(400, "parquet is missing")
        name, df = self.table(asked)
        return self.json({"active": name, "schema": browse.describe(df)})

    def schema(self, asked: dict, environ: dict) -> tuple:
        name, df = self.table(asked)
        return self.json({"parquet": name, "columns": browse.describe(df), "default_columns": list(browse.DEFAULT_COLUMNS)})

    def stats(self, asked: dict, environ: dict) -> tuple:
        name, df = self.table(asked)
        out = {"parquet_name": name, "parquet_path": self.catalog.tables[name]}
        if "duration_sec" not in df.columns:
            return self.json({**out, "total_rows": df.count()})
        found = browse.stats(df).first()
        return self.json({**out, "total_rows": found["rows"], "total_hours": found["hours"]})

    def facet(self, asked: dict, column: str, by_count: bool, name: str) -> tuple:
        df = self.table(asked)[1]
        found = browse.facet(df, column, by_count).collect() if column in df.columns else []
        return self.json([{name: r["value"], "n": r["count"]} for r in found])

    def sources(self, asked: dict, environ: dict) -> tuple:
        return self.facet(asked, "source", False, "source")

    def lid_values(self, asked: dict, environ: dict) -> tuple:
        return self.facet(asked, "qf_lid", True, "value")

    def request(self, asked: dict) -> browse.RowsRequest:
        one = lambda n, other="": (asked.get(n) or [other])[0]
        number = lambda n, other: int(one(n)) if re.fullmatch(r"-?\d{1,9}", one(n)) else other
        bounds: dict[str, dict[str, str]] = {"filter_min": {}, "filter_max": {}, "filter_eq": {}}
        for key, values in asked.items():
            if (found := HIDDEN.fullmatch(key)) and values[0] != "":
                bounds[found[1]][found[2]] = values[0]
        listed = lambda n: [x.strip() for v in asked.get(n, []) for x in v.split(",") if x.strip()]
        return browse.RowsRequest(
            columns=listed("columns"), sources=listed("source"), search=one("search") or one("q"), minimum=bounds["filter_min"], maximum=bounds["filter_max"], equal=bounds["filter_eq"],
            sort=one("sort") or browse.KEY, direction=one("dir", "asc"), page=number("page", 1), page_size=number("page_size", 0),
        )

    def rows(self, asked: dict, environ: dict) -> tuple:
        df, request = self.table(asked)[1], self.request(asked)
        page, total = browse.rows(df, request)
        for name, helper in (("audio_path", "_relative_audio_path"), ("refined_audio_path", "_relative_refined_audio_path")):
            if name in page.columns:
                path = F.col(f"`{name}`")
                page = page.withColumn(helper, F.when(path.startswith(self.root + "/"), relative(path, self.root)))
        number, size = browse.page_bounds(request.page, request.page_size)
        return self.json({
            "total": total.first()["total"], "page": number, "page_size": size, "sort": browse.sort_column(df, request.sort), "dir": "desc" if request.direction.lower() == "desc" else "asc",
            "columns": [c for c in page.columns if not c.startswith("_relative")], "rows": [r.asDict() for r in page.collect()],
        })

    def row(self, asked: dict, environ: dict, key: str) -> tuple:
        found = browse.row(self.table(asked)[1], key).collect()
        if not found:
            raise Refused(404, "no such row")
        return self.json(found[0])

    def _inside(self, path: str) -> str:
        """The place of a path below the root, by the rule that tables are filtered by."""
        found = self.spark.range(1).select(within_root(F.lit(path), self.root).alias("p")).first()["p"]
        if found is None:
            raise Refused(403, "outside the root")
        return f"{self.root}/{found}"

    def audio(self, asked: dict, environ: dict, rest: str) -> tuple:
        path = self._inside(rest.lstrip("/"))
        fs, jvm_path = at(self.spark, path)
        if not fs.exists(jvm_path) or not fs.getFileStatus(jvm_path).isFile():
            raise Refused(404, "no such file")
        size = fs.getFileStatus(jvm_path).getLen()
        found = byte_range(environ.get("HTTP_RANGE"), size)
        first, last = found or (0, size - 1)
        headers = [("Content-Type", mimetypes.guess_type(path)[0] or "application/octet-stream"), ("Accept-Ranges", "bytes"), ("Content-Length", str(last - first + 1))]
        if found:
            headers.append(("Content-Range", f"bytes {first}-{last}/{size}"))
        return 206 if found else 200, headers, self._bytes(fs, jvm_path, first, last - first + 1)

    def _bytes(self, fs, jvm_path, first: int, length: int) -> Iterator[bytes]:
        """A stretch of a file, a piece at a time."""
        stream = fs.open(jvm_path)
        try:
            stream.seek(first)
            reader = self.spark._jvm.org.apache.commons.io.IOUtils
            while length > 0:
                piece = bytes(reader.toByteArray(self.spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, min(READ_BYTES, length))))
                if not piece:
                    return
                length -= len(piece)
                yield piece
        finally:
            stream.close()

    def audio_parquet(self, asked: dict, environ: dict) -> tuple:
        """The audio bytes inside a shard, by the row's place."""
        if "path" not in asked or "row_index" not in asked:
            raise Refused(400, "path and row_index are needed")
        try:
            index = int(float(asked["row_index"][0]))
        except (ValueError, OverflowError):
            raise Refused(400, "row_index isn't a number") from None
        path = self._inside(asked["path"][0])
        if not readers.exists(self.spark, path):
            raise Refused(404, "no such file")
        shard = readers.parquet_rows(self.spark, path, ["audio.bytes"]).filter(F.col("row_index") == index).collect()
        if not shard or shard[0]["bytes"] is None:
            raise Refused(404, f"no audio at row {index}")
        body = bytes(shard[0]["bytes"])
        return 200, [("Content-Type", "audio/wav"), ("Content-Length", str(len(body)))], [body]


#: A small front end: the state is in the address, so a view can be kept and passed on.
PAGE = """<!doctype html><meta charset="utf-8"><title>Browse</title>
<style>body{font:14px sans-serif;margin:1em}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:2px 6px;max-width:30em;overflow:hidden;text-overflow:ellipsis;white-space:nowrap}th{cursor:pointer;resize:horizontal;overflow:auto}</style>
<form id="ask"><select name="parquet"></select> <input name="search" placeholder="text"> <input name="source" placeholder="sources"> <input name="columns" size="60" placeholder="columns" list="names"> <input name="filters" size="30" placeholder="column&gt;=1 column&lt;=2 column=x"> <button>Show</button><datalist id="names"></datalist></form>
<p><span id="told"></span> <button id="back">&lt;</button> <button id="on">&gt;</button></p><table id="rows"></table><audio id="play" controls></audio>
<script>
const $ = id => document.getElementById(id), form = $("ask"), get = (path, asked) => fetch(path + "?" + asked).then(r => r.json());
const state = () => new URLSearchParams(location.hash.slice(1));
const go = change => { const s = state(); for (const [k, v] of Object.entries(change)) v === "" ? s.delete(k) : s.set(k, v); location.hash = s; };
function query() {
  const asked = new URLSearchParams(state());
  for (const f of (asked.get("filters") || "").split(/\\s+/)) { const m = f.match(/^(.+?)(>=|<=|=)(.+)$/); if (m) asked.set({">=": "filter_min", "<=": "filter_max", "=": "filter_eq"}[m[2]] + "[" + m[1] + "]", m[3]); }
  asked.delete("filters");
  return asked;
}
async function show() {
  const s = state();
  for (const e of form.elements) if (e.name) e.value = s.get(e.name) || e.value;
  const found = await get("/api/rows", query()), table = $("rows");
  if (found.error) { $("told").textContent = found.error; return; }
  $("told").textContent = found.total + " rows, page " + found.page;
  table.replaceChildren();
  const head = table.insertRow();
  for (const c of found.columns) { const th = document.createElement("th"); th.textContent = c; th.onclick = () => go({sort: c, dir: s.get("sort") === c && s.get("dir") !== "desc" ? "desc" : "asc", page: 1}); head.append(th); }
  for (const row of found.rows) { const tr = table.insertRow(); for (const c of found.columns) tr.insertCell().textContent = typeof row[c] === "object" && row[c] ? JSON.stringify(row[c]) : row[c] ?? ""; const p = row._relative_refined_audio_path || row._relative_audio_path; if (p) tr.onclick = () => { $("play").src = "/audio/" + p; $("play").play(); }; }
}
form.onsubmit = e => { e.preventDefault(); const change = {page: 1}; for (const x of form.elements) if (x.name) change[x.name] = x.value; go(change); };
$("back").onclick = () => go({page: Math.max(1, (+state().get("page") || 1) - 1)});
$("on").onclick = () => go({page: (+state().get("page") || 1) + 1});
addEventListener("hashchange", show);
get("/api/parquets", "").then(async p => {
  for (const t of p.parquets) form.elements.parquet.append(new Option(t.name, t.name));
  if (!state().get("parquet") && p.parquets.length) go({parquet: p.active || p.parquets[0].name});
  const names = await get("/api/schema", state());
  for (const c of names.columns || []) for (const n of [c.name, ...c.subfields.map(f => c.name + "." + f.name)]) $("names").append(new Option(n));
  show();
});
</script>"""


def serve(app: App, host: str = "127.0.0.1", port: int = 8000) -> None:
    """With the library's own server, one request at a time."""
    from wsgiref.simple_server import make_server

    make_server(host, port, app).serve_forever()
