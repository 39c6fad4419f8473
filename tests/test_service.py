import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import quote

import pytest

from tessella import service
from tessella.functions import media
from tessella.operators import browse
from tessella.sources import acquire, writers

KIND = "utterance_id string, source string, duration_sec double, audio_path string, transcripts struct<source_caption:string>, quality_flags struct<rms_dbfs:double>, qf_lid string"


@pytest.fixture(scope="module")
def app(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("root")
    (root / "a b").mkdir()
    (root / "a b" / "x.wav").write_bytes(bytes(range(256)) * 3000)
    (root.parent / "secret.wav").write_bytes(b"no")
    rows = [(f"u{i:03}", f"s{i % 3}", float(i), f"{root}/a b/x.wav" if i % 2 else "/else/y.wav", (f"text {i}",), (float(-i),), "hu" if i % 4 else None) for i in range(120)]
    spark.createDataFrame(rows, KIND).write.parquet(f"{root}/set.parquet")
    spark.createDataFrame([((b"RIFF%d" % i,),) if i != 2 else (None,) for i in range(5)], "audio struct<bytes:binary>").coalesce(1).write.parquet(f"{root}/shard")
    spark.createDataFrame([(1,)], "n int").write.parquet(f"{root}/plain.parquet")
    return service.App(browse.Catalog(spark, {"set": f"{root}/set.parquet", "plain": f"{root}/plain.parquet"}), str(root))


def call(app, path, query="", method="GET", **headers):
    told = {}
    body = b"".join(app({"REQUEST_METHOD": method, "PATH_INFO": quote(path), "QUERY_STRING": query, **headers}, lambda status, found: told.update(status=int(status[:3]), headers=dict(found))))
    return told["status"], told["headers"], json.loads(body) if told["headers"].get("Content-Type") == "application/json" and body else body


def test_tables(app):
    assert call(app, "/api/schema")[0] == 400 or app.catalog.active
    assert call(app, "/api/load", "parquet=set")[2]["active"] == "set"
    assert [t["name"] for t in call(app, "/api/parquets")[2]["parquets"]] == ["plain", "set"] and call(app, "/api/parquets")[2]["active"] == "set"
    found = call(app, "/api/schema", "parquet=set")[2]
    assert found["columns"][4] == {"name": "transcripts", "type": "struct<source_caption:string>", "subfields": [{"name": "source_caption", "type": "string"}]} and "utterance_id" in found["default_columns"]
    assert call(app, "/api/load", "parquet=/etc/passwd")[0] == 404 and call(app, "/api/load")[0] == 400 and call(app, "/nothing")[0] == 404 and call(app, "/api/rows", method="POST")[0] == 405
    stats = call(app, "/api/stats", "parquet=set")[2]
    assert stats["total_rows"] == 120 and stats["total_hours"] == round(sum(range(120)) / 3600, 2)
    assert call(app, "/api/stats", "parquet=plain")[2]["total_rows"] == 1 and call(app, "/api/sources", "parquet=plain")[2] == []
    assert call(app, "/api/sources", "parquet=set")[2] == [{"source": f"s{i}", "n": 40} for i in range(3)] and call(app, "/api/lid_values", "parquet=set")[2] == [{"value": "hu", "n": 90}]
    assert b"<!doctype html>" in call(app, "/")[2]


def test_rows(app):
    asked = "parquet=set&columns=duration_sec,quality_flags.rms_dbfs,none&source=s1&source=s2&filter_min[duration_sec]=10&filter_max[quality_flags.rms_dbfs]=-20&sort=duration_sec&dir=desc&page=2&page_size=7"
    found = call(app, "/api/rows", asked)[2]
    expected = [i for i in range(119, -1, -1) if i % 3 and i >= 20]
    assert found["total"] == len(expected) and [r["duration_sec"] for r in found["rows"]] == expected[7:14] and (found["page"], found["page_size"], found["dir"]) == (2, 7, "desc")
    assert {"utterance_id", "duration_sec", "quality_flags.rms_dbfs"} <= set(found["columns"]) and "none" not in found["columns"]
    assert all(r["_relative_audio_path"] == ("a b/x.wav" if r["duration_sec"] % 2 else None) for r in found["rows"])
    assert call(app, "/api/rows", "parquet=set&q=text+11&sort=transcripts")[2]["sort"] == "utterance_id"
    assert call(app, "/api/row/u007", "parquet=set")[2]["transcripts"] == {"source_caption": "text 7"} and call(app, "/api/row/none", "parquet=set")[0] == 404


def test_audio(app):
    whole = bytes(range(256)) * 3000
    status, headers, body = call(app, "/audio/a b/x.wav")
    assert status == 200 and body == whole and headers["Content-Length"] == str(len(whole)) and headers["Content-Type"] in ("audio/wav", "audio/x-wav")
    for asked, first, last in (("bytes=5-9", 5, 9), ("bytes=767990-", 767_990, 767_999), ("bytes=-3", 767_997, 767_999), ("bytes=10-99999999", 10, 767_999)):
        status, headers, body = call(app, "/audio/a b/x.wav", HTTP_RANGE=asked)
        assert status == 206 and body == whole[first : last + 1] and headers["Content-Range"] == f"bytes {first}-{last}/768000"
    assert call(app, "/audio/a b/x.wav", HTTP_RANGE="bytes=768000-")[0] == 416 and call(app, "/audio/a b/x.wav", HTTP_RANGE="rows=1-2")[0] == 200
    assert call(app, "/audio/../secret.wav")[0] == 403 and call(app, "/audio/none.wav")[0] == 404 and call(app, "/audio/a b")[0] == 404
    shard = f"path={app.root}/shard&row_index="
    assert call(app, "/audio_parquet", shard + "3")[2] == b"RIFF3"
    assert [call(app, "/audio_parquet", q)[0] for q in (shard + "2", shard + "9", shard + "x", "row_index=1", "path=/etc&row_index=1")] == [404, 404, 400, 400, 403]


# Acquisition


class Handler(BaseHTTPRequestHandler):
    data, breaks, seen = bytes(range(256)) * 1000, [], []

    def do_GET(self):
        self.seen.append((self.path, self.headers.get("Range")))
        if self.path == "/missing":
            return self.send_error(404)
        first = int(self.headers["Range"][6:-1]) if self.headers.get("Range") and self.path != "/plain" else 0
        if first >= len(self.data):
            return self.send_error(416)
        self.send_response(206 if first else 200)
        self.send_header("Content-Length", str(len(self.data) - first))
        self.end_headers()
        stop = self.breaks.pop() if self.breaks else len(self.data)
        self.wfile.write(self.data[first:stop])

    def log_message(self, *args):
        pass


@pytest.fixture()
def server():
    found = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=found.serve_forever, daemon=True).start()
    Handler.seen.clear()
    yield f"http://127.0.0.1:{found.server_port}"
    found.shutdown()


def test_fetch_resumes(server, tmp_path):
    path, progress = str(tmp_path / "f"), str(tmp_path / "progress.json")
    Handler.breaks[:] = [200_000, 100_000]
    assert acquire.fetch(f"{server}/f", path, progress, pause=0) == 256_000 and open(path, "rb").read() == Handler.data
    assert [r for _, r in Handler.seen] == [None, "bytes=100000-", "bytes=200000-"]
    assert acquire.progress_of(progress) == {f"{server}/f": {"bytes": 256_000, "total": 256_000, "done": True}}
    assert acquire.fetch(f"{server}/f", path) == 256_000 and len(Handler.seen) == 3
    (tmp_path / "g.part").write_bytes(Handler.data)  # whole already
    (tmp_path / "h.part").write_bytes(b"old")
    assert acquire.fetch(f"{server}/g", str(tmp_path / "g")) == 256_000 and acquire.fetch(f"{server}/plain", str(tmp_path / "h")) == 256_000
    with pytest.raises(OSError):
        acquire.fetch(f"{server}/missing", str(tmp_path / "m"), progress)
    assert "404" in acquire.progress_of(progress)[f"{server}/missing"]["error"] and not (tmp_path / "m").exists()
    (tmp_path / "broken").write_text("{")
    assert acquire.progress_of(str(tmp_path / "broken")) == {}


def test_fetch_all(spark, server, tmp_path):
    wanted = spark.createDataFrame([(f"{server}/a", "a"), (f"{server}/missing", "b"), (f"{server}/c", "../c")], "url string, name string")
    found = {r["name"]: r for r in acquire.fetch_all(wanted, str(tmp_path / "all")).collect()}
    assert found["a"]["bytes"] == found["../c"]["bytes"] == 256_000 and found["b"]["bytes"] is None and "404" in found["b"]["error"] and (tmp_path / "all" / "c").exists()


def test_staging(spark, tmp_path):
    rows = [("s/1", str(tmp_path / "a.wav"), "egy"), ("s/2", str(tmp_path / "b.ogg"), None)]
    df = spark.createDataFrame(rows, "utterance_id string, audio_path string, text string")
    for _ in range(2):
        assert writers.stage(df, str(tmp_path / "staged")) == 2
    lines = [json.loads(x) for x in (tmp_path / "staged" / "ground_truth.jsonl").read_text().splitlines()]
    assert lines == [{"utterance_id": "s/1", "file": "s_1.wav", "text": "egy"}, {"utterance_id": "s/2", "file": "s_2.ogg", "text": ""}] and (tmp_path / "staged" / "s_2.ogg").readlink() == tmp_path / "b.ogg"
    with pytest.raises(FileExistsError):
        writers.stage(df.union(spark.createDataFrame([("s_1", "/x.wav", "")], df.schema)), str(tmp_path / "staged"))
    assert len(list((tmp_path / "staged").iterdir())) == 3 and len([p for p in tmp_path.iterdir() if "tmp" in p.name]) == 0


# Headers


def chunk(name, data):
    return name + len(data).to_bytes(4, "little") + data


def page(granule, packet):
    return b"OggS\0\2" + granule.to_bytes(8, "little", signed=True) + b"\0" * 12 + bytes([1, len(packet)]) + packet


def mp3_frame(bits=9, rate=0, version=3, mono=False):
    kb = media.KILOBITS[1 if version == 3 else 2][bits]
    hertz = media.MP3_RATES[rate] // {3: 1, 2: 2}[version]
    size = (1152 if version == 3 else 576) // 8 * kb * 1000 // hertz
    return bytes([0xFF, 0xE2 | version << 3 | 1, bits << 4 | rate << 2, 0xC0 if mono else 0]) + b"\0" * (size - 4)


def test_headers():
    fmt = chunk(b"fmt ", b"\1\0" + (2).to_bytes(2, "little") + (8000).to_bytes(4, "little") + (32_000).to_bytes(4, "little") + b"\4\0\x10\0")
    wav = chunk(b"RIFF", b"WAVE" + chunk(b"LIST", b"odd\0") + fmt + chunk(b"data", b"\0" * 16_000))
    flac = b"fLaC\x80\0\0\x22" + b"\0" * 10 + (44_100 << 44 | 1 << 41 | 15 << 36 | 88_200).to_bytes(8, "big") + b"\0" * 16
    vorbis = page(0, b"\1vorbis\0\0\0\0" + b"\2" + (22_050).to_bytes(4, "little") + b"\0" * 14) + page(44_100, b"x")
    opus = page(0, b"OpusHead\1\1" + (312).to_bytes(2, "little") + b"\0" * 7) + page(48_312, b"x")
    first = bytearray(mp3_frame())
    first[36:48] = b"Xing\0\0\0\1" + (100).to_bytes(4, "big")
    mp4 = b"\0\0\0\x10ftypM4A \0\0\0\0" + b"....mvhd" + b"\0" * 12 + (1000).to_bytes(4, "big") + (2500).to_bytes(4, "big") + b"....mp4a" + b"\0" * 16 + (2).to_bytes(2, "big") + b"\0" * 6 + (48_000).to_bytes(2, "big") + b"\0\0"
    told = lambda data: (lambda f: f and (f["codec"], f["sample_rate"], f["channels"], round(f["duration_sec"], 6)))(media.probe(data))
    assert told(wav) == ("pcm_s16le", 8000, 2, 0.5) and told(flac) == ("flac", 44_100, 2, 2.0)
    assert told(vorbis) == ("vorbis", 22_050, 2, 2.0) and told(opus) == ("opus", 48_000, 1, 1.0)
    assert told(b"ID3\4\0\0\0\0\0\5hello" + mp3_frame() * 10) == ("mp3", 44_100, 2, round(11_520 / 44_100, 6))
    assert told(bytes(first) + mp3_frame() * 2) == ("mp3", 44_100, 2, round(115_200 / 44_100, 6)) and told(mp3_frame(5, 1, 2, True) * 3) == ("mp3", 24_000, 1, round(1728 / 24_000, 6))
    assert told(mp4) == ("aac", 48_000, 2, 2.5)
    assert [media.probe(x) for x in (b"", b"RIFF", b"fLaC", b"OggS" * 20, b"\xff\xfb\x90", b"text" * 50, wav[:30])] == [None] * 7


def test_decoders(monkeypatch):
    monkeypatch.setitem(media.DECODERS, "flac", lambda data, rate: [float(rate)])
    flac = b"fLaC\x80\0\0\x22" + b"\0" * 10 + (44_100 << 44 | 100).to_bytes(8, "big") + b"\0" * 16
    assert media.decode(flac, 16_000) == [16_000.0] and media.decode(b"x", 1) is None
