import glob
import random
import time

import pytest
import zstandard

from tessella.llm import warc
from tests.llm.helpers import none_of


def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>{'x' * (i % 7)}é</p>") for i in range(40)] + [(100, None, None), (101, "a\r\nb", ""), (102, "u", None), (None, "n", "<p>é</p>"), (3, "again", "<p>xxxé</p>"), (7, "other html", "<p>new</p>"), (200, "long", "<b>" + "word " * 300_000)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def awkward_ids(spark):
    """String ids with line breaks, spaces, percent signs and the names of what isn't there."""
    ids = ["a\r\nX: y", "", " ", "None", None, "a%0D", "<b>", "é\u2028", "5", "urn:nopage:"]
    return spark.createDataFrame([(i, f"http://h/{n}", html) for n, i in enumerate(ids) for html in (f"p{n}", "same")], "page_id string, url string, html string")


@pytest.mark.parametrize("least,whole,make", [(0, 1 << 26, pages), (9, 1 << 26, pages), (0, 100, pages), (0, 1 << 26, awkward_ids)])
def test_round_trip(spark, monkeypatch, least, whole, make):
    monkeypatch.setattr(warc, "WHOLE_BYTES", whole)
    df = make(spark)
    first = {}
    for r in df.collect():
        payload = (r["html"] or "").encode()
        if r["page_id"] is not None and len(payload) >= least:
            first[payload] = min(first.get(payload, r["page_id"]), r["page_id"])
    expected = []
    for r in df.collect():
        payload = (r["html"] or "").encode()
        refers = first.get(payload)
        again = r["page_id"] is not None and refers is not None and r["page_id"] > refers
        expected.append((r["page_id"], len(payload), warc.digest(payload), "revisit" if again else "response", refers if again else None))
    found = [tuple(r) for r in warc.round_trip(df, least_bytes=least).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_payloads_come_back(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark), path)
    rows = warc.read(spark, path).filter("record_type = 'response'").collect()
    assert any(len(r["payload"]) == 1_500_003 for r in rows) and all(warc.digest(bytes(r["payload"])) == r["payload_digest"] for r in rows)
    data = b"".join(open(p, "rb").read()[:4] for p in glob.glob(path + "/part-*"))
    assert data[:4] == warc.DICTIONARY_MAGIC.to_bytes(4, "little")


def test_large_archives_in_chunks(spark, tmp_path, monkeypatch):
    """Archives over several splits, of more than a chunk, and one that ends with a separator."""
    monkeypatch.setattr(warc, "WHOLE_BYTES", 1000)
    rng = random.Random(3)
    for n in range(3):
        own = [(i, "u", rng.randbytes(5000), None) for i in range(n * 1000, n * 1000 + 500)]
        tail = warc.frame(0x184D2A50, b"PP") if n == 1 else b""
        (tmp_path / f"{n}.warc{'.zst' * (n == 2)}").write_bytes(archive(*own) + tail)
    monkeypatch.setattr("tessella.llm.bytefiles.CHUNK", 70_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600000")
    try:
        found = warc.read(spark, str(tmp_path), payloads=False, glob="*.warc*").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(int(r["page_id"]) for r in found) == [n * 1000 + i for n in range(3) for i in range(500)]


def test_reader_is_linear():
    """Eight times the records take about eight times the work: what a decoder leaves is bounded."""
    copied = []

    def work(n):
        data = archive(*[(i, "u", b"%d " % i * 300, None) for i in range(n)])
        began = time.process_time()
        assert sum(1 for _ in warc.frames([data])) == n
        copied.append(time.process_time() - began)

    work(100)
    work(1000)
    work(8000)
    assert copied[2] < 24 * max(copied[1], 0.01)


def test_dictionary_is_trained():
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 99)) for _ in range(60)).encode(), None) for i in range(300)]
    data = archive(*rows)
    assert data[8:12] == (0xEC30A437).to_bytes(4, "little") and len(list(warc.frames([data]))) == 300


def test_empty_table(spark):
    assert warc.round_trip(none_of(pages(spark))).isEmpty()


def archive(*records):
    return b"".join(warc.archive_frames(records))


def test_reader_takes_what_the_format_allows():
    records = [(1, "u", b"x" * 1000, None), (2, "u", b"y" * 50, None), (3, "u", b"x" * 1000, 1)]
    data = archive(*records)
    assert [warc.parse(r)["page_id"] for r in warc.frames([data])] == ["1", "2", "3"]
    assert list(warc.frames([data + warc.frame(0x184D2A50, b"anything")])) == list(warc.frames([data]))
    plain = zstandard.ZstdCompressor().compress(warc.record(9, "u", b"z"))
    assert [warc.parse(r)["payload"] for r in warc.frames([plain])] == [b"z"]
    size = int.from_bytes(data[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    assert list(warc.frames(data[i : i + 7] for i in range(0, len(data), 7))) == list(warc.frames([data]))
    assert list(warc.frames([warc.frame(warc.DICTIONARY_MAGIC, packed) + data[8 + size :]])) == list(warc.frames([data]))


def test_reader_refuses_damage():
    data = archive((1, "u", b"payload", None))
    size = 8 + int.from_bytes(data[4:8], "little")
    for bad in (data[:-3], data + b"xx", data[size:], data + data, data[:size] + b"\0" * 20):
        with pytest.raises(warc.WarcError):
            list(warc.frames([bad]))
    good = warc.record(1, "u", b"payload")
    for old, new in ((b"payload\r\n", b"PAYLOAD\r\n"), (b"WARC/1.1", b"WARC/9"), (b"WARC-Date", b"X-Date"), (b"\r\n\r\n", b"\r\n", ), (b"payload", b"pay")):
        with pytest.raises(warc.WarcError):
            warc.parse(good.replace(old, new, 1) if old != b"\r\n\r\n" else good.replace(old, new))
