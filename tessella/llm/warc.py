"""WARC archives of pages, compressed record by record with a shared dictionary.

An archive is a Zstandard file as the WARC profile for it has it: a leading skippable
frame (magic 0x184D2A5D) with the dictionary, then one frame per record.  Archives are
written by Spark's own text writer, so they go to any store Spark writes to, under its
commit protocol: each row is a frame's bytes, and the line separator is itself an empty
skippable frame, which every reader of the format passes over.  Reading takes the
dictionary from the leading frame, decodes frame by frame from a stream of bounded
slices, and checks every record's header, lengths and digests.

Of pages with equal payloads the one with the smallest id is written as a response and
the others as revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import ship
from .bytefiles import lines, runs
from .common import col, cut, new_path, remove, text_of

# Fixed values of the formats.
ZSTD_MAGIC = 0xFD2FB528
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
#: An empty skippable frame: magic 0x184D2A50 and length 0; all ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEVEL = 3
#: The dictionary is trained on the first records of an archive, up to this many bytes.
DICTIONARY_BYTES, SAMPLE_BYTES = 32 << 10, 1 << 20
#: Segment and match length of the training, which are then not searched for.
SEGMENT, MATCH = 200, 8
#: Bytes given to a decoder at once; what it leaves of them is copied for each record.
SLICE = 32 << 10
#: Archives up to this size are read as one value, larger ones in chunks that are put in order.
WHOLE_BYTES = 64 << 20
#: Compressed bytes are evenly spread, so any byte recurs.
CHUNK_SEPARATOR = b"P"
DATE = "1970-01-01T00:00:00Z"
RECORD_ID = "urn:page:"
#: Records of pages without an id are named by their payload.
NO_ID = "urn:nopage:"


class WarcError(ValueError):
    """An archive that doesn't follow the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def frame(kind: int, content: bytes) -> bytes:
    """A skippable frame."""
    return kind.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


def record(page_id: object, url: str, payload: bytes, refers_to: object = None) -> bytes:
    """A WARC record: a response, or a revisit of ``refers_to`` without the payload."""
    named = lambda i: RECORD_ID + quote(str(i), safe="") if i is not None else NO_ID + digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{named(page_id)}>"),
        ("WARC-Date", DATE),
        # A line break or control character in a URL would end the field.
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{named(refers_to)}>")] if refers_to is not None else []),
    ]
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in fields)])
    return head + END + block + END


def parse(raw: bytes) -> dict:
    """A record's fields, checked: version, lengths, digests, and the end."""
    head, found, rest = raw.partition(END)
    lines = head.split(b"\r\n")
    if not found or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError("a frame doesn't hold a WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"not a header line: {line[:80]!r}")
        fields[name.strip().lower().decode()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"no {name}")
    if not re.fullmatch(r"\d+", fields["content-length"]) or len(rest) != int(fields["content-length"]) + len(END) or not rest.endswith(END):
        raise WarcError(f"{fields['warc-record-id']}: content-length {fields['content-length']} but {len(rest) - len(END)} bytes follow")
    block = rest[: -len(END)]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise WarcError(f"{fields['warc-record-id']}: the block's digest differs")
    http, _, payload = block.partition(END)
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    if fields["warc-type"] == "response":
        if not stated or int(stated[1]) != len(payload):
            raise WarcError(f"{fields['warc-record-id']}: the payload's length differs")
        if fields.get("warc-payload-digest", "sha1:").removeprefix("sha1:") != digest(payload):
            raise WarcError(f"{fields['warc-record-id']}: the payload's digest differs")
    elif fields["warc-type"] == "revisit" and "warc-refers-to" not in fields:
        raise WarcError(f"{fields['warc-record-id']}: a revisit without warc-refers-to")
    named = lambda x: None if x[1:].startswith(NO_ID) else unquote(x.strip("<>").removeprefix(RECORD_ID))
    return {
        "page_id": named(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri", ""),
        "payload": payload if fields["warc-type"] == "response" else None,
        "payload_bytes": int(stated[1]) if stated else len(payload),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "record_type": fields["warc-type"],
        "refers_to": named(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
    }


def frames(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The records of an archive, decoded, one by one, from its bytes in any chunks."""
    import zstandard as z

    slices = (view[i : i + SLICE] for view in map(memoryview, chunks) for i in range(0, len(view), SLICE))
    held, at, decoder = b"", 0, z.ZstdDecompressor()

    def fill(n: int) -> bool:
        """Whether ``n`` bytes are held, after reading on if need be."""
        nonlocal held
        parts, size = [held], len(held)
        while size < n and (more := next(slices, None)) is not None:
            parts.append(more)
            size += len(more)
        held = b"".join(parts)
        return size >= n

    while fill(1):
        if not fill(8):
            raise WarcError(f"{len(held)} bytes after the last frame")
        magic = int.from_bytes(held[:4], "little")
        if magic in SKIPPABLE_MAGICS:
            end = 8 + int.from_bytes(held[4:8], "little")
            if not fill(end):
                raise WarcError("a skippable frame is cut off")
            if magic == DICTIONARY_MAGIC:
                if at:
                    raise WarcError("a dictionary that doesn't lead the archive")
                content = held[8:end]
                if content[:4] == ZSTD_MAGIC.to_bytes(4, "little"):  # it may be compressed itself
                    content = z.ZstdDecompressor().decompressobj().decompress(content)
                decoder = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(content))
            held = held[end:]
            at += end
        elif magic == ZSTD_MAGIC:
            one, parts, fed = decoder.decompressobj(), [], 0
            try:
                while held or fill(1):
                    parts.append(one.decompress(held))
                    fed += len(held)
                    held = one.unused_data if one.eof else b""
                    if one.eof:
                        break
            except z.ZstdError as e:
                raise WarcError(f"a frame at {at} can't be decoded: {e}") from e
            if not one.eof:
                raise WarcError("a frame is cut off")
            yield b"".join(parts)
            at += fed - len(held)
        else:
            raise WarcError(f"no frame begins at {at}")


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on ``records``; of too few to train on, their own bytes."""
    import zstandard as z

    try:
        return z.train_dictionary(DICTIONARY_BYTES, records, k=SEGMENT, d=MATCH, level=LEVEL).as_bytes()
    except z.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


def archive_frames(records: Iterable[tuple], level: int = LEVEL) -> Iterator[bytes]:
    """The frames of an archive of (page_id, url, payload, refers_to): dictionary, then records."""
    import itertools

    import zstandard as z

    source, first, held = iter(records), [], 0
    for r in source:
        first.append(r)
        held += len(r[2])
        if held >= SAMPLE_BYTES:
            break
    if not first:
        return
    content = dictionary([record(*r)[: 2 * DICTIONARY_BYTES] for r in first])
    yield frame(DICTIONARY_MAGIC, content)
    shared = z.ZstdCompressionDict(content)
    shared.precompute_compress(level=level)
    encoder = z.ZstdCompressor(level=level, dict_data=shared, write_checksum=True, write_content_size=True)
    for r in itertools.chain(first, source):
        yield encoder.compress(record(*r))


def revisits(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(page_id, sha1, refers_to) of the pages whose payload of at least ``least_bytes`` another, with a smaller id, has."""
    html = text_of(html_col)
    known = cut(pages.select(col(id_col).alias("page_id"), F.sha1(F.encode(html, "UTF-8")).alias("sha1"), F.octet_length(html).alias("bytes")).filter(F.col("page_id").isNotNull() & (F.col("bytes") >= least_bytes)))
    first = known.groupBy("sha1", "bytes").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).filter("refers_to < last").drop("last")
    return known.join(cut(first), ["sha1", "bytes"]).filter("page_id > refers_to").select("page_id", "sha1", "refers_to").distinct()


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> None:
    """Write a record for each page to archives under ``path``, one archive a task.

    Null html is an empty payload and a null url an empty one.  Pages that share the
    smallest id of a payload are all responses; pages without an id are responses.
    """
    ship(pages.sparkSession)
    other = cut(revisits(pages, id_col=id_col, html_col=html_col, least_bytes=least_bytes).select(*[F.col(c).cast("string").alias(n) for c, n in (("page_id", "again_id"), ("sha1", "again_sha1"), ("refers_to", "refers_to"))]))
    rows = pages.select(col(id_col).cast("string").alias("own_id"), text_of(url_col).alias("url"), text_of(html_col).alias("html"))
    same = (F.col("own_id") == F.col("again_id")) & (F.sha1(F.encode("html", "UTF-8")) == F.col("again_sha1"))
    rows = rows.join(other, same, "left").select("own_id", "url", "html", "refers_to")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def records() -> Iterator[tuple]:
            for batch in batches:
                for own, url, html, refers in zip(*batch.columns, strict=True):
                    yield own.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass"), refers.as_py()

        held, size = [], 0
        for part in archive_frames(records()):
            held.append(part)
            size += len(part)
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])

    bytes_as_text = rows.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    bytes_as_text.write.option("lineSep", SEPARATOR).option("compression", "none").text(path)


def read(spark: SparkSession, path: str, *, payloads: bool = True, glob: str = "part-*") -> DataFrame:
    """All records of the archives under ``path``; a damaged archive fails the read.

    page_id (string, null for pages without one), url, payload (of responses),
    payload_bytes, payload_digest, record_type, refers_to (string).  An archive is decoded
    by one task, as a stream; of archives over ``WHOLE_BYTES`` the chunks are first put in
    order, so none has to fit in memory.  Only names that make Spark's text reader
    decompress (.zst) are always one value, of 2 GB at most.
    """
    ship(spark)
    kinds = {"page_id": "string", "url": "string", "payload": "binary", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "string"}
    if not payloads:
        del kinds["payload"]
    arrow = {"string": "string", "long": "int64", "binary": "binary"}
    schema = ", ".join(f"{k} {v}" for k, v in kinds.items())

    def decode(archive: Iterable[bytes]) -> Iterator:
        import pyarrow as pa

        types = [pa.type_for_alias(arrow[k]) for k in kinds.values()]

        def batch_of(found: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], t) for n, t in zip(kinds, types, strict=True)], list(kinds))

        held, size = [], 0
        for raw in frames(archive):
            held.append(parse(raw))
            size += len(raw)
            if size > 1 << 22:
                yield batch_of(held)
                held, size = [], 0
        yield batch_of(held)

    def whole(batches: Iterator) -> Iterator:
        for batch in batches:
            for content in batch.column(0):
                yield from decode([content.as_buffer()])

    def chunk(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for run in runs(batches, CHUNK_SEPARATOR):
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in run], ["file", "block", "nth", "bytes", "size"])

    def ordered(batches: Iterator) -> Iterator:
        import itertools

        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(3), batch.column(4).to_pylist(), strict=True))
        for _, own in itertools.groupby(rows, lambda row: row[0]):

            def archive(own=own) -> Iterator[bytes]:
                at = 0
                for _, part, size in own:
                    yield part.as_py()[: size - at]
                    at += len(part.as_py())

            yield from decode(archive())

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    named = lambda c: F.col(c).rlike(r"\.(zst|deflate)$")
    at_once = (F.col("length") <= WHOLE_BYTES) | named("path")
    found = files.filter(at_once).select("content").mapInArrow(whole, schema)
    others = [r["path"] for r in files.filter(~at_once).select("path").toLocalIterator()]  # over WHOLE_BYTES each
    if not others:
        return found
    large = lines(spark, others, CHUNK_SEPARATOR, "*")
    chunks = large.mapInArrow(chunk, "file string, block long, nth long, bytes binary, size long")
    in_order = chunks.repartition("file").sortWithinPartitions("file", "block", "nth")
    return found.union(in_order.mapInArrow(ordered, schema))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, without payloads.

    Ids of any type that casts to a string and back come back as they were.  An empty
    table gives no archives' records, so no rows.  Columns other than id, url and html are
    not read.  The archives are deleted once they are read.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write(pages, path, **options)
    kind = pages.select(col(options.get("id_col", "page_id"))).schema[0].dataType
    typed = lambda c: F.col(c).try_cast(kind).alias(c)
    found = cut(read(spark, path, payloads=False).select(typed("page_id"), "payload_bytes", "payload_digest", "record_type", typed("refers_to")))
    remove(spark, path)
    return found
