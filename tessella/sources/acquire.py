"""Fetching files over HTTP: resumed by byte ranges, with a progress file, many at once on the cluster.

A file is fetched to ``<name>.part`` and renamed when it is whole.  What is there already
is kept: a finished file isn't fetched again, a part is continued where it ends.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator
from urllib.error import HTTPError, URLError
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship

CHUNK = 1 << 20
TRIES = 3
TIMEOUT = 60


def progress_of(path: str) -> dict:
    """What a progress file says: url to {bytes, total, done, error}; nothing if there is none or it is broken."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        return found if isinstance(found, dict) else {}
    except (FileNotFoundError, ValueError):
        return {}


def note(path: str, url: str, **entry) -> None:
    """Set one URL's entry; the file is replaced as a whole."""
    whole = progress_of(path) | {url: entry}
    staged = f"{path}.tmp-{os.getpid()}"
    with open(staged, "w", encoding="utf-8") as f:
        json.dump(whole, f, indent=2)
    os.replace(staged, path)


def fetch(url: str, path: str, progress: str | None = None, tries: int = TRIES, pause: float = 1.0) -> int:
    """Fetch ``url`` to ``path`` and return its size; a fetch that stops is resumed, some times.

    A server that ignores the range sends the whole, which then replaces the part.
    """
    if os.path.exists(path):
        return os.path.getsize(path)
    part, told = f"{path}.part", (lambda **e: note(progress, url, **e)) if progress else (lambda **e: None)
    for left in range(tries - 1, -1, -1):
        have = os.path.getsize(part) if os.path.exists(part) else 0
        try:
            with urlopen(Request(url, headers={"Range": f"bytes={have}-"} if have else {}), timeout=TIMEOUT) as answer:
                resumed = answer.status == 206
                length = answer.headers.get("Content-Length")
                total = int(length) + (have if resumed else 0) if length else None
                with open(part, "ab" if resumed else "wb") as out:
                    while data := answer.read(CHUNK):
                        out.write(data)
                        told(bytes=out.tell(), total=total, done=False)
            size = os.path.getsize(part)
            if total is not None and size != total:
                raise URLError(f"{size} of {total} bytes")
        except HTTPError as e:
            if e.code != 416 or not have:  # else the part was whole already
                told(bytes=have, total=None, done=False, error=str(e))
                if not left or e.code < 500:
                    raise
                time.sleep(pause)
                continue
        except (URLError, OSError) as e:
            told(bytes=os.path.getsize(part) if os.path.exists(part) else 0, total=None, done=False, error=str(e))
            if not left:
                raise
            time.sleep(pause)
            continue
        os.replace(part, path)
        told(bytes=os.path.getsize(path), total=os.path.getsize(path), done=True)
        return os.path.getsize(path)
    raise AssertionError


def fetch_all(wanted: DataFrame, folder: str) -> DataFrame:
    """(url, name, bytes, error) of ``wanted`` (url, name): each fetched by some task to ``folder``, which all machines share.

    A failure is a row, not a failed job.  Deal rows out by ``repartition`` for as many
    fetches at once.
    """
    ship(wanted.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            sizes, errors = [], []
            for url, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    sizes.append(fetch(url, os.path.join(folder, os.path.basename(name))))
                    errors.append(None)
                except (URLError, OSError, ValueError) as e:
                    sizes.append(None)
                    errors.append(str(e)[:200])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(errors, pa.string())], ["url", "name", "bytes", "error"])

    return wanted.select("url", F.col("name")).mapInArrow(run, "url string, name string, bytes long, error string")
