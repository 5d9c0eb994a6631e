"""Web archives as a Python data source: one input partition a file.

The URL filters run on Column expressions behind the reader.  Record and HTTP
content types are tested in it, so other records are skipped without decoding.
"""

from __future__ import annotations

import glob
import gzip
import io
import logging
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator, Mapping
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from trawl.scratch import exists
from trawl.sources import PAGE, per_source

LATEST = "CC-MAIN-2016-44"
COLUMNS = ("url", "headers", "doc_type", "body", "source_path", "pos")
KINDS = (pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary(), pa.string(), pa.int64())


class DamagedArchive(ValueError):
    """Bytes that are no archive."""


def _headers(handle) -> dict[str, str]:
    out: dict[str, str] = {}
    while line := handle.readline().rstrip(b"\r\n"):
        name, _, value = line.partition(b":")
        out[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def records(handle) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; a cut file ends with its last whole record.

    Damaged data raises DamagedArchive behind the records before it.  Errors of the
    storage are neither: they go through, so that the task runs again.
    """
    try:
        while line := handle.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise DamagedArchive(f"a record begins with {line[:20]!r}")
            headers = _headers(handle)
            size = headers.get("content-length", "0")
            if not size.isdigit():
                raise DamagedArchive(f"a record is {size!r} bytes long")
            block = handle.read(int(size))
            if len(block) < int(size):
                return
            yield headers, block
    except EOFError:
        return
    except (gzip.BadGzipFile, zlib.error) as error:
        raise DamagedArchive(str(error)) from error


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            n = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return body
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n
    return b"".join(out)


def responses(handle) -> Iterator[tuple[str, dict[str, str], bytes]]:
    """(url, HTTP headers, body) of the HTML responses."""
    for headers, block in records(handle):
        url = headers.get("warc-target-uri", "").strip("<>")
        if not url or headers.get("content-type", "").replace(" ", "") != "application/http;msgtype=response":
            continue
        inner = io.BytesIO(block)
        inner.readline()
        http = _headers(inner)
        if "text/html" not in http.get("content-type", ""):
            continue
        body = inner.read()
        if "chunked" in http.get("transfer-encoding", "").lower():
            body = unchunked(body)
        if "gzip" in http.get("content-encoding", "").lower():
            try:
                body = gzip.decompress(body)
            except (OSError, EOFError):
                continue
        yield url, http, body


class ArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str], maxdocs: int | None, skip_damaged: bool):
        self.paths, self.maxdocs, self.skip_damaged = paths, maxdocs, skip_damaged

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        path = partition.value
        store, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))
        rows, size, n = [], 0, 0
        with store.open_input_stream(name, compression=None) as raw:
            handle = io.BufferedReader(raw, 1 << 20) if path.endswith(".warc") else gzip.GzipFile(fileobj=raw)
            found = responses(handle)
            while self.maxdocs is None or n < self.maxdocs:
                try:
                    url, http, body = next(found)
                except StopIteration:
                    break
                except DamagedArchive as error:
                    if not self.skip_damaged:
                        raise DamagedArchive(f"{path}, behind {n} pages: {error}") from error
                    logging.getLogger("trawl").warning("%s is damaged behind %d pages: %s", path, n, error)
                    break
                rows.append((url, list(http.items()), "html", body, path, n))
                size += len(body)
                n += 1
                if size > 8_000_000:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), KINDS)], COLUMNS)


class ArchiveSource(DataSource):
    """format("trawl-warc"); options: paths (one a line), maxdocs (a file, pushed into the reader), skip_damaged (what is whole in a damaged file is read)."""

    @classmethod
    def name(cls) -> str:
        return "trawl-warc"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> DataSourceReader:
        most = self.options.get("maxdocs")
        return ArchiveReader(self.options["paths"].split("\n"), None if most is None else int(most), str(self.options.get("skip_damaged")).lower() in ("1", "true"))


def web_archive(spark: SparkSession, path: str | None = None, paths: Iterable[str] | None = None, list: str | None = None, maxdocs: int | str | None = None, webarchive: str | None = None, skip_damaged: int | str = 0) -> DataFrame:
    """`path` (a glob, on any store), `paths`, or `list`, a text file of paths."""
    if list is not None:
        found = [r.value.strip() for r in spark.read.text(list).collect() if r.value.strip()]
    elif paths is not None:
        found = [*paths]
    else:
        found = matching(path or webarchive)
    return _read(spark, found, maxdocs, skip_damaged)


def matching(pattern: str) -> list[str]:
    """The files of a glob, in order; the pattern itself where it matches none."""
    if "://" not in pattern:
        return sorted(glob.glob(pattern)) or [pattern]
    from pyarrow import fs

    if not any(x in pattern for x in "*?["):
        return [pattern]
    head = pattern[: min(pattern.index(x) for x in "*?[" if x in pattern)].rpartition("/")[0]
    store, root = fs.FileSystem.from_uri(head)
    prefix = head.removesuffix(root)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    wanted = re.compile(re.escape(pattern).replace(r"\*", "[^/]*").replace(r"\?", "[^/]"))
    return sorted(prefix + x.path for x in found if x.is_file and wanted.fullmatch(prefix + x.path)) or [pattern]


def _read(spark: SparkSession, paths: list[str], maxdocs: int | str | None, skip_damaged: int | str = 0) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("trawl-warc").option("paths", "\n".join(paths)).option("skip_damaged", str(skip_damaged))
    return (reader if maxdocs is None else reader.option("maxdocs", int(maxdocs))).load()


def crawl_archive(spark: SparkSession, manifest: str | None = None, limit: int | str | None = None, skip: int | str = 0, version: str = "latest", maxdocs: int | str | None = None, root: str = ".") -> DataFrame:
    """Files skip .. skip + limit of a crawl's manifest (S3).

    The manifest is a text file of archive paths, packed or plain; those are looked for
    below `root`.  Without one, `version` names `<root>/<version>.paths`, or the listing
    `<root>/crawl-data/<version>/warc.paths.gz` that crawls are published with.
    """
    name = manifest or _listing(spark, root, LATEST if version == "latest" else version)
    found = [r.value.strip() for r in spark.read.text(name).collect() if r.value.strip()]
    end = None if limit is None else int(skip) + int(limit)
    chosen = [p if "://" in p or os.path.isabs(p) else f"{root}/{p}" for p in found[int(skip) : end]]
    if not chosen:
        return spark.createDataFrame([], PAGE)
    return _read(spark, chosen, maxdocs)


def _listing(spark: SparkSession, root: str, version: str) -> str:
    published = f"{root}/crawl-data/{version}/warc.paths.gz"
    return published if exists(spark, published) else f"{root}/{version}.paths"


def write_archive(documents: Iterable[Mapping], path: str, compress: bool | None = None) -> str:
    """An archive of documents with url, content and optional headers (K9)."""
    gz = not path.endswith(".warc") if compress is None else compress
    with open(path, "wb") as out:
        for doc in documents:
            content = doc["content"] if isinstance(doc["content"], bytes) else doc["content"].encode()
            http = {"Content-Type": "text/html"} | dict(doc.get("headers") or {})
            block = ("HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http.items()) + "\r\n").encode() + content
            head = (
                f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {doc['url']}\r\nWARC-Date: {datetime.now(UTC):%Y-%m-%dT%H:%M:%SZ}\r\n"
                f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
            ).encode()
            record = head + block + b"\r\n\r\n"
            out.write(gzip.compress(record) if gz else record)
    return path
