"""WARC archives with a two-level capture index.

Writing: pages go to gzip-per-record WARC files, one or more per task. Pages with equal payloads get one response
(the largest page_id) and revisit records that refer to it. Every record leaves an index line.

Index: lines sorted by the URL key with reversed host ("org,example)/path") are cut into compressed
blocks; a sparse directory keeps the first key, place and length of each block, and a root the first key
of each file of the directory.

Reading: a key is looked up by binary search in the root, then in one file of the directory, by one range read of a
block, and one range read of each record under the key. The directory has one line per ``BLOCK_LINES`` captures, the
root one per task that wrote the index; a task reads the root and the files of the directory that its keys lie in.

Files are written to the shared folder. A repeated task writes files of new names, and only those named by
the index lines of the attempt that succeeded are ever read.

Null html is an empty payload, a null url an empty one; equal page_ids of one payload are all responses. Line breaks
in a url are escaped in archives and results. Rows that repeat a page_id and url are all written and all read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.shared import settle, shuffle_width
from tableferry.session import new_folder

BLOCK_LINES = 1000
FILE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"


def url_key(url: str) -> str:
    """Host labels in reverse order, then the path: ``http://a.b.org:80/x`` is ``org,b,a)/x``."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min([i for i in (rest.find(c) for c in "/?") if i >= 0], default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:]
    host = host.removesuffix(":80").removesuffix(":443").rstrip(".")
    return ",".join(reversed(host.split("."))) + ")" + (path if path.startswith("/") else "/" + path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def one_line(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url: str, payload: bytes, refers_to, refers_url: str | None) -> bytes:
    """One compressed WARC record; a revisit names what it refers to and carries no payload."""
    target = one_line(url)
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {target}')}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Page-Id: {page_id}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Target-URI: {one_line(refers_url or '')}", f"X-Refers-To-Page: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parsed(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, payload length as the server sent it, and payload of a compressed record."""
    data = zlib.decompress(raw, 31)
    end = data.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:])
    body = data[end + 4 : end + 4 + int(head["Content-Length"])]
    cut = body.index(b"\r\n\r\n")
    said = dict(line.split(": ", 1) for line in body[:cut].decode().split("\r\n")[1:])
    return head, int(said["Content-Length"]), body[cut + 4 :]


class _Output:
    """Files of one task in a folder, begun anew when one is full."""

    def __init__(self, folder: str, suffix: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.suffix, self.stream = suffix, None

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.stream.tell() >= FILE_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}{self.suffix}"
            self.stream = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        at = self.stream.tell()
        self.stream.write(data)
        return self.name, at, len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


class _Input:
    """Range reads from files of a folder; a few stay open."""

    def __init__(self, folder: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.open: dict[str, object] = {}

    def read(self, name: str, at: int, size: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.fs.open_input_file(f"{self.root}/{name}")
        return self.open[name].read_at(size, at)


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


_LINES = "url_key string, page_id long, file string, at long, size long"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page; index lines (url_key, page_id, file, at, size), settled."""
    folder = _uri(folder)
    whole = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    groups = whole.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.max_by("url", "page_id").alias("refers_url"), F.count("*").alias("n"))
    marked = whole.join(groups.where("n > 1"), "sha", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("refers_to")), F.col("refers_to")).alias("refers_to"), "refers_url"
    )

    def write(batches):
        out = _Output(folder, ".warc.gz")
        for batch in batches:
            rows = []
            for page, url, html, to, to_url in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "refers_url")), strict=True):
                rows.append((url_key(one_line(url)), page, *out.add(record(page, url, html.encode(), to, to_url))))
            if rows:
                yield _batch(rows)
        out.close()

    return settle(marked.mapInArrow(write, _LINES), "capture-lines")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["url_key", "page_id", "file", "at", "size"])


def write_index(lines: DataFrame, folder: str) -> str:
    """Sort index lines into compressed blocks; returns the folder of their sparse directory and its root."""
    folder = _uri(folder)

    def pack(batches):
        out, held = _Output(folder, ".cdx.z"), []

        def block(part):
            raw = "\n".join(json.dumps(x) for x in part).encode()
            return (part[0][0], part[0][1], *out.add(zlib.compress(raw, 6)))

        for batch in batches:
            held += list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            full, rows = len(held) // BLOCK_LINES, []
            for i in range(full):
                rows.append(block(held[i * BLOCK_LINES : (i + 1) * BLOCK_LINES]))
            held = held[full * BLOCK_LINES :]
            if rows:
                yield _batch(rows)
        if held:
            yield _batch([block(held)])
        out.close()

    lines = lines.withColumn("place", F.coalesce("page_id", F.lit(-(1 << 63))))
    dealt = lines.repartitionByRange(shuffle_width(lines.sparkSession), "url_key", "place").sortWithinPartitions("url_key", "place")
    directory, spark = new_folder(lines.sparkSession, "capture-directory"), lines.sparkSession
    dealt.select("url_key", "page_id", "file", "at", "size").mapInArrow(pack, _LINES).write.parquet(f"{directory}/lines")
    written = spark.read.schema(_LINES).parquet(f"{directory}/lines").select("url_key", "page_id", F.regexp_extract(F.input_file_name(), "[^/]+$", 0).alias("file"))
    first = F.min(F.struct("url_key", F.coalesce("page_id", F.lit(-(1 << 63))).alias("place"))).alias("first")
    written.groupBy("file").agg(first).select("first.*", "file").coalesce(1).write.parquet(f"{directory}/root")
    return directory


class Directory:
    """Two sorted levels: first keys of the directory's files, and of the blocks that a file names."""

    HELD = 16

    def __init__(self, folder: str):
        self.fs, self.root = pafs.FileSystem.from_uri(_uri(folder))
        rows = [r for f in self._files("root") for r in pq.read_table(f, filesystem=self.fs, partitioning=None).to_pylist()]
        rows.sort(key=lambda r: (r["url_key"], r["place"]))
        self.keys, self.names = [(r["url_key"], r["place"]) for r in rows], [r["file"] for r in rows]
        self.held: dict[str, tuple[list, list]] = {}

    def _files(self, level: str) -> list[str]:
        return [f.path for f in self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{level}")) if f.path.endswith(".parquet")]

    def lines(self, name: str) -> tuple[list, list]:
        """Keys and lines of one file of the directory; the last few read are kept."""
        if name not in self.held:
            if len(self.held) >= self.HELD:
                self.held.pop(next(iter(self.held)))
            rows = pq.read_table(f"{self.root}/lines/{name}", filesystem=self.fs, partitioning=None).to_pylist()
            rows.sort(key=lambda r: (r["url_key"], _place(r["page_id"])))
            self.held[name] = [(r["url_key"], _place(r["page_id"])) for r in rows], rows
        return self.held[name]

    def blocks_of(self, key: str, page_id):
        """The blocks that can hold a capture, in order: one, unless rows that repeat it run on into others."""
        asked = key, _place(page_id)
        for name in self.names[slice(*_around(self.keys, asked))]:
            keys, rows = self.lines(name)
            yield from rows[slice(*_around(keys, asked))]


def _around(keys: list, asked) -> tuple[int, int]:
    """Bounds of the runs, told by their sorted first keys, that can hold a key."""
    return max(0, bisect.bisect_left(keys, asked) - 1), bisect.bisect_right(keys, asked)


def _place(page_id) -> int:
    return -(1 << 63) if page_id is None else page_id


_FOUND = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


_SENT_ROWS, _SENT_BYTES = 1000, 16 << 20


def lookup(captures: DataFrame, directory: str, index: str, archives: str, with_payload: bool = False) -> DataFrame:
    """The records of captures (page_id, url): what the archives hold, found by way of the index.

    Rows that ask for one capture again are one. A capture gives all records under its page_id and url, or else those
    under its page_id and a url of the same key; one that is not there gives no row. Payloads of responses are checked against their digest.
    """
    directory, index, archives = _uri(directory), _uri(index), _uri(archives)
    line = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    wanted = captures.select("page_id", line.alias("url")).distinct()
    # About the order of the index, so that a task needs few of its files; what is found does not depend on it.
    labels = F.split(F.lower(F.substring_index(F.substring_index("url", "://", -1), "/", 1)), r"\.")
    order = wanted.withColumn("k", F.array_join(F.reverse(labels), ","))
    dealt = order.repartitionByRange(shuffle_width(captures.sparkSession), "k", "url", "page_id").sortWithinPartitions("k", "url", "page_id").select("page_id", "url")

    def find(batches):
        levels, blocks, files = None, _Input(index), _Input(archives)
        at, lines = None, {}
        out, size_out = [], 0

        def sent():
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        def places(key, page):
            nonlocal at, lines
            for row in levels.blocks_of(key, page):
                if row is not at:
                    at, lines = row, {}
                    for text in zlib.decompress(blocks.read(row["file"], row["at"], row["size"])).decode().split("\n"):
                        k, p, *place = json.loads(text)
                        lines.setdefault((k, p), []).append(place)
                yield from lines.get((key, page), ())

        for batch in batches:
            levels = levels or Directory(directory)
            for page, url in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), strict=True):
                key = url_key(url)
                # Urls of one key may differ; those that are the one asked for come before the others.
                for same in (True, False):
                    some = False
                    for place in places(key, page):
                        head, size, payload = parsed(files.read(*place))
                        if same and head["WARC-Target-URI"] != url:
                            continue
                        some = True
                        said = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if head["WARC-Type"] == "response" and digest(payload) != said:
                            raise ValueError(f"page {page}: the payload read is not the one written")
                        to = head.get("X-Refers-To-Page")
                        out.append((page, url, size, said, head["WARC-Type"], int(to) if to else None, payload if with_payload else None))
                        size_out += len(payload) if with_payload else 0
                        if len(out) >= _SENT_ROWS or size_out >= _SENT_BYTES:
                            yield sent()
                            out, size_out = [], 0
                    if some:
                        break
        if out:
            yield sent()

    return dealt.mapInArrow(find, _FOUND)


def archive_round_trip(spark: SparkSession, pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write archives and index of ``pages`` to the shared folder and read every capture back."""
    archives, index = new_folder(spark, "archives"), new_folder(spark, "capture-index")
    directory = write_index(write_archives(pages, archives), index)
    return lookup(pages, directory, index, archives, with_payload)
