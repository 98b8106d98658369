"""WARC archives and their index, merged from sorted runs.

1. Payloads are digested; Spark finds the largest page_id of each digest that occurs more
   than once, and keeps these in shared files.
2. Each task writes the records of its pages to one archive, gzip member by member, and the
   places of the records, sorted by URL key and timestamp, as a run of the index.
3. The runs are merged: the key space is cut into ranges, and a task merges a range of up to
   ``FAN_IN`` runs with a loser tree, reading and writing block by block. Passes follow until
   each range is one run. Ranges in order are the capture histories of all URLs.
4. Archives are read back in order of the index.

Files have their names only when they are whole, and a task that runs again writes them again.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm.shared import U64, find, listed, open_file, shard_bits, shared_path, write_bytes, write_sorted
from tickertide.llm.words import plain

FAN_IN = 64  # runs merged at once
SPLITTERS = 4096  # index keys at most from which ranges are cut
BLOCK = 4096  # index entries written at once
LEVEL = 1  # of compression
LEAST_BYTES = 0  # payloads below this size are never revisits

ENTRY = pa.schema([("key", pa.binary()), ("file", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def digest_words(payload: bytes) -> tuple[bytes, int, int, int]:
    """The SHA-1 of a payload, and as three numbers."""
    d = hashlib.sha1(payload).digest()
    return d, *(int.from_bytes(d[a:b], "big") for a, b in ((0, 8), (8, 16), (16, 20)))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def payload_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page, html in zip(batch.column(0).to_pylist(), plain(batch.column(1)).to_pylist()):
            payload = html.encode()
            _, a, b, c = digest_words(payload)
            rows.append((signed(a), signed(b), c, page, len(payload)))
        columns = zip(*rows) if rows else [()] * 5
        yield pa.record_batch([pa.array(x, pa.int64()) for x in columns], names=["key", "rest1", "rest2", "page", "size"])


def url_key(url: str) -> str:
    """The host's names from the top, then the rest; lower-cased, without scheme and www."""
    scheme, mark, rest = url.partition("://")
    host, path = re.match(r"([^/?#]*)(.*)", rest if mark else url, re.S).groups()
    host = re.sub(r"^www\d*\.", "", host.lower())
    return f"{','.join(reversed(host.split('.')))}){path.partition('#')[0].lower() or '/'}"


def header_value(text: str) -> str:
    """Without white space and control characters, which a header line cannot hold."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def captured(page_id: int | None) -> datetime:
    """Pages have no date; one second per page_id from a fixed day, within some 300 years."""
    return datetime(2000, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=(page_id or 0) % 10_000_000_000)


def record(page_id: int | None, url: str, payload: bytes, digest: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that keeps only the headers."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {captured(page_id):%Y-%m-%dT%H:%M:%SZ}", f"WARC-Target-URI: {header_value(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def sort_key(page_id: int | None, url: str) -> bytes:
    """URL key, timestamp, page: compared byte by byte."""
    order = (page_id if page_id is not None else 0) + (1 << 63)
    return url_key(url).encode() + f"\0{captured(page_id):%Y%m%d%H%M%S}\0{order:020d}".encode()


def write_entries(uri: str, entries: Iterator[tuple]) -> int:
    """Index entries as a file of blocks; returns their number."""
    total = 0

    def fill(out: pa.NativeFile) -> None:
        nonlocal total
        with pa.ipc.new_file(out, ENTRY) as file:
            block: list[tuple] = []
            for entry in entries:
                block.append(entry)
                if len(block) == BLOCK:
                    file.write_batch(entry_batch(block))
                    total += len(block)
                    block = []
            if block:
                file.write_batch(entry_batch(block))
                total += len(block)

    write_bytes(uri, fill)
    return total


def entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), ENTRY)], schema=ENTRY)


def write_archives(folder: str, bits: int, least_bytes: int) -> Callable:
    """Writes the pages (page_id, url, html) of a task as an archive and a run; returns for
    each run its entries and some of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        entries: list[tuple] = []

        def fill(out: pa.NativeFile) -> None:
            offset = 0
            for batch in batches:
                pages, urls, htmls = batch.column(0).to_pylist(), plain(batch.column(1)).to_pylist(), plain(batch.column(2)).to_pylist()
                payloads = [h.encode() for h in htmls]
                digests = [digest_words(p) for p in payloads]
                words = [np.array([d[i] for d in digests], U64) for i in (1, 2, 3)]
                also = {"rest1": words[1].view(np.int64), "rest2": words[2].view(np.int64)}
                top = find(f"{folder}/repeated", bits, words[0], ["top", "known"], also=also)
                for i, page in enumerate(pages):
                    known = bool(top["known"][i])
                    refers = int(top["top"][i]) if known else None
                    revisit = known and refers != page and len(payloads[i]) >= least_bytes
                    member = gzip_member(record(page, urls[i], payloads[i], digests[i][0], refers, revisit))
                    out.write(member)
                    entries.append((sort_key(page, urls[i]), number, offset, len(member)))
                    offset += len(member)

        write_bytes(f"{folder}/archives/{number}.warc.gz", fill)
        entries.sort()
        write_entries(f"{folder}/runs-0/{number}", iter(entries))
        yield pa.record_batch([pa.array([e[0] for e in entries[:: max(1, len(entries) // 64)]], pa.binary())], names=["key"])

    return run


class LoserTree:
    """Merges k sorted iterators: an inner node keeps the loser of its match, the root's
    winner is the next entry; after it is taken, only its path is played again."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self.play(i)

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def play(self, i: int) -> None:
        """Let leaf i play upwards until it loses; the first time, wait at a free node."""
        node = (i + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = i
                return
            if self.beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator:
        while (entry := self.heads[self.losers[0]]) is not None:
            winner = self.losers[0]
            yield entry
            self.heads[winner] = next(self.runs[winner], None)
            self.play(winner)


class Run:
    """A sorted file of index entries."""

    def __init__(self, uri: str):
        self.file = pa.ipc.open_file(open_file(uri))
        self.count = self.file.num_record_batches

    def entries(self, low: bytes | None, high: bytes | None) -> Iterator[tuple]:
        """From ``low`` up to, but without, ``high``; None is open."""
        for b in range(self.first_block(low), self.count):
            batch = self.file.get_batch(b)
            keys = batch.column(0).to_pylist()
            begin = bisect_left(keys, low) if low is not None else 0
            end = bisect_left(keys, high) if high is not None else len(keys)
            yield from zip(*[c.slice(begin, end - begin).to_pylist() for c in batch.columns])
            if end < len(keys):
                return

    def first_block(self, low: bytes | None) -> int:
        """The last block that begins before ``low``."""
        if low is None or not self.count:
            return 0
        heads = _Heads(self)
        return max(0, bisect_left(heads, low) - 1)


class _Heads:
    def __init__(self, run: Run):
        self.run = run

    def __len__(self) -> int:
        return self.run.count

    def __getitem__(self, i: int) -> bytes:
        return self.run.file.get_batch(i).column(0)[0].as_py()


def merge_runs(spark: SparkSession, folder: str, runs: int, splitters: list[bytes]) -> tuple[str, int]:
    """Merge runs pass by pass; returns the folder of one run for each range, and the ranges.

    Files of a pass are named ``range-group``; of the first, by their task.
    """
    ranges, level = len(splitters) + 1, 0
    bounds = [None, *splitters, None]
    while True:
        source, target = f"{folder}/runs-{level}", f"{folder}/runs-{level + 1}"
        groups = max(1, -(-runs // FAN_IN))

        def merge(batches, source=source, target=target, runs=runs, groups=groups, level=level):
            for batch in batches:
                for task in batch.column(0).to_pylist():
                    part, group = divmod(task, groups)
                    numbers = range(group * FAN_IN, min(runs, (group + 1) * FAN_IN))
                    names = [str(i) if level == 0 else f"{part}-{i}" for i in numbers]
                    found = [Run(f"{source}/{n}").entries(bounds[part], bounds[part + 1]) for n in names if n in listed(source)]
                    total = write_entries(f"{target}/{part}-{group}", iter(LoserTree(found)))
                    yield pa.record_batch([pa.array([total], pa.int64())], names=["n"])

        tasks = spark.range(0, ranges * groups, 1, ranges * groups)
        tasks.mapInArrow(merge, "n bigint").agg(F.sum("n")).collect()
        if groups == 1:
            return target, ranges
        runs, level = groups, level + 1


@lru_cache(maxsize=64)
def archive(uri: str) -> pa.NativeFile:
    return open_file(uri)


def read_record(uri: str, offset: int, length: int) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of one record; a
    response whose payload does not have its digest is an error."""
    file = archive(uri)
    file.seek(offset)
    head, _, block = zlib.decompress(file.read(length), 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record in {uri} at {offset}")
    page = lambda text: int(text) if (text := text.removeprefix("<urn:page:").removesuffix(">")) else None
    return page(fields["WARC-Record-ID"]), size, digest, kind, page(fields["WARC-Refers-To"]) if kind == "revisit" else None


def read_history(spark: SparkSession, folder: str, index: str, ranges: int) -> DataFrame:
    """The records of all archives in order of the index: ``history`` is the range, ``place``
    the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                place, file = 0, pa.ipc.open_file(open_file(f"{index}/{part}-0"))
                for b in range(file.num_record_batches):
                    entries = file.get_batch(b)
                    rows = [
                        read_record(f"{folder}/archives/{f}.warc.gz", o, n)
                        for f, o, n in zip(*[entries.column(i).to_pylist() for i in (1, 2, 3)])
                    ]
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                    where = [pa.array([part] * len(rows), pa.int64()), pa.array(range(place, place + len(rows)), pa.int64())]
                    place += len(rows)
                    yield pa.record_batch([*columns, *where], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "history", "place"])

    return spark.range(0, ranges, 1, ranges).mapInArrow(run, f"{RECORD}, history bigint, place bigint")


def archive_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> tuple[str, str, int]:
    """Write the pages as archives with a merged index; returns their folder, the folder of
    the index and the number of its ranges.

    Of equal payloads of at least ``least_bytes`` that with the largest page_id is a response
    and the others revisit it; rows with that page_id are all responses, and so are rows
    without page_id if none of the equal ones has any. Null html is empty, a null url is too.
    """
    spark = pages.sparkSession
    bits = shard_bits(spark)
    folder = shared_path(spark, "warc")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    digests = rows.select("page_id", "html").mapInArrow(payload_digests, "key bigint, rest1 bigint, rest2 bigint, page bigint, size bigint")
    tops = digests.where(F.col("size") >= least_bytes).groupBy("key", "rest1", "rest2").agg(F.max("page").alias("top"), F.count("*").alias("n"))
    tops = tops.where("n > 1 and top is not null").select("key", "rest1", "rest2", "top", F.lit(1).cast("tinyint").alias("known"))
    write_sorted(tops, f"{folder}/repeated", bits)
    keys = rows.mapInArrow(write_archives(folder, bits, least_bytes), "key binary")
    # Splitters from a sample: they only cut the work. Keys are ordered by hash to be spread.
    sample = sorted(r.key for r in keys.orderBy(F.xxhash64("key")).limit(SPLITTERS).collect())
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    runs = 1 + max((int(n) for n in listed(f"{folder}/runs-0") if n.isdigit()), default=-1)
    index, ranges = merge_runs(spark, folder, runs, splitters)
    return folder, index, ranges


def archive_round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the pages as archives and read every record back, in order of the index."""
    folder, index, ranges = archive_pages(pages, least_bytes)
    return read_history(pages.sparkSession, folder, index, ranges)
