"""WARC archives with revisits, and a globally ordered index of their captures."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.files import create, open_file
from reachgrid.llm.shared import store
from reachgrid.session import scratch

#: An archive is closed when it has grown to so many bytes.
FILE_BYTES = 64 * 1024 * 1024

#: Captures without a date are of this one.
NO_DATE = "1970-01-01T00:00:00Z"

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURES = (
    "url_key string, captured string, page_id long, run string, place long, "
    "at long, length long"
)
RECORDS = (
    "page_id long, url string, captured string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, payload binary"
)


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then the path and query: URLs of a
    site sort side by side. Without case of the host, user, port and fragment."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_replace(
        F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "#.*$", ""
    )
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def with_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, url, captured, payload`` with ``refers_to``, null for responses: of
    equal payloads the smallest page is the response."""
    rows = pages.withColumn("sha", F.sha1("payload"))
    firsts = rows.groupBy("sha").agg(F.min("page_id").alias("first"))
    revisit = (F.length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "sha").select(
        "page_id", "url", "captured", "payload", F.when(revisit, F.col("first")).alias("refers_to")
    )


def _line(name: str, value: str) -> bytes:
    # a line end inside a value would end the header
    value = value.replace("\r", "%0D").replace("\n", "%0A")
    return f"{name}: {value}\r\n".encode()


def record(page_id, url, captured, payload: bytes, refers_to) -> bytes:
    """A response or revisit record. The page is the record's name, or a random one
    where it is null; a revisit keeps the HTTP header, with the payload's length."""
    name = f"page:{page_id}" if page_id is not None else f"uuid:{uuid.uuid4()}"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = b"WARC/1.1\r\n"
    head += _line("WARC-Type", "response" if refers_to is None else "revisit")
    head += _line("WARC-Record-ID", f"<urn:{name}>")
    head += _line("WARC-Date", captured)
    if url is not None:
        head += _line("WARC-Target-URI", url)
    head += _line("WARC-Payload-Digest", f"sha1:{digest}")
    if refers_to is not None:
        head += _line("WARC-Refers-To", f"<urn:page:{refers_to}>")
        head += _line("WARC-Profile", PROFILE)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    head += _line("Content-Type", "application/http; msgtype=response")
    return head + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple:
    """The columns RECORDS of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    name = fields["WARC-Record-ID"][len("<urn:") : -1]
    page_id = int(name[5:]) if name.startswith("page:") else None
    kind, refers_to = fields["WARC-Type"], None
    if kind == "revisit":
        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        refers_to = int(fields["WARC-Refers-To"][len("<urn:page:") : -1])
        payload = None
    else:
        size = len(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    url = fields.get("WARC-Target-URI")
    return page_id, url, fields["WARC-Date"], kind, size, digest, refers_to, payload


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a gzip member per record; returns the captures, a sorted run per file.

    ``pages`` are ``page_id, url, captured, payload, refers_to``. Only files of
    listed captures count: what a lost task wrote is in no list.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, uri, at, place = None, "", 0, 0
        for batch in batches:
            runs, places, starts, lengths = [], [], [], []
            columns = ("page_id", "url", "captured", "payload", "refers_to")
            for row in zip(*(batch[c] for c in columns)):
                if stream is None:
                    uri, at, place = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = create(uri)
                packer = zlib.compressobj(wbits=31)
                member = packer.compress(record(*(v.as_py() for v in row))) + packer.flush()
                stream.write(member)
                runs.append(uri)
                places.append(place)
                starts.append(at)
                lengths.append(len(member))
                at, place = at + len(member), place + 1
                if at >= file_bytes:
                    stream.close()
                    stream = None
            kept = [batch[c] for c in ("url_key", "captured", "page_id")]
            new = [pa.array(runs, pa.string())]
            new += [pa.array(x, pa.int64()) for x in (places, starts, lengths)]
            names = ["url_key", "captured", "page_id", "run", "place", "at", "length"]
            yield pa.RecordBatch.from_arrays([*kept, *new], names)
        if stream is not None:
            stream.close()

    keyed = pages.withColumn("url_key", F.coalesce(url_key(F.col("url")), F.lit("")))
    runs = keyed.sortWithinPartitions("url_key", "captured", "page_id")
    return store(runs.mapInArrow(write, CAPTURES), "captures")


class LoserTree:
    """Merges sorted runs: each inner node holds the run that lost there, so that the
    next smallest key takes one game per level."""

    def __init__(self, runs: Sequence[Sequence[tuple]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.losers = [-1] * len(runs)
        self.winner = -1
        for run in range(len(runs)):
            self._enter(run)

    def _enter(self, run: int) -> None:
        """Play the first games of a run up to a place where none has come before."""
        node = (run + len(self.runs)) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = run
                return
            run = self._game(node, run)
            node //= 2
        self.winner = run

    def _game(self, node: int, run: int) -> int:
        """The run that goes on from a node; the other one stays there."""
        other = self.losers[node]
        if self._key(other) < self._key(run):
            self.losers[node] = run
            return other
        return run

    def _key(self, run: int) -> tuple:
        at = self.at[run]
        return (0, self.runs[run][at], run) if at < len(self.runs[run]) else (1, (), run)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it), in order of the keys."""
        for _ in range(sum(map(len, self.runs))):
            run = self.winner
            yield run, self.at[run]
            self.at[run] += 1
            node = (run + len(self.runs)) // 2
            while node > 0:
                run = self._game(node, run)
                node //= 2
            self.winner = run


def merge_runs(captures: DataFrame) -> DataFrame:
    """The captures of all runs in order of URL key, date and page: a table whose
    parts follow each other in that order.

    Ranges of keys go to tasks, so that captures of a frequent URL are split by date
    and page; each task merges the slices that the runs hold of its range. A slice
    that arrives out of order counts as several.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=schema)
        pages = table["page_id"].to_pylist()
        keys = list(
            zip(
                table["url_key"].to_pylist(),
                table["captured"].to_pylist(),
                [p is not None for p in pages],
                [p or 0 for p in pages],
            )
        )
        names = table["run"].to_pylist()
        runs: list[list[tuple]] = []
        begins: list[int] = []
        for i, key in enumerate(keys):
            if i == 0 or names[i] != names[i - 1] or key < keys[i - 1]:
                runs.append([])
                begins.append(i)
            runs[-1].append(key)
        order = [begins[run] + at for run, at in LoserTree(runs)]
        yield from table.take(pa.array(order, pa.int64())).combine_chunks().to_batches(10_000)

    text, number = pa.string(), pa.int64()
    kinds = [text, text, number, text, number, number, number]
    schema = pa.schema(list(zip(captures.columns, kinds)))
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = captures.repartitionByRange(parts, "url_key", "captured", "page_id")
    return store(ranged.mapInArrow(merge, CAPTURES), "history")


def read_archives(index: DataFrame) -> DataFrame:
    """The records that an index names, with the columns RECORDS."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, name = None, None
        names = [c.split()[0] for c in RECORDS.split(", ")]
        text, number = pa.string(), pa.int64()
        kinds = [number, text, text, text, number, text, number, pa.binary()]
        for batch in batches:
            rows, size = [], 0
            for run, at, length in zip(*(batch[c].to_pylist() for c in ("run", "at", "length"))):
                if run != name:
                    file, name = open_file(run), run
                rows.append(parsed(zlib.decompress(file.read_at(length, at), 31)))
                size += rows[-1][4]
                if size > 4_000_000:
                    yield _batch(rows, names, kinds)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names, kinds)

    # the records of an archive lie in one task, in their order in the file
    placed = index.select("run", "at", "length").repartition("run")
    return placed.sortWithinPartitions("run", "at").mapInArrow(read, RECORDS)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def archive(
    pages: DataFrame,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: Column | None = None,
    min_bytes: int = 0,
) -> DataFrame:
    """Write the pages as WARC files and return the merged index of their captures.

    A payload is the html in UTF-8, empty where it is null. Of equal payloads of at
    least ``min_bytes`` the smallest page is a response and the others revisit it;
    rows that repeat that page are responses too, and so are pages without a key if
    no page with one has their payload (else they revisit it). Null URLs sort first
    and have no target in their record; dates (text) default to 1970-01-01. Null
    keys get a random record name. An empty table gives no files and no captures;
    other columns are not read.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.lit(None) if date is None else date, F.lit(NO_DATE)).alias("captured"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    )
    return merge_runs(write_archives(with_types(rows, min_bytes), folder))
