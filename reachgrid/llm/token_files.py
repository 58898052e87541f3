"""Token ids in binary files, each document compressed with a shared dictionary."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachgrid.llm.files import create, open_file
from reachgrid.llm.shared import library_units, store, texts_of
from reachgrid.session import scratch

#: A file begins with this and the SHA-256 of the dictionary of its frames. Then
#: come the frames, one per document: its ids as little-endian unsigned 32-bit
#: numbers, compressed. The index follows, as arrays of little-endian 64-bit
#: numbers: ids before each document within the file, and the end of each frame; one
#: number more than documents each. The file ends with the number of documents and
#: the place of the index.
MAGIC = b"TOKIDS01"
HEAD = len(MAGIC) + 32
TAIL = "<QQ"

#: The dictionary is trained on so many different texts of any length, their ids in
#: samples of so many bytes: only compression depends on it.
SAMPLE = 512
SAMPLE_BYTES = 16 * 1024
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3

#: A file is closed when it has grown to so many bytes.
FILE_BYTES = 64 * 1024 * 1024

FILES_SCHEMA = "file string, docs long, ids long, first struct<key:{0},at:long>, keys array<{0}>"


def train(docs: DataFrame, path: str, text: str, end_id: int) -> bytes:
    """A dictionary from the serialized ids of SAMPLE different texts, those with the
    smallest hashes; none if they are too few or too uniform to train on.

    A threshold on the hash, from the number of rows, leaves about twice as many rows
    before anything is shuffled or sorted; copies of a text are one. If they leave too
    few texts, the threshold is raised until there are enough, or all are taken. One task
    encodes the sample and trains on it; the driver gets the dictionary.
    """
    hashed = docs.select(
        F.col(text).alias("text"), F.shiftrightunsigned(F.xxhash64(text), 1).alias("at")
    ).filter(F.length("text") > 0)
    n = max(1, docs.count())  # from the footers of a stored table
    limit = 0
    while limit < (1 << 63) - 1:
        limit = min(1 << 63, max(4 * limit, (1 << 63) * 2 * SAMPLE // n)) - 1
        some = store(hashed.filter(F.col("at") <= limit).dropDuplicates(["at"]), "sample")
        if some.count() >= SAMPLE:
            break
    ordered = some.repartition(1).sortWithinPartitions("at")

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = library_units(path, keep_space=True)
        end = np.array([end_id], "<u4").tobytes()
        samples, left = [], SAMPLE
        for batch in batches:
            texts = texts_of(batch["text"].slice(0, left))
            for values in units.encode(texts):
                ids = b"".join(values) + end
                samples += [ids[i : i + SAMPLE_BYTES] for i in range(0, len(ids), SAMPLE_BYTES)]
                left -= 1
        try:
            found = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            found = b""
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], ["dictionary"])

    found = ordered.mapInArrow(trained, "dictionary binary").first()
    return b"" if found is None else bytes(found[0])


class Shard:
    """One file while it is written."""

    def __init__(self, folder: str, dictionary: bytes):
        self.uri = f"{folder}/ids-{uuid.uuid4().hex}.bin"
        self.stream = create(self.uri)
        self.stream.write(MAGIC + hashlib.sha256(dictionary).digest())
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        self.keys: list = []
        self.starts, self.ends = [0], [HEAD]

    def add(self, key, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.stream.write(frame)
        self.keys.append(key)
        self.starts.append(self.starts[-1] + len(ids) // 4)
        self.ends.append(self.ends[-1] + len(frame))

    def close(self) -> tuple:
        self.stream.write(np.array(self.starts, "<u8").tobytes())
        self.stream.write(np.array(self.ends, "<u8").tobytes())
        self.stream.write(struct.pack(TAIL, len(self.keys), self.ends[-1]))
        self.stream.close()
        return self.uri, len(self.keys), self.starts[-1], self.keys


class Reader:
    """Documents of a file by number, each read and decompressed alone."""

    def __init__(self, uri: str, dictionary: bytes):
        self.file = open_file(uri)
        size = self.file.size()
        head = self.file.read_at(HEAD, 0)
        if head != MAGIC + hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} is of another format or dictionary")
        length = struct.calcsize(TAIL)
        self.docs, at = struct.unpack(TAIL, self.file.read_at(length, size - length))
        index = np.frombuffer(self.file.read_at(16 * (self.docs + 1), at), "<u8")
        self.starts, self.ends = index[: self.docs + 1], index[self.docs + 1 :]
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.decompressor = zstandard.ZstdDecompressor(dict_data=shared)

    def ids(self, n: int) -> bytes:
        begin, end = int(self.ends[n]), int(self.ends[n + 1])
        return self.decompressor.decompress(self.file.read_at(end - begin, begin))

    def close(self) -> None:
        self.file.close()


def write_ids(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    file_bytes: int = FILE_BYTES,
) -> tuple[DataFrame, bytes]:
    """Write the ids of every whole text, the end id after each, in ascending order of
    keys; returns the files in that order and the dictionary.

    The files are ``file, docs, ids, keys, start``; ``start`` counts the ids of all
    files before. Only listed files count: a lost task's files are in no list. The
    dictionary lies beside them as ``<its SHA-256>.dict``. Null texts hold the end id
    alone; null keys come first; rows with the same key follow each other by the hash
    of their texts; an empty table gives no files; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    dictionary = train(rows, path, "text", end_id)
    with create(f"{folder}/{hashlib.sha256(dictionary).hexdigest()}.dict") as out:
        out.write(dictionary)
    kind = rows.schema["key"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = library_units(path, keep_space=True)
        end = np.array([end_id], "<u4").tobytes()
        shard = None

        def closed() -> pa.RecordBatch:
            uri, n, ids, keys = shard.close()
            values = pa.array(keys, key_type)
            first = pa.StructArray.from_arrays(
                [values.slice(0, 1), pa.array([first_hash], pa.int64())], ["key", "at"]
            )
            listed = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), values)
            columns = [pa.array([uri]), pa.array([n]), pa.array([ids]), first, listed]
            return pa.RecordBatch.from_arrays(columns, ["file", "docs", "ids", "first", "keys"])

        for batch in batches:
            key_type = batch["key"].type
            found = units.encode(texts_of(batch["text"]))
            hashes = batch["at"].to_pylist()
            for k, at, values in zip(batch["key"].to_pylist(), hashes, found):
                if shard is None:
                    shard = Shard(folder, dictionary)
                    first_hash = at
                shard.add(k, b"".join(values) + end)
                if shard.ends[-1] >= file_bytes:
                    yield closed()
                    shard = None
        if shard is not None:
            yield closed()

    rows = rows.withColumn("at", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key", "at").sortWithinPartitions("key", "at")
    files = store(ordered.mapInArrow(write, FILES_SCHEMA.format(kind)), "files")
    # a row per file
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("file", "ids", "first")
    starts = sizes.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return files.join(starts.select("file", "start"), "file"), dictionary


def read_ids(files: DataFrame, dictionary: bytes, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids`` of every document of the files, ``start`` being
    the number of ids of all documents before it."""
    kind = files.schema["keys"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                reader = Reader(batch["file"][at].as_py(), dictionary)
                start, keys = batch["start"][at].as_py(), batch["keys"][at].values
                for low in range(0, reader.docs, 256):
                    n = min(256, reader.docs - low)
                    starts = reader.starts[low : low + n + 1].astype(np.int64) + start
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.slice(low, n),
                            pa.array(starts[:-1]),
                            pa.array(np.diff(starts)),
                            pa.array([reader.ids(low + i) for i in range(n)], pa.binary()),
                        ],
                        ["key", "start", "n_tokens", "ids"],
                    )
                reader.close()

    listed = files.select("file", "start", "keys")
    found = listed.mapInArrow(read, f"key {kind}, start long, n_tokens long, ids binary")
    return found.withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text"):
    """The documents' ids written to files in the shared folder and read from them."""
    folder = scratch(docs.sparkSession, "token-files")
    files, dictionary = write_ids(docs, path, folder, end_id, key, text)
    return read_ids(files, dictionary, key)
