"""Near duplicates by SimHash: pigeonhole blocks, then Hamming distances."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.components import components
from reachgrid.llm.shared import store

#: Most fingerprints of a block key that are compared pairwise in one task;
#: those of larger keys meet over their neighbouring values instead.
BUCKET = 512

#: Shingles whose bits are counted at once.
SLICE = 65_536


def fingerprint(text: str | None, words: int) -> int:
    """The 64-bit SimHash of a text, as a signed number.

    Lower-cases A-Z, takes words between ASCII white space, hashes every shingle
    (XXH64 of its UTF-8 bytes, seed 42); a bit is set if it is in over half of the
    hashes. Fewer words than a shingle make one shingle; none give 0.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    starts = starts[: len(parts) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), SLICE):
        spans = zip(starts[at : at + SLICE], ends[at : at + SLICE])
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), 1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    over = 2 * counts > len(starts)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 5) -> DataFrame:
    """The table with a column ``fp``; an older column of that name is replaced."""

    @F.arrow_udf("long")
    def fp(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(v.as_py(), words) for v in column], pa.int64())

    return docs.withColumn("fp", fp(F.col(text)))


def block_masks(bits: int) -> list[int]:
    """Masks of which two fingerprints within ``bits`` differing bits share at least
    one: 64 bits in ``bits + 2`` blocks, two of which no difference can reach."""
    n = bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _stars(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that join what is within ``bits`` of each other: each value to the
    smallest of its part of the bucket."""
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits
    order = np.argsort(values.view(np.int64))
    free = np.ones(len(values), bool)
    links = []
    for root in order:
        if not free[root]:
            continue
        part = close[root] & free
        free &= ~part
        front = part
        while front.any():
            front = close[front].any(0) & free
            free &= ~front
            part |= front
        part[root] = False
        base = int(values[root].view(np.int64))
        links += [(int(v), base) for v in values[part].view(np.int64)]
    return links


def _near(bits: int):
    @F.arrow_udf("array<struct<a:long,b:long>>")
    def near(buckets: pa.Array) -> pa.Array:
        flat = buckets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.cumsum(np.array([len(b) for b in buckets], np.int64))
        out, start = [], 0
        for end in ends.tolist():
            out.append(_stars(flat[start:end], bits) if end > start + 1 else [])
            start = end
        a = pa.array([x for links in out for x, _ in links], pa.int64())
        b = pa.array([x for links in out for _, x in links], pa.int64())
        offsets = np.concatenate(([0], np.cumsum([len(links) for links in out])))
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([a, b], ["a", "b"])
        )

    return near


def _around(fp: str, radius: int) -> str:
    """SQL for the values within one or two bits of a fingerprint."""
    if radius == 1:
        return f"concat(array({fp}), transform(sequence(0, 63), i -> {fp} ^ shiftleft(1L, i)))"
    one = f"{fp} ^ shiftleft(1L, i)"
    two = f"transform(sequence(i + 1, 64), j -> {one} ^ if(j = 64, 0L, shiftleft(1L, j)))"
    return f"concat(array({fp}), flatten(transform(sequence(0, 63), i -> {two})))"


def _dense_links(dense: DataFrame, bits: int) -> DataFrame:
    """Links among many fingerprints without pairs: two of them are within ``bits``
    of each other if and only if some value is within half as many bits of both, so
    each is tied to the smallest fingerprint around every value near it."""
    near = dense.select("fp", F.explode(F.expr(_around("fp", bits // 2))).alias("value"))
    least = near.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n"))
    met = near.join(least.filter("n > 1").drop("n"), "value").filter("fp <> b")
    return met.select(F.col("fp").alias("a"), "b").distinct()


def links(distinct: DataFrame, bits: int = 4, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links whose components are those of all pairs of the distinct
    fingerprints ``fp`` that differ in at most ``bits`` (2 or 4) bits.

    Fingerprints meet in pigeonhole blocks. Keys of up to ``bucket`` of them are
    compared pairwise and give a star per component; larger ones never meet in
    one task (see ``_dense_links``).
    """
    if bits not in (2, 4):
        raise ValueError("fingerprints link at 2 or 4 bits")
    keyed = distinct.select(
        "fp", F.explode(F.array(*[F.lit(m) for m in block_masks(bits)])).alias("mask")
    ).withColumn("key", F.expr("fp & mask"))
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(sizes, ["mask", "key"])
    buckets = (
        met.filter(F.col("n") <= bucket)
        .groupBy("mask", "key")
        .agg(F.collect_list("fp").alias("fps"))
    )
    sparse = buckets.select(F.explode(_near(bits)("fps")).alias("l")).select("l.a", "l.b")
    dense = store(met.filter(F.col("n") > bucket).select("fp").distinct(), "dense")
    if dense.isEmpty():
        return sparse
    return sparse.unionByName(_dense_links(dense, bits))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, bits: int = 4
) -> DataFrame:
    """One row per document: ``key, text_hash, fp, component``.

    ``component`` is the smallest key reachable over links, the own one included;
    null keys come last, so it is null only where all keys of a group are. Texts
    without words (null or empty) have fingerprint 0 and link like any other.
    Repeated rows stay repeated. Other columns are not read; a key or text column
    of any name works. An empty table gives no rows. ``text_hash`` tells rows with
    the same key apart.
    """
    prints = store(
        fingerprints(
            docs.select(F.col(key).alias("key"), F.col(text).alias("text")), words=words
        ).select("key", F.xxhash64("text").alias("text_hash"), "fp"),
        "fingerprints",
    )
    distinct = store(prints.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    rooted = store(components(links(distinct.select("fp"), bits)), "components")
    joined = distinct.join(rooted, distinct.fp == rooted.node, "left")
    linked = joined.filter("root IS NOT NULL")
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    of_fp = (
        linked.join(least, "root")
        .select("fp", "component")
        .unionByName(joined.filter("root IS NULL").select("fp", F.col("first").alias("component")))
    )
    return prints.join(of_fp, "fp").select(F.col("key").alias(key), "text_hash", "fp", "component")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, bits: int = 4
) -> DataFrame:
    """The documents without near duplicates: of each group the row with the
    smallest key stays (of rows with that key, the one with the smallest hash of
    its text; of rows equal in both, one). All columns stay as they are.
    """
    return keep_one(docs, near_duplicates(docs, key, text, words, bits), key, text)


def keep_one(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """The documents that ``one_of_each`` keeps of the groups that were found."""
    # rows without any key make no group but that of their own fingerprint
    group = F.struct("component", F.when(F.col("component").isNull(), F.col("fp")))
    kept = found.groupBy(group.alias("g")).agg(
        F.min(F.struct(F.col(key).isNull().alias("unknown"), key, "text_hash")).alias("m")
    )
    kept = kept.select(F.col("m")[key].alias("__key"), F.col("m.text_hash").alias("__hash"))
    rows = docs.withColumn("__hash_of_row", F.xxhash64(text))
    same = rows[key].eqNullSafe(kept["__key"]) & (rows["__hash_of_row"] == kept["__hash"])
    left = rows.join(kept, same, "left_semi")
    return left.dropDuplicates([key, "__hash_of_row"]).drop("__hash_of_row")
