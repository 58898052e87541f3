"""Approximate nearest neighbours by a hash-prefix forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachgrid.llm.shared import store

#: Trees, bits of a hash string, rows of an index block, queries of a query block.
TREES = 96
BITS = 32
BLOCK = 4096
QUERIES = 2048

#: Share of a block's rows that a query ascends to; documented recall in README.
SHARE = 0.45

BLOCK_SCHEMA = "dim int, block string, n int, ids binary, vectors binary"
RESULT_SCHEMA = "query_id long, rank int, vec_id long, score double"
INDEX_SCHEMA = BLOCK_SCHEMA + ", hashes binary, places binary"


def planes(dim: int, trees: int, bits: int, seed: int) -> np.ndarray:
    """Normals of the hyperplanes whose sides spell the hash strings."""
    return np.random.default_rng(seed).standard_normal((dim, trees * bits))


def hash_strings(vectors: np.ndarray, trees: int, bits: int, seed: int) -> np.ndarray:
    """Per tree and vector the hash string, its first bit the highest of a number."""
    sides = vectors @ planes(vectors.shape[1], trees, bits, seed) > 0
    sides = sides.reshape(len(vectors), trees, bits)
    weights = (1 << np.arange(bits - 1, -1, -1)).astype(np.uint64)
    return np.ascontiguousarray((sides * weights).sum(2, dtype=np.uint64).T)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, vector`` of the rows that take part, the vector as doubles."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), v.alias("vector"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return rows.filter("key IS NOT NULL AND vector IS NOT NULL").filter(
        finite & F.exists("vector", lambda x: x != 0)
    )


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed into blocks of up to ``size`` vectors of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        held: dict[int, tuple[list, list]] = {}

        def row(dim: int, ids: list, vectors: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "block": [uuid.uuid4().hex],
                    "n": pa.array([len(ids)], pa.int32()),
                    "ids": [np.array(ids, "<i8").tobytes()],
                    "vectors": [np.array(vectors, "<f8").tobytes()],
                }
            )

        for batch in batches:
            for key, vector in zip(batch["key"].to_pylist(), batch["vector"]):
                values = vector.values.to_numpy()
                ids, vectors = held.setdefault(len(values), ([], []))
                ids.append(key)
                vectors.append(values)
                if len(ids) == size:
                    yield row(len(values), *held.pop(len(values)))
        for dim, (ids, vectors) in held.items():
            yield row(dim, ids, vectors)

    return rows.mapInArrow(pack, BLOCK_SCHEMA)


def build_index(
    rows: DataFrame, trees: int = TREES, bits: int = BITS, block: int = BLOCK, seed: int = 11
) -> DataFrame:
    """The forest: per block its vectors and, per tree, the sorted hash strings
    with the places of their vectors. Every row is in one block."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                dim, n = one["dim"][0].as_py(), one["n"][0].as_py()
                vectors = np.frombuffer(one["vectors"][0].as_py(), "<f8").reshape(n, dim)
                hashes = hash_strings(vectors, trees, bits, seed)
                places = np.argsort(hashes, axis=1, kind="stable").astype("<i4")
                hashes = np.take_along_axis(hashes, places, 1).astype("<u8")
                columns = {name: one[name] for name in one.schema.names}
                columns["hashes"] = pa.array([hashes.tobytes()], pa.binary())
                columns["places"] = pa.array([places.tobytes()], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return blocks(rows, block).mapInArrow(index, INDEX_SCHEMA)


def met_by(
    strings: np.ndarray, hashes: np.ndarray, places: np.ndarray, bits: int, wanted: int
) -> Iterator[np.ndarray]:
    """For each query's hash strings (trees x queries), the places it meets in a
    block's forest.

    In every tree a query descends to the longest prefix that some vector shares;
    then all trees ascend together, bit by bit, until ``wanted`` vectors are met.
    """
    trees, n = hashes.shape
    if wanted >= n:
        yield from (np.arange(n) for _ in range(strings.shape[1]))
        return
    levels = []
    enough = np.full(strings.shape[1], -1)
    for depth in range(bits, -1, -1):
        free = np.uint64((1 << (bits - depth)) - 1)
        low = np.stack([np.searchsorted(h, s & ~free, "left") for h, s in zip(hashes, strings)])
        high = np.stack([np.searchsorted(h, s | free, "right") for h, s in zip(hashes, strings)])
        levels.append((low, high))
        enough[(enough < 0) & ((high - low).sum(0) >= wanted)] = len(levels) - 1
        if depth == 0:
            break
    met = np.zeros(n, bool)
    for q in range(strings.shape[1]):
        for low, high in levels[enough[q] :]:
            for t in range(trees):
                met[places[t, low[t, q] : high[t, q]]] = True
            found = np.flatnonzero(met)
            if len(found) >= wanted:
                break
        met[:] = False
        yield found


def _top(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[int, float]]:
    """The k best by score, then id; an id counts once, the query's own never."""
    best: dict[int, float] = {}
    for at in np.lexsort((ids, -scores)).tolist():
        found = int(ids[at])
        if found != own and found not in best:
            best[found] = float(scores[at])
            if len(best) == k:
                break
    return list(best.items())


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    share: float = SHARE,
    trees: int = TREES,
    bits: int = BITS,
    block: int = QUERIES,
    seed: int = 11,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest that each query finds.

    Query blocks meet all index blocks; a pair of blocks gives k rows per query,
    never the candidates themselves.
    """
    asked = store(blocks(queries, block), "queries").withColumnsRenamed(
        {"n": "q_n", "block": "q_block", "ids": "q_ids", "vectors": "q_vectors"}
    )
    numbers = Window.orderBy("q_block")
    asked = asked.withColumn("q", F.row_number().over(numbers))
    n_asked = asked.count()
    if not n_asked:
        return index.sparkSession.createDataFrame([], RESULT_SCHEMA)
    # both sides are dealt out: blocks of the index to groups, queries to each group
    groups = -(-index.count() // 4)
    met = index.withColumns(
        {
            "q": F.explode(F.sequence(F.lit(1), F.lit(n_asked))),
            "g": F.pmod(F.hash("block"), F.lit(max(groups, 1))),
        }
    ).join(
        asked.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(max(groups, 1) - 1)))),
        ["dim", "q", "g"],
    )
    width = bits

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = {name: batch[name][at].as_py() for name in batch.schema.names}
                dim, n = one["dim"], one["n"]
                ids = np.frombuffer(one["ids"], "<i8")
                vectors = np.frombuffer(one["vectors"], "<f8").reshape(n, dim)
                norms = np.sqrt((vectors * vectors).sum(1))
                hashes = np.frombuffer(one["hashes"], "<u8").reshape(trees, n)
                places = np.frombuffer(one["places"], "<i4").reshape(trees, n)
                q_ids = np.frombuffer(one["q_ids"], "<i8")
                asked = np.frombuffer(one["q_vectors"], "<f8").reshape(-1, dim)
                strings = hash_strings(asked, trees, width, seed)
                wanted = max(2 * k + 1, int(np.ceil(share * n)))
                found = []
                for i, c in enumerate(met_by(strings, hashes, places, width, wanted)):
                    vector = asked[i]
                    # row by row, so that equal vectors get equal scores
                    dots = (vectors[c] * vector).sum(1)
                    scores = dots / (norms[c] * np.sqrt((vector * vector).sum()))
                    own = int(q_ids[i])
                    found += [(own, v, s) for v, s in _top(ids[c], scores, own, k)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array([f[0] for f in found], pa.int64()),
                        "vec_id": pa.array([f[1] for f in found], pa.int64()),
                        "score": pa.array([f[2] for f in found], pa.float64()),
                    }
                )

    found = met.mapInArrow(look, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    share: float = SHARE,
) -> DataFrame:
    """The k nearest by cosine that every row of ``queries`` finds among ``vectors``.

    Null keys and vectors that are null, zero, or hold null or non-finite parts take
    no part, as query or as candidate; vectors only meet others of their length. A
    key that repeats is one query (its smallest vector) and one candidate (its best
    score), and never its own neighbour. Ties go to the smaller key. Fewer
    candidates than k are all returned. An empty table gives no rows; other columns
    are not read.
    """
    asked = usable(queries, key, vector).groupBy("key").agg(F.min("vector").alias("vector"))
    index = store(build_index(usable(vectors, key, vector)), "forest")
    return search(index, asked, k, share)
