"""The prefix trie of conversations, from sorted matrices of turn numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.shared import store

#: Turns of a shard, of which one task holds the ids (16 bytes each), and columns of
#: a matrix that are sorted at once.
SHARD_TURNS = 200_000
COLUMNS = 32

#: Neighbouring shards whose common nodes are put together in one task.
BLOCK = 128

NO_ENDS = hashlib.sha256(b"").hexdigest()

#: Digest of the root.
ROOT = bytes(16)

NODES = (
    "kind string, shard long, node binary, parent binary, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, chars long, n_children long, n_leaves long, "
    "saved_tokens long, at_left boolean, at_right boolean, ends string"
)


def turns_of(convs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turns``: per conversation its turns in order, each ``id`` (16 bytes,
    one value for all turns of equal role and text) and ``chars`` (of its text)."""
    rows = convs.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    spelled = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    one = F.struct(
        F.col("turn").isNotNull().alias("known"), "turn", "role", F.md5("text").alias("digest"),
        F.unhex(F.md5(spelled)).alias("id"), F.length("text").alias("chars"),
    )
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    return gathered.select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["id"], t["chars"])).alias("turns")
    )


def _sorted_nodes(conv: np.ndarray, sizes: np.ndarray, ids: np.ndarray, chars: np.ndarray):
    """Nodes of a shard and the deepest node of every conversation.

    ``ids`` are the numbers of all turns in a row, ``sizes`` those per conversation.
    The turns are padded to a matrix, COLUMNS of it at a time and without the
    conversations that have ended. Its rows are sorted; a node starts where a column,
    or one before it, changes from one row to the next.
    """
    starts = np.cumsum(sizes) - sizes
    rows = np.arange(len(conv))
    last = np.zeros(len(conv), np.int64)  # the deepest node so far, by row
    found = {"depth": [[0]], "conv": [[conv.min()]], "n": [[len(conv)]], "chars": [[0]],
             "parent": [[-1]], "row": [[rows[0]]]}
    levels, count, depth = [(0, 1)], 1, 0
    while True:
        rows = rows[sizes[rows] > depth]
        if not len(rows):
            break
        at = depth + np.arange(COLUMNS)
        held = at[None, :] < sizes[rows][:, None]
        matrix = np.where(held, ids[np.where(held, starts[rows][:, None] + at, 0)], -1)
        order = np.lexsort([*matrix.T[::-1], last[rows]])
        rows, matrix, held = rows[order], matrix[order], held[order]
        above = last[rows]
        change = np.concatenate(([True], above[1:] != above[:-1]))
        for column in range(min(COLUMNS, int(sizes[rows].max()) - depth)):
            numbers = matrix[:, column]
            change[1:] |= numbers[1:] != numbers[:-1]
            begin = np.flatnonzero(change)
            members = np.diff(np.append(begin, len(rows)))
            least = np.minimum.reduceat(conv[rows], begin)
            real = held[begin, column]
            first = rows[begin[real]]
            d = depth + column
            number = np.full(len(begin), -1)
            number[real] = count + np.arange(real.sum())
            found["depth"].append(np.full(real.sum(), d + 1))
            found["conv"].append(least[real])
            found["n"].append(members[real])
            found["chars"].append(chars[starts[first] + d])
            found["parent"].append(last[first])
            found["row"].append(first)
            levels.append((count, count + int(real.sum())))
            count += int(real.sum())
            alive = held[:, column]
            last[rows[alive]] = np.repeat(number, members)[alive]
        depth += COLUMNS
    return {k: np.concatenate(v).astype(np.int64) for k, v in found.items()}, last, levels


def _chain(node: int, parent: np.ndarray) -> list[int]:
    """A node and all above it, from the root."""
    chain = []
    while node >= 0:
        chain.append(node)
        node = int(parent[node])
    return chain[::-1]


def shard_nodes(shard: int, conv: np.ndarray, sizes: np.ndarray, turns: np.ndarray, chars: np.ndarray):
    """Rows of NODES for the conversations of a shard, a range in the order of their
    turns and ids. ``turns`` are the ids of all turns, 16 bytes each.

    Nodes on the way to the first and the last conversation ("edge") may go on in the
    neighbouring shards; what they hold is summed without one another's share. All
    others are whole ("node"). "ends" are conversations that end at an edge.
    """
    halves = turns.reshape(-1, 16).view(">u8").astype(np.uint64)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    ordered = halves[order]
    new = np.concatenate(([False], (ordered[1:] != ordered[:-1]).any(1))) if len(order) else order
    ids = np.empty(len(order), np.int64)
    ids[order] = np.cumsum(new)
    nodes, last, levels = _sorted_nodes(conv, sizes, ids, chars)
    parent, n = nodes["parent"], nodes["n"]
    total = len(parent)

    ends = np.lexsort((conv, last))
    begin = np.flatnonzero(np.concatenate(([True], np.diff(last[ends]) > 0)))
    lists = {
        int(last[part[0]]): ",".join(map(str, conv[part].tolist()))
        for part in np.split(ends, begin[1:])
    }

    # the order of numbers is that of ids, so the edges are those of the sorted rows
    by_turns = sorted_ends(conv, sizes, ids)
    left, right = (_chain(int(last[row]), parent) for row in by_turns)
    edge = np.zeros(total, bool)
    edge[left] = edge[right] = True

    children, leaves = np.zeros(total, np.int64), np.zeros(total, np.int64)
    saved = (n - 1) * nodes["chars"]
    saved[edge] = 0
    for low, high in levels[:0:-1]:
        own = np.arange(low, high)
        whole = own[~edge[low:high]]
        leaves[whole] += children[whole] == 0
        up = parent[whole]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[whole])
        np.add.at(saved, up, saved[whole])

    starts = np.cumsum(sizes) - sizes
    digest: dict[int, bytes] = {}
    for chain in (left, right):
        for node in chain:
            if node not in digest:
                if not node:
                    digest[node] = ROOT
                    continue
                at = int(starts[nodes["row"][node]] + nodes["depth"][node] - 1)
                turn = turns[16 * at : 16 * at + 16].tobytes()
                digest[node] = hashlib.md5(digest[int(parent[node])] + turn).digest()

    inner = np.flatnonzero(~edge)
    hung = [None if edge[p] else int(nodes["conv"][p]) for p in parent[inner].tolist()]
    sums = {"n_convs": n, "chars": nodes["chars"], "n_children": children, "n_leaves": leaves,
            "saved_tokens": saved, "conv_id": nodes["conv"], "depth": nodes["depth"]}
    if len(inner):
        yield pd.DataFrame(
            {"kind": "node", "shard": shard, "node": None,
             "parent": [digest.get(p) for p in parent[inner].tolist()],
             "parent_conv_id": pd.array(hung, "Int64"),
             "at_left": None, "at_right": None,
             "ends": [lists.get(i, "") for i in inner.tolist()],
             **{k: v[inner] for k, v in sums.items()}}
        )
    edges = np.flatnonzero(edge)
    at_left, at_right = set(left), set(right)
    yield pd.DataFrame(
        {"kind": "edge", "shard": shard, "node": [digest[i] for i in edges.tolist()],
         "parent": [digest[int(parent[i])] if i else None for i in edges.tolist()],
         "parent_conv_id": pd.array([None] * len(edges), "Int64"),
         "at_left": [i in at_left for i in edges.tolist()],
         "at_right": [i in at_right for i in edges.tolist()], "ends": None,
         **{k: v[edges] for k, v in sums.items()}}
    )
    for i in edges.tolist():
        if i in lists:
            yield pd.DataFrame(
                {"kind": ["ends"], "shard": [shard], "node": [digest[i]], "ends": [lists[i]]}
            )


def sorted_ends(conv: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> tuple[int, int]:
    """The first and the last conversation in the order of turns, then of ids."""
    starts = np.cumsum(sizes) - sizes
    out = []
    for sign in (1, -1):
        rows, depth = np.arange(len(conv)), 0
        while True:
            ended = rows[sizes[rows] == depth]
            if len(ended) and (sign == 1 or len(ended) == len(rows)):
                rows = ended
                break
            rows = rows[sizes[rows] > depth]
            values = sign * ids[starts[rows] + depth]
            rows = rows[values == values.min()]
            depth += 1
        out.append(int(rows[np.argmin(sign * conv[rows])]))
    return out[0], out[1]


def _in_shards(convs: DataFrame) -> DataFrame:
    """The nodes of every shard, as rows of NODES."""
    total = convs.agg(F.count("*"), F.sum(F.size("turns"))).first()
    n = max(1, -(-(total[0] + (total[1] or 0)) // SHARD_TURNS))
    ids = F.transform("turns", lambda t: t["id"])
    rows = convs.select(
        "conv_id", ids.alias("ids"), F.transform("turns", lambda t: t["chars"]).alias("chars")
    )
    ranged = rows.repartitionByRange(n, "ids", "conv_id")
    ranged = ranged.withColumn("shard", F.spark_partition_id().cast("long"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()

        def flat(name: str) -> pa.Array:
            return pa.concat_arrays([c.flatten() for c in table[name].chunks])

        sizes = np.concatenate([c.value_lengths().to_numpy() for c in table["ids"].chunks])
        turns = np.frombuffer(b"".join(flat("ids").to_pylist()), np.uint8)
        conv = table["conv_id"].to_numpy().astype(np.int64)
        shard = table["shard"][0].as_py()
        for found in shard_nodes(
            shard, conv, sizes.astype(np.int64), turns, flat("chars").to_numpy().astype(np.int64)
        ):
            found = found.reindex(columns=schema.names)
            yield pa.RecordBatch.from_pandas(found, schema, preserve_index=False)

    schema = arrow_schema()
    return ranged.mapInArrow(nodes, NODES)


def arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    parts = (column.split() for column in NODES.split(", "))
    return pa.schema([(name, kinds[kind]) for name, kind in parts])


def merged(edges: pd.DataFrame, block: int, final: bool) -> pd.DataFrame:
    """The edges of neighbouring shards put together: nodes that no longer reach the
    first or the last conversation of all of them are whole and count for their
    parents; the others are the edges of the block."""
    first, last = edges["shard"].min(), edges["shard"].max()
    edges = edges.assign(
        at_left=edges["at_left"].astype(bool) & (edges["shard"] == first),
        at_right=edges["at_right"].astype(bool) & (edges["shard"] == last),
    )
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    by_node = edges.groupby("node", sort=False).agg(
        parent=("parent", "first"), conv_id=("conv_id", "min"), depth=("depth", "first"),
        chars=("chars", "first"), at_left=("at_left", "any"), at_right=("at_right", "any"),
        **{c: (c, "sum") for c in sums},
    )
    by_node = by_node.sort_values("depth", ascending=False).reset_index()
    rows = by_node.to_dict("records")
    known = {r["node"]: r for r in rows}
    for r in rows:
        whole = final or not (r["at_left"] or r["at_right"])
        r["kind"], r["shard"] = ("node" if whole else "edge"), block
        if whole:
            r["n_leaves"] += r["n_children"] == 0
            r["saved_tokens"] += (r["n_convs"] - 1) * r["chars"]
            above = known.get(r["parent"])
            if above is not None:
                above["n_children"] += 1
                above["n_leaves"] += r["n_leaves"]
                above["saved_tokens"] += r["saved_tokens"]
    return pd.DataFrame(rows).assign(parent_conv_id=pd.array([None] * len(rows), "Int64"), ends=None)


def _merge(final: bool):
    def merge(part: pd.DataFrame) -> pd.DataFrame:
        found = merged(part, int(part["shard"].iloc[0]) // BLOCK, final)
        return found.reindex(columns=arrow_schema().names)

    return merge


def _put_together(edges: DataFrame) -> DataFrame:
    """The whole nodes among the edges of all shards, block by block of them."""
    whole = None
    n = (edges.agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        final = n <= BLOCK
        blocks = edges.groupBy(F.floor(F.col("shard") / BLOCK))
        done = blocks.applyInPandas(_merge(final), NODES)
        done = store(done, "trie_edges")
        found = done.filter("kind = 'node'")
        whole = found if whole is None else whole.unionByName(found)
        if final:
            return whole
        edges, n = done.filter("kind = 'edge'"), -(-n // BLOCK)


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the edges at which conversations end. The lists of the
    shards are hashed one after the other; no list is put together."""
    dealt = ends.select("node", "shard", "ends").repartition("node")
    dealt = dealt.sortWithinPartitions("node", "shard")
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for own, part in zip(batch["node"].to_pylist(), batch["ends"]):
                if own != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(part.as_py().encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[i] for d in done], schema.types[i]) for i in (0, 1)], schema=schema
            )
        if node is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node]), pa.array([digest.hexdigest()])], schema=schema
            )

    return dealt.mapInArrow(hashed, "node binary, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """A row per node of the prefix trie of ``conv_id, turns`` (as ``turns_of`` gives
    them): ``conv_id`` (the smallest of its conversations), ``depth``,
    ``parent_conv_id`` (that of its parent; null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (nodes without children in its subtree, itself
    included), ``saved_tokens`` (over its subtree, the characters that need not be
    stored again) and ``ends_sha256`` (of the ids of the conversations that end here,
    ascending, comma-joined).

    Conversations are sorted by their turns in ranges of about SHARD_TURNS. Ranges cut
    nodes only on the way to their first and last conversation; these are put together
    afterwards, BLOCK ranges at a time. A node that very many conversations share costs
    each range one row. The ids of the turns of one conversation (not its texts) are
    held by one task.

    Conversations without turns (null or empty) belong to the root alone. ``conv_id``
    is expected to be unique and not null. An empty table has no nodes, not even a root.
    """
    rows = turns.select(
        "conv_id",
        F.coalesce("turns", F.expr("cast(array() AS array<struct<id:binary,chars:int>>)")).alias("turns"),
    )
    found = store(_in_shards(store(rows, "trie_turns")), "trie_nodes")
    edges = _put_together(found.filter("kind = 'edge'"))
    ends = _hashed_ends(found.filter("kind = 'ends'"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    edges = store(
        edges.join(ends, "node", "left").select(
            "node", "parent", *columns, F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
        ),
        "trie_edges",
    )
    inner = found.filter("kind = 'node'").select(
        "parent", "parent_conv_id", *columns, F.sha2("ends", 256).alias("ends_sha256")
    )
    below = inner.filter("parent IS NOT NULL").drop("parent_conv_id")
    below = below.unionByName(edges.filter("depth > 0").drop("node"))
    above = edges.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = edges.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = ["conv_id", "depth", "parent_conv_id", *columns[2:], "ends_sha256"]
    return (
        inner.filter("parent IS NULL").select(*out)
        .unionByName(below.join(above, "parent").select(*out))
        .unionByName(root.select(*out))
    )


def prefix_trie(
    convs: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``trie`` of a table with a row per turn.

    Turns are ordered by number, null first; equal numbers by role, then by the MD5 of
    the text, and repeated rows follow each other. A null role or text is empty. Rows
    without a conversation are passed over; other columns are not read.
    """
    return trie(turns_of(convs, conv, turn, role, text))


def with_shared_start(turns: DataFrame, start_of: Column, length: Column) -> DataFrame:
    """``conv_id, turns`` with the first ``length`` turns replaced by those of the
    conversation ``start_of`` (all of them if it has fewer, none if it is not there).
    Both columns may use ``conv_id`` and ``turns``."""
    rows = turns.withColumns({"__start_of": start_of, "__length": length})
    others = turns.join(
        rows.select(F.col("__start_of").alias("conv_id")).distinct(), "conv_id", "left_semi"
    ).select(F.col("conv_id").alias("__start_of"), F.col("turns").alias("__turns"))
    joined = rows.join(others, "__start_of", "left")
    head = F.coalesce(
        F.slice("__turns", F.lit(1), F.col("__length")),
        F.expr("cast(array() AS array<struct<id:binary,chars:int>>)"),
    )
    tail = F.slice("turns", F.col("__length") + 1, F.greatest(F.size("turns"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, tail).alias("turns"))
