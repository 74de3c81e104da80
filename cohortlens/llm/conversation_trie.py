"""The trie of shared conversation openings, built as ternary search trees per range shard.

Turns are encoded by a dictionary: each distinct (role, text) has one number, found by its
SHA-256, so texts are read and never moved. Conversations become sequences of numbers, and
sequences are range-partitioned in their order (equal ones by conversation), so a sequence or
an opening that a third of all conversations share is cut between shards. A shard inserts its
distinct sequences into a ternary search tree, the median first, then the medians of both
halves, which keeps the tree of siblings balanced however ordered the input is. One walk
without recursion then adds up members, children, leaves and savings from below.

Only the nodes on a shard's first and last sequence can have members elsewhere. A shard gives
those as partial sums, and one pass over them in shard order, which holds a single path at a
time, merges them: two paths per shard come to it, whatever the number of conversations.

A conversation is the unit, as a document is elsewhere: its numbers lie in one row.

Defined results. A null role or text is empty. Turns go by ``turn``, null first, and turns that
tie by the SHA-256 of role and text; repeated rows are repeated turns. Rows without a conv_id
belong to no conversation and are left out. Columns besides the four that are read make no
difference, whatever their names. An empty table has no members and so no nodes, no root either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.ranking import global_row_number
from cohortlens.session import materialize, shuffle_width

#: Turns of a shard, about; more shards are made where there are more turns.
SHARD_TURNS = 1_000_000
#: Rows of an Arrow batch of nodes.
BATCH = 50_000
#: Turns that an opening has at most, and conversations that take it from one of them.
LONGEST_OPENING, OPENING_GROUP = 8, 5

NODE = (
    "shard int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, boundary long, parent_boundary long, "
    "node_key binary, bytes long, ends binary"
)
MERGED = (
    "node_key binary, parent_key binary, conv_id long, depth long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(rows), BATCH):
        columns = zip(*rows[start : start + BATCH])
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
        )


# --- sequences ------------------------------------------------------------------


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order, as (number, text bytes)."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.sha2(told, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    distinct = turns.groupBy("digest").agg(F.max("bytes").alias("_bytes"))
    dictionary = global_row_number(distinct, ["digest"], "number").select("digest", "number")
    placed = F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("known"), "turn", "digest", "number", "bytes"
    )))
    # array_sort puts null elements last, but here the elements are structs that are never
    # null; ``known`` puts turns without a number first.
    return (
        turns.join(dictionary, "digest")
        .groupBy("conv_id")
        .agg(placed.alias("placed"))
        .select(
            "conv_id",
            F.transform(
                "placed", lambda t: F.struct(t["number"].alias("number"), t["bytes"].alias("bytes"))
            ).alias("turns"),
        )
    )


def opening_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its group."""
    checksum = F.crc32(conv_id.cast("string").cast("binary"))
    return F.pmod(checksum, F.lit(LONGEST_OPENING + 1)).cast("int")


def share_openings(sequences: DataFrame) -> DataFrame:
    """Conversations that open with the first turns of conversation c - c % 5.

    The remainder has the sign of c, as in SQL. A first conversation that is absent gives no
    turns; the own turns that the opening replaces are left out all the same.
    """
    first = F.col("conv_id") - F.col("conv_id") % F.lit(OPENING_GROUP)
    heads = sequences.where(first == F.col("conv_id")).select(
        F.col("conv_id").alias("_first"),
        F.slice("turns", 1, LONGEST_OPENING).alias("_head"),
    )
    taken = opening_length(F.col("conv_id"))
    own = F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1)))
    nothing = F.slice("turns", 1, 0)
    joined = sequences.withColumn("_first", first).join(heads, "_first", "left")
    return joined.select(
        "conv_id",
        F.concat(F.coalesce(F.slice("_head", F.lit(1), taken), nothing), own).alias("turns"),
    )


# --- a shard --------------------------------------------------------------------


class TernaryTree:
    """A ternary search tree over sequences of numbers; node 0 is the textless root.

    ``lower``, ``equal`` and ``higher`` lead from a node to siblings with smaller numbers, to
    the children, and to siblings with larger numbers; 0 stands for none.
    """

    def __init__(self):
        self.number, self.lower, self.equal, self.higher = [-1], [0], [0], [0]
        self.depth, self.parent, self.bytes = [0], [-1], [0]
        self.members, self.smallest = [0], [None]
        self.ends: dict[int, list[int]] = {}

    def _node(self, number: int, parent: int, size: int) -> int:
        self.number.append(number)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.bytes.append(size)
        for links in (self.lower, self.equal, self.higher):
            links.append(0)
        self.members.append(0)
        self.smallest.append(None)
        return len(self.number) - 1

    def _count(self, node: int, members: int, smallest: int) -> None:
        self.members[node] += members
        known = self.smallest[node]
        if known is None or smallest < known:
            self.smallest[node] = smallest

    def insert(self, numbers: list[int], sizes: list[int], members: list[int]) -> list[int]:
        """Add a sequence with its conversations; gives the nodes of its path."""
        number, lower, equal, higher = self.number, self.lower, self.equal, self.higher
        node, count, smallest = 0, len(members), members[0]
        path = [0]
        self._count(0, count, smallest)
        for wanted, size in zip(numbers, sizes):
            at = equal[node]
            if not at:
                at = equal[node] = self._node(wanted, node, size)
            while number[at] != wanted:
                links = lower if wanted < number[at] else higher
                if not links[at]:
                    links[at] = self._node(wanted, node, size)
                at = links[at]
            node = at
            self._count(node, count, smallest)
            path.append(node)
        self.ends.setdefault(node, []).extend(members)
        return path

    def totals(self, boundary: set[int]) -> tuple[list[int], list[int], list[int]]:
        """Children, leaves and savings of every node, from the deepest up.

        What belongs to boundary nodes does not go up: they are added in the merge.
        """
        size = len(self.number)
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        # A node is made after its parent, so numbers descend from children to parents.
        for node in range(size - 1, 0, -1):
            if node in boundary:
                continue
            leaves[node] += not children[node]
            saved[node] += (self.members[node] - 1) * self.bytes[node]
            parent = self.parent[node]
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
        return children, leaves, saved


def median_order(count: int) -> Iterator[int]:
    """0..count-1, the median of the whole first, then those of the halves."""
    waiting = [(0, count)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(middle + 1, high), (low, middle)]


def joined_ids(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def _sequences(batches: Iterator[pa.RecordBatch]) -> tuple[int, list]:
    """The shard's number and its distinct sequences with their conversations, in order."""
    found: list[tuple[list[int], list[int], list[int]]] = []
    shard = -1
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column("shard")[0].as_py()
        numbers, sizes = batch.column("numbers"), batch.column("sizes")
        cuts = numbers.offsets.to_numpy()
        flat, flat_sizes = (column.flatten().to_numpy().tolist() for column in (numbers, sizes))
        cuts = (cuts - cuts[0]).tolist()
        for conv, low, high in zip(batch.column("conv_id").to_pylist(), cuts, cuts[1:]):
            sequence = flat[low:high]
            if found and found[-1][0] == sequence:
                found[-1][2].append(conv)
            else:
                found.append((sequence, flat_sizes[low:high], [conv]))
    return shard, found


def _path_keys(numbers: list[int]) -> list[bytes]:
    """A digest of each beginning of a sequence, the empty one first."""
    running = hashlib.sha256()
    keys = [running.digest()]
    for packed in np.array(numbers, "<i8").reshape(-1, 1):
        running.update(packed.tobytes())
        keys.append(running.digest())
    return keys


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, sequences = _sequences(batches)
    if not sequences:
        return
    tree = TernaryTree()
    edges = {}
    for place in median_order(len(sequences)):
        path = tree.insert(*sequences[place])
        if place in (0, len(sequences) - 1):
            edges[place] = path
    # Boundary nodes in the order of the merge: the first path, then what the last adds.
    keys: dict[int, bytes] = {}
    for place in sorted(edges):
        for node, key in zip(edges[place], _path_keys(sequences[place][0])):
            keys.setdefault(node, key)
    order = {node: number for number, node in enumerate(keys)}
    children, leaves, saved = tree.totals(set(keys))
    rows = []
    for node in range(len(tree.number)):
        parent = tree.parent[node]
        ends = tree.ends.get(node, [])
        at_edge = node in keys
        known = parent >= 0 and parent not in keys
        rows.append(
            (
                shard, tree.smallest[node], tree.depth[node],
                tree.smallest[parent] if known else None,
                tree.members[node], children[node], leaves[node], saved[node],
                None if at_edge else hashlib.sha256(joined_ids(ends)).hexdigest(),
                order.get(node), order.get(parent), keys.get(node), tree.bytes[node],
                joined_ids(ends) if at_edge else None,
            )
        )
    yield from _batches(rows, _arrow_schema(NODE))


def _shards(sequences: DataFrame) -> DataFrame:
    """Nodes of all shards' trees; the members of a boundary node are those in the shard."""
    turns = sequences.agg(F.coalesce(F.sum(F.size("turns")), F.lit(0))).first()[0]
    shards = max(shuffle_width(sequences.sparkSession), -(-turns // SHARD_TURNS))
    dealt = (
        sequences.select(
            "conv_id",
            F.col("turns.number").alias("numbers"),
            F.col("turns.bytes").alias("sizes"),
        )
        .repartitionByRange(shards, "numbers", "conv_id")
        .sortWithinPartitions("numbers", "conv_id")
        .withColumn("shard", F.spark_partition_id())
    )
    return dealt.mapInArrow(_shard_nodes, NODE)


# --- boundary nodes --------------------------------------------------------------


class _Open:
    """A node of the path that the merge has open."""

    __slots__ = ("key", "smallest", "members", "children", "leaves", "saved", "bytes", "ends", "told")

    def __init__(self, key: bytes, size: int):
        self.key, self.bytes = key, size
        self.smallest: int | None = None
        self.members = self.children = self.leaves = self.saved = 0
        self.ends, self.told = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        known = self.smallest
        self.smallest = row["conv_id"] if known is None else min(known, row["conv_id"])
        self.members += row["n_convs"]
        self.children += row["n_children"]
        self.leaves += row["n_leaves"]
        self.saved += row["saved_tokens"]
        if row["ends"]:
            # Shards hold ascending conversations of one sequence, so this is their order.
            self.ends.update(b"," * self.told + row["ends"])
            self.told = True


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Boundary nodes with their full sums, from partial ones in shard order."""
    path: list[_Open] = []
    closed: list[tuple] = []
    schema = _arrow_schema(MERGED)

    def close() -> None:
        node = path.pop()
        leaves = node.leaves + (not node.children)
        saved = node.saved + (node.members - 1) * node.bytes
        if path:
            path[-1].leaves += leaves
            path[-1].saved += saved
        closed.append(
            (
                node.key, path[-1].key if path else None, node.smallest, len(path), node.members,
                node.children, leaves, saved, node.ends.hexdigest(),
            )
        )

    for batch in batches:
        for row in batch.to_pylist():
            depth = row["depth"]
            if depth < len(path) and path[depth].key != row["node_key"]:
                while len(path) > depth:
                    close()
            if depth == len(path):
                if path:
                    path[-1].children += 1
                path.append(_Open(row["node_key"], row["bytes"]))
            path[depth].add(row)
        if len(closed) >= BATCH:
            yield from _batches(closed, schema)
            closed.clear()
    while path:
        close()
    yield from _batches(closed, schema)


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per distinct beginning of the sequences of ``(conv_id, turns)``.

    ``conv_id`` names a node by its smallest member and ``depth`` its turns; then its parent's
    conv_id, members, children, leaves below, what sharing saves in bytes below, and the
    SHA-256 of the conversations that end there.
    """
    nodes = materialize(_shards(materialize(sequences)))
    columns = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )
    edge = F.col("boundary").isNotNull()
    partial = nodes.where(edge).select(
        "shard", "boundary", "node_key", "conv_id", "depth", "n_convs", "n_children",
        "n_leaves", "saved_tokens", "bytes", "ends",
    )
    # Two paths per shard, so one task is enough; it reads them front to back.
    merged = materialize(
        partial.repartition(1).sortWithinPartitions("shard", "boundary").mapInArrow(_merge, MERGED)
    )
    parents = merged.select(
        F.col("node_key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")
    )
    shared = merged.join(parents, "parent_key", "left").select(*columns)
    # A parent on a boundary is named by its merged members, found by shard and place.
    names = partial.select("shard", F.col("boundary").alias("parent_boundary"), "node_key").join(
        merged.select("node_key", F.col("conv_id").alias("_named")), "node_key"
    )
    own = nodes.where(~edge).join(
        names.drop("node_key"), ["shard", "parent_boundary"], "left"
    ).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_named"))
    return own.select(*columns).unionByName(shared)
