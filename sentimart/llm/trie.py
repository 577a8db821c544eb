"""Prefix trie of conversations by time-forward processing.

A node is a distinct sequence of first turns.  Its identity is a polynomial
hash of the turns' digests (modulo 2**127 - 1), which is associative: a
conversation may cross range partitions, each of which hashes its own part,
and one row a partition carries the rest over.

Totals of subtrees climb from the leaves.  Nodes are sorted by reverse
level order (Spark's external sort); each sends its totals to its parent
through a priority queue in the same order, which spills, so that they
arrive when the parent's turn comes.  This is done within shards - the
subtrees below the nodes that more than ``shard_members`` conversations
share - whose roots' totals are then summed by parent over the cluster and
climb through those shared nodes, across shards.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import intermediates, stored
from .mixing import token_count

_MODULUS = (1 << 127) - 1
_BASE = 0x2545F4914F6CDD1D8A5CD789635D2DFF
_ROOT = bytes(16)
#: members above which a node is climbed across shards, not within one
SHARD_MEMBERS = 1 << 16
#: levels that climb in one go; longer conversations climb band by band
BAND = 1 << 16
#: messages of a queue in memory
QUEUE = 1 << 16
_PIECE = 1 << 16
_NO_IDS = hashlib.sha256(b"").hexdigest()


def turn_keys(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, words, row) of the turns that have a conv_id: a
    digest of role and text and the words of the text stand for them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return stored(conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.unhex(F.md5(F.concat(F.md5(role.cast("binary")), F.md5(text.cast("binary"))).cast("binary"))).alias("key"),
        token_count(text).alias("words"), F.monotonically_increasing_id().alias("row")), "turns")


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big") % _MODULUS


_CHAINED = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()),
                      ("parent", pa.binary()), ("key", pa.binary()), ("words", pa.int64()), ("last", pa.bool_())])
_CHAINED_SQL = "part int, conv_id long, depth long, node binary, parent binary, key binary, words long, last boolean"


def _chain(batches):
    """Hashes the prefixes of each conversation's turns as far as this
    partition has them, in order."""
    part = TaskContext.get().partitionId()
    conv, depth, value = None, 0, 0
    held = None           # the last row, until it is known whether its conversation goes on
    for batch in batches:
        rows = [] if held is None else [held]
        for c, key, words in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "key", "words"))):
            if c != conv:
                if rows:
                    rows[-1][-1] = True
                conv, depth, value = c, 0, 0
            before = value
            depth, value = depth + 1, (value * _BASE + _number(key)) % _MODULUS
            rows.append([part, c, depth, value.to_bytes(16, "big"), before.to_bytes(16, "big"), key, words, False])
        held = rows.pop() if rows else None
        yield _rows(rows, _CHAINED)
    if held is not None:
        held[-1] = True
        yield _rows([held], _CHAINED)


def _rows(rows: Sequence[Sequence], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _carried(ends: list) -> tuple[dict[int, tuple[int, int, int]], set[int]]:
    """From each partition's first and last conversation: what its first one
    already has (conversation, turns, hash), by partition, and the
    partitions whose last one goes on."""
    carried, goes_on = {}, set()
    before = None                    # partition, conversation, turns and hash so far
    for r in ends:
        value, depth = int.from_bytes(r["node"], "big"), r["depth"]
        if before is not None and before[1] == r["first"]:
            carried[r["part"]] = before[1:]
            goes_on.add(before[0])
            if r["first"] == r["conv_id"]:
                value = (before[3] * pow(_BASE, depth, _MODULUS) + value) % _MODULUS
                depth += before[2]
        before = (r["part"], r["conv_id"], depth, value)
    return carried, goes_on


def _joined(carried, goes_on, last_depth):
    """Adds what earlier partitions have to the rows of conversations that
    began there."""
    schema = pa.schema([f for f in _CHAINED if f.name != "part"])

    def moved(value: bytes, turns: int, by: int) -> bytes:
        return ((by * pow(_BASE, turns, _MODULUS) + int.from_bytes(value, "big")) % _MODULUS).to_bytes(16, "big")

    def run(batches):
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for i, (part, conv) in enumerate(zip(columns["part"], columns["conv_id"])):
                depth = columns["depth"][i]
                if part in goes_on and last_depth[part] == (conv, depth):
                    columns["last"][i] = False
                if part in carried and carried[part][0] == conv:
                    _, turns, value = carried[part]
                    columns["node"][i] = moved(columns["node"][i], depth, value)
                    columns["parent"][i] = moved(columns["parent"][i], depth - 1, value)
                    columns["depth"][i] = depth + turns
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
    return run


def chained(turns: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """(conv_id, depth, node, parent, key, words, last): the turns (conv_id,
    key, words and what ``order`` reads) with their places from 1 and the
    hashes of the prefixes that end with and before them."""
    spark = turns.sparkSession
    order = [F.col("conv_id"), *order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(turns.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv_id", "key", "words")
                   .mapInArrow(_chain, _CHAINED_SQL), "chained")
    # conversations do not go back, so a partition's first is its smallest; a
    # row a partition comes to the driver
    ends = (parts.groupBy("part").agg(F.min("conv_id").alias("first"),
                                      F.max_by(F.struct("conv_id", "depth", "node"), F.struct("conv_id", "depth")).alias("end"))
            .select("part", "first", "end.*").collect())
    ends.sort(key=lambda r: r["part"])
    carried, goes_on = _carried(ends)
    last_depth = {r["part"]: (r["conv_id"], r["depth"]) for r in ends if r["part"] in goes_on}
    schema = _CHAINED_SQL.removeprefix("part int, ")
    return parts.mapInArrow(_joined(carried, goes_on, last_depth), schema)


def with_shared_heads(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Rebuilds each conversation c of ``turns`` (of ``turn_keys``): the
    first h turns of conversation c - c % group (all if fewer, none if
    absent), then its own after its first h, h being crc32(c) % most.
    Turns go by number, null first, then by their keys.  Gives (conv_id,
    own, depth, key, words), in the order of own and depth."""
    numbered = stored(chained(turns, [F.col("turn").asc_nulls_first(), F.col("key"), F.col("row")])
                      .select("conv_id", "depth", "key", "words"), "numbered")
    h = F.crc32(F.col("conv_id").cast("string")) % most
    heads = (numbered.filter((F.col("conv_id") % group == 0) & (F.col("depth") < most))
             .select(F.col("conv_id").alias("base"), "depth", "key", "words"))
    taken = (numbered.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
             .join(heads, "base").filter(F.col("depth") <= h))
    return (taken.select("conv_id", F.lit(False).alias("own"), "depth", "key", "words")
            .unionByName(numbered.filter(F.col("depth") > h)
                         .select("conv_id", F.lit(True).alias("own"), "depth", "key", "words")))


class Queue:
    """Messages (key, node, leaves, saved) in ascending order.  More than
    ``limit`` go to a sorted run in an anonymous file, which is scratch of
    this one task attempt, like the runs of Spark's own sort."""

    _FORM = struct.Struct(">q16sqq")

    def __init__(self, limit: int = QUEUE):
        self.limit, self.held, self.runs, self.spilled = limit, [], [], 0

    def push(self, message: tuple[int, bytes, int, int]) -> None:
        heapq.heappush(self.held, message)
        if len(self.held) > self.limit:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()
        for message in sorted(self.held):
            run.write(self._FORM.pack(*message))
        run.seek(0)
        self.held = []
        self.spilled += 1
        self._next(run, self.spilled)

    def _next(self, run, number: int) -> None:
        record = run.read(self._FORM.size)
        if record:
            heapq.heappush(self.runs, (self._FORM.unpack(record), number, run))
        else:
            run.close()

    def take(self, key: tuple[int, bytes]) -> Iterator[tuple[int, int]]:
        """Leaves and saved tokens of the messages for ``key``, which leave
        the queue; none may be for an earlier one."""
        while self.held or self.runs:
            from_run = not self.held or (self.runs and self.runs[0][0] < self.held[0])
            first = self.runs[0][0] if from_run else self.held[0]
            if first[:2] > key:
                return
            if first[:2] < key:
                raise ValueError("a message to a node that is not in its shard")
            if from_run:
                _, number, run = heapq.heappop(self.runs)
                self._next(run, number)
            else:
                heapq.heappop(self.held)
            yield first[2:]

    def __bool__(self) -> bool:
        return bool(self.held or self.runs)


_NODE_SQL = "node binary, parent binary, depth long, conv_id long, n_convs long, top boolean"
_TOTALS = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                     ("n_convs", pa.int64()), ("top", pa.bool_()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                     ("saved_tokens", pa.int64())])
_TOTALS_SQL = _NODE_SQL + ", n_children long, n_leaves long, saved_tokens long"


def _climbed(limit: int):
    """Totals of the nodes of whole shards, which come sorted by shard and
    reverse level order."""
    kept = ("node", "parent", "depth", "conv_id", "n_convs", "top")

    def run(batches):
        shard, queue = None, Queue(limit)
        for batch in batches:
            column = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            out = []
            for i, own in enumerate(column["own"]):
                if column["shard"][i] != shard:
                    if queue:
                        raise ValueError("messages left in a shard's queue")
                    shard = column["shard"][i]
                children, leaves, saved = (column[n][i] or 0 for n in ("got_children", "got_leaves", "got_saved"))
                depth, node = column["depth"][i], column["node"][i]
                for more_leaves, more_saved in queue.take((-depth, node)):
                    children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
                leaves, saved = leaves or 1, saved + own
                if not column["top"][i]:
                    queue.push((1 - depth, column["parent"][i], leaves, saved))
                out.append([*(column[n][i] for n in kept), children, leaves, saved])
            yield _rows(out, _TOTALS)
        if queue:
            raise ValueError("messages left in a shard's queue")
    return run


def _climb(nodes: DataFrame, received: DataFrame | None, queue: int) -> DataFrame:
    """Totals of ``nodes`` (shard, node, parent, depth, conv_id, n_convs,
    own, top), given what nodes outside their shards sent (parent,
    n_children, n_leaves, saved_tokens)."""
    if received is None:
        nothing = F.lit(None).cast("long")
        met = nodes.withColumns({"got_children": nothing, "got_leaves": nothing, "got_saved": nothing})
    else:
        met = nodes.join(received.select(
            F.col("parent").alias("node"), F.col("n_children").alias("got_children"),
            F.col("n_leaves").alias("got_leaves"), F.col("saved_tokens").alias("got_saved")), "node", "left")
    return stored(met.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "node")
                  .mapInArrow(_climbed(queue), _TOTALS_SQL), "totals")


def _sent(totals: list[DataFrame]) -> DataFrame | None:
    """What the tops of shards send to their parents, summed by parent."""
    if not totals:
        return None
    tops = totals[0]
    for more in totals[1:]:
        tops = tops.unionByName(more)
    return (tops.filter("top and depth > 0").groupBy("parent")
            .agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                 F.sum("saved_tokens").alias("saved_tokens")))


def _pieces(batches):
    """Consecutive ids of a node, comma-joined, in texts of up to 64 KB."""
    schema = pa.schema([("node", pa.binary()), ("part", pa.int32()), ("at", pa.int64()), ("ids", pa.string())])
    part, at, node, ids, size = TaskContext.get().partitionId(), 0, None, [], 0
    for batch in batches:
        out = []
        for n, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if n != node or size > _PIECE:
                if ids:
                    out.append((node, part, at, ",".join(ids)))
                    at += 1
                node, ids, size = n, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _rows(out, schema)
    if ids:
        yield _rows([(node, part, at, ",".join(ids))], schema)


def _digests(batches):
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, digest = None, None
    for batch in batches:
        out = []
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if n != node:
                if digest is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = n, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield _rows(out, schema)
    if digest is not None:
        yield _rows([(node, digest.hexdigest())], schema)


def _ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): ids are joined in sorted
    pieces where they lie; a node's digest then runs over its pieces."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (ends.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(_pieces, "node binary, part int, at long, ids string"))
    return (pieces.repartition("node").sortWithinPartitions("node", "part", "at").select("node", "ids")
            .mapInArrow(_digests, "node binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame, members: DataFrame, order: Sequence[str | Column],
                shard_members: int = SHARD_MEMBERS, band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """The nodes of the trie of conversations: (node, parent, conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256).  ``turns`` (conv_id, key, words and what ``order`` reads)
    are the members' turns, ``members`` their distinct conv_ids, which may
    have no turn.

    ``node`` and ``parent`` are hashes of the sequences; conv_id and
    parent_conv_id the smallest members of the two; n_leaves counts the
    childless nodes of the subtree, its top included; saved_tokens sums the
    words of its nodes' last turns, times the members less one;
    ends_sha256 hashes the conv_ids, ascending and comma-joined, of the
    members that end there.

    No members give no nodes, not even a root.  The nodes that more than
    ``shard_members`` conversations share climb in one task a ``band`` of
    levels: by level they are at most the members divided by that bound.
    What one queue holds in memory is bounded by ``queue``."""
    spark = turns.sparkSession
    rows = stored(chained(turns, order).drop("key"), "prefixes")
    n_members, smallest = members.agg(F.count("*"), F.min("conv_id")).first()
    nodes = (rows.groupBy("node", "parent", "depth", "words").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
             .select("node", "parent", "depth", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("own")))
    root = spark.createDataFrame([(_ROOT, None, 0, smallest, n_members, 0)] if n_members else [],
                                 "node binary, parent binary, depth long, conv_id long, n_convs long, own long")
    nodes = stored(nodes.unionByName(root), "nodes")
    shared = nodes.filter((F.col("n_convs") > shard_members) | (F.col("depth") == 0))
    # the first node of a conversation that is not shared so widely is the
    # root of its shard
    names = shared.select("node")
    tops = (rows.join(names.withColumnRenamed("node", "parent"), "parent", "left_semi")
            .join(names, "node", "left_anti").select("conv_id", F.col("node").alias("shard")))
    within = (nodes.join(names, "node", "left_anti").join(tops, "conv_id")
              .withColumn("top", (F.col("node") == F.col("shard")) | (F.col("depth") % band == 0)))
    across = (shared.withColumn("shard", F.lit(_ROOT))
              .withColumn("top", (F.col("depth") == 0) | (F.col("depth") % band == 0)))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    if deepest >= band:
        within, across = stored(within, "within"), stored(across, "across")
    totals: list[DataFrame] = []
    for number in range(deepest // band, -1, -1):
        level = (F.col("depth") / band).cast("long") == number
        for some in (within, across):
            totals.append(_climb(some.filter(level), _sent(totals), queue))
    out = totals[0]
    for more in totals[1:]:
        out = out.unionByName(more)
    last = rows.filter("last").select("node", "conv_id")
    turnless = members.select("conv_id").join(last, "conv_id", "left_anti").select(F.lit(_ROOT).alias("node"), "conv_id")
    ends = _ends(last.unionByName(turnless))
    parents = nodes.filter("depth > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    return (out.join(parents, "parent", "left").join(ends, "node", "left")
            .select("node", "parent", "conv_id", "depth",
                    F.when(F.col("depth") == 1, F.lit(smallest)).otherwise(F.col("above")).cast("long").alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256")))


def rebuilt_trie(conversations: DataFrame, group: int = 20, most: int = 4, **limits) -> DataFrame:
    """``prefix_trie`` of the conversations (conv_id, turn, role, text) as
    ``with_shared_heads`` rebuilds them; every conv_id is a member, even if
    nothing is left of it.

    Null roles and texts are empty ones; turns go by number, null first,
    and turns of one number (repeated rows too, each a turn of its own) by
    the MD5 of the MD5s of role and text; rows without a conv_id take no
    part; an empty table gives an empty result."""
    with intermediates(conversations.sparkSession):
        turns = turn_keys(conversations)
        nodes = prefix_trie(with_shared_heads(turns, group, most), turns.select("conv_id").distinct(),
                            [F.col("own"), F.col("depth")], **limits)
        return stored(nodes, "trie", keep=True)
