"""Prefix trie of conversations, built as a burst trie.

A conversation is the sequence of its turns; a turn is the 64-bit hash of its
role and text with the size of its text, so no text is shuffled.  Equal
conversations become one entry of the trie, found by a range sort that may cut
a large group of copies anywhere.

Entries start in one suffix container below the root.  A container of more than
``container_turns`` turns bursts: its prefix becomes a trie head, and its entries
go to containers of the next turn id.  How large the containers of all prefixes
are is counted for several depths at once, more in each round, so the number of
rounds grows with the logarithm of the depth of the heads.  The containers that
remain are dealt out to shards, sorted there, and swept once with a stack of open
nodes; a node is finished when the sweep leaves it, and its children wait for its
smallest member.  Heads get their sums from the containers and heads below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import quoted
from variantflow.sources.scratch import written

#: turns below a prefix from which on it is a trie head
CONTAINER_TURNS = 20_000
#: heads that are broadcast; more are joined by a shuffle
BROADCAST_HEADS = 200_000
#: keys whose text is handed on at once
CHUNK_KEYS = 4096
#: depths that the first round looks at
FIRST_DEPTHS = 4

SEQUENCE = "ids array<long>, sizes array<long>"
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_sequences(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, turns) of each conversation: an array of (id, size) in the order of ``turn``.

    NULL turn numbers come first; a NULL role or text is an empty one.  Turns of
    the same number are ordered by their ids, which are hashes of role and text,
    so a repeated row stands beside its like.  Rows without a key belong to no
    conversation.  Other columns are ignored.  A conversation is one row of 16
    bytes for each turn.
    """
    role_, text_ = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (role, text))
    cells = F.struct(
        F.col(quoted(turn)).cast("long").alias("turn"),
        F.xxhash64(role_, F.octet_length(role_), text_).alias("id"),
        F.octet_length(text_).cast("long").alias("size"),
    )
    narrow = turns.select(F.col(quoted(key)).cast("long").alias(key), cells.alias("cell"))
    ordered = narrow.where(F.col(quoted(key)).isNotNull()).groupBy(quoted(key)).agg(
        F.sort_array(F.collect_list("cell")).alias("turns")
    )
    return ordered.withColumn("turns", F.transform("turns", lambda c: F.struct(c["id"], c["size"])))


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[int]]]:
    yield from zip(batch.column("ids").to_pylist(), batch.column("sizes").to_pylist())


class _Rows:
    """Columns of rows that are given out in batches."""

    def __init__(self, fields: list[tuple[str, pa.DataType]]):
        self.schema = pa.schema(fields)
        self.columns: list[list] = [[] for _ in fields]

    def add(self, *cells) -> int:
        """The row's number."""
        for column, cell in zip(self.columns, cells):
            column.append(cell)
        return len(self.columns[0]) - 1

    def __len__(self) -> int:
        return len(self.columns[0])

    def take(self) -> pa.RecordBatch:
        columns, self.columns = self.columns, [[] for _ in self.columns]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


LONGS = pa.list_(pa.int64())
ENTRY = [("ids", LONGS), ("sizes", LONGS), ("n", pa.int64()), ("least", pa.int64()), ("sha", pa.string())]
ENTRY_SCHEMA = f"{SEQUENCE}, n long, least long, sha string"


def _collect_copies(batches):
    """Rows (ids, sizes, key) in order to entries; those that may go on in other tasks leave in parts.

    A part has no ``sha`` but the text of its keys.
    """
    out = _Rows([*ENTRY, ("part", pa.string())])
    held: list[list[int]] = [[]]
    last = sizes = None
    first_group = True

    def part(keys):
        out.add(last, sizes, len(keys), keys[0], None, ",".join(map(str, keys)))

    def leave(whole: bool):
        if whole:
            text = ",".join(",".join(map(str, keys)) for keys in held)
            found = hashlib.sha256(text.encode()).hexdigest()
            out.add(last, sizes, sum(map(len, held)), held[0][0], found, None)
        else:
            for keys in filter(None, held):
                part(keys)

    streamed = False
    for batch in batches:
        keys = batch.column("key").to_pylist()
        for (ids, size), key in zip(_sequences(batch), keys):
            if ids != last:
                if last is not None:
                    leave(not first_group and not streamed)
                    first_group = False
                last, sizes, held, streamed = ids, size, [[]], False
            elif len(held[-1]) == CHUNK_KEYS:
                if first_group or streamed or len(held) >= 64:
                    # a group that fills the task is not held
                    leave(False)
                    held, streamed = [[]], True
                else:
                    held.append([])
            held[-1].append(key)
            if len(out) >= 1000:
                yield out.take()
    if last is not None:
        leave(False)
    yield out.take()


def _join_parts(batches):
    """Parts (ids, sizes, n, least, part) in order to entries.  The text is hashed as it comes."""
    out = _Rows(ENTRY)
    last = sizes = None
    for batch in batches:
        for (ids, size), n, least, text in zip(
            _sequences(batch), *(batch.column(c).to_pylist() for c in ("n", "least", "part"))
        ):
            if ids != last:
                if last is not None:
                    out.add(last, sizes, total, first, digest.hexdigest())
                last, sizes, total, first, digest = ids, size, 0, least, hashlib.sha256()
            else:
                digest.update(b",")
            total += n
            digest.update(text.encode())
    if last is not None:
        out.add(last, sizes, total, first, digest.hexdigest())
    yield out.take()


def _entries(sequences: DataFrame, key: str, partitions: int) -> DataFrame:
    """(ids, sizes, n, least, sha): each different sequence with its count, smallest key and hash of keys."""
    rows = sequences.select(
        F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"), F.col(quoted(key)).alias("key")
    )
    dealt = rows.repartitionByRange(partitions, "ids", "key").sortWithinPartitions("ids", "key")
    found = written(dealt.mapInArrow(_collect_copies, f"{ENTRY_SCHEMA}, part string"), "trie-copies")
    parts = found.where("part IS NOT NULL").drop("sha")
    parts = parts.repartition(partitions, "ids").sortWithinPartitions("ids", "least")
    joined = written(parts.mapInArrow(_join_parts, ENTRY_SCHEMA), "trie-joined")
    return found.where("part IS NULL").drop("part").unionByName(joined)


def _prefix(depth) -> F.Column:
    return F.slice("ids", F.lit(1), depth)


def _small(heads: DataFrame) -> DataFrame:
    """Marked for a broadcast where their number allows it."""
    return F.broadcast(heads) if heads.limit(BROADCAST_HEADS + 1).count() <= BROADCAST_HEADS else heads


def _burst(entries: DataFrame, container_turns: int) -> tuple[DataFrame, list[DataFrame]]:
    """(entries with the depth ``t`` of their container's prefix, heads of each round).

    Entries that end at a head are in no container; the head has their hash.
    """
    alive = entries.withColumn("t", F.lit(0))
    settled, rounds = [], []
    depths = FIRST_DEPTHS
    while True:
        length = F.size("ids")
        looked = alive.withColumn("d", F.explode(F.sequence("t", F.least(F.col("t") + depths - 1, length))))
        looked = looked.withColumn("prefix", _prefix(F.col("d")))
        found = looked.groupBy("prefix").agg(
            F.count("*").alias("entries"),
            F.sum(length - F.col("d") + 1).alias("weight"),
            F.sum("n").alias("n_convs"),
            F.min("least").alias("conv_id"),
            F.max(F.when(F.col("d") > 0, F.get("sizes", F.col("d") - 1)).otherwise(0)).alias("size"),
            F.max(F.when(length == F.col("d"), F.col("sha"))).alias("sha"),
        )
        heads = written(found.where((F.col("entries") > 1) & (F.col("weight") > container_turns)), "trie-heads")
        if heads.isEmpty():
            settled.append(alive)
            break
        rounds.append(heads)
        below = looked.select("ids", "d", "prefix").join(_small(heads.select("prefix")), "prefix", "left_semi")
        below = below.groupBy("ids").agg((F.max("d") + 1).alias("next"))
        moved = alive.join(below, "ids", "left").withColumn("before", F.col("t"))
        moved = moved.withColumn("t", F.coalesce("next", "t")).where(F.size("ids") >= F.col("t"))
        moved = written(moved.withColumn("open", F.col("t") == F.col("before") + depths).drop("next", "before"), "trie-burst")
        settled.append(moved.where("NOT open").drop("open"))
        alive = moved.where("open").drop("open")
        if alive.isEmpty():
            break
        depths *= 2
    out = settled[0]
    for df in settled[1:]:
        out = out.unionByName(df)
    return out, rounds


NODE = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("sha", pa.string()),
]
NODE_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, sha string"
)


class _Open:
    """A node that the sweep is in."""

    __slots__ = ("size", "least", "n", "children", "leaves", "saved", "sha", "waiting")

    def __init__(self, size: int):
        self.size, self.least, self.n, self.children, self.leaves, self.saved = size, None, 0, 0, 0, 0
        self.sha = NOTHING
        #: numbers of the rows that want this node's smallest member
        self.waiting: list[int] = []


def _sweep(batches):
    """Entries of containers, sorted, to nodes.  ``top`` is the prefix of a container's first node."""
    out = _Rows([*NODE, ("top", LONGS)])
    stack: list[_Open] = []
    last: list[int] = []
    top = 0

    def close() -> None:
        node = stack.pop()
        if not node.children:
            node.leaves = 1
        node.saved += (node.n - 1) * node.size
        depth = top + len(stack)
        row = out.add(
            node.least, depth, None, node.n, node.children, node.leaves, node.saved, node.sha,
            None if stack else last[:top],
        )
        parents = out.columns[2]
        for child in node.waiting:
            parents[child] = node.least
        if stack:
            above = stack[-1]
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
            above.waiting.append(row)

    for batch in batches:
        rows = zip(_sequences(batch), *(batch.column(c).to_pylist() for c in ("t", "n", "least", "sha")))
        for (ids, sizes), t, n, least, sha in rows:
            common = 0
            for x, y in zip(ids, last):
                if x != y:
                    break
                common += 1
            if stack and (common < t or t != top):
                while stack:
                    close()
            while stack and len(stack) > common - top + 1:
                close()
            if not stack:
                if len(out) >= 10_000:
                    yield out.take()
                top = t
                stack.append(_Open(sizes[t - 1] if t else 0))
            for size in sizes[top + len(stack) - 1 :]:
                stack.append(_Open(size))
            node = stack[-1]
            node.n += n
            node.sha = sha
            node.least = least if node.least is None else min(node.least, least)
            last = ids
    while stack:
        close()
    yield out.take()


def prefix_trie(
    sequences: DataFrame, key: str = "conv_id", container_turns: int = CONTAINER_TURNS
) -> DataFrame:
    """The nodes of the trie of ``sequences``: (key, turns) as :func:`turn_sequences` gives them.

    A node is a different sequence of first turns, from the empty one (depth 0);
    its members are the sequences that start with it.  Per node: ``conv_id``, its
    smallest member; ``depth``; ``parent_conv_id``, NULL for the root;
    ``n_convs``; ``n_children``; ``n_leaves``, the childless nodes of its subtree;
    ``saved_tokens``, summed over its subtree, one less than a node's members
    times the size of its last turn; ``ends_sha256``, the hash of the keys of the
    sequences that end at it, ascending and joined by commas.

    Keys are different and not NULL.  A NULL array of turns is an empty one, whose
    key ends at the root.  Without sequences there is no node.
    """
    spark = sequences.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = F.array().cast("array<struct<id:long,size:long>>")
    entries = _entries(sequences.withColumn("turns", F.coalesce("turns", none)), key, partitions)
    settled, rounds = _burst(entries, container_turns)
    dealt = settled.withColumn("prefix", _prefix(F.col("t"))).repartition(partitions, "prefix")
    swept = dealt.sortWithinPartitions("ids").mapInArrow(_sweep, f"{NODE_SCHEMA}, top array<long>")
    nodes = written(swept, "trie-nodes")
    if not rounds:
        return _told(nodes.drop("top"))
    heads = rounds[0]
    for df in rounds[1:]:
        heads = heads.unionByName(df)
    return _told(_with_heads(nodes, heads))


def _with_heads(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes of containers and heads, joined to each other."""
    def above(prefix: str, least: int):
        """Prefixes of a prefix, from the empty one on, that are shorter by ``least``."""
        return F.transform(
            F.sequence(F.lit(0), F.size(prefix) - least), lambda d: F.slice(prefix, F.lit(1), d)
        )

    tops = nodes.where("top IS NOT NULL")
    given = tops.select(
        F.explode(above("top", 1)).alias("prefix"), F.size("top").alias("of"), "n_leaves", F.col("saved")
    )
    own = ((F.col("n_convs") - 1) * F.col("size")).alias("saved")
    given = given.unionByName(
        heads.select(
            F.explode(above("prefix", 0)).alias("p"), F.size("prefix").alias("of"), F.lit(0).alias("n_leaves"), own
        ).withColumnRenamed("p", "prefix")
    )
    sums = given.groupBy("prefix").agg(
        F.count_if(F.col("of") == F.size("prefix") + 1).alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
    )
    parents = heads.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv"))
    parents = _small(parents)
    shorter = lambda c: F.when(F.size(c) > 0, F.slice(c, F.lit(1), F.size(c) - 1))
    inner = heads.join(sums, "prefix").withColumn("parent", shorter("prefix")).join(parents, "parent", "left")
    inner = inner.select(
        "conv_id", F.size("prefix").cast("long").alias("depth"), F.col("parent_conv").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved", F.coalesce("sha", F.lit(NOTHING)).alias("sha"),
    )
    hung = tops.withColumn("parent", shorter("top")).join(parents, "parent", "left")
    hung = hung.withColumn("parent_conv_id", F.col("parent_conv")).select(*inner.columns)
    return nodes.where("top IS NULL").drop("top").unionByName(hung).unionByName(inner)


def _told(nodes: DataFrame) -> DataFrame:
    return nodes.withColumnsRenamed({"saved": "saved_tokens", "sha": "ends_sha256"})
