"""The trie of conversations that begin alike, by adaptive radix trees over turn ids.

A turn's id is a fixed number of digest bytes of its role and text, so a conversation is a byte
key, compared as a big-endian number turn by turn. Equal keys are collapsed first. The others are
sorted by ranges, and each task builds adaptive radix trees over blocks of its range: nodes grow
through four layouts with their children, and a run without branches is one node. Only depths at
the end of a turn are nodes of the result.

A node is whole within a block unless it lies on the path of the block's first or last key. These
few go on as partial sums and are merged, block by block and then range by range, until one range
is left.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written

#: Bytes of a turn's id. Turns with equal ids count as equal: 128 bits of SHA-256.
WIDTH = 16
#: Every so many conversations share the first turns of the first of them.
FAMILY = 20
#: Turns shared are fewer than this.
SHARED = 4
#: Bytes of keys that one tree holds.
BLOCK = 8 << 20
#: Ranges that are merged at a time.
FAN = 64
#: Ids that are alike but for so many bits are hashed as one text.
ID_BITS = 16
#: Parts that the children of one open node are dealt to.
SHARDS = 64
NOTHING = hashlib.sha256(b"").hexdigest()


class Leaf(NamedTuple):
    """What a whole key stands for."""

    key: bytes
    words: list[int]
    conv_id: int
    n: int
    ends: str


class Node:
    """A compressed run of bytes, perhaps the end of a key, and the children behind it.

    Layouts by the number of children: up to 4 and up to 16 are sorted bytes beside a list, up to
    48 a table of 256 places into a list, more a list of 256.
    """

    __slots__ = ("run", "leaf", "bytes", "places", "below", "size")

    def __init__(self, run: bytes, leaf: Leaf | None = None):
        self.run, self.leaf = run, leaf
        self.bytes: bytearray | None = bytearray()
        self.places: bytearray | None = None
        self.below: list = []
        self.size = 0

    @property
    def layout(self) -> int:
        if self.bytes is not None:
            return 4 if self.size <= 4 else 16
        return 48 if self.places is not None else 256

    def child(self, byte: int) -> Node | None:
        if self.bytes is not None:
            at = bisect_left(self.bytes, byte)
            return self.below[at] if at < self.size and self.bytes[at] == byte else None
        if self.places is not None:
            at = self.places[byte]
            return self.below[at - 1] if at else None
        return self.below[byte]

    def put(self, byte: int, node: Node) -> None:
        """Set the child at ``byte``; a layout that is full grows into the next."""
        if self.child(byte) is not None:
            if self.bytes is not None:
                self.below[bisect_left(self.bytes, byte)] = node
            else:
                self.below[self.places[byte] - 1 if self.places is not None else byte] = node
            return
        if self.bytes is not None and self.size == 16:
            self.places = bytearray(256)
            for at, own in enumerate(self.bytes, start=1):
                self.places[own] = at
            self.bytes = None
        elif self.places is not None and self.size == 48:
            self.below = [self.below[at - 1] if at else None for at in self.places]
            self.places = None
        if self.bytes is not None:
            at = bisect_left(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.below.insert(at, node)
        elif self.places is not None:
            self.below.append(node)
            self.places[byte] = len(self.below)
        else:
            self.below[byte] = node
        self.size += 1

    def children(self) -> Iterator[tuple[int, Node]]:
        """With their bytes, in order."""
        if self.bytes is not None:
            return zip(self.bytes, self.below, strict=True)
        if self.places is not None:
            return ((byte, self.below[at - 1]) for byte, at in enumerate(self.places) if at)
        return ((byte, x) for byte, x in enumerate(self.below) if x is not None)


def insert(root: Node, leaf: Leaf) -> None:
    """Add a key to the tree; a run that it leaves early is split."""
    key, at, node = leaf.key, 0, root
    while True:
        run = node.run
        same = 0
        most = min(len(run), len(key) - at)
        if key[at : at + len(run)] == run:
            same = len(run)
        else:
            while same < most and run[same] == key[at + same]:
                same += 1
        if same < len(run):
            rest = Node(run[same + 1 :], node.leaf)
            rest.bytes, rest.places, rest.below, rest.size = node.bytes, node.places, node.below, node.size
            node.run, node.leaf = run[:same], None
            node.bytes, node.places, node.below, node.size = bytearray(), None, [], 0
            node.put(run[same], rest)
        at += same
        if at == len(key):
            node.leaf = leaf
            return
        nxt = node.child(key[at])
        if nxt is None:
            node.put(key[at], Node(key[at + 1 :], leaf))
            return
        node, at = nxt, at + 1


class Sums:
    """Of a node: its members and what its subtree adds up to."""

    __slots__ = ("conv_id", "n", "children", "leaves", "saved", "words", "ends", "waiting")

    def __init__(self, words: int):
        self.conv_id: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.words, self.ends = words, NOTHING
        #: Finished children that do not know yet who their parent's smallest member is.
        self.waiting: list[list] = []

    def members(self, conv_id: int, n: int) -> None:
        self.conv_id = conv_id if self.conv_id is None else min(conv_id, self.conv_id)
        self.n += n

    def adopt(self, child: Sums, row: list) -> None:
        """Add a finished child, whose sums are whole."""
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved
        self.waiting.append(row)

    def finish(self) -> None:
        self.leaves = self.leaves if self.children else 1
        self.saved += (self.n - 1) * self.words

    def row(self, depth: int) -> list:
        return [self.conv_id, depth, None, self.n, self.children, self.leaves, self.saved, self.ends]


def paths(key: bytes) -> list[bytes]:
    """A digest of each turn-aligned prefix, the empty one first."""
    chain, out = hashlib.sha256(), []
    for at in range(0, len(key) + 1, WIDTH):
        out.append(chain.digest()[:WIDTH])
        chain.update(key[at : at + WIDTH])
    return out


def spine(first: bytes, last: bytes) -> dict[bytes, tuple[bytes | None, int, bool, bool]]:
    """Open nodes of a block, by path: parent's path, depth, on the first and on the last key's path."""
    out: dict[bytes, tuple[bytes | None, int, bool, bool]] = {}
    for key, side in ((first, 2), (last, 3)):
        before = None
        for depth, path in enumerate(paths(key)):
            found = list(out.get(path, (before, depth, False, False)))
            found[side] = True
            out[path] = tuple(found)
            before = path
    return out


class Open(NamedTuple):
    """An open node with its sums so far."""

    path: bytes
    parent: bytes | None
    depth: int
    first: bool
    last: bool
    sums: Sums


def _given(rows: list[list], conv_id: int) -> list[list]:
    """Finished rows with their parent's smallest member."""
    for row in rows:
        row[2] = conv_id
    return rows


class _Made:
    """A node of the result while its tree is walked."""

    __slots__ = ("depth", "sample", "sums", "open")

    def __init__(self, depth: int, sample: Leaf, opened: bool):
        self.depth, self.sample, self.open = depth, sample, opened
        self.sums = Sums(sample.words[depth - 1] if depth else 0)


def block_nodes(leaves: list[Leaf]) -> tuple[list[list], list[Open]]:
    """Finished rows and open nodes of sorted keys, from their radix tree.

    A finished row whose parent is open waits in the sums of the parent.
    """
    root = Node(b"")
    for leaf in leaves:
        insert(root, leaf)
    first, last = leaves[0].key, leaves[-1].key
    edges = spine(first, last)
    sides = paths(first), paths(last)
    rows: list[list] = []
    opened: list[Open] = []
    # Post-order; a node hands up what it made of its topmost turn-aligned depth, or what it got.
    results: dict[int, list[_Made]] = {}
    stack: list[tuple] = [(root, 0, None, (True, True), False)]
    while stack:
        node, start, up, on, done = stack.pop()
        end = start + len(node.run)
        if not done:
            stack.append((node, start, up, on, True))
            results[id(node)] = []
            for byte, child in node.children():
                # Both keys are in the tree, so a run that one enters it passes as a whole.
                follows = tuple(
                    o and len(k) > end and k[end] == byte for o, k in zip(on, (first, last), strict=True)
                )
                stack.append((child, end + 1, node, follows, False))
            continue
        below = results.pop(id(node))
        sample = node.leaf or below[0].sample
        # Depths at the end of a turn within the run and the byte before it, lowest first.
        for at in range(end - end % WIDTH, start - 1, -WIDTH):
            own = _Made(at // WIDTH, sample, any(on))
            sums = own.sums
            if at == end and node.leaf:
                sums.members(node.leaf.conv_id, node.leaf.n)
                sums.ends = node.leaf.ends
            for child in below:
                sums.members(child.sums.conv_id, child.sums.n)
                if not child.open:
                    sums.adopt(child.sums, child.sums.row(child.depth))
            if own.open:
                path = sides[0 if on[0] else 1][own.depth]
                opened.append(Open(path, *edges[path], sums))
            else:
                sums.finish()
                rows += _given(sums.waiting, sums.conv_id)
            below = [own]
        if up is not None:
            results[id(up)] += below
    return rows, opened


class Frontier:
    """Open nodes of neighbouring ranges, merged as they come in order."""

    def __init__(self):
        self.nodes: dict[bytes, Open] = {}

    def merge(self, nodes: Iterable[Open]) -> list[list]:
        """Take in the next range; returns the rows of nodes that became whole."""
        rows: list[list] = []
        if not self.nodes:
            self.nodes = {o.path: o for o in nodes}
            return rows
        own = self.nodes
        for o in own.values():
            own[o.path] = o._replace(last=False)
        for o in nodes:
            old = own.get(o.path)
            if old is None:
                own[o.path] = o._replace(first=False)
                continue
            a, b = old.sums, o.sums
            a.members(b.conv_id, b.n)
            a.children += b.children
            a.leaves += b.leaves
            a.saved += b.saved
            a.ends = a.ends if a.ends != NOTHING else b.ends
            a.waiting += b.waiting
            own[o.path] = old._replace(last=o.last)
        return self.settle(lambda o: o.first or o.last)

    def settle(self, stays=lambda o: False) -> list[list]:
        """Finish the nodes that do not stay open, deepest first."""
        rows: list[list] = []
        for o in sorted(self.nodes.values(), key=lambda o: -o.depth):
            if stays(o):
                continue
            del self.nodes[o.path]
            o.sums.finish()
            rows += _given(o.sums.waiting, o.sums.conv_id)
            row = [*o.sums.row(o.depth), o.path]
            parent = self.nodes.get(o.parent)
            if parent:
                parent.sums.adopt(o.sums, row)
            else:
                rows.append(row)
        return rows


_FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_OPEN = ["path", "parent", "part", "words", "first", "last"]
_ROWS = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string, path binary, parent binary, part int, words long,"
    " first boolean, last boolean"
)


def _frame(rows: list[list], frontier: Frontier) -> pd.DataFrame:
    """Finished rows; those that were open once have their path, and those that wait their parent's."""
    lines = [(row, None) for row in rows]
    for o in frontier.nodes.values():
        lines += [(row, o.path) for row in o.sums.waiting]
        o.sums.waiting = []
    width = len(_FIELDS)
    return _typed([
        [*row[:width], row[width] if len(row) > width else None, parent, None, None, None, None]
        for row, parent in lines
    ])


def _handed(frontier: Frontier, part: int) -> pd.DataFrame:
    """Open nodes, for the next merge."""
    rows = [
        [*o.sums.row(o.depth), o.path, o.parent, part, o.sums.words, o.first, o.last]
        for o in frontier.nodes.values()
    ]
    return _typed(rows)


def _typed(rows: list[list]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_FIELDS + _OPEN)
    return out.astype({"parent_conv_id": "Int64", "part": "Int32", "words": "Int64"})


def _built(block: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Radix trees over blocks of sorted keys; what stays open is merged from block to block."""
        frontier, part = Frontier(), TaskContext.get().partitionId()
        leaves: list[Leaf] = []
        size = 0

        def made() -> pd.DataFrame:
            rows, opened = block_nodes(leaves)
            return _frame(rows + frontier.merge(opened), frontier)

        for batch in batches:
            for line in batch.itertuples(index=False, name=None):
                leaves.append(Leaf(*line))
                size += len(line[0]) + 200
                if size > block:
                    yield made()
                    leaves, size = [], 0
        if leaves:
            yield made()
        yield _handed(frontier, part)

    return build


def _joined(final: bool):
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Merge the open nodes of neighbouring ranges, in order."""
        frontier, part, group, nodes = Frontier(), None, None, []
        for batch in batches:
            for r in batch.itertuples(index=False):
                if group is not None and r.group != group:
                    # Another group: what the one before leaves open goes on.
                    yield _frame(frontier.merge(nodes), frontier)
                    yield _handed(frontier, group)
                    frontier, nodes, part = Frontier(), [], None
                elif part is not None and r.part != part:
                    yield _frame(frontier.merge(nodes), frontier)
                    nodes = []
                group, part = r.group, r.part
                sums = Sums(r.words)
                sums.members(r.conv_id, r.n_convs)
                sums.children, sums.leaves, sums.saved = r.n_children, r.n_leaves, r.saved_tokens
                sums.ends = r.ends_sha256
                nodes.append(Open(r.path, r.parent, r.depth, r.first, r.last, sums))
        if nodes:
            yield _frame(frontier.merge(nodes), frontier)
        if final:
            yield _frame(frontier.settle(), frontier)
        elif group is not None:
            yield _handed(frontier, group)

    return join


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its turns in order, as an array of (id, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        F.substring(F.unhex(F.sha2(both, 256)), 1, WIDTH).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    listed = F.sort_array(F.collect_list(F.struct("at", "id", "words")))
    return rows.groupBy("conv_id").agg(listed.alias("x")).select(
        "conv_id", F.transform("x", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of the first of their family."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("of"), F.slice("turns", 1, SHARED - 1).alias("head")
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    head = F.coalesce("head", F.slice("turns", 1, 0))
    own = F.slice("turns", shared + 1, F.greatest(F.size("turns"), F.lit(0)))
    return turns.join(heads, base == F.col("of"), "left").select(
        "conv_id", F.concat(F.slice(head, 1, shared), own).alias("turns")
    )


def _keys(conversations: DataFrame) -> DataFrame:
    """``key, words, conv_id, n, ends`` of each distinct rebuilt conversation."""
    key = F.coalesce(
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")), F.lit(b"")
    )
    rows = written(
        conversations.select(
            "conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words")
        ).withColumn("path", F.unhex(F.sha2("key", 256)))
    )
    one = rows.groupBy("path").agg(
        F.first("key").alias("key"), F.first("words").alias("words"),
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
    )
    # Ids of a block are so many numbers at most, whatever the number of copies.
    blocks = rows.groupBy("path", F.shiftright("conv_id", ID_BITS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")
    )

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Hash the ids of each key as they pass, block by block."""
        now, digest = None, None
        for batch in batches:
            out = []
            for path, ids in zip(batch["path"], batch["ids"], strict=True):
                if path != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = path, hashlib.sha256()
                    digest.update(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["of", "ends"])
        if now is not None:
            yield pd.DataFrame([(now, digest.hexdigest())], columns=["of", "ends"])

    ends = (
        blocks.repartition("path").sortWithinPartitions("path", "block")
        .select("path", "ids").mapInPandas(hashed, "of binary, ends string")
    )
    return one.join(ends, F.col("path") == F.col("of")).select("key", "words", "conv_id", "n", "ends")


def prefix_trie(conversations: DataFrame, *, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations, the empty one included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``: see the README for what they count.
    Turns go in the order of ``turn``, null first; ties and repeated rows are turns each, in the
    order of their ids. Null role or text counts as empty. Rows without ``conv_id`` belong to no
    conversation and are left out. An empty table gives an empty result; further columns are not
    read. A conversation's turn ids, not its texts, are held in one row.
    """
    keys = written(_keys(rebuilt(turns_of(conversations))))
    step = written(
        keys.repartitionByRange("key").sortWithinPartitions("key")
        .select("key", "words", "conv_id", "n", "ends").mapInPandas(_built(block), _ROWS)
    )
    steps = [step]
    parts = step.agg(F.max("part").alias("n")).first()["n"]
    parts = 0 if parts is None else parts + 1
    while parts:
        parts = -(-parts // fan) if parts > fan else 0
        group = F.floor(F.col("part") / F.lit(fan)).cast("int")
        step = written(
            step.where("part IS NOT NULL").withColumn("group", group)
            .repartition("group").sortWithinPartitions("group", "part")
            .mapInPandas(_joined(not parts), _ROWS)
        )
        steps.append(step)
    nodes = steps[0]
    for other in steps[1:]:
        nodes = nodes.unionByName(other)
    return _with_parents(nodes.where("part IS NULL"))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Children of nodes that were open learn who the smallest member of their parent is."""
    shard: Column = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SHARDS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1))).alias("s")
    opened = nodes.where("path IS NOT NULL").select(
        F.col("path").alias("of"), F.col("conv_id").alias("smallest"), every
    )
    columns = [F.col(c) for c in _FIELDS]
    known = nodes.where("parent IS NULL").select(*columns)
    waiting = nodes.where("parent IS NOT NULL").withColumn("shard", shard)
    found = waiting.join(opened, (F.col("parent") == F.col("of")) & (F.col("shard") == F.col("s")))
    return known.unionByName(
        found.withColumn("parent_conv_id", F.col("smallest")).select(*columns)
    )
