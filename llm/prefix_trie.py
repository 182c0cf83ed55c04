"""The prefix trie of conversations by truncation peeling.

A conversation is the chain of its turns: each turn adds a digest of everything up to it, so equal prefixes have equal digests. Equal
conversations become one row first. Rows are then put in the order of their chains, where all members of a node lie side by side, and
cut into ranges. A task peels its range: from the greatest depth down it merges conversations that end there with the nodes that
survived, finishes them, strips their last turn and regroups them under their parents, adding up all figures on the way. Only
nodes on a range's first or last chain may have members elsewhere: these stay open, and their sums so far are rows of the next
round, over far fewer and wider ranges, until one range holds all. So a few jobs do, however deep conversations are, and a node that has a third of all
conversations is spread over many tasks.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventwin.sources.sinks import staged
from llm.lookup import looked_up

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Bytes of a turn's digest, and rows of a range.
DIGEST, RANGE_ROWS = 16, 20_000
#: Bytes of joined ids that are passed on at once to the digest of a node's ended conversations.
CHUNK = 1_000_000

CHAINS = "conv_id bigint, node binary, chain binary, words array<bigint>"
ROWS = "chain binary, words array<bigint>, least bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string"
NODES = ("node binary, parent binary, open boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
         "n_leaves bigint, saved_tokens bigint, ends_sha256 string")


def rebuilt(conversations: DataFrame, *, family: int = 20, most: int = 4) -> DataFrame:
    """conv_id, turns (array of turn, role, text): the first h turns of conversation c - c % family, then c's own after its first h.

    h is the CRC-32 of the decimal c modulo `most`; % keeps the sign of c. Turns go by turn (null first), then role and text.
    """
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = conversations.where("conv_id is not null").groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    first = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first"))
    met = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(first, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    none = F.slice("turns", 1, 0)
    return met.select("conv_id", F.concat(F.coalesce(F.slice("first", F.lit(1), h), none), F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def _chains(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, turns) to conv_id, node (last digest), chain (all digests) and the words of each turn."""
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for conv, turns in zip(*batch.columns):
            chain, last, words = [], b"", []
            for turn in turns.as_py():
                role, text = turn["role"].encode("utf-8", "surrogatepass"), turn["text"].encode("utf-8", "surrogatepass")
                # the role's length keeps role and text apart
                last = hashlib.blake2b(b"%s%d %s%s" % (last, len(role), role, text), digest_size=DIGEST).digest()
                chain.append(last)
                words.append(sum(1 for _ in WORD.finditer(turn["text"])))
            for column, value in zip(columns, (conv.as_py(), last, b"".join(chain), words)):
                column.append(value)
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "node", "chain", "words"])


def _joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by node and conv_id to rows (node, chain, words, least, amount, ids): each node's ids, comma-joined, in chunks."""
    names = ["node", "chain", "words", "least", "amount", "ids"]
    kinds = [pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
    node, row, ids, size = None, None, [], 0

    def told(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)], names)

    for batch in batches:
        done = []
        for conv, key, chain, words in zip(*batch.columns):
            conv, key = conv.as_py(), key.as_py()
            if ids and (key != node or size >= CHUNK):
                done.append((*row, len(ids), ",".join(ids)))
                ids, size = [], 0
            if not ids:
                node, row = key, (key, chain.as_py(), words.as_py(), conv)
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield told(done)
    if ids:
        yield told([(*row, len(ids), ",".join(ids))])


def _ended(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks by node and least id to one row for each node, in the shape that is peeled."""
    names, node, row, digest, amount = [f.split()[0] for f in ROWS.split(", ")], None, None, None, 0

    def told(rows: list) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.list_(pa.int64()), *[pa.int64()] * 5, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 8, kinds)], names)

    closed = lambda: (*row, amount, 0, 0, 0, digest.hexdigest())
    for batch in batches:
        done = []
        for key, chain, words, least, count, ids in zip(*batch.columns):
            if (key := key.as_py()) != node or digest is None:
                if digest is not None:
                    done.append(closed())
                node, row, digest, amount = key, (chain.as_py(), words.as_py(), least.as_py()), hashlib.sha256(), 0
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
            amount += count.as_py()
        yield told(done)
    if digest is not None:
        yield told([closed()])


def ended(chains: DataFrame) -> DataFrame:
    """One row for each distinct conversation, with the number, the smallest id and the digest of all ids of those equal to it.

    The ids of one node are joined in many tasks, range by range; only their digest reads them in order, a chunk at a time.
    """
    ordered = chains.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = ordered.mapInArrow(_joined_ids, "node binary, chain binary, words array<bigint>, least bigint, amount bigint, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "least").mapInArrow(_ended, ROWS)


class _Node:
    """What is known of a node so far: figures of its members that ended in it, of its finished children and of those below them."""

    __slots__ = ("chain", "words", "least", "n_convs", "n_children", "n_leaves", "saved", "ends", "children")

    def __init__(self, chain: bytes, words: list):
        self.chain, self.words, self.least, self.ends, self.children = chain, words, None, None, []
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0

    def add(self, least, n_convs, n_children, n_leaves, saved, ends) -> None:
        if least is not None:
            self.least = least if self.least is None else min(self.least, least)
        self.n_convs += n_convs
        self.n_children += n_children
        self.n_leaves += n_leaves
        self.saved += saved
        self.ends = self.ends or ends


def peel(rows: list[tuple], whole: bool) -> Iterator[tuple[tuple | None, tuple | None]]:
    """Yields (finished node, None) and (None, row of an open node) for rows whose chains lie side by side.

    With `whole` there are no rows elsewhere, so nothing stays open.
    """
    spines = () if whole or not rows else (min(r[0] for r in rows), max(r[0] for r in rows))
    by_depth: dict[int, list[tuple]] = {}
    for row in rows:
        by_depth.setdefault(len(row[0]) // DIGEST, []).append(row)
    survivors: list[_Node] = []  # finished nodes one turn deeper
    for depth in range(max(by_depth, default=-1), -1, -1):
        size, here = depth * DIGEST, {}
        for chain, words, *figures in by_depth.pop(depth, []):
            here.setdefault(chain, _Node(chain, words)).add(*figures)
        for child in survivors:  # their last turn is stripped
            parent = here.setdefault(chain := child.chain[:size], _Node(chain, child.words[:depth]))
            parent.add(child.least, child.n_convs, 1, child.n_leaves, child.saved, None)
            parent.children.append(child)
        survivors = []
        for chain, node in here.items():
            is_open = any(s[:size] == chain for s in spines)
            for child in node.children:
                yield _told(child, None if is_open else node.least, is_open), None
            node.children = []
            if is_open:
                yield None, (chain, node.words, node.least, node.n_convs, node.n_children, node.n_leaves, node.saved, node.ends)
                continue
            if not node.n_children:
                node.n_leaves = 1
            node.saved += (node.n_convs - 1) * (node.words[-1] if depth else 0)
            survivors.append(node)
    for root in survivors:
        yield _told(root, None, False), None


def _told(node: _Node, parent_conv: int | None, parent_open: bool) -> tuple:
    depth = len(node.chain) // DIGEST
    parent = node.chain[-2 * DIGEST:-DIGEST] if depth else None
    ends = node.ends or hashlib.sha256(b"").hexdigest()
    return (node.chain[-DIGEST:], parent, parent_open, node.least, depth, parent_conv, node.n_convs, node.n_children, node.n_leaves, node.saved, ends)


def _peeled(whole: bool):
    """Rows of a range to nodes, and open rows in columns of their own."""
    nodes, rows = ([f.split() for f in s.split(", ")] for s in (NODES, ROWS))
    types = {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
        some: list[tuple] = []

        def told() -> pa.RecordBatch:
            fields = [pa.field(n, types[k]) for n, k in nodes], [pa.field(n, types[k]) for n, k in rows]
            columns = []
            for side, of in enumerate(fields):
                dicts = [None if s[side] is None else dict(zip([f.name for f in of], s[side])) for s in some]
                columns.append(pa.array(dicts, pa.struct(of)))
            return pa.RecordBatch.from_arrays(columns, ["done", "left"])

        for one in peel(held, whole):
            some.append(one)
            if len(some) == 10_000:
                yield told()
                some = []
        if some:
            yield told()

    return work


def trie(conversations: DataFrame, *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; rows without a conv_id take no part; repeated rows are turns each; ties of `turn` go by role, then
    text. Negative ids belong to the family towards zero, as SQL's remainder has it. Whole texts count. Extra columns are ignored. A
    rebuilt conversation is one row, so one task holds its turns. A conversation left without turns is a member of the root. An empty
    table has no nodes, not even a root.
    """
    chains = rebuilt(conversations).mapInArrow(_chains, CHAINS)
    left, finished = staged(ended(chains), "ended"), []
    while True:
        told = left.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("words")).alias("deepest")).collect()[0]
        # a range leaves at most two rows for each depth, so ranges are wide enough to leave a fraction of what they get
        ranges = math.ceil(told.n / max(range_rows, 8 * ((told.deepest or 0) + 1)))
        whole = ranges <= 1
        dealt = left.repartition(1) if whole else left.repartitionByRange(ranges, "chain")
        peeled = staged(dealt.mapInArrow(_peeled(whole), f"done struct<{_fields(NODES)}>, left struct<{_fields(ROWS)}>"), "peeled")
        finished.append(peeled.where("done is not null").select("done.*"))
        if whole:
            break
        left = peeled.where("left is not null").select("left.*")
    nodes = finished[0]
    for more in finished[1:]:
        nodes = nodes.unionByName(more)
    columns = [f.split()[0] for f in NODES.split(", ")][3:]
    known = nodes.where("not open").select(*columns)
    if len(finished) == 1:
        return known
    # children of nodes that stayed open for a round, and those nodes, which were finished later
    later = finished[1]
    for more in finished[2:]:
        later = later.unionByName(more)
    parents = later.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv"))
    orphans = looked_up(nodes.where("open"), ["parent"], parents, "node").withColumn("parent_conv_id", F.col("parent_conv"))
    return known.unionByName(orphans.select(*columns))


def _fields(schema: str) -> str:
    return ", ".join(f"{f.split(' ', 1)[0]}: {f.split(' ', 1)[1]}" for f in schema.split(", "))
