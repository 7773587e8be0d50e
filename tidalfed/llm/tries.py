"""Operator 13: the trie of conversation prefixes, as double arrays over prefix shards.

Texts are read once: of a turn only a digest of role and text (128 bits) and a word count are
carried on. Conversations become rows of at most ``SEGMENT`` digests, each with the identity of
the prefix before it, so a conversation of any length is no large row. Rows are range-sorted by
(prefix before, digests, conversation) and cut into shards of at most ``SHARD_TURNS`` turns.
A shard numbers its turns densely, packs BASE and CHECK arrays, and walks them for the counts
of its nodes.

Because shards are consecutive ranges, only nodes on a shard's first and last path can lie in
other shards as well. Those upper nodes are given out as parts that add up: a shard counts a
shared node's own words and its place among the children only if the node is not on the path
the shard before ended with, and takes back that path's leaf if it goes on from it. The first
shard of a task cannot see the one before; the seam between tasks is mended from the tasks'
first and last paths, one row per task. Parts are merged by node; all other nodes are whole.

Segments after the first are tries of their own, worked through from the last to the first;
the totals below a segment's start are added where the segment before ends. Ids of ending
conversations go through SHA-256 in order, in blocks, without a list of a node's members.

Null roles and texts are empty ones; turns with equal numbers come in order of their digest.
Rows without conv_id take no part. An empty table gives an empty result, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalfed.llm.common import WORD, partitions, settled
from tidalfed.operators.ordered import position
from tidalfed.operators.sizing import sized_broadcast

#: Turns taken from the start of another conversation: below this number, by crc32 of the id.
HEADS, FAMILY = 4, 20
SEGMENT = 1024
SHARD_TURNS = 65_536
IDS_PER_ROW = 4096
WIDTH = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE, PART, ENDS, SEAM = 0, 1, 2, 3
EMITTED = (
    "kind int, key binary, depth long, conv_id long, parent_key binary, parent_conv long, "
    "n_convs long, n_children long, n_leaves long, saved long, ends string, part int, "
    "shard long, first struct<path: binary, words: array<long>, keys: array<binary>, "
    "carry: array<long>>, last struct<path: binary, leaf: boolean>")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place in the conversation, digest and words of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = settled(conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast(
            "binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")), "turns")
    placed = position(turns, ["conv_id"], ["turn", "digest"], "place")
    return settled(placed.select("conv_id", (F.col("place") - 1).cast("long").alias("place"),
                                 "digest", "words"), "placed")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ids of all conversations, and their turns after the exchange of heads."""
    heads_of = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    ids = turns.select("conv_id").distinct()
    first = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS - 1))
    heads = first.withColumnRenamed("conv_id", "_base")
    given = ids.withColumns({"_base": base, "_h": heads_of}).join(heads, "_base").filter(
        F.col("place") < F.col("_h"))
    # Own turns follow the heads there are; only the first few places of a base are looked at.
    there = heads.groupBy("_base").agg(F.count("*").alias("_there"))
    own = turns.withColumns({"_base": base, "_h": heads_of}).filter("place >= _h").join(
        there, "_base", "left").withColumn(
        "place", F.col("place") - F.col("_h") + F.least("_h", F.coalesce("_there", F.lit(0))))
    columns = ["conv_id", "place", "digest", "words"]
    return ids, given.select(columns).union(own.select(columns))


def segments_of(ids: DataFrame, turns: DataFrame, segment: int) -> DataFrame:
    """conv_id, seg, path (digests), words, start and next_id (identities of the prefix before
    and, of a full segment, after it), ends (whether the conversation does)."""
    turn = F.struct("place", "digest", "words")
    rows = turns.select("conv_id", F.expr(f"cast(place div {segment} as int)").alias("seg"),
                        turn.alias("turn"))
    # Every conversation has a first segment, if an empty one.
    rows = rows.union(ids.select("conv_id", F.lit(0), F.lit(None).cast(rows.schema["turn"].dataType)))
    packed = rows.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", "seg",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"))
    line = W.partitionBy("conv_id").orderBy("seg")
    upto = line.rowsBetween(W.unboundedPreceding, W.currentRow)
    hashes = [F.bit_xor(F.xxhash64(F.lit(salt), "seg", F.md5("path"))) for salt in (1, 2)]
    identity = F.unhex(F.concat(*(F.lpad(F.hex(h.over(upto)), 16, "0") for h in hashes)))
    nothing = F.lit(bytes(WIDTH))
    full = F.octet_length("path") == segment * WIDTH
    known = packed.withColumn("_after", identity).select(
        "conv_id", "seg", "path", "words",
        F.coalesce(F.lag("_after").over(line), nothing).alias("start"),
        F.when(full, F.col("_after")).alias("next_id"),
        F.lead("seg").over(line).isNull().alias("ends"))
    return settled(known, "segments")


class DoubleArray:
    """BASE and CHECK of a trie; slot 0 is its top, and a child stands at BASE + turn id."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """``codes``: the dense ids of all paths, one path after another."""
        span = int(codes.max()) + 1 if len(codes) else 1
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -1)
        self.used, self.free = np.ones(1, bool), 1
        at = np.zeros(len(starts), np.int64)
        for depth in range(int(sizes.max()) if len(sizes) else 0):
            rows = np.flatnonzero(sizes > depth)
            pairs, back = np.unique(at[rows] * span + codes[starts[rows] + depth],
                                    return_inverse=True)
            at[rows] = self._place(pairs // span, pairs % span)[back]

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1)])
            self.used = np.concatenate([self.used, np.zeros(more, bool)])

    def _place(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of the children (parent, code), which come sorted; sets BASE and CHECK."""
        slots = np.empty(len(codes), np.int64)
        edges = np.flatnonzero(np.diff(parents, prepend=-1))
        counts = np.diff(np.append(edges, len(codes)))
        for first, count in zip(edges[counts > 1].tolist(), counts[counts > 1].tolist()):
            offsets = codes[first:first + count] - codes[first]
            slots[first:first + count] = self._fit(offsets)
            self._take(slots[first:first + count])
        single = edges[counts == 1]
        short = len(single) - np.count_nonzero(~self.used[self.free:])
        if short > 0:
            self._grow(len(self.used) + short)
        free = np.flatnonzero(~self.used[self.free:])[:len(single)] + self.free
        slots[single] = free
        self._take(free)
        if len(free):
            self.free = int(free[-1]) + 1
        self.base[parents[edges]] = slots[edges] - codes[edges]
        self.check[slots] = parents
        return slots

    def _take(self, slots: np.ndarray) -> None:
        self.used[slots] = True

    def _fit(self, offsets: np.ndarray) -> np.ndarray:
        """The first of some free places where all children fit, or behind everything."""
        self._grow(self.free + 64 + int(offsets[-1]) + 1)
        for first in (np.flatnonzero(~self.used[self.free:self.free + 256]) + self.free)[:32]:
            slots = first + offsets
            if slots[-1] < len(self.used) and not self.used[slots].any():
                return slots
        taken = np.flatnonzero(self.used)
        first = int(taken[-1]) + 1
        self._grow(first + int(offsets[-1]) + 1)
        return first + offsets

    def step(self, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Children of nodes by turn id; -1 where there is none."""
        slots = self.base[at] + codes
        inside = (slots > 0) & (slots < len(self.check))
        return np.where(inside & (self.check[np.where(inside, slots, 0)] == at), slots, -1)


class Shard:
    """Some consecutive sorted rows of one level and the counts of their trie's nodes."""

    def __init__(self, rows: list[dict], level: int, segment: int, before: dict | None):
        self.rows, self.segment, self.level = rows, segment, level
        # Paths as lists of digests; the prefix before them is the first step of each.
        paths = [[b"^" + r["start"], *np.frombuffer(r["path"], f"V{WIDTH}").tolist()]
                 for r in rows]
        self.sizes = np.array([len(p) for p in paths])
        self.starts = np.cumsum(self.sizes) - self.sizes
        codes = np.empty(int(self.sizes.sum()), np.int64)
        dense: dict[bytes, int] = {}
        for depth in range(int(self.sizes.max())):  # siblings get neighbouring ids
            for i in np.flatnonzero(self.sizes > depth).tolist():
                codes[self.starts[i] + depth] = dense.setdefault(paths[i][depth], len(dense))
        self.paths = paths
        self.array = DoubleArray(codes, self.starts, self.sizes)
        self._count(codes)
        self._settle(before)

    def _count(self, codes: np.ndarray) -> None:
        """Walk all paths at once: members, smallest member, words and depth of the nodes."""
        slots = len(self.array.used)
        convs = np.array([r["conv_id"] for r in self.rows], np.int64)
        words = np.zeros(len(codes), np.int64)
        for start, r in zip(self.starts.tolist(), self.rows):
            words[start + 1:start + 1 + len(r["words"])] = r["words"]
        self.convs, self.nodes = convs, np.empty(len(codes), np.int64)
        self.members = np.zeros(slots, np.int64)
        self.least = np.full(slots, np.iinfo(np.int64).max)
        self.words, self.depth = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        at = np.zeros(len(self.rows), np.int64)
        for depth in range(int(self.sizes.max())):
            rows = np.flatnonzero(self.sizes > depth)
            cells = self.starts[rows] + depth
            at[rows] = here = self.array.step(at[rows], codes[cells])
            self.nodes[cells] = here
            np.add.at(self.members, here, 1)
            np.minimum.at(self.least, here, convs[rows])
            self.words[here], self.depth[here] = words[cells], depth + 1
        self.last_nodes = at

    def _settle(self, before: dict | None) -> None:
        """Children, leaves and saved words below each node, as parts that add up."""
        check, rows = self.array.check, self.rows
        every = np.flatnonzero(self.members)
        owned = np.ones(len(check), bool)
        first = self.path_nodes(0)
        shared = 0
        if before is not None:
            shared = common(before["steps"], self.paths[0])
            owned[first[:shared]] = False
        children, leaves = (np.zeros(len(check), np.int64) for _ in range(2))
        saved = self.members * self.words - np.where(owned, self.words, 0)
        below = every[(check[every] > 0) & owned[every]]
        np.add.at(children, check[below], 1)
        has_child = np.zeros(len(check), bool)
        has_child[check[every]] = True
        self.carried = np.zeros(len(check), bool)
        for i, r in enumerate(rows):  # one entry per node: rows of a node agree
            node = self.last_nodes[i]
            if r["carry"] is not None and not self.carried[node]:
                self.carried[node] = True
                if owned[node]:
                    children[node] += r["carry"][0]
                    leaves[node] += r["carry"][1]
                    saved[node] += r["carry"][2]
        leaf = every[~has_child[every] & ~self.carried[every]]
        leaves[leaf] += 1
        if before is not None and before["leaf"] and shared == len(before["steps"]):
            leaves[first[shared - 1]] -= 1  # counted there, but it goes on here
        order = every[np.argsort(-self.depth[every], kind="stable")]
        edges = np.flatnonzero(np.diff(self.depth[order], prepend=-1))
        for start, end in zip(edges, [*edges[1:], len(order)]):
            nodes = order[start:end]
            up = nodes[check[nodes] > 0]
            np.add.at(leaves, check[up], leaves[up])
            np.add.at(saved, check[up], saved[up])
        self.children, self.leaves, self.saved, self.every = children, leaves, saved, every

    def path_nodes(self, row: int) -> np.ndarray:
        return self.nodes[self.starts[row]:self.starts[row] + self.sizes[row]]

    def keys_along(self, row: int) -> list[bytes]:
        """Identity of each node on a row's path, the same in every shard."""
        r, out = self.rows[row], []
        digest = hashlib.md5(r["start"])
        for step in self.paths[row]:
            if not out:
                out.append(r["start"])
                continue
            digest.update(step)
            out.append(digest.digest())
        if r["next_id"] is not None:
            out[-1] = r["next_id"]
        return out

    def end(self) -> dict:
        """What the next shard has to know."""
        last = len(self.rows) - 1
        node = self.last_nodes[last]
        return {"steps": self.paths[last],
                "leaf": bool(not self.carried[node])}

    def emitted(self, part: int, number: int) -> Iterator[pa.RecordBatch]:
        last = len(self.rows) - 1
        keys: dict[int, bytes] = {}
        for row in {0, last}:
            keys.update(zip(self.path_nodes(row).tolist(), self.keys_along(row)))
        # The node a full segment ends at is named too: the next segment's nodes hang on it,
        # as those of this one do on their start.
        for i, r in enumerate(self.rows):
            if r["next_id"] is not None:
                keys[int(self.last_nodes[i])] = r["next_id"]
            keys[int(self.nodes[self.starts[i]])] = r["start"]
        nodes = self.every
        parents = self.array.check[nodes]
        listed = nodes.tolist()
        named = [keys.get(n) for n in listed]
        ends = self._ends(keys)
        n = len(nodes)
        parent_conv = np.where(parents > 0, self.least[parents], 0)
        parent_named = [keys.get(p) for p in parents.tolist()]
        whole = [k is None for k in named]
        depth = self.level * self.segment + self.depth[nodes] - 1
        yield batch_of({
            "kind": [NODE if w else PART for w in whole], "key": named, "depth": depth,
            "conv_id": self.least[nodes], "parent_key": parent_named,
            "parent_conv": pa.array(parent_conv, mask=np.array(
                [k is not None or p <= 0 for k, p in zip(parent_named, parents.tolist())])),
            "n_convs": self.members[nodes], "n_children": self.children[nodes],
            "n_leaves": self.leaves[nodes], "saved": self.saved[nodes],
            "ends": [ends.get(m, NO_ENDS) if w else None for m, w in zip(listed, whole)]}, n)
        blocks = [(keys[m], at // IDS_PER_ROW, ",".join(map(str, ids[at:at + IDS_PER_ROW])))
                  for m, ids in ends.items() if m in keys
                  for at in range(0, len(ids), IDS_PER_ROW)]
        if blocks:
            yield batch_of({
                "kind": [ENDS] * len(blocks), "key": [b[0] for b in blocks],
                "ends": [b[2] for b in blocks], "part": [part] * len(blocks),
                "shard": [(number << 32) + b[1] for b in blocks]}, len(blocks))

    def _ends(self, keys: dict[int, bytes]) -> dict[int, str | list[int]]:
        """Ids ending at each node: a digest where the node is whole, else the ids."""
        found: dict[int, list[int]] = {}
        for node, r in zip(self.last_nodes.tolist(), self.rows):
            if r["ends"]:
                found.setdefault(node, []).append(r["conv_id"])
        return {node: ids if node in keys else hashlib.sha256(
            ",".join(map(str, ids)).encode()).hexdigest() for node, ids in found.items()}

    def seam(self) -> dict:
        """The first path, for the seam to the task before."""
        node = self.last_nodes[0]
        carry = self.rows[0]["carry"] if self.carried[node] else None
        return {"path": self.rows[0]["start"] + self.rows[0]["path"],
                "words": self.rows[0]["words"], "keys": self.keys_along(0), "carry": carry}


def common(a: list[bytes], b: list[bytes]) -> int:
    """Number of steps two paths share."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def batch_of(columns: dict, n: int) -> pa.RecordBatch:
    """A batch of the emitted columns; those not given are null."""
    arrays = []
    for name, kind in KINDS.items():
        values = columns.get(name)
        if values is None:
            arrays.append(pa.nulls(n, kind))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, names=list(KINDS))


KINDS = {
    "kind": pa.int32(), "key": pa.binary(), "depth": pa.int64(), "conv_id": pa.int64(),
    "parent_key": pa.binary(), "parent_conv": pa.int64(), "n_convs": pa.int64(),
    "n_children": pa.int64(), "n_leaves": pa.int64(), "saved": pa.int64(), "ends": pa.string(),
    "part": pa.int32(), "shard": pa.int64(),
    "first": pa.struct([("path", pa.binary()), ("words", pa.list_(pa.int64())),
                        ("keys", pa.list_(pa.binary())), ("carry", pa.list_(pa.int64()))]),
    "last": pa.struct([("path", pa.binary()), ("leaf", pa.bool_())])}


def sharded(rows: DataFrame, level: int, segment: int, shard_turns: int) -> DataFrame:
    """Nodes, parts of shared nodes, ids of ends and seams of one level."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, before, first = TaskContext.get().partitionId(), 0, None, None
        held: list[dict] = []
        turns = 0

        def close() -> Shard:
            return Shard(held, level, segment, before)

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                turns += len(row["words"]) + 1
                if turns >= shard_turns:
                    shard = close()
                    first = first or shard.seam()
                    before = shard.end()
                    yield from shard.emitted(part, number)
                    held, turns, number = [], 0, number + 1
        if held:
            shard = close()
            first = first or shard.seam()
            before = shard.end()
            yield from shard.emitted(part, number)
        if first:
            steps = before["steps"]
            yield batch_of({"kind": [SEAM], "part": [part], "first": [first], "last": [
                {"path": steps[0][1:] + b"".join(steps[1:]), "leaf": before["leaf"]}]}, 1)

    order = ["start", "path", "conv_id"]
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(
        *order)
    return settled(ranged.mapInArrow(build, EMITTED), "shards")


def seams(found: DataFrame, level: int, segment: int) -> DataFrame:
    """Parts that mend the seams between tasks; one row per task is looked at."""
    line = W.orderBy("part")
    pairs = found.filter(F.col("kind") == SEAM).select("part", "first", "last").withColumn(
        "before", F.lag("last").over(line)).filter("before IS NOT NULL")

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, before = row["first"], row["before"]
                mine, theirs = (
                    [p[i:i + WIDTH] for i in range(0, len(p), WIDTH)]
                    for p in (first["path"], before["path"]))
                n = common(mine, theirs)
                if not n:
                    continue
                words = np.array([0, *first["words"]])[:n]
                saved = np.cumsum(words[::-1])[::-1].copy()
                children = np.where(np.arange(n) < n - 1, -1, 0)
                leaves = np.full(n, -1 if before["leaf"] and n == len(theirs) else 0)
                if n == len(mine) and first["carry"]:
                    children[-1] -= first["carry"][0]
                    leaves -= first["carry"][1]
                    saved -= first["carry"][2]
                yield batch_of({
                    "kind": [PART] * n, "key": first["keys"][:n],
                    "depth": level * segment + np.arange(n), "n_convs": np.zeros(n, int),
                    "n_children": children, "n_leaves": leaves, "saved": saved}, n)

    return pairs.select("first", "before").mapInArrow(mend, EMITTED)


def level_nodes(rows: DataFrame, level: int, segment: int,
                shard_turns: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Whole nodes, shared nodes merged (with key), and blocks of ending ids of one level."""
    found = sharded(rows, level, segment, shard_turns)
    parts = found.filter(F.col("kind") == PART).unionByName(seams(found, level, segment))
    merged = settled(parts.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"),
        F.max("parent_conv").alias("parent_conv"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved"))), "shared")
    return (found.filter(F.col("kind") == NODE), merged,
            found.filter(F.col("kind") == ENDS).select("key", "part", "shard", "ends"))


def end_digests(blocks: DataFrame) -> DataFrame:
    """key and SHA-256 of its ids in order: blocks are gone through one at a time."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k != key:
                    if key is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out)], names=["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends"])

    order = ["key", "part", "shard"]
    return blocks.repartition(partitions(blocks.sparkSession), "key").sortWithinPartitions(
        *order).select(*order, "ends").mapInArrow(hashed, "key binary, ends string")


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT,
                shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    segments = segments_of(*rebuilt(turns_of(conversations)), segment)
    levels = segments.agg(F.max("seg")).first()[0]
    whole, shared, blocks = [], [], []
    carry = None
    for level in range(-1 if levels is None else levels, -1, -1):
        rows = segments.filter(F.col("seg") == level)
        if carry is None:
            rows = rows.withColumn("carry", F.lit(None).cast("array<long>"))
        else:
            rows = rows.join(carry, "next_id", "left")
        nodes, merged, ends = level_nodes(
            rows.select("start", "path", "words", "next_id", "carry", "ends", "conv_id"),
            level, segment, shard_turns)
        tops = F.col("depth") == level * segment
        carry = merged.filter(tops).select(
            F.col("key").alias("next_id"), F.array("n_children", "n_leaves", "saved").alias("carry"))
        whole.append(nodes)
        shared.append(merged.filter(~tops) if level else merged)
        blocks.append(ends)
    if not whole:
        return conversations.sparkSession.createDataFrame([], RESULT)
    columns = ["key", "depth", "conv_id", "parent_key", "parent_conv", "n_convs", "n_children",
               "n_leaves", "saved", "ends"]
    upper = settled(reduce(DataFrame.union, shared), "upper")
    digests = end_digests(reduce(DataFrame.union, blocks))
    complete = upper.join(digests, "key", "left").withColumn(
        "ends", F.coalesce("ends", F.lit(NO_ENDS)))
    nodes = reduce(DataFrame.union, [n.select(columns) for n in whole]).unionByName(
        complete.select(columns))
    parents = sized_broadcast(upper.select(F.col("key").alias("_key"),
                                           F.col("conv_id").alias("_parent")))
    return nodes.join(parents, nodes["parent_key"] == parents["_key"], "left").select(
        "conv_id", "depth", F.coalesce("_parent", "parent_conv").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"))


RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string")
