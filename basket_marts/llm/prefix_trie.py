"""Trie of conversation prefixes, built as double-array tries over shards of the prefixes.

Only numbers travel: a turn is a 64-bit hash of its role and text, and a prefix is the
exclusive-or of its turns' hashes, each hashed again with its depth. Conversations that are
equal throughout become one path with a weight. Three kinds of nodes are told apart:

* tails: below a depth at which a path is alone there is nothing to share; those nodes come
  from running sums, wherever their rows lie;
* owned nodes: paths are dealt to shards by their shallowest prefix (of depth 1, 2, 4, ...) that
  holds no more turns than a shard should. A shard numbers its turns densely, packs the paths
  into BASE and CHECK and walks these; what lies at or below the dealing prefix is whole there;
* upper nodes: prefixes above that, which several shards see in part. Their aggregates are
  merged by prefix, and summed over subtrees in steps of 1, 2, 4, ... levels.

A prefix or a conversation that holds a third of all rows is thus spread like any others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basket_marts.llm.common import shuffle_width, stored

# Turns to a shard at most, as far as its prefixes can be cut; a task holds some 200 bytes for each.
SHARD_TURNS = 500_000
# A conversation begins with up to five turns of the first one of its hundred.
HEADS, GROUP = 6, 100

_FREE, _ROOT = -1, -2
_WINDOW = 512


# The turns of conversations ------------------------------------------------------------


def _earlier(name: str):
    return Window.partitionBy(name).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, position, turn_key, n_chars): turns from 1 on, by turn, NULL first.

    Equal turn numbers go by the turn's hash. A NULL role or text counts as empty. Rows with a
    NULL conv_id belong to no conversation and are left out. Turns are range-partitioned by
    (conv_id, turn) and numbered within a part, so that a conversation of very many turns
    spreads over parts; what it has in earlier parts is added from at most a row per part.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("turn_key"),
        F.char_length(text).cast("bigint").alias("n_chars"),
    )
    width = shuffle_width(conversations.sparkSession)
    ranged = turns.repartitionByRange(width, "conv_id", "turn", "turn_key")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "turn-ranges")
    within = Window.partitionBy("part", "conv_id").orderBy("turn", "turn_key")
    before = (
        ranged.groupBy("conv_id", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("conv_id", "part", F.sum("n").over(_earlier("conv_id")).alias("before"))
        .where("before IS NOT NULL")
    )
    local = ranged.withColumn("local", F.row_number().over(within))
    return local.join(F.broadcast(before), ["conv_id", "part"], "left").select(
        "conv_id",
        "part",
        (F.col("local") + F.coalesce("before", F.lit(0))).cast("bigint").alias("position"),
        "turn_key",
        "n_chars",
    )


def _at_depth():
    return F.xxhash64("depth", "turn_key")


def spliced(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h turns of conversation c - c % GROUP, then the own ones
    after the first h, where h is the CRC-32 of the decimal c, modulo HEADS.

    Returns (conv_id, depth, length, turn_key, n_chars, key, chars), one row per rebuilt turn
    with the key and the code points of the prefix that it ends, and (conv_id, length) of all
    conversations, those left without turns included.
    """
    head = Window.partitionBy("conv_id").orderBy("depth")
    first_turns = numbered.where(f"conv_id % {GROUP} = 0 AND position < {HEADS}").withColumn(
        "depth", F.col("position")
    )
    heads = (
        first_turns.select(
            "conv_id",
            "depth",
            "turn_key",
            "n_chars",
            F.bit_xor(_at_depth()).over(head).alias("key"),
            F.sum("n_chars").over(head).alias("chars"),
        )
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "turn_key", "n_chars", "key", "chars"))).alias("heads"))
    )
    own = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    convs = (
        own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % GROUP, "h": h})
        .join(heads, "base", "left")
        .withColumn("lent", F.slice("heads", 1, F.col("h")))
        .withColumn("b", F.greatest(F.size("lent"), F.lit(0)))
        .select(
            "conv_id",
            "h",
            "b",
            "lent",
            (F.col("b") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length"),
            F.coalesce(F.try_element_at("lent", F.lit(-1)).getField("key"), F.lit(0)).alias("key_before"),
            F.coalesce(F.try_element_at("lent", F.lit(-1)).getField("chars"), F.lit(0)).alias("chars_before"),
        )
    )
    convs = stored(convs, "conversations")
    columns = ("conv_id", "depth", "length", "turn_key", "n_chars", "key", "chars")
    from_head = convs.select("conv_id", "length", F.inline("lent")).select(*columns)

    later = (
        numbered.where(F.col("position") > h)
        .join(convs.drop("lent"), "conv_id")
        .withColumn("depth", F.col("position") - F.col("h") + F.col("b"))
    )
    running = Window.partitionBy("part", "conv_id").orderBy("depth")
    inside = later.select(
        "conv_id",
        "part",
        "depth",
        "length",
        "turn_key",
        "n_chars",
        F.bit_xor(_at_depth()).over(running).alias("key"),
        F.sum("n_chars").over(running).alias("chars"),
        "key_before",
        "chars_before",
    )
    parts = later.groupBy("conv_id", "part").agg(
        F.bit_xor(_at_depth()).alias("key"), F.sum("n_chars").alias("chars")
    )
    carried = parts.select(
        "conv_id",
        "part",
        F.bit_xor("key").over(_earlier("conv_id")).alias("key_carried"),
        F.sum("chars").over(_earlier("conv_id")).alias("chars_carried"),
    ).where("chars_carried IS NOT NULL")
    key = F.col("key").bitwiseXOR(F.col("key_before")).bitwiseXOR(F.coalesce("key_carried", F.lit(0)))
    chars = F.col("chars") + F.col("chars_before") + F.coalesce("chars_carried", F.lit(0))
    # At most one conversation goes on from one part into the next: a row per part.
    of_own = inside.join(F.broadcast(carried), ["conv_id", "part"], "left").select(
        *columns[:5], key.alias("key"), chars.alias("chars")
    )
    return of_own.unionByName(from_head), convs.select("conv_id", "length")


# Double arrays ---------------------------------------------------------------------------


class DoubleArray:
    """A trie in two arrays: the child of state s by code c is at BASE[s] + c if CHECK there is s.

    States are slots; the root is slot 0. Codes are dense, from 0 on.
    """

    def __init__(self) -> None:
        self.base = np.zeros(_WINDOW, dtype=np.int64)
        self.check = np.full(_WINDOW, _FREE, dtype=np.int64)
        self.check[0] = _ROOT
        self._low = 1  # no slot below is free

    def _reach(self, slots: int) -> None:
        more = slots - len(self.check)
        if more > 0:
            more = max(more, len(self.check) // 2)
            self.base = np.append(self.base, np.zeros(more, dtype=np.int64))
            self.check = np.append(self.check, np.full(more, _FREE, dtype=np.int64))

    def place(self, state: int, codes: np.ndarray) -> None:
        """Give a state its children, ascending codes: at the first slots where all fit."""
        spans = codes - codes[0]
        start = self._low
        while True:
            self._reach(start + _WINDOW + int(spans[-1]) + 1)
            fits = start + np.flatnonzero(self.check[start : start + _WINDOW] == _FREE)
            for span in spans[1:].tolist():
                fits = fits[self.check[fits + span] == _FREE]
                if not len(fits):
                    break
            if len(fits):
                break
            start += _WINDOW
        at = int(fits[0])
        self.base[state] = at - codes[0]
        self.check[at + spans] = state
        while self.check[self._low] != _FREE:
            self._low += 1
            self._reach(self._low + 1)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of states by codes, all of which must be there."""
        to = self.base[states] + codes
        if len(to) and (to.max() >= len(self.check) or not (self.check[to] == states).all()):
            raise KeyError("a sequence that the trie does not hold")
        return to


def packed(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The double array of code sequences, and the state that each of their codes leads to.

    Sequence i is codes[starts[i] : starts[i] + lengths[i]]; lengths do not ascend.
    """
    trie, states = DoubleArray(), np.zeros(len(codes), dtype=np.int64)
    at = np.zeros(len(starts), dtype=np.int64)
    depth = 0
    alive = len(lengths)
    while True:
        while alive and lengths[alive - 1] <= depth:
            alive -= 1
        if not alive:
            return trie, states
        rows = starts[:alive] + depth
        own, parents = codes[rows], at[:alive]
        order = np.lexsort((own, parents))
        parent, code = parents[order], own[order]
        new = np.append(True, (parent[1:] != parent[:-1]) | (code[1:] != code[:-1]))
        parent, code = parent[new], code[new]
        cuts = np.flatnonzero(parent[1:] != parent[:-1]) + 1
        edges = [0, *cuts.tolist(), len(parent)]
        for first, last in zip(edges, edges[1:]):
            trie.place(int(parent[first]), code[first:last])
        at[:alive] = trie.step(parents, own)
        states[rows] = at[:alive]
        depth += 1


_NODES = pa.schema(
    [("upper", pa.bool_())]
    + [
        (name, pa.int64())
        for name in (
            "key", "parent_key", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
            "n_leaves", "saved_tokens", "n_chars", "end_path",
        )
    ]
)
_NODES_DDL = ", ".join(f"{f.name} {'boolean' if f.name == 'upper' else 'bigint'}" for f in _NODES)


def shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of a shard's paths: owned ones whole, upper ones as far as the shard sees them.

    Of an upper node, `n_children`, `n_leaves` and `saved_tokens` count what it has below it by
    way of owned children; its own share is not known here.
    """
    column = {n: table.column(n).to_numpy() for n in table.column_names if n != "shard"}
    order = np.lexsort((column["depth"], column["path"], -column["held"]))
    c = {name: values[order] for name, values in column.items()}
    starts = np.flatnonzero(np.append(True, c["path"][1:] != c["path"][:-1]))
    lengths = np.diff(starts, append=len(order))
    owner = np.repeat(np.arange(len(starts)), lengths)

    # Dense turn ids by first appearance, level after level, siblings side by side.
    parent_key = np.where(c["depth"] == 1, 0, np.append(0, c["key"][:-1]))
    by_level = np.lexsort((parent_key, c["depth"]))
    _, first, number = np.unique(c["turn_key"][by_level], return_index=True, return_inverse=True)
    codes = np.empty(len(order), dtype=np.int64)
    codes[by_level] = np.argsort(np.argsort(first))[number]

    trie, states = packed(codes, starts, lengths)
    n = len(trie.check)
    n_convs = np.zeros(n, dtype=np.int64)
    np.add.at(n_convs, states, c["copies"])
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, states, c["path"])
    depth, key, n_chars, dealt_at = (np.zeros(n, dtype=np.int64) for _ in range(4))
    for array, name in ((depth, "depth"), (key, "key"), (n_chars, "n_chars"), (dealt_at, "dealt_at")):
        array[states] = c[name]
    ends = states[starts + lengths - 1]
    paths, has_tail = c["path"][starts], c["length"][starts] > c["held"][starts]
    end_path, ended = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    end_path[ends[~has_tail]], ended[ends[~has_tail]] = paths[~has_tail], True
    # The root: all paths of the shard, none ends there.
    n_convs[0] = c["copies"][starts].sum()
    least[0], dealt_at[0] = paths.min(), 1

    nodes = np.flatnonzero(trie.check != _FREE)
    parent = trie.check.copy()
    owned = depth >= dealt_at
    n_children, leaves, saved = (np.zeros(n, dtype=np.int64) for _ in range(3))
    below = nodes[1:][owned[nodes[1:]]]
    np.add.at(n_children, parent[below], 1)
    n_children[ends[has_tail]] += 1
    leaves[below] = n_children[below] == 0
    leaves[ends[has_tail]] = 1
    saved[below] = (n_convs[below] - 1) * n_chars[below]
    saved[ends[has_tail]] += c["to_end"][starts + lengths - 1][has_tail]
    # From the deepest level up; what an upper node gets stays with it.
    levels = below[np.argsort(-depth[below], kind="stable")]
    for level in np.split(levels, np.flatnonzero(np.diff(depth[levels])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])

    up = parent[nodes]
    root = nodes == 0
    up[root] = 0
    values = {
        "upper": ~owned[nodes],
        "key": key[nodes],
        "parent_key": pa.array(key[up], mask=root),
        "depth": depth[nodes],
        "conv_id": least[nodes],
        "parent_conv_id": pa.array(least[up], mask=~owned[up] | root),
        "n_convs": n_convs[nodes],
        "n_children": n_children[nodes],
        "n_leaves": leaves[nodes],
        "saved_tokens": saved[nodes],
        "n_chars": n_chars[nodes],
        "end_path": pa.array(end_path[nodes], mask=~ended[nodes]),
    }
    return pa.table(values, schema=_NODES)


# Paths, shards and the nodes above them ----------------------------------------------------


def _dealt(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """`paths` with `held` (the depth below which a path is a tail), `dealt_at` and `shard`.

    Only turns at depths 1, 2, 4, ... are looked at. A path without a prefix there that is small
    enough is dealt by itself, and all its nodes are upper ones.
    """
    marks = stored(
        rows.where("depth & (depth - 1) = 0").join(paths.select("path"), rows["conv_id"] == F.col("path"))
        .select("path", "depth", "key"),
        "marks",
    )
    alone = (
        marks.groupBy("depth", "key")
        .agg(F.count(F.lit(1)).alias("n_paths"), F.min("path").alias("path"))
        .where("n_paths = 1")
        .groupBy("path")
        .agg(F.min("depth").alias("alone_at"))
    )
    held = paths.join(alone, "path", "left").withColumn("held", F.least("length", "alone_at"))
    held = stored(held, "held")
    total = held.agg(F.sum("held")).first()[0] or 0
    n_shards = max(shuffle_width(rows.sparkSession), -(-total // SHARD_TURNS))
    small = (
        marks.join(held.select("path", "held"), "path")
        .groupBy("depth", "key")
        .agg(F.sum("held").alias("turns"), F.count(F.lit(1)).alias("n_paths"))
        .where((F.col("turns") <= -(-total // n_shards)) | (F.col("n_paths") == 1))
        .select("depth", "key")
    )
    at = (
        marks.join(small, ["depth", "key"])
        .groupBy("path")
        .agg(F.min(F.struct(F.col("depth").alias("dealt_at"), F.col("key").alias("dealt_by"))).alias("at"))
        .select("path", "at.*")
    )
    by = F.coalesce("dealt_by", F.xxhash64("path"))
    return held.join(at, "path", "left").select(
        *held.columns[:-2],  # all but alone_at and held
        "held",
        F.coalesce("dealt_at", F.col("length") + 1).alias("dealt_at"),
        F.pmod(F.xxhash64(by), F.lit(n_shards)).cast("int").alias("shard"),
    )


def _merged_upper(partial: DataFrame, turnless: DataFrame) -> DataFrame:
    """The upper nodes, whole, from the shards' partial ones and the conversations without turns."""
    nothing = {f.name: F.lit(None).cast("bigint") for f in _NODES}
    at_root = nothing | {
        "upper": F.lit(True), "key": F.lit(0), "depth": F.lit(0), "n_convs": F.col("copies"),
        "conv_id": F.col("path"), "end_path": F.col("path"), "n_chars": F.lit(0),
    } | {c: F.lit(0) for c in ("n_children", "n_leaves", "saved_tokens")}
    root = turnless.select(*(v.cast("boolean" if k == "upper" else "bigint").alias(k) for k, v in at_root.items()))
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = partial.unionByName(root).groupBy("depth", "key").agg(
        F.max("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in sums),
        F.max("n_chars").alias("n_chars"),
        F.max("end_path").alias("end_path"),
    )
    merged = stored(merged, "upper")
    upper_children = (
        merged.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_key").alias("key"))
        .agg(F.count(F.lit(1)).alias("more"))
    )
    own = merged.join(upper_children, ["depth", "key"], "left").withColumns(
        {
            "n_children": F.col("n_children") + F.coalesce("more", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n_chars"),
            "n_leaves": F.col("n_leaves")
            + F.when(F.col("n_children") + F.coalesce("more", F.lit(0)) == 0, 1).otherwise(0),
        }
    )
    nodes = stored(own.drop("more", "n_chars").withColumn("ancestor", F.col("parent_key")), "upper")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        # `ancestor` is `step` levels up; a node has the sums of fewer than `step` levels below.
        far = nodes.where(F.col("depth") >= step)
        given = far.groupBy((F.col("depth") - step).alias("depth"), F.col("ancestor").alias("key")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        next_up = nodes.select(
            (F.col("depth") + step).alias("depth"), F.col("key").alias("ancestor"), F.col("ancestor").alias("next")
        )
        nodes = stored(
            nodes.join(given, ["depth", "key"], "left")
            .join(next_up, ["depth", "ancestor"], "left")
            .withColumns(
                {
                    "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
                    "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0)),
                    "ancestor": F.col("next"),
                }
            )
            .drop("more_leaves", "more_saved", "next"),
            "upper",
        )
        step *= 2
    return nodes.drop("ancestor")


_COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_path",
)


def prefix_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and paths of the rebuilt conversations (`spliced`) in (conv_id, turn, role, text).

    Nodes, all bigint: conv_id (least member), depth (0: the root), parent_conv_id (NULL at the
    root), n_convs, n_children, n_leaves (nodes without children in the subtree, itself
    included), saved_tokens (over the subtree, code points of each node's turn once for every
    member but one) and end_path (the path that ends there, or NULL). Members of paths: (path,
    conv_id), path being the least of the conversations that are equal throughout.

    NULLs, ties and repeated rows: see `numbered_turns`; repeated rows are turns of their own.
    A conversation without rebuilt turns is a member of the root only. No conversations: no
    nodes. Other columns are not read. 64-bit hashes stand for turns and prefixes.
    """
    rows, convs = spliced(stored(numbered_turns(conversations), "turns"))
    rows = stored(rows, "rebuilt")
    last = rows.where("depth = length").select("conv_id", "length", "key", "chars")
    copies = stored(
        last.groupBy("length", "key").agg(
            F.min("conv_id").alias("path"), F.count(F.lit(1)).alias("copies"), F.max("chars").alias("all_chars")
        ),
        "paths",
    )
    empty = convs.where("length = 0")
    turnless = empty.agg(F.min("conv_id").alias("path"), F.count(F.lit(1)).alias("copies")).where("copies > 0")
    members = last.join(copies.select("length", "key", "path"), ["length", "key"]).select("path", "conv_id")
    least = F.lit(empty.agg(F.min("conv_id")).first()[0]).cast("bigint").alias("path")
    members = members.unionByName(empty.select(least, "conv_id"))

    paths = stored(_dealt(rows, copies.drop("key")), "paths")
    of_paths = rows.join(paths.drop("length"), rows["conv_id"] == paths["path"])
    to_end = (F.col("copies") - 1) * (F.col("all_chars") - F.col("chars"))
    sent = of_paths.where("depth <= held").select(
        "shard", "path", "depth", "length", "held", "dealt_at", "copies", "turn_key", "n_chars", "key",
        to_end.alias("to_end"),
    )
    shards = stored(sent.groupBy("shard").applyInArrow(shard_nodes, _NODES_DDL), "shards")
    tails = of_paths.where("depth > held").select(
        F.col("path").alias("conv_id"),
        "depth",
        F.col("path").alias("parent_conv_id"),
        F.col("copies").alias("n_convs"),
        F.when(F.col("depth") < F.col("length"), 1).otherwise(0).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        (to_end + (F.col("copies") - 1) * F.col("n_chars")).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.col("path")).alias("end_path"),
    )
    upper = _merged_upper(shards.where("upper"), turnless)
    above = upper.select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("conv_id").alias("above")
    )
    owned = shards.where("NOT upper")
    known = owned.where("parent_conv_id IS NOT NULL").select(*_COLUMNS)
    joined = owned.where("parent_conv_id IS NULL").drop("upper", "parent_conv_id", "n_chars").unionByName(upper)
    joined = joined.join(above, ["depth", "parent_key"], "left").withColumnRenamed("above", "parent_conv_id")
    return known.unionByName(joined.select(*_COLUMNS)).unionByName(tails), members


# Digests of members -------------------------------------------------------------------------


def _id_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids that a path has in a batch, comma-joined."""
    for batch in batches:
        path, ids = (batch.column(c).to_numpy() for c in ("path", "conv_id"))
        if not len(path):
            continue
        cuts = np.flatnonzero(path[1:] != path[:-1]) + 1
        edges = [0, *cuts.tolist(), len(path)]
        spans = list(zip(edges, edges[1:]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(path[[a for a, _ in spans]]),
                pa.array(ids[[a for a, _ in spans]]),
                pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in spans]),
            ],
            names=["path", "first_id", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per path from rows that come sorted; a path may go on in the next batch."""
    current, digest = None, None
    for batch in batches:
        done: list[tuple[int, str]] = []
        for path, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
            if path == current:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                done.append((current, digest.hexdigest()))
            current, digest = path, hashlib.sha256(ids.encode())
        yield _digest_rows(done)
    if digest is not None:
        yield _digest_rows([(current, digest.hexdigest())])


def _digest_rows(done: list[tuple[int, str]]) -> pa.RecordBatch:
    paths, digests = [p for p, _ in done], [d for _, d in done]
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, type=pa.int64()), pa.array(digests, type=pa.string())],
        names=["end_path", "ends_sha256"],
    )


def member_digests(members: DataFrame) -> DataFrame:
    """(end_path, ends_sha256): SHA-256 of each path's ids, ascending, decimal, comma-joined.

    Ids are sorted by range over all tasks and travel on as strings of many, so the one task
    that hashes a path of very many reads few rows, and holds one at a time.
    """
    width = shuffle_width(members.sparkSession)
    ranged = members.repartitionByRange(width, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    rows = ranged.mapInArrow(_id_rows, "path bigint, first_id bigint, ids string")
    whole = rows.repartition(width, "path").sortWithinPartitions("path", "first_id")
    return whole.mapInArrow(_digests, "end_path bigint, ends_sha256 string")


def node_summary(conversations: DataFrame) -> DataFrame:
    """The nodes of `prefix_trie`, with the digest of the conversations that end at each."""
    nodes, members = prefix_trie(conversations)
    digests = member_digests(stored(members, "members"))
    nothing = hashlib.sha256(b"").hexdigest()
    joined = nodes.join(digests, "end_path", "left")
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing))).drop("end_path")
