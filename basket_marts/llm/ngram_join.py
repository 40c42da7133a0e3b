"""Exact Jaccard join of documents on word shingles, by vertical partitioning.

The space of shingles is cut into fragments. A fragment holds its part of every document's
set and knows of each of its shingles how many sets have it; so it counts, apart from all
other fragments, how many shingles a set shares with any other, and hands back the shared
ones. Partial counts are summed per set: one that shares fewer than three quarters of itself
links with nothing, which leaves the near copies. These counts are of a set against all others;
overlaps of pairs are counted whole, in the families that follow, for pairs as rows would be
millions in one family of near copies.

Of these the rarest shingles (the prefix: any two that link have one in common) are joined
to find families that may hold links. In a family, overlaps are counted shingle by shingle
and summed per pair, one member against all others at a time. Members already known to be
connected need no comparison, and pairs are never rows: a family of thousands of near copies
has millions. Documents with equal sets are one class from the start.

Sets stand in as 64-bit hashes, shingles as their fragment and 40 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket_marts.llm.common import (
    lookup_join,
    pack_rest,
    release_memory,
    row_key,
    shuffle_width,
    stored,
    text_slices,
    unpack_rest,
)
from basket_marts.llm.components import connected_components
from basket_marts.llm.shingles import shingle_sets

# Two sets link when 100 * |intersection| >= PERCENT * |union|.
PERCENT = 75

# Shingles that a fragment's task, and a family's task, hold at once: bounds of memory.
FRAGMENT_SHINGLES = 1_200_000
FAMILY_SHINGLES = 2_000_000
# Text whose sets a map task holds at once, and sets in it that make a shingle common.
CHUNK_BYTES = 2 << 20
COMMON = 24

_SUFFIX_BITS = np.uint64(40)
_SUFFIX = np.uint64((1 << 40) - 1)
_EVERYWHERE = np.uint16(65535)
_U8, _U4, _U2 = np.dtype("<u8"), np.dtype("<u4"), np.dtype("<u2")


# Sets ---------------------------------------------------------------------------------


def _class_of(hashes: np.ndarray) -> int:
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, n_shingles, set_class) per row; equal sets have one class, empty
    ones NULL.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, size=CHUNK_BYTES):
            sizes, classes = [], []
            for hashes in shingle_sets(batch.column("text")):
                sizes.append(len(hashes))
                classes.append(_class_of(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array(sizes, type=pa.int64()),
                    pa.array(classes, type=pa.int64()),
                ],
                names=["doc_id", "row_key", "n_shingles", "set_class"],
            )

    schema = "doc_id bigint, row_key bigint, n_shingles bigint, set_class bigint"
    keyed = docs.select("doc_id", row_key().alias("row_key"), "text")
    return keyed.mapInArrow(describe, schema)


# Fragments ----------------------------------------------------------------------------
#
# Sets travel packed, a row for what a chunk of texts has in a fragment: one number of the
# chunk, and for each shingle which set of the chunk has it and the shingle itself, seven bytes
# together however many fragments there are. What the sets are goes another way, in a row
# for the whole chunk.

_CUT = pa.schema(
    [("place", pa.int32()), ("chunk", pa.int64())]
    + [(c, pa.binary()) for c in ("owners", "shingles", "classes", "sizes")]
)
_SHARED = pa.schema(
    [("place", pa.int32())]
    + [(c, pa.binary()) for c in ("sets", "counts", "shingles", "shared", "classes", "sizes")]
)
_CUT_DDL, _SHARED_DDL = (
    ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'bigint' if f.name == 'chunk' else 'int'}" for f in schema)
    for schema in (_CUT, _SHARED)
)
# A set is numbered by its chunk and its place there.
_OWNER_BITS = 16
_MOST_OWNERS = 1 << _OWNER_BITS


def _packed(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    filled = [{f.name: row.get(f.name, b"" if pa.types.is_binary(f.type) else 0) for f in schema} for row in rows]
    return pa.RecordBatch.from_pylist(filled, schema=schema)


def _joined(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _narrow(shingles: np.ndarray) -> bytes:
    """Within a fragment five bytes tell shingles apart."""
    return np.ascontiguousarray(shingles.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _wide(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    wide[:, :5] = data.reshape(-1, 5)
    return wide.view(_U8).ravel()


def _by_place(place: np.ndarray, owner: np.ndarray, n_places: int):
    """Order of entries by place (owner order kept), and per place: entries, owners, counts."""
    kind = np.uint16 if n_places < 65536 else np.uint32
    order = np.argsort(place.astype(kind), kind="stable")
    place, owner = place[order], owner[order]
    first = np.flatnonzero(
        np.append(True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]))
    )
    counts = np.diff(first, append=len(place))
    starts = np.flatnonzero(np.append(True, np.diff(place[first].astype(np.int64)) != 0))
    ends = np.append(starts[1:], len(first))
    for a, b in zip(starts.tolist(), ends.tolist()):
        stop = first[b] if b < len(first) else len(place)
        yield int(place[first[a]]), order[first[a] : stop], owner[first[a:b]], counts[a:b]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, size=CHUNK_BYTES):
        for first in range(0, batch.num_rows, _MOST_OWNERS):
            yield batch.slice(first, _MOST_OWNERS)


def _to_fragments(docs: DataFrame, n_fragments: int) -> DataFrame:
    """What each chunk of texts has in each fragment, and, by chunk, its sets.

    A shingle that many sets of a chunk have is counted there: its fragment gets it once,
    marked, and the sets' own entries go where the chunk's sets are gathered, so that no
    fragment collects the occurrences of a very common shingle. Copies of a set that a task
    meets again are left out; those of other tasks count as other sets until they are gathered.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        chunk = TaskContext.get().partitionId() << 20
        for batch in _chunks(batches):
            chunk += 1
            sets, classes = [], []
            for hashes in shingle_sets(batch.column("text")):
                if not len(hashes):
                    continue
                own = _class_of(hashes)
                if own not in met:
                    met.add(own)
                    sets.append(hashes)
                    classes.append(own)
            if len(met) > 1_000_000:
                met.clear()
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets], dtype=_U4)
            owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
            shingles = np.concatenate(sets)
            fragment = (((shingles >> np.uint64(32)) * np.uint64(n_fragments)) >> np.uint64(32)).astype(np.int64)
            shingles = (fragment.astype(_U8) << _SUFFIX_BITS) | (shingles & _SUFFIX)
            by_shingle = np.sort(shingles)
            runs = np.flatnonzero(np.append(True, by_shingle[1:] != by_shingle[:-1]))
            lengths = np.diff(runs, append=len(by_shingle))
            common = by_shingle[runs[lengths >= COMMON]]
            home = {"place": n_fragments + chunk % n_fragments, "chunk": chunk}
            rows = [home | {"classes": np.array(classes, dtype="<i8").tobytes(), "sizes": sizes.tobytes()}]
            if len(common):
                at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
                is_common = common[at] == shingles
                held = {"owners": owner[is_common].astype(_U2).tobytes(), "shingles": shingles[is_common].tobytes()}
                rows.append(home | held)
                fragment, owner, shingles = fragment[~is_common], owner[~is_common], shingles[~is_common]
                marks = (common >> _SUFFIX_BITS).astype(np.int64)
                for to, entries, _, _ in _by_place(marks, np.zeros(len(marks), np.int64), n_fragments):
                    rows.append({"place": to, "shingles": _narrow(common[entries])})
            if len(shingles):
                for to, entries, _, _ in _by_place(fragment, owner, n_fragments):
                    owners = owner[entries].astype(_U2).tobytes()
                    rows.append({"place": to, "chunk": chunk, "owners": owners, "shingles": _narrow(shingles[entries])})
            yield _packed(rows, _CUT)

    return docs.select("doc_id", "text").mapInArrow(cut, _CUT_DDL)


def _numbered(chunk: pa.ChunkedArray, owners: pa.ChunkedArray) -> np.ndarray:
    """The sets that the entries of some rows belong to."""
    counts = [len(o) // _U2.itemsize for o in owners.to_pylist()]
    return (np.repeat(chunk.to_numpy(), counts) << _OWNER_BITS) | _joined(owners, _U2).astype(np.int64)


def _shared_parts(cut: DataFrame, n_fragments: int) -> DataFrame:
    """From each fragment the shingles that at least two sets have, by the place where their
    sets are gathered, with how many (`shared`, up to a maximum that also stands for common ones).
    What went there directly is handed on.
    """

    def count(table: pa.Table) -> pa.Table:
        place, owners = table.column("place")[0].as_py(), table.column("owners")
        rows = []
        if place >= n_fragments:
            for row in table.select(["chunk", "owners", "shingles", "classes", "sizes"]).to_pylist():
                to, first = place - n_fragments, row["chunk"] << _OWNER_BITS
                if row["classes"]:
                    sets = first | np.arange(len(row["classes"]) // 8, dtype=np.int64)
                    rows.append({"place": to, "sets": sets.tobytes(), "classes": row["classes"], "sizes": row["sizes"]})
                else:
                    own, counts = np.unique(np.frombuffer(row["owners"], dtype=_U2), return_counts=True)
                    everywhere = np.full(counts.sum(), _EVERYWHERE, dtype=_U2)
                    rows.append(
                        {"place": to, "sets": (first | own.astype(np.int64)).tobytes(), "counts": counts.astype(_U4).tobytes(),
                         "shingles": row["shingles"], "shared": everywhere.tobytes()}
                    )
        else:
            has_owner = pa.compute.greater(pa.compute.binary_length(owners), 0)
            held, marks = table.filter(has_owner), table.filter(pa.compute.invert(has_owner))
            marked = np.unique(_wide(_joined(marks.column("shingles"), np.dtype(np.uint8))))
            sets, owner = np.unique(_numbered(held.column("chunk"), held.column("owners")), return_inverse=True)
            suffix = _wide(_joined(held.column("shingles"), np.dtype(np.uint8)))
            order = np.lexsort((owner, suffix))
            suffix, owner = suffix[order], owner[order]
            runs = np.flatnonzero(np.append(True, suffix[1:] != suffix[:-1]))[: len(suffix)]
            lengths = np.diff(runs, append=len(suffix))
            df = np.repeat(np.minimum(lengths, int(_EVERYWHERE) - 1), lengths).astype(_U2)
            if len(marked) and len(suffix):
                at = np.minimum(np.searchsorted(marked, suffix), len(marked) - 1)
                df[marked[at] == suffix] = _EVERYWHERE
            keep = df > 1
            owner, shared = owner[keep], df[keep]
            shingles = (np.uint64(place) << _SUFFIX_BITS) | suffix[keep]
            order = np.argsort(owner, kind="stable")
            owner, shared, shingles = owner[order], shared[order], shingles[order]
            if len(shingles):
                home = (sets >> _OWNER_BITS) % n_fragments
                for to, entries, owners_there, found in _by_place(home[owner], owner, n_fragments):
                    rows.append(
                        {"place": to, "sets": sets[owners_there].tobytes(), "counts": found.astype(_U4).tobytes(),
                         "shingles": shingles[entries].tobytes(), "shared": shared[entries].astype(_U2).tobytes()}
                    )
        release_memory()
        return pa.Table.from_batches([_packed(rows, _SHARED)], schema=_SHARED)

    return cut.groupBy("place").applyInArrow(count, _SHARED_DDL)


def _near_sets(parts: DataFrame) -> DataFrame:
    """(set_class, n_shingles, n_shared, shingles, prefix) of the sets that share enough.

    `shingles` are those that other sets have, rarest first; `prefix` those of them among
    the set's first |set| - ceil(PERCENT % of |set|) + 1 in that order, which begins with the
    ones that no other set has.
    """

    def gather(table: pa.Table) -> pa.Table:
        is_known = pa.compute.greater(pa.compute.binary_length(table.column("classes")), 0)
        of_sets, parts = table.filter(is_known), table.filter(pa.compute.invert(is_known))
        numbers = _joined(of_sets.column("sets"), np.dtype(np.int64))
        by_number = np.argsort(numbers)
        numbers = numbers[by_number]
        known = _joined(of_sets.column("classes"), np.dtype(np.int64))[by_number]
        sizes = _joined(of_sets.column("sizes"), _U4).astype(np.int64)[by_number]
        counts = _joined(parts.column("counts"), _U4)
        shingles = _joined(parts.column("shingles"), _U8)
        shared = _joined(parts.column("shared"), _U2)
        number = np.searchsorted(numbers, _joined(parts.column("sets"), np.dtype(np.int64)))
        enough = np.bincount(number, weights=counts, minlength=len(numbers)) * 100 >= sizes * PERCENT
        owner = np.repeat(number, counts)
        keep = enough[owner]
        owner, shingles, shared = owner[keep], shingles[keep], shared[keep]
        order = np.lexsort((shingles, shared, owner))
        owner, shingles = owner[order], shingles[order]
        again = np.append(False, (owner[1:] == owner[:-1]) & (shingles[1:] == shingles[:-1]))[: len(owner)]
        owner, shingles = owner[~again], shingles[~again]
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))[: len(owner)]
        rows = []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(owner)]):
            size, found = int(sizes[owner[start]]), end - start
            if found * 100 < size * PERCENT:
                continue
            prefix = size - -(-size * PERCENT // 100) + 1 - (size - found)
            own = shingles[start:end].view(np.int64)
            rows.append(
                {
                    "set_class": int(known[owner[start]]),
                    "n_shingles": size,
                    "n_shared": found,
                    "shingles": own.tobytes(),
                    "prefix": own[: max(0, prefix)].tolist(),
                }
            )
        release_memory()
        return pa.Table.from_pylist(rows, schema=_NEAR)

    schema = (
        "set_class bigint, n_shingles bigint, n_shared bigint, shingles binary, "
        "prefix array<bigint>"
    )
    return parts.groupBy("place").applyInArrow(gather, schema)


_NEAR = pa.schema(
    [
        ("set_class", pa.int64()),
        ("n_shingles", pa.int64()),
        ("n_shared", pa.int64()),
        ("shingles", pa.binary()),
        ("prefix", pa.list_(pa.int64())),
    ]
)


# Families -----------------------------------------------------------------------------


def _families(near: DataFrame) -> DataFrame:
    """(set_class, family): sets that share a prefix shingle, directly or through others."""
    entries = near.select("set_class", F.explode("prefix").alias("shingle"))
    hubs = (
        entries.groupBy("shingle")
        .agg(F.min("set_class").alias("hub"), F.max("set_class").alias("last"))
        .where("last > hub")
        .select("shingle", "hub")
    )
    edges = (
        entries.join(hubs, "shingle")
        .where("set_class <> hub")
        .select(F.col("set_class").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )
    return connected_components(edges).select(
        F.col("node").alias("set_class"), F.col("component").alias("family")
    )


def linked_roots(sets: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Per set the least position of a set that it is connected with by links.

    Sets are taken up one after another, outside the largest group first known, and counted
    against all others at once: every shingle adds one to each set that has it. When all sets
    not taken up are in one group, any link between the others has been found.
    """
    n = len(sets)
    root = np.arange(n)
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), lengths)
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(shingle, kind="stable")
    holders = owner[order]
    begins = np.append(0, np.cumsum(np.bincount(shingle)))
    own = np.split(shingle, np.cumsum(lengths)[:-1])
    waiting = np.ones(n, dtype=bool)
    while True:
        groups = np.bincount(root[waiting], minlength=n)
        largest = int(groups.argmax())
        outside = np.flatnonzero(waiting & (root != largest))
        if not len(outside):
            return root
        x = int(outside[lengths[outside].argmax()])
        waiting[x] = False
        mine = own[x]
        spans = begins[mine + 1] - begins[mine]
        starts = np.repeat(begins[mine] - np.append(0, np.cumsum(spans)[:-1]), spans)
        overlap = np.bincount(holders[starts + np.arange(spans.sum())], minlength=n)
        overlap[x] = sizes[x]  # with itself, shingles that no other set has included
        union = sizes[x] + sizes - overlap
        linked = np.unique(root[overlap * 100 >= union * PERCENT])
        if len(linked) > 1:
            root[np.isin(root, linked)] = linked[0]


def _links(near: DataFrame, families: DataFrame, n_tasks: int) -> DataFrame:
    """(a, b): edges that connect the sets of each family that links connect.

    A family too large for a task is cut into parts, and every two parts meet in a task.
    """
    # Who goes where is settled without the sets, which then move once.
    # Copies of a set that different tasks had are still apart.
    classes = near.select("set_class", "n_shared").distinct()
    members = stored(classes.join(families, "set_class"), "members")
    large = (
        members.groupBy("family")
        .agg(F.sum("n_shared").alias("held"))
        .where(F.col("held") > FAMILY_SHINGLES)
        .select("family", F.ceil(2 * F.col("held") / FAMILY_SHINGLES).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("set_class"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    dealt = (
        lookup_join(members, stored(large, "large-families"), "family", "left")
        .withColumn("part", F.coalesce(part, F.lit(0)))
        .withColumn("other", F.explode(others))
        .withColumn("low", F.least("part", "other"))
        .withColumn("high", F.greatest("part", "other"))
        .withColumn(
            "task",
            F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("family"), F.lit(n_tasks)))
            .otherwise(n_tasks + F.abs(F.xxhash64("family", "low", "high") / 2).cast("bigint")),
        )
        .select("task", "family", "low", "high", "set_class")
    )
    sets = near.select("set_class", "n_shingles", "shingles")
    sent = lookup_join(sets, stored(dealt, "dealt"), "set_class")

    def connect(table: pa.Table) -> pa.Table:
        classes = table.column("set_class").to_numpy()
        sizes = table.column("n_shingles").to_numpy()
        held = table.column("shingles").to_pylist()
        keys = np.stack([table.column(c).to_numpy() for c in ("family", "low", "high")])
        order = np.lexsort((classes, *keys[::-1]))
        again = (keys[:, order][:, 1:] == keys[:, order][:, :-1]).all(0) & (classes[order][1:] == classes[order][:-1])
        order = order[np.append(True, ~again)]
        keys = keys[:, order]
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        found_a, found_b = [], []
        for group in np.split(order, cuts):
            if len(group) > 1:
                sets = [np.frombuffer(held[i], dtype=_U8) for i in group]
                root = linked_roots(sets, sizes[group])
                moved = root != np.arange(len(group))
                found_a.append(classes[group[moved]])
                found_b.append(classes[group[root[moved]]])
        empty = [np.zeros(0, dtype=np.int64)]
        release_memory()
        return pa.table(
            {"a": np.concatenate(found_a or empty), "b": np.concatenate(found_b or empty)}
        )

    return sent.groupBy("task").applyInArrow(connect, "a bigint, b bigint")


def _rooted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their set class, and (set_class, least_id, root) of the classes; linked
    classes have one root.
    """
    spark = docs.sparkSession
    sets = stored(document_sets(docs), "sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    n_fragments = max(shuffle_width(spark), -(-total // FRAGMENT_SHINGLES))
    parts = _shared_parts(_to_fragments(docs, n_fragments), n_fragments)
    near = stored(_near_sets(parts), "near-sets")
    links = stored(_links(near, stored(_families(near), "families"), n_fragments), "links")
    joined = connected_components(links).select(
        F.col("node").alias("set_class"), F.col("component").alias("root")
    )
    known = sets.where("set_class IS NOT NULL").groupBy("set_class")
    classes = known.agg(F.min("doc_id").alias("least_id"))
    root = F.coalesce("root", "set_class")
    return sets, stored(
        classes.join(joined, "set_class", "left").withColumn("root", root), "classes"
    )


def ngram_components(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id.

    A set is the distinct `WIDTH`-word shingles of the whole text, or the whole sequence of
    fewer words; NULL, empty and wordless texts have none and are linked with nothing, not
    even each other. Two rows link when 100 * |intersection| >= PERCENT * |union|.
    `component_id` is the least doc_id reachable by links, the row's own included; NULL ids
    are passed over unless there is no other. Rows that repeat are linked like any two;
    other columns are not read; an empty table gives no rows.
    """
    sets, rooted = _rooted(docs)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = rooted.join(least, "root").select("set_class", "component_id")
    return sets.join(of_class, "set_class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with one left of each group connected by links: that
    of the least doc_id (a NULL one only where there is no other), of rows that share it the
    one with the least hash of its text. Rows without shingles all stay.
    """
    sets, rooted = _rooted(docs)
    grouped = sets.join(rooted.select("set_class", "root"), "set_class").select(
        "root", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key").alias("rank"), "row_key"
    )
    keepers = grouped.groupBy("root").agg(
        F.min("rank").getField("row_key").alias("keeper"), F.count(F.lit(1)).alias("n_rows")
    )
    keepers = keepers.where("n_rows > 1").drop("n_rows")
    members = stored(
        grouped.join(keepers, "root").groupBy("row_key", "keeper").agg(F.count(F.lit(1)).alias("n")),
        "members",
    )
    packed = pack_rest(docs)
    gone = members.where("row_key <> keeper").select(F.col("row_key").alias("other_key"))
    same = row_key() == F.col("other_key")
    kept = lookup_join(packed, gone, same, "left_anti")
    # Whole rows that repeat, id and text, are one group too.
    repeated = members.where("row_key = keeper AND n > 1").select(F.col("row_key").alias("other_key"))
    if not repeated.isEmpty():
        once = lookup_join(packed, repeated, same).dropDuplicates(["other_key"]).drop("other_key")
        kept = lookup_join(kept, repeated, same, "left_anti").unionByName(once)
    return unpack_rest(kept, docs.columns)
