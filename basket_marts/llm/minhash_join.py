"""Near-duplicate documents by an inverted join of MinHash signatures.

A set of word shingles has a signature of `COORDINATES` minima. Sets are posted under each
(coordinate, value) that they have; two sets collide there with a probability of their
similarity, so near copies collide in at least `MATCHES` coordinates, but for one pair in a
billion. That makes counting collisions a threshold problem:

* a set whose values are shared in fewer coordinates than that is done;
* of the others' shared postings, rarest first, only a prefix is joined: two sets with enough
  collisions have one of its postings in common. Sets joined so, directly or through others,
  are a family;
* in a family a set meets the short lists of its prefix. Sets already connected with it or
  of another size are skipped, the others' collisions are counted over all coordinates, and
  those with enough are compared shingle by shingle, so every link is exact.

Equal sets are one class from the start, members already connected are not compared, and pairs
are never rows: a family of near copies has millions. A family that is too large for a task is
cut into parts, which are connected through a few sets that all of them get; only the sets
that this leaves outside the family's largest group meet all its parts again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket_marts.llm.common import lookup_join, row_key, shuffle_width, stored, text_slices
from basket_marts.llm.components import connected_components
from basket_marts.llm.shingles import shingle_sets
from basket_marts.operators import top_n_per_group

# Two sets link when 100 * |intersection| >= PERCENT * |union|.
PERCENT = 85
# Of 64 independent coordinates, each alike with probability 0.85, fewer than 34 are alike in
# 3 cases of 10^10.
COORDINATES = 64
MATCHES = 34
# The prefix of a set's postings: two sets with MATCHES collisions share one of these.
PREFIX = COORDINATES - MATCHES + 1

# Shingles of sets that a task holds, and sets of a large family that all its parts get.
FAMILY_SHINGLES = 400_000
HUBS = 8
# Text whose signatures a task computes at once.
SLICE_BYTES = 1 << 20

_U8, _U4 = np.dtype("<u8"), np.dtype("<u4")
# One odd multiplier for each coordinate, from a fixed seed.
_MULTIPLIERS = np.random.Generator(np.random.PCG64(31)).integers(
    1, 1 << 63, COORDINATES, dtype=np.uint64
) | np.uint64(1)


# Signatures -----------------------------------------------------------------------------


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima for each set of 64-bit hashes, none of them empty."""
    found = np.empty((len(sets), COORDINATES), dtype=_U4)
    if sets:
        hashes = np.concatenate(sets)
        starts = np.append(0, np.cumsum([len(s) for s in sets])[:-1])
        for place, multiplier in enumerate(_MULTIPLIERS):
            found[:, place] = np.minimum.reduceat(hashes * multiplier, starts) >> np.uint64(32)
    return found


def _class_of(hashes: np.ndarray) -> int:
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def signed_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, n_shingles, set_class, signature) per row; equal sets have one class,
    empty ones neither class nor signature.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, size=SLICE_BYTES):
            sets = list(shingle_sets(batch.column("text")))
            rows = iter(signatures([s for s in sets if len(s)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([_class_of(s) if len(s) else None for s in sets], type=pa.int64()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], type=pa.binary()),
                ],
                names=["doc_id", "row_key", "n_shingles", "set_class", "signature"],
            )

    schema = "doc_id bigint, row_key bigint, n_shingles bigint, set_class bigint, signature binary"
    keyed = docs.select("doc_id", row_key().alias("row_key"), "text")
    return keyed.mapInArrow(sign, schema)


# Postings -------------------------------------------------------------------------------


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=_U4)
        posts = values.reshape(-1, COORDINATES).astype(np.int64) | coordinate
        classes = np.repeat(batch.column("set_class").to_numpy(), COORDINATES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(classes), pa.array(posts.ravel())], names=["set_class", "post"]
        )


def near_classes(classes: DataFrame) -> DataFrame:
    """(set_class, prefix): classes that share enough of their postings with others, and the
    postings by which they can meet, rarest first.
    """
    posts = classes.select("set_class", "signature").mapInArrow(_posted, "set_class bigint, post bigint")
    shared = posts.groupBy("post").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    of_class = (
        posts.join(shared, "post")
        .groupBy("set_class")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "post"))).alias("posts"))
        .where(F.size("posts") >= MATCHES)
    )
    # Postings that no other set has would come first in the order; they use up the prefix.
    prefix = F.slice("posts.post", 1, F.size("posts") - MATCHES + 1)
    return of_class.select("set_class", prefix.alias("prefix"))


def _families(near: DataFrame) -> DataFrame:
    """(set_class, family): classes that share a posting of their prefixes, directly or through
    others. The least class of a posting is its hub.
    """
    entries = near.select("set_class", F.explode("prefix").alias("post"))
    hubs = (
        entries.groupBy("post")
        .agg(F.min("set_class").alias("hub"), F.max("set_class").alias("last"))
        .where("last > hub")
        .select("post", "hub")
    )
    # A class has many postings and so many hubs. It is tied to the least of them, and its other
    # hubs to that one as well: the same connections in far fewer edges, as hubs recur.
    of_class = entries.join(hubs, "post").groupBy("set_class").agg(F.collect_set("hub").alias("hubs"))
    tied = F.explode(F.array_union("hubs", F.array("set_class"))).alias("a")
    edges = of_class.select(tied, F.array_min("hubs").alias("b")).where("a <> b").distinct()
    return connected_components(edges).select(
        F.col("node").alias("set_class"), F.col("component").alias("family")
    )


# Links within families ------------------------------------------------------------------


class Family:
    """Sets with their signatures and inverted lists, held by one task."""

    def __init__(self, sets: list[np.ndarray], marks: np.ndarray):
        self.sets, self.marks = sets, marks
        self.sizes = np.array([len(s) for s in sets])
        posts = marks.astype(np.int64) | (np.arange(COORDINATES, dtype=np.int64) << 32)
        _, lists = np.unique(posts.ravel(), return_inverse=True)
        self.holders = np.argsort(lists, kind="stable") // COORDINATES
        self.lists = lists.reshape(-1, COORDINATES)
        self.ends = np.cumsum(np.bincount(lists))
        self.lengths = np.diff(self.ends, prepend=0)

    def matches(self, x: int, skipped: np.ndarray) -> np.ndarray:
        """Sets, but for the skipped ones, with at least MATCHES collisions with set x."""
        own = self.lists[x]
        # The shortest lists; a set in none of them can only match in the others: too few.
        short = own[np.argsort(self.lengths[own], kind="stable")[:PREFIX]]
        met = np.unique(np.concatenate([self.holders[self.ends[i] - self.lengths[i] : self.ends[i]] for i in short]))
        met = met[~skipped[met]]
        return met[(self.marks[met] == self.marks[x]).sum(1) >= MATCHES]

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` whose shingles link with set x."""
        if not len(others):
            return others
        sets, own = [self.sets[y] for y in others], self.sets[x]
        shingles = np.concatenate(sets)
        at = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
        starts = np.append(0, np.cumsum([len(s) for s in sets])[:-1])
        both = np.add.reduceat((own[at] == shingles).astype(np.int64), starts)
        return others[100 * both >= PERCENT * (len(own) + self.sizes[others] - both)]

    def roots(self, root: np.ndarray, asking: np.ndarray) -> np.ndarray:
        """Per set one that it is connected with by links, the same for all connected sets.

        `root` tells what is known to be connected. Sets that ask are taken up one after another,
        outside the largest group first, until all that were not are in one group: then no
        link that is still unknown, and that one of those asking has, would change a group.
        """
        root, waiting, unmet = root.copy(), asking.copy(), np.ones(len(root), dtype=bool)
        while waiting.any():
            groups = np.bincount(root[unmet], minlength=len(root))
            largest = int(groups.argmax())
            if groups[largest] == unmet.sum():
                break
            outside = np.flatnonzero(waiting & (root != largest))
            x = int(outside[0] if len(outside) else np.flatnonzero(waiting)[0])
            waiting[x] = unmet[x] = False
            low, high = np.minimum(self.sizes, self.sizes[x]), np.maximum(self.sizes, self.sizes[x])
            skipped = (root == root[x]) | (100 * low < PERCENT * high)
            joined = np.unique(root[self.linked(x, self.matches(x, skipped))])
            if len(joined):
                joined = np.append(joined, root[x])
                root[np.isin(root, joined)] = joined.min()
        return root


def _connect(table: pa.Table) -> pa.Table:
    """(a, b): edges that connect the sets of each family in a task as their links do."""
    classes, families, known = (table.column(c).to_numpy() for c in ("set_class", "family", "known"))
    asking = table.column("asking").to_numpy(zero_copy_only=False)
    signature, shingles = (table.column(c).to_pylist() for c in ("signature", "shingles"))
    # A class may come twice, as a member and as one that asks; once is enough, asking.
    order = np.lexsort((~asking, classes, families))
    same = (classes[order][1:] == classes[order][:-1]) & (families[order][1:] == families[order][:-1])
    order = order[np.append(True, ~same)]
    cuts = np.flatnonzero(np.diff(families[order])) + 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for group in np.split(order, cuts):
        if len(group) > 1:
            sets = [np.frombuffer(shingles[i], dtype=_U8) for i in group]
            marks = np.frombuffer(b"".join(signature[i] for i in group), dtype=_U4)
            family = Family(sets, marks.reshape(-1, COORDINATES))
            _, first, number = np.unique(known[group], return_index=True, return_inverse=True)
            root = family.roots(first[number], asking[group])
            moved = np.flatnonzero(root != np.arange(len(group)))
            found.append((classes[group[moved]], classes[group[root[moved]]]))
    pairs = [np.concatenate(side) for side in zip(*found)] if found else [np.zeros(0, np.int64)] * 2
    return pa.table({"a": pairs[0], "b": pairs[1]})


_EDGES = "a bigint, b bigint"
_MEMBER = ("family", "set_class", "known", "asking")


def _with_sets(dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges from tasks of (task, family, set_class, known, asking), once their sets are there."""
    sent = lookup_join(sets, stored(dealt, "dealt"), "set_class")
    return stored(sent.groupBy("task").applyInArrow(_connect, _EDGES), "links")


def _part(name: str = "parts"):
    return F.pmod(F.xxhash64("set_class"), F.col(name)).cast("int")


def _own_task(*by: str):
    return F.xxhash64("family", *by)


def family_links(sets: DataFrame, families: DataFrame) -> DataFrame:
    """(a, b): edges that connect the classes of each family that links connect.

    `sets` is (set_class, n_shingles, signature, shingles). A family within FAMILY_SHINGLES is one
    task's. A larger one is cut into parts; each part finds its own links and those with the
    family's hubs. If that leaves the family in several groups, the sets outside the largest one,
    in portions, meet every part. All that moves in proportion to the sets is the sets, once,
    and those outside again.
    """
    members = stored(sets.select("set_class", "n_shingles").distinct().join(families, "set_class"), "members")
    n_tasks = max(
        shuffle_width(sets.sparkSession),
        -(-(members.agg(F.sum("n_shingles")).first()[0] or 0) // FAMILY_SHINGLES),
    )
    held = members.groupBy("family").agg(F.sum("n_shingles").alias("held"), F.count(F.lit(1)).alias("n"))
    large = held.where((F.col("held") > FAMILY_SHINGLES) & (F.col("n") > 2 * HUBS)).select(
        "family", F.ceil(F.col("held") / FAMILY_SHINGLES).cast("int").alias("parts")
    )
    large = stored(large, "large-families")
    first_known, always = F.col("set_class").alias("known"), F.lit(True).alias("asking")
    small = lookup_join(members, large, "family", "left_anti").select(
        F.pmod(F.xxhash64("family"), F.lit(n_tasks)).alias("task"), "family", "set_class", first_known, always
    )
    if large.isEmpty():
        return _with_sets(small, sets)

    of_large = stored(lookup_join(members, large, "family"), "of-large")
    in_part = of_large.withColumn("part", _part())
    hubs = top_n_per_group(of_large, "family", [F.col("set_class")], HUBS).select(
        "family", "set_class", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    dealt = in_part.select("family", "set_class", "part").unionByName(hubs).distinct()
    dealt = dealt.select(_own_task("part").alias("task"), "family", "set_class", first_known, always)
    links = _with_sets(small.unionByName(dealt), sets)

    groups = connected_components(links).select(F.col("node").alias("set_class"), F.col("component").alias("known"))
    known = F.coalesce("known", "set_class")
    grouped = stored(of_large.join(groups, "set_class", "left").withColumn("known", known), "grouped")
    by_group = grouped.groupBy("family", "known").agg(F.sum("n_shingles").alias("held"))
    largest = by_group.groupBy("family").agg(
        F.max(F.struct("held", "known")).getField("known").alias("largest"),
        F.count(F.lit(1)).alias("n_groups"),
        (F.sum("held") - F.max("held")).alias("outside"),
    )
    open_families = stored(
        largest.where("n_groups > 1").select(
            "family", "largest", F.ceil(F.col("outside") / FAMILY_SHINGLES).cast("int").alias("portions")
        ),
        "open-families",
    )
    if open_families.isEmpty():
        return links
    still = lookup_join(grouped, open_families, "family")
    every_portion = F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion")
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    met = still.select(*_MEMBER[:3], F.lit(False).alias("asking"), _part().alias("part"), every_portion)
    ask = still.where("known <> largest").select(
        *_MEMBER[:3], F.lit(True).alias("asking"), every_part, _part("portions").alias("portion")
    )
    again = met.unionByName(ask).select(_own_task("part", "portion").alias("task"), *_MEMBER)
    return links.unionByName(_with_sets(again, sets))


def rooted_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their set class, and (set_class, least_id, root) of the classes; linked
    classes have one root.
    """
    rows = stored(signed_sets(docs), "signed")
    classes = rows.where("set_class IS NOT NULL").groupBy("set_class")
    classes = stored(
        classes.agg(
            F.min("doc_id").alias("least_id"),
            F.min("row_key").alias("row_key"),
            F.first("signature").alias("signature"),
        ),
        "classes",
    )
    near = stored(near_classes(classes), "near")
    families = stored(_families(near), "families")
    # The sets themselves, from one text of each class that has company.
    in_family = classes.join(families.select("set_class"), "set_class")
    wanted = stored(in_family.select(F.col("row_key").alias("of_row"), "set_class"), "wanted")
    texts = lookup_join(docs.select("doc_id", "text"), wanted, row_key() == F.col("of_row"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # whole rows may repeat; a task sends a set once
        for batch in text_slices(batches, size=SLICE_BYTES):
            classes = batch.column("set_class").to_pylist()
            new = [c not in met and not met.add(c) for c in classes]
            batch = batch.filter(pa.array(new, type=pa.bool_()))
            sets = list(shingle_sets(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("set_class"),
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([row.tobytes() for row in signatures(sets)], type=pa.binary()),
                    pa.array([s.tobytes() for s in sets], type=pa.binary()),
                ],
                names=["set_class", "n_shingles", "signature", "shingles"],
            )

    sets = texts.select("text", "set_class").mapInArrow(
        rebuild, "set_class bigint, n_shingles bigint, signature binary, shingles binary"
    )
    links = family_links(stored(sets, "sets"), families)
    joined = connected_components(links).select(
        F.col("node").alias("set_class"), F.col("component").alias("root")
    )
    root = F.coalesce("root", "set_class")
    return rows, stored(
        classes.select("set_class", "least_id").join(joined, "set_class", "left").withColumn("root", root),
        "rooted",
    )


def minhash_components(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id, kept.

    A set is the distinct five-word shingles of the whole text, or the whole sequence of fewer
    words; NULL, empty and wordless texts have none and are linked with nothing. Two rows link
    when 100 * |intersection| >= PERCENT * |union|. `component_id` is the least doc_id
    reachable by links, the row's own included; NULL ids are passed over unless there is no
    other. `kept` is whether that is the row's own id; rows that repeat an id and are connected
    are alike in this. Other columns are not read; an empty table gives no rows.
    """
    rows, rooted = rooted_classes(docs)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = rooted.join(least, "root").select("set_class", "component_id")
    found = rows.select("doc_id", "n_shingles", "set_class").join(of_class, "set_class", "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
