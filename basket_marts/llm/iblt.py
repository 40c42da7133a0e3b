"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

Each different paragraph of a text is hashed to a digest and added to one cell in each of
three tables; a cell holds a count and the exclusive-or of digests and of their checks.
Subtracting the cells of one version from those of another leaves what they do not share. A
cell that then holds a single digest gives it away; taking it out of its other cells frees
more. If some cells stay locked, both versions are sketched again with more cells.

Built-in functions only. Peeling works on rows of cells, table by table, within the
partitions that the pairs were dealt to, so it moves no data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basket_marts.llm.common import shuffle_width, stored

# A line is a paragraph, cut where a sentence ends unless the next begins with one of these
# letters. That leaves a few sentences together, and an edit moves no cut elsewhere.
CUT = r"(?<=[.!?]) (?![M-Zm-z])"
TABLES = 3
CELLS = 16  # in each table of a fingerprint
GROWTH = 4
STEPS = 7  # tables opened in turn before a sketch counts as locked
MAX_RETRIES = 12

# Documents of consecutive ids that are looked at together for the next one.
BUCKET = 1024


def paragraph_digests(text: Column) -> Column:
    """Digests of the different non-blank paragraphs of a text; NULL has none."""
    cut = F.regexp_replace(F.coalesce(text, F.lit("")), CUT, "\n")
    paragraphs = F.filter(F.array_distinct(F.split(cut, "\n")), lambda p: F.trim(p) != "")
    return F.transform(paragraphs, lambda p: F.xxhash64(p))


# Sketches -----------------------------------------------------------------------------


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit("check"), digest)


def _cells(digest: Column) -> list[Column]:
    """Where a digest goes: a cell of each table, `size` being the tables' size.

    The size is a column, so that all retries run the same compiled code.
    """
    return [
        (F.pmod(F.xxhash64(F.lit(table), digest), "size") + F.lit(table) * F.col("size")).cast("int")
        for table in range(TABLES)
    ]


def _sketches(pairs: DataFrame) -> DataFrame:
    """(pair, size, cell, and count, digests, checks of both sides) for rows (pair, size,
    left, right).
    """
    sides = F.concat(
        F.transform("left", lambda d: F.struct(F.lit(True).alias("is_left"), d.alias("digest"))),
        F.transform("right", lambda d: F.struct(F.lit(False).alias("is_left"), d.alias("digest"))),
    )
    entries = (
        pairs.select("pair", "size", F.explode_outer(sides).alias("e"))
        .select("pair", "size", "e.is_left", "e.digest", _check(F.col("e.digest")).alias("check"))
        .where("digest IS NOT NULL")
        .select("*", F.explode(F.array(*_cells(F.col("digest")))).alias("cell"))
    )
    sums = []
    for side, is_side in (("left", F.col("is_left")), ("right", ~F.col("is_left"))):
        sums += [
            F.count(F.when(is_side, 1)).alias(f"{side}_count"),
            F.bit_xor(F.when(is_side, F.col("digest")).otherwise(0)).alias(f"{side}_digests"),
            F.bit_xor(F.when(is_side, F.col("check")).otherwise(0)).alias(f"{side}_checks"),
        ]
    return entries.groupBy("pair", "size", "cell").agg(*sums)


def _packed(side: str) -> Column:
    """A side's cells as text: for each one in use its number, count, digests and checks."""
    used = F.filter("cells", lambda c: c[f"{side}_count"] > 0)
    cells = F.transform(
        used,
        lambda c: F.concat(
            F.lpad(F.hex(c["cell"]), 2, "0"),
            F.lpad(F.hex(c[f"{side}_count"]), 4, "0"),
            F.lpad(F.hex(c[f"{side}_digests"]), 16, "0"),
            F.right(F.lpad(F.hex(c[f"{side}_checks"]), 16, "0"), F.lit(8)),
        ),
    )
    packed = F.base64(F.unhex(F.array_join(cells, "")))
    return F.replace(packed, F.lit("\r\n"), F.lit(""))


def fingerprints(pairs: DataFrame) -> DataFrame:
    """(pair, left_print, right_print) of rows (pair, left, right) of digests."""
    sized = pairs.withColumn("size", F.lit(CELLS))
    listed = _sketches(sized).groupBy("pair").agg(
        F.sort_array(F.collect_list(F.struct("cell", *_SIDES))).alias("cells")
    )
    return listed.select(
        "pair", _packed("left").alias("left_print"), _packed("right").alias("right_print")
    )


_SIDES = [f"{side}_{what}" for side in ("left", "right") for what in ("count", "digests", "checks")]


# Peeling ------------------------------------------------------------------------------


def _peeled(cells: DataFrame, table: int) -> DataFrame:
    """Open the cells of one table that hold a single digest and take it out of the others.

    A digest has one cell in a table, so it is taken out once. Rows with a cell of -1 are
    digests found, their count telling the side.
    """
    alone = (
        (F.floor(F.col("cell") / F.col("size")) == table)
        & (F.abs("count") == 1)
        & (F.col("checks") == _check(F.col("digests")))
    )
    entry = lambda cell, count, digest: F.struct(
        cell.alias("cell"),
        count.alias("count"),
        F.col("digests"),
        F.col("checks"),
        digest.alias("digest"),
    )
    found = entry(F.lit(-1), F.col("count"), F.col("digests"))
    itself = entry(F.col("cell"), F.col("count"), F.col("digest"))
    places = _cells(F.col("digests"))
    removed = [
        F.when(alone, entry(place, -F.col("count"), F.lit(None).cast("bigint")))
        for other, place in enumerate(places)
        if other != table
    ]
    # The filter also ends a stage of generated code here: all rounds share one small class.
    entries = F.filter(
        F.array(F.when(alone, found).otherwise(itself), *removed), lambda e: e.isNotNull()
    )
    return (
        cells.select("pair", "size", F.explode_outer(entries).alias("e"))
        .select("pair", "size", "e.*")
        .groupBy("pair", "size", "cell", "digest")
        .agg(
            F.sum("count").alias("count"),
            F.bit_xor("digests").alias("digests"),
            F.bit_xor("checks").alias("checks"),
        )
        .where("cell < 0 OR count <> 0 OR digests <> 0 OR checks <> 0")
    )


def _differences_at(pairs: DataFrame) -> DataFrame:
    """(pair, only_left, only_right, locked): digests found on one side only, and how many
    cells of the difference could not be opened.
    """
    rows = _sketches(pairs).select(
        "pair",
        "size",
        "cell",
        (F.col("left_count") - F.col("right_count")).alias("count"),
        F.col("left_digests").bitwiseXOR(F.col("right_digests")).alias("digests"),
        F.col("left_checks").bitwiseXOR(F.col("right_checks")).alias("checks"),
        F.lit(None).cast("bigint").alias("digest"),
    )
    rows = rows.where("count <> 0 OR digests <> 0 OR checks <> 0")
    for step in range(STEPS):
        rows = _peeled(rows, step % TABLES)
    found = F.col("cell") < 0
    return rows.groupBy("pair").agg(
        F.count_if(found & (F.col("count") > 0)).alias("only_left"),
        F.count_if(found & (F.col("count") < 0)).alias("only_right"),
        F.count_if(~found).alias("locked"),
    )


def differences(pairs: DataFrame) -> DataFrame:
    """(pair, only_left, only_right) of rows (pair, left, right): how many digests the
    difference of the sketches gives back for each side. Pairs without a difference have no
    row. Sketches grow `GROWTH`-fold for the pairs that stay locked, until none does.
    """
    waiting, done = pairs.select("pair", F.lit(CELLS).alias("size"), "left", "right"), None
    for _ in range(MAX_RETRIES):
        dealt = waiting.repartition(shuffle_width(pairs.sparkSession), "pair")
        tried = stored(_differences_at(dealt), "differences")
        opened = tried.where("locked = 0").drop("locked")
        done = opened if done is None else done.unionByName(opened)
        locked = tried.where("locked > 0").select("pair")
        if locked.isEmpty():
            return done
        waiting = waiting.join(locked, "pair", "left_semi")
        waiting = stored(waiting.withColumn("size", F.col("size") * GROWTH), "locked")
    raise RuntimeError(f"sketches stay locked after {MAX_RETRIES} retries")


# Next documents -----------------------------------------------------------------------


def _following(keys: DataFrame) -> DataFrame:
    """(key, next_key) for distinct numbers, in ascending order and around.

    Numbers are looked at in groups of neighbours, so that no task orders more than
    `BUCKET` of them, and of the groups one in as many.
    """
    grouped = keys.withColumn("group", F.floor(F.col("key") / BUCKET))
    within = Window.partitionBy("group").orderBy("key")
    heads = grouped.groupBy("group").agg(F.min("key").alias("head"))
    around = Window.partitionBy(F.lit(0)).orderBy("group")
    whole = Window.partitionBy(F.lit(0))
    next_heads = heads.select(
        "group",
        F.coalesce(F.lead("head").over(around), F.min("head").over(whole)).alias("next_head"),
    )
    return (
        grouped.withColumn("next_key", F.lead("key").over(within))
        .join(next_heads, "group")
        .select("key", F.coalesce("next_key", "next_head").alias("next_key"))
    )


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, digests) with next_text and next_digests, those of the following
    row by (doc_id, text), after the last the first.

    A NULL text counts as empty. NULL ids come before all others. Texts move once; only the
    first row of every `BUCKET` ids is looked up for the row before it.
    """
    text = F.coalesce("text", F.lit(""))
    first_bucket = F.lit(-(1 << 62))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.floor(F.col("doc_id") / BUCKET), first_bucket).alias("bucket"),
        text.alias("text"),
    )
    heads = rows.groupBy("bucket").agg(F.min("doc_id").alias("head_id"))
    heads = stored(heads, "heads")
    firsts = (
        rows.join(
            heads,
            (rows["bucket"] == heads["bucket"]) & rows["doc_id"].eqNullSafe(heads["head_id"]),
            "left_semi",
        )
        .groupBy("bucket")
        .agg(F.min("text").alias("head_text"))
    )
    following = _following(heads.select(F.col("bucket").alias("key")))
    next_firsts = following.join(firsts, following["next_key"] == firsts["bucket"]).select(
        F.col("key").alias("bucket"),
        "head_text",
        paragraph_digests(F.col("head_text")).alias("head_digests"),
    )
    in_order = Window.partitionBy("bucket").orderBy("doc_id", "text")
    described = rows.withColumn("digests", paragraph_digests(F.col("text")))
    return (
        described.withColumn("next_text", F.lead("text").over(in_order))
        .withColumn("next_digests", F.lead("digests").over(in_order))
        .join(stored(next_firsts, "next-heads"), "bucket")
        .select(
            "doc_id",
            "text",
            "digests",
            F.coalesce("next_text", "head_text").alias("next_text"),
            F.coalesce("next_digests", "head_digests").alias("next_digests"),
        )
    )


# The whole -----------------------------------------------------------------------------


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): its fingerprint, that of its edited text, and how like it
    are the edited text and the next document.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as
    many, or all, of the next document by (doc_id, text); after the last comes the first, in
    a table of one row itself. Likeness is the Jaccard similarity of paragraph sets, exact
    as recovered from the sketches; two texts without paragraphs are alike (1). Equal texts
    have equal fingerprints, the empty one ''. NULL text counts as empty, NULL ids come
    first, repeated rows have a row each, other columns are not read.
    """
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 4)
    replaced = (F.col("n_chars") - kept).cast("int")
    versions = (
        with_next(docs.select("doc_id", "text"))
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), kept.cast("int")),
                F.substring("next_text", F.lit(1), replaced),
            ),
        )
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "digests",
            paragraph_digests(F.col("edited")).alias("edited_digests"),
            "next_digests",
        )
    )
    versions = stored(versions, "versions")
    sides = [(0, "edited_digests"), (1, "next_digests")]
    pairs = versions.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        (F.col("row") * 2 + number).alias("pair"),
                        F.col("digests").alias("left"),
                        F.col(side).alias("right"),
                    )
                    for number, side in sides
                )
            )
        ).alias("p")
    ).select("p.*")
    found = stored(differences(pairs), "all-differences")
    lefts = found.select(
        F.floor(F.col("pair") / 2).alias("row"),
        F.when(F.col("pair") % 2 == 0, F.col("only_left")).alias("edited_only"),
        F.when(F.col("pair") % 2 == 1, F.col("only_left")).alias("next_only"),
    )
    by_row = lefts.groupBy("row").agg(
        F.max("edited_only").alias("edited_only"), F.max("next_only").alias("next_only")
    )
    width = shuffle_width(docs.sparkSession)
    dealt = versions.repartition(width, "row")
    prints = fingerprints(
        dealt.select(F.col("row").alias("pair"), F.col("digests").alias("left"), F.col("edited_digests").alias("right"))
    ).withColumnRenamed("pair", "row")

    def likeness(only: str, side: str) -> Column:
        missing = F.coalesce(only, F.lit(0))
        union = F.size(side) + missing
        return F.when(union == 0, F.lit(1.0)).otherwise((F.size("digests") - missing) / union)

    return (
        dealt.join(by_row, "row", "left")
        .join(prints, "row", "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            F.coalesce("left_print", F.lit("")).alias("fingerprint"),
            F.coalesce("right_print", F.lit("")).alias("edited_fingerprint"),
            likeness("edited_only", "edited_digests").alias("near_edited"),
            likeness("next_only", "next_digests").alias("near_next"),
        )
    )
