"""Line deduplication by a log-template tree, with built-in functions only.

Lines go down a tree of fixed depth: by token count, then by their leading tokens, in which
tokens with digits are variable fields. Within a leaf a token is fixed if enough lines have
it at its place; the other tokens are variable fields too. If enough of a line is fixed, its
template is the line with `<*>` for variable fields, else the line itself. A template that
recurs across documents is kept in the first of them and dropped from the others. A line that
does not recur goes with a recurring template of its leaf if enough of its tokens are those
that the template has fixed; and lines that do not recur, but of which enough is what most such
lines of the leaf have, recur together.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket_marts.llm.common import (
    code_points,
    keep_last_stored,
    lookup_join,
    pack_rest,
    row_key,
    scratch_mark,
    stored,
    unpack_rest,
)

# A template recurs from so many documents on.
MIN_DOCS = 3
# Lines of so many tokens and more are passages: they recur from fewer documents on.
LONG_TOKENS = 50
LONG_MIN_DOCS = 2
LEADING_TOKENS = 3
# Share of a line's tokens that must be fixed; lines below so many tokens are taken as they are.
SIMILARITY = 0.8
MIN_TOKENS = 5
FIELD = "<*>"
# A line with more templates than this to be compared with looks for fewer; see `_near`.
CROWD = 16


def _masked(text: str | Column) -> Column:
    """The text with single spaces, none around line feeds, and fields for tokens with
    digits. It has as many lines as before. Texts that are so already are only looked at.
    """
    text = F.coalesce(text, F.lit(""))
    spaced = F.regexp_replace(text, r"[^\S\n]+", " ")
    stripped = F.trim(F.regexp_replace(spaced, r" ?\n ?", "\n"))
    is_odd = reduce(or_, (text.contains(c) for c in ("\t", "\r", "\f", "\x0b", "  ", " \n", "\n ")))
    is_odd = is_odd | text.startswith(" ") | text.endswith(" ")
    plain = F.when(is_odd, stripped).otherwise(text)
    # A token is entered at its start only, so that a very long one is walked through once.
    fields = F.regexp_replace(plain, r"(?<!\S)\S*?[0-9]\S*", FIELD)
    return F.when(plain.rlike("[0-9]"), fields).otherwise(plain)


def _count(text: str, byte: str) -> Column:
    """How often a one-byte character occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(byte), F.lit("")))


def _document_lines(docs: DataFrame) -> DataFrame:
    """Each different non-blank line of each row, with its place in the tree: (row_key,
    doc_id, line, n_tokens, leaf, line_hash, line_check).
    """
    masked = docs.select("doc_id", row_key().alias("row_key"), _masked("text").alias("masked"))
    # Outer, for else the optimizer filters empty arrays and computes each one twice.
    lines = masked.select(
        "row_key", "doc_id", F.explode_outer(F.array_distinct(F.split("masked", "\n"))).alias("line")
    ).where("line <> ''")
    return lines.withColumn("n_tokens", _count("line", " ") + 1).select(
        "row_key",
        "doc_id",
        "line",
        "n_tokens",
        F.xxhash64("n_tokens", F.substring_index("line", " ", LEADING_TOKENS)).alias("leaf"),
        *_hashes(),
    )


_LINE = ["line_hash", "line_check"]


def _hashes() -> list[Column]:
    return [
        F.xxhash64("line").alias("line_hash"),
        F.xxhash64(F.lit(7), "line").alias("line_check"),
    ]


def _needed(min_docs: int, long_min_docs: int) -> Column:
    """From how many documents on a line recurs, by its length."""
    return F.when(F.col("n_tokens") >= LONG_TOKENS, long_min_docs).otherwise(min_docs)


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_docs"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    ]


def _templates(leaf_lines: DataFrame) -> DataFrame:
    """(leaf, line_hash, template) of the lines of which enough is fixed in their leaf."""
    tokens = leaf_lines.select(
        "leaf",
        "line_hash",
        "n_docs",
        "needed",
        F.posexplode_outer(F.split("line", " ")).alias("place", "token"),
    )
    fixed = (
        tokens.groupBy("leaf", "needed", "place", "token")
        .agg(F.sum("n_docs").alias("support"))
        .where(F.col("support") >= F.col("needed"))
        .select("leaf", "place", "token", F.lit(True).alias("is_fixed"))
    )
    shown = F.when(F.col("is_fixed"), F.col("token")).otherwise(F.lit(FIELD))
    return (
        tokens.drop("n_docs", "needed")
        .join(fixed, ["leaf", "place", "token"], "left")
        .groupBy("leaf", "line_hash")
        .agg(
            F.count("is_fixed").alias("n_fixed"),
            F.sort_array(F.collect_list(F.struct("place", shown.alias("shown")))).alias("parts"),
        )
        .where(F.col("n_fixed") >= SIMILARITY * F.size("parts"))
        .select("leaf", "line_hash", F.array_join("parts.shown", " ").alias("template"))
    )


def _segments(tokens: Column) -> Column:
    """Hashes of the runs of tokens behind the leading ones, numbered. There is one more run
    than tokens that may differ, so a line shares a run with any template that it goes with.
    """
    n_runs = F.size(tokens) - F.ceil(SIMILARITY * F.size(tokens)) + 1
    n_rest = F.size(tokens) - LEADING_TOKENS
    start = lambda i: (LEADING_TOKENS + 1 + F.floor(i * n_rest / n_runs)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), (n_runs - 1).cast("int")),
        lambda i: F.xxhash64(i, F.slice(tokens, start(i), start(i + 1) - start(i))),
    )


def _consensus(leaf_lines: DataFrame) -> DataFrame:
    """(leaf, template) of each leaf's most frequent token at every place, a field where it
    is in too few lines.
    """
    tokens = leaf_lines.select(
        "leaf", "needed", "n_docs", F.posexplode_outer(F.split("line", " ")).alias("place", "token")
    )
    support = tokens.groupBy("leaf", "needed", "place", "token").agg(
        F.sum("n_docs").alias("support")
    )
    most = F.max(F.struct("support", "token"))
    is_common = F.col("most.support") >= F.col("needed")
    shown = F.when(is_common, F.col("most.token")).otherwise(F.lit(FIELD))
    return (
        support.groupBy("leaf", "needed", "place")
        .agg(most.alias("most"))
        .groupBy("leaf")
        .agg(F.sort_array(F.collect_list(F.struct("place", shown.alias("shown")))).alias("parts"))
        .select("leaf", F.array_join("parts.shown", " ").alias("template"))
    )


def _is_alike(tokens: str, shown: str) -> Column:
    """Whether enough of the tokens of a line are those of a template."""
    equal = F.size(F.filter(F.zip_with(tokens, shown, lambda t, s: t == s), lambda same: same))
    return equal >= SIMILARITY * F.size(tokens)


def _members(pairs: DataFrame) -> DataFrame:
    """Those of rows (line, template, ...) in which enough tokens are equal."""
    pairs = pairs.withColumn("tokens", F.split("line", " ")).withColumn(
        "shown", F.split("template", " ")
    )
    return pairs.where(_is_alike("tokens", "shown")).drop("tokens", "shown")


_KEY = ["leaf", "nth", "run"]


def _runs(rows: DataFrame, text: str) -> DataFrame:
    """Each row once for every run of its tokens."""
    # Tokens are a column of their own: within the lambda each use would split the line anew.
    with_tokens = rows.withColumn("tokens", F.split(text, " "))
    runs = F.posexplode(_segments(F.col("tokens"))).alias("nth", "run")
    return with_tokens.select("*", runs).drop("tokens")


def _elements(rows: DataFrame, text: str) -> DataFrame:
    """Each row once for every token behind the leading ones, hashed with its place."""
    placed = rows.select("*", F.posexplode(F.split(text, " ")).alias("place", "token"))
    placed = placed.where(F.col("place") >= LEADING_TOKENS)
    return placed.withColumn("element", F.xxhash64("place", "token")).drop("place", "token", text)


def _rarest(rows: DataFrame, text: str, support: DataFrame, columns: list[str]) -> DataFrame:
    """Each row once for the tokens that the fewest templates have, one more than may differ, as
    `run`. A line and a template that it goes with have one of them in common.
    """
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce("support", F.lit(0)), "element")))
    size = F.size("ordered") + LEADING_TOKENS
    rarest = F.slice("ordered", 1, (size - F.ceil(SIMILARITY * size) + 1).cast("int"))
    return (
        _elements(rows.select(*columns, text), text)
        .join(support, ["leaf", "element"], "left")
        .groupBy(*columns)
        .agg(ordered.alias("ordered"))
        .select(*columns, F.lit(-1).alias("nth"), F.explode(rarest.getField("element")).alias("run"))
    )


def _near(rare: DataFrame, recurring: DataFrame) -> DataFrame:
    """(line_hash, line_check, keeper) of rare lines and the recurring templates that they go
    with, the least keeper of each line among them.

    Templates are met on equal runs of tokens. A line is first compared with the template of
    the least keeper for each of its runs; then, where others could have a lesser one than is
    found by then, with all of these. Where they are many, the line may meet templates on its
    rarest tokens instead, if these have fewer.
    """
    ours = ["leaf", *_LINE]
    postings = stored(_runs(recurring.select("leaf", "template", "keeper"), "template"), "postings")
    first = F.min(F.struct("keeper", "template")).alias("first")
    centres = stored(
        postings.groupBy(*_KEY)
        .agg(first, F.count(F.lit(1)).alias("n"))
        .select(*_KEY, "first.keeper", "first.template", "n"),
        "centres",
    )
    met = lookup_join(_runs(rare.select(*ours, "line"), "line"), centres, _KEY)
    met = met.withColumn("tokens", F.split("line", " ")).withColumn("shown", F.split("template", " "))
    further = F.when(F.col("n") > 1, F.struct("nth", "run", "keeper", "n"))
    is_open = lambda k: F.col("bound").isNull() | (k["keeper"] < F.col("bound"))
    compared = stored(
        met.groupBy(*ours)
        .agg(
            F.min(F.when(_is_alike("tokens", "shown"), F.col("keeper"))).alias("bound"),
            F.collect_list(further).alias("runs"),
        )
        .withColumn("runs", F.filter("runs", is_open))
        .where(F.col("bound").isNotNull() | (F.size("runs") > 0)),
        "compared",
    )
    near = compared.where("bound IS NOT NULL").select(*_LINE, F.col("bound").alias("keeper"))
    left = compared.where(F.size("runs") > 0)
    if left.isEmpty():
        return near
    cost = F.aggregate("runs", F.lit(0).cast("bigint"), lambda sum_, k: sum_ + k["n"])
    left = stored(
        lookup_join(rare.select(*ours, "line"), left.withColumn("cost", cost), ours), "left"
    )
    crowded = left.where(F.col("cost") > CROWD)
    templates = stored(
        lookup_join(
            recurring.select("leaf", "template", "keeper"),
            stored(crowded.select("leaf").distinct(), "crowded-leaves"),
            "leaf",
        ),
        "crowded-templates",
    )
    support = stored(
        _elements(templates.drop("keeper"), "template")
        .groupBy("leaf", "element")
        .agg(F.count(F.lit(1)).alias("support")),
        "support",
    )
    rare_postings = stored(
        _rarest(templates.withColumn("shown", F.col("template")), "shown", support, ["leaf", "template", "keeper"]),
        "rare-postings",
    )
    sizes = stored(rare_postings.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")), "sizes")
    instead = (
        lookup_join(_rarest(crowded, "line", support, ours), sizes, _KEY, "left")
        .groupBy(*ours)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("other_cost"),
            F.collect_list(F.when(F.col("n") > 0, F.struct("nth", "run"))).alias("other_runs"),
        )
    )
    by_runs = F.transform("runs", lambda k: F.struct(k["nth"].alias("nth"), k["run"].alias("run")))
    chosen = F.when(F.col("other_cost") < F.col("cost"), F.col("other_runs")).otherwise(by_runs)
    keys = left.join(stored(instead, "instead"), ours, "left").select(
        *ours, "line", "bound", F.explode(chosen).alias("key")
    )
    keys = keys.select("leaf", "key.*", *_LINE, "line", "bound")
    pairs = lookup_join(keys, postings.unionByName(rare_postings), _KEY)
    pairs = pairs.where(F.col("bound").isNull() | (F.col("keeper") < F.col("bound")))
    return near.unionByName(_members(pairs).select(*_LINE, "keeper"))


def _variants(rare: DataFrame, recurring: DataFrame) -> DataFrame:
    """(line_hash, line_check, keeper) of rare lines that go with a template of their leaf: with a
    recurring one, whichever it is, or with the consensus of the leaf's rare lines if enough
    documents do.
    """
    near = _near(rare, recurring)
    gathered = stored(
        _members(rare.join(_consensus(rare), "leaf")).drop("line", "template"), "gathered"
    )
    enough = (
        gathered.groupBy("leaf", "needed")
        .agg(
            F.sum("n_docs").alias("n_docs"),
            F.min("first_doc").alias("keeper"),
            F.max("last_doc").alias("last_doc"),
        )
        .where((F.col("n_docs") >= F.col("needed")) & (F.col("last_doc") > F.col("keeper")))
        .select("leaf", "keeper")
    )
    return near.unionByName(gathered.join(enough, "leaf").select(*_LINE, "keeper"))


def _generalised(docs: DataFrame, counted: DataFrame, needed: Column) -> DataFrame:
    """(line_hash, line_check, keeper) of lines that recur as a template with fields, or are
    rare variants of one.
    """
    leaves = stored(
        counted.where(F.col("n_tokens") >= MIN_TOKENS)
        .groupBy("leaf", needed.alias("needed"))
        .agg(F.sum("n_docs").alias("n_docs"), F.count(F.lit(1)).alias("n_lines"))
        .where((F.col("n_docs") >= F.col("needed")) & (F.col("n_lines") > 1))
        .select("leaf"),
        "leaves",
    )
    # Only here is the text of lines moved, of those that share a leaf with others.
    long_lines = _document_lines(docs).where(F.col("n_tokens") >= MIN_TOKENS)
    leaf_lines = stored(
        lookup_join(long_lines.select("leaf", "line", "n_tokens", "doc_id"), leaves, "leaf")
        .groupBy("leaf", "line", "n_tokens")
        .agg(*_counts())
        .select("*", needed.alias("needed"), *_hashes())
        .drop("n_tokens"),
        "leaf-lines",
    )
    templated = stored(
        leaf_lines.drop("line").join(_templates(leaf_lines), ["leaf", "line_hash"]),
        "templates",
    )
    recurring = stored(
        templated.groupBy("leaf", "needed", "template")
        .agg(
            F.sum("n_docs").alias("n_docs"),
            F.min("first_doc").alias("keeper"),
            F.max("last_doc").alias("last_doc"),
        )
        .where((F.col("n_docs") >= F.col("needed")) & (F.col("last_doc") > F.col("keeper"))),
        "recurring-templates",
    )
    same = stored(
        templated.select("leaf", "template", *_LINE)
        .join(recurring, ["leaf", "template"])
        .select("leaf", *_LINE, "keeper"),
        "same",
    )
    rare = stored(leaf_lines.join(same.drop("keeper"), ["leaf", *_LINE], "left_anti"), "rare")
    return same.drop("leaf").unionByName(_variants(rare, recurring))


def drop_recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, long_min_docs: int = LONG_MIN_DOCS
) -> DataFrame:
    """All columns of `docs` with recurring lines dropped from `text`; `n_lines` (before) and
    `n_dropped` are added, columns of those names replaced.

    Every row stays, also one whose lines all go (its text is then empty). Rows are counted
    as documents, rows that repeat a doc_id too; all rows of the keeper's id keep the line. A
    line that repeats within one document only is kept; blank lines never count. NULL text
    stays NULL and has no lines; a NULL doc_id is never a keeper unless all are NULL. A
    document with two lines of one template counts twice towards `min_docs`, but a template
    with variable fields must occur under two different ids. Lines of `LONG_TOKENS` and more
    recur from `long_min_docs` documents on. Variants: see `_variants`.
    """
    columns, docs = docs.columns, pack_rest(docs)
    spark, before = docs.sparkSession, scratch_mark()
    lines = stored(
        _document_lines(docs).select("row_key", "doc_id", "n_tokens", "leaf", *_LINE), "lines"
    )
    with_lines = scratch_mark()
    # Copies of a line combine before the shuffle.
    counted = stored(lines.groupBy(*_LINE, "n_tokens", "leaf").agg(*_counts()), "counted-lines")
    needed = _needed(min_docs, long_min_docs)
    exact = counted.where(F.col("n_docs") >= needed).select(
        *_LINE, F.col("first_doc").alias("keeper")
    )
    recurring = stored(
        exact.unionByName(_generalised(docs, counted, needed))
        .groupBy(*_LINE)
        .agg(F.min("keeper").alias("keeper")),
        "recurring-lines",
    )
    # Lines and documents are shuffled below: what is not needed any more makes room.
    keep_last_stored(spark, with_lines)
    gone = stored(
        lookup_join(lines, recurring, _LINE)
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("row_key").alias("gone_key"))
        .agg(F.collect_set("line_hash").alias("gone")),
        "gone",
    )
    keep_last_stored(spark, before)
    # Rows of documents are large and those of `gone` small: these are hashed, not sorted.
    joined = docs.join(gone.hint("shuffle_hash"), row_key() == F.col("gone_key"), "left")
    pairs = F.arrays_zip(
        F.split("text", "\n").alias("line"), F.split(_masked("text"), "\n").alias("masked")
    )
    is_kept = lambda pair: ~F.array_contains("gone", F.xxhash64(pair["masked"]))
    kept = F.when(F.col("gone").isNotNull(), F.filter(pairs, is_kept))
    n_lines = F.coalesce(_count("text", "\n") + 1, F.lit(0)).cast("bigint")
    n_kept = F.coalesce(F.size("kept"), n_lines)
    shorter = F.when(F.col("kept").isNull(), F.col("text")).otherwise(
        F.array_join("kept.line", "\n")
    )
    return unpack_rest(
        joined.withColumn("kept", kept),
        columns,
        text=shorter,
        n_lines=n_lines,
        n_dropped=F.when(F.col("kept").isNull(), 0).otherwise(n_lines - n_kept).cast("bigint"),
    )


def dedup_summary(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, and the length and digest of the text that stays."""
    kept = drop_recurring_lines(docs.select("doc_id", "text"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        code_points("text").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
