"""Quotation linking: which message a message answers, told by the text it quotes.

Lines are parsed into quote levels (`>`, `> >`, ...). Runs of lines of one level are
passages; the normalised passage is hashed, and so are its lines, its sentences and its runs of
2, 4, 8, ... sentences, each run from its halves' hashes. The original of a passage is the first message of the conversation that holds it unquoted. A message answers
the message that its outermost matched quotes come from. Ordering by `reply_path` puts
every message below the one it answers; `body` is its text without quotes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket_marts.llm.common import lookup_join, stored, text_slices

# Fixed value: the quote marks before a line.
QUOTE = re.compile(r"((?:[ \t]*>)+)[ \t]?")
# Fixed value: the line in front of a quote that says whose words follow.
ATTRIBUTION = re.compile(r"[ \t]*on\b.*\bwrote:[ \t]*", re.IGNORECASE)


# Fixed value: where a sentence ends in normalised text.
SENTENCE_END = re.compile(r"(?<=[.!?…]) |(?<=[.!?…][\"')\]”’»]) |(?<=[。！？]) ?")


def quote_levels(text: str) -> list[tuple[int, str]]:
    """(level, text) of each line, without quote marks and attribution lines."""
    found = []
    for line in re.split(r"\r\n?|\n", text):
        marks = QUOTE.match(line)
        level = marks[1].count(">") if marks else 0
        if found and level > found[-1][0] and ATTRIBUTION.fullmatch(found[-1][1]):
            found.pop()
        found.append((level, line[marks.end() :] if marks else line))
    return found


def passages(lines: list[tuple[int, str]]) -> set[tuple[int, str]]:
    """(level, normalised text) of each run of lines of one level, each paragraph of it and each
    line, so that quotes of parts and re-wrapped quotes find their original too.
    """
    found = set()
    for level, run in groupby(lines, key=lambda line: line[0]):
        texts = [text for _, text in run]
        whole = "\n".join(texts)
        units = (whole, *re.split(r"\n[ \t]*\n", whole), *texts)
        found.update((level, " ".join(unit.lower().split())) for unit in units)
    return {(level, unit) for level, unit in found if unit}


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def passage_hashes(text: str) -> set[bytes]:
    """Hashes of a normalised text as a sequence of sentences, of each sentence, and of all its
    runs of 2, 4, 8, ... sentences.

    Any run of sentences is two of these that overlap, so a quote of some sentences shares
    its longest ones with the text it is from. A run is hashed from the hashes of its halves:
    there are n log n hashes for n sentences, and no text is put together again.
    """
    runs = [[_digest(s.encode()) for s in SENTENCE_END.split(text) if s]]
    n, half = len(runs[0]), 1
    while 2 * half <= n:
        before = runs[-1]
        runs.append([_digest(before[i] + before[i + half]) for i in range(n - 2 * half + 1)])
        half *= 2
    # The whole is told by its longest runs of such lengths, from the left.
    parts, at = [], 0
    for power in range(len(runs) - 1, -1, -1):
        if n >> power & 1:
            parts.append(runs[power][at])
            at += 1 << power
    found = {run for of_length in runs for run in of_length}
    return found | {parts[0] if len(parts) == 1 else _digest(b"".join(parts))} if parts else found


def _hashes_of(lines: list[tuple[int, str]]) -> tuple[list[int], list[bytes]]:
    found = {(level, run) for level, unit in passages(lines) for run in passage_hashes(unit)}
    return [level for level, _ in found], [run for _, run in found]


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, passages) of each message; passages are (level, hash), and
    there are none where nobody in the conversation quotes anything.
    """
    marked = F.coalesce(F.col("text").rlike(r"(?:^|[\r\n])[ \t]*>"), F.lit(False))
    quoting = stored(
        messages.where(marked & F.col("conv_id").isNotNull())
        .select("conv_id", F.lit(True).alias("is_quoting"))
        .distinct(),
        "quoting",
    )
    rows = lookup_join(messages.select("conv_id", "turn", "role", "text"), quoting, "conv_id", "left")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            bodies, ends, levels, hashes = [], [0], [], []
            texts = batch.column("text").fill_null("").to_pylist()
            for text, is_quoting in zip(texts, batch.column("is_quoting").to_pylist()):
                lines = quote_levels(text)
                bodies.append("\n".join(line for level, line in lines if not level).strip())
                if is_quoting:
                    own_levels, own_hashes = _hashes_of(lines)
                    levels += own_levels
                    hashes += own_hashes
                ends.append(len(levels))
            units = pa.StructArray.from_arrays(
                [pa.array(levels, pa.int32()), pa.array(hashes, pa.binary())], ["level", "hash"]
            )
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), units)
            columns = [batch.column(c) for c in ("conv_id", "turn", "role")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bodies, pa.string()), found],
                names=["conv_id", "turn", "role", "body", "passages"],
            )

    schema = (
        "conv_id bigint, turn bigint, role string, body string, "
        "passages array<struct<level:int,hash:binary>>"
    )
    return rows.mapInArrow(parse, schema)


def reply_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_quotes) of messages with a quote whose original is known.

    Of the matched passages those of the lowest quote level count; the message most of them
    come from is answered, the later one in a tie. Of the unquoted passages only those that
    are quoted are kept, one row each before the join, so a passage that many messages repeat
    does not multiply.
    """
    identified = messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    units = identified.select("conv_id", "turn", F.explode("passages").alias("unit")).select(
        "conv_id", "turn", "unit.level", "unit.hash"
    )
    quoted = stored(units.where("level > 0").distinct(), "quoted-passages")
    wanted = stored(quoted.select("conv_id", "hash").distinct(), "wanted-passages")
    originals = (
        lookup_join(units.where("level = 0"), wanted, ["conv_id", "hash"])
        .groupBy("conv_id", "hash")
        .agg(F.min("turn").alias("reply_to"))
    )
    matched = (
        quoted.join(originals, ["conv_id", "hash"])
        .where(F.col("reply_to") < F.col("turn"))
        .groupBy("conv_id", "turn", "level", "reply_to")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max(F.struct(-F.col("level"), F.col("n"), F.col("reply_to").alias("reply_to")))
    return matched.groupBy("conv_id", "turn").agg(
        best["reply_to"].alias("reply_to"), F.sum("n").alias("n_quotes")
    )


def reply_paths(links: DataFrame) -> DataFrame:
    """(conv_id, turn, path): turns from the conversation's first message down to each reply.

    Paths double in length per round: what is known of the message at the head of a path
    goes in front of it. Links lead to earlier turns, so there is no cycle.
    """
    paths = stored(
        links.select("conv_id", "turn", F.array("reply_to", "turn").alias("path")), "paths"
    )
    while True:
        head = paths.select(
            "conv_id", F.col("turn").alias("head"), F.col("path").alias("above")
        )
        longer = stored(
            paths.withColumn("head", F.col("path")[0])
            .join(head, ["conv_id", "head"], "left")
            .select(
                "conv_id",
                "turn",
                F.when(
                    F.col("above").isNotNull(),
                    F.concat("above", F.slice("path", 2, F.size("path"))),
                )
                .otherwise(F.col("path"))
                .alias("path"),
                F.col("above").isNotNull().alias("grew"),
            ),
            "paths",
        )
        paths = longer.drop("grew")
        if longer.where("grew").isEmpty():
            return paths


def linked_conversations(messages: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with reply_to, n_quotes, reply_path and body.

    Without a matched quote reply_to is NULL and the path is the turn alone. A message whose
    conv_id or turn is NULL is linked to nothing (path NULL without a turn). Rows that
    repeat a turn share its links: their quotes count together, a passage once. NULL text
    counts as empty; other columns are dropped. `body` has no leading or trailing blanks.
    """
    rows = parsed(messages)
    links = stored(reply_links(rows), "reply-links")
    found = links.join(reply_paths(links), ["conv_id", "turn"])
    own_path = F.when(F.col("turn").isNotNull(), F.array("turn"))
    return rows.join(found, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "reply_to",
        F.coalesce("n_quotes", F.lit(0)).cast("bigint").alias("n_quotes"),
        F.coalesce("path", own_path).alias("reply_path"),
        "body",
    )


def in_reply_order(linked: DataFrame) -> DataFrame:
    """Conversations one after another, each message below the one it answers."""
    return linked.orderBy("conv_id", "reply_path", "role", "body")
