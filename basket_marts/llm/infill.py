"""Fill-in-the-middle rewriting of texts by rotating blocks of bytes in place.

A text is cut at two line ends into prefix, middle and suffix. In one bytearray the cuts are
scanned, a sentinel is put before each part, and two neighbouring blocks change places by
three reversals: of the left block, of the right one, and of both together. The same rotation
with the blocks' lengths exchanged undoes it, so a text comes back from its output alone.

The draws come from a hash of the row's id, so a task that runs again rewrites alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from basket_marts.llm.common import text_slices

# The sentinels, and the forms a row may take.
PREFIX, SUFFIX, MIDDLE = SENTINELS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Text that a task rewrites at once; a longer one is rewritten alone.
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Draws:
    """Of 100 rows `rewritten` are rewritten, and of 100 of these `suffix_first` begin with
    the suffix. `seed` is part of what is hashed.
    """

    seed: int = 7
    rewritten: int = 100
    suffix_first: int = 50

    def of(self, doc_id: int | None) -> list[int]:
        """Four numbers below 2^32; a NULL id is hashed as the empty string."""
        key = f"{self.seed}:{'' if doc_id is None else doc_id}"
        digest = hashlib.sha256(key.encode()).hexdigest()
        return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def reverse(view: np.ndarray, start: int, stop: int) -> None:
    """Reverse a stretch in place, half of it being held at a time."""
    half = (stop - start) // 2
    if half:
        left = view[start : start + half].copy()
        view[start : start + half] = view[stop - half : stop][::-1]
        view[stop - half : stop] = left[::-1]


def rotate(buffer: bytearray, start: int, border: int, stop: int) -> None:
    """Exchange the blocks [start, border) and [border, stop) by three reversals."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    reverse(view, start, border)
    reverse(view, border, stop)
    reverse(view, start, stop)


def line_ends(data: bytes) -> np.ndarray:
    """Offset behind every line of a text; the last may lack its line feed."""
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 0x0A) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    return ends


def rewrite(data: bytes, form: str, first: int, second: int) -> bytearray:
    """The output for a text cut at byte offsets `first` <= `second`."""
    buffer = bytearray(data)
    if form == PLAIN:
        return buffer
    # From the back, so that offsets before a sentinel still hold.
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def restore(output: bytes, form: str) -> bytearray:
    """The text that `rewrite` was given, from its output and form.

    A text that holds a sentinel is never rewritten, and none can arise at a seam, so each is
    found at its only place.
    """
    buffer = bytearray(output)
    if form == PLAIN:
        return buffer
    suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    if form == PSM:  # prefix, suffix, middle
        rotate(buffer, suffix, middle, len(buffer))
    else:  # suffix, prefix, middle
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(sentinel)
        del buffer[at : at + len(sentinel)]
    return buffer


def _code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))


def _rewritten(doc_id: int | None, data: bytes, draws: Draws) -> tuple:
    ends = line_ends(data)
    cut_a, cut_b, whether, which = draws.of(doc_id)
    units = sorted((cut_a % (len(ends) + 1), cut_b % (len(ends) + 1)))
    plain = not data or whether % 100 >= draws.rewritten or any(s in data for s in SENTINELS)
    if plain:
        return len(ends), PLAIN, None, None, data
    first, second = (int(ends[u - 1]) if u else 0 for u in units)
    form = SPM if which % 100 < draws.suffix_first else PSM
    chars = _code_points(data[:first]), _code_points(data[first:second])
    return len(ends), form, *chars, bytes(rewrite(data, form, first, second))


def fill_in_middle(docs: DataFrame, draws: Draws = Draws()) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n (lines), form, prefix_chars, middle_chars (code
    points; NULL if plain) and the `output` text.

    Lines end behind a line feed or with the text. The prefix ends after the lower and the
    middle after the higher of two drawn numbers of lines, either of which may be 0 or all.
    Plain, that is unchanged, are empty and NULL texts (output: empty) and those that hold a
    sentinel. Rows keep their number, repeated ones included, and draw by their id alone; a
    NULL id is kept. Other columns are not read. No shuffle; a task holds one slice of text.
    """

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, size=SLICE_BYTES):
            ids = batch.column("doc_id")
            texts = batch.column("text").fill_null(b"").to_pylist()
            rows = [_rewritten(i, t, draws) for i, t in zip(ids.to_pylist(), texts)]
            n, form, before, between, output = zip(*rows)
            # Whole characters were moved, so what is UTF-8 stays so.
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n, type=pa.int64()),
                    pa.array(form),
                    pa.array(before, type=pa.int64()),
                    pa.array(between, type=pa.int64()),
                    pa.array(output, type=pa.binary()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    schema = (
        "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output binary"
    )
    turned = docs.selectExpr("doc_id", "CAST(text AS BINARY) AS text").mapInArrow(turn, schema)
    return turned.withColumn("output", turned["output"].cast("string"))


def restored(outputs: DataFrame) -> DataFrame:
    """All rows and columns of a frame with `form` and `output`, and the `restored` text, each
    rebuilt from these two alone. A NULL output, or one without form, has a NULL text.
    """

    def undo(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "output", SLICE_BYTES):
            pairs = zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())
            texts = [None if o is None or f is None else bytes(restore(o, f)) for o, f in pairs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, type=pa.binary())], schema=out
            )

    kept = [c for c in outputs.columns if c != "restored"]
    rows = outputs.select(*kept).withColumn("output", outputs["output"].cast("binary"))
    schema = rows.selectExpr("*", "CAST(NULL AS BINARY) AS restored").schema
    out = to_arrow_schema(schema)
    found = rows.mapInArrow(undo, schema)
    return found.select(
        *(found[c].cast("string").alias(c) if c in ("output", "restored") else found[c] for c in found.columns)
    )
