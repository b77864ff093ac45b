"""Fill-in-middle transformation by rotating blocks in place.

A text is cut into units (lines) and, at two unit boundaries, into prefix, middle and suffix. In a bytearray of the text, a
sentinel is inserted before each part; then parts change places by a rotation, which is three reversals. Undoing the rotation and
removing the sentinels restores the text exactly, from the output and the form alone.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import unused
from tidelane.llm.words import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MADE = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"

#: Bytes exchanged at once by a reversal, all the room it needs beside the text.
STEP = 1 << 16


def reverse(data: np.ndarray, start: int, end: int) -> None:
    """Reverse the bytes from ``start`` up to ``end`` in place, exchanging stretches from both ends."""
    while end - start > 1:
        size = min(STEP, (end - start) // 2)
        left = data[start : start + size].copy()
        data[start : start + size] = data[end - size : end][::-1]
        data[end - size : end] = left[::-1]
        start, end = start + size, end - size


def rotate(data: np.ndarray, start: int, middle: int, end: int) -> None:
    """Exchange the blocks from ``start`` up to ``middle`` and from there up to ``end``, in place."""
    reverse(data, start, middle)
    reverse(data, middle, end)
    reverse(data, start, end)


def rearrange(text: bytes, first: int, second: int, form: str) -> bytes:
    """A text with the cuts ``first`` and ``second`` (byte offsets) in the given form. It must not contain a sentinel."""
    if form == "plain":
        return text
    data = bytearray(text)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        data[at:at] = mark
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    view = np.frombuffer(data, np.uint8)
    if form == "psm":
        rotate(view, middle, suffix, len(data))
    elif form == "spm":
        rotate(view, 0, suffix, len(data))
    else:
        raise ValueError(f"no such form: {form}")
    del view
    return bytes(data)


def restore(output: bytes, form: str) -> bytes:
    """The text that ``rearrange`` was given."""
    if form == "plain":
        return output
    data = bytearray(output)
    view = np.frombuffer(data, np.uint8)
    if form == "psm":
        # The suffix block's length tells where the middle goes back to.
        suffix, middle = data.index(SUFFIX), data.index(MIDDLE)
        rotate(view, suffix, middle, len(data))
    elif form == "spm":
        rotate(view, 0, data.index(PREFIX), len(data))
    else:
        raise ValueError(f"no such form: {form}")
    del view
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = data.index(mark)
        del data[at : at + len(mark)]
    return bytes(data)


def line_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which the units of a text end: after each line feed, and at the end of the text."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if not len(data) or data[-1] == 10 else np.append(ends, len(data))


def _chars(data: np.ndarray) -> int:
    """Code points of a stretch of UTF-8: all bytes but those that continue one."""
    return int(len(data) - ((data & 0xC0) == 0x80).sum())


def draws(key: str, row_id: Column) -> list[Column]:
    """Four numbers below 2^32 for each row id, from the digest of the key, a colon and the id; a null id counts as ''."""
    digest = F.sha2(F.concat(F.lit(f"{key}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _make(text: str, into: str, drawn: list[str], fim_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, text):
                made = []
                for raw, *h in zip(texts.to_pylist(), *(rows[c].to_pylist() for c in drawn), strict=True):
                    data = np.frombuffer(raw, np.uint8)
                    ends = line_ends(data)
                    n = len(ends)
                    if not raw or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= fim_percent:
                        made.append({"n": n, "form": "plain", "output": raw.decode()})
                        continue
                    form = "spm" if h[3] % 100 < spm_percent else "psm"
                    first, second = (int(ends[c - 1]) if c else 0 for c in sorted((h[0] % (n + 1), h[1] % (n + 1))))
                    sizes = {"prefix_chars": _chars(data[:first]), "middle_chars": _chars(data[first:second])}
                    made.append({"n": n, "form": form, "output": rearrange(raw, first, second, form).decode()} | sizes)
                at = rows.schema.get_field_index(into)
                yield rows.set_column(at, rows.schema.field(into), pa.array(made, rows.schema.field(into).type)).drop_columns(drawn)

    return run


def fill_in_middle(docs: DataFrame, into: str, row_id: str = "doc_id", key: str = "7", fim_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Cuts and form follow from ``key`` and the row's id only, so a repeated job, and an equal row, gives the same; rows of one id but different
    texts share their draws. ``fim_percent`` of the rows are rearranged, ``spm_percent`` of those as spm. A null text counts as empty; an empty text, and one
    that contains a sentinel, stays plain, and a plain row's character counts are null. Parts may be empty. Other columns
    pass through; an earlier column ``into`` is replaced.
    """
    drawn: list[str] = []
    numbered = docs.withColumn(into, F.lit(None).cast(MADE))
    kept = numbered.schema
    for column in draws(key, docs[row_id]):
        drawn.append(unused(numbered, "draw"))
        numbered = numbered.withColumn(drawn[-1], column)
    return numbered.mapInArrow(_make("text", into, drawn, fim_percent, spm_percent), kept)


def _undo(output: str, form: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch, output):
                made = [restore(t, f).decode() for t, f in zip(texts.to_pylist(), rows[form].to_pylist(), strict=True)]
                at = rows.schema.get_field_index(into)
                yield rows.set_column(at, rows.schema.field(into), pa.array(made, rows.schema.field(into).type))

    return run


def restored(made: DataFrame, output: str, form: str, into: str) -> DataFrame:
    """``made`` with a column ``into``: the text rebuilt from the columns ``output`` and ``form`` alone; '' where the text was null."""
    out = made.withColumn(into, F.lit(None).cast("string"))
    return out.mapInArrow(_undo(output, form, into), out.schema)
