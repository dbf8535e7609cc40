"""Fill-in-the-middle transformation by in-place block rotation.

A text is cut into prefix, middle and suffix at two unit boundaries. The sentinels go into a bytearray of the text, and
neighbouring segments change places by rotations: three reversals each, done in place in blocks of a fixed size. The
inverse rotations put an output's segments back, and without the sentinels it is the text again, byte for byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
BLOCK = 1 << 16  # bytes exchanged at once


@dataclass(frozen=True)
class Rates:
    """Of a hundred texts, how many are cut at all, and of a hundred of those, how many put the suffix first."""

    cut: int = 50
    suffix_first: int = 80
    seed: int = 42


def unit_ends(text: bytes) -> np.ndarray:
    """Where units end: a word with the white space before it, or the white space after the last word."""
    codes = np.frombuffer(text, np.uint8)
    blank = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1 if len(codes) else np.zeros(0, np.int64)
    return np.append(ends, len(codes)) if len(codes) and blank[-1] else ends


def characters(text: bytes | memoryview) -> int:
    """Code points: bytes that do not continue one."""
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def reverse(cells: np.ndarray, start: int, end: int) -> None:
    while end - start > 1:
        n = min(BLOCK, (end - start) // 2)
        left = cells[start : start + n].copy()
        cells[start : start + n] = cells[end - n : end][::-1]
        cells[end - n : end] = left[::-1]
        start, end = start + n, end - n


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the neighbouring segments ``start..cut`` and ``cut..end``."""
    cells = np.frombuffer(buffer, np.uint8)
    reverse(cells, start, cut)
    reverse(cells, cut, end)
    reverse(cells, start, end)


def infill(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text cut at two byte offsets, its segments in the order of ``form``, each after its sentinel."""
    out = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        out[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(out, middle if form == PSM else 0, suffix, len(out))
    return out


def undo(output: bytes, form: str) -> bytes:
    """The text of an output. A text that is cut holds no sentinel, nor can one arise where it meets one."""
    if form == PLAIN:
        return output
    out = bytearray(output)
    middle = out.index(MIDDLE)
    if form == PSM:
        suffix = out.index(SUFFIX)
        rotate(out, suffix, middle, len(out))
        starts = (0, suffix, suffix + len(out) - middle)
    else:
        prefix = out.index(PREFIX)
        rotate(out, 0, prefix, len(out))
        starts = (0, middle - prefix, len(out) - prefix)
    for at in reversed(starts):
        del out[at : at + 3]
    return bytes(out)


def transformed(doc_id: int | None, text: bytes, rates: Rates) -> tuple[int, str, bytes, int | None, int | None]:
    """``n, form, output, prefix_chars, middle_chars`` of one document."""
    ends = unit_ends(text)
    n = len(ends)
    digest = sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    if not text or h3 % 100 >= rates.cut or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, text, None, None
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    form = SPM if h4 % 100 < rates.suffix_first else PSM
    whole = memoryview(text)
    out = bytes(infill(text, first, second, form))
    return n, form, out, characters(whole[:first]), characters(whole[first:second])


FIELDS = {
    "n": pa.int64(),
    "form": pa.string(),
    "output": pa.binary(),
    "prefix_chars": pa.int64(),
    "middle_chars": pa.int64(),
}


def transform(documents: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """``doc_id, n, form, output, prefix_chars, middle_chars`` for every row: units, ``plain``, ``psm`` or ``spm``, the
    transformed text, and the code points of its first two segments (null if plain).

    Null text counts as empty and stays plain; so do texts that hold a sentinel. A null doc_id hashes like no digits.
    Blank texts have one unit. Repeated rows each get a row, all alike. Very long texts cost about three times their
    size in the task that holds them. Empty table: empty result. Other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text")
            made = [transformed(i.as_py(), t.as_py() or b"", rates) for i, t in zip(ids, texts, strict=True)]
            columns = zip(*made, strict=True) if made else ((),) * len(FIELDS)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, FIELDS.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *arrays], names=["doc_id", *FIELDS])

    kind = documents.schema["doc_id"].dataType.simpleString()
    bare = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = bare.mapInArrow(
        run, f"doc_id {kind}, n bigint, form string, output binary, prefix_chars bigint, middle_chars bigint"
    )
    return out.withColumn("output", F.col("output").cast("string"))


@F.pandas_udf(BinaryType())
def _undo(outputs: pd.Series, forms: pd.Series) -> pd.Series:
    return pd.Series([undo(bytes(o), f) for o, f in zip(outputs, forms, strict=True)], dtype="object")


def restored(output: Column, form: Column) -> Column:
    """The exact text behind an output. Null outputs give null."""
    filled = F.coalesce(output.cast("binary"), F.lit("").cast("binary"))
    text = _undo(filled, F.coalesce(form, F.lit(PLAIN))).cast("string")
    return F.when(output.isNotNull(), text)
