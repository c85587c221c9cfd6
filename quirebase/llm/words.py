"""Words and columns shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

#: A word is a longest run of Unicode letters or digits. ``\w`` without the
#: underscore is the same set of code points as the categories L and N.
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words of a text; a null text has none."""
    return [w.lower() for w in WORD.findall(text)] if text else []


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 1_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """Parts of a batch of about ``chars`` characters, as (first row, texts).

    Bounds what a task holds at a time; a text is never divided.
    """
    values = batch.column(column)
    start, size, part = 0, 0, []
    for row in range(len(values)):
        text = values[row].as_py()
        part.append(text)
        size += len(text) if text else 0
        if size >= chars:
            yield start, part
            start, size, part = row + 1, 0, []
    if part:
        yield start, part
