"""Helpers for Arrow-batched functions over texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

# A slice of a batch is worked on at a time, so that what a task holds beside the batch stays bounded.
SLICE_CHARS = 2_000_000


def text_slices(batch: pa.RecordBatch, text: int = 1, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, texts) runs of rows with about ``chars`` characters; a null text is an empty one."""
    values = [t or "" for t in batch.column(text).to_pylist()]
    start = size = 0
    for i, value in enumerate(values):
        size += len(value)
        if size >= chars:
            yield start, i + 1, values[start : i + 1]
            start, size = i + 1, 0
    if start < len(values):
        yield start, len(values), values[start:]


class Memo:
    """Values by key, computed in bulk; two generations of at most ``entries`` keys, the older one is dropped.

    Keys beyond ``long_key`` characters are kept for one batch only, so that memory stays bounded.
    """

    def __init__(self, compute, entries: int = 150_000, long_key: int = 64):
        self.compute, self.entries, self.long_key = compute, entries, long_key
        self.now, self.old, self.long = {}, {}, []

    def prepare(self, keys: set) -> dict:
        """A dict that has (at least) all ``keys``."""
        for key in self.long:
            self.now.pop(key, None)
        missing = keys.difference(self.now)
        if missing and len(self.now) + len(missing) > self.entries and self.now:
            self.old, self.now = self.now, {}
            missing = keys
        fresh = []
        for key in missing:
            value = self.old.get(key)
            if value is None:
                fresh.append(key)
            else:
                self.now[key] = value
        self.now.update(zip(fresh, self.compute(fresh), strict=True))
        self.long = [key for key in fresh if len(key) > self.long_key]
        return self.now
