"""Words of a column of texts as arrays, for work inside tasks that looks at every word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Bytes of lower-case ASCII words and numbers.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1)]] = True


def numbered_words(texts: pa.Array, inside: np.ndarray = ALNUM) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text number and word number of each word, and the distinct words; a null text has none.

    Words are runs of the bytes marked in ``inside``.
    """
    column = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    content = column.buffers()[2]
    data = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]] if content is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    kept = inside[data]
    # A word begins behind another byte, or with its text.
    before = np.concatenate([[False], kept[:-1]])
    before[(offsets[:-1] - offsets[0])[np.diff(offsets) > 0]] = False
    starts = np.flatnonzero(kept & ~before)
    lengths = np.add.reduceat(kept, starts, dtype=np.int64) if len(starts) else starts
    edges = np.concatenate([[0], np.cumsum(lengths)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges.tobytes()), pa.py_buffer(data[kept].tobytes())).dictionary_encode()
    of = np.searchsorted(offsets - offsets[0], starts, "right") - 1
    return of, np.asarray(words.indices).astype(np.int64), words.dictionary


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to at most ``most``, or of a single row."""
    edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + most, "right")) - 1)
        yield at, end
        at = end
