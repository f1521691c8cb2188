"""Small pieces shared by the operators: byte-level word splitting, record batches, the public tokenizers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

#: A-Z to a-z, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8.

    ``bytes.split`` without arguments splits at exactly these six bytes.
    """
    return (text or "").encode().translate(LOWER).split()


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds at most ``max_bytes`` of ``column``, or one row."""
    for batch in batches:
        lengths = batch.column(batch.schema.get_field_index(column))
        start = size = 0
        for i, n in enumerate(pa.compute.binary_length(lengths).fill_null(0).to_pylist()):
            if i > start and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


#: Byte values of words: all but the six of ASCII white space.
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.frombuffer(LOWER, np.uint8)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers so that every bit depends on every other."""
    x = (x ^ x >> np.uint64(32)) * _MULTIPLIER
    x = (x ^ x >> np.uint64(29)) * _MULTIPLIER
    return x ^ x >> np.uint64(32)


class Words:
    """The words of a column of texts (null: empty) as arrays and not as objects, A-Z lower-cased unless told not to.

    ``data`` holds the bytes of all texts, ``starts`` and ``ends`` the words' places in
    it, and ``bounds`` the first word of each text, with the count of all behind.
    """

    def __init__(self, texts: pa.Array, inside: np.ndarray = SOLID, lower: bool = True) -> None:
        column = texts.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        content = column.buffers()[2]
        self.data = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]] if content is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        if lower:
            self.data = _LOWER[self.data]
        self.offsets = offsets - offsets[0]
        self.solid = inside[self.data]
        first, last = self.solid.copy(), self.solid.copy()
        first[1:] &= ~self.solid[:-1]
        last[:-1] &= ~self.solid[1:]
        # Words end with their text, also where the next one begins with a word.
        edges = self.offsets[:-1][np.diff(self.offsets) > 0]
        first[edges] = self.solid[edges]
        edges = self.offsets[1:][np.diff(self.offsets) > 0] - 1
        last[edges] = self.solid[edges]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def numbered(self) -> tuple[np.ndarray, list[bytes]]:
        """Each word's place in the list of distinct words, and that list."""
        edges = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=edges[1:])
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(self.data[self.solid].tobytes())])
        found = flat.dictionary_encode()
        return np.asarray(found.indices).astype(np.int64), found.dictionary.to_pylist()

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; each distinct one is hashed once."""
        at, distinct = self.numbered()
        return np.array([xxhash.xxh64_intdigest(w, seed) for w in distinct], np.uint64)[at]
