"""Words of whole texts as arrays: runs of a-z, 0-9 and all beyond ASCII, A-Z made lower case.

Works on the bytes of a batch at once. ASCII bytes never occur within a longer UTF-8
character, so cutting at them leaves every word valid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words for checking engines: of texts whose A-Z are in lower case.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = (
    (_BYTES >= 128)
    | ((_BYTES >= ord("0")) & (_BYTES <= ord("9")))
    | ((_BYTES >= ord("a")) & (_BYTES <= ord("z")))
)


def byte_view(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary array without nulls; string i is bytes[o[i]:o[i+1]]."""
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    _, places, content = strings.buffers()
    kind = np.int64 if wide else np.int32
    if not len(strings):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    first = strings.offset
    offsets = np.frombuffer(places, dtype=kind)[first : first + len(strings) + 1].astype(np.int64)
    everything = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], everything[offsets[0] : offsets[-1]]


def binary_array(content: np.ndarray, offsets: np.ndarray) -> pa.LargeBinaryArray:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(content)]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def words(texts: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """(different words, code of each word, ends): text i has codes[ends[i]:ends[i + 1]].

    Null and empty texts have none. Takes about 30 bytes a byte of text while it runs.
    """
    offsets, content = byte_view(pc.fill_null(texts, ""))
    content = _LOWER[content]
    inside = _IN_WORD[content]
    # Neighbouring texts touch in the buffer, so their ends part words too.
    edge = offsets[offsets < len(content)]
    before = np.r_[False, inside[:-1]] if len(inside) else inside.copy()
    before[edge] = False
    begins = np.flatnonzero(inside & ~before)
    after = np.r_[inside[1:], False] if len(inside) else inside.copy()
    after[edge[edge > 0] - 1] = False
    stops = np.flatnonzero(inside & ~after) + 1
    lengths = np.r_[0, np.cumsum(stops - begins)]
    coded = binary_array(content[inside], lengths).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, codes, np.searchsorted(begins, offsets)


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int, rows: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of at most ``rows`` rows and about ``size`` bytes of ``column``.

    A longer single text is a table of its own.
    """
    held: list[pa.RecordBatch] = []
    held_size = held_rows = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for end, length in enumerate(lengths.tolist()):
            if held_rows and (held_size + length > size or held_rows >= rows):
                if end > begin:
                    held.append(batch.slice(begin, end - begin))
                yield pa.Table.from_batches(held)
                held, held_size, held_rows, begin = [], 0, 0, end
            held_size += length
            held_rows += 1
        if begin < len(lengths):
            held.append(batch.slice(begin))
    if held_rows:
        yield pa.Table.from_batches(held)
