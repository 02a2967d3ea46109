"""Texts of a task's batch as arrays of token codes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def letter_tokens(texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Runs of letters, marks and digits in lower case: (words, codes, ends).

    ``codes`` number the tokens of all texts by ``words``; those of text i are
    ``codes[ends[i]:ends[i + 1]]``. Null texts have none.
    """
    lower = pc.utf8_lower(pa.array([t or "" for t in texts], type=pa.large_string()))
    return _coded(pc.split_pattern_regex(lower, r"[^\pL\pM\pN]+"))


def space_tokens(texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Runs of anything but ASCII white space, with only A-Z made lower case; as above."""
    # On UTF-8 the ASCII kernels leave all bytes beyond ASCII alone.
    lower = pc.ascii_lower(pa.array([t or "" for t in texts], type=pa.large_string()))
    return _coded(pc.ascii_split_whitespace(lower))


def _coded(lists: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    ends = offsets - offsets[0] if len(offsets) else np.zeros(1, dtype=np.int64)
    # Splitting leaves empty strings at the ends and for empty texts.
    blank = words.index("") if "" in words else -1
    real = codes != blank
    ends = np.r_[0, np.cumsum(real)][ends]
    return words, codes[real], ends
