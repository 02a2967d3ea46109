"""Operator 6, token counts by byte-pair merging with a heap and a linked list.

A piece of text starts as one symbol per byte. The adjacent pair of lowest rank is popped
from a heap and merged, its neighbours in the linked list form new pairs, and so on until no
pair has a rank. The count is the number of bytes minus the number of merges; no token
identifiers are made.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how the byte-level vocabulary parts text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Symbols are numbers below 2 ** SHIFT; a pair of them is one number, and so is a heap entry.
SHIFT = 32
MASK = (1 << SHIFT) - 1


@dataclass
class Merges:
    """Ranks of adjacent symbols, and strings that are one token wherever they stand.

    Symbols 0 to 255 are the bytes; what a merge makes gets the next free number, bytes made
    in two ways one number. ``known`` remembers counts of short pieces; it stays with the
    vocabulary in a Python worker from task to task.
    """

    ranks: dict[int, int]  # left << SHIFT | right: rank
    made: list[int]  # by rank
    special: tuple[str, ...]
    known: dict[str, int] = field(default_factory=dict)


def byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte: itself if printable, else one past 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def read_merges(path: str) -> Merges:
    """Reads a byte-level BPE file of the ``tokenizers`` library; refuses what it doesn't count."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    model, parting = stored["model"], stored.get("pre_tokenizer") or {}
    expected = (
        model["type"] == "BPE"
        and parting.get("type") == "ByteLevel"
        and parting.get("use_regex", True)
        and not parting.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and not model.get("ignore_merges")
        and not stored.get("normalizer")
        and not any(t[k] for t in stored["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
    )
    if not expected:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    number = byte_letters()
    ranks: dict[int, int] = {}
    made = []
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made.append(number.setdefault(left + right, len(number)))
        ranks.setdefault(number[left] << SHIFT | number[right], rank)
    return Merges(ranks, made, tuple(t["content"] for t in stored["added_tokens"]))


def merged_count(piece: bytes, ranks: dict[int, int], made: list[int]) -> int:
    """Tokens of one piece: its bytes minus its merges. Ties of rank go to the left."""
    n = len(piece)
    symbol = list(piece)
    get = ranks.get
    # rank[i]: of the pair that begins at i, -1 if it has none or i has been merged away.
    rank = [get(a << SHIFT | b, -1) for a, b in zip(piece, piece[1:])]
    rank.append(-1)
    heap = [r << SHIFT | i for i, r in enumerate(rank) if r >= 0]
    if not heap:
        return n
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        r, i = entry >> SHIFT, entry & MASK
        if rank[i] != r:
            continue  # stale: a symbol of the pair has been merged since
        merges += 1
        j = after[i]
        k = after[i] = after[j]
        new = symbol[i] = made[r]
        rank[i] = rank[j] = -1
        if k < n:
            before[k] = i
            q = rank[i] = get(new << SHIFT | symbol[k], -1)
            if q >= 0:
                heappush(heap, q << SHIFT | i)
        h = before[i]
        if h >= 0:
            q = rank[h] = get(symbol[h] << SHIFT | new, -1)
            if q >= 0:
                heappush(heap, q << SHIFT | h)
    return n - merges


class Counter:
    """Counts tokens of texts; remembers the counts of up to ``memory`` short pieces."""

    def __init__(self, merges: Merges, memory: int = 1_000_000, longest: int = 64):
        self.merges = merges
        self.memory, self.longest = memory, longest
        self.pieces = regex.compile(PIECES).findall
        self.special = None
        if merges.special:
            ordered = sorted(merges.special, key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, ordered)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        known, get = self.merges.known, self.merges.known.get
        total, new = 0, []
        for piece in self.pieces(text):
            n = get(piece)
            if n is None:
                new.append(piece)
            else:
                total += n
        for piece in new:
            n = known.get(piece)
            if n is None:
                n = merged_count(piece.encode("utf-8", "replace"), self.merges.ranks, self.merges.made)
                if len(piece) <= self.longest:
                    if len(known) >= self.memory:
                        known.clear()
                    known[piece] = n
            total += n
        return total


def token_counts(documents: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``documents`` (doc_id, text).

    ``path`` is a vocabulary file on the driver; its merges, whose number the file fixes, are
    sent to the tasks. Nothing is added at the ends; a special string inside a text is one
    token. Whole texts of any length are counted; null and empty texts have 0 bytes and
    tokens; repeated rows and ids appear as given; an empty table gives no rows.
    """
    merges = documents.sparkSession.sparkContext.broadcast(read_merges(path))

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(merges.value)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    counted = documents.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.pandas_udf(count, "long")(F.col("text")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
