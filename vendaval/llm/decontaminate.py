"""Operator 7, benchmark decontamination with spaced seeds.

A fixed mask looks at some of a window's tokens and ignores the others, so one substituted
token leaves the seeds that ignore its position intact. Seeds of the benchmark are looked up
at every token of every document; each hit fixes how text and item lie on one another, and the
whole overlap is then compared token by token. The masks are chosen so that every overlap the
rule accepts has a hit: what counts is decided by the rule, what is compared by the seeds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.llm.batches import letter_tokens
from vendaval.llm.shared import keep

#: Fixed masks: 1 looks at the token, 0 ignores it. Chosen by enumeration, so that each way to
#: put 70 % of 6 to 23 tokens in place (six at least) has a window in which all that some mask
#: looks at are in place. Of a longer item some stretch of 12 to 23 tokens has its 70 % too,
#: when the item is parted into such stretches. A test goes through all of them.
MASKS = (
    "110111",
    "111011",
    "1001111",
    "1101101",
    "1110101",
    "10100111",
    "10111001",
    "11010011",
    "110000111",
    "110100011",
    "110101001",
    "111000101",
)


@dataclass(frozen=True)
class Rule:
    """When an overlap counts as contamination."""

    masks: Sequence[str] = MASKS
    share: float = 0.7  # of the item's tokens found in place
    tokens: int = 6  # found in place at least; items with fewer tokens must match whole
    run: int = 25  # or this many tokens of a longer item in one stretch
    run_share: float = 0.8  # of which this share is found in place
    block: int = 200_000  # benchmark tokens sent to the tasks at once


#: Constants of the seeds' hash, one per token a mask looks at.
_FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64)) for i in range(64)]
#: Bits of a hash that are looked up in a table before the seeds themselves.
_BITS = 22
#: Hits compared together.
_STEP = 1 << 16


class Vocabulary:
    """Tokens and seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], rule: Rule):
        self.rule = rule
        hashed = [(i, token_hashes([t])[0]) for i, t in items]
        hashed = [(i, h) for i, h in hashed if len(h)]
        self.names, tokens = [i for i, _ in hashed], [h for _, h in hashed]
        self.size = np.array([len(h) for h in tokens], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.uint64)
        self.need = np.array([required(n, rule) for n in self.size.tolist()], dtype=np.int64)
        self.run_need = int(np.ceil(rule.run_share * rule.run - 1e-9))
        masks = [np.flatnonzero([c == "1" for c in m]) for m in rule.masks]
        # Items of fewer tokens than count in place are looked up whole, by a mask of their length.
        masks += [np.arange(n) for n in sorted({n for n in self.size.tolist() if n < rule.tokens})]
        self.seeds = []
        for mask in masks:
            span = int(mask[-1]) + 1
            whole = span < rule.tokens
            own = np.repeat(np.arange(len(tokens)), self.size)
            seeds = seed_hashes(self.flat, mask)
            item = own[: len(seeds)]
            inside = item == own[span - 1 :][: len(seeds)]
            inside &= (self.size[item] == span) if whole else (self.size[item] >= rule.tokens)
            place = np.flatnonzero(inside)
            order = np.argsort(seeds[place], kind="stable")
            place = place[order]
            keys = seeds[place]
            likely = np.zeros(1 << _BITS, dtype=bool)
            likely[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.seeds.append((mask, span, keys, item[place], place - self.start[item[place]], likely))


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (letters and digits, in lower case) and where each text begins."""
    words, codes, ends = letter_tokens(texts)
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)[codes], ends


def seed_hashes(tokens: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """One hash per window, of the tokens the mask looks at."""
    n = max(len(tokens) - int(mask[-1]), 0)
    found = np.zeros(n, dtype=np.uint64)
    for factor, place in zip(_FACTORS, mask.tolist()):
        found += tokens[place : place + n] * factor
    return found


def required(n: int, rule: Rule) -> int:
    """How many of an item's ``n`` tokens must be in place if they count over the whole item."""
    return int(np.ceil(max(min(rule.tokens, n), rule.share * n) - 1e-9))


def seed_hits(tokens: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> Iterator[tuple]:
    """Arrays (text, item, shift) of a step's hits, each once: where the item begins in the text.

    ``tokens`` are those of all texts, text i being ``tokens[ends[i]:ends[i + 1]]``.
    """
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    for mask, span, keys, item, at, filled in vocabulary.seeds:
        if not len(keys) or len(tokens) < span:
            continue
        seeds = seed_hashes(tokens, mask)
        places = np.flatnonzero(filled[(seeds >> np.uint64(64 - _BITS)).astype(np.int64)])
        places = places[text[places] == text[places + span - 1]]
        left = np.searchsorted(keys, seeds[places], "left")
        count = np.searchsorted(keys, seeds[places], "right") - left
        total = np.cumsum(count)
        for low in range(0, int(total[-1]) if len(total) else 0, _STEP):
            # Hits low and on, numbered over all places.
            hit = np.arange(low, min(low + _STEP, int(total[-1])))
            own = np.searchsorted(total, hit, "right")
            entry = left[own] + hit - (total[own] - count[own])
            owner = text[places[own]]
            shift = places[own] - ends[owner] - at[entry]
            found = np.unique(np.stack([owner, item[entry], shift]), axis=1)
            yield found[0], found[1], found[2]


def overlaps(tokens: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> list[tuple]:
    """(text, item, begin, end, matched, item tokens) of each contamination, in order."""
    rule, found = vocabulary.rule, set()
    for owner, item, shift in seed_hits(tokens, ends, vocabulary):
        # As many hits at once as have a million tokens, at least one.
        part = np.cumsum(vocabulary.size[item]) >> 20
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(item)]
        for a, b in zip(edges, edges[1:]):
            found.update(_compared(tokens, ends, vocabulary, owner[a:b], item[a:b], shift[a:b]))
    names = vocabulary.names
    return [(d, names[k], begin, end, matched, n) for d, k, begin, end, matched, n in sorted(found)]


def _compared(tokens, ends, vocabulary, owner, item, shift) -> Iterator[tuple]:
    rule, size = vocabulary.rule, vocabulary.size[item]
    begin = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(begin, size)
    spot = within + np.repeat(shift, size)
    inside = (spot >= 0) & (spot < np.repeat(ends[owner + 1] - ends[owner], size))
    here = tokens[np.where(inside, spot + np.repeat(ends[owner], size), 0)]
    same = inside & (here == vocabulary.flat[within + np.repeat(vocabulary.start[item], size)])
    matched = np.add.reduceat(same, begin, dtype=np.int64)
    good = matched >= vocabulary.need[item]
    for i in np.flatnonzero(~good & (size >= rule.run) & (matched >= vocabulary.run_need)).tolist():
        row, within_text = (x[begin[i] : begin[i] + size[i]] for x in (same, inside))
        sums = np.r_[0, np.cumsum(row[within_text])]
        if len(sums) > rule.run:
            good[i] = (sums[rule.run :] - sums[: -rule.run]).max() >= rule.run_share * rule.run
    length = ends[owner + 1] - ends[owner]
    for i in np.flatnonzero(good).tolist():
        low, high = max(0, int(shift[i])), min(int(length[i]), int(shift[i] + size[i]))
        yield int(owner[i]), int(item[i]), low, high, int(matched[i]), int(size[i])


def contaminations(documents: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, item_id, first_token, last_token, matched, item_tokens) for each item found.

    A document is contaminated by an item if at least ``share`` of its tokens stand in place
    in the document, or ``run_share`` of a stretch of ``run``. Tokens are runs of letters,
    marks and digits in lower case; null and empty texts and items have none and match
    nothing; an item of fewer than six tokens must stand there whole. An item found at
    several places gives a row for each; items with equal texts each give theirs, and so do
    repeated documents. Empty tables give no rows. Very long texts are read whole.

    Only what a seed points at is compared, and the masks have a seed in all the rule accepts
    as long as ``share`` and ``run_share`` are 0.7 or more and ``tokens`` is six.

    Benchmark items go to the tasks in blocks of at most ``block`` tokens (a longer item is a
    block of its own), so what is sent stays bounded; each block scans the documents once,
    and the documents are not shuffled.
    """
    if min(rule.share, rule.run_share) < 0.7 or rule.tokens < 6 or rule.run < 12:
        raise ValueError("the masks reach overlaps of which 70 % are in place, six tokens at least")
    found = None
    for items in _blocks(benchmark, rule):
        rows = _scan(documents.select("doc_id", "text"), items, rule)
        found = rows if found is None else found.unionByName(rows)
    return found


def _blocks(benchmark: DataFrame, rule: Rule) -> Iterator[list[tuple[int, str]]]:
    """The stated query set, fetched and handed out block by block; at least one block."""
    block, size, given = [], 0, False
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        n = row["text"].count(" ") + 1
        if block and size + n > rule.block:
            yield block
            block, size, given = [], 0, True
        block.append((row["item_id"], row["text"]))
        size += n
    if block or not given:
        yield block


def _scan(documents: DataFrame, items: list[tuple[int, str]], rule: Rule) -> DataFrame:
    sent = documents.sparkSession.sparkContext.broadcast(items)
    names = ["doc_id", "item_id", "first_token", "last_token", "matched", "item_tokens"]
    kind = documents.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = None
        for rows in batches:
            out = []
            for at in range(0, len(rows), 500):
                part = rows.iloc[at : at + 500]
                tokens, ends = token_hashes(part["text"].tolist())
                vocabulary = vocabulary or Vocabulary(sent.value, rule)
                ids = part["doc_id"].tolist()
                out.extend((ids[d], i, x, y - 1, m, n) for d, i, x, y, m, n in overlaps(tokens, ends, vocabulary))
            yield pd.DataFrame(out, columns=names, dtype=object)

    # As text, because pandas would turn long ids beside a missing one to floats.
    named = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = named.mapInPandas(
        scan,
        "doc_id string, item_id bigint, first_token bigint, last_token bigint, matched bigint, item_tokens bigint",
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``documents``, all columns, in which no benchmark item is found.

    Rows are judged by their text, so one without an id is judged like any other, and rows
    that share an id each by their own text. Null, empty and blank texts stay. Columns may have
    any names. An empty table gives no rows.
    """
    key = F.xxhash64("text").alias("key")
    # Written first, so that few keys are broadcast and the documents stay where they are.
    dirty = contaminations(documents.select(key.alias("doc_id"), "text"), benchmark, rule)
    dirty = keep(dirty.select(F.col("doc_id").alias("key")).distinct(), "contaminated")
    rows = documents.select(key, F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    return rows.join(dirty, "key", "left_anti").select("row.*")
