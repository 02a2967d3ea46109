"""Operator 10, LM scoring: a Katz back-off model of any order, trained on and applied to documents.

Counts are discounted after Good and Turing; what a context loses goes to the words never
seen after it, in proportion to their probability after the context shortened by a word, with
a weight that makes the context's probabilities sum to one exactly. So a token is scored by the
longest run that training has seen, and by a weight for each context it had to leave. Words
never seen at all are one further type, which holds what the unigrams lose.

Documents are packed into blocks of tokens, written once. A count travels as follows: each
block sends its different keys (words, runs or contexts) with its own sums to the buckets of
the keys, a bucket adds up and answers every block in the block's order. A key is sent once
per block however often it occurs, so a word or run that makes up a third of all tokens
weighs no more than any other. The answers are the model's tables, partitioned by bucket:
counts of runs of each length, and the parts of the back-off weight of contexts. Weights are
made for the contexts that some text to be scored has left, or may have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.llm.batches import space_tokens
from vendaval.llm.shared import discard, held_out, keep


@dataclass(frozen=True)
class Katz:
    """Parameters of the model and of the work."""

    order: int = 2  # words of the longest run counted; see README for what 3 costs
    discounted: int = 5  # counts up to this are discounted after Good and Turing
    large: float = 0.5  # what larger counts lose, so that every context keeps something
    block: int = 1_000_000  # tokens of a block (a longer text is a block of its own)
    bucket: int = 1_000_000  # keys sent to a bucket, on average


END = xxhash.xxh3_64_intdigest(b"end of text", seed=1)
BEGIN = xxhash.xxh3_64_intdigest(b"begin of text", seed=1)
_MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def pack(values: np.ndarray) -> bytes:
    """64-bit values byte by byte, compressed: small and alike values take little."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).ravel()


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of 64-bit word keys."""
    mixed = (left ^ (left >> np.uint64(31))) * np.uint64(_MIX[0]) + right
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(_MIX[1])
    return mixed ^ (mixed >> np.uint64(32))


def discounts(counts: np.ndarray, katz: Katz) -> np.ndarray:
    """Factors d for counts 0 to ``discounted``, from how many keys have each count.

    Where Good and Turing's estimates are out of order (in small corpora), every count loses
    ``large`` instead.
    """
    k = katz.discounted
    r = np.arange(1, k + 1, dtype=np.float64)
    n = counts.astype(np.float64)  # n[r] keys have count r, up to k + 1
    found = (r - katz.large) / r
    if (n[1 : k + 1] > 0).all():
        far = (k + 1) * n[k + 1] / n[1]
        with np.errstate(divide="ignore", invalid="ignore"):
            turing = ((r + 1) * n[2 : k + 2] / n[1 : k + 1] / r - far) / (1.0 - far)
        if np.isfinite(turing).all() and (turing > 0).all() and (turing < 1).all():
            found = turing
    return np.r_[0.0, found]


def discounted(counts: np.ndarray, factors: np.ndarray, katz: Katz) -> np.ndarray:
    small = factors[np.minimum(counts, katz.discounted)] * counts
    return np.where(counts > katz.discounted, counts - katz.large, small)


def packed_documents(documents: DataFrame, katz: Katz = Katz()) -> DataFrame:
    """(block, ids, trained, lengths, words, codes, pairs): blocks of documents, written.

    ``words`` are the keys of a block's different words, the most frequent first, ``codes``
    its tokens by that order, each text closed by the end token.
    """
    # Ids as text, because pandas would turn long ones beside a missing one to floats.
    own_id = F.col("doc_id").cast("string").alias("doc_id")
    texts = documents.select(own_id, (~held_out(F.col("doc_id"), 1)).alias("trained"), "text")

    def block(number: int, parts: list[tuple]) -> pd.DataFrame:
        keys, codes = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        counts = np.bincount(codes)
        order = np.argsort(-counts, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        codes = place[codes].astype(np.int64)
        return pd.DataFrame(
            {
                "block": [TaskContext.get().partitionId() << 24 | number],
                "ids": [[i for p in parts for i in p[0]]],
                "trained": [pack(np.concatenate([p[1] for p in parts]).astype(np.int64))],
                "lengths": [pack(np.concatenate([p[3] for p in parts]))],
                "words": [pack(keys[order])],
                "codes": [pack(codes)],
                "tokens": [len(codes)],
            }
        )

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, number = [], 0, 0
        digest = xxhash.xxh3_64_intdigest
        for rows in batches:
            for at in range(0, len(rows), 1000):
                part = rows.iloc[at : at + 1000]
                words, codes, ends = space_tokens(part["text"].tolist())
                keys = np.array([*map(digest, words), END], dtype=np.uint64)
                # The end token goes behind each text.
                codes = np.insert(codes, ends[1:], len(words))
                ids = part["doc_id"].tolist()
                held.append((ids, part["trained"].to_numpy(), keys[codes], np.diff(ends) + 1))
                size += len(codes)
                if size >= katz.block:
                    yield block(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield block(number, held)

    packed = texts.mapInPandas(
        split,
        "block long, ids array<string>, trained binary, lengths binary, words binary, codes binary, tokens long",
    )
    return keep(packed, "katz_blocks")


class Block:
    """A row of ``packed_documents``, opened."""

    def __init__(self, row: pd.Series):
        self.number, self.ids = row["block"], row["ids"]
        self.lengths = unpack(row["lengths"])
        self.ends = np.cumsum(self.lengths)
        self.words = unpack(row["words"], np.uint64)
        self.codes = unpack(row["codes"])
        trained = unpack(row["trained"])
        self.trained = np.repeat(trained, self.lengths)  # by token
        self.docs = np.repeat(np.arange(len(self.lengths)), self.lengths)

    def grams(self, order: int) -> list[Grams]:
        """The different runs of 1 to ``order`` tokens, by length."""
        place = np.argsort(self.words, kind="stable")
        number = np.empty_like(place)
        number[place] = np.arange(len(place))
        words = Grams(self.words[place], np.uint64(BEGIN), None, None, number[self.codes])
        found = [words]
        for _ in range(1, order):
            below = found[-1]
            before = self.contexts(below)
            own = pair_keys(np.r_[below.keys, below.begin][before], words.keys[words.of_token])
            keys, of_token = np.unique(own, return_inverse=True)
            context, suffix = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=np.int64)
            context[of_token], suffix[of_token] = before, below.of_token
            begin = pair_keys(np.array([below.begin]), np.array([BEGIN], dtype=np.uint64))[0]
            found.append(Grams(keys, begin, context, suffix, of_token))
        return found

    def contexts(self, below: Grams) -> np.ndarray:
        """For each token the run before it; a text begins with number ``len(below.keys)``."""
        before = np.r_[len(below.keys), below.of_token[:-1]]
        before[self.ends[:-1]] = len(below.keys)
        return before


@dataclass
class Grams:
    """Runs of one length in the order of their keys."""

    keys: np.ndarray
    begin: np.uint64  # key of the context a text begins with
    context: np.ndarray | None  # the run without its last word, numbered a length below
    suffix: np.ndarray | None  # the run without its first word
    of_token: np.ndarray  # the run that ends at each token


def _requests(block: int, keys: np.ndarray, values: list[np.ndarray], buckets: int) -> list[tuple]:
    """Rows (block, bucket, keys, values) for sorted keys; a bucket is a range of keys."""
    top = (keys >> np.uint64(32)).astype(np.int64)
    of = top * buckets >> 32
    cuts = np.searchsorted(of, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        a, e = cuts[b], cuts[b + 1]
        steps = np.diff(keys[a:e], prepend=np.uint64(0))
        rows.append((block, b, pack(steps), [pack(v[a:e].astype(np.int64)) for v in values]))
    return rows


_REQUEST = "block long, bucket int, keys binary, values array<binary>"
_COLUMNS = ["block", "bucket", "keys", "values"]


def pooled(requests: DataFrame, most: int, name: str) -> DataFrame:
    """Adds up the values of each key over all blocks and answers every block; written.

    Answers are (block, bucket, values): the totals in the order of the block's keys, then
    whether the block is the first that has the key. A row without block has the bucket's
    statistics: how many keys have a first total of 1 to ``most``, how many of more than 0,
    and the sum of the first totals.
    """

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        # In the order of the blocks, so that a repeated task names the same first block.
        rows = rows.sort_values("block", kind="stable")
        keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in rows["keys"]]
        cuts = np.cumsum([0, *map(len, keys)])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        every = every[order]
        new = np.r_[True, every[1:] != every[:-1]]
        starts, group = np.flatnonzero(new), np.cumsum(new) - 1
        answers, first = [], None
        for c in range(len(rows["values"].iloc[0])):
            value = np.concatenate([unpack(v[c]) for v in rows["values"]])
            totals = np.add.reduceat(value[order], starts)
            first = totals if first is None else first
            back = np.empty_like(value)
            back[order] = totals[group]
            answers.append(back)
        owner = np.zeros(len(every), dtype=np.int64)
        owner[order[starts]] = 1
        answers.append(owner)
        stats = np.bincount(np.minimum(first, most + 1), minlength=most + 2)[1 : most + 1].tolist()
        stats += [int((first > 0).sum()), int(first.sum())]
        out = [
            (block, bucket, [pack(v[a:e]) for v in answers], None)
            for block, bucket, a, e in zip(rows["block"], rows["bucket"], cuts[:-1], cuts[1:])
        ]
        out.append((None, rows["bucket"].iloc[0], None, stats))
        return pd.DataFrame(out, columns=["block", "bucket", "values", "stats"]).astype({"block": "Int64"})

    kind = "block long, bucket int, values array<binary>, stats array<long>"
    return keep(requests.groupBy("bucket").applyInPandas(add, kind), name)


def _statistics(answers: DataFrame, most: int) -> tuple[np.ndarray, int, int]:
    """(keys by count 0 to ``most``, different keys, total), added up over the buckets."""
    sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(most + 2)]
    row = answers.where("block is null").agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    return np.array([0, *row[:most]]), int(row[most]), int(row[most + 1])


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    """One row per block: its answers in the order of the buckets."""
    rows = answers.where("block is not null").groupBy("block")
    return rows.agg(F.sort_array(F.collect_list(F.struct("bucket", "values"))).alias(name))


def _columns(answers: list) -> list[np.ndarray]:
    parts = [[unpack(v) for v in a["values"]] for a in answers]
    return [np.concatenate(c) for c in zip(*parts)]


def score_documents(documents: DataFrame, katz: Katz = Katz()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Scores are log10 probabilities of the whole text with its end, under the smoothed
    unigrams of the contract (``base_score``) and the back-off model (``score``), trained on
    all rows that are not held out. A null text counts as empty: its only token is the end.
    Repeated rows count as often as they occur. A null id is trained on. Columns other than
    doc_id and text are not read. Without any row to train on every word has probability one
    and both scores are 0; an empty table gives no rows.
    """
    k, order = katz.discounted, katz.order
    blocks = packed_documents(documents, katz)
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    buckets = int(tokens // katz.bucket) + 1

    def ask(length: int):
        def requests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                for _, row in rows.iterrows():
                    b = Block(row)
                    own = b.grams(length)[-1]
                    n = len(own.keys)
                    counts = np.bincount(own.of_token, weights=b.trained, minlength=n).astype(np.int64)
                    # Where a text that is not trained on may leave this run as a context.
                    left = b.contexts(own)[~b.trained.astype(bool)]
                    asked = np.bincount(left, minlength=n + 1)[:n]
                    yield pd.DataFrame(_requests(b.number, own.keys, [counts, asked], buckets), columns=_COLUMNS)

        return requests

    counted, answers = [], blocks
    for length in range(1, order + 1):
        table = pooled(blocks.mapInPandas(ask(length), _REQUEST), k + 1, f"katz_runs_of_{length}")
        counted.append(table)
        answers = answers.join(_by_block(table, f"answers_{length}"), "block")
    stats = [_statistics(table, k + 1) for table in counted]
    _, types, total = stats[0]
    factors = [discounts(by_count, katz) for by_count, _, _ in stats]
    lost = _lost(stats[0][0], types, factors[0], katz)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums of the documents as far as they are known, and the contexts' own sums."""
        for rows in batches:
            for _, row in rows.iterrows():
                yield from _weigh_block(row, katz, total, types, lost, factors, buckets)

    weighed = keep(answers.mapInPandas(weigh, f"{_REQUEST}, ids array<string>, sums array<binary>"), "katz_contexts")
    for table in (blocks, *counted):
        discard(table)
    contexts = pooled(weighed.where("bucket >= 0").select(*_COLUMNS), 1, "katz_weights")
    partial = weighed.where("bucket < 0").select("block", "ids", "sums", "values")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, row in rows.iterrows():
                yield _finish_block(row, katz, factors)

    id_kind = documents.schema["doc_id"].dataType.simpleString()
    kind = "doc_id string, n_tokens long, n_known long, base_score double, score double"
    scored = partial.join(_by_block(contexts, "answers"), "block", "left").mapInPandas(finish, kind)
    scored = scored.withColumn("doc_id", F.col("doc_id").cast(id_kind))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 1).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def _unigrams(counts: np.ndarray, total: int, factors: np.ndarray, lost: float, katz: Katz) -> np.ndarray:
    """log10 probabilities of words by count; a count of 0 is the unknown type."""
    kept = discounted(counts, factors, katz)
    return np.log10(np.where(counts > 0, np.maximum(kept, 1e-300), max(lost, 1e-300)) / max(total, 1))


def _lost(by_count: np.ndarray, types: int, factors: np.ndarray, katz: Katz) -> float:
    """How many of the trained tokens the discounts free for unknown words."""
    r = np.arange(1, katz.discounted + 1)
    small = by_count[1 : katz.discounted + 1]
    return float((small * r * (1.0 - factors[1:])).sum() + (types - small.sum()) * katz.large)


def _weigh_block(row, katz, total, types, lost, factors, buckets) -> Iterator[pd.DataFrame]:
    b, k = Block(row), katz.discounted
    names = [*_COLUMNS, "ids", "sums"]
    grams = b.grams(katz.order)
    answers = [_columns(row[f"answers_{length}"]) for length in range(1, katz.order + 1)]
    counts = [a[0] for a in answers]
    # As many texts begin as end; what a text begins with is a context of any length.
    end = np.flatnonzero(grams[0].keys == np.uint64(END))
    texts = counts[0][end[0]] if len(end) else 0
    of_word = counts[0][grams[0].of_token]
    score = np.zeros(len(b.codes))
    if total:
        score = _unigrams(counts[0], total, factors[0], lost, katz)[grams[0].of_token]
    # From the longest runs down: the first that was seen gives the score, and every known
    # context left on the way still lacks its weight.
    open_tokens = np.ones(len(b.codes), dtype=bool)
    waiting, keys, tallies, seen_with, below_with, levels = [], [], [], [], [], []
    for level in range(katz.order - 1, 0, -1):
        own, below = grams[level], grams[level - 1]
        _, asked, _ = answers[level - 1]
        owner = answers[level][2]
        with_context = np.r_[counts[level - 1], texts]
        seen, known = counts[level] > 0, with_context[own.context] > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            given = np.log10(discounted(counts[level], factors[level], katz)) - np.log10(with_context[own.context])
        here = open_tokens & seen[own.of_token]
        score[here] = given[own.of_token[here]]
        open_tokens &= ~here
        fallen = np.flatnonzero(open_tokens & known[own.of_token])
        mine = np.flatnonzero(seen & (owner > 0) & np.r_[asked > 0, True][own.context])
        left = own.context[own.of_token[fallen]]
        needed = np.unique(np.r_[own.context[mine], left])
        waiting.append((b.docs[fallen], np.searchsorted(needed, left) + sum(map(len, keys))))
        tallies.append(_tallies(np.searchsorted(needed, own.context[mine]), len(needed), counts[level][mine], counts[level - 1][own.suffix[mine]], k))
        keys.append(np.r_[below.keys, below.begin][needed])
        seen_with.append(with_context[needed])
        # What the shortened context was seen with: all tokens, where nothing is left of it.
        if level == 1:
            below_with.append(np.full(len(needed), total))
        else:
            below_with.append(np.r_[counts[level - 2][below.suffix], texts][needed])
        levels.append(np.full(len(needed), level))
    docs, at = (np.concatenate(x) for x in zip(*waiting))
    key = np.concatenate(keys)
    place = np.argsort(key, kind="stable")
    number = np.empty_like(place)
    number[place] = np.arange(len(place))
    columns = [np.concatenate(c)[place] for c in zip(*tallies)]
    yield pd.DataFrame([(*r, None, None) for r in _requests(b.number, key[place], columns, buckets)], columns=names)
    # What finishes the documents: the contexts waited for, with their counts.
    n = len(b.lengths)
    own = np.bincount(b.docs, weights=score, minlength=n)
    base = np.log10((of_word + 0.5) / (total + 0.5 * (types + 1))) if total else np.zeros(len(of_word))
    base = np.bincount(b.docs, weights=base, minlength=n)
    sums = [b.lengths, np.bincount(b.docs, weights=of_word > 0, minlength=n).astype(np.int64), base, own]
    values = [docs, number[at], *(np.concatenate(x)[place] for x in (seen_with, below_with, levels))]
    yield pd.DataFrame(
        [(b.number, -1, None, [pack(v.astype(np.int64)) for v in values], list(b.ids), [pack(s) for s in sums])],
        columns=names,
    )


def _tallies(at: np.ndarray, m: int, own: np.ndarray, follower: np.ndarray, k: int) -> list[np.ndarray]:
    """Per context: its runs by count (1 to k, more), the shortened runs by count, sum of larger ones."""
    small = np.minimum(own, k + 1)
    tally = [np.bincount(at[small == r], minlength=m) for r in range(1, k + 2)]
    tally += [np.bincount(at[follower == r], minlength=m) for r in range(1, k + 1)]
    large = follower > k
    tally.append(np.bincount(at[large], minlength=m))
    tally.append(np.bincount(at[large], weights=follower[large].astype(np.float64), minlength=m).astype(np.int64))
    return tally


def _finish_block(row, katz, factors) -> pd.DataFrame:
    k = katz.discounted
    lengths, known = (unpack(v) for v in row["sums"][:2])
    base, score = (unpack(v, np.float64) for v in row["sums"][2:])
    docs, at, seen_with, below_with, level = (unpack(v) for v in row["values"])
    if len(at):
        tally = _columns(row["answers"])[:-1]
        by_level = np.stack(factors)
        r = np.arange(1, k + 1)
        free = katz.large * tally[k].astype(np.float64)
        follow = tally[2 * k + 2] - katz.large * tally[2 * k + 1]
        for i in range(k):
            free += tally[i] * r[i] * (1.0 - by_level[level, i + 1])
            follow = follow + tally[k + 1 + i] * r[i] * by_level[level - 1, i + 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.log10(free / seen_with / (1.0 - follow / below_with))
        score = score + np.bincount(docs, weights=weight[at], minlength=len(score))
    ids = pd.Series(list(row["ids"]), dtype=object)
    return pd.DataFrame(
        {"doc_id": ids, "n_tokens": lengths, "n_known": known, "base_score": base, "score": score}
    )
