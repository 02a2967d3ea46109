"""Operator 11, ranked lexical search: best-first document intervals under range-maximum tables.

Documents are indexed in shards: per shard and term the numbers of the documents that hold it,
with counts. Where items meet a shard, each posting list gets a sparse table of range maxima of
its impacts. An interval of documents can score no more than the sum, over an item's terms, of
the greatest impact within it. The intervals with the highest such bounds are opened first: the
document of the greatest single impact is scored and parts the interval in two. What cannot
reach the k-th best any more is left unopened. Impacts are whole numbers, so bounds are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaval.llm.shared import keep
from vendaval.llm.words import pieces, words


@dataclass(frozen=True)
class Ranking:
    k: int = 10
    length_share: int = 75  # per cent of the length correction


#: A shard holds at most so many documents and, if more than one, about so many bytes of text.
SHARD_ROWS, SHARD_BYTES = 8192, 16 << 20
#: Item terms that meet a shard in one task, about; items beyond are blocks of their own.
BLOCK_TERMS = 50_000
#: Index only the items' terms if they are no longer than this together; else index all terms.
FILTER_BYTES = 16 << 20
#: Intervals opened together, at first and at most.
FIRST_OPEN, MOST_OPEN = 16, 256


def index(documents: DataFrame, only: pa.Array | None = None) -> DataFrame:
    """(shard, term, docs, counts, ids, lengths): the postings of ``documents`` (doc_id, text).

    A shard's documents are numbered in the order of their ids, null last. A row with a term
    lists in ``docs`` the numbers of the documents that hold it, ascending, and how often in
    ``counts``. One row of each shard has no term and holds the ids and lengths in terms of its
    documents. Documents without a term are in no shard. A shard is a stretch of a task's rows,
    so indexing shuffles nothing; a text longer than a shard's bytes is a shard of its own.
    With ``only`` the other terms count in the lengths alone.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 32
        for at, part in enumerate(pieces(batches, "text", SHARD_BYTES, SHARD_ROWS)):
            known, codes, ends = words(part.column("text").combine_chunks())
            lengths = np.diff(ends)
            if not lengths.any():
                continue
            ids = part.column("doc_id").combine_chunks()
            order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
            order = order[lengths[order] > 0]
            number = np.zeros(len(lengths), dtype=np.int64)
            number[order] = np.arange(len(order))
            owner = np.repeat(number, lengths)
            if only is not None:
                wanted = pc.index_in(known, value_set=only).fill_null(-1).to_numpy(zero_copy_only=False)
                keeps = wanted[codes] >= 0
                codes, owner = codes[keeps], owner[keeps]
            cells, counts = np.unique(codes * len(order) + owner, return_counts=True)
            term, doc = np.divmod(cells, len(order))
            terms, starts = np.unique(term, return_index=True)
            lists = pa.array(np.r_[starts, len(cells)].astype(np.int32))
            n = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, first + at)),
                    known.take(pa.array(terms)).cast(pa.large_string()).cast(pa.string()),
                    pa.ListArray.from_arrays(lists, pa.array(doc.astype(np.int32))),
                    pa.ListArray.from_arrays(lists, pa.array(counts.astype(np.int32))),
                    pa.nulls(n, pa.list_(ids.type)),
                    pa.nulls(n, pa.list_(pa.int32())),
                ],
                schema,
            )
            whole = pa.array([0, len(order)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first + at]),
                    pa.nulls(1, pa.string()),
                    pa.nulls(1, pa.list_(pa.int32())),
                    pa.nulls(1, pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(whole, ids.take(pa.array(order))),
                    pa.ListArray.from_arrays(whole, pa.array(lengths[order].astype(np.int32))),
                ],
                schema,
            )

    schema = ["shard", "term", "docs", "counts", "ids", "lengths"]
    out = f"shard long, term string, docs array<int>, counts array<int>, ids array<{kind}>, lengths array<int>"
    return documents.select("doc_id", "text").mapInArrow(build, out)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, times) of ``items`` (item, text)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", SHARD_BYTES, SHARD_ROWS):
            known, codes, ends = words(part.column("text").combine_chunks())
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            cells, times = np.unique(owner * max(len(known), 1) + codes, return_counts=True)
            row, term = np.divmod(cells, max(len(known), 1))
            terms = known.take(pa.array(term)).cast(pa.large_string()).cast(pa.string())
            names = ["item", "term", "times"]
            columns = [part.column("item").combine_chunks().take(pa.array(row)), terms, pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return items.select("item", "text").mapInArrow(split, "item long, term string, times long")


class Postings:
    """Posting lists one after the other, each under a sparse table of its range maxima."""

    def __init__(self, docs: list[np.ndarray], impacts: list[np.ndarray], n_docs: int):
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        self.ends = np.r_[0, np.cumsum(sizes)]
        self.n_docs = n_docs
        self.doc = np.concatenate(docs).astype(np.int64)
        self.impact = np.concatenate(impacts)
        self.place = np.repeat(np.arange(len(docs)), sizes) * n_docs + self.doc
        longest = int(sizes.max())
        self.log = np.zeros(longest + 1, dtype=np.int64)
        for n in range(2, longest + 1):
            self.log[n] = self.log[n >> 1] + 1
        # Level j holds where the greatest impact of the 2^j entries from each place on stands,
        # the first of equals. Entries past a list's end are never asked for.
        self.best = np.empty((int(self.log[longest]) + 1, len(self.doc)), dtype=np.int32)
        self.best[0] = np.arange(len(self.doc))
        for level in range(1, len(self.best)):
            below, half = self.best[level - 1], 1 << (level - 1)
            self.best[level] = below
            left, right = below[:-half], below[half:]
            self.best[level, :-half] = np.where(self.impact[right] > self.impact[left], right, left)

    def greatest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the greatest impact of entries begin to end stands; only for begin < end."""
        level = self.log[end - begin]
        left, right = self.best[level, begin], self.best[level, end - (1 << level)]
        return np.where(self.impact[right] > self.impact[left], right, left)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, documents scored): the k best above 0, of equal ones the first."""
        base = terms * self.n_docs

        def intervals(low, high, begin, end):
            held = begin < end
            at = np.zeros(begin.shape, dtype=np.int64)
            at[held] = self.greatest(begin[held], end[held])
            most = np.where(held, times * self.impact[at], 0)
            lead = at[np.arange(len(at)), most.argmax(axis=1)]
            return [low, high, begin, end, most.sum(axis=1), self.doc[lead]]

        begin, end = self.ends[terms][None, :], self.ends[terms + 1][None, :]
        front = intervals(np.zeros(1, np.int64), np.full(1, self.n_docs), begin, end)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        n_open, scored = FIRST_OPEN, 0
        while True:
            low, bound = front[0], front[4]
            may = bound > 0
            if len(docs) == k:
                # An equal score is better only for a document that comes before.
                may &= (bound > scores[-1]) | ((bound == scores[-1]) & (low < docs[-1]))
            if not may.all():
                front = [f[may] for f in front]
            if not len(front[0]):
                return docs, scores, scored
            if len(front[0]) > n_open:
                taken = np.zeros(len(front[0]), dtype=bool)
                taken[np.argpartition(-front[4], n_open)[:n_open]] = True
                now, front = [f[taken] for f in front], [f[~taken] for f in front]
            else:
                now, front = front, [f[:0] for f in front]
            n_open = min(2 * n_open, MOST_OPEN)
            low, high, begin, end, _, doc = now
            at = np.searchsorted(self.place, base[None, :] + doc[:, None])
            at = np.clip(at, begin, end)
            hit = (at < end) & (self.doc[np.minimum(at, len(self.doc) - 1)] == doc[:, None])
            score = (np.where(hit, self.impact[np.minimum(at, len(self.doc) - 1)], 0) * times).sum(axis=1)
            scored += len(doc)
            docs, scores = np.r_[docs, doc[score > 0]], np.r_[scores, score[score > 0]]
            best = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[best], scores[best]
            halves = intervals(np.r_[low, doc + 1], np.r_[doc, high], np.r_[begin, at + hit], np.r_[at, end])
            front = [np.concatenate(pair) for pair in zip(front, halves)]


def _search_shard(rows: pa.Table, n: int, total: int, ranking: Ranking) -> tuple[list, list, list]:
    """(items, documents' numbers, scores) of one shard for a block of items."""
    of = {c: rows.column(c).combine_chunks() for c in ("term", "lengths", "docs", "counts", "weight", "asked")}
    is_term = pc.is_valid(of["term"]).to_numpy(zero_copy_only=False)
    plain = int(np.flatnonzero(~is_term)[0])
    lengths = of["lengths"][plain].values.to_numpy().astype(np.int64)
    share = ranking.length_share
    slow = 8 * (100 - share + (share * lengths * n) // total)
    docs, impacts = [], []
    queries: dict[int, list[tuple[int, int]]] = {}
    for number, row in enumerate(np.flatnonzero(is_term).tolist()):
        doc = of["docs"][row].values.to_numpy()
        count = of["counts"][row].values.to_numpy().astype(np.int64)
        docs.append(doc)
        impacts.append(of["weight"][row].as_py() * ((1_000_000_000 * count) // (1000 * count + slow[doc])))
        for asked in of["asked"][row].as_py():
            queries.setdefault(asked["item"], []).append((number, asked["times"]))
    if not docs:
        return [], [], []
    postings = Postings(docs, impacts, len(lengths))
    items, found, scores = [], [], []
    for item, terms in queries.items():
        number, times = np.array(terms, dtype=np.int64).T
        best, score, _ = postings.search(number, times, ranking.k)
        items += [item] * len(best)
        found += best.tolist()
        scores += score.tolist()
    return items, found, scores


def search(documents: DataFrame, items: DataFrame, ranking: Ranking = Ranking()) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of each item.

    ``documents`` has (doc_id, text), ``items`` (item_id, text); other columns are not read.
    Equal scores come by ascending doc_id, no id last. Repeated items count once; rows of one
    item_id with different texts are items of their own. Repeated documents are documents of
    their own, in any order among themselves. Null and empty texts, and texts without a term,
    match nothing; an item without a match has no rows, nor has an empty table. Texts are read
    whole.

    Document counts of terms come from the written index. Each block of items meets each shard
    in one group of one shard's postings for the block's terms, joined by term, so neither
    table is sent whole; a group yields at most ``k`` rows an item.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    items = items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id())
    items = keep(items, "items")
    asked = keep(item_terms(items), "item_terms")
    different = asked.select("term").distinct()
    size = different.agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("bytes")).first()
    only = None
    if (size["bytes"] or 0) + 8 * size["n"] <= FILTER_BYTES:
        only = different.toArrow().column("term").combine_chunks().cast(pa.large_string()).cast(pa.large_binary())
    table = keep(index(documents, only), "postings")
    plain = table.where("term is null")
    sums = plain.agg(
        F.sum(F.size("ids")).alias("n"),
        F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")).alias("l"),
    ).first()
    n, total = sums["n"] or 0, sums["l"] or 0

    blocks = max(-(-asked.count() // BLOCK_TERMS), 1)
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")
    held_in = table.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * n + 2) / (2.0 * F.col("df") + 1)))
    weights = keep(held_in.join(different, "term").select("term", weight.alias("weight")), "weights")
    queries = asked.groupBy(block, "term").agg(F.collect_list(F.struct("item", "times")).alias("asked"))
    queries = queries.join(weights, "term")
    postings = table.where("term is not null").join(queries, "term")
    every_block = F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block")
    lists = plain.select("*", every_block)
    rows = postings.unionByName(lists, allowMissingColumns=True)

    def best(rows: pa.Table) -> pa.Table:
        plain = rows.filter(pc.is_null(rows.column("term")))
        ids = plain.column("ids").combine_chunks()[0].values
        found, docs, scores = _search_shard(rows, n, total, ranking)
        columns = [pa.array(found, pa.int64()), ids.take(pa.array(docs, pa.int64())), pa.array(scores, pa.int64())]
        return pa.Table.from_arrays(columns, ["item", "doc_id", "score"])

    found = rows.groupBy("block", "shard").applyInArrow(best, f"item long, doc_id {kind}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranking.k)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
