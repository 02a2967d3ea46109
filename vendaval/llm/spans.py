"""Operator 1, substring dedup: repeated runs of sentences are removed, all but the first.

Every run of consecutive sentences that is long enough is hashed; runs meet in one global
join on the hash. What lies in a run that occurred before, in another document or earlier in
the same one, is cut out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.llm.shared import keep


@dataclass(frozen=True)
class Runs:
    """What makes a run: so many sentences and words at least."""

    sentences: int = 2
    words: int = 16
    longest: int = 24  # longer sentences are parted at commas
    part: int = 12  # and what is longer still by content into parts of about so many words


# Ideographic stops and commas need no white space after them.
_SENTENCE = re.compile(r"(?<=[.!?…。！？])\s+|\s*\n\s*|(?<=[。！？])(?![。！？」』”）\s])")
_CLAUSE = re.compile(r"(?<=[,;:，、；：])\s+|(?<=[，、；：])(?!\s)")
_IDEOGRAPHS = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_IDEOGRAPH = re.compile(f"[{_IDEOGRAPHS}]")
#: Each ideograph or kana counts as a word.
_WORD = re.compile(rf"[{_IDEOGRAPHS}][^\w\s]*|[^\s{_IDEOGRAPHS}]+")
_PLAIN = re.compile(r"\S+")


def _words(text: str) -> list[str]:
    if _IDEOGRAPH.search(text):
        return [w.lower() for w in _WORD.findall(text)]
    return text.lower().split()


def _content_cuts(words: list[str], runs: Runs) -> list[int]:
    """Words before which an unbroken stretch is cut, so that equal passages are cut alike.

    A cut stands where the hash of two words is the least within half a part to both sides.
    Where that leaves more than ``longest`` words, it stands at the least of each window of a
    part. Either depends on the words near by and not on where the stretch begins.
    """
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(f"{a} {b}") for a, b in zip(words, words[1:])], dtype=np.uint64)
    # Of equal hashes the last one counts.
    radius = max(runs.part // 2 - 1, 1)
    most = np.full(radius, np.iinfo(np.uint64).max, dtype=np.uint64)
    near = np.lib.stride_tricks.sliding_window_view(np.r_[most, own, most], 2 * radius + 1)
    least = (own <= near[:, :radius].min(axis=1)) & (own < near[:, radius + 1 :].min(axis=1))
    cuts = (np.flatnonzero(least) + 1).tolist()
    edges = [0, *cuts, len(words)]
    for a, b in zip(edges, edges[1:]):
        if b - a > runs.longest:
            windows = np.lib.stride_tricks.sliding_window_view(own[a : b - 1], runs.part)
            last = runs.part - 1 - np.argmin(windows[:, ::-1], axis=1)
            cuts.extend(set((a + 1 + np.arange(len(last)) + last).tolist()))
    return sorted(cuts)


def sentences(text: str, runs: Runs) -> list[tuple[int, int, list[str]]]:
    """(begin, end, words in lower case) of each sentence; together they are the whole text."""
    found: list[tuple[int, int, list[str]]] = []

    def cut(begin: int, end: int, breaks: list[re.Pattern]) -> None:
        words = _words(text[begin:end])
        if len(words) <= runs.longest or not breaks:
            if len(words) > runs.longest:
                word = _WORD if _IDEOGRAPH.search(text, begin, end) else _PLAIN
                starts = [m.start() for m in word.finditer(text, begin, end)]
                edges = [begin, *[starts[i] for i in _content_cuts(words, runs)], end]
                for a, b in zip(edges, edges[1:]):
                    found.append((a, b, _words(text[a:b])))
            elif words:
                found.append((begin, end, words))
            elif found:  # white space goes with what stands before it
                found[-1] = (found[-1][0], end, found[-1][2])
            return
        at = begin
        for m in breaks[0].finditer(text, begin, end):
            if m.end() > at:
                cut(at, m.end(), breaks[1:])
                at = m.end()
        if at < end:
            cut(at, end, breaks[1:])

    at = 0
    for m in _SENTENCE.finditer(text):
        if m.end() > at:
            cut(at, m.end(), [_CLAUSE])
            at = m.end()
    if at < len(text):
        cut(at, len(text), [_CLAUSE])
    return found


def text_runs(text: str | None, runs: Runs) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Digest and (begin, end) of the shortest sufficient run from each sentence on."""
    units = sentences(text or "", runs)
    digest = xxhash.xxh3_128_digest
    own = [digest(" ".join(w)) for _, _, w in units]
    size = [len(w) for _, _, w in units]
    digests, places = [], []
    for i in range(len(units)):
        j, words = i, 0
        while j < len(units) and (j - i < runs.sentences or words < runs.words):
            words += size[j]
            j += 1
        if j - i >= runs.sentences and words >= runs.words:
            digests.append(digest(b"".join(own[i:j])))
            places.append((units[i][0], units[j - 1][1]))
    return digests, places


def repeated_runs(documents: DataFrame, runs: Runs = Runs()) -> DataFrame:
    """(doc_id, tie, begin, end): the runs that are not the first of their kind.

    The first is the one in the document of the smallest id (no id comes first of all), there
    the earliest. ``tie`` is a hash of the text, ``begin`` and ``end`` count its characters.
    A run's hash has 128 bits. Firsts are found by a partial aggregate per task, so a passage
    in a third of all documents leaves each task as one row. Only hashes seen more than once
    are joined with the runs. They are written first, because adaptive execution splits a hash
    with very many runs only if both sides of the join come straight from a shuffle.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 1000):
                part = rows.iloc[at : at + 1000]
                digests, places, counts = [], [], []
                for text in part["text"]:
                    found, where = text_runs(text, runs)
                    digests += found
                    places += where
                    counts.append(len(found))
                halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                spots = np.array(places, dtype=np.int32).reshape(-1, 2)
                ids = part[["doc_id", "tie"]].iloc[np.repeat(np.arange(len(part)), counts)]
                yield ids.assign(h=halves[:, 0], l=halves[:, 1], begin=spots[:, 0], end=spots[:, 1])

    # As text, because pandas would turn long ids beside a missing one to floats.
    own_id = F.col("doc_id").cast("string").alias("doc_id")
    texts = documents.where("text is not null").select(own_id, F.xxhash64("text").alias("tie"), "text")
    every = texts.mapInPandas(split, "doc_id string, tie long, h long, l long, begin int, end int")
    # Written, so that texts are split once for the firsts and the runs that follow them.
    every = keep(every.withColumn("doc_id", F.col("doc_id").cast(kind)), "runs")
    place = F.struct("doc_id", "tie", "begin")
    firsts = every.groupBy("h", "l").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = keep(firsts.where("n > 1").select("h", "l", "first"), "first_runs")
    later = every.join(firsts, ["h", "l"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("doc_id", "tie", "begin", "end")


def without_repeats(documents: DataFrame, runs: Runs = Runs()) -> DataFrame:
    """``documents`` with ``text`` cut, and ``removed``, an array of (begin, end) in characters.

    Texts without a repeated run, empty ones and nulls stay as they are, with nothing removed;
    a text all of which occurred before becomes empty. Rows alike in id and text are one
    document and are cut alike; rows of one id with different texts are documents of their
    own. An empty table gives no rows. A column named ``removed`` is replaced.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    later = repeated_runs(documents, runs).groupBy("doc_id", "tie")
    # One entry for each sentence of a document at most.
    spans = later.agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            merged = []
            for own in rows["spans"]:
                out: list[list[int]] = []
                for span in own:
                    b, e = span["begin"], span["end"]
                    if out and b <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], e)
                    else:
                        out.append([b, e])
                merged.append([{"begin": b, "end": e} for b, e in out])
            yield rows[["doc_id", "tie"]].assign(spans=pd.Series(merged, index=rows.index, dtype=object))

    spans = spans.withColumn("doc_id", F.col("doc_id").cast("string"))
    spans = spans.mapInPandas(merge, "doc_id string, tie long, spans array<struct<begin: int, end: int>>")
    spans = spans.withColumn("doc_id", F.col("doc_id").cast(kind)).alias("s")
    names = [c for c in documents.columns if c not in ("text", "removed")]
    row = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in names]).alias("row")
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("tie"), row).alias("d")
    alike = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.tie") == F.col("s.tie"))
    joined = rows.join(spans, alike, "left").select("d.text", "d.row", "s.spans")
    kept = F.expr(
        "array_join(transform(sequence(0, size(spans)), i -> substring(text,"
        " if(i = 0, 1, spans[i - 1].end + 1),"
        " if(i = size(spans), length(text), spans[i].begin) - if(i = 0, 0, spans[i - 1].end))), '')"
    )
    none = F.expr("cast(array() as array<struct<begin: int, end: int>>)")
    return joined.select(
        *[F.col(f"row.`{c}`").alias(c) for c in names],
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.coalesce("spans", none).alias("removed"),
    )


def repeat_report(documents: DataFrame, runs: Runs = Runs()) -> DataFrame:
    """(doc_id, n_chars, n_removed, removed, text) for every row."""
    narrow = documents.select("doc_id", "text", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
    cut = without_repeats(narrow, runs)
    gone = F.expr("aggregate(removed, 0, (n, s) -> n + s.end - s.begin)")
    return cut.select("doc_id", "n_chars", gone.alias("n_removed"), "removed", "text")
