"""Operator 9, near duplicates: SimHash fingerprints matched on their bytes by position.

Two 64-bit fingerprints that differ in at most two bits share at least six of their eight
bytes by position. The index therefore lists each fingerprint under every choice of six
positions with the bytes found there: two fingerprints meet under one key only if their
count of shared positional bytes reaches that minimum, and every linked pair does meet.
Tallying single bytes would meet a 256th of all pairs per position; with six bytes fixed, a
key holds at most 2^16 different fingerprints. Within a key the two-bit test is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaval.llm.components import connected_components
from vendaval.llm.shared import keep

SEED = 42
SHINGLE = 3
BITS = 2
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SPACE = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def _words(text: str | None) -> list[str]:
    # Only ASCII white space parts words, so str.split() without argument won't do.
    return [w for w in (text or "").translate(_LOWER).translate(_SPACE).split(" ") if w]


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, repeats included; 0 without words."""
    words = _words(text)
    if not words:
        return 0
    if len(words) < shingle:
        joined = [" ".join(words)]
    else:
        joined = map(" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in joined], dtype=">u8")
    ones, step = np.zeros(64, dtype=np.int64), 1 << 16
    for at in range(0, len(hashes), step):
        part = hashes[at : at + step].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([text_fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return F.pandas_udf(compute, "long")(text)


def _links(free: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Pairs that connect what differs in at most ``bits`` bits: a spanning forest.

    ``free`` holds different 16-bit values. Each value probes the values one and two bits away,
    so the work grows with the number of values and not with its square.
    """
    n = len(free)
    flips = [1 << i for i in range(16)]
    near = [sum(c) for k in range(1, bits + 1) for c in combinations(flips, k)]
    if n <= 64:
        apart = np.bitwise_count(free[:, None] ^ free[None, :])
        left, right = np.nonzero(np.triu(apart <= bits, 1))
    else:
        where = np.full(1 << 16, -1, dtype=np.int64)
        where[free] = np.arange(n)
        found = where[free[:, None] ^ np.array(near)[None, :]]
        left, at = np.nonzero(found > np.arange(n)[:, None])
        right = found[left, at]
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for a, b in zip(left.tolist(), right.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            links.append((a, b))
    return links


def fingerprint_links(fingerprints: DataFrame, bits: int = BITS) -> DataFrame:
    """(trial, a, b): links between different fingerprints that join all within ``bits`` bits.

    ``fingerprints`` has distinct ``fp`` values, or distinct (trial, fp) of independent sets.
    The links have the same connected components as all pairs at most ``bits`` (0 to 2) bits
    apart; each of them is such a pair. A link may come more than once.
    """
    if not 0 <= bits <= 2:
        raise ValueError("six of eight bytes are shared only up to two bits")
    if "trial" not in fingerprints.columns:
        fingerprints = fingerprints.withColumn("trial", F.lit(0))
    choices = list(combinations(range(8), 2))

    def byte(i: int) -> Column:
        return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(0xFF))

    def entry(n: int, i: int, j: int) -> Column:
        mask = ~(0xFF << (8 * i)) & ~(0xFF << (8 * j)) & ((1 << 64) - 1)
        fixed = F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        free = F.shiftleft(byte(j), 8).bitwiseOR(byte(i)).cast("int")
        choice = (F.col("trial") * len(choices) + n).cast("int")
        return F.struct(choice.alias("choice"), fixed.alias("bytes"), free.alias("free"))

    listed = F.array(*[entry(n, i, j) for n, (i, j) in enumerate(choices)])
    index = fingerprints.select(F.explode(listed).alias("k")).select("k.*")
    # Sorted whole, so that a repeated task finds the same links.
    sorted_index = index.repartition("choice", "bytes").sortWithinPartitions("choice", "bytes", "free")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in batches:
            part = [rows[c].to_numpy() for c in ("choice", "bytes", "free")]
            if held is not None:
                part = [np.concatenate(pair) for pair in zip(held, part)]
            if not len(part[0]):
                continue
            choice, key, _ = part
            new = np.r_[True, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])]
            starts = np.flatnonzero(new)
            # The last key may go on in the next batch; it has at most 2^16 rows.
            held = [x[starts[-1] :] for x in part]
            yield found(*part, starts[:-1], starts[1:])
        if held is not None:
            yield found(*held, np.array([0]), np.array([len(held[0])]))

    def found(choice, key, free, begin, end) -> pd.DataFrame:
        a, b, trial = [], [], []
        several = end - begin > 1
        for s, e in zip(begin[several].tolist(), end[several].tolist()):
            i, j = choices[choice[s] % len(choices)]
            fixed = int(key[s]) & ((1 << 64) - 1)
            group = free[s:e].astype(np.int64)
            for pair in _links(group, bits):
                x, y = (fixed | (f & 0xFF) << (8 * i) | (f >> 8) << (8 * j) for f in group[list(pair)].tolist())
                a.append(x)
                b.append(y)
                trial.append(int(choice[s]) // len(choices))
        ends = [np.array(x, dtype=np.uint64).view(np.int64) for x in (a, b)]
        return pd.DataFrame({"trial": np.array(trial, dtype=np.int32), "a": ends[0], "b": ends[1]})

    return sorted_index.mapInPandas(link, "trial int, a long, b long")


def _rooted(prints: DataFrame, bits: int) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable from each of the distinct ``fp``."""
    parts = connected_components(fingerprint_links(prints, bits)).withColumnRenamed("node", "fp")
    return prints.join(parts, "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``documents`` (doc_id, text).

    ``component_id`` is the smallest doc_id of all documents whose fingerprints are reachable
    by links of at most ``bits`` differing bits. Null and empty texts and texts of white space
    have fingerprint 0, which links like any other. Texts of fewer words than a shingle count
    as one shingle, very long ones are read whole. Repeated rows appear as often as given. A
    null doc_id is never the smallest; a component without any other has a null id. Other
    columns are not read, whatever their names. An empty table gives no rows.
    """
    marked = keep(documents.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    least = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint_ids")
    rooted = least.join(_rooted(least.select("fp"), bits), "fp")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicate_report(documents: DataFrame) -> DataFrame:
    rows = near_duplicates(documents)
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the smallest doc_id.

    Groups are the components of ``near_duplicates``; null, empty and blank texts are one. Of
    rows that share the smallest id the one with the smallest md5 of the text stays, of
    repeated rows one. A null id comes after all others. Texts are read whole; columns may
    have any names. An empty table gives no rows.
    """
    # No text is an empty text.
    key = F.md5(F.coalesce("text", F.lit("")))
    marked = documents.select("doc_id", key.alias("key"), fingerprint(F.col("text"), shingle).alias("fp"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    firsts = keep(marked.groupBy("fp").agg(F.min(place).alias("p")), "fingerprint_firsts")
    rooted = firsts.join(_rooted(firsts.select("fp"), bits), "fp")
    chosen = rooted.groupBy("root").agg(F.min("p").alias("p")).select("p.key", "p.doc_id")
    # Written, so that its size decides how it is joined.
    chosen = keep(chosen, "first_documents").alias("c")
    rows = documents.select("doc_id", key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    alike = (F.col("r.key") == F.col("c.key")) & F.col("r.doc_id").eqNullSafe(F.col("c.doc_id"))
    first = rows.alias("r").join(chosen, alike, "left_semi")
    return first.dropDuplicates(["key", "doc_id"]).select("row.*")
