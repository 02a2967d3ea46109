from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from vendaval.llm.katz import Katz, pack, score_documents, unpack

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def trained(i) -> bool:
    return i is None or zlib.crc32(str(i).encode()) % 5 != 1


def brute(rows, katz=Katz()):
    """(doc_id, n_tokens, n_known, N, base, score) of each row, from dictionaries."""
    k, order = katz.discounted, katz.order
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), "</s>"] for _, t in rows]
    runs = [Counter() for _ in range(order + 1)]  # by length
    for (i, _), own in zip(rows, tokens):
        if trained(i):
            for n in range(1, order + 1):
                padded = ["<s>"] * (n - 1) + own
                runs[n].update(tuple(padded[j : j + n]) for j in range(len(own)))
    total, types = sum(runs[1].values()), len(runs[1])

    def factors(counts):
        n = Counter(counts.values())
        if all(n[r] for r in range(1, k + 1)):
            far = (k + 1) * n[k + 1] / n[1]
            found = {r: ((r + 1) * n[r + 1] / n[r] / r - far) / (1 - far) for r in range(1, k + 1) if far != 1}
            if found and all(0 < d < 1 for d in found.values()):
                return found
        return {r: (r - katz.large) / r for r in range(1, k + 1)}

    by_length = [None, *map(factors, runs[1:])]

    def kept(n, run):
        count = runs[n][run]
        return count - katz.large if count > k else count * by_length[n][count]

    unknown = total - sum(kept(1, w) for w in runs[1])
    followers = defaultdict(list)
    for n in range(2, order + 1):
        for run in runs[n]:
            followers[run[:-1]].append(run)
    sums = {c: sum(runs[len(c) + 1][r] for r in own) for c, own in followers.items()}

    @cache
    def weight(context):
        if context not in followers:
            return 1.0
        own, n = followers[context], len(context) + 1
        return (1 - sum(kept(n, r) for r in own) / sums[context]) / (1 - sum(chance(r[1:]) for r in own))

    @cache
    def chance(run):
        if runs[len(run)][run]:
            return kept(len(run), run) / (sums[run[:-1]] if len(run) > 1 else total)
        return unknown / total if len(run) == 1 else weight(run[:-1]) * chance(run[1:])

    for context in [*followers][:3] + [c for c in followers if len(c) == order - 1][:4]:
        # A context's probabilities sum to one, the unknown type's among them.
        mass = sum(chance((*context, *w)) for w in runs[1])
        assert mass + chance((*context, "never seen")) == pytest.approx(1)

    out = []
    for (i, _), own in zip(rows, tokens):
        base = sum(math.log10((runs[1][w,] + 0.5) / (total + 0.5 * (types + 1))) for w in own) if total else 0.0
        padded = ["<s>"] * (order - 1) + own
        score = sum(math.log10(chance(tuple(padded[j : j + order]))) for j in range(len(own))) if total else 0.0
        out.append((i, len(own), sum((w,) in runs[1] for w in own), total, base, score))
    return out


def check(frame, rows, katz):
    found = score_documents(frame, katz).collect()
    key = lambda r: (str(r[0]), r[1], round(r[4], 6))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found), key=key)
    wanted = sorted(brute(rows, katz), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    assert [x for g in got for x in g[4:]] == pytest.approx([x for w in wanted for x in w[4:]], rel=1e-9)
    assert all(r.held_out == (not trained(r.doc_id)) for r in found)


def test_whole_table_in_many_blocks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for order in (2, 3):
        check(docs, rows, Katz(order=order, block=30_000, bucket=40_000))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_odd_rows(documents, odd_rows, order):
    rows = [*odd_rows, *[(i, f"common words {i % 3} Common") for i in range(40)]]
    check(documents(rows, clashing=True), rows, Katz(order=order, block=50, bucket=100))


def test_ids_beyond_doubles_beside_a_null(documents):
    rows = [((1 << 60) + i, f"some words {i}") for i in (1, 3, 5, 6)] + [(None, "no id")]
    check(documents(rows), rows, Katz(block=4, bucket=5))


def test_counts_where_good_and_turing_apply(documents):
    # As many words of each count as a long-tailed corpus has.
    words = [f"w{r}-{j}" for r in range(1, 9) for j in range(400 // r**2 + 1) for _ in range(r)]
    rows = [(n, " ".join(words[n::37])) for n in range(37)]
    check(documents(rows), rows, Katz())


def test_nothing_to_train_on(documents):
    rows = [(i, "some words") for i in range(200) if not trained(i)]
    check(documents(rows), rows, Katz())
    assert score_documents(documents([])).collect() == []


def test_packing():
    values = np.array([0, 1, -5, 2**62, 7], dtype=np.int64)
    assert (unpack(pack(values)) == values).all()
    assert (unpack(pack(values.view(np.float64)), np.float64).view(np.int64) == values).all()
