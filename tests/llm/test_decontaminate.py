from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from vendaval.llm.decontaminate import (
    MASKS,
    Rule,
    Vocabulary,
    contaminations,
    drop_contaminated,
    overlaps,
    required,
    token_hashes,
)

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards quietly judge my vow"


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, ITEM), (2, "two words"), (3, None), (4, ""), (5, ITEM.upper()), (6, "alpha beta gamma delta epsilon zeta eta theta")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(documents, benchmark, texts, rule=Rule()):
    rows = contaminations(documents(list(enumerate(texts))), benchmark, rule).collect()
    return sorted((r.doc_id, r.item_id) for r in rows)


def test_whole_item_and_substitutions(documents, benchmark):
    words = ITEM.split()
    one = [w if i != 7 else "LION" for i, w in enumerate(words)]
    four = [w if i % 5 != 4 else "other" for i, w in enumerate(words)]
    most = [w if i % 2 else "other" for i, w in enumerate(words)]
    texts = [f"Before, {ITEM}! After.", "x " * 50 + " ".join(one), " ".join(four), " ".join(most), "nothing of the kind here"]
    assert found(documents, benchmark, texts) == [(0, 1), (0, 5), (1, 1), (1, 5), (2, 1), (2, 5)]


def test_short_items_must_stand_whole(documents, benchmark):
    assert found(documents, benchmark, ["two words", "here are two  WORDS.", "two other words"]) == [(0, 2), (1, 2)]


def test_part_of_an_item(documents, benchmark):
    texts = ["alpha beta gamma delta epsilon zeta", "alpha beta gamma delta"]
    assert found(documents, benchmark, texts) == [(0, 6)]


def test_blocks_give_the_same(documents, benchmark):
    texts = [ITEM, "two words", "alpha beta gamma delta epsilon zeta eta theta", "none"]
    assert found(documents, benchmark, texts, Rule(block=3)) == found(documents, benchmark, texts)


def test_whole_table_against_plain_search(spark, sf):
    import re

    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: " " + " ".join(w for w in re.split(r"[\W_]+", t.lower()) if w) + " "
    wanted = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if plain(i.text) in plain(d.text)}
    got = {(r.doc_id, r.item_id) for r in contaminations(docs, items).collect()}
    assert wanted <= got and len(got - wanted) <= 1


def test_odd_rows(documents, odd_rows, benchmark, spark):
    docs = documents([*odd_rows, (None, ITEM), (7, ITEM), (7, ITEM), (7, "a clean text")], clashing=True)
    rows = contaminations(docs, benchmark).where("item_id = 1").collect()
    assert sorted(str(r.doc_id) for r in rows) == ["7", "7", "None"]
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows) + 1
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminations(docs, none).collect() == [] and drop_contaminated(docs, none).count() == docs.count()
    assert contaminations(documents([]), benchmark).collect() == []


def compared(texts, items, rule=Rule()):
    """(text, item, begin, end, matched, item tokens) over lists of words."""
    vocabulary = Vocabulary([(i, " ".join(t)) for i, t in enumerate(items)], rule)
    tokens, ends = token_hashes([" ".join(t) for t in texts])
    return overlaps(tokens, ends, vocabulary)


def brute(texts, items, rule=Rule()):
    """Every item on every text at every shift, by the rule alone."""
    found = []
    for d, text in enumerate(texts):
        for k, item in enumerate(items):
            n = len(item)
            for shift in range(-n + 1, len(text)):
                begin, end = max(0, shift), min(len(text), shift + n)
                same = [text[p] == item[p - shift] for p in range(begin, end)]
                hit = sum(same) >= max(min(rule.tokens, n), rule.share * n) - 1e-9
                if n >= rule.run:
                    runs = [sum(same[i : i + rule.run]) for i in range(len(same) - rule.run + 1)]
                    hit |= max(runs, default=0) >= rule.run_share * rule.run
                if hit:
                    found.append((d, k, begin, end, sum(same), n))
    return found


@pytest.mark.parametrize("n", range(6, 24))
def test_masks_meet_every_pattern_the_rule_accepts(n):
    """All ways to leave as many of n tokens out of place as the rule allows: some mask fits in each."""
    allowed = n - required(n, Rule())
    ways = list(combinations(range(n), allowed))
    bad = np.array(ways, dtype=np.int64).reshape(len(ways), allowed)
    good = np.ones((len(bad), n), dtype=bool)
    np.put_along_axis(good, bad, False, axis=1)
    met = np.zeros(len(good), dtype=bool)
    for mask in MASKS:
        places = [i for i, c in enumerate(mask) if c == "1"]
        for begin in range(n - len(mask) + 1):
            met |= good[:, [begin + p for p in places]].all(axis=1)
    assert met.all()


def test_equals_every_item_at_every_shift():
    """Zero to over thirty per cent substituted, cut at either end, several to a text; few words, so chance hits."""
    chance = random.Random(11)
    word = lambda: f"w{chance.randrange(40)}"
    items = [[word() for _ in range(n)] for n in (1, 3, 5, 6, 7, 8, 10, 11, 14, 23, 24, 25, 26, 40, 70)]
    items.append(list(items[8]))  # two items alike
    texts = []
    for step in range(260):
        text = [word() for _ in range(chance.randrange(12))]
        for item in chance.sample(items, chance.randrange(3)):
            part = [word() if chance.random() < step % 8 * 0.05 else w for w in item]
            text += part[chance.randrange(2) * chance.randrange(len(part)) :][: chance.choice((len(part), 27, 60))]
            text += [word() for _ in range(chance.randrange(6))]
        texts.append(text)
    expected = brute(texts, items)
    assert compared(texts, items) == expected and len(expected) > 300


def test_without_seeds_nothing_is_found():
    """What is found comes through the seeds alone."""
    item = [f"w{i}" for i in range(30)]
    vocabulary = Vocabulary([(1, " ".join(item))], Rule())
    tokens, ends = token_hashes([" ".join(item)])
    assert overlaps(tokens, ends, vocabulary) == [(0, 1, 0, 30, 30, 30)]
    vocabulary.seeds = []
    assert overlaps(tokens, ends, vocabulary) == []


def test_rules_the_masks_do_not_reach_are_refused(documents, benchmark):
    with pytest.raises(ValueError, match="70 %"):
        contaminations(documents([(1, ITEM)]), benchmark, Rule(share=0.5))


def test_ids_beyond_doubles_beside_a_null(documents, benchmark):
    far = 1 << 60
    rows = contaminations(documents([(far + 1, ITEM), (far + 3, ITEM), (None, ITEM)]), benchmark).collect()
    assert {r.doc_id for r in rows} == {far + 1, far + 3, None}
