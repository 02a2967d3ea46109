from __future__ import annotations

from collections import Counter

import pytest

from vendaval.llm.spans import Runs, repeat_report, sentences, text_runs, without_repeats

PASSAGE = " ".join(
    f"{'Abcdefgh'[i % 8]}nd number {i} came with several other words that fill it up." for i in range(6)
)


@pytest.mark.parametrize("text", ["", " ", "One.", "A b.\n\nC d? E", "x " * 100 + "y", "a, " * 90, "\n A.  B!\n"])
def test_sentences_are_the_whole_text(text):
    found = sentences(text, Runs())
    assert "".join(text[b:e] for b, e, _ in found).split() == text.split()
    assert all(a[1] == b[0] for a, b in zip(found, found[1:]))
    assert all(len(w) <= Runs().longest for *_, w in found)


def test_whole_table_against_a_dictionary(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen, wanted = set(), {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        digests, places = text_runs(r.text, Runs())
        cut = bytearray(len(r.text))
        for d, (b, e) in zip(digests, places):
            if d in seen:
                cut[b:e] = b"\1" * (e - b)
            seen.add(d)
        wanted[r.doc_id] = "".join(c for c, x in zip(r.text, cut) if not x)
    rows = repeat_report(docs).collect()
    assert {r.doc_id: r.text for r in rows} == wanted
    assert all(r.n_removed == r.n_chars - len(r.text) for r in rows)


def test_passage_in_three_documents(documents):
    texts = [f"Something new {i} starts here. {PASSAGE} And it ends {i} in its own way." for i in range(3)]
    rows = {r.doc_id: r.text for r in repeat_report(documents(list(enumerate(texts)))).collect()}
    assert rows[0] == texts[0]
    for i in (1, 2):
        assert rows[i].startswith(f"Something new {i} starts here.") and rows[i].endswith(f"it ends {i} in its own way.")
        assert len(rows[i]) < len(texts[i]) - 0.8 * len(PASSAGE)


def test_repeats_within_a_document(documents):
    text = f"{PASSAGE} Between them stands this. {PASSAGE}"
    (row,) = repeat_report(documents([(1, text)])).collect()
    assert Counter(row.text.split())["number"] == 6


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (7, PASSAGE), (7, PASSAGE), (8, PASSAGE), (None, PASSAGE)]
    docs = documents(rows, clashing=True)
    cut = without_repeats(docs)
    assert set(cut.columns) == {*docs.columns, "removed"} - {"spans_"} and cut.count() == len(rows)
    found = [(r.doc_id, r.text, len(r.removed)) for r in cut.collect()]
    # No id comes first; rows alike are one document.
    assert (None, PASSAGE, 0) in found and (8, "", 1) in found
    assert found.count((7, "", 1)) == 2 and (5, None, 0) in found and (1, "", 0) in found
    assert without_repeats(documents([])).collect() == []


def covered(text, other, passage):
    """The share of a passage of ``text`` that lies in runs ``other`` has too."""
    (mine, places), (theirs, _) = text_runs(text, Runs()), text_runs(other, Runs())
    begin = text.index(passage)
    inside = set()
    for d, (b, e) in zip(mine, places):
        if d in theirs:
            inside.update(range(max(b, begin), min(e, begin + len(passage))))
    return len(inside) / len(passage)


@pytest.mark.parametrize("gap", ["", " "])
def test_unbroken_passages_are_met_at_every_offset(gap):
    import random

    chance = random.Random(8)
    if gap:
        word = lambda: f"w{chance.randrange(3000)}"
    else:
        word = lambda: chr(0x4E00 + chance.randrange(3000))
    shares = []
    for offset in range(60):
        passage = gap.join(word() for _ in range(60))
        texts = [gap.join([*(word() for _ in range(n)), passage, *(word() for _ in range(n))]) for n in (40, 40 + offset)]
        shares.append(covered(*texts, passage))
    assert sum(s == 0 for s in shares) <= 1 and sum(shares) / len(shares) > 0.7


def test_ideographic_sentences_need_no_white_space():
    text = "今天天气很好，我们去公园。" * 3 + "他说！你来吗？来。"
    assert [text[b:e] for b, e, _ in sentences(text, Runs())] == ["今天天气很好，我们去公园。"] * 3 + ["他说！", "你来吗？", "来。"]


def test_equal_words_are_parted_with_a_bound():
    for words in (["x"] * 200, [f"w{i}" for i in range(300)], ["a", "b"] * 90):
        assert max(len(w) for *_, w in sentences(" ".join(words), Runs())) <= Runs().longest


def test_ids_beyond_doubles_beside_a_null(documents):
    far = 1 << 60
    rows = [(far + 1, "Own words come first here. " + PASSAGE), (far + 3, PASSAGE), (None, "Nobody knows this one."), (far + 5, PASSAGE)]
    found = {r.doc_id: r.removed for r in without_repeats(documents(rows, clashing=True)).collect()}
    assert set(found) == {far + 1, far + 3, far + 5, None}
    assert not found[far + 1] and found[far + 3] and found[far + 5]
