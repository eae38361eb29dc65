"""Long passages against a brute-force search for shared runs of words."""

import random

import numpy as np
import pytest

from gaugeframe.llm.passages import LONG, REACH, cut_words, repeated_passages, units
from gaugeframe.llm.paragraphs import drop_repeated_paragraphs, repeated_paragraphs


def runs(texts, size):
    """Per row the words covered by runs of ``size`` words that another row has."""
    words = [(t or "").lower().split() for t in texts]
    where = {}
    for k, w in enumerate(words):
        for i in range(len(w) - size + 1):
            where.setdefault(tuple(w[i:i + size]), set()).add(k)
    return [{i + j for i in range(len(w) - size + 1) if len(where[tuple(w[i:i + size])]) > 1
             for j in range(size)} for w in words]


def planted(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(40)}"
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(n) for n in (39, 45, 51, 52, 60, 90, 200)]
    texts = [None, "", "a b", " ".join(["x"] * 70), " ".join(["x"] * 90)]
    for k in range(120):
        w = prose(rng.randrange(5, 150))
        if k % 2:
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        text = " ".join(w)
        texts.append(text.replace(" ", "\n", 3) if k % 5 == 0 else text.upper() if k % 7 == 0 else text)
    return texts + [texts[7], texts[8] + " tail"]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_run_of_51_words_is_found_and_no_short_one(spark, seed):
    texts = planted(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    got = {r["row"]: [(p["start"], p["end"]) for p in r["passages"]]
           for r in repeated_passages(df).collect()}
    long, short = runs(texts, LONG), runs(texts, LONG - REACH + 1)
    assert sum(bool(x) for x in long) > 40
    for k in range(len(texts)):
        covered = {i for a, b in got.get(k, []) for i in range(a, b)}
        assert bool(covered) >= bool(long[k])
        assert covered <= short[k]
        # Runs lose fewer words than the reach at each end.
        for i in long[k]:
            assert any(a - REACH < i < b + REACH for a, b in got[k])
        assert got.get(k, []) == sorted(got.get(k, []))


def test_passage_inside_different_lines(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"v{rng.randrange(900)}" for _ in range(n))
    passage = prose(55)
    texts = [prose(40) + " " + passage + " " + prose(70), passage.replace(" ", "\n", 9),
             prose(80) + "\n" + prose(3) + " " + passage, prose(200), None]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, passages string")
    got = {r["doc_id"]: r for r in repeated_paragraphs(docs).collect()}
    assert [got[i]["n_long"] for i in range(5)] == [1, 1, 1, 0, 0]
    assert got[0]["passages"][0]["start"] in range(40, 40 + REACH)
    assert all(got[i]["n_removed"] == 0 for i in range(5))


def test_the_line_that_stays_counts_as_repeated(spark):
    line = " ".join(f"u{k}" for k in range(60))
    docs = spark.createDataFrame(
        [(1, "first line of its own\n" + line), (2, line), (3, line + "\nshort"), (4, "a b c d e")],
        "doc_id long, text string")
    got = {r["doc_id"]: r for r in repeated_paragraphs(docs).collect()}
    assert [got[i]["n_repeated"] for i in (1, 2, 3, 4)] == [1, 1, 1, 0]
    assert [got[i]["n_removed"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert [got[i]["n_long_lines"] for i in (1, 2, 3, 4)] == [1, 1, 1, 0]
    assert [got[i]["n_long"] for i in (1, 2, 3, 4)] == [1, 1, 1, 0]


def test_one_very_long_text_and_an_empty_table(spark):
    text = " ".join(f"w{k % 701}" for k in range(200_000))
    words = text.encode().split()
    at, keys = units(words, np.zeros(len(words), int))
    assert len(at) == len(keys) and (np.diff(at) <= REACH).all()
    docs = spark.createDataFrame([(1, text), (2, "w1 w2")], "row long, text string")
    assert repeated_passages(docs).count() == 0  # repeats inside of one row are none
    assert repeated_passages(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_units_of_many_texts_equal_those_of_each(seed):
    texts = [(t or "").lower().encode().split() for t in planted(seed)]
    number = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
    at, keys = units([w for t in texts for w in t], number)
    first = np.cumsum([0] + [len(w) for w in texts])
    for k, words in enumerate(texts):
        own_at, own_keys = units(words, np.zeros(len(words), int))
        mine = number[at] == k
        assert (at[mine] - first[k]).tolist() == own_at.tolist()
        assert keys[mine].tolist() == own_keys.tolist()
        # Every stretch of 16 groups of five words has an anchor, unless its unit leaves the text.
        last = len(words) - (LONG - REACH + 1)
        for i in range(max(0, len(words) - REACH - 3)):
            assert any(i <= a < i + REACH for a in own_at) or i + REACH - 1 > last


def test_passages_stay_in_one_text(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"q{rng.randrange(900)}" for _ in range(n))
    passage = prose(70)
    head = "é " + prose(40)
    texts = [prose(40) + " " + passage + "\n" + prose(10), prose(50) + " " + passage + "  " + prose(9),
             head + " " + passage, None, prose(90)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, passages string")
    out = drop_repeated_paragraphs(docs, passages=True)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[0] == texts[0] and got[3] is None and got[4] == texts[4]
    for i, own in ((1, texts[1].split(passage)), (2, [head + " ", ""])):
        left = got[i].split()
        # What stays is the text around the passage and fewer than 16 words of it at each end.
        around = own[0].split() + own[1].split()
        assert len(around) <= len(left) < len(around) + 2 * REACH
        assert got[i].startswith(own[0]) and got[i].endswith(own[1])
    assert drop_repeated_paragraphs(docs.limit(0), passages=True).count() == 0


def test_words_are_cut_with_the_space_between_them():
    assert cut_words("a  b\tc d\ne".encode(), [(1, 3)]) == b"a   d\ne"
    assert cut_words("à b".encode(), [(0, 2)]) == b"" and cut_words(b" x ", []) == b" x "
