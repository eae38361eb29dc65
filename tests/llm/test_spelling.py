"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from gaugeframe.llm.spelling import Acceptor, OneEdit, count_words, near_words, spelling_variants

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        others = sorted((-counts[v], v.encode(), v) for v in counts if near(w, v))
        form = others[0][2] if others and -others[0][0] >= 2 * n else None
        out[w] = (n, len(others), form, counts[form] if form else None)
    result = {}
    for w, row in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        result[w] = (*row, root)
    return result


def vocabulary(seed, size=250):
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        words.add("".join(rng.choices("abé", k=rng.randrange(1, 8))))
    return {w: rng.choice([1, 2, 3, 3, 5, 9, 20, 60]) for w in words}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)


def test_acceptor_is_minimal_and_accepts_its_words():
    words = sorted(["taps", "tap", "top", "tops", "stop", "stops"])
    a = Acceptor(words)

    def language(state):
        found = [""] if a.final[state] else []
        return found + [c + rest for c, to in a.arcs[state].items() for rest in language(to)]

    assert sorted(language(a.start)) == words
    # No two states accept the same rests.
    assert len({frozenset(language(s)) for s in range(len(a.arcs))}) == len(a.arcs)
    assert list(OneEdit(Acceptor([])).pairs()) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_each_pair_comes_once(seed):
    words = sorted(vocabulary(seed))
    got = list(OneEdit(Acceptor(words)).pairs())
    want = {frozenset((a, b)) for a in words for b in words if near(a, b)}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


# Beginnings of more than ``most`` words are open: all, many, few or no pairs cross them.
@pytest.mark.parametrize("most", [1, 5, 60, 4_000])
def test_variants_equal_brute_force_at_any_split(spark, most):
    counts = vocabulary(most)
    pairs = near_words(table(spark, counts), most).collect()
    assert len(pairs) == len({(r["word"], r["near"]) for r in pairs})
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"])
           for r in spelling_variants(table(spark, counts), most).collect()}
    assert got == brute(counts)


def test_long_common_beginnings(spark):
    """Beginnings stay open beyond the lengths that one aggregate counts."""
    rng = random.Random(8)
    counts = {"a" * 20 + "".join(rng.choices("ab", k=rng.randrange(6))): rng.randrange(1, 50)
              for _ in range(120)}
    counts |= {"b" * 3_000: 5, "b" * 2_999: 1, "c" + "b" * 2_999: 2}
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"])
           for r in spelling_variants(table(spark, counts), 4).collect()}
    assert got == brute(counts)


def test_words_are_counted_and_misspelt_as_defined(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["Straße", "house", "Élan", "ÉLANS", "naïve", "it", "word1word", "a×b"])
                      for _ in range(300)) for _ in range(30)] + [None, ""]
    ids = [None, *range(1, len(texts))]
    want = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 7 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    docs = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts)],
                                 "doc_id long, text string, word string")
    got = {r["word"]: r["n"] for r in count_words(docs, misspell=7).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert spelling_variants(count_words(docs.limit(0))).count() == 0


def test_ties_and_null_words(spark):
    counts = {"caabb": 3, "baabb": 9, "daabb": 9, "baabbx": 18}
    rows = [*counts.items(), (None, 4), ("", 5)]
    got = {r["word"]: r for r in spelling_variants(
        spark.createDataFrame(rows, "word string, n long")).collect()}
    assert set(got) == set(counts)
    assert got["caabb"]["form"] == "baabb" and got["caabb"]["root"] == "baabbx"
    assert got["daabb"]["form"] is None and got["daabb"]["root"] == "daabb"
