"""Importance resampling and repeated paragraphs against brute-force versions on small tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gaugeframe.llm.near_copies import bands_for
from gaugeframe.llm.paragraphs import drop_repeated_paragraphs, repeated_paragraphs
from gaugeframe.llm.quality import BUCKETS, _buckets, resample
from gaugeframe.llm.text import shingles, shingles_of

DOCS = "doc_id long, text string, row string, line string, place int, good string"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "r", "l", 3, "g") for i, t in rows], DOCS)


# --- importance resampling


def test_documents_like_the_target_are_drawn(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"{'g' if i % 4 == 0 else 'b'}{rng.randrange(50)}" for _ in range(80)))
            for i in range(200)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 100, 4)], "doc_id long, quality int")
    docs = docs_of(spark, rows)
    got = {r["doc_id"]: r for r in resample(docs, labels, share=0.25).collect()}
    assert len(got) == 202 and got[900]["log_ratio"] == got[901]["log_ratio"] == 0
    assert all(got[i]["selected"] for i in range(0, 200, 4))
    assert sum(r["selected"] for r in got.values()) == math.ceil(0.25 * 202)
    assert resample(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.01, 0.3, 1.0])
def test_ratios_and_cut_equal_brute_force(spark, share):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 60))))
            for i in range(150)]
    rows += [(None, "w1 w2"), (7, rows[7][1]), (151, None), (152, "Ä é w1")]
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(0, 150)] + [(None, 1), (3, 1)],
        "doc_id long, quality int")
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for i, t in rows:
        n = np.bincount(_buckets((t or "").encode()), minlength=BUCKETS)
        raw += n
        if i is not None and i < 150 and i % 3 == 0:
            target += n
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    want = Counter((i, round(float(ratio[_buckets((t or "").encode())].sum()), 6)) for i, t in rows)
    got = resample(docs_of(spark, rows), labels, share).collect()
    assert Counter((r["doc_id"], round(r["log_ratio"], 6)) for r in got) == want
    k = math.ceil(share * len(rows))
    best = sorted((r["noisy"] for r in got), reverse=True)
    assert all(r["selected"] == bool(k and r["noisy"] >= best[k - 1]) for r in got)


def test_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = resample(docs_of(spark, [(1, "a b"), (2, "c")]), labels, 0.5).collect()
    assert sum(r["selected"] for r in got) == 1


# --- repeated paragraphs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.lower())


def brute(rows):
    """(removed, kept_in) per row by comparing all pairs of lines."""
    lines = []
    for row, (doc, text) in enumerate(rows):
        for place, line in enumerate((text or "").split("\n")):
            w = words_of(line)
            if len(w) >= 5:
                lines.append((doc if doc is not None else -1, place, row,
                              {tuple(w[i:i + 5]) for i in range(len(w) - 4)}))
    lines.sort(key=lambda x: x[:3])
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(lines)):
        for b in range(a):
            x, y = lines[a][3], lines[b][3]
            if 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    out = {row: [] for row in range(len(rows))}
    for a, (_, place, row, _) in enumerate(lines):
        if find(a) != a:
            out[row].append((place, lines[find(a)][0]))
    return {row: sorted(v) for row, v in out.items()}


def planted(seed):
    rng = random.Random(seed)
    line = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    pool = [line(rng.choice([3, 4, 5, 6, 12, 60, 70])) for _ in range(12)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(1, 6)):
            w = list(rng.choice(pool)) if rng.random() < 0.5 else line(20)
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] = f"x{i}"
            own.append((" ".join(w)).upper() if rng.random() < 0.1 else "\t" + "  ".join(w))
        rows.append((i, "\n".join(own)))
    return rows + [(60, None), (61, ""), (62, "\n\n"), (63, "a b c d"), (None, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removed_lines_equal_brute_force(spark, seed):
    rows = planted(seed)
    want = brute(rows)
    got = {r["doc_id"]: r for r in repeated_paragraphs(docs_of(spark, rows)).collect()}
    assert len(got) == len(rows) and sum(map(len, want.values())) > 20
    for row, (doc, text) in enumerate(rows):
        r = got[doc]
        kept_in = [-1 if k is None else k for k in r["kept_in"]]
        assert list(zip(r["removed"], kept_in)) == want[row]
        assert r["n_removed"] == len(want[row]) and r["repeats"] == bool(want[row])
        assert r["n_paragraphs"] == len((text or "").split("\n"))


def test_texts_lose_the_removed_lines(spark):
    rows = planted(4) + [(5, planted(4)[5][1])]
    want = Counter()
    for row, (doc, text) in enumerate(rows):
        gone = {p for p, _ in brute(rows)[row]}
        want[doc, None if text is None else "\n".join(
            x for p, x in enumerate(text.split("\n")) if p not in gone)] += 1
    docs = docs_of(spark, rows)
    out = drop_repeated_paragraphs(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want
    assert drop_repeated_paragraphs(docs.limit(0)).count() == 0
    assert repeated_paragraphs(docs.limit(0)).count() == 0


def test_bands_follow_the_recall():
    assert bands_for(80, 0.9999) == 18 and bands_for(80, 1 - 1e-12) == 32
    assert bands_for(80, 0.9999, 2) == 10


@pytest.mark.parametrize("size", [1, 2, 5])
def test_hashes_of_many_texts_equal_those_of_each(size):
    rng = random.Random(size)
    texts = [[b"w%d" % rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(80)]
    for some in (texts, [], [[]], [[], [b"a"]], [[b"a"] * 9, []]):
        codes, owner, counts = shingles_of(some, size)
        for i, words in enumerate(some):
            want = shingles(words, size)
            assert counts[i] == len(want) and (codes[owner == i] == want).all()


def test_lines_edited_around_an_original_in_the_middle(spark):
    """Lines match the original, 0.81, but hardly each other, 0.68."""
    rng = random.Random(6)
    base, rows = [f"w{rng.randrange(3_000)}" for _ in range(100)], []
    for k in range(201):
        line = list(base)
        for at in rng.sample(range(5, 95, 5), 0 if k == 100 else 2):
            line[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(line)))
    want = brute(rows)
    got = {r["doc_id"]: r["removed"] for r in repeated_paragraphs(docs_of(spark, rows)).collect()}
    assert sum(map(len, want.values())) == 200
    assert got == {row: [place for place, _ in gone] for row, gone in want.items()}
