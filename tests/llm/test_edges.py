"""Language against a plain version; very long texts and words through every text operator."""

import random
import zlib
from collections import Counter

import pytest

from gaugeframe.llm.decontaminate import contamination
from gaugeframe.llm.language import PROFILE, identify_language
from gaugeframe.llm.mixing import mix_sources
from gaugeframe.llm.near_copies import near_copies
from gaugeframe.llm.paragraphs import repeated_paragraphs
from gaugeframe.llm.pii import find_personal_data
from gaugeframe.llm.quality import resample
from gaugeframe.llm.spelling import count_words

# --- language


def grams(text):
    """Counts of n-grams of one to three characters, as tuples of code points, 0 for a blank."""
    out, codes = Counter(), [0]
    for c in (text or "").lower() + " ":
        code = ord(c) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    if len(codes) == 1:
        return out
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            g = tuple(codes[i:i + n])
            if n == 1 and not g[0] or n == 3 and not g[1]:
                continue
            out[g] += 1
    return out


def number(g):
    """The order of n-grams of equal counts: by length, then by code points."""
    return (len(g), g)


def signed(g):
    """The same among the learned ones, where the longest come first."""
    return (len(g) < 3, len(g), g)


def brute(rows):
    learned = {}
    for i, text, lang in rows:
        if i is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            learned.setdefault(lang, Counter()).update(grams(text))
    ranks = {lang: {g: r for r, g in enumerate(sorted(c, key=lambda g: (-c[g], signed(g)))[:PROFILE])}
             for lang, c in learned.items()}
    out = []
    for i, text, _ in rows:
        c = grams(text)
        mine = sorted(c, key=lambda g: (-c[g], number(g)))[:PROFILE]
        if not mine:
            out.append((i, "und", 0.0))
            continue
        far = {lang: sum(abs(r[g] - k) if g in r else PROFILE for k, g in enumerate(mine))
               / (len(mine) * PROFILE) for lang, r in ranks.items()}
        best = min(sorted(far), key=lambda lang: far[lang])
        rest = (sum(far.values()) - far[best]) / (len(far) - 1)
        out.append((i, best, min(1.0, max(0.0, 1 - far[best] / rest))))
    return out


def test_language_equals_brute_force(spark):
    rng = random.Random(3)
    words = {lang: ["".join(rng.choices(letters, k=rng.randrange(2, 8))) for _ in range(60)]
             for lang, letters in (("aa", "abcdeé"), ("bb", "cdefgß"), ("cc", "efghiø"))}
    rows = []
    for i in range(150):
        lang = rng.choice(list(words))
        rows.append((i, " ".join(rng.choices(words[lang], k=rng.randrange(1, 40))) + rng.choice([".", " 1!", ""]),
                     lang if i % 4 else None))
    rows += [(150, None, "aa"), (151, "", None), (152, "12 3", "bb"), (None, words["aa"][0], "aa"), (3, "abc", "cc")]
    docs = spark.createDataFrame([(*r, "x") for r in rows],
                                 "doc_id long, text string, lang string, score string").repartition(3)
    got = Counter((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in identify_language(docs).collect())
    assert got == Counter((i, lang, round(s, 9)) for i, lang, s in brute(rows))


# --- long texts


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(9)
    prose = " ".join(f"word{rng.randrange(5_000)}" for _ in range(200_000))
    texts = [prose, prose + " tail", "x" * 300_000, "a b@c.de " * 30_000, None, "", "short text"]
    return spark.createDataFrame(
        [(i, t, "en", "s") for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("name", ["mix", "near", "resample", "paragraphs", "language", "leaks", "pii", "words"])
def test_very_long_texts(spark, long_docs, name):
    items = spark.createDataFrame([(1, " ".join(["word1"] * 12)), (2, "short text")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1), (6, 0)], "doc_id long, quality int")
    run = {
        "mix": lambda: mix_sources(long_docs), "near": lambda: near_copies(long_docs),
        "resample": lambda: resample(long_docs, labels), "paragraphs": lambda: repeated_paragraphs(long_docs),
        "language": lambda: identify_language(long_docs), "leaks": lambda: contamination(long_docs, items),
        "pii": lambda: find_personal_data(long_docs), "words": lambda: count_words(long_docs)}
    got = run[name]().collect()
    if name == "words":
        return
    rows = {r["doc_id"]: r for r in got}
    assert sorted(rows) == list(range(7))
    if name == "near":
        assert rows[1]["component_id"] == 0 and not rows[1]["kept"]
    if name == "paragraphs":
        assert rows[1]["n_long"] == 1 and rows[0]["n_long"] == 1
    if name == "leaks":
        assert rows[6]["contaminated"] and not rows[2]["contaminated"]
    if name == "pii":
        assert rows[3]["n_email"] == 30_000
    if name == "mix":
        assert rows[0]["size"] == 200_000
