"""Operators on documents against brute-force versions on small tables."""

import hashlib
import random
import re
import zlib

import pytest

from gaugeframe.llm import near_copies as near
from gaugeframe.llm import pii
from gaugeframe.llm.decontaminate import (
    build_postings, contamination, phrase_matches, phrase_table, proximity_matches)
from gaugeframe.llm.language import identify_language
from gaugeframe.llm.mixing import mix_sources
from gaugeframe.llm.toxicity import POSITIVES, UNLABELLED, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_of(spark, texts, ids=None, sources=None, langs=None):
    """Documents with two extra columns whose names clash with results."""
    n = len(texts)
    ids, sources, langs = ids or range(n), sources or ["s"] * n, langs or ["en"] * n
    return spark.createDataFrame(
        [(i, t, g, s, None if t is None else len(t), "x", "y")
         for i, t, s, g in zip(ids, texts, sources, langs)], DOCS)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# --- near copies


def shingle_set(text, size):
    w = words_of(text)
    if not w:
        return set()
    k = min(size, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute_components(ids, sets, percent=80):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(ids[a]), find(ids[b])))
                root[q] = p
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_copies_equal_brute_force(spark, size):
    rng = random.Random(size)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "ONE\x0btwo", "É", "é", "one  two "]
    for n in (3, 6, 12, 40, 120, 400):
        for _ in range(4):
            base = prose(rng, n)
            for edits in (0, 1, 1, 2, n // 20, n // 10, n // 4):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(n)] = f"x{rng.randrange(9)}"
                texts.append(" ".join(copy))
    texts += ["the same text " * 30] * 50 + [" ".join(prose(rng, 20_000))]
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[k] for k in order]
    got = {r["doc_id"]: r for r in near.near_copies(docs_of(spark, texts), size).collect()}
    sets = [shingle_set(t, size) for t in texts]
    want = brute_components(list(range(len(texts))), sets)
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


@pytest.mark.parametrize("block", [1_024, 16])
def test_copies_of_an_original_of_middle_id(spark, monkeypatch, block):
    """Copies match the original, 0.85, but not each other, 0.73; it is a centre of few buckets."""
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "BLOCK_SETS", block)
    rng = random.Random(5)
    texts = []
    for base in (prose(rng, 400, 4_000), prose(rng, 400, 4_000)):
        for k in range(201):
            copy = list(base)
            for at in rng.sample(range(400), 0 if k == 100 else 16):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    want = brute_components(list(range(len(texts))), [shingle_set(t, 2) for t in texts])
    assert len(set(want.values())) < 20
    got = near.near_copies(docs_of(spark, texts), 2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_near_copies_without_ids_and_repeated_rows(spark):
    text, other = "a b c d e f g", "h i j k l m n"
    df = docs_of(spark, [text, text, text, other, None, text], [4, 4, None, None, None, 9])
    got = [(str(r["doc_id"]), r["component_id"], r["kept"]) for r in near.near_copies(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [
        ("4", 4, True), ("4", 4, True), ("None", 4, False), ("None", None, True),
        ("None", None, True), ("9", 4, False)]))


# --- benchmark passages


def brute_hits(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, found = split(text), set(), set()
    for item, passage in items:
        p = split(passage)
        k = min(window, len(p))
        parts = {tuple(p[i : i + k]) for i in range(len(p) - k + 1)} if p else ()
        for i in range(len(w) - k + 1) if p else ():
            if tuple(w[i : i + k]) in parts:
                hit.update(range(i, i + k))
                found.add(item)
    ids = ",".join(sorted(map(str, found)))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def leak_fixture():
    rng = random.Random(8)
    items = [(k, " ".join(prose(rng, 5 + 3 * k, 60))) for k in range(8)]
    items += [(50, None), (51, "--"), (52, "w1"), (53, items[6][1]), (54, "Ünï-cödé W" + "x" * 90)]
    texts = [None, "", "w1", "ÜNï cödé", "Ünï.cödé!w" + "X" * 90]
    for k in range(60):
        w = prose(rng, rng.randrange(0, 200), 60)
        for _ in range(rng.randrange(3)):
            p = rng.choice(items)[1]
            if p:
                cut = p.upper().split()
                at, a = rng.randrange(len(w) + 1), rng.randrange(len(cut))
                w[at:at] = cut[a : a + rng.randrange(1, 20)]
        texts.append(", ".join(w))
    return items, texts + texts[10:20]


@pytest.mark.parametrize("slice_windows", [100_000, 7])
def test_contamination_equals_brute_force(spark, slice_windows):
    items, texts = leak_fixture()
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in contamination(
        docs_of(spark, texts), table, slice_windows=slice_windows).collect()}
    assert got == {i: brute_hits(t, items) for i, t in enumerate(texts)}


def test_phrases_and_proximity_from_full_postings(spark):
    df = docs_of(spark, ["a b c d", "c x a y b", "a b", "c q q q q q q a b"])
    rows, postings, terms = build_postings(df, ["a b c"])
    phrases = phrase_table(spark, ["a b c"], terms, postings)
    key = {r["text_key"]: r["doc_id"] for r in rows.collect()}
    assert [(key[r["text_key"]], r["start"]) for r in phrase_matches(postings, phrases).collect()] == [(0, 0)]
    close = {key[r["text_key"]] for r in proximity_matches(postings, phrases, 2).collect()}
    assert close == {0, 1}


# --- personal data


def brute_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        odd, even = d[-1::-2], d[-2::-2]
        total = sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng, automaton = random.Random(10), pii._automaton()
    for k in range(20_000):
        n = rng.randrange(1, 60)
        letters = "0123456789.-@+ ()a%É" if k % 2 else "0123456789.. --@@++a"
        text = "".join(rng.choice(letters) for _ in range(n))
        assert [s for s in pii.find_spans(text, automaton) if s[1] < 4] == brute_spans(text), text


def test_personal_data_query_columns_and_added_spans(spark):
    text = ('É a.b@x.org, 10.0.0.255 or 4111 1111 1111 1111; +1 (523) 555-1055. '
            'token = "24be64439e3e49cf" see https://x.org/a?b.')
    rows = pii.find_personal_data(docs_of(spark, [text, None, "", "9" * 50_000 + "@"])).collect()
    r = rows[0]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(text))
    assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    added = {s.split(":")[0]: text[int(s.split(":")[1]) : int(s.split(":")[2])]
             for s in r["spans"].split(",")}
    assert added["account"] == "24be64439e3e49cf" and added["address"] == "https://x.org/a?b"
    empty = hashlib.sha256(b"").hexdigest()
    assert [(x["base_sha256"], x["spans"]) for x in rows[1:]] == [(empty, "")] * 3
    masked = pii.mask_personal_data(docs_of(spark, [text, None])).collect()
    assert masked[0]["text"].startswith("É [EMAIL], [IP] or [CARD]; [PHONE]. token = \"[ACCOUNT]\"")
    assert masked[1]["text"] is None and masked[0]["kept"] == "x"


@pytest.mark.parametrize("before, value, after", [
    ("token = ", "0123456789abcdef" * 5, " end"), ("token: ", "eyJhbGci0.eyJzdWIi.c2lnbmF0", ". End"),
    ("account ", "12345678", "."), ("Account: ", "1234 5678 9012", " is"),
    ("IBAN ", "DE89 3704 0044 0532 0130 00", " is mine"), ("iban: ", "DE89370400440532013000", ","),
    ("token = ", "0123456789" * 20_000, ""), ("the account is ", "", "closed since 2024"),
    ("account ", "", "covid-19"), ("password ", "", "strength")])
def test_account_values_are_read_to_their_end(before, value, after):
    text = before + value + after
    spans = [s for s in pii.find_spans(text, pii._automaton()) if s[1] == 5]
    assert [text[a:b] for a, _, b in spans] == ([value] if value else [])


# --- mixing


def brute_targets(sizes):
    weight = dict(zip(sizes, [5, 2, 1] * len(sizes)))
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in full else weight[s] * level for s in sizes}
        full |= above


def test_mixing_meets_targets_and_repeats_itself(spark):
    rng = random.Random(2)
    texts = [" ".join(prose(rng, rng.randrange(0, 400))) for _ in range(600)] + [None, "", "\t a\n"]
    sources = [rng.choice(["é", "b", "b", "b", "b", None, "z"]) for _ in texts]
    sources[:3] = ["a", "a", "a"]  # weighs 5 but is small
    df = docs_of(spark, texts, sources=sources)
    got = {r["doc_id"]: r for r in mix_sources(df, block_words=16, shard_slots=256).collect()}
    again = {r["doc_id"]: r["taken"] for r in mix_sources(
        df.repartition(7), block_words=16, shard_slots=256).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}
    order = sorted({s for s in sources if s}) + [None]
    total = {s: sum(size[i] for i in size if sources[i] == s) for s in order}
    want = brute_targets(total)
    for i, r in got.items():
        assert r["size"] == size[i] and r["source_size"] == total[sources[i]]
        assert r["target"] == pytest.approx(want[sources[i]]) and 0 <= r["taken"] <= 3 * r["size"]
    assert want["a"] == 3 * total["a"]
    for s in order:
        taken = sum(r["taken"] for i, r in got.items() if sources[i] == s)
        assert taken == pytest.approx(want[s], rel=0.05), s


# --- classifiers


def test_language_is_learned_outside_the_held_out_fold(spark):
    rng = random.Random(6)
    parts = {"xx": "th er on an ing ed".split(), "yy": "éau oi ent ch le qué".split()}
    texts, langs = [], []
    for k in range(300):
        lang = "xx" if k % 3 else "yy"
        texts.append(" ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(40)))
        langs.append(lang)
    texts += [None, "", "12 34 !", texts[0] * 200]
    langs += ["xx", "yy", None, "yy"]
    got = {r["doc_id"]: r for r in identify_language(docs_of(spark, texts, langs=langs)).collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        letters = texts[i] and any(c.isalpha() for c in texts[i])
        assert r["lang_pred"] == (langs[i] if letters else "und")
    unknown = identify_language(docs_of(spark, ["abc"], langs=[None])).head()
    assert unknown["lang_pred"] == "und"


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(7)
    texts, toxic = [], []
    for k in range(1_500):
        w = prose(rng, 80)
        bad = k % 8 == 0
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(80), rng.choice(["Idiot!", "scum", "moron,", "TRASH"]))
        texts.append(" ".join(w))
        toxic.append(int(bad))
    texts += [None, ""]
    rows = [(i, t) for i, t in enumerate(toxic) if i % 2 == 0]
    labels = spark.createDataFrame(rows + rows[:5] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity(docs_of(spark, texts), labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"] and i < len(toxic)]
    assert sum(got[i]["predicted"] == toxic[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= got[i]["score"] <= 1 and got[i]["predicted"] == 0 for i in (1_500, 1_501))
    none = toxicity(docs_of(spark, texts[:3]), labels.limit(0)).collect()
    assert [r["predicted"] for r in none] == [0, 0, 0]


def test_training_sample_has_its_full_bounds():
    assert (POSITIVES, UNLABELLED) == (6_000, 18_000)


# --- empty tables


def test_empty_tables(spark):
    none = docs_of(spark, ["x"]).limit(0)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for df in (near.near_copies(none), contamination(none, items), identify_language(none),
               pii.find_personal_data(none), mix_sources(none), toxicity(none, labels)):
        assert df.count() == 0
    clean = contamination(docs_of(spark, ["a b"]), items.limit(0)).head()
    assert clean["n_hit"] == 0 and not clean["contaminated"] and clean["n_words"] == 2
