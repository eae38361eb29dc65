"""Spelling variants: words one edit apart, and the frequent form that each leads to.

The vocabulary as an acceptor A is composed with a transducer E that copies letters and makes
exactly one edit (insert, delete or replace), and with A again. A path through A . E . A is a state
(p, edited, q); as long as nothing was edited both sides have read the same letters, so p = q, and
once the edit is made both must read the same rest. A pair is found once: where its words differ
first.

The work is split by initial states, that is by what both sides have read so far. A beginning with
at most ``MOST`` words is one partition: its words make a minimal acceptor in one task, and the
composition is enumerated from there. A beginning with more words is open. It goes on with its
longer beginnings, and only the edits made right there remain; after such an edit the two sides
must accept equal rests, so these pairs come from a Spark aggregate by (place, rest). There a key
has at most one word per letter of the alphabet.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.sources.scratch import materialize

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LENGTH, COUNT = 5, 3
# Words of one acceptor, and how many lengths of beginnings are counted in one aggregate.
MOST, LEVELS = 4_000, 8


def count_words(docs: DataFrame, misspell: int = 0) -> DataFrame:
    """``(word, n)`` of the runs of letters in ``docs (doc_id, text)``, A-Z lower-cased.

    With ``misspell`` m, about one run in m loses a letter: where m divides h, the crc32 of
    ``doc_id:run``, the letter h modulo the run's length goes. A null doc_id counts as empty, a
    null text has no runs. Kept are words of at least ``LENGTH`` letters and ``COUNT`` runs.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        F.translate("text", UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run"))
    word: Column = F.col("run")
    if misspell:
        name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), word)
        runs = runs.select("run", F.crc32(F.encode(name, "UTF-8")).alias("h"))
        at = F.pmod("h", F.length("run")).cast("int")
        word = F.when(F.col("h") % misspell == 0, F.concat(
            F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
        ).otherwise(word)
    words = runs.select(word.alias("word")).where(F.length("word") >= LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= COUNT)


class Acceptor:
    """The minimal deterministic acceptor of sorted distinct words, built word by word."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], bool]] = [({}, False)]
        last = ""
        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            self._close(path, last, same)
            path += [({}, False) for _ in range(len(word) - same)]
            path[-1] = (path[-1][0], True)
            last = word
        self._close(path, last, 0)
        self.start = self._state(*path[0])

    def _close(self, path, word: str, size: int) -> None:
        """States of ``word`` beyond ``size`` letters get no more arcs: share equal ones."""
        while len(path) > size + 1:
            state = self._state(*path.pop())
            path[-1][0][word[len(path) - 1]] = state

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, *arcs.items())
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return found


class OneEdit:
    """The composition of an acceptor, one edit and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self.acceptor = acceptor
        self._common: dict[tuple[int, int], list[str]] = {}
        self._edits: dict[int, list[tuple[str, str, str]]] = {}

    def common(self, p: int, q: int) -> list[str]:
        """The rests that both states accept."""
        arcs, final, done = self.acceptor.arcs, self.acceptor.final, self._common
        stack = [(p, q)]
        while stack:
            p1, q1 = at = stack[-1]
            if at in done:
                stack.pop()
                continue
            steps = [(c, (arcs[p1][c], arcs[q1][c])) for c in arcs[p1] if c in arcs[q1]]
            open_steps = [to for _, to in steps if to not in done]
            if open_steps:
                stack += open_steps
                continue
            found = [""] if final[p1] and final[q1] else []
            for c, to in steps:
                found += [c + rest for rest in done[to]]
            done[at] = found
            stack.pop()
        return done[p, q]

    def edits(self, state: int) -> list[tuple[str, str, str]]:
        """``(a, b, rest)``: from a state both a + rest and b + rest are accepted, where a and b
        are different letters, or a is a letter that rest doesn't begin with and b is nothing."""
        found = self._edits.get(state)
        if found is None:
            arcs = self.acceptor.arcs[state]
            letters = sorted(arcs)
            found = [(a, b, rest) for k, a in enumerate(letters) for b in letters[:k]
                     for rest in self.common(arcs[a], arcs[b])]
            found += [(a, "", rest) for a in letters for rest in self.common(arcs[a], state)
                      if not rest.startswith(a)]
            self._edits[state] = found
        return found

    def pairs(self):
        """All pairs of words one edit apart, each once."""
        stack = [("", self.acceptor.start)]
        while stack:
            read, state = stack.pop()
            for a, b, rest in self.edits(state):
                yield read + a + rest, read + b + rest
            stack += [(read + c, to) for c, to in self.acceptor.arcs[state].items()]


def _composed(table: pa.Table) -> pa.Table:
    """The pairs of one partition, both ways."""
    counts = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))
    words, near = [], []
    for a, b in OneEdit(Acceptor(sorted(counts))).pairs():
        words += (a, b)
        near += (b, a)
    return pa.table({"word": pa.array(words, pa.string()), "near": pa.array(near, pa.string()),
                     "near_n": pa.array([counts[w] for w in near], pa.int64())})


def _open_beginnings(words: DataFrame, most: int) -> DataFrame | None:
    """Beginnings of more than ``most`` words, stored; None if there are none."""
    found, low = [], 0
    while True:
        lengths = F.sequence(F.lit(low + 1), F.least(F.length("word"), F.lit(low + LEVELS)))
        begins = words.where(F.length("word") > low).select(F.explode(lengths).alias("k"), "word")
        many = materialize(
            begins.groupBy(F.substring("word", F.lit(1), F.col("k")).alias("begin")).count()
            .where(F.col("count") > most).select("begin"), "open")
        if not many.head(1):
            break
        found.append(many)
        low += LEVELS
        last = many.where(F.length("begin") == low).select(F.col("begin").alias("last"))
        words = words.join(last, F.substring("word", 1, low) == F.col("last"), "left_semi")
    return reduce(DataFrame.unionByName, found) if found else None


def _depths(words: DataFrame, most: int) -> DataFrame:
    """``(word, n, depth)``, stored: the shortest beginning of a word that is not open, which
    is longer than the word if the word itself is open. The empty beginning is always open."""
    many = _open_beginnings(words, most)
    if many is None:
        return materialize(words.withColumn("depth", F.lit(1)), "depths")
    longest = many.agg(F.max(F.length("begin"))).head()[0]
    begins = words.select("word", F.explode(F.sequence(
        F.lit(1), F.least(F.length("word"), F.lit(longest)))).alias("k"))
    begins = begins.withColumn("begin", F.substring("word", F.lit(1), F.col("k")))
    depth = begins.join(many, "begin", "left_semi").groupBy("word").agg(
        (F.count("*") + 1).cast("int").alias("depth"))
    return materialize(words.join(depth, "word", "left").select(
        "word", "n", F.coalesce("depth", F.lit(1)).alias("depth")), "depths")


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """``(word, near, near_n)`` for all pairs of different words one edit apart, both ways.

    ``words (word, n)`` holds each word once; null and empty words are left out.
    """
    words = _depths(words.where(F.length("word") > 0).select("word", "n"), most)
    inside = words.where(F.length("word") >= F.col("depth")).groupBy(
        F.substring("word", F.lit(1), F.col("depth")).alias("begin")).applyInArrow(
            lambda table: _composed(table), "word string, near string, near_n long")
    # Edits at the end of an open beginning of k letters: with or without a letter there, the
    # beginning and the rest are equal.
    size = F.length("word")
    places = words.select("word", "n", F.explode(F.sequence(
        F.lit(0), F.least(size, F.col("depth") - 1))).alias("k"))
    letter = F.substring("word", F.col("k") + 1, F.lit(1))
    without = F.concat(F.substring("word", F.lit(1), F.col("k")),
                       F.substring("word", F.col("k") + 2, size))
    sides = places.select("k", F.explode(F.array(
        F.struct(without.alias("key"), letter.alias("letter")),
        F.struct(F.col("word").alias("key"), F.lit("").alias("letter")))).alias("s"), "word", "n")
    # At the end of a word there is no letter to leave out.
    sides = sides.where((F.col("k") < size) | (F.col("s.letter") == "") & (F.col("s.key") == F.col("word")))
    sides = sides.groupBy("k", F.col("s.key").alias("key")).agg(F.collect_set(F.struct(
        F.col("s.letter").alias("letter"), "word", "n")).alias("all")).where(F.size("all") > 1)
    one, other = sides.select("k", "key", "all", F.explode("all").alias("x")), "y"
    both = one.select("k", "key", "x", F.explode("all").alias(other))
    begins_rest = F.substring("key", F.col("k") + 1, F.lit(1))
    differ = (F.col("x.letter") != F.col("y.letter")) & ~(
        ((F.col("x.letter") == "") | (F.col("y.letter") == ""))
        & (begins_rest != "")
        & (F.concat("x.letter", "y.letter") == begins_rest))
    across = both.where(differ).select(
        F.col("x.word").alias("word"), F.col("y.word").alias("near"), F.col("y.n").alias("near_n"))
    return inside.unionByName(across)


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the ends of the chains in ``(word, form)``, by doubling steps.

    A form is at least twice as frequent as its word, so chains have no loops and few steps.
    """
    steps = materialize(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = materialize(steps.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"),
            F.col("beyond").isNotNull().alias("moved")), "steps")
        steps = joined.select("word", "root")
        if not joined.where("moved").head(1):
            return steps


def spelling_variants(words: DataFrame, most: int = MOST) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for each word of ``words (word, n)``.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (ties: the
    smallest), if it is at least twice as frequent as the word, else null. ``root`` is where the
    forms lead in the end: the word itself if it has no form. An empty vocabulary has no rows.
    """
    words = materialize(words.select("word", "n").where(F.length("word") > 0), "words")
    near = near_words(words, most).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    form_n = -F.col("best.less")
    frequent = form_n >= 2 * F.col("n")
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.form")).alias("form"),
        F.when(frequent, form_n).alias("form_n")), "forms")
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
