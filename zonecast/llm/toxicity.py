"""Toxicity: a lexicon trie intersected with Levenshtein automata, and scores
of the context around each match.

The lexicon is learnt from labelled documents: words, and stems of words,
that occur in toxic texts much more often than in others (copies of a text
count once): in `LEAST_DOCS` toxic texts, with log odds of `LEAST_ODDS`, and
not by chance. Thousands of words are tried, so each has a bound on the
probability of its counts, were it as usual in toxic texts as in others, and
the bounds are held against a false discovery rate of `CHANCE` (Benjamini and
Hochberg). A term of 5 letters or more may have one error, of 9 or more two.

A word of a document is looked up by pieces: a term cut into one piece more
than it may have errors keeps one piece whole (pigeonhole), so the terms that
share a piece with the word are all that can match. Of the trie the branches of
these terms are walked together with the word's Levenshtein automaton
(bit-parallel: one mask of positions per number of errors), and branches in
which no state is left are cut. So the index finds the candidates, the automaton
decides, and a word costs a few lookups, not the lexicon. A word may have the
errors of a term one letter longer than itself, so a word of 7 letters is one
error from a term, not two. Words that clean labelled documents use themselves
are neither misspellings nor derived from a stem.

Each match is judged by the words around it: how many other matches there are,
whether it stands between quotation marks, and how the words near it speak for
or against abuse. These context words are learnt like the lexicon, from the
words near matches in toxic and in other labelled texts: those who quote a word
report it, those who abuse address someone. A logistic model over these scores
gives the document's score. It is fitted on a bounded sample (`SAMPLE`
documents of each class at most, those with the smallest id hash); every
document is scored over its whole text.

Defined cases: null and empty texts have no match and get the model's score
for none; null ids have no label and are not held out; a document with several
labels counts as its highest; without labels of both classes every score is 0;
other columns of the inputs are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import staged
from zonecast.llm.pu_quality import Logistic, _sigmoid, fit_logistic, sample

SAMPLE = 20_000
MOST_ENTRIES = 200_000   # terms, stems, exceptions and context words that workers hold, each; more is an error
STEMS = (4, 5, 6)
LEAST_DOCS = 3           # toxic texts that must hold a term
LEAST_CLEAN = 2          # clean texts that make a word one of their own
LEAST_ODDS = 3.0         # smoothed log odds of a term
CHANCE = 0.05            # false discoveries among terms, and among context words
LEAST_CONTEXT_ODDS = 1.0 # of a context word, for or against
REACH = 8                # words of context on either side
CACHE = 1 << 20          # words whose match a worker remembers

WORDS = re.compile(r"[^\W_]+")
TOKENS = re.compile(r"[^\W_]+|[\"“”„«»]")
QUOTES = frozenset("\"“”„«»")


def allowed_errors(term: str) -> int:
    return _errors(len(term))


def _errors(size: int) -> int:
    return 0 if size < 5 else 1 if size < 9 else 2


def _cuts(size: int) -> list[int]:
    """Ends of the pieces of a term, one more than it is allowed errors."""
    n = _errors(size) + 1
    return [size * i // n for i in range(n + 1)]


def _letters(word: str) -> int:
    """A bit for each letter's first occurrence, its second, and so on; letters
    may share theirs. An error sets one bit and clears one at most."""
    out = 0
    for c in word:
        bit = 1 << (ord(c) & 63)
        while out & bit:
            bit <<= 64
        out |= bit
    return out


class Trie:
    """Terms and stems, and an index of the terms' pieces."""

    def __init__(self, terms: list[str], stems: list[str]):
        self.terms, self.stems = terms, stems
        self.term_at = {t: i for i, t in enumerate(terms)}
        self.stem_at = {s: i for i, s in enumerate(stems)}
        self.stem_sizes = sorted({len(s) for s in stems})
        self.sizes = sorted({len(t) for t in terms if allowed_errors(t)})
        self.pieces: dict[tuple[int, int, str], list[int]] = {}
        for i, t in enumerate(terms):
            if allowed_errors(t):
                cuts = _cuts(len(t))
                for p, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    self.pieces.setdefault((len(t), p, t[start:end]), []).append(i)
        self.letters = [(_letters(t), allowed_errors(t)) for t in terms]
        self.probes: dict[int, list[tuple[int, int, int, int]]] = {}

    def _probes(self, m: int) -> list[tuple[int, int, int, int]]:
        """(term size, piece, start, end): where a word of m letters can hold
        a piece that its errors left as it was."""
        out, k = [], _errors(m + 1)
        for size in self.sizes:
            e, more = min(k, _errors(size)), m - size
            if abs(more) > e:
                continue
            cuts = _cuts(size)
            last = len(cuts) - 2
            for p, (start, end) in enumerate(zip(cuts, cuts[1:])):
                # a piece moves by the errors before it; the first one has none there, the last none after it
                for by in [0] if p == 0 else [more] if p == last else range(-e, e + 1):
                    if abs(by) + abs(more - by) <= e and start + by >= 0 and end + by <= m:
                        out.append((size, p, start + by, end + by))
        return out

    def candidates(self, word: str) -> set[int]:
        """All terms that can match: of one piece more than there are errors,
        one stands in the word as it stands in the term, and an error brings or
        takes one letter at most."""
        m = len(word)
        if not self.sizes or m > self.sizes[-1] + 2:
            return set()
        if m not in self.probes:
            self.probes[m] = self._probes(m)
        pieces, out = self.pieces, set()
        for size, p, start, end in self.probes[m]:
            if (found := pieces.get((size, p, word[start:end]))) is not None:
                out.update(found)
        if not out:
            return out
        own, letters = _letters(word), self.letters
        return {i for i in out if (own & ~letters[i][0]).bit_count() <= letters[i][1]
                and (letters[i][0] & ~own).bit_count() <= letters[i][1]}

    def match(self, word: str) -> tuple[int, bool, int] | None:
        """The best (entry number, is a stem, errors): fewest errors first,
        terms before stems."""
        if word in self.term_at:
            return self.term_at[word], False, 0
        for n in self.stem_sizes:
            if word[:n] in self.stem_at:
                return self.stem_at[word[:n]], True, 0
        near = self.candidates(word)
        if not near:
            return None
        m = len(word)
        full, goal = (1 << (m + 1)) - 1, 1 << m
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | (1 << i)
        k = allowed_errors(word + "x")
        best = None
        # a node of the candidates' trie: its depth, and the terms below it
        stack = [(0, near, tuple(((1 << (e + 1)) - 1) & full for e in range(k + 1)))]
        while stack:
            depth, below_it, states = stack.pop()
            children: dict[str, list[int]] = {}
            for i in below_it:      # terms of the same letters up to here
                term = self.terms[i]
                if len(term) > depth:
                    children.setdefault(term[depth], []).append(i)
                    continue
                for e, s in enumerate(states[:allowed_errors(term) + 1]):
                    if s & goal:
                        if best is None or (e, i) < best:
                            best = (e, i)
                        break
            for c, terms in children.items():
                hit = at.get(c, 0)
                new, below, below_new = [], 0, 0
                for s in states:
                    t = ((s & hit) << 1 | below | below << 1 | below_new << 1) & full
                    new.append(t)
                    below, below_new = s, t
                if any(new):
                    stack.append((depth + 1, terms, tuple(new)))
        return None if best is None else (best[1], False, best[0])


class Lexicon:
    """The trie, a weight per entry, words that match only as terms, and the
    log odds of context words."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], exceptions=(), context=None):
        self.trie = Trie(list(terms), list(stems))
        self.term_weight, self.stem_weight = list(terms.values()), list(stems.values())
        self.exceptions = frozenset(exceptions)
        self.context: dict[str, float] = dict(context or {})
        self.cache: dict[str, tuple | None] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def find(self, word: str):
        """(weight, errors, is a stem, entry) or None."""
        got = self.trie.match(word)
        if got is None:
            return None
        i, stem, errors = got
        if (stem or errors) and word in self.exceptions:
            return None
        return (self.stem_weight if stem else self.term_weight)[i], errors, stem, i

    def matches(self, words: set[str]) -> dict[str, tuple]:
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        for w in words:
            if w not in cache:
                cache[w] = self.find(w)
        return {w: got for w in words if (got := cache[w]) is not None}


N_FEATURES = 11


def _places(text: str | None, lexicon: Lexicon) -> tuple[list[str], list[int], list[tuple]]:
    """A text's tokens, the places of its matches, and the matches."""
    tokens = TOKENS.findall((text or "").lower())
    found = lexicon.matches(set(tokens) - QUOTES)
    places = [i for i, w in enumerate(tokens) if w in found] if found else []
    return tokens, places, [found[tokens[i]] for i in places]


def context_features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Scores of a document's matches and of the words around them."""
    out = np.zeros(N_FEATURES)
    tokens, places, hits = _places(text, lexicon)
    if not hits:
        return out
    where = np.array(places)

    def within_reach(at: np.ndarray) -> np.ndarray:
        return (np.searchsorted(at, where + REACH, "right")
                - np.searchsorted(at, where - REACH, "left"))

    around = within_reach(where) - 1
    quotes = np.array([i for i, t in enumerate(tokens) if t in QUOTES], int)
    opened = np.searchsorted(quotes, where)
    quoted = int(((opened % 2 == 1) & (len(quotes) > opened)).sum())
    odds = np.zeros(len(where))
    if lexicon.context:
        known = [(i, lexicon.context[t]) for i, t in enumerate(tokens) if t in lexicon.context]
        at, said = np.array([i for i, _ in known], int), np.array([o for _, o in known])
        sums = np.concatenate([[0.0], np.cumsum(said)])
        odds = (sums[np.searchsorted(at, where + REACH, "right")]
                - sums[np.searchsorted(at, where - REACH, "left")])
    odds = np.clip(odds, -6, 6) / 6
    n_words = len(tokens) - len(quotes)
    n = len(hits)
    exact = sum(h[1] == 0 and not h[2] for h in hits)
    weights = [h[0] for h in hits]
    out[:] = [1, np.log1p(exact), np.log1p(sum(h[1] > 0 for h in hits)),
              np.log1p(sum(h[2] for h in hits)), np.log1p(len({h[2:] for h in hits})),
              np.log1p(1000 * n / n_words), max(weights) / 5, np.log1p(float(around.mean())),
              quoted / n, float(np.maximum(odds, 0).mean()), float(np.maximum(-odds, 0).mean())]
    return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, stem, toxic): each word and stem of a document once."""
    for b in batches:
        term, stem, toxic = [], [], []
        for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
            words = set(WORDS.findall((text or "").lower()))
            heads = {w[:n] for w in words for n in STEMS if len(w) > n}
            term += [*words, *heads]
            stem += [False] * len(words) + [True] * len(heads)
            toxic += [y] * (len(words) + len(heads))
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(stem, pa.bool_()),
                                          pa.array(toxic, pa.int64())], ["term", "stem", "toxic"])


def _log_chance(most: float, n: float, share: float) -> float:
    """Logarithm of a bound (Chernoff's) on the probability of `most` or more
    of n, each with probability `share`."""
    a = most / n
    if a <= share:
        return 0.0
    rest = (1 - a) * np.log((1 - a) / (1 - share)) if a < 1 else 0.0
    return float(-n * (a * np.log(a / share) + rest))


def chance_cut(tried: list[tuple[int, int, int]], share: float) -> float:
    """The largest log bound that passes a false discovery rate of `CHANCE`.
    `tried`: (toxic, clean, how many words have these counts)."""
    bounds = sorted((_log_chance(t, t + c, share), n) for t, c, n in tried)
    total = sum(n for _, n in bounds)
    cut, rank = -np.inf, 0
    for bound, n in bounds:
        rank += n
        if bound <= np.log(CHANCE * rank / total):
            cut = bound
    return cut


def _log_chance_column(most: Column, n: Column, share: float) -> Column:
    a = most / n
    rest = F.when(a < 1, (1 - a) * F.log((1 - a) / F.lit(1 - share))).otherwise(0.0)
    return F.when(a <= share, 0.0).otherwise(-n * (a * F.log(a / F.lit(share)) + rest))


def _not_by_chance(counts: DataFrame, share: float) -> DataFrame:
    """The rows of `counts` (toxic, clean) whose toxic count is no chance."""
    tried = counts.where(F.col("toxic") + F.col("clean") >= LEAST_DOCS)
    # one row per pair of counts: bounded by the labelled sample, not by its words
    pairs = [(r["toxic"], r["clean"], r["count"]) for r in tried.groupBy("toxic", "clean").count().collect()]
    cut = chance_cut(pairs, share) if pairs else -np.inf
    bound = _log_chance_column(F.col("toxic"), F.col("toxic") + F.col("clean"), share)
    return tried.where(bound <= F.lit(float(max(cut, -1e300)) + 1e-9))


def _bounded(rows: DataFrame, what: str) -> list:
    got = rows.limit(MOST_ENTRIES + 1).collect()
    if len(got) > MOST_ENTRIES:
        raise ValueError(f"{rows.count()} {what} tell toxic texts from others, more than "
                         f"MOST_ENTRIES = {MOST_ENTRIES}: raise it, or LEAST_ODDS")
    return got


def _odds(n_toxic: float, n_clean: float) -> Column:
    return (F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0))
            - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1.0)))


def learn_lexicon(labelled: DataFrame, n_toxic: int, n_clean: int) -> Lexicon:
    """From `labelled`: doc_id, text, y."""
    counts = (labelled.select("text", "y").mapInArrow(_terms, "term string, stem boolean, toxic long")
              .groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"),
                                           F.sum(1 - F.col("toxic")).alias("clean")))
    counts = staged(counts.withColumn("odds", _odds(n_toxic, n_clean)), "term-counts")
    strong = _not_by_chance(counts, n_toxic / (n_toxic + n_clean)).where(
        (F.col("toxic") >= LEAST_DOCS) & (F.col("odds") >= LEAST_ODDS))
    ordered = strong.orderBy(F.desc("toxic"), "term")
    terms = {r["term"]: r["odds"] for r in _bounded(ordered.where(~F.col("stem")), "terms")}
    stems = {r["term"]: r["odds"] for r in _bounded(ordered.where("stem"), "stems") if r["term"] not in terms}
    # a stem below another stem adds nothing; a term does, as stems match without errors
    stems = {t: o for t, o in stems.items() if not any(t[:n] in stems for n in STEMS if n < len(t))}
    rough = Lexicon(terms, stems)

    def unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("term").to_pylist()
            near = [(got := rough.find(w)) is not None and bool(got[1] or got[2]) for w in words]
            yield b.filter(pa.array(near, pa.bool_()))

    used = (counts.where(~F.col("stem") & (F.col("clean") > F.col("toxic"))
                         & (F.col("clean") >= LEAST_CLEAN))
            .select("term").mapInArrow(unlike, "term string"))
    return Lexicon(terms, stems, [r["term"] for r in _bounded(used, "words of clean texts")])


def _near_words(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """(word, toxic): each word near a match once a document, and one row with
    a null word for each document with a match."""
    for b in batches:
        word, toxic = [], []
        for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
            tokens, places, _ = _places(text, lexicon)
            if not places:
                continue
            own = {tokens[i] for i in places}
            near = {t for i in places for t in tokens[max(0, i - REACH):i + REACH + 1]} - own - QUOTES
            word += [None, *near]
            toxic += [y] * (len(near) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(toxic, pa.int64())],
                                         ["word", "toxic"])


def learn_context(labelled: DataFrame, lexicon: Lexicon) -> Lexicon:
    """`lexicon` with the log odds of words near its matches in `labelled`
    (text, y): for abuse where they stand in toxic texts more often than
    chance, against it in others."""
    shared = labelled.sparkSession.sparkContext.broadcast(lexicon)
    counts = staged(labelled.select("text", "y").mapInArrow(
        lambda b: _near_words(b, shared.value), "word string, toxic long")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")),
        "context-counts")
    with_match = counts.where("word is null").first()
    if with_match is None or not with_match["toxic"] or not with_match["clean"]:
        return lexicon                      # all matches are of one kind
    n_toxic, n_clean = with_match["toxic"], with_match["clean"]
    share = n_toxic / (n_toxic + n_clean)
    words = counts.where("word is not null").withColumn("odds", _odds(n_toxic, n_clean))
    abuse = _not_by_chance(words, share).where(F.col("odds") >= LEAST_CONTEXT_ODDS).select("word", "odds")
    swapped = words.select("word", F.col("clean").alias("toxic"), F.col("toxic").alias("clean"), "odds")
    other = _not_by_chance(swapped, 1 - share).where(F.col("odds") <= -LEAST_CONTEXT_ODDS).select("word", "odds")
    learnt = _bounded(abuse.unionByName(other).orderBy("word"), "words around matches")
    return Lexicon(dict(zip(lexicon.trie.terms, lexicon.term_weight)),
                   dict(zip(lexicon.trie.stems, lexicon.stem_weight)), lexicon.exceptions,
                   {r["word"]: r["odds"] for r in learnt})


def _context_rows(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [context_features(t.as_py(), lexicon) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(x, pa.list_(pa.float64()))],
                                         ["y", "x"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic",
          most: int = SAMPLE) -> tuple[Lexicon, Logistic] | None:
    """Fit on `docs` and `labels` (doc_id, `label`), the labels already
    without the rows that must not be learnt from."""
    spark = docs.sparkSession
    per = (labels.where(F.col(label).isNotNull()).groupBy("doc_id")
           .agg(F.max(F.col(label).cast("int")).alias("y")))
    ids = (sample(per.where("y = 1"), most).withColumn("y", F.lit(1)).unionByName(
        sample(per.where("y = 0"), most).withColumn("y", F.lit(0))))
    rows = staged(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "labelled")
    texts = rows.groupBy(F.xxhash64("text"), "y").agg(F.min("text").alias("text"))
    found = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    if len(found) < 2:
        return None
    lexicon = learn_context(texts, learn_lexicon(texts, found[1], found[0]))
    shared = spark.sparkContext.broadcast(lexicon)
    fitted = (rows.select("y", "text").mapInArrow(lambda b: _context_rows(b, shared.value),
                                                  "y int, x array<double>")
              .groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).collect())
    x = np.array([r["x"] for r in fitted])
    y = np.array([r["y"] for r in fitted], float)
    n = np.array([r["n"] for r in fitted], float)
    # rows with equal features are one weighted row
    model = fit_logistic([x], lambda z: n / n.sum() * (_sigmoid(z) - y))
    return lexicon, model


def scores(docs: DataFrame, trained: tuple[Lexicon, Logistic] | None,
           keep: list[str]) -> DataFrame:
    """`keep` and score of every row of `docs` (columns `keep` and text)."""
    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    shared = docs.sparkSession.sparkContext.broadcast(trained)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            if model is None:
                s = np.zeros(b.num_rows)
            else:
                s = model[1].score(np.array([context_features(t.as_py(), model[0])
                                             for t in b.column("text")]).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(s)],
                                             [*keep, "score"])

    return docs.select(*keep, "text").mapInArrow(scored, f"{fields}, score double")
