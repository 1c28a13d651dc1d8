"""Toxicity from a learned lexicon, met through Levenshtein automata.

Terms (whole words, and stems that many toxic words share) are learned from labelled
training texts. A text's words run through the automaton of "at most k edits" over the
terms' trie (two neighbouring letters that changed places are one edit): the states
reached after a prefix are the trie nodes with their edit rows, and prefixes that no term
can match any more are remembered as dead. What clean training texts use within an edit
of a term (words, and beginnings that look like a stem) is no hit. Every hit is then
weighed by its context window: quotation marks around it, or words of speaking before
it, mark a quotation. A logistic model over the weighed sums gives the score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import in_fold
from barlake.runtime import stage

#: At most so many labelled training texts teach the lexicon and the model.
TRAIN_ROWS = 40_000
THRESHOLD = 0.7
#: Words on each side of a hit that its context window holds.
WINDOW = 5
#: Weight of a hit that its window shows to be quoted.
QUOTED = 0.25
_QUOTES = "\"“”„«»‹›"
#: Words that introduce what somebody else said.
_SAYING = frozenset(
    "said says wrote quoted called calls word term sagte schrieb wort begriff dit écrit mot"
    " terme dijo escribió palabra término".split()
)
_edge = re.compile(r"^[\W_]+|[\W_]+$")
END_MARK = "$"


def core(token: str) -> str:
    """A token without marks at its ends, in lower case."""
    return _edge.sub("", token).lower()


def edits_allowed(term: str) -> int:
    """One edit for terms of at least five letters, none for shorter ones."""
    return 1 if len(term.rstrip(END_MARK)) >= 5 else 0


class Lexicon:
    """Levenshtein automaton over the trie of terms, made deterministic as words run through it.

    A term that ends in ``$`` is a whole word, any other a stem; stems are met with an
    edit only if ``edited_stems``. A state is the set of (trie node, edits so far) that the
    letters read can stand for; the empty set is dead. A negative node -k is the first of
    two letters that changed places: the next one must be that before k's. Letters that no
    term has are one letter, so the states stay few whatever is read.

    ``misread`` has words, and beginnings of words with ``*``, that only look like a term.
    """

    def __init__(self, terms: list[str], misread: set[str] = frozenset(), edited_stems: bool = False):
        self.children: list[dict[str, int]] = [{}]
        self.before: list[str] = [""]
        self.term_at: dict[int, str] = {}
        for term in terms:
            node = 0
            for n, char in enumerate(term):
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.before.append(term[n - 1] if n else "")
                node = self.children[node][char]
            self.term_at[node] = term
        self.misread = misread
        self.stem_edits = int(edited_stems)
        self.edits = max(map(self._allowed, terms), default=0)
        self.letters = set("".join(terms)) - {END_MARK}
        self.number: dict[tuple, int] = {(): 0}
        self.states: list[tuple] = [()]
        self.moves: list[dict[str, int]] = [{}]
        self.accepts: list[tuple[str, int] | None] = [None]
        self.edited_stem: list[str | None] = [None]
        self.stops: list[bool] = [True]
        self.start = self._state(self._spread({0: 0}))

    def _allowed(self, term: str) -> int:
        return edits_allowed(term) if term.endswith(END_MARK) else min(self.stem_edits, edits_allowed(term))

    def _spread(self, least: dict[int, int]) -> dict[int, int]:
        """Adds what letters left out of a term reach."""
        todo = list(least)
        while todo:
            node = todo.pop()
            if node >= 0 and least[node] < self.edits:
                for char, child in self.children[node].items():
                    if char != END_MARK and least[node] + 1 < least.get(child, self.edits + 1):
                        least[child] = least[node] + 1
                        todo.append(child)
        return least

    def _state(self, least: dict[int, int]) -> int:
        key = tuple(sorted(least.items()))
        if key not in self.number:
            best, stem = None, None
            for node, edits in key:
                if node < 0:
                    continue
                for term in (self.term_at.get(node), self.term_at.get(self.children[node].get(END_MARK))):
                    if term and edits <= self._allowed(term):
                        if best is None or (edits, term) < best[::-1]:
                            best = (term, edits)
                        if edits and not term.endswith(END_MARK) and (stem is None or term < stem):
                            stem = term
            self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.accepts.append(best)
            self.edited_stem.append(stem)
            self.stops.append(best is not None and not best[1] and not best[0].endswith(END_MARK))
        return self.number[key]

    def _move(self, state: int, char: str) -> int:
        least: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.edits and edits < least.get(node, self.edits + 1):
                least[node] = edits

        for node, edits in self.states[state]:
            if node < 0:
                if char == self.before[-node]:
                    reach(-node, edits)
                continue
            reach(node, edits + 1)  # a letter too many
            for step, child in self.children[node].items():
                if step != END_MARK:
                    reach(child, edits + (step != char))  # the letter, or another one
                    swapped = self.children[child].get(char)
                    if swapped is not None and step != char:
                        reach(-swapped, edits + 1)  # the letter after it comes first
        return self._state(self._spread(least))

    def _read(self, word: str) -> tuple[tuple[str, int] | None, list[tuple[str, str]]]:
        """What the word is exactly, if anything, and (reading, term) of what it is within an edit.

        A reading is the word, or the beginning of it that looks like a stem, with ``*``.
        """
        state = self.start
        edited: list[tuple[str, str]] = []
        for n, char in enumerate(word, 1):
            if char not in self.letters:
                char = "\0"
            step = self.moves[state].get(char)
            if step is None:
                step = self.moves[state][char] = self._move(state, char)
            state = step
            if self.stops[state]:
                break
            if self.edited_stem[state]:
                edited.append((word[:n] + "*", self.edited_stem[state]))
        best = self.accepts[state]
        if best and best[1] and best[0].endswith(END_MARK):
            edited.append((word, best[0]))
        return (best if best and not best[1] else None), edited

    def match(self, word: str) -> tuple[str, int] | None:
        """The term a word matches with the fewest edits, and that number."""
        best, edited = self._read(word)
        if best:
            return best
        return next(((term, 1) for reading, term in edited if reading not in self.misread), None)

    def near(self, word: str) -> list[str]:
        """Readings of a word that is no term by which it looks like one."""
        best, edited = self._read(word)
        return [] if best else [reading for reading, _ in edited]


def hits(text: str, lexicon: Lexicon, known: dict) -> list[tuple[str, int, float]]:
    """(term, edits, context weight) of every hit in the text, all words read."""
    tokens = text.split()
    found = []
    for n, token in enumerate(tokens):
        hit = known.get(token, known)
        if hit is known:
            if len(known) > 400_000:
                known.clear()
            word = core(token)
            known[token] = hit = lexicon.match(word) if word else None
        if hit:
            found.append((n, hit))
    return [(*hit, context_weight(tokens, n)) for n, hit in found]


def context_weight(tokens: list[str], n: int) -> float:
    """1 for abuse, ``QUOTED`` where the window shows a quotation."""
    before, after = tokens[max(0, n - WINDOW) : n], tokens[n + 1 : n + 1 + WINDOW]
    own = tokens[n]
    opened = any(t[:1] in _QUOTES for t in before) or own[:1] in _QUOTES
    closed = any(t.rstrip(".,;:!?")[-1:] in _QUOTES for t in after if t.rstrip(".,;:!?")) or (
        own.rstrip(".,;:!?")[-1:] in _QUOTES
    )
    said = any(core(t) in _SAYING for t in before)
    return QUOTED if (opened and closed) or (said and (opened or closed)) else 1.0


def features(text: str, lexicon: Lexicon, known: dict) -> list[float]:
    found = hits(text, lexicon, known)
    exact = sum(w for _, edits, w in found if not edits)
    near = sum(w for _, edits, w in found if edits)
    terms = len({t for t, _, w in found if w == 1.0})
    return [math.log1p(exact), math.log1p(near), math.log1p(terms), float(exact >= 1)]


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Newton steps for a logistic model with an intercept (first) and a ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def choose_terms(counts: dict[str, tuple[int, int]], toxic: int, clean: int, tried: int) -> list[str]:
    """Terms from (toxic, clean) text counts of words (with ``$``) and their stems.

    A term occurs almost only in toxic texts, and in so many that none of the ``tried``
    stems would by chance. A stem is taken where it branches: none of its longer forms has
    nearly as many texts, and no shorter term covers it already.
    """
    rate = toxic / (toxic + clean)
    least = max(3, math.ceil(math.log(0.05 / max(1, tried)) / math.log(rate))) if rate < 1 else 3
    good = {w: t for w, (t, c) in counts.items() if t >= least and c * toxic <= 0.02 * t * clean}
    followed: dict[str, int] = {}
    for w, t in good.items():
        followed[w[:-1]] = max(followed.get(w[:-1], 0), t)
    closed = [w for w, t in good.items() if followed.get(w, 0) < 0.8 * t]
    chosen: set[str] = set()
    for w in sorted(closed, key=lambda w: (len(w), w)):
        if not any(w[:k] in chosen for k in range(1, len(w))):
            chosen.add(w)
    return sorted(chosen)


def _stem_counts(train: DataFrame) -> tuple[dict[str, tuple[int, int]], int]:
    """Toxic and clean training texts by word, and by stem of 4 letters or more, as far as
    enough toxic ones hold it; and how many stems toxic texts have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stems: set[str] = set()
                for word in {core(t) for t in set(text.split())}:
                    if 1 <= len(word) <= 30:
                        # A short word is learned as it is, without stems.
                        stems.update(word[:k] for k in range(4, min(len(word), 12) + 1))
                        stems.add(word + END_MARK)
                for stem in stems:
                    counts.setdefault(stem, [0, 0])[0 if toxic else 1] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.string()),
                    pa.array([c[0] for c in counts.values()], pa.int64()),
                    pa.array([c[1] for c in counts.values()], pa.int64()),
                ],
                names=["stem", "toxic", "clean"],
            )

    sums = train.select("text", "toxic").mapInArrow(run, "stem string, toxic long, clean long")
    sums = sums.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sums = stage(sums.where("toxic > 0"), "stems")
    # Seen in 3 toxic texts and mostly there: a bounded sample gives a bounded table.
    rows = sums.where("toxic >= 3 AND clean <= toxic").collect()
    return {r[0]: (r[1], r[2]) for r in rows}, sums.count()


def distinct_texts(train: DataFrame) -> DataFrame:
    """One of each family of near copies, whose words would count as independent evidence.

    Families share a least shingle hash; two rounds with different hashes find most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[list[int]] = [[], []]
            for text in batch.column(0).to_pylist():
                tokens = text.split()
                grams = [" ".join(tokens[n : n + 4]) for n in range(max(1, len(tokens) - 3))]
                first = [zlib.crc32(g.encode()) for g in grams]
                keys[0].append(min(first))
                keys[1].append(min(h * 0x9E3779B1 % (1 << 32) for h in first))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(k, pa.int64()) for k in keys]],
                names=["text", "toxic", "k1", "k2"],
            )

    rows = train.select("text", F.col("toxic").cast("int")).mapInArrow(run, "text string, toxic int, k1 long, k2 long")
    for key in ("k1", "k2"):
        least = F.min(F.struct("text", "toxic", "k1", "k2")).alias("r")
        rows = rows.groupBy(key).agg(least).select("r.*")
    return stage(rows.select("text", "toxic"), "distinct-texts")


def _misread_words(train: DataFrame, terms: list[str]) -> set[str]:
    """Readings within the edits of a term that words of clean training texts have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, known = Lexicon(terms, edited_stems=True), set()
        for batch in batches:
            found: set[str] = set()
            for text in batch.column(0).to_pylist():
                for token in set(text.split()) - known:
                    known.add(token)
                    found.update(lexicon.near(core(token)))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["word"])

    near = train.where("toxic = 0").select("text").mapInArrow(run, "word string").distinct()
    # All of them: a bounded sample has a bounded number of words.
    return {r["word"] for r in near.collect()}


def train(labelled: DataFrame) -> tuple[list[str], set[str], list[float]]:
    """Terms, words that only look like one, and model weights from (text, toxic) rows."""
    sizes = {r[0]: r[1] for r in labelled.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        share = 1.0 if toxic else 0.0
        return [], set(), [20.0 * share - 10.0, 0.0, 0.0, 0.0, 0.0]
    counts, tried = _stem_counts(distinct_texts(labelled))
    terms = choose_terms(counts, toxic, clean, tried)
    misread = _misread_words(labelled, terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, known = Lexicon(terms, misread, edited_stems=True), {}
        for batch in batches:
            rows = [features(t, lexicon, known) for t in batch.column(0).to_pylist()]
            x = np.array(rows, dtype=float).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x[:, k]) for k in range(4)], batch.column(1).cast(pa.float64())], names=[*"abcd", "y"]
            )

    rows = labelled.select("text", "toxic").mapInArrow(run, "a double, b double, c double, d double, y double").toPandas()
    x = rows[[*"abcd"]].to_numpy()
    # A misspelled term counts as much as a term, however rare it is in the sample.
    weights = fit_logistic(np.column_stack([x[:, 0] + x[:, 1], x[:, 2:]]), rows["y"].to_numpy())
    return terms, misread, [weights[0], weights[1], weights[1], *weights[2:]]


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held_fold: int, rows: int
) -> DataFrame:
    """Staged (text, label) of training ids; at most about ``rows``, chosen by a hash of the id."""
    marks = (
        labels.where(F.col(label_col).isNotNull() & ~in_fold(id_col, folds, held_fold))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    known = marks.count()
    if known > rows:
        marks = marks.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < int(1_000_003 * rows / known))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # About `rows` ids at most, so their table is broadcast and no text is shuffled.
    return stage(texts.join(F.broadcast(marks), "_id").select("text", "label"), "labelled")


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 3,
    held_fold: int = 1,
    threshold: float = THRESHOLD,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Null texts are empty; an empty text has the score of a text without hits. Null labels
    and labels of unknown ids teach nothing; of repeated labels the largest counts.
    Repeated rows are scored alike. With labels of one kind only every text gets that
    label. Other columns are ignored, an empty table gives an empty result.
    """
    labelled = training_rows(docs, labels, id_col, text_col, label_col, folds, held_fold, train_rows)
    terms, misread, weights = train(labelled.withColumnRenamed("label", "toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, known = Lexicon(terms, misread, edited_stems=True), {}
        beta = np.array(weights)
        for batch in batches:
            rows = [features(text.as_py() or "", lexicon, known) for text in batch.column(2)]
            z = np.array(rows, dtype=float).reshape(-1, 4) @ beta[1:] + beta[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                names=["_id", "held_out", "score"],
            )

    chosen = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        in_fold(id_col, folds, held_fold).alias("held_out"),
        F.col(text_col).cast("string"),
    )
    scored = chosen.mapInArrow(run, "_id long, held_out boolean, score double")
    return scored.select(
        F.col("_id").alias(id_col),
        "held_out",
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
