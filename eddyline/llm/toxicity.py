"""Toxicity scores by Levenshtein automata over a learned lexicon.

The lexicon is learned from labelled rows: words, and beginnings of words from four letters on,
that stand in toxic texts far more often than chance would have it. Its terms form a trie. The
Levenshtein automaton of distance one, intersected with the trie and made deterministic state
by state, reads a word and tells whether it is a term, or one edit away from a term.

Every hit is seen in its context: the hits within eight words around it, and whether it stands
in quotation marks. Marks count in pairs within a sentence: one that opens before a word, and one
that closes behind a word; others, as behind inches, are no quotation. Typographic marks are read
as plain ones, so no word contains them. Logistic regression over a few sums of hits (exact, misspelled, quoted,
crowded) gives the score; what a quotation or a misspelling is worth is learned like the rest.

Fitting takes at most `sample` labelled documents, the first by hash of doc_id. Null texts are
empty; a text without hits, the empty one too, has the score of texts without hits. Without any
usable label every score is 0. Rows without doc_id are scored and count as not held out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.batches import map_batches, only
from eddyline.llm.words import words_of
from eddyline.session import scratch_path

#: Labelled documents that fitting takes at most.
SAMPLE = 12_000

#: Letters of the shortest beginning that can be a term, and of the longest.
STEM_LETTERS = (4, 8)

#: Terms with fewer letters are not looked for misspelled.
FUZZY_LETTERS = 5

#: Words on either side of a hit that are its context.
CONTEXT = 8

PREDICTED_FROM = 0.7

#: Typographic quotation marks and apostrophes, and the plain ones they are read as.
_MARKS = {ord(mark): plain for marks, plain in (("“”„‟«»", '"'), ("‘’‚‛‹›", "'")) for mark in marks}

#: A pair of marks with no end of a sentence between.
_QUOTED = re.compile(r"""(?<![^\s(\[{'])"(?=\S)(?:(?![.!?]\s)[^"\n])+"(?!\w)""")

_FEATURES = 7


class Lexicon:
    """Deterministic automaton for words within one edit of a term; states are made when met.

    A term that ends in "*" fits every word that begins with it.
    """

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.whole, self.stem, self.fuzzy = [False], [False], [False]
        for term in terms:
            letters, node = term.removesuffix("*"), 0
            path = [0]
            for letter in letters:
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.whole.append(False)
                    self.stem.append(False)
                    self.fuzzy.append(False)
                path.append(node)
            (self.stem if term.endswith("*") else self.whole)[node] = True
            if len(letters) >= FUZZY_LETTERS:
                for node in path:
                    self.fuzzy[node] = True
        self._numbers: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._steps: list[dict[str, int]] = []
        self.value: list[int] = []
        self.start = self._state({(0, 0)})
        self._known: dict[bytes, int] = {}

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Number of a set of (trie node, edits), closed under leaving out a letter of a term."""
        for node, edits in list(pairs):
            if edits == 0 and self.fuzzy[node]:
                pairs.update((child, 1) for child in self.children[node].values() if self.fuzzy[child])
        # An accepted stem stays accepted whatever follows: node -1.
        for node, edits in list(pairs):
            if node >= 0 and self.stem[node] and (edits == 0 or self.fuzzy[node]):
                pairs.add((-1, edits))
        key = frozenset(pairs)
        number = self._numbers.get(key)
        if number is None:
            number = self._numbers[key] = len(self._sets)
            self._sets.append(key)
            self._steps.append({})
            found = [edits for node, edits in key if node < 0 or self.whole[node]]
            self.value.append(1 + min(found) if found else 0)
        return number

    def _step(self, state: int, letter: str) -> int:
        pairs: set[tuple[int, int]] = set()
        for node, edits in self._sets[state]:
            if node < 0:
                pairs.add((-1, edits))
                continue
            child = self.children[node].get(letter)
            if child is not None and (edits == 0 or self.fuzzy[child]):
                pairs.add((child, edits))
            if edits == 0 and self.fuzzy[node]:
                pairs.add((node, 1))
                pairs.update((other, 1) for other in self.children[node].values() if self.fuzzy[other])
        number = self._steps[state][letter] = self._state(pairs)
        return number

    def look_up(self, word: bytes) -> int:
        """0 for no term, 1 for a term, 2 for a term with one edit."""
        known = self._known.get(word)
        if known is None:
            state = self.start
            for letter in word.decode():
                following = self._steps[state].get(letter)
                state = self._step(state, letter) if following is None else following
                if not self._sets[state]:
                    break
            if len(self._known) > 400_000:
                self._known.clear()
            known = self._known[word] = self.value[state]
        return known


def plain_marks(text: str | None) -> str:
    return (text or "").translate(_MARKS)


def is_quoted(text: str, places: np.ndarray) -> np.ndarray:
    """Which places of a text with plain marks lie within a pair of quotation marks."""
    pairs = np.array([match.span() for match in _QUOTED.finditer(text)], np.int64).reshape(-1, 2)
    at = np.searchsorted(pairs[:, 0], places, "right") - 1
    return (at >= 0) & (places < pairs[at, 1]) if len(pairs) else np.zeros(len(places), bool)


def text_features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Sums over the hits of a text."""
    features = np.zeros(_FEATURES)
    text = plain_marks(text)
    words = words_of(text.encode())
    get = lexicon._known.get
    kinds = list(map(get, words))
    if None in kinds:
        kinds = list(map(lexicon.look_up, words))
    hits = np.flatnonzero(np.array(kinds, np.int8)) if any(kinds) else np.zeros(0, np.int64)
    if not len(hits):
        return features
    values = np.array(kinds, np.int8)[hits]
    quoted = np.zeros(len(hits), bool)
    if '"' in text:
        quoted = is_quoted(text, np.array([match.start() for match in _WORD.finditer(text)])[hits])
    crowd = np.searchsorted(hits, hits + CONTEXT, "right") - np.searchsorted(hits, hits - CONTEXT) - 1
    exact, near = values == 1, values == 2
    features[:] = (
        1.0, math.log1p((exact & ~quoted).sum()), math.log1p((near & ~quoted).sum()), math.log1p(quoted.sum()),
        math.log1p(crowd[~quoted].sum()), exact.any(), math.sqrt(len(hits) / len(words)),
    )
    return features


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(batch: pa.RecordBatch) -> Iterator[list]:
    """Distinct terms of each text with its label; counts are combined within the batch."""
    counts: dict[str, list[int]] = {}
    low, high = STEM_LETTERS
    for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
        found: set[str] = set()
        for word in set(words_of(plain_marks(text).encode())):
            letters = word.decode()
            found.add(letters)
            found.update(letters[:size] + "*" for size in range(low, min(high, len(letters)) + 1))
        for term in found:
            counts.setdefault(term, [0, 0])[label] += 1
    yield [list(counts), [pair[0] for pair in counts.values()], [pair[1] for pair in counts.values()]]


def learn_lexicon(labelled: DataFrame) -> list[str]:
    """Terms of the toxic texts among `text` with `label` 0 or 1; shortest beginnings first."""
    totals = {label: count for label, count in labelled.groupBy("label").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return []
    counted = map_batches(labelled.select("text", "label"), "term string, clean long, toxic long", _terms)
    counted = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    base = toxic / (clean + toxic)
    share = F.col("toxic") / (F.col("clean") + F.col("toxic"))
    gain = F.col("toxic") * F.log(share / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base)),
    ).otherwise(0.0)
    frequent = counted.filter(F.col("toxic") >= 3).withColumn("gain", gain)
    # By chance alone one of so many candidates would reach the logarithm of their number.
    candidates = counted.filter(F.col("clean") + F.col("toxic") >= 3).count()
    found = (
        frequent.filter((share >= 0.8) & (F.col("gain") > math.log(max(2, candidates)))).select("term").collect()
    )  # terms of a bounded sample
    kept: set[str] = set()
    for term in sorted((row["term"] for row in found), key=lambda term: (len(term), term)):
        letters = term.removesuffix("*")
        if not any(letters[:size] + "*" in kept for size in range(1, len(letters) + 1)):
            kept.add(term)
    return sorted(kept)


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and intercept by Newton steps."""
    design = np.c_[features, np.ones(len(features))]
    weights = np.zeros(design.shape[1])
    penalty = np.full(len(weights), ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (chance - labels) + penalty * weights
        curve = (design * (chance * (1 - chance))[:, None]).T @ design + np.diag(penalty) + 1e-9 * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return weights


_lexicons: dict[tuple[str, ...], Lexicon] = {}


def _lexicon(terms: tuple[str, ...]) -> Lexicon:
    """The automaton of a worker, kept between batches."""
    if terms not in _lexicons:
        _lexicons.clear()
        _lexicons[terms] = Lexicon(list(terms))
    return _lexicons[terms]


def _featured(batch: pa.RecordBatch, terms: tuple[str, ...]) -> Iterator[list]:
    lexicon = _lexicon(terms)
    features = [text_features(text, lexicon).tolist() for text in batch.column("text").to_pylist()]
    yield [batch.column("label"), features]


def _scored(batch: pa.RecordBatch, terms: tuple[str, ...], weights: np.ndarray | None) -> Iterator[list]:
    lexicon = _lexicon(terms)
    if weights is None:
        scores = [0.0] * batch.num_rows
    else:
        features = np.array([text_features(text, lexicon) for text in batch.column("text").to_pylist()]).reshape(-1, _FEATURES)
        scores = 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))
    yield [batch.column("doc_id"), scores]


def is_held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: Column, sample: int) -> DataFrame:
    """text and label of at most `sample` documents that may be learned from.

    Labels of one doc_id count once (the largest); a doc_id stands for one of its documents.
    """
    chosen = (
        labels.select(F.col("doc_id"), label.alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .filter(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # At most `sample` rows of two numbers.
    joined = documents.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    return joined.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label"))


def toxicity_scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    frame = only(documents, doc_id="long", text="string")
    marks = only(labels, doc_id="long", toxic="int")
    folder = scratch_path(documents.sparkSession, "toxicity")
    labelled_sample(frame, marks, F.when(F.col("toxic").isin(0, 1), F.col("toxic")), sample).write.parquet(folder)
    labelled = documents.sparkSession.read.schema("doc_id long, text string, label int").parquet(folder)
    terms = tuple(learn_lexicon(labelled))
    featured = map_batches(labelled.select("text", "label"), "label int, features array<double>", _featured, terms)
    rows = featured.collect()  # at most `sample` rows of a few numbers
    known = np.array([row["label"] for row in rows], float)
    weights = None
    if len(rows):
        weights = fit_logistic(np.array([row["features"] for row in rows]).reshape(-1, _FEATURES), known)
    scored = map_batches(frame, "doc_id long, score double", _scored, terms, weights)
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"),
    )
