"""Quotation and stems in toxicity features."""

from __future__ import annotations

import random

import numpy as np
import pytest

from eddyline.llm import toxicity

EXACT, NEAR, QUOTED = 1, 2, 3


@pytest.fixture(scope="module")
def lexicon():
    return toxicity.Lexicon(["idiot", "moro*"])


@pytest.mark.parametrize(
    "text, exact, quoted",
    [
        ("you idiot", 1, 0),
        ("he said \"you idiot\" to me", 0, 1),
        ("he said “you idiot” to me", 0, 1),
        ("er sagte „idiot“ zu mir", 0, 1),
        ("il dit «idiot» hier", 0, 1),
        ("“Idiot!”", 0, 1),
        ("(“idiot”)", 0, 1),
        ("5\" pipe. you idiot idiot", 2, 0),
        ("5\" pipe and 6\" pipe, you idiot", 1, 0),
        ("an open \"mark only. you idiot", 1, 0),
        ("\"quoted idiot\" and plain idiot", 1, 1),
        ("line \"one\nidiot\" two", 1, 0),
        ("‘idiot’ you", 1, 0),
        ("don’t, idiot", 1, 0),
        ("", 0, 0),
        (None, 0, 0),
    ],
)
def test_quotation_is_told_from_abuse(lexicon, text, exact, quoted):
    features = toxicity.text_features(text, lexicon)
    assert round(np.expm1(features[EXACT])) == exact and round(np.expm1(features[QUOTED])) == quoted


def test_abuse_and_quotation_score_differently(spark):
    """What a quotation is worth is learned from the labels."""
    pick, rows, labels = random.Random(4), [], []
    plain = ["river", "table", "evening", "market", "garden", "window"]
    for number in range(900):
        filler = " ".join(pick.choices(plain, k=12))
        kind = number % 3
        text = [filler, f"you are an idiot and a moron {filler}", f"they wrote “you idiot” about {filler}"][kind]
        rows.append((number, text))
        labels.append((number, int(kind == 1)))
    found = toxicity.toxicity_scores(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"),
    )
    scores = {row["doc_id"]: (row["score"], row["predicted"]) for row in found.collect()}
    assert all(scores[number][1] == int(number % 3 == 1) for number in range(900))


def test_stems_fit_words_that_begin_with_them(lexicon):
    assert [lexicon.look_up(word) for word in (b"moro", b"moronic", b"mor", b"amoro", b"idiots", b"idiotics")] == [1, 1, 0, 0, 2, 0]
