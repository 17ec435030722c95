"""Repeated passages in many different documents."""

from __future__ import annotations

import functools
import hashlib
import random
from collections import Counter

import pytest

repeats = pytest.importorskip("eddyline.llm.repeats")


def _texts(count):
    """Different texts around one passage that all of them have."""
    pick = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(pick.choices(letters, k=260))
    return [
        "".join(pick.choices(letters, k=pick.randrange(220, 260))) + passage + "".join(pick.choices(letters, k=230))
        for _ in range(count)
    ]


def _brute_force(texts, length):
    starts = Counter(text[at:at + length] for text in texts for at in range(len(text) - length + 1))
    found = {}
    for number, text in enumerate(texts):
        gone = set()
        for at in range(len(text) - length + 1):
            if starts[text[at:at + length]] > 1:
                gone.update(range(at, at + length))
        kept = "".join(letter for at, letter in enumerate(text) if at not in gone)
        found[number] = (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def test_a_passage_of_some_hundred_documents_is_merged_and_not_expanded(spark, tmp_path, monkeypatch):
    texts = _texts(400)
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(repeats, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = repeats.repeat_digests(documents).collect()
    assert {row.doc_id: (row.n_removed, row.kept_sha256) for row in rows} == _brute_force(texts, 200)
    pieces = spark.read.parquet(f"{tmp_path}/repeats/pieces")
    assert pieces.count() > 400 and pieces.filter("hot").count() == 0


def test_merged_and_counted_buckets_agree(spark, tmp_path):
    documents = spark.createDataFrame([(text,) for text in _texts(60)], "text string")
    found = []
    for most in (16, 4096):
        distinct = repeats.distinct_texts(documents, f"{tmp_path}/{most}")
        spans = repeats.repeated_spans(distinct, f"{tmp_path}/{most}", most_anchors=most).collect()
        found.append({(row.h, row.g): row.spans for row in spans})
    assert len(found[0]) == 60 and found[0] == found[1]


def test_equal_pieces_of_ordinary_buckets_are_settled_by_digest(spark, tmp_path, monkeypatch):
    """Copies of a passage used to be compared by their text unless the bucket was a large one."""
    texts = _texts(2)
    texts = [f"{texts[0]}{number:05d}" for number in range(40)] + [texts[1]]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(repeats, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = repeats.repeat_digests(documents).collect()
    assert {row.doc_id: (row.n_removed, row.kept_sha256) for row in rows} == _brute_force(texts, 200)
    pieces = spark.read.parquet(f"{tmp_path}/repeats/pieces")
    assert pieces.filter("hot").count() == 0
    assert pieces.filter("piece IS NULL").count() > pieces.count() / 2


def test_a_phrase_that_one_text_repeats_is_one_piece_of_it(spark, tmp_path, monkeypatch):
    """Every place of the phrase used to be a row of its own, of the pieces and of a join."""
    texts = [f"{number:05d}" + "and so on, " * 300 + f"{number:05d}" for number in range(6)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(repeats, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = repeats.repeat_digests(documents).collect()
    assert {row.doc_id: (row.n_removed, row.kept_sha256) for row in rows} == _brute_force(texts, 200)
    pieces = spark.read.parquet(f"{tmp_path}/repeats/pieces")
    assert pieces.count() < 60 and pieces.filter("size(ranges) > 0").count() >= 6


def test_only_suffixes_of_some_parts_of_a_hot_bucket_become_rows(spark, tmp_path):
    """All of them used to, with and without a repeated core: here a line that is too short to go."""
    pick = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz "
    line = "".join(pick.choices(letters, k=180))
    texts = ["".join(pick.choices(letters, k=230)) + line + "".join(pick.choices(letters, k=230)) for _ in range(80)]
    documents = spark.createDataFrame([(text,) for text in texts], "text string")
    distinct = repeats.distinct_texts(documents, f"{tmp_path}")
    assert repeats.repeated_spans(distinct, f"{tmp_path}", most_anchors=16).count() == 0
    assert spark.read.parquet(f"{tmp_path}/pieces").filter("hot AND piece IS NOT NULL").count() > 40
    assert spark.read.parquet(f"{tmp_path}/parts").count() == 0


@pytest.mark.parametrize("most_anchors", [2, 4096])
@pytest.mark.parametrize("length,gram", [(200, 32), (20, 20), (9, 1)])
def test_near_copies_lose_what_they_share(spark, tmp_path, monkeypatch, most_anchors, length, gram):
    pick = random.Random(length)
    text = "".join(pick.choices("abc ", k=700)) + "so on " * 60
    texts = ["", text, text + "x"]
    for number in range(40):
        letters = list(text[pick.randrange(300):pick.randrange(400, len(text))])
        for _ in range(pick.randrange(4)):
            letters[pick.randrange(len(letters))] = str(number)
        texts.append("".join(letters))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(repeats, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(repeats, "repeated_spans", functools.partial(repeats.repeated_spans, gram=gram, most_anchors=most_anchors))
    rows = repeats.repeat_digests(documents, length).collect()
    assert {row.doc_id: (row.n_removed, row.kept_sha256) for row in rows} == _brute_force(texts, length)
