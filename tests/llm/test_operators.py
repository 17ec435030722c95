"""The training-data operators against brute force, libraries, SQL and held-out labels."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from eddyline.llm import bpe, decontaminate, knn, neardup, quality, repeats, sharding, tokenfile, toxicity, urls
from eddyline.llm.queries import BYTE_BPE, ORACLES, QUERIES, URL_RULES, WORD_BPE, table
from eddyline.llm.words import words_of
from eddyline.session import scratch_path
from tests.oracle import check, connect

LONG = " ".join(random.Random(1).choice(["alpha", "beta", "gamma", "delta", "Éps"]) for _ in range(30_000))
SHARED = " ".join(f"shared{number}" for number in range(60))

#: Null, empty, blank, very long and repeated texts, null and repeated ids.
ODD_ROWS = [
    (1, None), (2, ""), (None, None), (3, " \n\t "), (4, "Hi"), (4, "Hi"), (None, "Hi"),
    (5, "Ünï cødé 漢字 🙂 it's <|endoftext|> " * 40), (6, LONG), (7, LONG), (8, "before " + SHARED + " after"),
    (9, SHARED + " end"), (10, "one two three four five six seven eight nine ten eleven"), (11, "ab" * 500),
]
ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "h long, key string, row string, node long, TEXT string"
)


@pytest.fixture(scope="module")
def documents(spark, data):
    return table(spark, data, "documents")


@pytest.fixture(scope="module")
def labels(spark, data):
    return table(spark, data, "labels")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (doc_id, text, None, "web", None if text is None else len(text), 7, "k", "r", 1, "other")
        for doc_id, text in ODD_ROWS
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def values_of(frame, *columns):
    """Columns told by their exact names, which Spark does not do where names clash."""
    places = [frame.columns.index(name) for name in columns]
    return [tuple(row[place] for place in places) for row in frame.collect()]


def id_texts(frame):
    return [(doc_id, text or "") for doc_id, text in values_of(frame, "doc_id", "text")]


def rows_of(frame, *columns):
    return Counter(values_of(frame, *columns))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# --- 1 ---------------------------------------------------------------------------------------------


def test_top_k_equals_sql(spark, data):
    check(QUERIES["op1_voronoi_top_k"](spark, data), connect(data), ORACLES["op1_voronoi_top_k"])


def test_top_k_of_odd_vectors(spark):
    rows = [
        (100, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, [-1.0, 0.5]), (None, [9.0, 9.0]),
    ]
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "vec_id long, embedding array<float>, cell long, score string")
    found = knn.top_k(frame, F.col("vec_id") % 100 == 0)
    same = 1024 * 1024 + 2048 * 2048
    assert sorted(tuple(row) for row in found.select("query_id", "rank", "vec_id", "score").collect()) == [
        (100, 1, 1, same), (100, 2, 2, same), (100, 3, 7, 0),
    ]
    assert knn.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_of_very_large_numbers(spark):
    """Beyond the range of a long, scores are cut off; ids break the ties."""
    rows = [(100, [1e306, 1.0]), (1, [1e306, 0.0]), (2, [2e306, 5.0]), (3, [-1e306, 0.0]), (4, [0.0, 3.0]), (5, [3e15, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = knn.top_k(frame, F.col("vec_id") == 100).orderBy("rank").collect()
    most = (1 << 63) - 1
    assert [(row["vec_id"], row["score"]) for row in found] == [
        (1, most), (2, most), (5, most), (4, 3 * 1024 * 1024), (3, -most - 1),
    ]


def test_top_k_in_many_small_blocks(spark):
    draw = np.random.default_rng(5)
    vectors = np.r_[draw.normal(size=(600, 8)), np.repeat(draw.normal(size=(1, 8)), 200, axis=0)]
    frame = spark.createDataFrame(
        [(number, vector.tolist()) for number, vector in enumerate(vectors)], "vec_id long, embedding array<double>",
    )
    whole = np.floor(vectors * 1024).astype(np.int64)
    expected = set()
    for query in range(0, 800, 100):
        scores = whole @ whole[query]
        order = [number for number in np.lexsort((np.arange(800), -scores)) if number != query][:10]
        expected |= {(query, rank + 1, int(number), int(scores[number])) for rank, number in enumerate(order)}
    found = knn.top_k(frame, F.col("vec_id") % 100 == 0, cell_rows=40, group_rows=3)
    assert {tuple(row) for row in found.select("query_id", "rank", "vec_id", "score").collect()} == expected


# --- 2 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_token_files_hold_the_library_ids(spark, which, request):
    frame = request.getfixturevalue(which)
    folder = scratch_path(spark, "tokens")
    manifest = tokenfile.write_tokens(frame, WORD_BPE, folder, end=1)
    library = Tokenizer.from_file(WORD_BPE)
    expected, lengths = Counter(), []
    for doc_id, text in id_texts(frame):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        expected[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        lengths.append(len(ids))
    digests = tokenfile.read_digests(manifest, folder, WORD_BPE)
    assert rows_of(digests, "doc_id", "n_tokens", "ids_crc32") == expected
    place = 0
    ordered = sorted(digests.collect(), key=lambda row: row["start"])
    for row in ordered:
        assert row["start"] == place
        place += row["n_tokens"]
    ids = [row["doc_id"] for row in ordered]
    assert ids == sorted(ids, key=lambda doc_id: (doc_id is not None, doc_id or 0))
    assert place == sum(lengths)


def test_token_files_of_no_documents(spark, none):
    folder = scratch_path(spark, "tokens")
    assert tokenfile.read_digests(tokenfile.write_tokens(none, WORD_BPE, folder, end=1), folder, WORD_BPE).count() == 0


# --- 3 and 9 ---------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op3_levenshtein_toxicity"](spark, folder).join(table(spark, folder, "labels"), "doc_id")
    rows = found.filter("held_out").select("toxic", "predicted", "score").collect()
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.7) for row in rows)
    counts = Counter((row.toxic, row.predicted) for row in rows)
    assert counts[1, 1] >= 0.85 * (counts[1, 0] + counts[1, 1])
    assert counts[0, 1] <= 0.02 * (counts[0, 0] + counts[0, 1])


def test_levenshtein_automaton_finds_one_edit():
    terms = ["grumble", "vexation", "odd"]
    lexicon = toxicity.Lexicon(terms)

    def distance(left, right):
        row = list(range(len(right) + 1))
        for place, letter in enumerate(left, 1):
            row, above = [place], row
            for other, sign in enumerate(right, 1):
                row.append(min(row[-1] + 1, above[other] + 1, above[other - 1] + (letter != sign)))
        return row[-1]

    for word in ("grumble", "grumbel", "grimble", "grmble", "grumbble", "vexatiom", "odd", "order", "gru", ""):
        near = any(distance(word, term) <= 1 for term in terms if len(term) >= toxicity.FUZZY_LETTERS)
        hit = lexicon.look_up(word.encode()) != 0
        assert hit == (near or word in terms), word
    assert lexicon.look_up(b"grumble") == 1 and lexicon.look_up(b"grumbel") == 0 and lexicon.look_up(b"grimble") == 2


def test_toxicity_of_odd_texts(odd, none, labels):
    rows = toxicity.toxicity_scores(odd, labels).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(0 <= row.score <= 1 for row in rows)
    assert toxicity.toxicity_scores(none, labels).count() == 0
    assert {row.score for row in toxicity.toxicity_scores(odd, labels.limit(0)).collect()} == {0.0}


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op9_ordinal_quality"](spark, folder).join(table(spark, folder, "labels"), "doc_id")
    rows = found.filter(toxicity.is_held_out(F.col("doc_id"))).select("quality", "selected").collect()
    right = sum(row.quality == int(row.selected) for row in rows)
    assert len(rows) > 500 and right >= 0.95 * len(rows)


def test_quality_of_odd_texts(odd, none, labels):
    scores = quality.quality_scores(odd, labels).collect()
    assert len(scores) == len(ODD_ROWS)
    kept = quality.select_quality(odd, labels)
    assert kept.columns == odd.columns
    assert kept.count() == sum(row.selected for row in scores)
    assert quality.select_quality(none, labels).count() == 0
    assert quality.select_quality(odd, labels.limit(0)).count() == len(ODD_ROWS)


def test_ordinal_thresholds_ascend():
    draw = np.random.default_rng(2)
    grades = draw.integers(0, 3, 300)
    model = quality.fit_ordinal(np.arange(300), grades.astype(np.int64), np.ones(300), grades)
    expected, tail = model.judge(np.array([-9.0, 0.0, 9.0]), 1)
    assert list(expected) == sorted(expected) and list(tail) == sorted(tail)


# --- 4 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_bpe_equals_the_library(which, request):
    frame = request.getfixturevalue(which)
    library = Tokenizer.from_file(BYTE_BPE)
    library.no_truncation()
    library.no_padding()
    expected = Counter()
    for doc_id, text in id_texts(frame):
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected[doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(back.encode())] += 1
    found = bpe.encoding_digests(frame, BYTE_BPE)
    assert rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def test_bpe_of_random_characters():
    draw = random.Random(3)
    letters = "aAbB's dDtT0 9é漢🙂\x1c\x85\xa0\n\t\r <|>_.,!İß"
    library, own = Tokenizer.from_file(BYTE_BPE), bpe.codec(BYTE_BPE)
    for _ in range(1500):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(50)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text)[0].tolist() == ids, repr(text)
        assert own.decode(np.array(ids, np.int32)).decode(errors="replace") == library.decode(ids, skip_special_tokens=False)


def test_bpe_of_no_documents(none):
    assert bpe.encoding_digests(none, BYTE_BPE).count() == 0


# --- 5 ---------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected_hits(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        found = words(text)
        size = min(10, len(found))
        for place in range(len(found) - size + 1 if size else 0):
            windows[tuple(found[place:place + size])].add("null" if item is None else str(item))
    expected = Counter()
    for doc_id, text in texts:
        found, hit, named = words(text), set(), set()
        for size in {len(window) for window in windows}:
            for place in range(len(found) - size + 1):
                items_here = windows.get(tuple(found[place:place + size]))
                if items_here:
                    hit.update(range(place, place + size))
                    named |= items_here
        digest = sha(",".join(sorted(named)).encode())
        expected[doc_id, len(found), len(hit), len(named), digest, bool(hit)] += 1
    return expected


HIT_COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_contamination_equals_brute_force(spark, data, which, request):
    frame = request.getfixturevalue(which)
    known = table(spark, data, "benchmark")
    columns = [name for name in known.columns if name in ("item_id", "text")]
    known = known.select(*columns)
    extra = spark.createDataFrame([(900, "alpha BETA"), (901, ""), (902, None), (903, "hi"), (904, SHARED)], known.schema)
    items = known.union(extra)
    found = decontaminate.contamination(frame, items.withColumn("n_words", F.lit("x")))
    assert rows_of(found, *HIT_COLUMNS) == expected_hits(id_texts(frame), [tuple(row) for row in items.collect()])


def test_phrases_go_out_of_texts(odd, none, spark):
    items = spark.createDataFrame([(1, SHARED), (2, None)], "item_id long, text string")
    cut = decontaminate.remove_phrases(odd, items)
    assert cut.columns == odd.columns and cut.count() == len(ODD_ROWS)
    assert decontaminate.contamination(cut, items).filter("contaminated").count() == 0
    untouched = odd.filter("doc_id IS NULL OR doc_id NOT IN (8, 9)")
    left = cut.filter("doc_id IS NULL OR doc_id NOT IN (8, 9)")
    assert rows_of(left, "doc_id", "text", "n_chars") == rows_of(untouched, "doc_id", "text", "n_chars")
    assert decontaminate.remove_phrases(none, items).count() == 0
    assert rows_of(decontaminate.remove_phrases(odd, items.limit(0)), "doc_id", "text") == rows_of(odd, "doc_id", "text")


# --- 6 ---------------------------------------------------------------------------------------------


def test_urls_equal_sql(spark, data):
    check(QUERIES["op6_url_cascade"](spark, data), connect(data), ORACLES["op6_url_cascade"])


def test_odd_urls_and_sharded_cascades(spark):
    rows = [
        (1, None, None), (2, "", None), (3, "no scheme/net/es/", None), (4, "HTTP://X.NET/fr/a?b", ("net/fr/", "block")),
        (5, "http://xnet/fr/", None), (6, "https://net/es/#x", ("net/es/", "block")), (7, "http://net/ES/", None),
        (8, "http://a.www.example.com/en/x", ("www.example.com/en/", "allow")),
        (9, "http://example.com/en/x", ("example.com/en/", "block")), (9, "http://example.com/de", ("com/", "allow")),
        (None, "http://example.com?/en/", None), (11, "http://" + "a" * 50_000 + ".net/fr/", ("net/fr/", "block")),
    ]
    frame = spark.createDataFrame([(*row[:2], "x", 1) for row in rows], "page_id long, url string, key string, host long")
    expected = Counter((row[0], *(row[2] or (None, "allow"))) for row in rows)
    for most_bytes in (16 << 20, 1 << 13):
        found = urls.judge_urls(frame, URL_RULES, most_bytes=most_bytes)
        assert rows_of(found, "page_id", "rule", "verdict") == expected
    assert urls.judge_urls(frame.limit(0), URL_RULES).count() == 0


# --- 7 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_shards_are_even_and_gapless(which, request):
    frame = request.getfixturevalue(which)
    texts = id_texts(frame)
    rows = sharding.shard_documents(frame).collect()
    assert Counter((row.doc_id, row["size"], row.text_crc32) for row in rows) == Counter(
        (doc_id, len(text.encode()) + 1, zlib.crc32(text.encode())) for doc_id, text in texts
    )
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    counts = [len(slots[shard]) for shard in range(8)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts)
    assert all(sorted(taken) == list(range(len(taken))) for taken in slots.values())


def test_linked_documents_share_shards(spark):
    rows = [(number, f"text {number // 4 if number < 400 else number}") for number in range(1000)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    shards = defaultdict(set)
    for row in found.collect():
        if row.doc_id < 400:
            shards[row.doc_id // 4].add(row.shard)
    assert sum(len(there) > 1 for there in shards.values()) <= 10


def test_shards_of_no_documents(none):
    assert sharding.shard_documents(none).count() == 0


# --- 8 ---------------------------------------------------------------------------------------------


def expected_classes(texts):
    """Least doc_id of everyone's class: all pairs of shingle sets, exactly."""
    shingles = []
    for _, text in texts:
        found = words_of(text.encode())
        size = min(5, len(found))
        shingles.append(frozenset(tuple(found[place:place + size]) for place in range(len(found) - size + 1)) if size else text)
    distinct = list(dict.fromkeys(shingles))
    parent = list(range(len(distinct)))

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    holders = defaultdict(list)
    for node, there in enumerate(distinct):
        if isinstance(there, str):
            continue
        shared = Counter(other for shingle in there for other in holders[shingle])
        for shingle in there:
            holders[shingle].append(node)
        for other, count in shared.items():
            if count >= 0.8 * (len(there) + len(distinct[other]) - count):
                parent[root(node)] = root(other)
    numbers = {there: node for node, there in enumerate(distinct)}
    classes = defaultdict(list)
    for (doc_id, _), there in zip(texts, shingles, strict=True):
        classes[root(numbers[there])].append(doc_id)
    return Counter(
        (doc_id, min((known for known in members if known is not None), default=None), len(members))
        for members in classes.values() for doc_id in members
    )


def near_texts():
    draw = random.Random(8)
    base = [f"w{draw.randrange(10_000)}" for _ in range(300)]
    texts = []
    for _ in range(40):
        changed = list(base)
        changed[draw.randrange(300)] = f"x{draw.randrange(1000)}"
        texts.append(" ".join(changed))
    return texts + texts[:20] + [" ".join(f"v{draw.randrange(10_000)}" for _ in range(50)) for _ in range(20)]


@pytest.mark.parametrize("which", ["documents", "odd", "near"])
def test_classes_equal_brute_force(spark, which, request):
    if which == "near":
        frame = spark.createDataFrame(list(enumerate(near_texts())), "doc_id long, text string")
    else:
        frame = request.getfixturevalue(which)
    found = neardup.duplicate_classes(frame)
    assert rows_of(found, "doc_id", "class_id", "class_size") == expected_classes(id_texts(frame))


def test_one_of_each_class_stays(odd, none):
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({row.class_key for row in neardup.duplicate_classes(odd).collect()})
    assert neardup.keep_one(none).count() == 0


# --- 10 --------------------------------------------------------------------------------------------


def covered(texts, length=200):
    starts = Counter(text[place:place + length] for text in texts for place in range(len(text) - length + 1))
    marks = []
    for text in texts:
        mark, past = bytearray(len(text)), 0
        for place in range(len(text) - length + 1):
            if starts[text[place:place + length]] > 1:
                begin = max(place, past)
                past = place + length
                mark[begin:past] = b"\x01" * (past - begin)
        marks.append(mark)
    return marks


def expected_removals(texts):
    data = [text.encode() for _, text in texts]
    expected = Counter()
    for (doc_id, _), text, mark in zip(texts, data, covered(data), strict=True):
        kept = bytes(byte for byte, gone in zip(text, mark, strict=True) if not gone)
        expected[doc_id, len(text), len(text) - len(kept), len(re.findall(b"\x01+", bytes(mark))), sha(kept)] += 1
    return expected


REMOVAL_COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def repeating_texts():
    draw = random.Random(4)
    passage = "".join(draw.choice("abcde é") for _ in range(500))
    texts = ["x" * 1000, "ab" * 400, "abc" * 130, passage, passage + "!", "?" + passage[100:320], passage[:199]]
    for number in range(60):
        own = "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(300)))
        texts.append(own + passage[draw.randrange(200):draw.randrange(300, 500)] + own[::-1] + str(number))
    return texts


@pytest.mark.parametrize("most_anchors", [256, 3])
@pytest.mark.parametrize("which", ["documents", "odd", "repeating"])
def test_removals_equal_brute_force(spark, monkeypatch, which, most_anchors, request):
    if which == "repeating":
        frame = spark.createDataFrame(list(enumerate(repeating_texts())), "doc_id long, text string")
    else:
        frame = request.getfixturevalue(which)
    monkeypatch.setattr(repeats, "repeated_spans", functools.partial(repeats.repeated_spans, most_anchors=most_anchors))
    assert rows_of(repeats.repeat_digests(frame), *REMOVAL_COLUMNS) == expected_removals(id_texts(frame))


def test_removal_keeps_rows_and_columns(odd, none):
    cut = repeats.remove_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == len(ODD_ROWS)
    assert all(text is None or count == len(text) for count, text in values_of(cut, "n_chars", "text"))
    assert repeats.remove_repeats(none).count() == 0 and repeats.repeat_digests(none).count() == 0


# --- pipeline --------------------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, data, documents, labels):
    stages = dict(corpus_pipeline.STAGES)
    selected = {row.doc_id for row in quality.quality_scores(documents, labels).filter("selected").collect()}
    folder = scratch_path(spark, "stages")

    def stage(name, before):
        stages[name](spark, before, data).write.parquet(f"{folder}/{name.replace(' ', '_')}")
        return spark.read.parquet(f"{folder}/{name.replace(' ', '_')}")

    docs = stage("quality classifier", documents)
    assert {row.doc_id for row in docs.collect()} == selected and docs.columns == documents.columns

    before, docs = id_texts(docs), stage("MinHash near-dedup", docs)
    assert {row.doc_id for row in docs.collect()} == {named for _, named, _ in expected_classes(before)}

    before, docs = id_texts(docs), stage("suffix-array dedup", docs)
    expected = {}
    for (doc_id, text), mark in zip(before, covered([text.encode() for _, text in before]), strict=True):
        place, kept = 0, []
        for letter in text:
            past = place + len(letter.encode())
            if not all(mark[place:past]):
                kept.append(letter)
            place = past
        expected[doc_id] = "".join(kept)
    assert dict(id_texts(docs)) == expected

    before, docs = dict(id_texts(docs)), stage("benchmark decontamination", docs)
    benchmark = table(spark, data, "benchmark")
    hit = {row.doc_id for row in decontaminate.contamination(
        spark.createDataFrame(list(before.items()), "doc_id long, text string"), benchmark).filter("contaminated").collect()}
    after = dict(id_texts(docs))
    assert after.keys() == before.keys()
    assert {doc_id for doc_id in before if before[doc_id] != after[doc_id]} == hit
    assert docs.columns == documents.columns

    library = Tokenizer.from_file(BYTE_BPE)
    result = rows_of(corpus_pipeline.run(spark, data), "doc_id", "n_tokens", "ids_sha256")
    assert result == Counter(
        (doc_id, len(ids), sha(",".join(map(str, ids)).encode()))
        for doc_id, text in after.items() for ids in [library.encode(text, add_special_tokens=False).ids]
    )
