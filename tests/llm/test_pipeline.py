"""The pipeline as a whole on odd rows and on no rows."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from eddyline.llm import neardup
from tests.llm.test_operators import LONG, ODD_ROWS

#: Further columns have the names that the operators use for their own.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, h long, key string, row string, node long, salt int, c0 int"


def folder_of(spark, tmp_path, rows, labels=()):
    frame = spark.createDataFrame(
        [(doc_id, text, None, "web", None if text is None else len(text), 7, "k", "r", 1, 3, 5) for doc_id, text in rows], DOCUMENTS,
    )
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(
        [("a", "one two three four five six seven eight nine ten"), ("b", None), ("c", ""), ("a", "one two three four five six seven eight nine ten")],
        "item_id string, text string",
    ).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    folder = folder_of(spark, tmp_path, ODD_ROWS)
    found = [row.asDict() for row in corpus_pipeline.run(spark, folder).collect()]
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    # Without ratings nothing is rejected; of every class one document stays.
    classes = {row["class_key"] for row in neardup.duplicate_classes(documents).collect()}
    assert len(found) == len(classes)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {row["doc_id"]: row for row in found}
    # The long text says one word over and over, so all of it goes as repeated.
    assert len(set(LONG.split())) == 1 and texts[6]["n_tokens"] == 0 and 7 not in texts
    # The benchmark's ten words are cut out of document 10; one of eleven is left.
    left = library.encode(" eleven", add_special_tokens=False).ids
    assert texts[10]["n_tokens"] == len(left)
    assert texts[1]["n_tokens"] == 0 and texts[1]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_no_rows_and_null_rows(spark, tmp_path, rows):
    folder = folder_of(spark, tmp_path, rows, [(1, 1, 0), (None, 0, 1)])
    assert corpus_pipeline.run(spark, folder).count() == len(rows)
