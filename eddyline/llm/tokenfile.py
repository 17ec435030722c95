"""Token files: flat unsigned integers, 64-bit document offsets, read by memory mapping.

A written corpus is a folder with, for every part,

* `part-00000.tokens`: the ids of its documents, little-endian, of the smallest of 16 and 32
  bits that holds the vocabulary;
* `part-00000.offsets`: for each of its documents, and for its end, the number of ids before
  it in the whole corpus, as little-endian unsigned 64-bit integers;

and the table `manifest` with part, row, doc_id and n_tokens of every document. Documents are
dealt to parts by ranges of doc_id, so parts follow each other in ascending doc_id order (null
first; rows of one doc_id follow a hash of their text). A part is encoded and written by one
task in one stream. The parts' bases are the prefix sums of their id counts; a second pass adds
them to the offsets. A file is written under a name of its own and then renamed, so that a
task which runs again, or twice, leaves the same file.

Null texts are empty and have the end id alone. An empty table has no parts.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.batches import arrow_schema, map_batches, only

#: Distinct chunks of text, and distinct words, a worker remembers before it starts anew.
REMEMBERED = 300_000
REMEMBERED_WORDS = 800_000

#: Pre-tokenizer pattern of word-level files that drop white space (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_OFFSET = np.dtype("<u8")


#: A chunk of letters up to U+00FF, then maybe ASCII punctuation: two pre-tokens at most, whatever follows.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level files write each byte, for `str.translate` of Latin-1 text."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [byte for byte in range(256) if byte not in same]
    return {**{byte: chr(byte) for byte in same}, **{byte: chr(256 + place) for place, byte in enumerate(other)}}


class Remembered(dict):
    """What `work` gives for each key it was asked for; starts anew beyond `most` keys."""

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key):
        value = self.work(key)
        if len(self) > self.most:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """A file of the tokenizers library, with the ids of known chunks of text remembered.

    Where words never reach across white space and white space has no ids, a text is encoded
    chunk by chunk; files of other kinds are given whole texts. Words of plain letters go to the
    library's model past its normalizer and pre-tokenizer, which take longer than the model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = self.library.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        steps = (described.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        first = steps[0]
        self.chunked = (
            first.get("type") == "Split" and first["pattern"].get("Regex") == WORDS
            and first["behavior"] == "Removed" and first["invert"]
            and not any(token["lstrip"] or token["rstrip"] or " " in token["content"] for token in described["added_tokens"])
        )
        normalizers = (described.get("normalizer") or {}).get("normalizers", [])
        self.plain = (
            [step.get("type") for step in steps[1:]] == ["ByteLevel"] and not steps[1]["add_prefix_space"]
            and [step["type"] for step in normalizers] == ["NFC", "Replace", "Lowercase"]
            and normalizers[1]["pattern"] == {"Regex": r"\s+"} and normalizers[1]["content"] == " "
            and all("<|" in token["content"] for token in described["added_tokens"])
        )
        self.model = self.library.model
        self._bytes = [np.array([number], self.kind).tobytes() for number in range(size)]
        self._byte_letters = _byte_letters()
        self._chunks = Remembered(self._chunk, REMEMBERED)
        self._words = Remembered(self._word, REMEMBERED_WORDS)

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _word(self, word: bytes) -> bytes:
        if self.plain and (match := _PLAIN.fullmatch(word)) and not match[2]:
            # Composed letters, one pre-token; in lower case and by bytes as the model has them.
            letters = word.decode().lower()
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(self._byte_letters)
            return b"".join([self._bytes[token.id] for token in self.model.tokenize(letters)])
        return self._library(word.decode())

    def _chunk(self, chunk: bytes) -> bytes:
        if self.plain and (match := _PLAIN.fullmatch(chunk)) and b"<|" not in chunk:
            letters, rest = match.groups()
            ids = self._words[letters.lower()]
            return ids + self._words[rest] if rest else ids
        return self._words[chunk]

    def encode(self, text: str) -> bytes:
        if not self.chunked:
            return self._library(text)
        return b"".join(map(self._chunks.__getitem__, text.encode().split()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _publish(files: pafs.FileSystem, temporary: str, path: str) -> None:
    """Give a finished file its name; if another attempt was first, its file is the same."""
    if files.get_file_info(path).type == pafs.FileType.NotFound:
        files.move(temporary, path)
    else:
        files.delete_file(temporary)


def _part(root: str, part: int, what: str) -> str:
    return f"{root}/part-{part:05d}.{what}"


def _writer(folder: str, tokenizer: str, end: int):
    """Function for mapInArrow that writes a partition's documents as one part."""
    schema = arrow_schema("part int, row long, doc_id long, n_tokens long")

    def write(batches):
        coder = encoder(tokenizer)
        files, root = _filesystem(folder)
        part, row, attempt = TaskContext.get().partitionId(), 0, uuid.uuid4().hex
        names = {what: f"{_part(root, part, what)}.{attempt}" for what in ("tokens", "offsets")}
        closing = np.array([end], coder.kind).tobytes()
        counts: list[int] = []
        with files.open_output_stream(names["tokens"]) as tokens:
            for batch in batches:
                lengths = []
                for text in batch.column("text").to_pylist():
                    ids = coder.encode(text or "") + closing
                    tokens.write(ids)
                    lengths.append(len(ids) // coder.kind.itemsize)
                counts += lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(lengths), pa.int32()),
                        pa.array(range(row, row + len(lengths)), pa.int64()),
                        batch.column("doc_id"), pa.array(lengths, pa.int64()),
                    ],
                    schema=schema,
                )
                row += len(lengths)
        local = np.zeros(len(counts) + 1, _OFFSET)
        np.cumsum(np.array(counts, _OFFSET), out=local[1:])
        with files.open_output_stream(names["offsets"]) as offsets:
            offsets.write(local.tobytes())
        _publish(files, names["tokens"], _part(root, part, "tokens"))
        _publish(files, names["offsets"], _part(root, part, "local"))

    return write


def _add_base(batch: pa.RecordBatch, folder: str) -> Iterator[list]:
    files, root = _filesystem(folder)
    for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist(), strict=True):
        with files.open_input_file(_part(root, part, "local")) as file:
            local = np.frombuffer(file.read(), _OFFSET)
        temporary = f"{_part(root, part, 'offsets')}.{uuid.uuid4().hex}"
        with files.open_output_stream(temporary) as out:
            out.write((local + _OFFSET.type(base)).tobytes())
        _publish(files, temporary, _part(root, part, "offsets"))
    yield [batch.column("part")]


def write_tokens(documents: DataFrame, tokenizer: str, folder: str, end: int) -> DataFrame:
    """Write the documents' ids, each document closed by the id `end`, and return the manifest."""
    spark = documents.sparkSession
    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        only(documents, doc_id="long", text="string")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    schema = "part int, row long, doc_id long, n_tokens long"
    ordered.mapInArrow(_writer(folder, tokenizer, end), schema).write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(schema).parquet(f"{folder}/manifest")
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("total")).orderBy("part").collect()
    bases, base = [], 0
    for part, total in totals:
        bases.append((part, base))
        base += total
    if bases:
        based = spark.createDataFrame(bases, "part int, base long").repartition(len(bases))
        map_batches(based, "part int", _add_base, folder).count()
    return manifest


def _mapped(files: pafs.FileSystem, path: str, kind: np.dtype) -> np.ndarray:
    """A file as an array: mapped where the folder is mounted, else read."""
    if isinstance(files, pafs.LocalFileSystem):
        if files.get_file_info(path).size == 0:
            return np.zeros(0, kind)
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def open_part(folder: str, part: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of a part."""
    files, root = _filesystem(folder)
    return _mapped(files, _part(root, part, "tokens"), kind), _mapped(files, _part(root, part, "offsets"), _OFFSET)


def _read(batch: pa.RecordBatch, folder: str, tokenizer: str) -> Iterator[list]:
    kind = encoder(tokenizer).kind
    open_number, starts, sizes, sums = None, [], [], []
    for part, row in zip(batch.column("part").to_pylist(), batch.column("row").to_pylist(), strict=True):
        if part != open_number:
            open_number = part
            tokens, offsets = open_part(folder, part, kind)
        first, past = int(offsets[row]), int(offsets[row + 1])
        base = int(offsets[0])
        ids = tokens[first - base:past - base]
        starts.append(first)
        sizes.append(past - first)
        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
    yield [batch.column("doc_id"), starts, sizes, sums]


def read_digests(manifest: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    rows = manifest.select("part", "row", "doc_id")
    return map_batches(rows, "doc_id long, start long, n_tokens long, ids_crc32 long", _read, folder, tokenizer)


def read_ids(spark: SparkSession, folder: str, tokenizer: str) -> DataFrame:
    """doc_id and ids of every document, from the files."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("part", "row", "doc_id")

    def read(batch: pa.RecordBatch) -> Iterator[list]:
        kind = encoder(tokenizer).kind
        ids = []
        for part, row in zip(batch.column("part").to_pylist(), batch.column("row").to_pylist(), strict=True):
            tokens, offsets = open_part(folder, part, kind)
            ids.append(tokens[int(offsets[row] - offsets[0]):int(offsets[row + 1] - offsets[0])].tolist())
        yield [batch.column("doc_id"), ids]

    return map_batches(manifest, "doc_id long, ids array<long>", read)
