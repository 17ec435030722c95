"""Token ids of whole batches: every distinct word of a batch is looked up once.

Texts are cut at white space and a closing punctuation mark is cut from the letter before it;
where the tokenizer drops white space and keeps words within it, neither changes the ids.
Distinct pieces are found by Arrow, only theirs are looked up or encoded, and the ids of the
texts are gathered from them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from eddyline.llm.batches import slices, spread
from eddyline.llm.bpe import byte_letters
from eddyline.llm.tokenfile import encoder

#: Text bytes that one step takes at a time.
TEXT_BYTES = 2 << 20

#: Distinct words a worker remembers before it starts anew.
REMEMBERED = 500_000

#: Letters before this one are neither composed nor lower-cased in more than one way; the
#: dotted capital I is the exception.
_PLAIN_LETTERS, _DOTTED = "ɐ", "İ"


def gathered(parts: list[bytes], chosen: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The chosen parts one after the other, and the number of items of each."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // kind.itemsize
    starts = np.cumsum(lengths) - lengths
    flat = np.frombuffer(b"".join(parts), kind)
    taken = lengths[chosen]
    return flat[spread(starts[chosen], taken)], taken


class Words:
    """The ids of words of a file of the tokenizers library."""

    def __init__(self, path: str):
        self.coder = encoder(path)
        self.kind = self.coder.kind
        self.known: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        normalizer, splitter = ((described.get(name) or {}) for name in ("normalizer", "pre_tokenizer"))
        # Only what these steps do to a word of plain letters is known here.
        self.direct = (
            [step["type"] for step in normalizer.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [step["type"] for step in splitter.get("pretokenizers", [])] == ["Split", "ByteLevel"]
        )
        self.letters = {byte: letter for letter, byte in byte_letters().items()}

    def _encode(self, word: str) -> bytes:
        if self.direct and word.isalpha() and max(word) < _PLAIN_LETTERS and _DOTTED not in word:
            # The normalizer changes the case of such a word alone, the pre-tokenizer keeps it
            # whole and writes its bytes as letters.
            spelled = word.lower().encode().decode("latin-1").translate(self.letters)
            return np.array([token.id for token in self.coder.model.tokenize(spelled)], self.kind).tobytes()
        return self.coder.encode(word)

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, as array bytes."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        ids = list(map(known.get, words))
        if None in ids:
            for place, word in enumerate(words):
                if ids[place] is None:
                    ids[place] = known[word] = self._encode(word)
        return ids


def _distinct(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    coded = values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def _chunked(texts: pa.Array, words: Words, end: bytes) -> tuple[np.ndarray, np.ndarray]:
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    bounds = split.offsets.to_numpy()
    chunks, chosen = _distinct(split.values.slice(bounds[0], bounds[-1] - bounds[0]))
    # What looks like an added token is left as it is.
    added = pc.match_substring(chunks, "<|")
    chunks = pc.if_else(added, chunks, pc.ascii_lower(chunks))
    closed = pc.and_not(pc.match_substring_regex(chunks, r"\p{L}[!-/:-@\[-`{-~]$"), added)
    heads = pc.if_else(closed, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
    marks = pc.if_else(closed, pc.utf8_slice_codeunits(chunks, -1), "")
    distinct, index = _distinct(pa.concat_arrays([heads, marks.cast(heads.type)]))
    ids = [*words.look_up(distinct.to_pylist()), end]
    # Per chunk its head and its mark, and per text one more part, its end.
    both = np.stack([index[:len(chunks)][chosen], index[len(chunks):][chosen]], axis=1).ravel()
    past = 2 * (bounds[1:] - bounds[0])
    found, lengths = gathered(ids, np.insert(both, past, len(distinct)), words.kind)
    return found, np.diff(np.cumsum(lengths)[past + np.arange(len(texts))], prepend=0)


@lru_cache(maxsize=2)
def word_table(path: str) -> Words:
    """The words of a file, once per worker."""
    return Words(path)


def encoded_texts(texts: pa.Array, words: Words, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of the texts, each closed by the id `end`, and each text's number of ids, slice by slice."""
    texts = pc.fill_null(texts, "")
    closing = np.array([end], words.kind).tobytes()
    for start, past in slices(pc.binary_length(texts).to_numpy(), TEXT_BYTES):
        some = texts.slice(start, past - start)
        if words.coder.chunked:
            yield _chunked(some, words, closing)
        else:
            parts = [words.coder.encode(text) + closing for text in some.to_pylist()]
            yield gathered(parts, np.arange(len(parts)), words.kind)
