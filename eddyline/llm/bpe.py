"""BPE encoding and decoding with an automaton over tokens.

The merges are compiled one by one. At first one state allows every byte token and
returns to itself. Merge (a, b) -> c takes the state behind `a`, copies it without `b`,
redirects `a` to the copy, and lets `c` lead from wherever `a` leads to where `b` led.
What the finished automaton accepts is exactly the sequences that BPE produces: one for
each byte string.

The finished automaton is a set of arrays, made once on the driver and sent to the tasks: the
state behind every token, the tokens that a state lost and when, and a byte trie of the tokens.
A state has a transition on a token unless it lost the token, or, before the token was made,
the token's left part. All distinct words of a batch walk the trie at once, from every
position reached, under the transitions allowed; the one path to a word's end is its encoding.
Decoding emits the byte labels of the tokens.

Texts are cut into words by the pre-tokenizer's pattern. Most can be cut at their single spaces
first, and then only distinct pieces are looked at; the ids of the texts are gathered from those
of the distinct words. A worker remembers words up to a number of bytes.

Encodings equal those of the tokenizers library for byte-level BPE files whose
pre-tokenizer is the byte-level pattern. Null texts are empty; empty texts have no tokens
and decode to the empty text. Added tokens in a text are taken whole, as the library does. Texts
and words of any length are encoded whole; one longer than a slice of a batch is a slice of its
own. Repeated rows and rows with equal or null doc_id stay rows of their own; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.batches import binary_array, map_batches, only, slices, spread, text_bytes

#: The pattern of byte-level pre-tokenizers (fixed value).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Where a text cannot be cut at its spaces: white space of two or more characters that ends in
#: a space or begins with one, and white space other than the space and the line feed.
_UNCUT = (
    "  |\n | \n| $|[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)

_WORDS = regex.compile(WORDS)

#: What no word of the pattern begins with, since letters and marks are words of their own.
_ADDED = "\ue000a"

_SPACE, _NOTHING = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())

#: A piece that is one word, or a word of letters and one of marks.
_PLAIN_PIECE = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<marks>[!-/:-@\\[-`{-~]*)$"

#: Bytes of remembered words, with what a dictionary needs for them, before a worker starts anew.
REMEMBERED_BYTES = 40 << 20
_ENTRY_BYTES = 200

#: Words longer than this walk alone.
LONG_WORD = 96

#: Text bytes that one step takes at a time, and ids whose decimals are written at once.
TEXT_BYTES = 2 << 20
IDS_AT_ONCE = 1 << 18


def byte_letters() -> dict[str, int]:
    """The letters that byte-level files write for the 256 bytes: printable bytes for
    themselves, the others as the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, further = {}, 256
    for byte in range(256):
        if byte in printable:
            letters[chr(byte)] = byte
        else:
            letters[chr(further)] = byte
            further += 1
    return letters


class Automaton:
    """States and transitions compiled from a vocabulary and its merges.

    `vocabulary` maps token bytes to ids; `merges` are pairs of token bytes in order. A state is
    kept as (copied state, token taken away, time), since the tokens it allows follow from the
    tokens they were merged from.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.labels = {number: label for label, number in vocabulary.items()}
        self.start = 0
        # state -> (state it was copied from, token taken away, time of the copy)
        self._copied = [(-1, -1, 0)]
        self._behind = {}
        self._made = {}
        self._known: dict[tuple[int, int], bool] = {}
        for byte in range(256):
            number = vocabulary.get(bytes([byte]))
            if number is not None:
                self._behind[number] = self.start
                self._made[number] = (0, -1)
        for time, (left, right) in enumerate(merges, 1):
            self._merge(time, vocabulary[left], vocabulary[right], vocabulary[left + right])
        self._known.clear()

    def _merge(self, time: int, left: int, right: int, merged: int) -> None:
        """The gadget of one merge; a pair that never meets in an encoding adds nothing."""
        if left not in self._made or right not in self._made or merged in self._made:
            return
        old = self._behind[left]
        if not self.allows(old, right):
            return
        after = self._behind[right]
        self._copied.append((old, right, time))
        self._behind[left] = len(self._copied) - 1
        self._made[merged] = (time, left)
        self._behind[merged] = after

    def allows(self, state: int, token: int) -> bool:
        """Whether the state has a transition on the token."""
        known = self._known.get((state, token))
        if known is not None:
            return known
        at, number = state, token
        while True:
            source, without, copied = self._copied[at]
            made, left = self._made[number]
            if made >= copied and left >= 0:
                number = left
            elif source < 0:
                answer = True
                break
            elif number == without:
                answer = False
                break
            else:
                at = source
        self._known[state, token] = answer
        return answer

    def tables(self) -> Transitions:
        """The finished automaton as arrays."""
        size = max(self.labels) + 1
        made, left, after = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        places = {self.start: 0}
        for token, (time, part) in self._made.items():
            made[token], left[token] = time, part
            after[token] = places.setdefault(self._behind[token], len(places))
        keys, times = [], []
        for state, place in places.items():
            while state != self.start:
                state, token, time = self._copied[state]
                keys.append(place << TOKEN_BITS | token)
                times.append(time)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        return Transitions(
            made, left, after, np.array(keys, np.int64)[order], np.array(times, np.int32)[order], *self._trie(),
            np.array([len(self.labels.get(token, b"")) for token in range(size)], np.int32),
        )

    def _trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte trie of all tokens that encodings contain, as a double array.

        The child of a node on a byte lies at the node's base plus the byte, if the owner there
        is the node.
        """
        children, ends = [{}], [-1]
        for token in self._made:
            node = 0
            for byte in self.labels[token]:
                found = children[node].get(byte)
                if found is None:
                    found = children[node][byte] = len(ends)
                    children.append({})
                    ends.append(-1)
                node = found
            ends[node] = token
        taken = bytearray(2 * len(ends) + 512)
        taken[0] = 1
        bases, places, reached = {}, {0: 0}, [1] * 257
        # Nodes with many children first, while there is room everywhere; nodes with as many
        # children go on where the last one found room.
        for node in sorted(range(len(ends)), key=lambda node: -len(children[node])):
            steps = sorted(children[node])
            if not steps:
                break
            at = max(reached[len(steps)], steps[0])
            while True:
                at = taken.index(0, at)
                base = at - steps[0]
                if base + 256 >= len(taken):
                    taken.extend(bytes(len(taken)))
                if not any(taken[base + byte] for byte in steps[1:]):
                    break
                at += 1
            bases[node], reached[len(steps)] = base, at
            for byte in steps:
                taken[base + byte] = 1
                places[children[node][byte]] = base + byte
        size = max(max(places.values()), max(bases.values(), default=0) + 255) + 1
        base, owner, end = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        for node, place in places.items():
            base[place], end[place] = bases.get(node, 0), ends[node]
            for byte, child in children[node].items():
                owner[bases[node] + byte] = place
                assert places[child] == bases[node] + byte
        return base, owner, end


TOKEN_BITS = 21


#: Bits of the table that tells most losses that never were.
_SIEVE_BITS = 23
_STIR = np.uint64(0x9E3779B97F4A7C15)


def _sieve_place(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * _STIR >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)


@dataclass
class Transitions:
    """The automaton as arrays; state 0 is the start.

    Per token: when it was `made`, its `left` part, the state `after` it (-1: no encoding has
    it) and its label's length. `lost` are states and tokens they lost, `lost_at` when. The byte
    trie is a double array of `base` and `owner`; `ends` are its nodes' tokens.
    """

    made: np.ndarray
    left: np.ndarray
    after: np.ndarray
    lost: np.ndarray
    lost_at: np.ndarray
    base: np.ndarray
    owner: np.ndarray
    ends: np.ndarray
    lengths: np.ndarray

    @cached_property
    def _sieve(self) -> np.ndarray:
        sieve = np.zeros(1 << _SIEVE_BITS, bool)
        sieve[_sieve_place(self.lost)] = True
        return sieve

    def allows(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """For each state and token, whether the state has a transition on the token.

        A loss counts for the token as it was then: itself, once it was made, and before that
        the left part it was made of.
        """
        answer = np.ones(len(states), bool)
        live, number = np.flatnonzero(states != 0), tokens[states != 0]
        until = np.full(len(live), np.iinfo(np.int32).max)
        while len(live):
            keys = states[live].astype(np.int64) << TOKEN_BITS | number
            made, hit = self.made[number], np.zeros(len(live), bool)
            maybe = np.flatnonzero(self._sieve[_sieve_place(keys)])
            if len(maybe):
                at = np.minimum(np.searchsorted(self.lost, keys[maybe]), len(self.lost) - 1)
                time = self.lost_at[at]
                hit[maybe] = (self.lost[at] == keys[maybe]) & (time > made[maybe]) & (time <= until[maybe])
                answer[live[hit]] = False
            on = ~hit & (self.left[number] >= 0)
            live, until, number = live[on], made[on], self.left[number[on]]
        return answer

    def encode_words(self, words: list[bytes], kind: np.dtype) -> list[bytes]:
        """Token ids of pre-split words, as array bytes."""
        short = [word if len(word) <= LONG_WORD else b"" for word in words]
        out: list[bytes] = []
        for start in range(0, len(words), 1 << 15):
            ids, counts = self._walk(short[start:start + (1 << 15)])
            packed, ends = ids.astype(kind).tobytes(), (np.cumsum(counts) * kind.itemsize).tolist()
            out += [packed[first:last] for first, last in zip([0, *ends], ends)]
        for place, word in enumerate(words):
            if len(word) > LONG_WORD:
                out[place] = np.array(self._walk_alone(word), kind).tobytes()
        return out

    def _walk(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        # One more slot than bytes for each word: the token of the path that ends there.
        slots = starts + np.arange(len(words))
        reached = np.full(len(data) + len(words), -1, np.int64)
        for place in range(int(lengths.max(initial=0))):
            active = np.flatnonzero(lengths > place)
            if place:
                active = active[reached[slots[active] + place] >= 0]
                states = self.after[reached[slots[active] + place]]
            else:
                states = np.zeros(len(active), np.int64)
            nodes, at = np.zeros(len(active), np.int32), place
            while len(active):
                steps = self.base[nodes] + data[starts[active] + at]
                found = self.owner[steps] == nodes
                active, states, nodes = active[found], states[found], steps[found]
                at += 1
                tokens = self.ends[nodes]
                new = np.flatnonzero((tokens >= 0) & (reached[slots[active] + at] < 0))
                new = new[self.allows(states[new], tokens[new])]
                reached[slots[active[new]] + at] = tokens[new]
                more = lengths[active] > at
                active, states, nodes = active[more], states[more], nodes[more]
        return self._paths(words, reached, slots, lengths)

    def _paths(self, words, reached, slots, lengths) -> tuple[np.ndarray, np.ndarray]:
        """Follow the paths back from the words' ends."""
        at, alive, owners, tokens = lengths.copy(), np.flatnonzero(lengths > 0), [], []
        while len(alive):
            token = reached[slots[alive] + at[alive]]
            if (token < 0).any():
                raise ValueError(f"the vocabulary cannot spell {words[alive[token < 0][0]]!r}")
            owners.append(alive)
            tokens.append(token)
            at[alive] -= self.lengths[token]
            alive = alive[at[alive] > 0]
        if not owners:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        counts = np.bincount(np.concatenate(owners), minlength=len(lengths))
        ids = np.empty(int(counts.sum()), np.int64)
        ends = np.cumsum(counts)
        for step, (owner, token) in enumerate(zip(owners, tokens, strict=True)):
            ids[ends[owner] - 1 - step] = token
        return ids, counts

    @cached_property
    def _lists(self) -> tuple:
        """The arrays for walking alone, made when the first long word comes."""
        lost = dict(zip(self.lost.tolist(), self.lost_at.tolist(), strict=True))
        return lost, *[array.tolist() for array in (self.base, self.owner, self.ends, self.after, self.made, self.left)]

    def _walk_alone(self, word: bytes) -> list[int]:
        lost, base, owner, ends, after, made, left = self._lists
        reached, size = [-1] * (len(word) + 1), len(word)

        def allows(state: int, token: int) -> bool:
            until = 1 << 60
            while token >= 0:
                time = lost.get(state << TOKEN_BITS | token)
                if time is not None and made[token] < time <= until:
                    return False
                token, until = left[token], made[token]
            return True

        for place in range(size):
            if place and reached[place] < 0:
                continue
            state, node, at = after[reached[place]] if place else 0, 0, place
            while at < size:
                step = base[node] + word[at]
                if owner[step] != node:
                    break
                node = step
                at += 1
                token = ends[node]
                if token >= 0 and reached[at] < 0 and allows(state, token):
                    reached[at] = token
        ids, at = [], size
        while at > 0:
            if reached[at] < 0:
                raise ValueError(f"the vocabulary cannot spell {word[:100]!r}")
            ids.append(reached[at])
            at -= int(self.lengths[reached[at]])
        return ids[::-1]


class ByteLevelLabels:
    """What decoding needs of a byte-level BPE file: the byte labels of its tokens."""

    def __init__(self, path: str):
        self._read(path)

    def _read(self, path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]]]:
        """Set the labels; return vocabulary and merges."""
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        split = described["pre_tokenizer"]
        if described.get("normalizer") or split["type"] != "ByteLevel" or split.get("add_prefix_space"):
            raise ValueError("only byte-level files without normalizer and prefix space are read")
        letters = byte_letters()

        def spelled(token: str) -> bytes:
            return bytes(letters[letter] for letter in token)

        model = described["model"]
        vocabulary = {spelled(token): number for token, number in model["vocab"].items() if set(token) <= letters.keys()}
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.added = {token["content"]: token["id"] for token in described["added_tokens"]}
        labels = {number: label for label, number in vocabulary.items()}
        labels.update({number: content.encode() for content, number in self.added.items()})
        self.size = max(labels) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        lengths = np.zeros(self.size + 1, np.int64)
        for number, label in labels.items():
            lengths[number + 1] = len(label)
        self.label_starts = np.cumsum(lengths)
        self.label_bytes = np.frombuffer(b"".join(labels.get(number, b"") for number in range(self.size)), np.uint8)
        return vocabulary, [(spelled(a), spelled(b)) for a, b in pairs]

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of the ids, one after the other."""
        starts = self.label_starts[ids]
        return self.label_bytes[spread(starts, self.label_starts[ids.astype(np.int64) + 1] - starts)].tobytes()


class ByteLevelCodec(ByteLevelLabels):
    """A byte-level BPE file: pre-splitting, added tokens, encoding and decoding of texts."""

    def __init__(self, path: str):
        self.transitions = Automaton(*self._read(path)).tables()
        decimals = [b"%d," % number for number in range(self.size)]
        self.decimal_starts = np.cumsum([0, *map(len, decimals)])
        self.decimal_bytes = np.frombuffer(b"".join(decimals), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known = {_ADDED + content: np.array([number], self.kind).tobytes() for content, number in self.added.items()}
        self.known_bytes = 0

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name not in ("known", "known_bytes")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, as array bytes."""
        if self.known_bytes > REMEMBERED_BYTES:
            self._forget()
        found = list(map(self.known.get, words))
        if None in found:
            places = [place for place, ids in enumerate(found) if ids is None]
            fresh = [words[place] for place in places]
            packed = self.transitions.encode_words([word.encode() for word in fresh], self.kind)
            for place, ids in zip(places, packed, strict=True):
                found[place] = ids
            short = {word: ids for word, ids in zip(fresh, packed, strict=True) if len(word) <= LONG_WORD}
            self.known.update(short)
            self.known_bytes += sum(map(len, short)) + sum(map(len, short.values())) + _ENTRY_BYTES * len(short)
        return found

    def _words(self, text: str) -> list[str]:
        """The words of a text; an added token is a word that begins with `_ADDED`."""
        if not any(content in text for content in self.added):
            return _WORDS.findall(text)
        named = "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))
        out: list[str] = []
        for part in regex.split(f"({named})", text):
            out += [_ADDED + part] if part in self.added else _WORDS.findall(part)
        return out

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Words, the texts as places among them, and how many words each text has."""
        uncut = pc.match_substring_regex(texts, _UNCUT)
        for content in self.added:
            uncut = pc.or_(uncut, pc.match_substring(texts, content))
        cut = pc.split_pattern(texts.filter(pc.invert(uncut)), " ")
        uncut = uncut.to_numpy(zero_copy_only=False)
        bounds = cut.offsets.to_numpy()
        coded = cut.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        distinct, chosen = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        heads = cut.values.take(pa.array(bounds[:-1])).to_pylist()
        bounds = bounds - bounds[0]
        plain = pc.extract_regex(distinct, _PLAIN_PIECE)
        is_plain = plain.is_valid()
        kept = plain.filter(is_plain)
        letters = pc.binary_join_element_wise(_SPACE, kept.field("word"), _NOTHING)
        marks, count = kept.field("marks"), len(letters)
        # A plain piece is one word, or two, of which the marks stand `count` words behind.
        is_plain_here = is_plain.to_numpy(zero_copy_only=False)
        first, sizes = np.zeros(len(distinct), np.int64), np.ones(len(distinct), np.int64)
        first[is_plain_here] = np.arange(count)
        marked = np.zeros(len(distinct), bool)
        marked[is_plain_here] = pc.binary_length(marks).to_numpy() > 0
        # Other pieces, the first pieces of texts and uncut texts are split by the pattern.
        others = [_WORDS.findall(" " + piece) for piece in distinct.filter(pc.invert(is_plain)).to_pylist()]
        texts_uncut = [self._words(text) for text in texts.filter(pa.array(uncut)).to_pylist()]
        split = others + [_WORDS.findall(piece) for piece in heads] + texts_uncut
        counts = np.fromiter(map(len, split), np.int64, len(split))
        starts = 2 * count + np.cumsum(counts) - counts
        first[~is_plain_here], sizes[~is_plain_here] = starts[:len(others)], counts[:len(others)]
        first, sizes = np.r_[first, starts[len(others):]], np.r_[sizes, counts[len(others):]]
        marked = np.r_[marked, np.zeros(len(heads) + len(texts_uncut), bool)]
        words = pa.concat_arrays([letters, marks, pa.array([word for found in split for word in found], pa.large_string())])
        # The texts as they come: those that were cut, and those that were not.
        chosen[bounds[:-1]] = len(distinct) + np.arange(len(cut))
        lengths = np.ones(len(texts), np.int64)
        lengths[~uncut] = np.diff(bounds)
        pieces = np.empty(int(lengths.sum()), np.int64)
        of_uncut = np.repeat(uncut, lengths)
        pieces[~of_uncut] = chosen
        pieces[of_uncut] = len(distinct) + len(heads) + np.arange(len(texts_uncut))
        begin, twice = first[pieces], marked[pieces]
        taken = sizes[pieces] + twice
        ends = np.cumsum(taken)
        index = spread(begin, taken)
        index[ends[twice] - 1] = begin[twice] + count
        return words, index, np.diff(np.r_[0, ends][np.cumsum(lengths)], prepend=0)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and how many each has."""
        words, index, lengths = self._pieces(texts.cast(pa.large_string()))
        coded = words.dictionary_encode()
        parts = self._look_up(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // self.kind.itemsize
        chosen = coded.indices.to_numpy()[index]
        taken = sizes[chosen]
        flat = np.frombuffer(b"".join(parts), self.kind)
        ids = flat[spread((np.cumsum(sizes) - sizes)[chosen], taken)]
        return ids, np.diff(np.r_[0, np.cumsum(taken)][np.cumsum(lengths)], prepend=0)

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids of a text, and the same in decimal, joined by commas."""
        ids, _ = self.encode_texts(pa.array([text], pa.string()))
        return ids, ",".join(map(str, ids.tolist()))

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, each followed by a comma."""
        out = []
        for start in range(0, len(ids), IDS_AT_ONCE):
            part = ids[start:start + IDS_AT_ONCE].astype(np.int64)
            starts = self.decimal_starts[part]
            out.append(self.decimal_bytes[spread(starts, self.decimal_starts[part + 1] - starts)].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> ByteLevelCodec:
    """The compiled file."""
    return ByteLevelCodec(path)


@lru_cache(maxsize=2)
def token_labels(path: str) -> ByteLevelLabels:
    """The labels alone: workers that only decode hold no automaton."""
    return ByteLevelLabels(path)


def _encoded(batch: pa.RecordBatch, shared: Broadcast) -> Iterator[list]:
    coder = shared.value
    texts = pc.fill_null(batch.column("text"), "")
    for start, past in slices(pc.binary_length(texts).to_numpy(), TEXT_BYTES):
        ids, counts = coder.encode_texts(texts.slice(start, past - start))
        ends = np.cumsum(counts)
        widths = coder.decimal_starts[ids.astype(np.int64) + 1] - coder.decimal_starts[ids]
        places = np.r_[0, np.cumsum(widths)][np.r_[0, ends]].tolist()
        decimals = memoryview(coder.decimals(ids))
        digests = [
            hashlib.sha256(decimals[first:max(first, last - 1)]).hexdigest() for first, last in zip(places, places[1:])
        ]
        yield [
            batch.column("doc_id").slice(start, past - start),
            binary_array(ids.astype("<u4").view(np.uint8), np.r_[0, ends] * 4), counts, digests,
        ]


def encode_documents(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (binary of little-endian 32-bit integers), n_tokens and ids_sha256 per document.

    `tokenizer` is the path of the file; it is compiled here, and tasks get the tables.
    """
    shared = documents.sparkSession.sparkContext.broadcast(codec(tokenizer))
    frame = only(documents, doc_id="long", text="string")
    return map_batches(frame, "doc_id long, ids binary, n_tokens long, ids_sha256 string", _encoded, shared)


def _decoded(batch: pa.RecordBatch, path: str) -> Iterator[list]:
    coder = token_labels(path)
    texts = [coder.decode(np.frombuffer(ids or b"", "<u4")).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
    yield [*[batch.column(name) for name in batch.schema.names if name != "ids"], texts]


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The columns of `encode_documents` with the decoded `text` in place of the ids."""
    kinds = [f"`{name}` {kind}" for name, kind in encoded.dtypes if name != "ids"]
    return map_batches(encoded, ", ".join([*kinds, "text string"]), _decoded, tokenizer)


def encoding_digests(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    decoded = decode_documents(encode_documents(documents, tokenizer), tokenizer)
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
