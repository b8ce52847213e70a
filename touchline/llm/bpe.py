"""BPE encoding by backtracking over Aho-Corasick matches, decoding by offset table.

A text is cut into pre-tokens; a pre-token's tokens are found from left to right, always the longest vocabulary match
first.  A match may follow the token before it only if merging their joint bytes gives just these two tokens, which a
table of pairs remembers; where no match fits, the position is marked dead and the last token gives way to its next
shorter one.  The result is exactly that of applying all merges in order, and each position dies once at most.
Each distinct pre-token is encoded once per worker.

For vocabularies of the kind "end-of-word suffix, text lower-cased after NFC, white space dropped".  NULL and empty texts
have no tokens and decode to the empty text.  Special strings inside a text become their special token.  Repeated rows are
encoded each; columns besides the id and text are not read.
"""

from __future__ import annotations

import json

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import chunks, text_arrays
from touchline.llm.pretokens import Normal, Segments, library_kinds, split_special

KEEP_WORDS = 250_000
"""Encoded pre-tokens a worker remembers before it starts afresh."""
_END = 0x1000


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def ragged(offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the items that ``offsets`` gives for each of ``index``, and the new offsets."""
    start = offsets[index]
    length = offsets[index + 1] - start
    upto = np.concatenate([[0], np.cumsum(length)])
    return np.arange(upto[-1]) + np.repeat(start - upto[:-1], length), upto


class Codec:
    """Encoder and decoder of one vocabulary, built from its tokenizer file's text."""

    def __init__(self, spec: str, kinds: bytes | None = None, odd: bytes | None = None):
        """``kinds`` and ``odd`` are the library's tables (see ``pretokens``), where they are already known."""
        spec = json.loads(spec)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.normal = Normal(odd)
        self.kinds = np.frombuffer(kinds, np.uint8) if kinds is not None else library_kinds()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        inner = {self._inner(t): i for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank.setdefault((left, right), r)
            self.made.setdefault(whole, (r, left, right))
        self.length = {i: len(t) for t, i in inner.items()}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.matches = ahocorasick.Automaton()
        for t, i in inner.items():
            made = self.made.get(i)
            if made is None or self._joins(made[1], made[2], made[0]):
                self.matches.add_word(t, i)
        self.matches.make_automaton()
        letters = _byte_letters()
        self.to_letters = {b: letters[b] for b in range(256)}
        names = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.special.items()}}
        table = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)
        self.token_offsets = np.concatenate([[0], np.cumsum([len(t) for t in table])])
        self.words: dict[int, int] = {}
        self._forget()

    def _inner(self, token: str) -> str:
        """Token as a string with one letter per symbol: the end of a word marks its last letter."""
        return token[: -len(self.suffix) - 1] + chr(ord(token[-len(self.suffix) - 1]) + _END) if token.endswith(self.suffix) else token

    def _forget(self):
        self.words.clear()
        self.flat: list[np.ndarray] = []
        self.n_words = 0
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _joins(self, left: int, right: int, below: int) -> bool:
        """Whether merges of rank under ``below`` leave the border between two tokens alone.

        Both are taken apart at the border, the later merge first; at each stage the two symbols that meet must not be
        merged before one of them grows.  Of equal symbols in a row the left ones merge first, hence the two bounds.
        """
        while True:
            meet = self.rank.get((left, right))
            if meet is not None and meet < below:
                return False
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                left, below = a[2], a[0]
            else:
                right, below = b[1], b[0] + 1

    def fits(self, left: int, right: int) -> bool:
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > 2 * KEEP_WORDS:
                self.compatible.clear()
            known = self.compatible[left, right] = self._joins(left, right, 1 << 60)
        return known

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        letters = "".join(self.to_letters[b] for b in raw)
        letters = letters[:-1] + chr(ord(letters[-1]) + _END)
        n = len(letters)
        found: list[list[int]] = [[] for _ in range(n)]
        length, fits = self.length, self.fits
        for end, token in self.matches.iter(letters):
            found[end + 1 - length[token]].append(token)
        dead = bytearray(n + 1)
        out: list[int] = []
        tried: list[int] = []
        at, k = 0, len(found[0]) - 1
        while at < n:
            options = found[at]
            while k >= 0 and (dead[at + length[options[k]]] or (out and not fits(out[-1], options[k]))):
                k -= 1
            if k >= 0:
                out.append(options[k])
                tried.append(k)
                at += length[options[k]]
                k = len(found[at]) - 1 if at < n else 0
            else:
                dead[at] = 1
                last = out.pop()
                k = tried.pop() - 1
                at -= length[last]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the n + 1 offsets of the texts in them."""
        pieces, rows, after = split_special(texts, self.special)
        seg = Segments([self.normal(p) for p in pieces], spaced=False, kind_of=self.kinds)
        if self.n_words > KEEP_WORDS:
            self._forget()
        distinct, first, index = np.unique(seg.hashes, return_index=True, return_inverse=True)
        number = np.empty(len(distinct), np.int64)
        words = self.words
        for k, h in enumerate(distinct.tolist()):
            at = words.get(h)
            if at is None:
                at = words[h] = self.n_words
                self.flat.append(np.asarray(self.encode_word(seg.string(first[k])), np.int32))
                self.n_words += 1
            number[k] = at
        if self.flat:
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum([len(f) for f in self.flat])])
            self.ids = np.concatenate([self.ids, *self.flat])
            self.flat = []
        where, upto = ragged(self.offsets, number[index])
        ids = self.ids[where]
        ends = upto[np.searchsorted(seg.piece, np.arange(len(pieces)), side="right")]
        after = np.asarray(after)
        marks = np.flatnonzero(after >= 0)
        if len(marks):
            ids = np.insert(ids, ends[marks], after[marks])
            ends = ends + np.cumsum(after >= 0)
        last = np.searchsorted(rows, np.arange(len(texts)), side="right") - 1
        return ids.astype(np.int32), np.concatenate([[0], ends[last]]) if len(texts) else np.zeros(1, np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Tokens of each text, joined by single spaces, in UTF-8."""
        where, upto = ragged(self.token_offsets, ids)
        joined = self.token_bytes[where].tobytes()
        return [joined[upto[a]: max(upto[a], upto[b] - 1)] for a, b in zip(offsets[:-1], offsets[1:])]


_codec: dict[int, Codec] = {}


def codec(spec: str, kinds: bytes, odd: bytes) -> Codec:
    """The worker's codec of a vocabulary; built once."""
    key = hash(spec)
    if key not in _codec:
        _codec[key] = Codec(spec, kinds, odd)
    return _codec[key]


def _coded(spec, with_text: bool, names: list[str]):
    def run(batches):
        own = codec(*spec.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            _, offsets = text_arrays(texts)
            for i, j in chunks(offsets):
                ids, upto = own.encode([t or "" for t in texts.slice(i, j - i).to_pylist()])
                out = [c.slice(i, j - i) for c in batch.columns[:-1]]
                out += [pa.array(np.diff(upto).astype(np.int64)), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids))]
                if with_text:
                    out.append(pa.array([b.decode() for b in own.decode(ids, upto)], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str, keep: list[str] = ("doc_id",), text_col: str = "text", with_text: bool = False) -> DataFrame:
    """The ``keep`` columns, n_tokens (long), ids (array of int) and, if asked for, the text that the ids decode to (decoded).

    ``vocabulary`` is the path of a tokenizer file on the driver; its text is what workers get.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast((f.read(), library_kinds().tobytes(), Normal.odd_points()))
    kept = docs.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "n_tokens bigint", "ids array<int>", *(["decoded string"] if with_text else [])])
    names = [*kept.columns, "n_tokens", "ids", *(["decoded"] if with_text else [])]
    return docs.select(*keep, F.col(text_col).alias("bp_text")).mapInArrow(_coded(spec, with_text, names), schema)
