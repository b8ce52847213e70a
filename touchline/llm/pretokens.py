"""Cutting texts into pre-tokens, vectorised over code points.

Two public patterns are known.  ``spaced``: contractions, or a run of letters, of numbers or of other signs with one space
before it, or white space (a run leaves its last character to what follows).  Otherwise: contractions, runs of letters,
single numbers, runs of other signs, white space dropped.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

from touchline.llm.common import mix, powers

LETTER, NUMBER, SPACE, OTHER = range(4)
# White space of Unicode; endings of contractions.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    first = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
    kinds[first == "L"] = LETTER
    kinds[first == "N"] = NUMBER
    kinds[WHITE] = SPACE
    return kinds


@functools.cache
def library_kinds() -> np.ndarray:
    """Classes of all code points as the tokenizer library has them: its Unicode tables needn't be Python's."""
    from tokenizers import Regex, pre_tokenizers

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    points = np.array(points)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text):
            out[points[a:b]] = kind
    return out


class Normal:
    """NFC and lower case, as the tokenizer library does them.

    Python does the work; pieces with a code point that its tables lack, or for which the library has another lower case or
    decomposition, are left to the library.
    """

    def __init__(self, odd: bytes | None = None):
        """``odd`` is the table that :meth:`odd_points` gave elsewhere."""
        from tokenizers import normalizers

        self.library = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.odd = np.frombuffer(self.odd_points() if odd is None else odd, np.bool_)

    @staticmethod
    @functools.cache
    def odd_points() -> bytes:
        """For every code point whether it is the library's business."""
        from tokenizers import normalizers

        lower, nfd, nfc = normalizers.Lowercase(), normalizers.NFD(), normalizers.NFC()

        def odd(c: str) -> bool:
            return unicodedata.category(c) == "Cn" or lower.normalize_str(c) != _lower(c) or nfd.normalize_str(c) != unicodedata.normalize("NFD", c) or nfc.normalize_str(c) != unicodedata.normalize("NFC", c)

        return np.array([not 0xD800 <= c < 0xE000 and odd(chr(c)) for c in range(0x110000)]).tobytes()

    def __call__(self, text: str) -> str:
        if not text.isascii() and self.odd[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            return self.library.normalize_str(text)
        return _lower(unicodedata.normalize("NFC", text))


def _lower(text: str) -> str:
    """Letter by letter, so a capital sigma never becomes the final form."""
    return text.replace("Σ", "σ").lower()


def split_special(texts: list[str], special: dict[str, int]) -> tuple[list[str], np.ndarray, list[int]]:
    """Pieces of ordinary text, the row of each, and for each the id of the special string after it (-1: none)."""
    pieces, rows, after = [], [], []
    for r, text in enumerate(texts):
        rest = text
        while True:
            found = [(p, -len(s), s) for s in special if (p := rest.find(s)) >= 0] if "<|" in rest else []
            if not found:
                break
            p, _, s = min(found)
            pieces.append(rest[:p]), rows.append(r), after.append(special[s])
            rest = rest[p + len(s):]
        pieces.append(rest), rows.append(r), after.append(-1)
    return pieces, np.asarray(rows, np.int64), after


class Segments:
    """Pre-tokens of many pieces: ``starts``, ``ends`` in the joined text, ``piece`` and 64-bit ``hashes`` of each."""

    def __init__(self, pieces: list[str], spaced: bool, kind_of: np.ndarray | None = None):
        kind_of = library_kinds() if kind_of is None else kind_of
        self.text = "".join(pieces)
        cp = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        n = len(cp)
        edges = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        kind = kind_of[cp]
        border = np.zeros(n + 1, bool)
        border[edges] = True
        first = border.copy()
        first[1:n] |= kind[1:] != kind[:-1]
        if not spaced:
            first[:n] |= kind == NUMBER
        mark = np.flatnonzero((cp == 39) & first[:n] & first[1:] & ~border[1:])
        if spaced:
            mark = mark[border[mark] | (cp[mark - 1] != 32)]
            after_space = np.flatnonzero(~border[1:n] & (kind[:-1] == SPACE) & (kind[1:] != SPACE)) + 1
            first[after_space - 1] = True
            first[after_space[cp[after_space - 1] == 32]] = False
        padded = np.concatenate([cp, np.zeros(2, np.uint32)])
        for ending in ENDINGS:
            fits = np.all([padded[mark + 1 + k] == ord(x) for k, x in enumerate(ending)], axis=0)
            at = mark[fits]
            if len(ending) == 2:
                at = at[~border[at + 2]]
            first[at + 1] = False
            first[at + 1 + len(ending)] = True
        self.starts = np.flatnonzero(first[:n])
        self.ends = np.append(self.starts[1:], n) if len(self.starts) else self.starts
        if not spaced:
            keep = kind[self.starts] != SPACE
            self.starts, self.ends = self.starts[keep], self.ends[keep]
        self.piece = np.searchsorted(edges, self.starts, side="right") - 1
        lengths = self.ends - self.starts
        begin = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
        codes = mix(cp[within + np.repeat(self.starts, lengths)].astype(np.uint64) + np.uint64(77))
        self.hashes = mix(np.add.reduceat(codes * powers(int(lengths.max()))[within], begin) + lengths.astype(np.uint64)) if len(lengths) else np.zeros(0, np.uint64)

    def string(self, k: int) -> str:
        return self.text[self.starts[k]: self.ends[k]]
