"""Byte-level BPE by longest matches and backtracking, exact in linear time; and its decoder.

Bytes are mapped to Latin-1 so that an Aho-Corasick automaton over characters matches them. A piece is
encoded by taking the longest token at each place; a token may follow another only if the merges would
leave the two side by side, which is decided by undoing their merges and is memoised; where none fits,
the last token is shortened. Places that no valid encoding reaches are marked, so none is tried twice.

Defined cases: a null text counts as empty and has no ids; a piece that is itself a token is that
token; special tokens don't exist, their strings are ordinary text; repeated rows each get a result;
long texts are taken whole; a kept column that has the name of a result gives way to it; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from functools import cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import columns_of, map_texts

#: Up to here letters, digits and blanks are listed in a character class of the standard library's re.
PLAIN = 0x250


def load_ranks(path: str) -> list[bytes]:
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * (1 + max(int(r) for _, r in pairs))
    for text, rank in pairs:
        tokens[int(rank)] = base64.b64decode(text)
    return tokens


@cache
def _plain(pattern: str) -> re.Pattern:
    """The same pattern for texts of characters below PLAIN: classes are spelt out."""
    kinds = {x: "".join(re.escape(chr(i)) for i in range(PLAIN) if unicodedata.category(chr(i))[0] == x) for x in "LN"}
    blank = "\\t-\\r \\x85\\xa0"
    own = pattern.replace("(?!\\S)", f"(?![^{blank}])")
    own = re.sub(r"\[\^\\s\\p\{L\}\\p\{N\}\]", lambda _: f"[^{blank}{kinds['L']}{kinds['N']}]", own)
    own = own.replace("\\p{L}", f"[{kinds['L']}]").replace("\\p{N}", f"[{kinds['N']}]")
    return re.compile(own.replace("\\s", f"[{blank}]"))


class Splitter:
    """All matches of a pattern, as the regex library would find them."""

    def __init__(self, pattern: str):
        self.whole = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.plain = _plain(pattern).findall

    def __call__(self, text: str) -> list[str]:
        return self.plain(text) if text.isascii() or max(text) < chr(PLAIN) else self.whole.findall(text)


class _Fits(dict):
    """first << 20 | second -> whether merging leaves the two tokens side by side."""

    def __init__(self, tokens: list[bytes], ids: dict[bytes, int], split: list[tuple[int, int]], most: int = 1_000_000):
        super().__init__()
        self.tokens, self.ids, self.split, self.most = tokens, ids, split, most

    def __missing__(self, key: int) -> bool:
        """Undoes the later merge of the two, again and again; no pair on the way may merge before the next."""
        a, b = key >> 20, key & 0xFFFFF
        limit, split, tokens, ids, ok = 1 << 62, self.split, self.tokens, self.ids, True
        while True:
            if ids.get(tokens[a] + tokens[b], limit) < limit:
                ok = False
                break
            if a > b:
                limit, a = a, split[a][1]
                if a == limit:
                    limit, b = b + 1, split[b][0]
                    if b + 1 == limit:
                        break
            else:
                limit, b = b + 1, split[b][0]
                if b + 1 == limit:
                    limit, a = a, split[a][1]
                    if a == limit:
                        break
        if len(self) >= self.most:
            self.clear()
        self[key] = ok
        return ok


class Encoder(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers. Filled as pieces are met, emptied when full."""

    def __init__(self, tokens: list[bytes], most: int = 800_000):
        super().__init__()
        self.most = most
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens) if t}
        self.lengths = [len(t) for t in tokens]
        self.split: list[tuple[int, int]] = [(i, i) for i in range(len(tokens))]
        reached = [len(t) == 1 for t in tokens]
        for i in sorted((i for i, t in enumerate(tokens) if len(t) > 1)):
            parts = self._merge(tokens[i], i)
            if len(parts) == 2 and max(parts) < i and reached[parts[0]] and reached[parts[1]]:
                self.split[i], reached[i] = (parts[0], parts[1]), True
        self.reached = reached
        #: the longest proper start of a token that is a token; -1: none
        self.shorter = [next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids and reached[self.ids[t[:k]]]), -1) for t in tokens]
        self.fits = _Fits(tokens, self.ids, self.split)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in enumerate(tokens):
            if t and reached[i]:
                automaton.add_word(t.decode("latin-1"), i)
        automaton.make_automaton()
        self.automaton = automaton

    def _merge(self, piece: bytes, below: int | None = None) -> list[int]:
        """Merges by rank, the lowest and leftmost first; only ranks under `below`."""
        ids, tokens = self.ids, self.tokens
        parts = [ids[piece[i : i + 1]] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ids.get(tokens[parts[i]] + tokens[parts[i + 1]])
                if r is not None and (below is None or r < below) and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [best]
        return parts

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        n, lengths, shorter, fits = len(piece), self.lengths, self.shorter, self.fits
        longest = [-1] * n
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token  # ends ascend, so the longest comes last
        dead = bytearray(n + 1)
        out: list[int] = []
        pos, last, token = 0, -1, longest[0]
        while pos < n:
            while token >= 0 and (dead[pos + lengths[token]] or (last >= 0 and not fits[last << 20 | token])):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos += lengths[token]
                last, token = token, longest[pos] if pos < n else -1
            else:
                dead[pos] = 1
                token = out.pop()
                pos -= lengths[token]
                token, last = shorter[token], out[-1] if out else -1
        return out

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        got = np.array(self.encode_piece(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = got
        return got


@cache
def tools(path: str, pattern: str) -> tuple[Splitter, Encoder]:
    return Splitter(pattern), Encoder(load_ranks(path))


def encode(text: str | None, path: str, pattern: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    split, encoder = tools(path, pattern)
    return b"".join(map(encoder.__getitem__, split(text))) if text else b""


def decode(ids: bytes, path: str, pattern: str) -> bytes:
    return b"".join(map(tools(path, pattern)[1].tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoded(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep's columns and ids, a binary of little-endian unsigned 32-bit integers."""
    return _mapped(docs, keep, text, "ids binary", lambda t: (encode(t, path, pattern),))


def decoded(rows: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """keep's columns and bytes, what the ids stand for."""
    return _mapped(rows, keep, ids, "bytes binary", lambda b: (decode(b or b"", path, pattern),))


def digests(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Both ways in one pass: the number of ids and the hashes of the ids and of what they decode to."""

    def both(t: str | None) -> tuple:
        ids = encode(t, path, pattern)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decode(ids, path, pattern)).hexdigest()

    return _mapped(docs, keep, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", both)


def _mapped(df: DataFrame, keep: tuple[str, ...], column: str, adds: str, f) -> DataFrame:
    n = len(adds.split(", "))

    def make():
        return lambda values: (columns_of([f(x) for x in values], n), None)

    return map_texts(df, make, adds, keep, column)
