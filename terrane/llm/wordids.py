"""Subword ids of whole texts by a word-level BPE of the tokenizers library, with what words give kept.

Its normaliser and splitter treat the stretches between blanks one by one wherever a text holds only
characters below LIMIT and no control blanks, so the ids of a stretch are looked up, and the model is
asked only for words that are new. Any other text goes through the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, models, pre_tokenizers

LIMIT = "\u0180"
#: Python takes these for blanks, the tokenizer doesn't.
_ODD = re.compile("[\x1c-\x1f]")
#: What only the library as a whole is asked for.
_HARD = re.compile(f"[\x1c-\x1f{LIMIT}-\U0010ffff]")


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """texts -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bare = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=end, cache_capacity=0))
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(max(model["vocab"].values()) + 1, bool)
        self.ends[[i for t, i in model["vocab"].items() if t.endswith(end)]] = True
        classes = {x: "".join(re.escape(chr(i)) for i in range(ord(LIMIT)) if unicodedata.category(chr(i))[0] == x) for x in "LN"}
        self.words_in = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{classes['L']}]+|[{classes['N']}]|[^{classes['L']}{classes['N']}]+").findall
        self.chars = {b: c for b, c in _byte_chars().items()}
        self.words: dict[str, bytes] = {}
        self.most = most
        self._forget()

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of stretches, by their words, which are kept."""
        cut = self.words_in
        parts = [[s.lower()] if s.isascii() and s.isalpha() else cut(s.lower()) for s in new]
        known = self.words
        unknown = list(set().union(*parts) - known.keys())
        if unknown:
            known.update(zip(unknown, self._pieces(unknown), strict=True))
        return [known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for ws in parts]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of words as the splitter gives them, none of which holds a blank."""
        if not pieces:
            return []
        line = " ".join([p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.chars) for p in pieces])
        ids = np.array(self.bare.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
        cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(cuts) != len(pieces):
            raise RuntimeError("a word's ids don't end where the word ends")
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def fresh(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words without blanks, none of which is kept."""
        parts: list[list[str] | None] = []
        for w in words:
            if w.isascii():
                if w.isalpha():
                    parts.append([w.lower()])
                    continue
            elif max(w) >= LIMIT:
                parts.append(None)
                continue
            parts.append(self.words_in(w.lower()) if not _ODD.search(w) and len(w.split()) == 1 else None)
        pieces = list({p for ps in parts if ps for p in ps})
        known = dict(zip(pieces, self._pieces(pieces), strict=True))
        return [(known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps])) if ps is not None else np.array(self.whole.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w, ps in zip(words, parts, strict=True)]

    def _forget(self) -> None:
        self.stretches: dict[str, int] = {}
        self.count = self.used = 0
        self.start, self.size, self.ids = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)

    def _keep(self, new: list[str]) -> None:
        """Adds stretches and their ids."""
        ids = self._learn(new)
        flat, sizes = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        a, b, end = self.count, self.count + len(new), self.used + len(flat)
        room = lambda x, n: x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])
        self.start, self.size, self.ids = room(self.start, b), room(self.size, b), room(self.ids, end)
        self.start[a:b], self.size[a:b], self.ids[self.used : end] = self.used + np.cumsum(sizes) - sizes, sizes, flat
        self.stretches.update(zip(new, range(a, b), strict=True))
        self.count, self.used = b, end

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what has been learnt is dropped when it is much, and always for long words."""
        hard = [bool(_HARD.search(t)) for t in texts]
        if len(self.stretches) > self.most:
            self._forget()
        if len(self.words) > self.most:
            self.words.clear()
        lists = pc.utf8_split_whitespace(pa.array([t for t, h in zip(texts, hard, strict=True) if not h], pa.large_string()))
        flat, offsets = lists.flatten(), lists.offsets.to_numpy()
        some = pc.not_equal(flat, "")
        begin = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])[offsets - offsets[0]]
        coded = flat.filter(some).dictionary_encode()
        own, have = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.stretches
        got = list(map(have.get, own))
        new = [s for s, n in zip(own, got, strict=True) if n is None]
        short, long = [s for s in new if len(s) <= 48], [s for s in new if len(s) > 48]
        self._keep(short)
        count, used = self.count, self.used
        self._keep(long)
        if new:
            fresh = iter(map(have.__getitem__, new))
            got = [next(fresh) if n is None else n for n in got]
        number = np.array(got, np.int64)[coded.indices.to_numpy()]
        sizes = self.size[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.ids[np.repeat(self.start[number] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        cuts = iter(zip((4 * ends[begin[:-1]]).tolist(), (4 * ends[begin[1:]]).tolist(), strict=True))
        out = []
        for t, h in zip(texts, hard, strict=True):
            if h:
                out.append(np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                a, b = next(cuts)
                out.append(data[a:b])
        for s in long:
            del have[s]
            for w in self.words_in(s.lower()):
                self.words.pop(w, None)
        self.count, self.used = count, used
        return out


@cache
def tool(path: str) -> WordIds:
    return WordIds(path)
