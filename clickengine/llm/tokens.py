"""Token ids by a file of the tokenizers library, with a cache of text pieces.

Where the file's merges make every token of its vocabulary out of that token's bytes, in the
order of the ids, merging the pair with the smallest id first gives the same ids, and that is
what the tiktoken library does: texts in Latin letters go there whole.

Other texts go piece by piece.  A byte-level BPE with the usual pattern never joins what stands
before a space and what follows it, if a letter, digit or punctuation mark follows.  Texts are
cut there, and each different piece is encoded once; the result is the same as that of the whole
text.  Pieces in Latin letters are split into words here, by the same pattern, and the words go
to the tokenizer's model; all others go through the whole tokenizer.  The file's added tokens,
where they are matched, cut a text first, and what lies between them is encoded for itself.
"""

from __future__ import annotations

import gc
import json
import os
import re
import string
from itertools import chain

import numpy as np
import regex
import tiktoken

from clickengine.llm.common import ragged

#: Pieces in a generation of the cache.  A full generation becomes the old one, from which pieces
#: that come up again move to the new one; the rest is forgotten with the next change.
CACHE = 150_000

#: The pattern of the pre-tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same, without going back inside a run of one kind.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: Pieces of characters below are split here.
LATIN_END = "\u0250"
#: The first UTF-8 byte of characters from U+0240 on.
LATIN_BYTES = 0xC9
#: White space of such length is left to the tokenizer: the other pattern would go back through it.
LONG_SPACE = 10_000


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the model's vocabulary: itself if it is
    printable Latin-1, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _by_rank(tokenizer) -> tiktoken.Encoding | None:
    """The tokenizer's encoding by ids of merges; None if it may differ."""
    file = json.loads(tokenizer.to_str())
    model, before = file["model"], file["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not file["normalizer"] and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    added = {t["content"]: t["id"] for t in file["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    letters = {c: b for b, c in _byte_letters().items()}
    if (None in merged or any(a >= b for a, b in zip(merged, merged[1:])) or not letters.keys() <= vocab.keys()
            or any(c not in letters for t in vocab for c in t)
            or any([x.id for x in tokenizer.model.tokenize(t)] != [i] for t, i in vocab.items())):
        return None
    return tiktoken.Encoding("by_rank", pat_str=RUNS, mergeable_ranks={bytes(letters[c] for c in t): i for t, i in vocab.items()},
                             special_tokens=added or {"\0": max(vocab.values()) + 1})


_MARKS = frozenset(string.punctuation)
_RAW = "\0"  # marks a piece that isn't led by a space


class _Pieces(dict):
    """Piece -> number; an unknown piece gets the next one, and waits to be copied from the
    old generation or to be encoded."""

    def __init__(self, old: dict[str, int]):
        super().__init__()
        self.old = old
        self.waiting: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.waiting.append(piece)
        self[piece] = n = len(self)
        return n

    def take(self) -> tuple[list[str], np.ndarray]:
        """The waiting pieces, and their old numbers (-1: none)."""
        out, self.waiting = self.waiting, []
        return out, np.array([self.old.get(p, -1) for p in out], np.int64)


#: A space that may not start a piece.
_ODD = re.compile(r" (?![\w!-/:-@\[-`{-~])")


def _starts(piece: str) -> bool:
    """True if the space before the piece starts a new piece."""
    return bool(piece) and (piece[0].isalnum() or piece[0] in _MARKS)


class Encoder:
    """Encodes texts as the tokenizer file does, with no special tokens put around them.
    ``added``: the strings of the file's added tokens in a text become those tokens, as in the
    untouched tokenizer; else those of special tokens are ordinary text."""

    _own: dict[tuple[str, int, bool], "Encoder"] = {}

    def __init__(self, path: str, cache: int = CACHE, added: bool = False):
        self.cache = cache
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = list(self.tokenizer.get_added_tokens_decoder().values()) if added else []
        self.added = tuple(t.content for t in tokens)
        #: Cuts a text at its added tokens; None if some of them also take in or look at what is beside them.
        self.at_added = None
        if not any(t.single_word or t.lstrip or t.rstrip or t.normalized and self.tokenizer.normalizer for t in tokens):
            self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.by_rank = _by_rank(self.tokenizer)
        self.long_space = re.compile(rf"\s{{{LONG_SPACE}}}")
        self.model = self.tokenizer.model
        self.words = regex.compile(PATTERN)
        self.letters = _byte_letters()
        self.word_ids: dict[str, tuple[int, ...]] = {}
        self.pieces = _Pieces({})
        self.start, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self._next_generation()

    @classmethod
    def of(cls, path: str, cache: int = CACHE, added: bool = False) -> Encoder:
        """One encoder a file, cache size, way of added tokens and worker process."""
        if (path, cache, added) not in cls._own:
            cls._own[path, cache, added] = cls(path, cache, added)
        return cls._own[path, cache, added]

    def _next_generation(self) -> None:
        self.old = self.start, self.count, self.flat
        self.pieces = _Pieces(dict(self.pieces))
        self.start, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _numbers(self, text: str) -> list[int]:
        """The numbers of the pieces of a text."""
        parts = text.split(" ")
        parts[0] = _RAW + parts[0]
        if not _ODD.search(text):
            return list(map(self.pieces.__getitem__, parts))
        out, now = [], [parts[0]]
        raw = True
        for p in parts[1:]:
            if _starts(p):
                out.append(self._piece(now, raw))
                now, raw = [p], False
            else:
                now.append(p)
        out.append(self._piece(now, raw))
        return out

    def _around_added(self, text: str) -> list[int]:
        """The numbers of the pieces of a text that holds added tokens; each of these is a piece."""
        if self.at_added is None:
            return [self.pieces[_RAW + text]]
        out = []
        for i, part in enumerate(self.at_added.split(text)):
            if part:
                out.extend([self.pieces[_RAW + part]] if i % 2 else self._numbers(part))
        return out

    def _piece(self, parts: list[str], raw: bool) -> int:
        if len(parts) == 1:
            return self.pieces[parts[0]]
        return self.pieces[" ".join(parts) if raw else _RAW + " " + " ".join(parts)]

    def _word(self, word: str) -> tuple[int, ...]:
        if len(self.word_ids) > self.cache:
            self.word_ids.clear()
        tokens = self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
        self.word_ids[word] = out = tuple([t.id for t in tokens])
        return out

    def _split(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of pieces that are each led by a space."""
        words = self.words.findall(" " + " ".join(pieces))
        known = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = [self.word_ids.get(w) or self._word(w) for w in known]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))
        number = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        start = (np.cumsum(count) - count)[number]
        per_word = count[number]
        # A piece ends where as many characters are read as it and those before have.
        read = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        ends = np.searchsorted(read, np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)) + 1
        total = np.concatenate(([0], np.cumsum(per_word)))[np.concatenate(([0], ends))]
        return flat[ragged(start, per_word)], np.diff(total)

    def _encode_waiting(self) -> None:
        waiting, old = self.pieces.take()
        counts = np.zeros(len(waiting), np.int64)
        known = np.flatnonzero(old >= 0)
        start, count, ids = self.old
        counts[known] = count[old[known]]
        flat = [ids[ragged(start[old[known]], counts[known])]]
        latin = np.array([p[:1] != _RAW and (p.isascii() or max(p) < LATIN_END) for p in waiting], bool) & (old < 0)
        at = np.flatnonzero(latin)
        if len(at):
            ids, counts[at] = self._split([waiting[i] for i in at])
            flat.append(ids)
        others = np.flatnonzero(~latin & (old < 0))
        texts = [p[1:] if p[:1] == _RAW else " " + p for p in (waiting[i] for i in others)]
        for a in range(0, len(texts), 500):
            part = [e.ids for e in self.tokenizer.encode_batch(texts[a:a + 500], add_special_tokens=False)]
            counts[others[a:a + 500]] = [len(x) for x in part]
            flat.extend(np.array(x, np.uint32) for x in part)
        order = np.concatenate((known, at, others))  # as the ids stand in ``flat``
        start = np.zeros(len(waiting), np.int64)
        start[order] = len(self.flat) + np.cumsum(counts[order]) - counts[order]
        self.start = np.concatenate((self.start, start))
        self.count = np.concatenate((self.count, counts))
        self.flat = np.concatenate((self.flat, *flat))

    def _whole(self, text: str | None) -> np.ndarray | None:
        """The ids of a text that needs no pieces."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.by_rank is None or any(token in text for token in self.added):
            return None
        if not text.isascii() and np.frombuffer(text.encode(), np.uint8).max() >= LATIN_BYTES:
            return None
        if len(text) >= LONG_SPACE and self.long_space.search(text):
            return None
        return self.by_rank.encode_to_numpy(text, disallowed_special=())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts, and where each text's begin (one more entry).
        None counts as an empty text."""
        out = [self._whole(t) for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        if rest:
            ids, first = self._in_pieces([texts[i] for i in rest])
            for k, i in enumerate(rest):
                out[i] = ids[first[k]:first[k + 1]]
        first = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int64)
        return np.concatenate(out) if out else np.zeros(0, np.uint32), first

    def _in_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pieces) > self.cache:
            self._next_generation()
        collecting = gc.isenabled()
        gc.disable()  # the many small tuples below form no cycles
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        numbers, sizes = [], []
        for t in texts:
            n = self._around_added(t) if any(token in t for token in self.added) else self._numbers(t)
            numbers.extend(n)
            sizes.append(len(n))
        if self.pieces.waiting:
            self._encode_waiting()
        at = np.fromiter(numbers, np.int64, len(numbers))
        count = self.count[at]
        ids = self.flat[ragged(self.start[at], count)]
        total = np.concatenate(([0], np.cumsum(count)))
        return ids, total[np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)]
