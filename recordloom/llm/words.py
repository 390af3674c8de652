"""Small helpers for texts inside tasks: token ids with a word cache, slices of bounded size."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator, Sequence, Sized
from itertools import chain, compress, repeat

import numpy as np
import regex

SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ODD = re.compile(r"[\x1c-\x1f]")  # str.split() cuts at these, white space of the tokenizer it is not


def slices(texts: Sequence[Sized], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of texts (or arrays of ids) whose lengths sum to about limit, one at least."""
    a, size = 0, 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > limit:
            yield a, b
            a, size = b, 0
        size += len(text)
    if len(texts) > a:
        yield a, len(texts)


PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")  # fixed value: the tokenizer's own pattern


MARK = " "  # before special tokens; no word holds a space

PROBE = "It's Été, ONE-two\n  x=3.14 (don't) ΣΑΣ naïve_42 tab\there — 日本 and so on..."


def byte_letters() -> dict[int, str]:
    """The usual letter for each byte: printable ones stand for themselves, others follow at U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


END = b"\xff"  # behind a word's bytes; no byte of UTF-8


def _ranked(path: str, letters: dict[int, str]) -> Callable[[bytes], list[int]]:
    """Ids of a word's bytes and END, by a faster library over the file's vocabulary.

    That library joins the neighbours whose union has the least id. It gives the same, since ids follow the
    order of merges (which is checked) and a last letter with its end mark is older than any merge.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, specials = whole["model"], {t["content"] for t in whole["added_tokens"]}
    end, vocab = model["end_of_word_suffix"], model["vocab"]
    byte = {letter: bytes([b]) for b, letter in letters.items()}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    order = [vocab[m.replace(" ", "")] for m in merged]
    if order != sorted(order) or any(vocab[c] > order[0] or vocab[c + end] > order[0] for c in byte):
        raise ValueError(f"{path} has ids out of the order of its merges")
    ranks = {}
    for token, i in vocab.items():
        if token not in specials:
            text, mark = (token[: -len(end)], END) if token.endswith(end) and token != end else (token, b"")
            ranks[b"".join([byte[c] for c in text]) + mark] = i
    own = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    return own._core_bpe.encode_single_piece


class WordIds:
    """Ids of whole texts by a tokenizer that drops white space and never joins across it.

    White-space-separated words are looked up in a cache; a new word is cut by the tokenizer's
    pattern, and only parts that are new reach its model. Words beyond the alphabets for which the
    pattern is sure to agree go through the whole tokenizer. Both caches hold about ``keep`` entries,
    some 200 bytes each; beyond, the words used least go. The ids equal those of encoding the whole text; a
    tokenizer of another normaliser or pattern is refused.
    """

    def __init__(self, path: str, keep: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.keep, self.letters = Tokenizer.from_file(path), keep, byte_letters()
        # the strings of special tokens are tokens of their own as they stand, and ordinary in any other case
        specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if not t.normalized}
        self.specials = {MARK + t: i for t, i in specials.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else re.compile(r"(?!)")
        self.opening = os.path.commonprefix([*specials]) if specials else "\ud800"  # soon found in a text, or in none
        self.tokenizer.encode_special_tokens = True  # for words, which are no special tokens
        self.pieces, self.parts = _ranked(path, self.letters), {}
        self._clear()
        if self.encode([PROBE])[0].tolist() != self.tokenizer.encode(PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{path} does not cut words as this class does")

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.begins, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Keep the more used half of the words; their uses fade."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.keep // 2])
        stay = np.zeros(len(self.uses), bool)
        stay[kept] = True
        self.place = dict(zip(compress(self.place, stay.tolist()), range(len(kept))))
        self.flat, self.lengths, self.uses = self.flat[ragged(self.begins[kept], self.lengths[kept])], self.lengths[kept], self.uses[kept] // 2
        self.begins = np.cumsum(self.lengths) - self.lengths

    def _part(self, part: str) -> bytes:
        return array("I", self.pieces(part.encode() + END)).tobytes()

    def _kept(self, part: str) -> bytes:
        ids = self.parts[part] = self._part(part)
        return ids

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or max(word) < "\u0530"):
            return array("I", self.pieces(word.encode() + END)).tobytes()  # the word itself is kept by its place
        if word in self.specials:
            return array("I", [self.specials[word]]).tobytes()
        if not word.isascii() and max(word) >= "\u0530" or ODD.search(word):
            return self._whole(word)
        parts = self.parts
        return b"".join([parts.get(p) or self._kept(p) for p in PIECE.findall(word)])

    def _learn(self, words: list[str]) -> None:
        if len(self.parts) > self.keep:
            self.parts = {}
        ids = [self._word(w) for w in words]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.begins = np.append(self.begins, len(self.flat) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.flat = np.append(self.flat, np.frombuffer(b"".join(ids), np.uint32))
        self.uses = np.append(self.uses, np.zeros(len(words), np.int64))

    @staticmethod
    def _split(text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        text = text.lower()
        return SPACE.split(text) if ODD.search(text) else text.split()

    def _around(self, text: str) -> list[str]:
        """Words of a text with special tokens."""
        return [w for i, piece in enumerate(self.special.split(text)) for w in ([MARK + piece] if i % 2 else self._split(piece))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.place) > self.keep:
            self._shrink()
        words = [self._around(t) if self.opening in t and self.special.search(t) else self._split(t) for t in texts]
        at = np.fromiter(map(self.place.get, chain.from_iterable(words), repeat(-1)), np.int64)
        new = at < 0
        if new.any():
            missing = list(compress(chain.from_iterable(words), new.tolist()))
            self._learn(list(dict.fromkeys(missing)))
            at[new] = np.fromiter(map(self.place.__getitem__, missing), np.int64, len(missing))
        self.uses += np.bincount(at, minlength=len(self.uses))
        ids = self.flat[ragged(self.begins[at], self.lengths[at])]
        ends = np.concatenate([[0], np.cumsum(self.lengths[at])])[np.cumsum([0] + [len(w) for w in words])]
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


def ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices begins[0] .. begins[0]+lengths[0]-1, begins[1] .., and so on."""
    total = int(lengths.sum())
    shift = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)
