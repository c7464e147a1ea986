"""Byte-pair encoding with word ends by backtracking over longest token matches.

Greedy merging by rank gives one result per word. It is the only sequence of tokens in which each
neighbouring pair is compatible, that is, merging the two tokens' bytes together leaves the border
between them. So it can be found from the left: take the longest token that matches, check the pair
with the token before, otherwise try the next shorter token, and step back if none fits. A set of
positions that turned out to be dead ends keeps the work linear.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import regex
from tokenizers import Regex, normalizers, pre_tokenizers

WORD_END = "</w>"
# Up to here all versions of Unicode agree.
BEYOND = regex.compile("[^\x00-\u052f]")
NOT_LATIN = re.compile("[^\x00-\xff]")
# Beyond that, texts are composed by the tokenizers library's own version.
COMPOSED = normalizers.NFC()
# What a Python worker keeps of pairs and of words that it has met: about 20 and 50 MB.
KEPT_PAIRS = 100_000
KEPT_WORDS = 200_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [], 256
    for b in range(256):
        if b in printable:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class Vocabulary:
    """Tokens in order of rank: first the symbols, then one token per merge.

    Words are strings of symbols: chr(b) for a byte, chr(256 + b) for the last byte of a word.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("a BPE vocabulary with word ends is needed")
        number = {letter: b for b, letter in enumerate(byte_letters())}

        def symbols(token: str) -> str:
            body = token.removesuffix(WORD_END)
            last = 256 if body != token else 0
            codes = [number[c] for c in body]
            return "".join(map(chr, codes[:-1])) + chr(codes[-1] + last)

        ids = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        names = [*byte_letters(), *(x + WORD_END for x in byte_letters()), *(a + b for a, b in merges)]
        self.ids = [ids[n] for n in names]
        self.rank = {symbols(n): r for r, n in enumerate(names)}
        if len(self.rank) != len(names):
            raise ValueError("two merges make the same token")
        # The pair each token was merged from (symbols: themselves), and the token of each pair.
        self.parts = [(r, r) for r in range(512)]
        self.merged: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges, 512):
            pair = (self.rank[symbols(a)], self.rank[symbols(b)])
            self.parts.append(pair)
            self.merged[pair] = r
        self.length = [0] * len(names)
        self.shorter = [-1] * len(names)  # the longest token that a token starts with, but itself
        self.matcher = ahocorasick.Automaton()
        for token, r in self.rank.items():
            self.length[r] = len(token)
            self.matcher.add_word(token, r)
            for n in range(len(token) - 1, 0, -1):
                if (prefix := self.rank.get(token[:n])) is not None:
                    self.shorter[r] = prefix
                    break
        self.matcher.make_automaton()
        # Decoding: all tokens one after the other, and where each starts.
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens must match as they are")
        by_id = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.offsets = [0]
        pieces = []
        for i in range(max(by_id) + 1):
            pieces.append(by_id.get(i, "").encode())
            self.offsets.append(self.offsets[-1] + len(pieces[-1]))
        self.bytes = b"".join(pieces)
        self.decoded = [self.token_bytes(i) for i in range(len(self.offsets) - 1)]
        self.names = list(map(str, range(len(self.decoded))))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # White space by its Unicode property, as the tokenizer's own patterns have it.
        self.pattern = split.replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(self.pattern)
        self.latin_words = re.compile(_latin(split))
        self.specials = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        )
        self._compatible: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps the border between two neighbouring tokens."""
        known = self._compatible.get((left, right))
        if known is not None:
            return known
        a, b, limit, result = left, right, len(self.ids), True
        # Undo the merges of both tokens, latest first. A merge across the border that comes
        # before the merge just undone would have happened instead of it.
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < limit:
                result = False
                break
            left_whole, right_whole = self.parts[a][1] == a, self.parts[b][0] == b
            if left_whole and right_whole:  # both are symbols
                break
            if right_whole or (a > b and not left_whole):
                limit, a = a, self.parts[a][1]
            else:
                limit, b = b + 1, self.parts[b][0]
        if len(self._compatible) >= KEPT_PAIRS:
            self._compatible.clear()
        self._compatible[left, right] = result
        return result

    def encode_symbols(self, word: str) -> list[int]:
        """Ranks of the tokens of a word that is given as symbols."""
        whole = self.rank.get(word)
        if whole is not None and whole < 512:
            return [whole]
        n, length, shorter = len(word), self.length, self.shorter
        longest = [-1] * n
        for end, r in self.matcher.iter(word):  # ends rise, so the last match of a start is its longest
            longest[end - length[r] + 1] = r
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        compatible = self.compatible
        while at < n:
            while token >= 0:
                end = at + length[token]
                if not dead[end] and (not out or compatible(out[-1], token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
            else:  # nothing fits here: step back and try a shorter token before
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out

    def encode_word(self, word: str) -> list[int]:
        data = word.encode()
        symbols = data[:-1].decode("latin-1") + chr(256 + data[-1])
        ids = self.ids
        return [ids[r] for r in self.encode_symbols(symbols)]

    def split(self, text: str) -> list[str]:
        """The normalised words of a text without special tokens."""
        known = not BEYOND.search(text)
        text = unicodedata.normalize("NFC", text) if known else COMPOSED.normalize_str(text)
        words = self.words
        if text.isascii() or not NOT_LATIN.search(text):
            words = self.latin_words
        elif not known:
            unlike, unlike_words, unlike_lower = _other_unicode(self.pattern)
            if unlike.search(text):
                text, words = text.translate(unlike_lower), unlike_words
        # Letter by letter, so that a final sigma is like any other.
        return words.findall(text.replace("Σ", "σ").lower())

    def pieces(self, text: str):
        """Words of a text in order; special tokens come as their id."""
        if self.specials is None or not any(s in text for s in self.special):
            return self.split(text)
        out: list[str | int] = []
        for part in self.specials.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self.split(part)
        return out

    def token_bytes(self, token_id: int) -> bytes:
        return self.bytes[self.offsets[token_id] : self.offsets[token_id + 1]]

    def decode(self, ids: list[int]) -> bytes:
        """Tokens joined by a blank, as the vocabulary names no decoder."""
        return b" ".join(map(self.decoded.__getitem__, ids))


def _latin(split: str) -> str:
    """The split pattern for texts of the first 256 characters, which Python's own module matches faster."""
    letters, numbers, spaces = (
        "".join(f"\\x{c:02x}" for c in range(256) if regex.match(kind, chr(c)))
        for kind in (r"\p{L}", r"\p{N}", r"\p{White_Space}")
    )
    for name, own in ((r"[\p{L}]", letters), (r"[\p{N}]", numbers)):
        split = split.replace(name, f"[{own}]")
    return split.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")


@lru_cache(maxsize=4)
def _other_unicode(split: str) -> tuple[regex.Pattern, regex.Pattern, dict[int, str]]:
    """Where the tokenizers library has other letters, numbers or small letters than Python's modules.

    They follow different versions of Unicode. Returns a pattern that finds such characters, the
    split pattern with the library's classes (slower, so only for texts that hold one), and the small
    letters that Python lacks.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    odd, classes = set(), {}
    for name in ("L", "N"):
        matched = pre_tokenizers.Split(Regex(rf"\p{{{name}}}"), "removed").pre_tokenize_str(every)
        theirs = set(every).difference(*(t for t, _ in matched))
        ours = set(regex.findall(rf"\p{{{name}}}", every))
        odd |= theirs ^ ours
        add, drop = (_char_class(x) for x in (theirs - ours, ours - theirs))
        classes[name] = rf"[[\p{{{name}}}{add}]--[{drop}\x00]]"
    lower = normalizers.Lowercase()
    small = {ord(c): t for c in every if c != (t := lower.normalize_str(c)) and t != c.lower() and c != "Σ"}
    unlike = _char_class(odd | set(map(chr, small)))
    # The classes also stand inside others, where a set difference is as good.
    pattern = split.replace(r"\p{L}", classes["L"]).replace(r"\p{N}", classes["N"])
    return regex.compile(f"[{unlike}\ue000]"), regex.compile(pattern, regex.V1), small


def _char_class(chars: set[str]) -> str:
    """Characters as ranges of a character class."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Built once per Python worker."""
    return Vocabulary(path)


class Encoder:
    """Encodes texts; keeps the tokens of words it has seen, up to a limit."""

    def __init__(self, vocab: Vocabulary, limit: int = KEPT_WORDS):
        self.vocab, self.limit = vocab, limit
        self.seen: dict[str | int, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        get, seen = self.seen.get, self.seen
        for piece in self.vocab.pieces(text):
            ids = get(piece)
            if ids is None:
                ids = [piece] if isinstance(piece, int) else self.vocab.encode_word(piece)
                if len(seen) >= self.limit:
                    seen.clear()
                if not isinstance(piece, str) or len(piece) <= 64:
                    seen[piece] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))
