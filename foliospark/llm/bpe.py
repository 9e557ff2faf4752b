"""Exact byte-pair encoding in linear time by backtracking over longest matches.

A greedy longest match is not what byte-pair merging yields, yet every merging result is a chain of
tokens in which each neighbouring pair is *compatible*: merging the two tokens' bytes alone gives the
same two tokens again. So the encoder walks the text with the longest token at each position (found
for all positions in one Aho-Corasick pass), keeps it if it is compatible with the token before it,
else tries the next shorter token that is a prefix of it, and steps back where none fits; positions
that were given up are never visited again, which bounds the work by the text's length times the
(constant) number of prefixes of a token.

Compatibility needs no text: it follows from undoing the merges that made the two tokens, last merge
first, and looking whether a merge across the border would have come earlier. Results are memoised
in the pair table. The decoder is an offset table into one byte string.
"""

from __future__ import annotations

import base64
import functools
from itertools import chain

import ahocorasick
import numpy as np
import regex

#: The pre-tokenizer of the 50k byte-level vocabularies (fixed by the vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries after which a worker's memo of encoded chunks is emptied; bounds its memory, not the result.
MEMO_CHUNKS = 400_000
#: Chunks longer than this are encoded without being remembered.
MEMO_LENGTH = 64


class Bpe:
    """Encoder and decoder for a rank file: lines of base64 token and rank."""

    def __init__(self, path: str, pattern: str = SPLIT) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.ids = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens: dict[int, str] = {rank: token for token, rank in self.ids.items()}
        self.words = regex.compile(pattern)
        # A single space between two characters that are no space always begins a new pre-token.
        self.loose = regex.compile(r"[\s\x1c-\x1f\x85] | [\s\x1c-\x1f\x85]|^ | $")
        self.cuts = regex.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ids.items():
            self.automaton.add_word(token, (len(token), rank))
        self.automaton.make_automaton()
        self.shorter_of: dict[int, int] = {}
        self.parts_of: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        top = max(self.tokens) + 1
        lengths = np.zeros(top + 1, np.int64)
        for rank, token in self.tokens.items():
            lengths[rank + 1] = len(token)
        self.offsets = np.cumsum(lengths)
        self.bytes = b"".join(self.tokens.get(i, "").encode("latin-1") for i in range(top))

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of `token`; -1 if there is none."""
        found = self.shorter_of.get(token)
        if found is None:
            text, found = self.tokens[token], -1
            for n in range(len(text) - 1, 0, -1):
                if (t := self.ids.get(text[:n])) is not None:
                    found = t
                    break
            self.shorter_of[token] = found
        return found

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made `token`; None for a single byte."""
        if token in self.parts_of:
            return self.parts_of[token]
        text, found = self.tokens[token], None
        if len(text) > 1:
            left = self.shorter(token)
            while left >= 0:
                right = self.ids.get(text[len(self.tokens[left]) :])
                if right is not None and left < token and right < token and self.compatible(left, right, token):
                    found = (left, right)
                    break
                left = self.shorter(left)
        self.parts_of[token] = found
        return found

    def compatible(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether merging the bytes of both, one after the other, leaves exactly these two tokens.

        `below` asks about the state before the merge of that rank.
        """
        key = (left, right)
        if below is None and key in self.pairs:
            return self.pairs[key]
        limit, a, b = (below if below is not None else len(self.tokens) + 1), left, right
        verdict = None
        while verdict is None:
            across = self.ids.get(self.tokens[a] + self.tokens[b])
            if across is not None and across < limit and self._is_merge(across, a, b):
                verdict = False
                break
            # Undo the later of the two merges; what is merged across from then on must rank above it.
            pa, pb = self.parts(a), self.parts(b)
            if pa is None and pb is None:
                verdict = True
            elif pb is None or (pa is not None and a > b):
                limit, a = a, pa[1]
            else:
                limit, b = b + 1, pb[0]
        if below is None:
            self.pairs[key] = verdict
        return verdict

    def _is_merge(self, token: int, a: int, b: int) -> bool:
        """Whether merging a and b is a merge that can take place: any two tokens that spell a token."""
        return a < token and b < token

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """The ids of one pre-token."""
        text = piece.encode("utf-8").decode("latin-1")
        whole = self.ids.get(text)
        if whole is not None:
            return (whole,)
        n = len(text)
        longest = [0] * n
        size = [0] * n
        for end, (length, rank) in self.automaton.iter(text):
            at = end - length + 1
            if length > size[at]:
                size[at], longest[at] = length, rank
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        tokens, compatible = self.tokens, self.compatible
        while True:
            end = at + len(tokens[token])
            if alive[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return tuple(out)
                token = longest[at]
                continue
            token = self.shorter(token)
            while token < 0:  # nothing fits here: give the position up and shorten the token before it
                alive[at] = 0
                before = out.pop()
                at -= len(tokens[before])
                token = self.shorter(before)

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        """The ids of a stretch of text that begins and ends at pre-token borders."""
        ids = tuple(chain.from_iterable(map(self.encode_piece, self.words.findall(chunk))))
        if len(chunk) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_CHUNKS:
                self.memo.clear()
            self.memo[chunk] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text, without special tokens; an empty and a null text give an empty list."""
        if not text:
            return []
        pieces = self.cuts.split(text) if self.loose.search(text) else text.split(" ")
        get, slow = self.memo.get, self.encode_chunk
        out: list[int] = []
        extend = out.extend
        first = pieces[0]
        extend(get(first) or slow(first))
        for p in pieces[1:]:
            p = " " + p
            extend(get(p) or slow(p))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids."""
        at = self.offsets
        return b"".join(self.bytes[at[i] : at[i + 1]] for i in ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The encoder of a rank file, made once per worker."""
    return Bpe(path)
