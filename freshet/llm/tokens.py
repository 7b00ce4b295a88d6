"""Token ids of whole texts by a public word-level BPE, at the speed of a dictionary lookup.

The tokenizer drops white space and never merges across it, so a text's ids are its words' ids in
order. Words are encoded once and remembered; what is remembered is bounded.
"""

from __future__ import annotations

import os
import re
import struct
import sys

END = 1
# Words remembered, and the longest of them: together some 100 MB at most.
MAX_WORDS = 600_000
MAX_BYTES = 64
# Lower-case letters that are composed already, digits and ASCII marks: normalising keeps them, and
# the tokenizer's own pattern comes down to `_PIECE`. Any other word goes through the whole tokenizer.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


_END_OF_WORD = "</w>"
_LAST = b"\xff"


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level BPE stands for: a byte is written as itself if it
    shows, else as one of the letters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.

    Plain words go through the same vocabulary and merges as ranks of byte strings, where a last byte
    that no text has marks the word's end; the tests hold them against the tokenizer's own ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        letters = _byte_letters()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {}
        for token, i in self.tokenizer.get_vocab().items():
            if token not in special:
                stem = token.removesuffix(_END_OF_WORD)
                ranks[bytes(map(letters.__getitem__, stem)) + (_LAST if stem != token else b"")] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            known = _packed(self.merge.encode_single_piece(piece.encode() + _LAST))
            if len(piece) <= MAX_BYTES:
                self.pieces[piece] = known
        return known

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if "<|" not in text and _PLAIN.fullmatch(text):
            ids = b"".join(map(self._piece, _PIECE.findall(text.lower())))
        else:
            ids = _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(word) <= MAX_BYTES:
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(self.words) > MAX_WORDS or len(self.pieces) > MAX_WORDS:
            self.words.clear()
            self.pieces.clear()
        known, word = self.words.get, self._word
        return b"".join([known(w) or word(w) for w in text.encode().split()])


def encoder(path: str) -> Encoder:
    """One per Python worker: loading takes a fifth of a second."""
    kept = sys.__dict__.setdefault("_corpus_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
