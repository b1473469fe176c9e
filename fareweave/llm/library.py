"""Tokenizers of the tokenizers library, on distinct pieces where their texts are split by a pattern."""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

from fareweave.llm.words import BYTE_LEVEL, PieceIds, free_memory

WHOLE = r"(?s).+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


LETTERS = {b: letter for letter, b in byte_letters().items()}


def settings(path: str) -> tuple[str, list[str], int]:
    """The pattern that cuts texts into pieces the library may encode one by one, special strings, and the number of ids.

    Pieces are independent where nothing normalises the text and the byte-level pattern
    alone splits it; other tokenizers get whole texts.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    special = [t["content"] for t in told.get("added_tokens", [])]
    size = max([*told["model"]["vocab"].values(), *(t["id"] for t in told.get("added_tokens", []))]) + 1
    split = told.get("pre_tokenizer") or {}
    by_piece = (
        told.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in told.get("added_tokens", []))
    )
    return (BYTE_LEVEL, special, size) if by_piece else (WHOLE, [], size)


class LibraryTokenizer:
    """A tokenizer file, in a worker. Ids come as bytes of ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pattern, special, size = settings(path)
        self.dtype = np.uint16 if size <= 2**16 else np.uint32
        self.code = "H" if self.dtype is np.uint16 else "I"
        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = pattern == BYTE_LEVEL
        self.special_ids = {t: self.tokenizer.token_to_id(t) for t in special}
        self.pattern = regex.compile(pattern)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.cache = PieceIds(self.encode_pieces, self.dtype)

    def split(self, text: str) -> list[str]:
        """The pieces of a text; a special string is a piece."""
        if not self.special:
            return self.pattern.findall(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [*self.pattern.findall(text, at, found.start()), found.group()]
            at = found.end()
        return out + self.pattern.findall(text, at)

    def forget(self) -> None:
        """End of a task: drop the cache."""
        self.cache.forget()
        free_memory()

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece. What the pattern has split goes straight to the file's model, byte by byte as its letters."""
        out: list[bytes] = []
        if not self.by_piece:
            for i in range(0, len(pieces), 20_000):
                some = self.tokenizer.encode_batch_fast(pieces[i : i + 20_000], add_special_tokens=False)
                out += [array(self.code, e.ids).tobytes() for e in some]
            return out
        tokenize = self.tokenizer.model.tokenize
        words = [p.encode() for p in pieces]
        letters = b"".join(words).decode("latin-1").translate(LETTERS)
        at = 0
        for piece, word in zip(pieces, words, strict=True):
            end = at + len(word)
            if piece in self.special_ids:
                ids = [self.special_ids[piece]]
            else:
                ids = [t.id for t in tokenize(letters[at:end])]
            out.append(array(self.code, ids).tobytes())
            at = end
        return out


_LOADED: dict[str, LibraryTokenizer] = {}


def library_tokenizer(path: str) -> LibraryTokenizer:
    """The worker's tokenizer for a file."""
    if path not in _LOADED:
        _LOADED[path] = LibraryTokenizer(path)
    return _LOADED[path]
