"""Token ids of whole texts by a public tokenizer of the `tokenizers` library.

BPE treats each pre-token alone, so the ids of a text are those of its pre-tokens one after another. Texts repeat their
words: each worker keeps the ids of the pre-tokens that it has met, and asks the library's model for the others. Cutting into
pre-tokens is done here for texts made of Latin letters, ASCII and common punctuation, where Python's and the library's
character classes agree; all other texts, and those that could hold special tokens, go to the library whole. Both ways
give the same ids (tests/llm/test_operators.py).
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-įı-ňŊ-ž"
_BLANK = r"\t\n\x0b\x0c\r "
#: Anything outside the characters for which the fast cut is known to be exact, or a possible special token.
_OTHER = re.compile(rf"[^\x00-\x1b\x20-\x7e¡-¬®-±´-¸»¿{_LETTER}×÷‐-‧€™]|<\|")
#: The same for texts that are ASCII.
_CONTROL = re.compile(r"[\x1c-\x1f\x7f]|<\|")
_SUFFIX = "'(?:[stmd]|re|ve|ll)"
#: The two pre-tokenizers of the public files: byte level with its own pattern, and lower case with word ends. Words, the commonest, are tried
#: first: no other part can begin where they do.
_BYTE_LEVEL = re.compile(rf" ?[{_LETTER}]+| ?[0-9]+|{_SUFFIX}| ?[^{_BLANK}{_LETTER}0-9]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_WORD_END = re.compile(rf"[{_LETTER}]+|[0-9]|{_SUFFIX}|[^{_BLANK}{_LETTER}0-9]+")
_BYTE_LEVEL_CONF = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: Byte-level models see each byte as a printable character: the printable ones of Latin-1 as themselves, others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BLANK_SHOWN = chr(_SHOWN[32])
_PACK = [struct.Struct(f"<{n}I").pack for n in range(65)]


class _Memo(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers. Two generations of at most `limit` pre-tokens: those
    in use move from the old one to the new one."""

    def __init__(self, model, limit: int):
        super().__init__()
        self.model, self.limit, self.old = model, limit, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            if piece.isascii() and piece.isprintable():  # all but the blank are shown as themselves
                shown = piece.replace(" ", _BLANK_SHOWN)
            else:
                shown = piece.encode("utf-8").decode("latin-1").translate(_SHOWN)
            found = [t.id for t in self.model.tokenize(shown)]
            ids = _PACK[len(found)](*found) if len(found) < len(_PACK) else np.array(found, dtype="<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def age(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class Encoder:
    """encode(texts) yields the ids of each whole text as little-endian unsigned 32-bit integers, without special tokens."""

    def __init__(self, path: str, memo: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.memo = _Memo(self.tokenizer.model, memo)
        before, norm, model = conf.get("pre_tokenizer") or {}, conf.get("normalizer"), conf["model"]
        plain = model["type"] == "BPE" and not conf.get("post_processor") and all(a["content"].startswith("<|") for a in conf["added_tokens"])
        self.cut, self.lower = None, False
        if plain and norm is None and before == _BYTE_LEVEL_CONF:
            self.cut = _BYTE_LEVEL.findall
        elif plain and [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in before.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            self.cut, self.lower = _WORD_END.findall, True

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        known = self.memo.__getitem__
        for text in texts:
            if not text:
                yield b""
            elif self.cut is None or (_CONTROL if text.isascii() else _OTHER).search(text):
                yield np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            else:
                yield b"".join(map(known, self.cut(text.lower() if self.lower else text)))
                self.memo.age()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file; Spark reuses its Python workers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
