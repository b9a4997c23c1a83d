"""Token ids of texts with a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import re
from struct import pack

import numpy as np

from changeflow.llm.common import LOWER

# What a file must say for words to be encoded one by one: white space separates pieces, runs of letters are pieces.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the same for words of visible ASCII characters in lower case
_ASCII_WORD = re.compile(rb"[\x21-\x7e]+")
_ASCII_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# lower-case letters of the Latin alphabets
_LATIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# one of them, then one mark: two pieces
_LETTER_MARK = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])[!-&(-/:-@\[-`{-~]")


def _by_words(spec: dict) -> bool:
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    split, level = pre[0], pre[-1]
    return (
        (spec.get("normalizer") or {}).get("normalizers") == _NORMAL
        and len(pre) == 2
        and split.get("pattern") == {"Regex": _PIECES}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and (level.get("type"), level.get("add_prefix_space"), level.get("use_regex")) == ("ByteLevel", False, False)
        and spec["model"]["type"] == "BPE"
        and not any(t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    )


def _byte_chars() -> list[str]:
    """The characters by which byte-level models write bytes: printable ones themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class TokenIds(dict):
    """Encodes UTF-8 texts to little-endian 16-bit ids.

    Where the file allows it, words between ASCII white space are encoded one by one and remembered, words with marks or digits by
    their pieces. Texts come in many repeated words, so most words cost a look-up. There are two generations of at most about ``limit``
    words: when the young one is full it becomes the old one, and words not seen since the one before are forgotten. Other files encode
    whole texts.
    """

    def __init__(self, path: str, limit: int = 400_000):
        super().__init__()
        self.old: dict[bytes, bytes] = {}
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_words, self.model = _by_words(spec), self.tokenizer.model
        self.marks = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.chars = dict(enumerate(_byte_chars()))

    def _whole(self, text: str) -> bytes:
        ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        if len(ids) and ids.max() > 0xFFFF:
            raise ValueError("the file format holds ids below 65,536")
        return ids.astype("<u2").tobytes()

    def _pieces(self, word: bytes) -> list[bytes]:
        """Pieces of a word, if it can be cut without the library; else the word."""
        if any(m[:2] in word for m in self.marks):
            return [word]
        if _LETTER_MARK.fullmatch(word, max(0, len(word) - 2)) or _LETTER_MARK.fullmatch(word, max(0, len(word) - 3)):
            return [word[:-1], word[-1:]]
        return _ASCII_PIECES.findall(word.translate(LOWER)) if _ASCII_WORD.fullmatch(word) else [word]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._first_seen(word)
        self[word] = ids
        return ids

    def _first_seen(self, word: bytes) -> bytes:
        # a run of Latin letters is one piece, and no normal form or context changes it
        if _LATIN.fullmatch(word):
            ids = [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.chars))]
            return pack(f"<{len(ids)}H", *ids)
        pieces = self._pieces(word)
        if len(pieces) > 1:
            return b"".join(map(self.__getitem__, pieces))
        text = word.decode("utf-8", "replace")
        lower = text.lower().encode()
        return self[lower] if lower != word and _LATIN.fullmatch(lower) else self._whole(text)

    def encode(self, raw: bytes) -> bytes:
        if not self.by_words:
            return self._whole(raw.decode("utf-8", "replace"))
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        # letters may be lowered first, unless that could make a special token of ordinary text
        if not any(m[:2] in raw for m in self.marks):
            raw = raw.translate(LOWER)
        return b"".join(map(self.__getitem__, raw.split()))


_LOADED: dict[str, TokenIds] = {}


def loaded(path: str) -> TokenIds:
    """One encoder for each file and Python worker; a worker is used for many tasks."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]
