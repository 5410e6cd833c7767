"""Token ids of whole texts under a public tokenizer, fast for one of the word kind."""

from __future__ import annotations

import json
import re
import struct

#: Letters only, ASCII or Latin-1, as UTF-8.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")
#: Marks that may follow a word of letters without changing how it is cut.
_MARKS = b".,!?;:*&%$#|"
#: Words that are remembered, before those of them go that have not come since as many others did.
REMEMBERED = 300_000

# How a tokenizer of the word kind cuts a text, in the terms of its file.
_WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_CUTS = [
    {"type": "Split", "pattern": {"Regex": _WORD_PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def of_word_kind(path: str) -> bool:
    """Whether a tokenizer file lower-cases, lets no token reach over white space, and cuts words as :class:`WordTokens` does."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    cuts, normal, model = told.get("pre_tokenizer") or {}, told.get("normalizer") or {}, told.get("model") or {}
    return (
        normal.get("normalizers") == _WORD_NORMALIZERS
        and cuts.get("pretokenizers") == _WORD_CUTS
        and model.get("type", "BPE") == "BPE"
        and not model.get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] for t in told.get("added_tokens") or [])
    )


def tokens_of(path: str, remembered: int = REMEMBERED) -> WordTokens | PlainTokens:
    """What encodes texts as the tokenizer of this file does: word by word where its kind allows it."""
    return WordTokens(path, remembered) if of_word_kind(path) else PlainTokens(path)


class PlainTokens:
    """Ids as bytes, by the tokenizer's own ``encode`` of the whole text."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)

    def encode(self, text: bytes) -> bytes:
        return _packed(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)


class WordTokens(dict):
    """Ids as bytes (little-endian unsigned 32-bit), the same as of the tokenizer's own ``encode``.

    The tokenizer drops white space and lets no token reach over it, so a text's ids are those of
    its words, one after the other, and a word's ids are looked up once: this is the dictionary of
    words seen.  A new word made of plain letters and marks goes to the tokenizer's model in these
    two parts, as the tokenizer itself would cut it; every other word goes through the whole
    tokenizer.  A file of another kind is refused.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import pre_tokenizers

        if not of_word_kind(path):
            raise ValueError(f"{path} is no tokenizer of the word kind")
        super().__init__()
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        # how the tokenizer spells the bytes of a letter beyond ASCII for its model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {b: spelt for c in map(chr, range(0xC0, 0x100)) for b, spelt in zip(c.encode(), spell(c)[0][0], strict=True)}
        self.parts: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.remembered = remembered

    def encode(self, text: bytes) -> bytes:
        if len(self) > self.remembered:
            self.older, self.parts = dict(self), {b"": b""}
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.older.get(word)) is not None:
            self[word] = ids
            return ids
        letters = word.rstrip(_MARKS)
        if letters.isalpha() or not letters or _LETTERS.match(letters):
            ids = self._part(letters.lower()) + self._part(word[len(letters) :])
        else:
            ids = _packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def _part(self, part: bytes) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            text = part.decode() if part.isascii() else part.decode().lower().encode().decode("latin-1").translate(self.spelling)
            ids = self.parts[part] = _packed([t.id for t in self.model.tokenize(text)])
        return ids


def _tokenizer(path: str):
    """The tokenizer of a file, without the cutting and padding that the file may ask for."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
