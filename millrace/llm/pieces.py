"""Pre-tokens of a byte-level BPE with word ends, and their ids.

A text of printable ASCII and Latin letters is cut whole by the tokenizer's own pattern, and each
pre-token is looked up or merged by the library's model. Any other text is taken apart at ASCII
white space, which such a tokenizer drops and never merges across; runs that still hold other
characters, or an added token, go through the library as they are. The result is the library's
in every case.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession
from tokenizers import Tokenizer

# The text pipeline of the tokenizer file.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The pattern over the characters of _PLAIN, in lower case. Letters and numbers of this part of
# Unicode are the same in all its versions.
_LETTER = "a-zªµºß-öø-ÿĀ-ſ"
_NUMBER = "0-9²³¹¼½¾"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ſ]*")
# Entries of one generation of a cache; a worker's memory stays bounded.
CACHE_ENTRIES = 100_000


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


_LETTERS = byte_letters()
_BYTES = {chr(c): b for b, c in _LETTERS.items()}


class Recent(dict):
    """Values by key, made on demand, in two generations: keys in use move on, others are forgotten."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Pieces:
    """Cuts runs into pre-tokens and gives the ids of each."""

    def __init__(self, config: str):
        self.library = Tokenizer.from_str(config)
        self.library.no_truncation()
        self.library.no_padding()
        parts = json.loads(config)
        pre = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.known = (
            parts.get("normalizer") == NORMALIZER
            and (pre[0].get("pattern") or {}).get("Regex") == PATTERN
            and pre[1:] == [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
            and not parts.get("post_processor")
        )
        self.added = [t["content"] for t in parts.get("added_tokens") or []]
        if any(not t or t.split() != [t] for t in self.added):
            self.known = False
        self.model = self.library.model

    def cut(self, text: str) -> list[str] | None:
        """The pre-tokens of a text, or None if only the library knows them."""
        if not _PLAIN.fullmatch(text) or any(t in text for t in self.added):
            return None
        # Printable Latin is in NFC by itself; lower() may leave the range.
        low = text.lower()
        return _PIECES.findall(low) if low.isascii() or _PLAIN.fullmatch(low) else None

    def spread(self, text: bytes, piece: Callable, other: Callable) -> list:
        """``piece`` of every pre-token in order, and ``other`` of the ids of runs that only the library knows."""
        whole = text.decode()
        cut = self.cut(whole)
        if cut is not None:
            return list(map(piece, cut))
        found = []
        for run in text.split():
            cut = self.cut(run.decode())
            found += map(piece, cut) if cut is not None else [other(self.encode(run.decode()))]
        return found

    def merge(self, piece: str) -> list[int]:
        """The ids of one pre-token by the model's merges."""
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_LETTERS))]

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


def whole_tokens(config: str) -> frozenset[str]:
    """Proves which vocabulary strings encode alone as one token.

    A string counts only if the library leaves it as it is, takes it as one pre-token and gives
    exactly its own id for it.
    """
    pieces = Pieces(config)
    if not pieces.known:
        return frozenset()
    suffix = pieces.model.end_of_word_suffix or ""
    proved = set()
    for entry, own in pieces.library.get_vocab(with_added_tokens=False).items():
        if not entry.endswith(suffix) or len(entry) == len(suffix):
            continue
        letters = entry[: len(entry) - len(suffix)]
        try:
            text = bytes(_BYTES[c] for c in letters).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if pieces.cut(text) == [text] and pieces.encode(text) == [own]:
            proved.add(text)
    return frozenset(proved)


def load_config(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def share(spark: SparkSession, value):
    """Broadcast a tokenizer's file or vocabulary, whose size is that of the file."""
    return spark.sparkContext.broadcast(value)
