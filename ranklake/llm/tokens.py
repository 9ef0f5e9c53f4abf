"""Token ids of whole texts by a byte-level BPE vocabulary, with a cache of words."""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import tiktoken

#: How a byte-level vocabulary of this kind cuts text before it merges. A fixed value.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of ASCII and beyond it, each before a space.
_ASCII_PAIRS = tuple(c + " " for c in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")
_OTHER_PAIRS = tuple(chr(c) + " " for c in range(128, 0x3001) if chr(c).isspace())
_MARKS = frozenset(".,;:!?|")
_WORDS = 250_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_names() -> dict[str, int]:
    """The character that stands for each byte: itself if it prints, else the next unused one from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def added(path: str) -> dict[str, int]:
    """The added tokens of a vocabulary file with their ids. Each stands for itself wherever a text holds it."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)["added_tokens"]
    for token in said:
        if any(token[k] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: {token['content']} takes in what stands beside it")
    return {t["content"]: t["id"] for t in said}


@cache
def _added_pattern(path: str) -> re.Pattern:
    return re.compile("|".join(map(re.escape, sorted(added(path), key=len, reverse=True))) or r"(?!)")


def between(text: str, path: str) -> tuple[list[str], list[str]]:
    """The stretches of a text between added tokens, and the added tokens between them."""
    pattern = _added_pattern(path)
    found = pattern.findall(text)
    return (pattern.split(text), found) if found else ([text], found)


def cuts_at_spaces(text: str) -> bool:
    """Whether a byte-level vocabulary cuts the text before each space: no white space stands before one."""
    return not any(pair in text for pair in (_ASCII_PAIRS if text.isascii() else _ASCII_PAIRS + _OTHER_PAIRS))


@cache
def encoder(path: str) -> tiktoken.Encoding:
    """An encoder for the vocabulary file. Its merges must be listed in the order of the ids they make."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    special = set(added(path))
    names, vocabulary = _byte_names(), said["model"]["vocab"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in said["model"]["merges"]]
    if made != sorted(made):
        raise ValueError(f"the merges of {path} are not in the order of their ids")
    ranks = {bytes(names[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    return tiktoken.Encoding("bytes", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})


class _Words(dict):
    """Ids of pieces of text, as little-endian 32-bit integers, after ``lead``."""

    def __init__(self, encoding: tiktoken.Encoding, lead: str, other: _Words | None = None) -> None:
        self.encoding, self.lead, self.other = encoding, lead, self if other is None else other

    def __missing__(self, piece: str) -> bytes:
        head, newline, tail = piece.partition("\n")
        if head and tail and not head[-1].isspace() and not tail[0].isspace():
            return self[head] + self.other[newline] + self.other[tail]
        marked = piece[-1:] in _MARKS and piece[:-1].isalpha()
        if marked:
            found = self[piece[:-1]] + self.other[piece[-1]]
        else:
            found = np.array(self.encoding.encode_ordinary(self.lead + piece), "<u4").tobytes()
        if len(piece) < (12 if marked else 40):
            if len(self) >= _WORDS:
                self.clear()
            self[piece] = found
        return found


@cache
def _words(path: str) -> tuple[_Words, _Words]:
    first = _Words(encoder(path), "")
    return first, _Words(encoder(path), " ", first)


def token_bytes(text: str, path: str) -> bytes:
    """The ids of a whole text, as little-endian 32-bit integers; an added token in it is its own id."""
    stretches, marks = between(text, path)
    out = _stretch_bytes(stretches[0], path)
    for mark, stretch in zip(marks, stretches[1:]):
        out += added(path)[mark].to_bytes(4, "little") + _stretch_bytes(stretch, path)
    return out


def _stretch_bytes(text: str, path: str) -> bytes:
    """A cut always falls between a character and a space after it, unless that is white space too.
    So where spaces stand alone, the ids of a text are those of its words, in order.
    """
    if not cuts_at_spaces(text):
        return np.array(encoder(path).encode_ordinary(text), "<u4").tobytes()
    first, later = _words(path)
    words = text.split(" ")
    return first[words[0]] + b"".join(map(later.__getitem__, words[1:]))
