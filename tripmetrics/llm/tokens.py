"""Token ids of a whole text, with each blank-separated part looked up in a bounded table."""

from __future__ import annotations

import base64
import json
import re
import struct

from functools import lru_cache

import numpy as np

#: Pattern that cuts a text before the merges of the byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A blank between two visible characters always starts a new match of PATTERN: no match holds
#: a blank past its first character unless it is white space throughout.
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")


class _BesideSpace(Exception):
    """A blank that does not stand between two visible characters."""


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes of each token by its rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def library_encoding(path: str):
    import tiktoken

    return tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={}
    )


def read_added(path: str) -> dict[str, int]:
    """Ids of the added tokens of a ``tokenizers`` file, by their strings."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token[rule] for rule in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']!r} is not taken literally")
    return {token["content"]: token["id"] for token in added}


class PartEncoder:
    """Ids of texts as little-endian 32-bit integers.

    The strings of added tokens are cut out of a text first, and what is between is encoded by itself.

    Text is cut at blanks that stand between two visible characters. Parts recur, so their ids are
    remembered in a table of at most ``entries`` short parts, which starts anew when it is full.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None, entries: int = 400_000, longest: int = 48):
        self._added = {token: np.uint32(k).astype("<u4").tobytes() for token, k in (added or {}).items()}
        by_length = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(by_length)})").split if by_length else None
        self._encode = library_encoding(path).encode_ordinary
        self._entries = entries
        self._longest = longest
        self._known: dict[str, bytes] = {}

    def _bytes(self, text: str) -> bytes:
        ids = self._encode(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, part: str) -> bytes:
        if not part or part[0].isspace() or part[-1].isspace():
            raise _BesideSpace
        ids = self._bytes(" " + part)
        if len(part) <= self._longest:
            if len(self._known) >= self._entries:
                self._known.clear()
            self._known[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self._cut is None:
            return self._plain(text)
        pieces = self._cut(text)  # text and added tokens in turn
        if len(pieces) == 1:
            return self._plain(text)
        return b"".join([self._added[p] if k % 2 else self._plain(p) for k, p in enumerate(pieces)])

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        # Most texts have lone blanks only, which shows when their parts are looked up.
        if "  " not in text and "\n " not in text:
            try:
                return self._joined(text.split(" "))
            except _BesideSpace:
                pass
        return self._joined(_LONE_BLANK.split(text))

    def _joined(self, parts: list[str]) -> bytes:
        """Ids of parts that one blank each stood between; only the first may begin, and the last end, with space."""
        first, last = parts[0], parts[-1]
        if len(parts) == 1:
            return self._bytes(first)
        if not first or first[-1].isspace() or not last or last[0].isspace():
            raise _BesideSpace
        known, learn = self._known.get, self._learn
        ids = list(map(known, parts))
        ids[0] = self._bytes(first)
        if last[-1].isspace():
            ids[-1] = self._bytes(" " + last)
        if None in ids:
            ids = [found or known(part) or learn(part) for found, part in zip(ids, parts)]
        return b"".join(ids)


@lru_cache(maxsize=4)
def part_encoder(path: str, vocabulary: str | None = None) -> PartEncoder:
    """One encoder for each Python worker and vocabulary; ``vocabulary`` names the file with added tokens."""
    return PartEncoder(path, read_added(vocabulary) if vocabulary else None)
