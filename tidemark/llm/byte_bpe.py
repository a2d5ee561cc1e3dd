"""Byte-level BPE ids of whole texts, word by word from a bounded cache.

Pre-tokens of the public pattern never run over white space that follows something else, so a text may be cut in
front of every space or line feed that has a character other than white space before it; the ids of the cut parts,
joined, are the ids of the text. Most words occur many times, and only new ones reach the encoder.

The tokenizer file's added tokens, such as the end-of-text mark, are found in a text first, as the library does by
default; what stands between them is encoded on its own. They are read from the JSON file beside the ranks.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import tiktoken

_CACHED_WORDS, _CACHED_LENGTH = 200_000, 48
#: White space for which the cut is not safe: runs, and kinds other than space and line feed.
_UNSAFE = re.compile(r"[ \n][ \n]|[^\S \n]|[\x1c-\x1f]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens in the JSON file beside the ranks at ``path``; none without such a file."""
    path = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that are not matched as they stand are not supported")
    return {token["content"]: token["id"] for token in added}


class ByteBpe:
    def __init__(self, path: str):
        import public_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}
        self.added = {token: np.asarray([i], "<u4").tobytes() for token, i in added_tokens(path).items()}
        # Of tokens that begin at one place the longest counts.
        self.between = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})") if self.added else None

    def plain(self, text: str) -> bytes:
        return np.asarray(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def _new(self, word: str) -> bytes:
        ids = self.plain(word if word.startswith("\n") else " " + word)
        if len(word) <= _CACHED_LENGTH:
            if len(self.cache) >= _CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def encode_document(self, text: str) -> bytes:
        """Ids as ``encode`` gives them, but for the added tokens in the text, which have their own."""
        if not any(token in text for token in self.added):
            return self.encode(text)
        parts = self.between.split(text)  # every second one is an added token
        return b"".join(self.added[part] if k % 2 else self.encode(part) for k, part in enumerate(parts))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers, all of the text being taken as plain text."""
        if not text:
            return b""
        if _UNSAFE.search(text):
            return self.plain(text)
        words = text.replace("\n", " \n").split(" ")
        known = list(map(self.cache.get, words[1:]))
        if None in known:
            known = [ids if ids is not None else self.cache.get(word) or self._new(word) for word, ids in zip(words[1:], known)]
        return self.plain(words[0]) + b"".join(known)


_loaded: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    """One tokenizer for each worker process."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
