"""Byte-level BPE of the tokenizers library, one call per distinct pre-token.

The library's pre-tokenizer cuts a text by a pattern, and merges never cross a
cut. So texts are cut here by the same pattern, every distinct pre-token is
encoded once by the library, and its ids are kept in a bounded cache per
Python worker.

With ``added``, texts are first cut at the file's added tokens, as the library
as loaded does: each is a pre-token of its own with its own id, and the pattern
sees the pieces between them alone. Without it, added tokens are plain text
(the library's ``encode_special_tokens``).
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

from quayside.llm.piece_codec import Numbers

TOKENIZER = "byte_bpe_50k.json"
CACHE_PRETOKENS = 600_000       # about 200 bytes each
GROUP = 1000                    # pre-tokens given to the library at once
# The characters that stand for bytes in a byte-level vocabulary.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = dict(zip([*_PRINTED, *sorted({*range(256)} - {*_PRINTED})],
                  map(chr, [*_PRINTED, *range(256, 324)]), strict=True))


def written(buffer: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``buffer`` with ``values`` from ``at`` on, twice as large if they don't fit."""
    end = at + len(values)
    if end > len(buffer):
        buffer = np.concatenate([buffer[:at], np.zeros(max(end, 2 * at) - at, buffer.dtype)])
    buffer[at:end] = values
    return buffer


class PretokenCodec:
    kept = CACHE_PRETOKENS

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # one core per Spark task
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"]
        if (cut["type"], cut["add_prefix_space"], cut["use_regex"], spec["normalizer"]) != (
                "ByteLevel", False, True, None):
            raise ValueError("not a plain byte-level tokenizer")
        tokens = spec["added_tokens"] if added else []
        if any(t[k] for t in tokens for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("not plain added tokens")
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not added
        # Leftmost, then longest, as the library finds them.
        self.names = sorted((t["content"] for t in tokens), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, self.names)))
        # Characters after a pre-token that its end depends on, at most.
        self.reach = max([2, *map(len, self.names)])
        # The library's model alone: pre-tokens need no further cut.
        self.bare = Tokenizer(self.library.model)
        self.size = self.library.get_vocab_size()
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self._forget()

    def _forget(self) -> None:
        self._cache = Numbers()                # pre-token -> its place in off
        # Buffers with room to grow; the cache's length says how far off is filled.
        self.flat, self.off = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        for k, name in enumerate(self.names):  # added tokens are no matter of the model
            self._cache[name], self.flat[k] = k, self.library.token_to_id(name)
            self.off[k + 1] = k + 1

    def merged(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per pre-token) by the library, for no added tokens."""
        flat, size = [], []
        for a in range(0, len(pretokens), GROUP):
            group = pretokens[a:a + GROUP]
            printed = [p.encode().decode("latin-1").translate(_BYTES) for p in group]
            found = self.bare.encode(printed, is_pretokenized=True, add_special_tokens=False)
            flat.append(np.array(found.ids, np.int32))
            size.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(group)))
        return np.concatenate(flat), np.concatenate(size)

    def codes(self, pretokens: list[str]) -> np.ndarray:
        """Place of each pre-token's ids: ``flat[off[c]:off[c + 1]]``.

        Good until the next call, which may start the cache afresh.
        """
        if len(self._cache) > self.kept:
            self._forget()
        cache = self._cache
        code = np.fromiter(map(cache.__getitem__, pretokens), np.int64, len(pretokens))
        if cache.fresh:
            ids, size = self.merged(cache.fresh)
            known = len(cache) - len(cache.fresh)
            end = int(self.off[known])
            self.flat = written(self.flat, end, ids)
            self.off = written(self.off, known + 1, end + np.cumsum(size))
            cache.fresh = []
        return code

    def pretokens(self, text: str) -> list[str]:
        """All pre-tokens of a text."""
        if any(name in text for name in self.names):
            return list(self.each(text, 0))
        return self.pattern.findall(text)

    def each(self, text: str, begin: int) -> Iterator[str]:
        """Pre-tokens from a cut at ``begin`` on, one by one."""
        while begin < len(text):
            found = self.added.search(text, begin) if self.names else None
            end = found.start() if found else len(text)
            for match in self.pattern.finditer(text[begin:end]):
                yield match.group()
            if found:
                yield found.group()
                end = found.end()
            begin = end

    def cut(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(pre-tokens of all texts, number of pre-tokens per text)."""
        out: list[str] = []
        ends = [0]
        for t in texts:
            if t:
                out += self.pretokens(t)
            ends.append(len(out))
        return out, np.diff(np.array(ends, np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids per text)."""
        pretokens, count = self.cut(texts)
        code = self.codes(pretokens)
        begin, size = self.off[code], self.off[code + 1] - self.off[code]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self.flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)]
        return flat, np.diff(total[np.concatenate([[0], np.cumsum(count)])])

    def sizes(self, pretokens: list[str]) -> np.ndarray:
        """Number of ids of each pre-token."""
        code = self.codes(pretokens)
        return self.off[code + 1] - self.off[code]


def latin_pattern() -> re.Pattern:
    """The pattern for texts of code points up to U+00FF, for the faster engine
    of the standard library: its classes spelled out for these characters."""
    every = [chr(i) for i in range(256)]
    letters, numbers, spaces = (
        "".join(re.escape(c) for c in every if regex.match(kind, c))
        for kind in (r"\p{L}", r"\p{N}", r"\s"))
    pattern = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]",
                                                f"[^{spaces}{letters}{numbers}]")
    for name, inside in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", spaces)):
        pattern = pattern.replace(name, f"[{inside}]")
    return re.compile(pattern.replace(r"\S", f"[^{spaces}]"))


class LatinCodec(PretokenCodec):
    """The same ids; cuts Latin-1 texts faster and keeps more pre-tokens."""

    kept = 1_200_000

    def __init__(self, path: str, added: bool = False):
        super().__init__(path, added)
        self.latin = latin_pattern()

    def pretokens(self, text: str) -> list[str]:
        if any(name in text for name in self.names):
            return list(self.each(text, 0))
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern.findall(text)
        return self.latin.findall(text)


@functools.lru_cache(maxsize=2)
def latin_codec(name: str = TOKENIZER, added: bool = False) -> LatinCodec:
    return LatinCodec(public_tokenizers.path(name), added)


@functools.lru_cache(maxsize=2)
def codec(name: str = TOKENIZER, added: bool = False) -> PretokenCodec:
    """One codec per Python worker. ``name``: a file of the public tokenizers."""
    return PretokenCodec(public_tokenizers.path(name), added)
