"""A worker's table of words met before, bounded by bytes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ENTRY = 200  # bytes of a dictionary's place and of the heads of key and value


class WordTable:
    """Words and their ids in two generations.

    A full young generation becomes the old one, and the one before that goes; a word that is met in the old one moves
    up. So frequent words stay, and both generations together hold at most about twice ``limit`` bytes.
    """

    def __init__(self, limit: int, longest: int = 64) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size, self.limit, self.longest = 0, limit, longest

    def get(self, word: str) -> bytes | None:
        ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is not None:
                self.put({word: ids})
        return ids

    def put(self, own: dict[str, bytes]) -> None:
        """Words longer than ``longest`` characters are not kept."""
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0
        length = sum(map(len, own))
        if length > self.longest and max(map(len, own)) > self.longest:
            own = {word: ids for word, ids in own.items() if len(word) <= self.longest}
            length = sum(map(len, own))
        self.young.update(own)
        self.size += ENTRY * len(own) + length + sum(map(len, own.values()))

    def all(self, words: Sequence[str], learn: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of all words, in order; ``learn`` gives those of words not met before."""
        found = list(map(self.young.get, words))
        if None not in found:
            return found
        missing = list({word for word, ids in zip(words, found, strict=True) if ids is None})
        older = list(map(self.old.get, missing))
        own = {word: ids for word, ids in zip(missing, older, strict=True) if ids is not None}
        new = [word for word, ids in zip(missing, older, strict=True) if ids is None]
        own.update(zip(new, learn(new) if new else [], strict=True))
        for at in range(0, len(missing), 10_000):  # a full table turns over between the parts
            self.put({word: own[word] for word in missing[at : at + 10_000]})
        return [own[word] if ids is None else ids for word, ids in zip(words, found, strict=True)]

    def ids(self, coded: pa.DictionaryArray, learn: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words behind one another, and where each word's ids end; distinct words are looked up once."""
        found = self.all(coded.dictionary.to_pylist(), learn)
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(length) - length
        code = coded.indices.to_numpy(zero_copy_only=False)
        own = length[code]
        ends = np.cumsum(own)
        kind = np.int32 if not len(ends) or ends[-1] < 1 << 31 else np.int64
        place = np.repeat((start[code] - (ends - own)).astype(kind), own)
        place += np.arange(len(place), dtype=kind)
        return np.frombuffer(b"".join(found), "<u4")[place], ends


def stretches(texts: pa.Array, most: int) -> list[pa.Array]:
    """Slices of at most ``most`` bytes of text, or of one text."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at, out = np.cumsum(size), 0, []
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        out.append(texts.slice(at, stop - at))
        at = stop
    return out
