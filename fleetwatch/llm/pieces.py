"""SentencePiece merge-type encoding and decoding.

Text becomes symbols: a mark in front, a mark for every space. All adjacent pairs that are pieces stand on an agenda
ordered by score, then from left to right; the best pair is merged, its new neighbours join the agenda, and entries whose
symbols have changed since are passed over. Symbols that are no piece become byte pieces. No piece of a vocabulary that
was split at white space holds a mark behind another character, so pairs never cross from a word into the next mark and
each marked word is encoded by itself; a vocabulary without that property is handled as one word per text. Every distinct
word that a worker meets is checked against the sentencepiece library, a whole batch of words in one call, and so is the
first whole text of every Arrow batch.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from fleetwatch.llm.wordtable import WordTable, stretches

MARK = "▁"
WORD_BYTES = 64 << 20
PART_BYTES = 24 << 20
BLOCK_CHARS = 1_000_000
STRETCH_BYTES = 4 << 20


class PieceCodec:
    """Agenda encoder and decoder for one model file's content."""

    def __init__(self, proto: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        p, n = self.library, self.library.get_piece_size()
        self.text = [p.id_to_piece(i) for i in range(n)]
        special = [p.is_control(i) or p.is_unknown(i) or p.is_unused(i) for i in range(n)]
        self.byte = {int(self.text[i][1:-1], 16): i for i in range(n) if p.is_byte(i)}
        self.of_byte = {i: b for b, i in self.byte.items()}
        self.silent = {i for i in range(n) if p.is_control(i)}
        self.id = {self.text[i]: i for i in range(n) if not special[i] and i not in self.of_byte}
        self.rank = {piece: -p.get_score(i) for piece, i in self.id.items()}
        self.bos, self.eos, self.unknown = p.bos_id(), p.eos_id(), p.unk_id()
        if len(self.byte) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        if p.encode(" a  b ", out_type=str) and p.decode(p.encode(" a  b ")) != " a  b ":
            raise ValueError("the vocabulary changes white space")
        apart = not any(MARK in piece.lstrip(MARK) for piece in self.id)
        self.apart = apart
        self.words = re.compile(f"{MARK}+[^{MARK}]*" if apart else "(?s).+")
        self.cut = re.compile(f"(?<=[^{MARK}]){MARK}") if apart else re.compile(r"(?!)")
        self.touching = {pair for piece in self.id for pair in map(str.__add__, piece, piece[1:])}
        self.breaks = not any("\n" in piece for piece in self.id)
        self.known, self.units, self.parts = WordTable(WORD_BYTES // 4), WordTable(WORD_BYTES), WordTable(PART_BYTES)

    def word(self, word: str) -> bytes:
        """Ids of one marked word as 32-bit integers. Where no piece holds two neighbouring characters nothing can merge, so parts between
        such places are encoded by themselves, and parts met before are not encoded again."""
        touching, parts, known = self.touching, [], self.parts.young.get
        start = 0
        for i, pair in enumerate(map(str.__add__, word, word[1:]), 1):
            if pair not in touching:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        out: list[bytes] = []
        for part in parts:
            ids = known(part)
            if ids is None:
                ids = self.parts.get(part)
            if ids is None:
                ids = array("I", self.agenda(part)).tobytes()  # bytes, which Python's garbage collector need not visit
                self.parts.put({part: ids})
                known = self.parts.young.get
            out.append(ids)
        return b"".join(out)

    def agenda(self, part: str) -> list[int]:
        """Ids of one run of characters by the agenda of adjacent pairs."""
        rank, n = self.rank, len(part)
        symbols: list[str] = list(part)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i, pair in enumerate(map(str.__add__, part, part[1:])):
            score = rank.get(pair)
            if score is not None:
                agenda.append((score, i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, merged = heapq.heappop(agenda)
            j = right[i]
            # An entry is stale if one of its symbols has been merged meanwhile.
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != merged:
                continue
            symbols[i], symbols[j] = merged, ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                pair = merged + symbols[k]
                score = rank.get(pair)
                if score is not None:
                    heapq.heappush(agenda, (score, i, pair))
            k = left[i]
            if k >= 0:
                pair = symbols[k] + merged
                score = rank.get(pair)
                if score is not None:
                    heapq.heappush(agenda, (score, k, pair))
        out: list[int] = []
        for symbol in symbols:
            if symbol:
                one = self.id.get(symbol)
                out += [one] if one is not None else [self.byte[b] for b in symbol.encode()]
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ids: byte pieces join to UTF-8, marks are spaces, the first mark goes, begin and end are silent."""
        return self._spaced(ids).removeprefix(" ")

    def _spaced(self, ids: Sequence[int]) -> str:
        parts: list[str] = []
        run = bytearray()
        for i in ids:
            b = self.of_byte.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run.clear()
            if i == self.unknown:
                parts.append(" ⁇ ")
            elif i not in self.silent:
                parts.append(self.text[i].replace(MARK, " "))
        if run:
            parts.append(run.decode("utf-8", "replace"))
        return "".join(parts)

    def _checked(self, words: list[str], theirs: list[Sequence[int]]) -> list[bytes]:
        """Ids of new words, which the library's and the decoded words must equal."""
        out, text = [], self.text.__getitem__
        for word, expected in zip(words, theirs, strict=True):
            ids = self.word(word)
            expected = array("I", expected)
            if ids != expected.tobytes() and word != MARK:  # the library has no ids for the empty text
                raise ValueError(f"encoding of {word!r} differs from the library's")
            if "".join(map(text, expected)) != word and self._spaced(array("I", ids)) != word.replace(MARK, " "):
                raise ValueError(f"decoding of {word!r} does not give the word")
            out.append(ids)
        return out

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of marked words; all of them are checked against the library in one call."""
        return self._checked(words, self.library.encode([w[1:].replace(MARK, " ") for w in words], num_threads=1))

    def _learn_units(self, units: list[str]) -> list[bytes]:
        """Ids of words without their mark, or with the newline that they begin with; none for empty and marked ones."""
        theirs = self.library.encode(units, num_threads=1)
        out = [b""] * len(units)
        good = [i for i, u in enumerate(units) if u and MARK not in u]
        lines = {i for i in good if units[i][0] == "\n" and self.breaks}
        if any(theirs[i][:1] != [self.id[MARK]] for i in lines):
            raise ValueError("a newline is no symbol of its own")
        words = [units[i] if i in lines else MARK + units[i] for i in good]
        for i, ids in zip(good, self._checked(words, [theirs[i][1:] if i in lines else theirs[i] for i in good]), strict=True):
            out[i] = ids
        return out

    def blocks(self, text: str) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian 32-bit integers, and decoded text with the first mark, block by block.

        Every word of a block decodes to itself, as ``_learn`` has made sure, so their texts one behind the other are the
        block.
        """
        if not text:
            return
        text = MARK + text.replace(" ", MARK)
        at = 0
        while at < len(text):
            cut = self.cut.search(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
            end = cut.start() if cut else len(text)
            block = text[at:end] if at or cut else text
            words = self.words.findall(block)
            at = end
            yield b"".join(self.known.all(words, self._learn)), block.replace(MARK, " ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids with begin and end, digest of the ids, digest of the decoded text."""
        ids, plain = hashlib.sha256(self.bos.to_bytes(4, "little")), hashlib.sha256()
        n, first = 2, True
        for data, part in self.blocks(text):
            n += len(data) // 4
            ids.update(data)
            plain.update((part.removeprefix(" ") if first else part).encode())
            first = False
        ids.update(self.eos.to_bytes(4, "little"))
        return n, ids.hexdigest(), plain.hexdigest()

    def digests(self, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
        """``digest`` of every text (null: empty); words are cut and looked up for many texts at once.

        Texts with a mark of their own or a space beside another one, at their begin or end, go one by one.
        """
        begin_id, end_id = self.bos.to_bytes(4, "little"), self.eos.to_bytes(4, "little")
        for part in stretches(pc.fill_null(texts, ""), STRETCH_BYTES):
            if len(part) == 1 or not self.apart:
                yield from map(self.digest, part.to_pylist())
                continue
            spaced = pc.replace_substring(part, "\n", " \n") if self.breaks else part
            lists = pc.split_pattern(spaced, " ")
            stops = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            ids, ends = self.units.ids(pc.dictionary_encode(lists.flatten()), self._learn_units)
            ends = np.concatenate([[0], ends])
            odds = np.concatenate([[0], np.cumsum(ends[1:] == ends[:-1])])
            for i, (begin, stop) in enumerate(zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)):
                text = part[i].as_py()
                if odds[stop] > odds[begin]:
                    yield self.digest(text)
                    continue
                own = ids[ends[begin] : ends[stop]]
                yield len(own) + 2, hashlib.sha256(begin_id + own.tobytes() + end_id).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
            del spaced, lists, ids, ends, odds
            pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> list[int]:
        data = array("I")
        for part, _ in self.blocks(text):
            data.frombytes(part)
        return [self.bos, *data, self.eos]


_CODECS: dict[str, PieceCodec] = {}


def _codec(proto: bytes) -> PieceCodec:
    """The worker's codec, kept from task to task."""
    name = hashlib.sha256(proto).hexdigest()
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = PieceCodec(proto)
    return _CODECS[name]


def _broadcast(model_file: str):
    with open(model_file, "rb") as f:
        return SparkSession.active().sparkContext.broadcast(f.read())


def token_ids(col: Column, model_file: str) -> Column:
    """Column of id arrays with begin and end; null text is empty."""
    sent = _broadcast(model_file)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(sent.value)
        for texts in batches:
            yield pd.Series([codec.encode(t if isinstance(t, str) else "") for t in texts], dtype=object)

    return F.pandas_udf(run, "array<int>")(col)


def token_digests(col: Column, model_file: str) -> Column:
    """Column of structs (n_tokens, ids_sha256, decoded_sha256); null and empty text have the two ids begin and end."""
    sent = _broadcast(model_file)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(sent.value)
        for texts in batches:
            rows = list(codec.digests(texts))
            for text, row in zip(texts[:1].to_pylist(), rows, strict=False):
                ids = codec.library.encode(text or "", add_bos=True, add_eos=True)
                theirs = codec.library.decode(ids)
                expected = len(ids), array("I", ids), theirs
                if row != (expected[0], hashlib.sha256(expected[1].tobytes()).hexdigest(), hashlib.sha256(theirs.encode()).hexdigest()):
                    raise ValueError("a text's encoding differs from the library's")
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            kinds = pa.int64(), pa.string(), pa.string()
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return F.arrow_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")(col)
