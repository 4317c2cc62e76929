"""Token ids in bit-packed files.

Every id takes as many bits as the vocabulary needs. Documents stand in the order of their keys; range partitions by key
give each task a stretch of them, and a task writes files of whole documents: blocks of ``BLOCK_IDS`` ids, the least
significant bits first, then the blocks' offsets, the documents' starts and keys, and a closing header. numpy packs and
unpacks whole blocks, and any range of ids is read from the blocks it touches. A file gets its final name when it is
whole; the manifest, written last by Spark's committer, lists the files that count.

Ids come from the tokenizers library. Pieces of its pattern never run from a character that is no space into a space, so a
text is cut where a space stands before another character, and what is cut is encoded once per worker while its table of
words has room; the first text of every Arrow batch is compared with the library's encoding of the whole.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import posixpath
import re
import struct
import uuid
from array import array
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.llm.wordtable import WordTable, stretches
from fleetwatch.plans.ordering import running_sum

MAGIC = b"IDBLOCKS"
BLOCK_IDS = 4096
ROLL_IDS = 1 << 24
ROLL_DOCS = 1 << 18
TABLE_BYTES = 96 << 20
BLOCK_CHARS = 1 << 20
STRETCH_BYTES = 8 << 20
READ_IDS = 1 << 20
MANIFEST = "file string, part long, number long, docs long, ids long, bytes long, sha256 string"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids behind one another, each in ``bits`` bits, the least significant first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class IdWriter:
    """One file while its documents come."""

    def __init__(self, stream, bits: int, block_ids: int = BLOCK_IDS) -> None:
        self.stream, self.bits, self.block_ids = stream, bits, block_ids
        self.sha, self.size, self.n_ids = hashlib.sha256(), 0, 0
        self.offsets: list[int] = []
        self.starts, self.keys = [0], []
        self.open = np.zeros(0, np.uint32)
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.size += len(data)

    def ids(self, more: np.ndarray) -> None:
        """The next ids of the document that is open."""
        if len(more) and int(more.max()) >> self.bits:
            raise ValueError("an id does not fit the vocabulary's bits")
        self.n_ids += len(more)
        held = np.concatenate([self.open, more])
        whole = len(held) - len(held) % self.block_ids
        for at in range(0, whole, self.block_ids):
            self._block(held[at : at + self.block_ids])
        self.open = held[whole:]

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.size)
        self._put(pack(ids, self.bits))

    def end(self, key: int | None) -> None:
        self.starts.append(self.n_ids)
        self.keys.append(key)

    def close(self) -> dict:
        if len(self.open):
            self._block(self.open)
        tail = self.size
        self._put(np.array(self.offsets, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes())
        self._put(np.array([k or 0 for k in self.keys], "<i8").tobytes())
        self._put(np.array([k is None for k in self.keys], np.uint8).tobytes())
        head = {"bits": self.bits, "block_ids": self.block_ids, "ids": self.n_ids, "docs": len(self.keys), "blocks": len(self.offsets), "tail": tail}
        text = json.dumps(head, sort_keys=True).encode()
        self._put(text + struct.pack("<I", len(text)) + MAGIC)
        return {"docs": len(self.keys), "ids": self.n_ids, "bytes": self.size, "sha256": self.sha.hexdigest()}


class IdFile:
    """Random access to a file's ids and documents."""

    def __init__(self, stream) -> None:
        self.stream = stream
        size = stream.seek(0, io.SEEK_END) if not hasattr(stream, "size") else stream.size()
        length, magic = struct.unpack("<I8s", self._read(size - 12, 12))
        if magic != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of ids")
        head = json.loads(self._read(size - 12 - length, length))
        self.bits, self.block_ids, self.n_ids, self.n_docs = (head[k] for k in ("bits", "block_ids", "ids", "docs"))
        tail = self._read(head["tail"], size - 12 - length - head["tail"])
        at = 8 * head["blocks"]
        self.offsets = np.frombuffer(tail, "<u8", head["blocks"])
        self.starts = np.frombuffer(tail, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.keys = np.frombuffer(tail, "<i8", self.n_docs, at)
        self.null = np.frombuffer(tail, np.uint8, self.n_docs, at + 8 * self.n_docs).astype(bool)

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        data = self.stream.read(n)
        if len(data) != n:
            raise ValueError("a file of ids ends early")
        return data

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, read from the blocks they lie in."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        n = min(self.n_ids, (last + 1) * self.block_ids) - first * self.block_ids
        begin = int(self.offsets[first])
        per_block = (self.block_ids * self.bits + 7) // 8
        whole, rest = divmod(n, self.block_ids)
        data = self._read(begin, whole * per_block + (rest * self.bits + 7) // 8)
        if self.block_ids * self.bits % 8 == 0:
            found = unpack(data, n, self.bits)
        else:  # blocks begin at whole bytes
            cut = [(i * per_block, min(self.block_ids, n - i * self.block_ids)) for i in range(whole + (rest > 0))]
            found = np.concatenate([unpack(data[a : a + per_block], k, self.bits) for a, k in cut])
        return found[start - first * self.block_ids : stop - first * self.block_ids]


class TextCodec:
    """Encoder of one tokenizer file's content, with tables of what it has met before.

    Texts are cut before a space that another character follows. Where many texts are encoded at once they are cut before
    newlines, points and commas too, and those where that would cut a piece of the byte-level pattern, because white space
    follows white space or a mark follows another, are encoded by themselves.
    """

    CUT = re.compile(r" (?=\S)")
    MARKS = "\n.,"
    PLAIN = re.compile(r"([\n.,]?)([A-Za-zÀ-ÖØ-öø-ÿ]*)\Z")

    def __init__(self, content: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library = Tokenizer.from_str(content.decode())
        shape = json.loads(content)
        before, model = shape.get("pre_tokenizer") or {}, shape["model"]
        if shape.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or model.get("type") != "BPE":
            raise ValueError("not a byte-level vocabulary that leaves the text as it is")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or set(" \n") & set(a["content"]) for a in shape.get("added_tokens", [])):
            raise ValueError("an added token reaches over spaces")
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        added = {a["content"] for a in shape.get("added_tokens", [])}
        self.size = max(vocabulary.values()) + 1
        self.octets = np.zeros(self.size, np.int64)
        for token, i in vocabulary.items():
            self.octets[i] = len(token.encode()) if token in added else len(token)
        signs = [*map(chr, range(0xC0, 0x100)), " ", *self.MARKS]
        self.signs = {ord(c): self.library.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in signs}
        self.apart = Tokenizer(self.library.model)  # takes pieces in the vocabulary's own letters, a space between them
        self.apart.pre_tokenizer = WhitespaceSplit()
        self.words, self.units, self.heads = WordTable(TABLE_BYTES // 4), WordTable(TABLE_BYTES), WordTable(TABLE_BYTES // 16)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _heads(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _cut(self, ids: np.ndarray, lengths: list[int]) -> list[bytes]:
        """The ids of texts that were encoded as one, cut where each ends by its number of bytes."""
        ends, wanted = np.cumsum(self.octets[ids]), np.cumsum(lengths)
        at = np.searchsorted(ends, wanted)
        if len(at) and (at[-1] >= len(ends) or (ends[at] != wanted).any()):
            raise ValueError("a piece runs from one word into the next")
        data, stops = ids.tobytes(), (4 * (at + 1)).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words with the space before them, all in one call."""
        joined = [f" {w}" for w in words]
        ids = np.array(self.library.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, "<u4")
        return self._cut(ids, [len(w.encode()) for w in joined])

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of words with the space before them, or with the mark that they begin with; none if white space follows white space."""
        out: list[bytes] = [b""] * len(units)
        plain, pieces, rest, alone = [], [], [], []
        for i, unit in enumerate(units):
            m = self.PLAIN.match(unit)
            if m and unit != "\n" and unit:
                mark, letters = m.groups()
                if not letters.isascii():
                    letters = letters.translate(self.signs)
                space, newline = self.signs[32], self.signs[10]
                plain.append(i)
                pieces.append(space + letters if not mark else (newline if mark == "\n" else mark) + " " * bool(letters) + letters)
            elif unit and unit[0] in ".," or len(unit) > 1 and unit[0] == "\n" and not unit[1].isspace():
                alone.append(i)
            elif unit and not unit[0].isspace():
                rest.append(i)
        groups = [" ".join(pieces[at : at + 200]) for at in range(0, len(pieces), 200)]
        told = [np.array(e.ids, "<u4") for e in self.apart.encode_batch_fast(groups, add_special_tokens=False)]
        parts = self._cut(np.concatenate([np.zeros(0, "<u4"), *told]), [len(p) - (" " in p) for p in pieces])
        for where, found in ((plain, parts), (rest, self._words([units[i] for i in rest]) if rest else []), (alone, self._heads([units[i] for i in alone]))):
            for i, ids in zip(where, found, strict=True):
                out[i] = ids
        return out

    def blocks(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text, block by block."""
        at = 0
        while at < len(text):
            cut = self.CUT.search(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
            end = cut.start() if cut else len(text)
            head, *words = self.CUT.split(text[at:end])
            found = self.heads.all([head], self._heads) if head else []
            yield np.frombuffer(b"".join(found + self.words.all(words, self._words)), "<u4")
            at = end

    def _soft(self, word: str) -> bool:
        """Whether a mark behind the word is a piece of its own: the word ends in a letter or digit."""
        return not word or word[-1] < "\u0530" and word[-1].isalnum()

    def texts(self, texts: pa.Array) -> Iterator[Iterable[np.ndarray]]:
        """For every text (null: empty) its ids in one or more arrays. Words are cut and looked up for many texts at once."""
        for part in stretches(pc.fill_null(texts, ""), STRETCH_BYTES):
            if len(part) == 1:
                yield self.blocks(part[0].as_py())
                continue
            spaced = part
            for mark in self.MARKS:
                spaced = pc.replace_substring(spaced, mark, f" {mark}")
            lists = pc.split_pattern(spaced, " ")
            words, first = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            heads = words.take(pa.array(first[:-1])).to_pylist()
            inner = np.ones(len(words), bool)
            inner[first[:-1]] = False
            coded = pc.dictionary_encode(words.filter(pa.array(inner)))
            ids, ends = self.units.ids(coded, self._units)
            distinct, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            mark = np.array([w[:1] in (".", ",") for w in distinct], bool)[code]
            soft = np.array(list(map(self._soft, distinct)), bool)[code]
            stops = first[1:] - np.arange(1, len(first))  # of each text among the inner words
            begins = np.concatenate([[0], stops[:-1]])
            ends = np.concatenate([[0], ends])
            odd = ends[1:] == ends[:-1]
            odd[1:] |= mark[1:] & ~soft[:-1]
            full = stops > begins
            odd[begins[full]] = odd[begins[full]] & (ends[1:] == ends[:-1])[begins[full]]
            odd[begins[full]] |= mark[begins[full]] & ~np.array(list(map(self._soft, heads)), bool)[full]
            odds = np.concatenate([[0], np.cumsum(odd)])
            found = self.heads.all(heads, self._heads)
            for i, (begin, stop) in enumerate(zip(begins.tolist(), stops.tolist(), strict=True)):
                if odds[stop] > odds[begin]:
                    yield self.blocks(part[i].as_py())
                else:
                    yield np.frombuffer(found[i], "<u4"), ids[ends[begin] : ends[stop]]
            del spaced, lists, words, inner, coded, distinct, code, mark, soft, odd, odds
            pa.default_memory_pool().release_unused()


_CODECS: dict[str, TextCodec] = {}


def _codec(content: bytes) -> TextCodec:
    """The worker's codec, kept from task to task."""
    name = hashlib.sha256(content).hexdigest()
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = TextCodec(content)
    return _CODECS[name]


def _place(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1)


def write_ids(
    docs: DataFrame, folder: str, tokenizer_file: str, key: str = "doc_id", text: str = "text", end_id: int | None = 2,
    block_ids: int = BLOCK_IDS, roll_ids: int = ROLL_IDS,
) -> DataFrame:
    """Encodes every text, writes the files to ``folder`` (any address pyarrow and Spark both know), returns the manifest.

    Documents ascend by key (whole numbers, null first), equal keys by the text's hash; rows that repeat are documents of
    their own, so a frequent key is cut anywhere. Null and empty texts have the end id alone. Very long texts are encoded
    block by block; a document lies in one file. An empty table gives an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    name = lambda c: F.col(f"`{c.replace('`', '``')}`")
    slim = docs.select(name(key).cast("long").alias("key"), name(text).alias("text"))
    order = ["key", F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = slim.select("key", "text", *[c.alias(f"_{i}") for i, c in enumerate(order[1:])])
    ordered = rows.repartitionByRange("key", "_0", "_1").sortWithinPartitions("key", "_0", "_1").select("key", "text")
    target = _place(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        codec = _codec(sent.value)
        bits = max(1, (max(codec.size, (end_id or 0) + 1) - 1).bit_length())
        last = np.array([] if end_id is None else [end_id], "<u4")
        store, path = fs.FileSystem.from_uri(target)
        part, files, out = TaskContext.get().partitionId(), [], None

        def close() -> None:
            told = out.close()
            out.stream.close()
            final = f"ids-{part:08d}-{len(files):05d}.bin"
            store.move(temp, posixpath.join(path, final))
            files.append({"file": final, "part": part, "number": len(files)} | told)

        for batch in batches:
            texts = batch.column("text")
            for i, (k, blocks) in enumerate(zip(batch.column("key").to_pylist(), codec.texts(texts), strict=True)):
                if out is None:
                    store.create_dir(path, recursive=True)
                    temp = posixpath.join(path, f"_temporary-{uuid.uuid4().hex}")
                    out = IdWriter(store.open_output_stream(temp, compression=None), bits, block_ids)
                if not i:
                    blocks = list(blocks)
                    if not np.array_equal(np.concatenate([np.zeros(0, "<u4"), *blocks]), codec.whole(texts[i].as_py() or "")):
                        raise ValueError("a text's encoding differs from the library's")
                for block in blocks:
                    out.ids(block)
                out.ids(last)
                out.end(k)
                if out.n_ids >= roll_ids or len(out.keys) >= ROLL_DOCS:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(files, columns=["file", "part", "number", "docs", "ids", "bytes", "sha256"]), preserve_index=False
        )

    manifest = f"{folder.rstrip('/')}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def _each_document(spark: SparkSession, folder: str, schema: str, row) -> DataFrame:
    """Rows that ``row`` makes of (file, number of the document, place of the file's first id), files in parallel."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    placed = running_sum(manifest, [], ["part", "number"], "ids", "_upto")
    files = placed.select("file", "docs", "ids", (F.col("_upto") - F.col("ids")).alias("start"))
    source = _place(folder)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(source)
        names = [f.split(" ")[0] for f in schema.split(", ")]
        for batch in batches:
            for f in batch.itertuples(index=False):
                with store.open_input_file(posixpath.join(path, f.file)) as stream:
                    ids = IdFile(stream)
                    if (ids.n_docs, ids.n_ids) != (f.docs, f.ids):
                        raise ValueError(f"{f.file} is not what its manifest says")
                    at = 0
                    while at < ids.n_docs:  # documents of about READ_IDS ids together
                        stop = max(at + 1, int(np.searchsorted(ids.starts, ids.starts[at] + READ_IDS, "right")) - 1)
                        yield pd.DataFrame(row(ids, at, stop, int(f.start)), columns=names)
                        at = stop

    parts = max(1, manifest.count())
    return files.repartition(parts).mapInPandas(read, schema)


def _key(ids: IdFile, i: int) -> int | None:
    return None if ids.null[i] else int(ids.keys[i])


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files that the manifest lists: key, start (ids of all documents before), ids."""

    def rows(ids: IdFile, at: int, stop: int, before: int) -> list[tuple]:
        first = int(ids.starts[at])
        found = ids.ids(first, int(ids.starts[stop]))
        cut = [(i, int(ids.starts[i]), int(ids.starts[i + 1])) for i in range(at, stop)]
        return [(_key(ids, i), before + a, found[a - first : b - first].astype(np.int32)) for i, a, b in cut]

    return _each_document(spark, folder, "key long, start long, ids array<int>", rows)


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files that the manifest lists: key, start, n_tokens, ids_crc32 (ids as little-endian 32-bit integers)."""

    def rows(ids: IdFile, at: int, stop: int, before: int) -> list[tuple]:
        out, first = [], int(ids.starts[at])
        found = ids.ids(first, int(ids.starts[stop])) if stop - at > 1 else None
        for i in range(at, stop):
            a, b = int(ids.starts[i]), int(ids.starts[i + 1])
            value = 0
            if found is not None:
                value = crc32(found[a - first : b - first].data)
            else:  # one document, which may be long
                for c in range(a, b, READ_IDS):
                    value = crc32(ids.ids(c, min(b, c + READ_IDS)).data, value)
            out.append((_key(ids, i), before + a, b - a, value))
        return out

    return _each_document(spark, folder, "key long, start long, n_tokens long, ids_crc32 long", rows)
