"""Language identification by unigram pieces, marginalised over segmentations.

A word is a run of letters with a word-start mark in front (what follows ``RUN`` letters without a break is a further word,
which bounds the memory that a run of any length takes). Its probability in a language is the sum over all ways to cut it
into vocabulary pieces, each piece with its probability in that language; a character outside the vocabulary is a piece of
its own. The forward recursion computes that sum for a whole block of words of equal length at once, scaled every few
characters so that long words stay within a double. A text's log probability is the sum over its words.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.common import uniform
from fleetwatch.session import settled

MARK = "▁"
RUN = 4096
RESCALE = 8  # characters; the least probability of a piece to this power, and a piece's length more, stays a double
LETTERS = regex.compile(r"\p{L}{1,%d}" % RUN)
FLOOR = 1e-9
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BLOCK_CHARS = 2_000_000
CACHE_WORDS = 300_000


@dataclass
class Vocabulary:
    """Hashes of the pieces, sorted; piece ``i`` is the i-th hash, ``unknown`` follows, then ``none``."""

    hashes: np.ndarray
    longest: int

    @property
    def unknown(self) -> int:
        return len(self.hashes)

    @property
    def none(self) -> int:
        return len(self.hashes) + 1


def _hash(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of code points."""
    h = np.zeros(codes.shape[0], np.uint64)
    for j in range(codes.shape[1]):
        h = h * MULTIPLIER + codes[:, j]
    return h


def load_vocabulary(model_file: str) -> Vocabulary:
    """The normal pieces of a public sentencepiece vocabulary that hold letters only."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
    wanted = regex.compile(f"{MARK}?\\p{{L}}*")
    pieces = {
        processor.id_to_piece(i).lower()
        for i in range(processor.get_piece_size())
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))
    }
    by_length: dict[int, list[str]] = {}
    for piece in pieces:
        if piece and len(piece) <= RUN and wanted.fullmatch(piece):
            by_length.setdefault(len(piece), []).append(piece)
    hashes = np.unique(np.concatenate([_hash(_codes(group, n)) for n, group in by_length.items()]))
    return Vocabulary(hashes, max(by_length))


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)


def _lattice(words: list[str], vocabulary: Vocabulary) -> list[np.ndarray]:
    """For each piece length l from 1, the piece that starts at each place of each word (``none`` if no piece does)."""
    codes = _codes(words, len(words[0]))
    n = codes.shape[1]
    h = np.zeros_like(codes)
    table = vocabulary.hashes
    out = []
    for length in range(1, min(n, vocabulary.longest) + 1):
        starts = n - length + 1
        h = h[:, :starts] * MULTIPLIER + codes[:, length - 1 : length - 1 + starts]
        at = np.searchsorted(table, h.ravel()).reshape(h.shape)
        at[at == len(table)] = 0
        out.append(np.where(table[at] == h, at, vocabulary.unknown if length == 1 else vocabulary.none).astype(np.int32))
    return out


def _forward(lattice: list[np.ndarray], probs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | float]]:
    """For i from 0: summed probability of all segmentations of the first i characters, per word and language.

    Each is a pair whose value times exp(scale) is that sum.
    """
    words, n = lattice[0].shape
    window: list[np.ndarray] = [np.ones((words, probs.shape[1]))]
    scale: np.ndarray | float = 0.0
    yield window[0], scale
    for i in range(1, n + 1):
        total = np.zeros_like(window[0])
        for length in range(1, min(i, len(lattice)) + 1):
            total += window[-length] * probs[lattice[length - 1][:, i - length]]
        window = [*window[-len(lattice) + 1 :], total] if len(lattice) > 1 else [total]
        if i % RESCALE == 0 and i < n:
            scale = scale + np.log(total)
            window = [w / total for w in window]
        yield window[-1], scale


def _log_sums(words: list[str], vocabulary: Vocabulary, probs: np.ndarray) -> np.ndarray:
    """Log probability of each marked word in each language; words of equal length."""
    for value, scale in _forward(_lattice(words, vocabulary), probs):  # noqa: B007
        pass
    return np.log(value) + scale


def _expected(words: list[str], counts: np.ndarray, probs: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Expected number of uses of each piece in words of one language (one column of ``probs``)."""
    lattice = _lattice(words, vocabulary)
    alpha = list(_forward(lattice, probs))
    n = lattice[0].shape[1]
    whole, whole_scale = alpha[n]
    used = np.zeros(probs.shape[0])
    after = [np.ones((len(words), 1))]  # of the places behind, the nearest last, all with one scale
    scale: np.ndarray | float = 0.0
    for i in range(n - 1, -1, -1):
        total = np.zeros((len(words), 1))
        value, own = alpha[i]
        exponent = own + scale - whole_scale
        weight = value / whole * (np.exp(exponent) if np.ndim(exponent) else 1.0)
        for length in range(1, min(n - i, len(lattice)) + 1):
            pieces = lattice[length - 1][:, i]
            part = probs[pieces] * after[-length]
            total += part
            used += np.bincount(pieces, (weight * part)[:, 0] * counts, minlength=len(used))
        after = [*after[-len(lattice) + 1 :], total] if len(lattice) > 1 else [total]
        if (n - i) % RESCALE == 0:
            scale = scale + np.log(total)
            after = [a / total for a in after]
    return used


def _by_length(words: list[str]) -> Iterator[list[str]]:
    """Blocks of words of equal length, none too large for memory."""
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    for length, group in groups.items():
        step = max(1, 100_000 // length)
        for i in range(0, len(group), step):
            yield group[i : i + step]


class Scorer:
    """Log probabilities of texts per language; words met often are kept in a table of bounded size."""

    def __init__(self, vocabulary: Vocabulary, probs: np.ndarray) -> None:
        self.vocabulary, self.probs = vocabulary, probs
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, self.probs.shape[1]))

    def _learn(self, words: list[str]) -> None:
        need = len(self.index) + len(words)
        if need > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((need, self.probs.shape[1]))])
        for group in _by_length(words):
            rows = np.arange(len(self.index), len(self.index) + len(group))
            self.table[rows] = _log_sums([MARK + w for w in group], self.vocabulary, self.probs)
            self.index.update(zip(group, rows.tolist(), strict=True))

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """One row per text: log probability per language; NaN for a text without a letter."""
        out = np.full((len(texts), self.probs.shape[1]), np.nan)
        for first, part in _blocks(texts):
            if len(self.index) > CACHE_WORDS:
                self._reset()
            split = [LETTERS.findall(t) for t in part]
            self._learn([w for w in {w for words in split for w in words} if w not in self.index])
            for k, words in enumerate(split, first):
                if words:
                    index = self.index
                    total = self.table[[index[w] for w in words]].sum(axis=0)
                    out[k] = total if np.isnan(out[k, 0]) else out[k] + total
        return out


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive lower-cased texts of bounded total length; a longer text comes in parts cut between words."""
    first, part, size = 0, [], 0
    for k, text in enumerate(texts):
        text = (text or "").lower()
        if size + len(text) > BLOCK_CHARS and part:
            yield first, part
            part, size = [], 0
        if not part:
            first = k
        while len(text) > BLOCK_CHARS:
            cut = regex.compile(r"\P{L}").search(text, BLOCK_CHARS)
            end = cut.start() if cut else len(text)
            yield k, [text[:end]]
            text = text[end:]
        part.append(text)
        size += len(text)
    if part:
        yield first, part


@dataclass
class Model:
    languages: list[str]
    probs: np.ndarray
    vocabulary: Vocabulary


def fit(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", lang: str = "lang", key: str = "doc_id",
    fit_rows: int = 3000, rounds: int = 3, smoothing: float = 0.1,
) -> Model:
    """Piece probabilities per language by expectation maximisation.

    The sample is bounded: about ``fit_rows`` different labelled texts of each language, chosen by a hash of key and text;
    texts that repeat count as often. The model has (languages x pieces) numbers, which is what reaches the driver. Rows with null text or lang teach nothing; without
    any labelled row the model has no language.
    """
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), uniform(F.col(key), F.col(text), F.lit("fit")).alias("u")
    )
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((vocabulary.none + 1, 0)), vocabulary)
    limit = F.create_map(*[F.lit(x) for k in languages for x in (k, fit_rows / sizes[k])])
    sample = labelled.where(F.col("u") < limit[F.col("lang")]).groupBy("lang", "text").agg(F.count(F.lit(1)).alias("rows"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for one, body, rows in zip(batch["lang"], batch["text"], batch["rows"], strict=True):
                for w, n in Counter(LETTERS.findall(body.lower())).items():
                    counts[one, w] += n * rows
            yield pd.DataFrame([(a, b, n) for (a, b), n in counts.items()], columns=["lang", "word", "n"])

    words = settled(
        sample.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "langid-words",
    )
    probs = np.full((vocabulary.none + 1, len(languages)), 1.0 / vocabulary.none)
    place = {one: i for i, one in enumerate(languages)}
    for _ in range(rounds):
        probs[vocabulary.none] = 0.0
        sent = words.sparkSession.sparkContext.broadcast((vocabulary, probs, place))

        def expect(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            vocabulary, probs, place = sent.value
            used = np.zeros_like(probs)
            for batch in batches:
                for one, rows in batch.groupby("lang"):
                    weight = dict(zip(rows["word"], rows["n"], strict=True))
                    column = probs[:, place[one] : place[one] + 1]
                    for group in _by_length(list(weight)):
                        counts = np.array([weight[w] for w in group], float)
                        used[:, place[one]] += _expected([MARK + w for w in group], counts, column, vocabulary)
            at, column = np.nonzero(used)
            yield pd.DataFrame({"lang": column, "piece": at, "n": used[at, column]})

        sums = words.mapInPandas(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        found = sums.toArrow()
        used = np.zeros_like(probs)
        used[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
        used = used[: vocabulary.none] + smoothing
        probs[: vocabulary.none] = np.maximum(used / used.sum(axis=0), FLOOR)
        sent.unpersist()
    probs[vocabulary.none] = 0.0
    # The sums of a shuffle come in any order; rounding makes reruns agree in every later digit.
    return Model(languages, np.round(probs, 12), vocabulary)


_SCORERS: dict[str, Scorer] = {}


def predict(col: Column, model: Model) -> Column:
    """Column of structs (lang_pred, score): the likeliest language and its posterior under equal priors.

    Null text, or text without a letter: ``und`` with score 0. Equal probabilities: the language first by code point.
    The text alone is read.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    name = hashlib.sha1(model.probs.tobytes() + "\n".join(model.languages).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        names = np.array([*model.languages, "und"], dtype=object)
        if name not in _SCORERS:  # a worker keeps one table of words from task to task
            _SCORERS.clear()
            _SCORERS[name] = Scorer(model.vocabulary, model.probs)
        for texts in batches:
            if not model.languages:
                yield pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0})
                continue
            logs = _SCORERS[name].texts([t if isinstance(t, str) else None for t in texts])
            none = np.isnan(logs[:, 0])
            logs[none] = 0.0
            best = logs.argmax(axis=1)
            share = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            best[none] = len(model.languages)
            yield pd.DataFrame({"lang_pred": names[best], "score": np.where(none, 0.0, share)})

    return F.pandas_udf(score, "lang_pred string, score double")(col)
