"""Language of whole texts by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The score of a text in a language is the
sum over all ways to write it as pieces, by a forward pass. No piece spans a word's end, so the sum over a text
is the product over its words, and words that occur again come from a bounded cache.

Probabilities are learned by expectation maximisation over the distinct words of a sample: they begin alike for all
languages, falling with a piece's rank in the vocabulary, and are replaced ``ROUNDS`` times by the expected use of the
pieces in all segmentations. The sample takes about
``SAMPLE`` documents of each language (those with the least hash of the id; all, where there are fewer): a language
is a few thousand frequencies, which more text does not change. Each round is one Spark job; what reaches the driver
is one sum per language and piece.

Cases: ``und`` with score 0 for a null text and one without a letter, and for all where nothing was learned. Characters
outside the vocabulary count alike in all languages. Rows that repeat are judged each. Empty table: empty result. No
column but the text enters a prediction.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import pieces
from tidemark.llm.common import written

SAMPLE, ROUNDS, UNDETERMINED = 1000, 2, "und"
_SMOOTH, _UNKNOWN = 0.05, 1e-7
#: Every probability is multiplied by this for each character, so that sums over a word stay in range.
_PER_CHARACTER = 20.0
#: Characters after which a word's sums are scaled anew. One character may weigh as little as 1e-12, be it unknown (2e-6) or
#: unseen in a large sample (1 / its pieces), and so many of them stay in the range of a float.
_STRETCH = 24
_CACHED_WORDS, _CACHED_LENGTH = 400_000, 48
_GROUP_WORDS, _GROUP_NEW = 150_000, 20_000  # words of the texts judged together, and new words summed together
_BETWEEN = "\ud800"  # in no text and no piece
_PLACES = 1 << 6  # more than the places in a word that is judged in step
_LETTER = re.compile(r"[^\W\d_]")


class Segmentations:
    """Sums over the segmentations of words, for probabilities given as one row per language, one column per piece."""

    def __init__(self, model: pieces.PieceModel, probabilities: np.ndarray):
        self.model, self.languages = model, len(probabilities)
        lengths = np.array([len(p) for p, _, _ in model.pieces], float)
        self.scaled = np.ascontiguousarray((probabilities * _PER_CHARACTER**lengths).T)
        self.reach = int(max(len(p) for p in model.ids))
        self.columns: dict[int, list[float]] = {}
        self.cache: dict[str, int] = {}  # place in logs
        self.logs = np.zeros((_CACHED_WORDS, self.languages))
        self.characters = {c for c in model.ids if len(c) == 1}
        self.letters = np.array(sorted(map(ord, self.characters)), np.uint32)
        self.spotter = ahocorasick.Automaton()
        for piece, length, _, number in model.automaton.values():
            self.spotter.add_word(piece, length << 32 | number)
        self.spotter.make_automaton()

    def matches(self, word: str) -> list[tuple[int, int, int]]:
        """(start, end, piece) of all pieces in the word, by end; piece -1 for a character that is none."""
        found = []
        for end, (_, length, _, piece) in self.model.automaton.iter(word):
            found.append((end + 1 - length, end + 1, piece))
        if not self.characters.issuperset(word):
            found += [(k, k + 1, -1) for k, c in enumerate(word) if c not in self.characters]
            found.sort(key=lambda m: m[1])
        return found

    def forward(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """Sums for every prefix (in the scale of its stretch), and the logarithm of the whole, by language."""
        sums = np.zeros((len(word) + 1, self.languages))
        sums[0] = 1
        logs, scaled, unknown, next_scaling = np.zeros(self.languages), self.scaled, _UNKNOWN * _PER_CHARACTER, _STRETCH
        for start, end, piece in self.matches(word):
            if end > next_scaling:  # every prefix has a sum, because every character is a piece or unknown
                last = sums[next_scaling].copy()
                sums[max(0, next_scaling - self.reach) : next_scaling + 1] /= last
                logs += np.log(last)
                next_scaling += _STRETCH
            sums[end] += sums[start] * (scaled[piece] if piece >= 0 else unknown)
        return sums, logs + np.log(sums[-1]) - len(word) * np.log(_PER_CHARACTER)

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(end, start, word, piece) of all pieces in the words, as flat arrays by end and start: one run of the automaton
        over all words, and a radix sort."""
        lengths = np.array([len(w) for w in words])
        text = _BETWEEN.join(words)
        found = np.fromiter(itertools.chain.from_iterable(self.spotter.iter(text)), np.int64).reshape(-1, 2)
        last, length, ids = found[:, 0], found[:, 1] >> 32, found[:, 1] & 0xFFFFFFFF
        letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        strange = np.flatnonzero(~np.isin(letters, self.letters))  # also what stands between words
        strange = strange[letters[strange] != ord(_BETWEEN)]
        if len(strange):
            last, length = np.concatenate([last, strange]), np.concatenate([length, np.ones(len(strange), np.int64)])
            ids = np.concatenate([ids, np.full(len(strange), -1)])
        word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths + 1)[:-1] if len(text) else np.zeros(0, np.int32)
        rows = word_of[last]
        end = last + 1 - (np.cumsum(lengths + 1) - lengths - 1)[rows]
        key = (end * _PLACES + end - length).astype(np.int16)
        order = np.argsort(key, kind="stable")
        return end[order], (end - length)[order], rows[order], ids[order]

    def forward_many(self, words: list[str]) -> np.ndarray:
        """Logarithms of words of ``_CACHED_LENGTH`` characters at most, by language, all words in step."""
        lengths = np.array([len(w) for w in words])
        sums = np.zeros((lengths.max() + 1, len(words), self.languages))
        sums[0] = 1
        ends, starts, rows, ids = self.edges(words)
        weights = self.scaled[ids]
        weights[ids < 0] = _UNKNOWN * _PER_CHARACTER
        logs, next_scaling = np.zeros((len(words), self.languages)), _STRETCH
        cuts = np.flatnonzero((np.diff(ends) != 0) | (np.diff(starts) != 0)) + 1
        for at, to in itertools.pairwise([0, *cuts.tolist(), len(ends)]):
            if at == to:
                continue
            end, start, here = int(ends[at]), int(starts[at]), rows[at:to]
            if end > next_scaling:
                longer = np.flatnonzero(lengths > next_scaling)
                last = sums[next_scaling, longer]
                sums[max(0, next_scaling - self.reach) : next_scaling + 1, longer] /= last
                logs[longer] += np.log(last)
                next_scaling += _STRETCH
            sums[end, here] += sums[start, here] * weights[at:to]
        return logs + np.log(sums[lengths, np.arange(len(words))]) - lengths[:, None] * np.log(_PER_CHARACTER)

    def logs_of(self, texts: list[list[str]]) -> np.ndarray:
        """Logarithms of texts given as their words, by text and language."""
        new = {w for words in texts for w in words if w not in self.cache}
        if len(self.cache) + len(new) > _CACHED_WORDS:
            # Those that came first, the frequent words among them, stay.
            self.cache = {w: k for w, k in self.cache.items() if k < _CACHED_WORDS // 2}
            new = {w for words in texts for w in words if w not in self.cache}
        rest = {w: self.forward(w.replace(" ", pieces.MARK))[1] for w in new if len(w) > _CACHED_LENGTH}
        short = [w for w in new if len(w) <= _CACHED_LENGTH]
        if len(self.cache) + len(short) > len(self.logs):  # one text may have any number of words
            self.logs = np.vstack([self.logs, np.zeros((len(self.cache) + len(short) - len(self.logs), self.languages))])
        for at in range(0, len(short), _GROUP_NEW):
            group = short[at : at + _GROUP_NEW]
            first = len(self.cache)
            self.logs[first : first + len(group)] = self.forward_many([w.replace(" ", pieces.MARK) for w in group])
            self.cache.update(zip(group, range(first, first + len(group))))
        out = np.zeros((len(texts), self.languages))
        for k, words in enumerate(texts):
            out[k] = self.logs[[self.cache[w] for w in words if w not in rest]].sum(0) if rest else self.logs[list(map(self.cache.__getitem__, words))].sum(0)
            if rest:
                out[k] += sum((rest[w] for w in words if w in rest), np.zeros(self.languages))
        return out

    def expected(self, word: str, language: int) -> Counter:
        """How often each piece is used in the word's segmentations, on average by their probability."""
        out, matches = Counter(), self.matches(word)
        ahead, behind = [0.0] * (len(word) + 1), [0.0] * (len(word) + 1)
        ahead[0] = behind[-1] = 1.0
        if language not in self.columns:
            self.columns[language] = self.scaled[:, language].tolist()
        column = self.columns[language]
        weight = [column[p] if p >= 0 else _UNKNOWN * _PER_CHARACTER for _, _, p in matches]
        if len(word) > _STRETCH:  # the same in logarithms
            logs = [math.log(w) for w in weight]
            steps = [(start, end, w) for (start, end, _), w in zip(matches, logs)]
            ahead = _log_sums(steps, len(word), 0)
            behind = _log_sums([(end, start, w) for start, end, w in sorted(steps, key=lambda x: -x[0])], len(word), len(word))
            for (start, end, piece), w in zip(matches, logs):
                if piece >= 0:
                    out[piece] += math.exp(ahead[start] + w + behind[end] - ahead[-1])
            return out
        for (start, end, _), w in zip(matches, weight):
            ahead[end] += ahead[start] * w
        for (start, end, _), w in sorted(zip(matches, weight), key=lambda x: -x[0][0]):
            behind[start] += behind[end] * w
        for (start, end, piece), w in zip(matches, weight):
            if piece >= 0:
                out[piece] += ahead[start] * w * behind[end] / ahead[-1]
        return out


_loaded: dict[tuple[str, bytes], Segmentations] = {}


def loaded(path: str, probabilities: np.ndarray) -> Segmentations:
    """One scorer, with the words it knows, for each worker process and model; an earlier model's goes."""
    key = path, hashlib.sha256(probabilities.tobytes()).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Segmentations(pieces.loaded(path), probabilities)
    return _loaded[key]


def _log_sums(steps: list[tuple[int, int, float]], size: int, first: int) -> list[float]:
    """Logarithms of the sums over all ways from place ``first`` to each place, by steps (from, to, logarithm of the
    weight) in an order in which a place is reached in full before it is left."""
    sums = [-math.inf] * (size + 1)
    sums[first] = 0.0
    for at, to, w in steps:
        more, have = sums[at] + w, sums[to]
        sums[to] = more if have == -math.inf else max(more, have) + math.log1p(math.exp(-abs(more - have)))
    return sums


def learn(spark: SparkSession, docs: DataFrame, path: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages, and their piece probabilities, from docs (doc_id, text, lang)."""
    taught = docs.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    # Written, so that its size is known when the join is planned and texts stay where they are.
    share = written(taught.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share")), "language-shares")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.loaded(path)
        for batch in batches:
            counts = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.update((lang, word) for word in model.segments(text.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"]
            )

    sampled = taught.join(share, "lang").where(place < F.col("share")).select("lang", "text")
    counted = sampled.mapInArrow(count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = written(counted.repartition(spark.sparkContext.defaultParallelism), "language-words")  # few rows, much work for each
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    place_of, model = {lang: k for k, lang in enumerate(languages)}, pieces.loaded(path)
    ranked = sorted(model.ids.values(), key=lambda i: -model.pieces[i][1])
    probabilities = np.zeros((len(languages), len(model.pieces)))
    probabilities[:, ranked] = 1 / (10 + np.arange(len(ranked)))
    probabilities /= probabilities.sum(1, keepdims=True)
    for _ in range(rounds):

        def use(batches: Iterator[pa.RecordBatch], now=probabilities) -> Iterator[pa.RecordBatch]:
            sums, used = Segmentations(pieces.loaded(path), now), Counter()
            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    lang = place_of[lang]
                    for piece, k in sums.expected(word.replace(" ", pieces.MARK), lang).items():
                        used[lang, piece] += n * k
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in used], pa.int32()), pa.array([k[1] for k in used], pa.int32()), pa.array(list(map(float, used.values())), pa.float64())], names=["lang", "piece", "n"]
            )

        used = words.mapInArrow(use, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        counts = np.zeros((len(languages), len(model.pieces)))
        counts[:, ranked] = _SMOOTH
        for row in used.toLocalIterator():  # one for each language and piece at most
            counts[row.lang, row.piece] += row.n
        probabilities = counts / np.maximum(counts.sum(1, keepdims=True), 1e-9)
    return languages, probabilities


def identify(spark: SparkSession, docs: DataFrame, teaches: Column, model_path: str | None = None, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs`` (doc_id, text, lang); rows where ``teaches`` holds are learned
    from. The score is the probability of the language given the text, all languages being alike beforehand."""
    path = model_path or pieces.default_path()
    languages, probabilities = learn(spark, docs.where(teaches), path, sample)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = loaded(path, probabilities)
        for batch in batches:
            names, scores = [UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows
            rows, texts, held = [], [], 0

            def judge() -> None:
                for row, logs in zip(rows, sums.logs_of(texts)):
                    best = int(logs.argmax())
                    names[row], scores[row] = languages[best], float(1 / np.exp(logs - logs[best]).sum())

            for row, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                if languages and _LETTER.search(text):
                    rows.append(row), texts.append(sums.model.segments(text))
                    held += len(texts[-1])
                if held >= _GROUP_WORDS:
                    judge()
                    rows, texts, held = [], [], 0
            judge()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(judged, "doc_id bigint, lang_pred string, score double")
