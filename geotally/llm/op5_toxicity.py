"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

Words: blank-separated tokens in lower case without anything but letters, between a mark for their start and one for
their end; three or more single characters in a row are also read as one word, so that spelled-out insults count.
Kernel: subsequences of ``P`` characters, each weighted by ``DECAY`` to the power of the length that it spans in both
words, normalised; values under ``FLOOR`` are zero, and so are those with a landmark of whose neighbouring characters the
word does not hold at least half the pairs in order, with up to ``REACH`` - 1 characters put between. Words of over ``LONG`` characters count as their overlapping windows.

Landmarks are words and word beginnings that toxic training texts hold far oftener than clean ones do, picked so that
each new one adds texts to those before it, and the commonest words of clean texts that resemble them. A labelled text is compared
with each landmark twice: by its most similar word, whitened by the landmarks' own kernel matrix (Nyström), and by the sum over all
its different words, as a logarithm. So one clear insult counts, and so do several words that each are no more than suspicious. A
linear machine learns from these; a logistic curve fitted on the training texts turns its margin into a score.

Training reads at most ``TRAIN_ROWS`` labelled rows (of the lowest hash) whose crc32(doc_id) mod 3 is not 1, with all their words;
the driver holds at most ``CANDIDATES`` words of each kind and two numbers per landmark for each of those texts.

Defined results: null and empty texts have no words and get the score of a text without evidence; without labels of both
kinds every score is the overall share of toxic labels (0 without labels); null labels are ignored, repeated ones count
again; repeated documents get one row each; a null doc_id is not held out; other columns are ignored. Texts are never cut: a very long one is
read in parts, and its words count as one set.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lowest_hashes, slices, table, worker_cache, written

P, DECAY, FLOOR, LONG = 3, 0.7, 0.4, 32
TRAIN_ROWS, CANDIDATES, LANDMARKS, CONTRASTS = 12_000, 2000, 64, 32
STEMS = range(4, 9)
#: A kernel value counts only if the word holds half of the landmark's neighbouring pairs, up to ``REACH`` places apart.
REACH = 3
THRESHOLD = 0.7
#: Bytes that the words which a worker remembers may take, about; what a word takes beside its characters and features.
MEMORY_BYTES, ENTRY = 24 << 20, 160
#: Bytes of text read at a time, and tokens of a very long text.
SLICE_BYTES, PART = 1 << 20, 1 << 16


def cleaned(token: str) -> str:
    return token if token.isalpha() else "".join(filter(str.isalpha, token))


def marked(word: str) -> str:
    return f"^{word}$"


def _codes(words: list[str], width: int, pad: str) -> np.ndarray:
    """Characters of the words, one row each, filled up with ``pad``."""
    return np.frombuffer("".join(w.ljust(width, pad) for w in words).encode("utf-32-le"), np.int32).reshape(len(words), width)


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """The subsequence kernel of each pair of words (not normalised): sums over subsequences of ``P`` characters."""
    if not left:
        return np.zeros(0)
    every = np.arange(len(left))
    return kernels(_codes(left, max(1, *map(len, left)), "\0"), every, _codes(right, max(1, *map(len, right)), "\1"), every)


def kernels(left: np.ndarray, i: np.ndarray, right: np.ndarray, j: np.ndarray, step: int = 512) -> np.ndarray:
    """The kernel of words ``left[i]`` and ``right[j]``, given by their characters; pads of both sides differ."""
    out = np.zeros(len(i))
    left, right = left.T, right.T
    for at in range(0, len(i), step):
        same = (left[:, None, i[at : at + step]] == right[None, :, j[at : at + step]]) * DECAY**2
        ends = same.copy()
        for _ in range(P - 1):
            # Sums over all earlier ends, decayed by the gaps on both sides; the next match follows on the diagonal.
            for k in range(1, len(left)):
                ends[k] += DECAY * ends[k - 1]
            for k in range(1, len(right)):
                ends[:, k] += DECAY * ends[:, k - 1]
            ends[1:, 1:] = same[1:, 1:] * ends[:-1, :-1]
            ends[0], ends[:, 0] = 0, 0
        out[at : at + step] = ends.sum((0, 1))
    return out


def pair_codes(words: list[str], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The ordered pairs of characters at most ``reach`` places apart, as numbers, and the words that they are from."""
    rows, codes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if words:
        letters = _codes(words, max(2, *map(len, words)), "\0").astype(np.int64)
        for step in range(1, reach + 1):
            first, second = letters[:, :-step], letters[:, step:]
            row, at = np.nonzero((first != 0) & (second != 0))
            rows.append(row)
            codes.append(first[row, at] << 21 | second[row, at])
    return np.concatenate(rows), np.concatenate(codes)


@dataclass
class Model:
    landmarks: list[str] = field(default_factory=list)
    whitener: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 0.0
    offset: float = -30.0

    def __post_init__(self):
        self.norms = np.sqrt(kernel(self.landmarks, self.landmarks))
        self.sizes = np.array([len(x) for x in self.landmarks], np.int64)
        # Characters of the short landmarks, and of all.
        width = int(self.sizes.max(initial=1))
        self.letters = [_codes([x[:most] for x in self.landmarks], most, "\1") if self.landmarks else None for most in (min(8, width), width)]
        # An index of the landmarks' neighbouring pairs: all others say nothing about a word.
        row, code = pair_codes(self.landmarks, 1)
        self.codes = np.unique(code)
        self.pairs = np.zeros((len(self.codes), len(self.landmarks)), np.float32)
        self.pairs[np.searchsorted(self.codes, code), row] = 1
        self.need = self.pairs.sum(0) / 2

    def shared(self, words: list[str]) -> np.ndarray:
        """Whether the words hold half of the landmarks' pairs."""
        row, code = pair_codes(words, REACH)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[at] == code
        held = np.zeros((len(words), len(self.codes)), np.float32)
        held[row[known], at[known]] = 1
        return held @ self.pairs >= self.need

    def similar(self, words: list[str]) -> np.ndarray:
        """Normalised kernel values, words x landmarks; those under the floor are zero."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        if not words or not self.landmarks:
            return out
        shared = self.shared(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((P, 12), (13, 20), (21, LONG)):
            own = np.nonzero((lengths >= low) & (lengths <= high))[0]
            if not len(own):
                continue
            w, j = np.nonzero(shared[own])
            if not len(w):
                continue
            size = int(lengths[own].max())
            letters, theirs = (_codes([words[x] for x in own], size, pad) for pad in "\0\1")
            i, back = np.unique(w, return_inverse=True)
            norms = np.sqrt(kernels(letters, i, theirs, i))
            value = np.zeros(len(w))
            for long in (False, True):  # landmarks of like length together
                of = np.nonzero((self.sizes[j] > 8) == long)[0]
                if len(of):
                    value[of] = kernels(letters, w[of], self.letters[long], j[of])
            value /= np.maximum(norms[back] * self.norms[j], 1e-12)
            out[own[w], j] = np.where(value >= FLOOR, value, 0)
        return out

    def margins(self, most: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return self.mapped(most, sums) @ self.weights + self.bias

    def mapped(self, most: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """What the machine sees of texts, given the greatest and the summed kernel values with all landmarks."""
        return np.concatenate((most @ self.whitener, np.log1p(sums)), 1)

    def score(self, margin):
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def windows(word: str) -> list[str]:
    return [word] if len(word) <= LONG else [word[i : i + LONG] for i in range(0, len(word) - LONG // 2, LONG // 2)]


class Reader:
    """Finds the words of a text that have features. Lives in a worker and remembers words, those of late for longest."""

    def __init__(self, model: Model):
        self.model, self.words, self.older, self.held = model, {}, {}, 0

    def learn(self, tokens: set[str]) -> tuple[dict[str, tuple[str, np.ndarray]], set[str]]:
        """Of the tokens whose words have features, word and features; and the tokens of a single letter."""
        cleaned_of = {t: t if t.isalpha() else cleaned(t) for t in tokens}
        distinct = set(cleaned_of.values())
        fresh = [w for w in distinct if w not in self.words]
        old = [w for w in fresh if w in self.older]
        for word in old:
            self.remember(word, self.older[word])
        fresh = sorted(w for w in set(fresh).difference(old) if len(w) > 1)
        own: dict[str, np.ndarray] = {}
        for at in range(0, len(fresh), 4096):
            group = fresh[at : at + 4096]
            parts = [(w, p) for w in group for p in windows(marked(w))]
            for i in range(0, len(parts), 8192):
                values = self.model.similar([p for _, p in parts[i : i + 8192]])
                for k in np.nonzero(values.any(1))[0].tolist():
                    name = parts[i + k][0]
                    own[name] = np.maximum(own[name], values[k]) if name in own else values[k].copy()
        words = self.words
        active = {t: (w, row) for t, w in cleaned_of.items() if (row := own.get(w) if w in own else words.get(w)) is not None}
        single = {t for t, w in cleaned_of.items() if len(w) == 1}
        for word in fresh:
            if len(word) <= LONG:
                self.remember(word, own.get(word))
        if self.held > MEMORY_BYTES // 2:
            self.words, self.older, self.held = {}, self.words, 0
        return active, single

    def remember(self, word: str, row: np.ndarray | None) -> None:
        self.words[word] = row
        self.held += ENTRY + 4 * len(word) + (112 + row.nbytes if row is not None else 0)

    def evidence(self, tokens: list[str], known: tuple[dict[str, tuple[str, np.ndarray]], set[str]], found: dict[str, np.ndarray]) -> None:
        """Adds the words of ``tokens`` that have features to ``found``."""
        active, single = known
        different = set(tokens)
        found.update(active[t] for t in different if t in active)
        if not different.isdisjoint(single):
            at = np.nonzero(np.fromiter(map(single.__contains__, tokens), bool, len(tokens)))[0]
            runs = np.split(at, np.nonzero(np.diff(at) > 1)[0] + 1)
            spelled = sorted({"".join(cleaned(tokens[i]) for i in run) for run in runs if len(run) > 2}.difference(found))
            of = [(word, part) for word in spelled for part in windows(marked(word))]
            for i in range(0, len(of), 4096):
                for (word, _), row in zip(of[i : i + 4096], self.model.similar([part for _, part in of[i : i + 4096]]), strict=True):
                    if row.any():
                        found[word] = np.maximum(found[word], row) if word in found else row

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The greatest and the summed kernel values of each text's different words with all landmarks."""
        width = len(self.model.landmarks)
        most, sums = np.zeros((len(texts), width)), np.zeros((len(texts), width))
        if not width:
            return most, sums
        split = [tokens_of(t) if len(t or "") <= SLICE_BYTES else None for t in texts]
        known = self.learn(set().union(*(s for s in split if s)))
        for i, tokens in enumerate(split):
            found: dict[str, np.ndarray] = {}
            for part in [tokens] if tokens is not None else parts_of(texts[i]):
                self.evidence(part, known if tokens is not None else self.learn(set(part)), found)
            if found:
                rows = np.stack([found[w] for w in sorted(found)])  # summed in one order, whatever was remembered
                most[i], sums[i] = rows.max(0), rows.sum(0, dtype=np.float64)
        return most, sums


def worker_reader(broadcast) -> Reader:
    readers = worker_cache("toxicity_readers")
    if broadcast.id not in readers:
        readers.clear()
        readers[broadcast.id] = Reader(Model(**broadcast.value))
    return readers[broadcast.id]


def tokens_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def parts_of(text: str) -> Iterator[list[str]]:
    """The tokens of a very long text in parts; a run of single characters stays together."""
    part: list[str] = []
    for token in re.finditer(r"\S+", text):
        if len(part) >= PART and len(token[0]) > 1:
            yield part
            part = []
        part.append(token[0].lower())
    yield part


class Handle:
    """A broadcast with an identity that workers can compare."""

    def __init__(self, spark: SparkSession, model: Model):
        self.id = uuid.uuid4().hex
        self.broadcast = spark.sparkContext.broadcast({f.name: getattr(model, f.name) for f in fields(model)})

    @property
    def value(self) -> dict:
        return self.broadcast.value


def _train_texts(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text, toxic of the training rows."""
    mark = F.col("doc_id").cast("string")
    usable = labels.where((F.pmod(F.crc32(mark.cast("binary")), F.lit(3)) != 1) & F.col("toxic").isNotNull())
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("__toxic"))
    ids = lowest_hashes(usable, ["doc_id", "__toxic"], rows, usable.count())
    # At most ``rows`` pairs of numbers: a proven bound.
    return written(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", F.col("__toxic").alias("toxic")), "toxic-train")


def _word_counts(texts: DataFrame) -> DataFrame:
    """word, pos, neg: toxic and clean training texts that hold the marked word or the beginning of a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {cleaned(t) for t in tokens_of(text)}
                stems = {f"^{w[:n]}" for w in words for n in STEMS if n < len(w)}
                for word in stems.union(marked(w) for w in words if P <= len(w) <= LONG - 2):
                    counts.setdefault(word, [0, 0])[0 if toxic == 1 else 1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], names=["word", "pos", "neg"])

    found = texts.select("text", "toxic").mapInArrow(run, "word string, pos long, neg long")
    return found.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def pick_landmarks(words: list[tuple[str, float]], count: int = LANDMARKS) -> list[str]:
    """Greedy: the word that stands for most weight that earlier landmarks are not similar to."""
    names, weights = [w for w, _ in words], np.array([x for _, x in words], float)
    picked: list[str] = []
    while len(picked) < count and len(names) and weights.max(initial=0) > 0:
        best = int(weights.argmax())
        picked.append(names[best])
        near = Model([names[best]]).similar(names)[:, 0]
        weights = weights * (1 - near**2)
        weights[best] = 0
        weights[weights < 1] = 0
    return picked


def _text_features(texts: DataFrame, handle: Handle) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, and the greatest and summed kernel values with all landmarks, of the training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = worker_reader(handle)
        for batch in (p for b in batches for p in slices(b, SLICE_BYTES)):
            both = np.concatenate(reader.texts(batch.column(1).to_pylist()), 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(both.tolist(), pa.list_(pa.float64()))], names=["doc_id", "toxic", "features"])

    found = texts.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id long, toxic int, features array<double>")
    rows = found.toArrow().combine_chunks()
    x = rows.column("features").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    text, toxic = (rows.column(n).to_numpy() for n in ("doc_id", "toxic"))
    # In an order that does not depend on partitions, so that training is repeatable.
    order = np.lexsort((*x.T[::-1], toxic, text))
    x, width = x[order], x.shape[1] // 2
    return toxic[order], x[:, :width], x[:, width:]


def _machine(x: np.ndarray, y: np.ndarray, steps: int = 30, cost: float = 3000.0) -> tuple[np.ndarray, float]:
    """Linear machine of squared hinge loss, by Newton steps on the rows inside the margin."""
    weight = np.full(len(y), min(1.0, cost / len(y)))
    x1 = np.concatenate((x, np.ones((len(x), 1))), 1)
    ridge = np.append(np.ones(x.shape[1]), 1e-6)
    w = np.zeros(x1.shape[1])
    loss = lambda v: (ridge * v * v).sum() / 2 + (weight * np.maximum(0, 1 - y * (x1 @ v)) ** 2).sum()
    for _ in range(steps):
        inside = y * (x1 @ w) < 1
        own = x1[inside] * weight[inside, None]
        move = np.linalg.solve(np.diag(ridge) + 2 * own.T @ x1[inside], ridge * w - 2 * own.T @ (y[inside] - x1[inside] @ w))
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * move) > now:
            size /= 2
        w = w - size * move
        if now - loss(w) < 1e-9 * now:
            break
    return w[:-1], float(w[-1])


def _curve(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of labels over margins, by Newton steps with a small penalty."""
    x = np.stack((margins, np.ones(len(margins))), 1)
    # Platt's targets: a few labels don't make sure.
    positive, total = toxic.sum(), len(toxic)
    toxic = np.where(toxic > 0, (positive + 1) / (positive + 2), 1 / (total - positive + 2))
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - toxic) + 1e-3 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    texts = _train_texts(docs, labels, rows)
    counts = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = counts.get(1, 0), sum(n for k, n in counts.items() if k != 1)
    share = (pos + 0.5) / (pos + neg + 1) if pos + neg else 0.0
    without = Model(offset=float(np.log(share / (1 - share))) if share else -30.0)
    if not pos or not neg:
        return without
    words = written(_word_counts(texts), "toxic-words")
    # Toxic texts beyond eight times what the clean texts' rate explains; rare words say nothing.
    weight = F.col("pos") - 8 * (F.col("neg") + 1) * F.lit(pos / neg)
    toxic_words = words.where(F.col("pos") >= max(3, 0.03 * pos)).select("word", weight.alias("weight")).where("weight > 0")
    landmarks = pick_landmarks([(r[0], float(r[1])) for r in toxic_words.orderBy(F.desc("weight"), "word").limit(CANDIDATES).collect()])
    if not landmarks:
        return without
    clean = [r[0] for r in words.where(F.col("neg") * pos > F.col("pos") * neg).where(F.col("word").endswith("$")).orderBy(F.desc("neg"), "word").limit(CANDIDATES).collect()]
    near = Model(landmarks).similar(clean).max(1, initial=0)
    landmarks += [w for w, x in zip(clean, near, strict=True) if x >= FLOOR and w not in landmarks][:CONTRASTS]
    model = Model(landmarks)
    values, vectors = np.linalg.eigh(model.similar(landmarks).astype(float))
    model.whitener = vectors / np.sqrt(np.maximum(values, 1e-2)) @ vectors.T
    label, most, sums = _text_features(texts, Handle(docs.sparkSession, model))
    toxic = label == 1
    model.weights, model.bias = _machine(model.mapped(most, sums), np.where(toxic, 1.0, -1.0))
    model.slope, model.offset = _curve(model.margins(most, sums), toxic.astype(float))
    return model


def _scores(reader: Reader, texts: list[str | None]) -> np.ndarray:
    model = reader.model
    if model.weights is None:
        return model.score(np.full(len(texts), model.bias))
    return model.score(model.margins(*reader.texts(texts)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    handle = Handle(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = worker_reader(handle)
        for batch in (p for b in batches for p in slices(b, SLICE_BYTES)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(reader, batch.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose own text scores below the threshold; columns are those of ``docs``."""
    model = train(docs, labels)
    handle = Handle(docs.sparkSession, model)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        reader = worker_reader(handle)
        column = pa.array(texts, pa.string())
        rows = pa.RecordBatch.from_arrays([column, column], names=["text", "again"])
        return pd.Series(np.concatenate([np.zeros(0), *(_scores(reader, part.column(0).to_pylist()) for part in slices(rows, SLICE_BYTES))]))

    return docs.where(scored(F.coalesce("text", F.lit(""))) < threshold)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
