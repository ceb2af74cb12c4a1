"""Toxicity by a subsequence string kernel and a support vector machine over Nystroem landmarks, trained on sentences.

Two strings are alike by the subsequences of three letters that they share; one that spans more
characters counts less, so gaps and inserted characters are tolerated. A sentence is compared with a
landmark by its most alike word (runs of lone characters are read as one word), so it has one kernel
value per landmark, and the machine is trained on these values of labelled sentences.

Labels are of documents: a document is a bag of sentences. Sentences of clean documents are clean;
of a toxic document only its worst sentence by the machine so far is held to be toxic, in rounds, the
first time those nearest to any landmark. A document scores as its worst sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Code points; a subsequence of three letters is one number below their third power.
LETTERS = 1 << 21
DECAY = 0.7
#: Kernel values below this are those of strings that have little in common; they count as none.
LEAST = 0.5
#: Longer words are read through windows of this many characters, half as far apart.
WIDEST = 20
#: About so many labelled documents are learned from.
POSITIVE_ROWS, NEGATIVE_ROWS = 1500, 3000
#: Landmarks at most, how many standard deviations apart their log odds in toxic and clean documents must be, and how alike two may be.
LANDMARKS, TELLING, ALIKE = 96, 2.8, 0.7
#: Added to the landmarks' kernel matrix, so that landmarks that are much alike share their weight.
JITTER = 0.1
#: Rounds of finding each toxic document's worst sentence.
ROUNDS = 5
CACHE = 400_000
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+|[\r\n]+")


@lru_cache(1)
def _letter_table() -> np.ndarray:
    """Code points of letters as they are, 0 for all else; 2 and 3 mark the ends of short words."""
    table = np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), np.int64, 0x110000)
    table[2:4] = 2, 3
    return table


@lru_cache(64)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and letters of the words of each length; words of fewer than three letters are marked at both ends, so they have subsequences too."""
    words = [w if len(w) > 4 or sum(map(str.isalpha, w)) >= 3 else f"\2{w}\3" for w in words]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(sizes[sizes >= 3]).tolist():
        own = np.flatnonzero(sizes == n)
        step = max(1, (1 << 21) // len(_triples(n)[0]))
        for at in range(0, len(own), step):
            rows = own[at : at + step]
            text = "".join([words[i] for i in rows]).encode("utf-32-le", "surrogatepass")
            yield rows, _letter_table()[np.frombuffer(text, np.uint32)].reshape(-1, n)


def _codes(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The three-letter subsequences of words of one length, and their weights; those with a zero in them count for nothing."""
    at, weight = _triples(letters.shape[1])
    return (letters[:, at[:, 0]] * LETTERS + letters[:, at[:, 1]]) * LETTERS + letters[:, at[:, 2]], weight


def _norms(letters: np.ndarray) -> np.ndarray:
    """Root of each word's kernel with itself, by the recursion over prefixes; words are rows of one length."""
    n, w = letters.shape[1], letters.shape[0]
    same = [[(letters[:, i] == letters[:, j]) & (letters[:, i] > 0) for j in range(n)] for i in range(n)]
    below = np.ones((n + 1, n + 1, w))
    for _ in range(2):
        now = np.zeros((n + 1, n + 1, w))
        for i in range(1, n + 1):
            run = np.zeros(w)
            for j in range(1, n + 1):
                run = DECAY * run + DECAY**2 * np.where(same[i - 1][j - 1], below[i - 1, j - 1], 0.0)
                now[i, j] = DECAY * now[i - 1, j] + run
        below = now
    return np.sqrt(sum(DECAY**2 * np.where(same[i][j], below[i, j], 0.0) for i in range(n) for j in range(n)))


class Landmarks:
    """Strings that others are compared with, by the subsequences that they hold."""

    def __init__(self, marks: list[str]) -> None:
        self.marks = marks
        owner, codes, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for rows, letters in _by_length(marks):
            code, weight = _codes(letters)
            real = (letters[:, _triples(letters.shape[1])[0]] > 0).all(axis=2)
            norm = _norms(letters)
            owner.append(np.repeat(rows, real.sum(axis=1)))
            codes.append(code[real])
            weights.append((np.broadcast_to(weight, code.shape) / np.where(norm > 0, norm, 1)[:, None])[real])
        owner, codes, weights = map(np.concatenate, (owner, codes, weights))
        order = np.argsort(codes, kind="stable")
        self.owner, self.weight = owner[order], weights[order]
        self.codes, self.start, self.count = np.unique(codes[order], return_index=True, return_counts=True)
        # most subsequences of a word are none of a landmark's; a table by a hash rules them out
        self.likely = np.zeros(1 << 20, bool)
        self.likely[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def values(self, words: list[str], least: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, kernel value) of all values above zero and of ``least`` and more, by words."""
        out_row, out_mark, out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for rows, letters in _by_length(words) if len(self.codes) else ():
            code, weight = _codes(letters)
            row, place = np.nonzero(self.likely[self._slot(code)])
            found = code[row, place]
            at = np.minimum(np.searchsorted(self.codes, found), len(self.codes) - 1)
            met = self.codes[at] == found
            at, row, weight_of = at[met], row[met], weight[place[met]]
            times = self.count[at]
            entry = np.repeat(self.start[at] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
            total = np.bincount(np.repeat(row, times) * len(self.marks) + self.owner[entry], np.repeat(weight_of, times) * self.weight[entry], len(rows) * len(self.marks))
            row, mark = np.nonzero(total.reshape(len(rows), -1))
            value = total[row * len(self.marks) + mark]
            # of words that are all letters the norm is no less than that of distinct subsequences
            lower = np.where((letters > 0).all(axis=1), np.sqrt((weight * weight).sum()), 0.0)
            near = value >= least * lower[row]
            row, mark, value = row[near], mark[near], value[near]
            some, where = np.unique(row, return_inverse=True)
            if len(some):
                value = value / _norms(letters[some])[where]
                near = value >= least
                out_row.append(rows[row[near]])
                out_mark.append(mark[near])
                out.append(value[near])
        row, mark, value = map(np.concatenate, (out_row, out_mark, out))
        order = np.argsort(row, kind="stable")
        return row[order], mark[order], value[order]


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Normalised kernel values; 0 for strings without letters."""
    out = np.zeros((len(left), len(right)))
    row, mark, value = Landmarks(right).values(left)
    out[row, mark] = value
    return out


def _lone_run(words: list[str]) -> bool:
    sizes = list(map(len, words))
    return sizes.count(1) >= 3 and b"\1\1\1" in bytes(map(min, sizes, repeat(255)))


def words_of(text: str, given: list[str] | None = None) -> list[str]:
    """Lower-cased words of a text; runs of three and more lone characters also as one word; long words in windows."""
    words = text.lower().split() if given is None else given
    if not words:
        return words
    if _lone_run(words):
        run = []
        for w in [*words, ""]:
            if len(w) == 1:
                run.append(w)
            else:
                if len(run) >= 3:
                    words.append("".join(run))
                run = []
    if max(map(len, words)) > WIDEST:
        long = [w for w in words if len(w) > WIDEST]
        words = [w for w in words if len(w) <= WIDEST] + [w[at : at + WIDEST] for w in long for at in range(0, max(1, len(w) - WIDEST // 2), WIDEST // 2)]
    return words


def sentences_of(text: str) -> list[str]:
    """Parts of a text between line ends and after full stops, exclamation and question marks with white space behind."""
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()]


class Reader:
    """Kernel values of sentences; a worker remembers what words have in common with the landmarks."""

    def __init__(self, landmarks: Landmarks) -> None:
        self.landmarks, self.known = landmarks, {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            self.known.update(dict.fromkeys(part))
            row, mark, value = self.landmarks.values(part, LEAST)
            ends = np.searchsorted(row, np.arange(len(part) + 1))
            for i in np.unique(row).tolist():
                own = slice(ends[i], ends[i + 1])
                self.known[part[i]] = mark[own], value[own]

    def bag(self, text: str, words: set[str]) -> list[dict[int, float]]:
        """The distinct sentences that have something in common with a landmark, as {landmark: greatest value}."""
        known = self.known
        alike = {w for w in words if known[w] is not None}
        if not alike:
            return []
        out = []
        for sentence in sentences_of(text):
            near = alike.intersection(words_of(sentence))
            if near:
                values: dict[int, float] = {}
                for w in near:
                    for m, v in zip(*(x.tolist() for x in known[w]), strict=True):
                        values[m] = max(v, values.get(m, 0.0))
                out.append(values)
        return [dict(x) for x in dict.fromkeys(tuple(sorted(x.items())) for x in out)]

    def bags(self, texts: list[str | None]) -> Iterator[list[dict[int, float]]]:
        for at in range(0, len(texts), 500):
            part = [t or "" for t in texts[at : at + 500]]
            words = []
            for t in part:
                given = t.lower().split()
                # runs of lone characters may end where sentences do, so words of sentences need not be words of the text
                more = list(map(words_of, sentences_of(t))) if _lone_run(given) else ()
                words.append(set(words_of(t, given)).union(*more))
            self.learn(set().union(*words))
            for t, w in zip(part, words, strict=True):
                yield self.bag(t, w)


@dataclass
class ToxicityModel:
    """Weights of the landmarks' kernel values in a sentence, and how margins become probabilities."""

    landmarks: list[str]
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    reader: Reader | None = field(default=None, repr=False, compare=False)

    def margins(self, texts: list[str | None]) -> list[float]:
        """Each text's margin: that of its worst sentence; the bias is that of a sentence like no landmark."""
        if self.reader is None:
            self.reader = Reader(Landmarks(self.landmarks))
        w = self.weight
        return [self.bias + max((sum(w[m] * v for m, v in s.items()) for s in bag), default=0.0) if len(bag) else self.bias for bag in self.reader.bags(texts)]


def _dense(sentences: list[dict[int, float]], m: int) -> np.ndarray:
    out = np.zeros((len(sentences), m), np.float32)
    for i, s in enumerate(sentences):
        out[i, list(s.keys())] = list(s.values())
    return out


def train(landmarks: list[str], toxic: list[list[dict[int, float]]], clean: list[list[dict[int, float]]], epochs: int = 30, ridge: float = 1e-3, seed: int = 3) -> ToxicityModel:
    """A linear machine with hinge loss on Nystroem features of sentences, in rounds over bags of them.

    Bags without sentences that are like a landmark count as one empty sentence. Both kinds of bags weigh the same.
    """
    m = len(landmarks)
    if not m or not toxic or not clean:
        return ToxicityModel(landmarks, np.zeros(m), -1.0 if not toxic or not m else 0.0)
    value, vector = np.linalg.eigh(kernel(landmarks, landmarks))
    root = (vector @ np.diag(1 / np.sqrt(np.maximum(value, 0) + JITTER)) @ vector.T).astype(np.float32)

    def features(bags: list) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(bags)), [max(1, len(b)) for b in bags])
        return _dense([s for b in bags for s in (b or [{}])], m) @ root, owner

    (pos, pos_bag), (neg, neg_bag) = features(toxic), features(clean)
    # a clean bag's sentences share its weight
    neg_cost = 0.5 / len(clean) / np.bincount(neg_bag)[neg_bag]
    score = np.array([max(s.values(), default=0.0) for b in toxic for s in (b or [{}])])
    w, b = np.zeros(m), 0.0
    for k in range(ROUNDS):
        order = np.lexsort((np.arange(len(score)), -score, pos_bag))
        worst = order[np.r_[True, pos_bag[order][1:] != pos_bag[order][:-1]]]
        x = np.concatenate([pos[worst], neg])
        y = np.r_[np.ones(len(worst)), -np.ones(len(neg))]
        cost = np.r_[np.full(len(worst), 0.5 / len(worst)), neg_cost]
        w, b = _machine(x, y, cost * len(y), epochs, ridge, seed + k)
        score = pos @ w + b
    return ToxicityModel(landmarks, root @ w, b)


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int, ridge: float, seed: int, batch: int = 64) -> tuple[np.ndarray, float]:
    """Stochastic subgradient descent on the hinge loss; the average of the second half's steps."""
    rng, w, b, step = np.random.default_rng(seed), np.zeros(x.shape[1]), 0.0, 0
    sum_w, sum_b, kept = np.zeros_like(w), 0.0, 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            own = order[at : at + batch]
            step += 1
            rate = 1 / (ridge * step + 1)
            inside = own[y[own] * (x[own] @ w + b) < 1]
            push = cost[inside] * y[inside] / len(own)
            w = (1 - rate * ridge) * w + rate * (push @ x[inside])
            b += 0.1 * rate * push.sum()
            if 2 * epoch >= epochs:
                sum_w, sum_b, kept = sum_w + w, sum_b + b, kept + 1
    return sum_w / kept, float(sum_b / kept)


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, document, word, context): the words before and behind tell copies of a sentence from new uses of a word."""
    for b in batches:
        seen = set()
        for text, label, place in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), b.column("place").to_pylist(), strict=True):
            for sentence in sentences_of(text or ""):
                words = ["", *words_of(sentence), ""]
                seen.update((label, place, w, f"{a} {c}") for a, w, c in zip(words, words[1:], words[2:], strict=False))
        kinds = pa.int32(), pa.int64(), pa.string(), pa.string()
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*seen, strict=True) if seen else [[]] * 4, kinds, strict=True)], names=["toxic", "place", "word", "context"])


def _spread(words: list[str]) -> list[str]:
    """The first ``LANDMARKS`` words that are not nearly the same as one before."""
    alike, out = kernel(words, words) > ALIKE, []
    for i in range(len(words)):
        if len(out) < LANDMARKS and not alike[i, out].any():
            out.append(i)
    return [words[i] for i in out]


def _bags(marks: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Landmarks(marks))
        for b in batches:
            bags = list(reader.bags(b.column("text").to_pylist()))
            kinds = pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), b.column("place"), pa.array([[list(s) for s in bag] for bag in bags], kinds[0]), pa.array([[list(s.values()) for s in bag] for bag in bags], kinds[1])],
                names=["toxic", "place", "marks", "kernel"],
            )

    return run


def _margins(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [n for n in b.schema.names if n != "text"]
            margin = shared.value.margins(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(margin, pa.float64())], names=[*names, "margin"])

    return run


def _calibrated(model: ToxicityModel, x: np.ndarray, y: np.ndarray) -> ToxicityModel:
    """Logistic regression in one variable, with Platt's smoothed targets; left as it is where the held documents are of one kind."""
    if 0 < y.sum() < len(y):
        hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2)
        t, theta = np.where(y > 0, hi, lo), np.zeros(2)
        z = np.c_[x, np.ones(len(x))]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
            theta = theta - np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (p - t) + 1e-3 * theta)
        if theta[0] > 0:
            model.slope, model.shift = map(float, theta)
    return model


def fit(docs: DataFrame, labels: DataFrame, learnable: Column | None = None) -> ToxicityModel:
    """Learn from documents that ``labels`` marks in ``toxic`` (1 if any row of an id says so) and ``learnable`` allows.

    A sample by a hash of the id, bounded by ``POSITIVE_ROWS`` and ``NEGATIVE_ROWS`` on average. Landmarks
    are the words of sentences by whose presence (in different surroundings, so copies count once) toxic
    documents differ most from clean ones; sentences of four fifths of the sample train the machine, the last
    fifth turns margins into probabilities. Null texts are empty ones, repeated rows count again; without
    documents of both kinds every text scores the same.
    """
    marked = labels.where("doc_id is not null and toxic is not null").where(F.lit(True) if learnable is None else learnable).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect() if r[0] in (0, 1)}
    scale, place = 1 << 30, F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30))
    share = lambda n, k: F.lit(min(scale, scale * n // max(1, total.get(k, 0))))
    chosen = marked.where(((F.col("toxic") == 1) & (place < share(POSITIVE_ROWS, 1))) | ((F.col("toxic") == 0) & (place < share(NEGATIVE_ROWS, 0)))).withColumn("place", F.xxhash64("doc_id"))
    sample = staged(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "place"), "labelled")
    held = F.pmod("place", F.lit(5)) == 0
    uses = sample.where(~held).mapInArrow(_uses, "toxic int, place long, word string, context string")
    # a use of a word belongs to one document, so copies of a document add nothing
    owned = uses.groupBy("toxic", "word", "context").agg(F.min("place").alias("place")).select("toxic", "word", "place").distinct()
    per_word = owned.groupBy("word").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    kinds = {r[0]: r[1] for r in sample.where(~held).groupBy("toxic").count().collect()}
    pos, neg = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(pos / F.lit(kinds.get(1, 0) + 1.0)) - F.log(neg / F.lit(kinds.get(0, 0) + 1.0))
    apart = odds / F.sqrt(1 / pos + 1 / neg)
    telling = per_word.where(F.col("pos") >= 2).select("word", apart.alias("apart")).where(F.col("apart") >= TELLING).orderBy(F.desc("apart"), "word").limit(4 * LANDMARKS)
    marks = _spread([r[0] for r in telling.select("word").collect()])
    found = sample.where(~held).mapInArrow(_bags(marks), "toxic int, place long, marks array<array<int>>, kernel array<array<float>>").toArrow().sort_by([("place", "ascending"), ("toxic", "ascending")])
    kinds = found.column("toxic").to_pylist()
    bags = [[dict(zip(m, v, strict=True)) for m, v in zip(a, b, strict=True)] for a, b in zip(found.column("marks").to_pylist(), found.column("kernel").to_pylist(), strict=True)]
    model = train(marks, [b for b, k in zip(bags, kinds, strict=True) if k], [b for b, k in zip(bags, kinds, strict=True) if not k])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    margins = sample.where(held).select("toxic", "text").mapInArrow(_margins(shared), "toxic int, margin double").toPandas()
    return _calibrated(model, margins.margin.to_numpy(), margins.toxic.to_numpy(float))


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts, and texts that are like no landmark, have the bias for a margin. Only the text
    is looked at. Repeated rows get equal results; null ids stay; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    margins = docs.select("doc_id", "text").mapInArrow(_margins(shared), f"doc_id {kind}, margin double")
    at = F.lit(model.slope) * F.col("margin") + F.lit(model.shift)
    score = 1 / (1 + F.exp(-F.greatest(F.least(at, F.lit(30.0)), F.lit(-30.0))))
    return margins.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
