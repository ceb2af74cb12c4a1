"""Language ID: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

A text's letters are lower-cased, all else becomes one space; its subwords are the runs of 2 to 4
characters without a space inside. Each is hashed to a bucket with an embedding; the embeddings'
average goes through a linear layer and a softmax. As averaging is linear too, a table of
embedding times layer predicts the same with one row per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
DIMENSIONS = 16
#: About so many labelled documents of each language are fitted and calibrated on; of all languages together no more than the second.
ROWS_PER_LANGUAGE, ROWS = 600, 100_000
#: Subwords of a labelled document that are learned from at most, drawn from the whole text.
SUBWORDS = 20_000
#: Share of clean calibration texts that rejection may cost.
REJECTED_CLEAN = 0.001
SEGMENT = 1 << 20


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _counts(code: np.ndarray, fresh: int) -> np.ndarray:
    """Buckets of the subwords that end at place ``fresh`` or behind."""
    inner, total = code != 32, np.zeros(BUCKETS, np.int64)
    mixed = code * np.uint32(2654435761)
    running, whole = mixed.copy(), np.ones(len(code), bool)
    for n in range(2, 5):
        if len(code) < n:
            break
        running = running[:-1] * np.uint32(16777619) ^ mixed[n - 1 :]
        whole = whole[: len(running)] & inner[n - 2 : n - 2 + len(running)] if n > 2 else whole[: len(running)]
        used = running[max(0, fresh - n + 1) :][whole[max(0, fresh - n + 1) :]]
        total += np.bincount((used * np.uint32(0x85EBCA6B)) >> np.uint32(17), minlength=BUCKETS)
    return total


def subword_counts(text: str | None) -> np.ndarray | None:
    """How often each bucket occurs in a whole text; None for a null or one without letters. Long texts go in segments that overlap."""
    if not text or not any(map(str.isalpha, text)):
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total, tail = np.zeros(BUCKETS, np.int64), np.array([32], np.uint32)
    for at in range(0, len(code) + 1, SEGMENT):
        part = code[at : at + SEGMENT]
        part = np.where(_letters()[part], part, np.uint32(32)).astype(np.uint32)
        if at + SEGMENT > len(code):
            part = np.r_[part, np.uint32(32)]
        joined = np.r_[tail, part]
        joined = joined[np.r_[True, (joined[1:] != 32) | (joined[:-1] != 32)]]
        total += _counts(joined, len(tail))
        tail = joined[-3:]
    return total


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        z = (counts @ self.table / max(1, counts.sum()) + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 4.0, seed: int = 7) -> LanguageModel:
    """From (language, buckets, counts) of labelled texts. Every fifth text calibrates, the rest fit.

    Each visit of a text uses a random share of its subwords, so short texts are learned too.
    """
    rng = np.random.default_rng(seed)
    languages = sorted({s[0] for s in samples})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    place = {x: i for i, x in enumerate(languages)}
    emb = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    fit, held = [s for i, s in enumerate(samples) if i % 5], samples[::5]
    fit = fit or held

    def bag(sample: tuple) -> tuple[np.ndarray, np.ndarray]:
        _, at, n = sample
        drawn = rng.binomial(n, 10 ** rng.uniform(-2, 0))
        used = np.flatnonzero(drawn) if drawn.any() else rng.integers(0, len(at), 1)
        weight = np.maximum(drawn[used], 1).astype(np.float32)
        return at[used], weight / weight.sum()

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(fit)):
            at, weight = bag(fit[i])
            mean = weight @ emb[at]
            error = _softmax(mean @ layer + bias)
            error[place[fit[i][0]]] -= 1
            back = layer @ error
            layer -= 0.1 * step * np.outer(mean, error)
            bias -= 0.01 * step * error
            emb[at] -= step * weight[:, None] * back
    model = LanguageModel(languages, (emb @ layer).astype(np.float32), bias, 1.0, 0.0)
    # calibration: the temperature with the least loss on held texts, cut to random lengths too
    logits, truth = [], []
    for sample in held:
        for at, weight in [(sample[1], sample[2] / sample[2].sum())] + [bag(sample) for _ in range(3)]:
            logits.append(weight @ model.table[at] + bias)
            truth.append(place[sample[0]])
    z, y = np.array(logits), np.array(truth)

    def loss(t: float) -> float:
        s = z / t - (z / t).max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    model.temperature = float(min(np.geomspace(0.2, 5, 40), key=loss))
    whole = z[::4] / model.temperature
    best = 1 / np.exp(whole - whole.max(axis=1, keepdims=True)).sum(axis=1)
    model.threshold = float(min(0.5, np.quantile(best, REJECTED_CLEAN)))
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lang, order, at, n = [], [], [], []
        for text, tag, place in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), b.column("place").to_pylist(), strict=True):
            if (counts := subword_counts(text)) is not None:
                if counts.sum() > SUBWORDS:
                    counts = np.random.default_rng(abs(place)).multinomial(SUBWORDS, counts / counts.sum())
                used = np.flatnonzero(counts)
                lang.append(tag)
                order.append(place)
                at.append(used.astype(np.int32))
                n.append(counts[used].astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(order, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))], names=["lang", "place", "buckets", "counts"])


def fit(docs: DataFrame, learnable: Column | None = None, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Learn from rows of ``docs`` (text, lang) with a language, and for which ``learnable`` holds.

    The rows are a sample by a hash of the id, about ``rows_per_language`` of each language and ``ROWS``
    in all; of a long text ``SUBWORDS`` draws from all its subwords are learned from. Every language is
    learned. Null ids and repeated rows count like any other.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.lit(True) if learnable is None else learnable))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # a row for each language
    if not counts:
        return train([])
    scale, rows_per_language = 1 << 30, max(1, min(rows_per_language, ROWS // len(counts)))
    rates = F.create_map(*[x for r in counts for x in (F.lit(r[0]), F.lit(min(scale, scale * rows_per_language // r[1])))])
    place = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("language"))
    sample = rows.select("text", "lang", place.alias("place")).where(F.pmod("place", F.lit(scale)) < F.coalesce(rates[F.col("lang")], F.lit(0)))
    found = sample.mapInArrow(_features, "lang string, place long, buckets array<int>, counts array<int>").toArrow().sort_by([("place", "ascending"), ("lang", "ascending")])
    tag, at, n = found.column("lang").to_pylist(), found.column("buckets").combine_chunks(), found.column("counts").combine_chunks()
    model = train([(tag[i], at[i].values.to_numpy(), n[i].values.to_numpy()) for i in range(len(tag))])
    del found, at, n
    pa.default_memory_pool().release_unused()  # the driver lives on beside the model
    return model


def _predict(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        for b in batches:
            lang, score = [], []
            for text in b.column("text").to_pylist():
                counts = subword_counts(text)
                if counts is None or not model.languages:
                    lang.append("und")
                    score.append(0.0)
                else:
                    p = model.probabilities(counts)
                    lang.append(model.languages[int(p.argmax())])
                    score.append(float(p.max()))
            rejected = [t == "und" or s < model.threshold for t, s in zip(lang, score, strict=True)]
            names = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=[*names, "lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: LanguageModel, *keep: str) -> DataFrame:
    """``keep`` columns of each row with lang_pred, score (calibrated, 0 to 1) and rejected.

    A null text, one without letters, or a model that learned nothing gives ``und`` with score 0,
    rejected. Else a text is rejected if its score is below the model's threshold. Only the text is
    looked at; repeated rows get equal results; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a row of BUCKETS floats for each language
    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return docs.select(*keep, F.col("text").alias("text")).mapInArrow(_predict(shared), f"{schema}, lang_pred string, score double, rejected boolean")


def filtered(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.RecordBatch.from_arrays([b.column("text")], names=["text"])
            rejected = next(_predict(shared)(iter([text]))).column("rejected")
            yield b.filter(pc.invert(rejected))

    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(run, docs.schema)
