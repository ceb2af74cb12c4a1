"""Language-model scoring by Katz backoff over n-gram counts of the whole training corpus.

Counts of every order are stored in tables partitioned by a hash of the context. Small counts are
discounted after Good and Turing; what that frees for a context goes to the words not seen behind
it, in proportion to the next lower order, by a backoff weight that makes the context's
probabilities sum to one over the training words and one unknown word. A token is looked up in the
highest order; if it isn't there, its context's weight is applied and the next lower one is asked.

Words are 64-bit hashes of their bytes, contexts hashes of their words' hashes.

To score texts, no row per n-gram is shuffled. Texts are staged as chunks of numbered words. At each
order a chunk asks the buckets, to which contexts are dealt, for its different n-grams, in one packed
row a bucket; a bucket counts what all chunks hold and answers each with counts, which are small and
pack well. A frequent context is dealt out by its words as well, and what its parts leave is summed
apart. The next order asks with the counts of the order below, and texts meet all answers at last.
Here words are numbered by falling counts, so that a context of two words is told exactly by its numbers.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty, utf8_texts

#: Counts up to this are discounted.
DISCOUNTED = 5
#: Parts of a stored n-gram table.
PARTS = 32
#: Not words: they hold a space.
END_WORD = b" end"
START, END = xxhash.xxh64_intdigest(b" start"), xxhash.xxh64_intdigest(END_WORD)
CACHE = 500_000
#: Tokens of a chunk, and of a bucket on average; buckets at least.
CHUNK, BUCKET, LEAST_BUCKETS = 1 << 21, 2_000_000, 8
#: Shares of the chunks that are scored one after another.
SHARES = 4


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def tokens(text: bytes, order: int) -> np.ndarray:
    """A row per token: its hash, then its contexts of 1, 2, ... words."""
    words = text.lower().split()
    w = np.r_[np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)), np.uint64(END)]
    out, context = [w], np.zeros(len(w), np.uint64)
    for k in range(1, order):
        back = np.r_[np.full(min(k, len(w)), START, np.uint64), w[:-k]] if len(w) > k else np.full(len(w), START, np.uint64)
        context = back if k == 1 else (context ^ (back + np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(context)
    return np.stack(out, axis=1)


def _grams(order: int, level: int):
    """Each document's distinct n-grams of one level with how often it has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, grams, times = [], [], []
            for i, text in enumerate(utf8_texts(b.column("text"))):
                found, n = np.unique(tokens(text, order)[:, :level], axis=0, return_counts=True)
                rows.append(np.full(len(n), i))
                grams.append(found)
                times.append(n)
            rows, grams, times = np.concatenate(rows), np.concatenate(grams), np.concatenate(times)
            for at in range(0, len(rows), 1 << 17):
                part = slice(at, at + (1 << 17))
                names = [n for n in b.schema.names if n != "text"]
                cols = [b.column(n).take(pa.array(rows[part])) for n in names]
                cols += [pa.array(grams[part, k].astype(np.uint64).view(np.int64)) for k in range(level)] + [pa.array(times[part])]
                yield pa.RecordBatch.from_arrays(cols, names=[*names, "w", *[f"c{k}" for k in range(1, level)], "n"])

    return run


def _exploded(docs: DataFrame, order: int, level: int, *keep: str) -> DataFrame:
    kept = docs.select(*keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    columns = "w long, " + "".join(f"c{k} long, " for k in range(1, level)) + "n long"
    return docs.select(*keep, "text").mapInArrow(_grams(order, level), schema + columns)


def discounts(n: dict[int, int]) -> list[float]:
    """Good-Turing discount factors of counts 1 to DISCOUNTED from how many n-grams have each count.

    Where the formula gives no factor between 0 and 1 (few n-grams), absolute discounting does.
    """
    k, out = DISCOUNTED, []
    n1, n2 = n.get(1, 0), n.get(2, 0)
    absolute = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
    tail = (k + 1) * n.get(k + 1, 0) / n1 if n1 else 1.0
    for r in range(1, k + 1):
        d = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - tail) / (1 - tail) if n.get(r) and tail < 1 else 0.0
        out.append(d if 0 < d < 1 else 1 - absolute / r)
    return out


def _discounted(count: Column, factors: list[float]) -> Column:
    found = count.cast("double")
    for r, d in enumerate(factors, 1):
        found = F.when(count == r, F.lit(d * r)).otherwise(found)
    return found


def train(docs: DataFrame, order: int = 2) -> tuple[list[DataFrame], dict]:
    """Stored tables of each order and {tokens, words, unknown}.

    Order one: (w, n, p). Order k: (context, w, p) and, where ``w`` is null, the context's backoff weight
    in ``p``. ``unknown`` is the probability of an unknown word.
    """
    def counted(level: int) -> DataFrame:
        by = ["w", *([f"c{level - 1}"] if level > 1 else []), *([f"c{level - 2}"] if level > 2 else [])]
        return _exploded(docs, order, level).groupBy(*by).agg(F.sum("n").alias("n"))

    def factors(table: DataFrame) -> list[float]:
        return discounts({r[0]: r[1] for r in table.where(F.col("n") <= DISCOUNTED + 1).groupBy("n").count().collect()})

    part = lambda c: F.pmod(c, F.lit(PARTS)).cast("int")
    words = staged(counted(1).withColumn("part", part(F.col("w"))), "unigrams", "part")
    total, kinds = words.agg(F.sum("n"), F.count("*")).head()
    total = total or 0
    p = _discounted(F.col("n"), factors(words)) / F.lit(float(max(1, total)))
    # an unknown word has what discounting leaves, or a part of one token's share where it leaves nothing
    left = 1 - (words.agg(F.sum(p)).head()[0] or 0.0)
    if left < 1e-12:
        p, left = p * F.lit(total / (total + 1.0)), 1 / (total + 1.0)
    tables = [words.select("part", "w", "n", p.alias("p"))]
    for level in range(2, order + 1):
        context, lower = f"c{level - 1}", [f"c{level - 2}"] if level > 2 else []
        grams = staged(counted(level).withColumn("part", part(F.col(context))), f"grams{level}", "part")
        below = tables[-1]
        below = (below.where("w is not null").select(F.col("context").alias(lower[0]), "w", F.col("p").alias("below")) if lower else below.select("w", F.col("p").alias("below")))
        d = _discounted(F.col("n"), factors(grams))
        sums = grams.join(below, ["w", *lower], "left").groupBy(context).agg(F.sum("n").alias("all"), F.sum(d).alias("kept"), F.sum("below").alias("covered"))
        # a context whose counts are all above the discounted ones leaves one count's share instead
        whole = F.when(F.col("kept") < F.col("all"), F.col("all")).otherwise(F.col("all") + 1)
        weight = (1 - F.col("kept") / F.col("whole")) / F.greatest(1 - F.col("covered"), F.lit(1e-12))
        contexts = sums.withColumn("whole", whole).select(F.col(context).alias("context"), "whole", weight.alias("weight"))
        # apart, so that the shuffles which find them are gone when grams are shuffled again
        contexts = staged(contexts, f"contexts{level}")
        seen = grams.select(F.col(context).alias("context"), "w", "n").join(contexts, "context").select("context", "w", (d / F.col("whole")).alias("p"))
        weights = contexts.select("context", F.lit(None).cast("long").alias("w"), F.col("weight").alias("p"))
        tables.append(staged(seen.unionByName(weights).withColumn("part", part(F.col("context"))), f"katz{level}", "part"))
    return tables, {"tokens": total, "words": kinds, "unknown": left}


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as planes of their bytes, compressed: planes of high bytes are nearly empty."""
    out = []
    for a in arrays:
        bits = np.ascontiguousarray(a).astype(np.uint64, copy=False)
        width = (int(bits.max(initial=0)).bit_length() + 7) // 8
        planes = bits.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        data = pa.compress(planes, "zstd", asbytes=True) if planes else b""
        out += [struct.pack("<QQB", len(data), len(bits), width), data]
    return b"".join(out)


def _unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size, n, width = struct.unpack_from("<QQB", data, at)
        at += 17
        bits = np.zeros((n, 8), np.uint8)
        if width:
            planes = pa.decompress(data[at : at + size], n * width, "zstd", asbytes=True)
            bits[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
        out.append(bits.reshape(-1).view(np.int64))
        at += size
    return out


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``CHUNK`` tokens or a bit more: their documents, hashes of their words, and the texts in numbers of these.

    Number 0 stands before each document, the others are the words from 1 as they come. The first 16 bits
    of a hash, which choose its bucket, are kept apart: later orders need no more of it.
    """
    part, made = TaskContext.get().partitionId(), 0
    for b in batches:
        numbers, texts, size, begin = _Numbers(), [], 0, 0
        for i, text in enumerate(utf8_texts(b.column("text")), 1):
            words = text.lower().split()
            texts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            size += len(words) + 1
            if size >= CHUNK or i == b.num_rows:
                end = [numbers[END_WORD]]
                stream = np.concatenate([x for t in texts for x in ([0], t, end)])
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
                docs = [pa.ListArray.from_arrays(pa.array([0, i - begin], pa.int32()), b.column(c).slice(begin, i - begin)) for c in ("doc_id", "held_out")]
                row = [pa.array([part << 32 | made], pa.int64()), *docs, pa.array([size], pa.int64()), *[pa.array([_packed(x)], pa.binary()) for x in (hashes >> np.uint64(48), hashes & np.uint64((1 << 48) - 1), stream)]]
                yield pa.RecordBatch.from_arrays(row, names=["chunk", "doc_id", "held_out", "size", "deal", "words", "stream"])
                numbers, texts, size, begin, made = _Numbers(), [], 0, i, made + 1


def _factored(n: np.ndarray, factors: list[float]) -> np.ndarray:
    """Discounted counts."""
    low = np.array([0.0, *[r * d for r, d in enumerate(factors, 1)]])
    return np.where(n <= DISCOUNTED, low[np.minimum(n, DISCOUNTED)], n)


def _left(context: np.ndarray, n: int, count: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Of each of ``n`` contexts: the sum of its n-grams' counts and how many have a count of 1, 2, ...; the same of the counts one level below."""
    out = []
    for x in (count, lower):
        out.append(np.bincount(context, x, n).astype(np.int64))
        low = np.flatnonzero(x <= DISCOUNTED)
        each = np.bincount(context[low] * DISCOUNTED + x[low] - 1, minlength=n * DISCOUNTED) if len(low) else np.zeros(n * DISCOUNTED, np.int64)
        out.extend(each.reshape(n, DISCOUNTED).T)
    return np.stack(out)


def _totals(count: np.ndarray) -> np.ndarray:
    """Of n-grams: how many there are, their counts' sum, and how many have a count of 1, 2, ... one more than are discounted."""
    return np.r_[(count > 0).sum(), count.sum(), np.bincount(count[count <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)[1:]]


def _freed(low: np.ndarray, factors: list[float]) -> np.ndarray:
    """What discounting takes, from how many counts are 1, 2, ..."""
    return sum(r * (1 - d) * x for (r, d), x in zip(enumerate(factors, 1), low, strict=True))


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ x >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)) % np.uint64(buckets)


def _slices(of: np.ndarray, buckets: int) -> list[int]:
    return np.searchsorted(of, np.arange(buckets + 1)).tolist()


class _Chunk:
    """A chunk's n-grams, level by level, as far as they have been answered."""

    def __init__(self, row: dict, model: dict) -> None:
        self.model, self.level = model, 1
        (deal,), (self.stream,) = _unpacked(row["deal"]), _unpacked(row["stream"])
        self.hashes = deal << 48 | _unpacked(row["words"])[0] if "words" in row else None
        self.start = self.stream == 0
        self.doc = np.cumsum(self.start) - 1
        learned = np.array([x is False for x in row["held_out"]], bool)
        self.learned = learned[self.doc] & ~self.start
        self.held = ~self.learned & ~self.start
        # of the level reached: which n-gram each place has, how often the chunk's training texts have each, and its other texts
        self.gram = self.stream
        self.own, self.more = (np.bincount(self.stream[x], minlength=len(deal) + 1) for x in (self.learned, self.held))
        self.order = np.argsort(bucket := _bucket(deal, model["buckets"]), kind="stable")
        self.cuts = _slices(bucket[self.order], model["buckets"])

    def asks(self) -> Iterator[tuple[int, bytes]]:
        """What each bucket is asked at this level."""
        if self.level == 1:
            for k, (a, z) in enumerate(pairwise(self.cuts)):
                if a < z:
                    own = self.order[a:z]
                    yield k, _packed(self.hashes[own], self.own[own + 1], self.more[own + 1])
            return
        ids, told = self.ids[self.word], _totals(self.own[self.alone])
        for k, (a, z) in enumerate(pairwise(self.cuts)):
            if a < z or k == self.first:
                own = self.asked[self.at[a] : self.at[z]]
                keys = self.keys[a:z]
                yield k, _packed(np.diff(keys, prepend=np.int64(0)), self.sizes[a:z], self.hot[a:z], ids[own], self.own[own], self.more[own], self.lower[own], told * (k == self.first))

    def up(self) -> None:
        """Go to the next level's n-grams: a context, an n-gram of the level before, and a word."""
        self.level += 1
        before, n = self.gram, len(self.ids)
        context = np.where(self.start, before, np.r_[before[:1], before[:-1]])
        kinds, self.gram = np.unique(context * n + self.stream, return_inverse=True)
        self.context, self.word = kinds // n, kinds % n
        here = (self.count == self.own) & (self.rest == self.more)
        self.own, self.more = (np.bincount(self.gram[x], minlength=len(kinds)) for x in (self.learned, self.held))
        self.suffix = np.zeros(len(kinds), np.int64)
        self.suffix[self.gram] = before
        self.lower, first = self.count[self.suffix], before[0] if len(before) else 0
        # contexts that no training text has tell nothing; those of a document's start are frequent
        known, often = self.count > 0, self.count + self.rest >= self.model["often"]
        known[first] = often[first] = True
        # a context that no other chunk has is known here as a whole
        alone = known & here
        alone[first] = False
        self.alone = np.flatnonzero(alone[self.context])
        asked = np.flatnonzero((known & ~alone)[self.context] & (self.word > 0))
        mine, frequent = self.context[asked], often[self.context[asked]]
        # a part is a context with its words, or one word of a frequent context, whose words are dealt out over the buckets
        begins = np.flatnonzero(frequent | (np.diff(mine, prepend=-1) != 0))
        sizes, hot = np.diff(begins, append=len(asked)), frequent[begins]
        keys = self.key[mine[begins]]
        salt = np.where(hot, self.ids[self.word[asked[begins]]] + 1, 0) * 0x2545F4914F6CDD1D
        bucket = _bucket(keys ^ salt, self.model["buckets"])
        order = np.argsort(keys, kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
        self.cuts = _slices(bucket[order], self.model["buckets"])
        self.first = int(bucket[order[0]]) if len(order) else 0
        self.keys, self.sizes, self.hot = keys[order], sizes[order], hot[order]
        self.at = np.r_[0, np.cumsum(self.sizes)]
        self.asked = asked[np.repeat(begins[order] - self.at[:-1], self.sizes) + np.arange(len(asked))]
        self.parts = mine[begins][order]

    def _joined(self, answers: dict[int, bytes]) -> list[np.ndarray]:
        """Buckets in their order; one that was told the chunk's totals alone has nothing to add."""
        found = [_unpacked(answers[k]) for k, (a, z) in enumerate(pairwise(self.cuts)) if a < z]
        return [np.concatenate(x) for x in zip(*found, strict=True)]

    def answered(self, answers: dict[int, bytes], left: dict[int, bytes] | None) -> None:
        """Take the answers of this level's buckets: counts of n-grams and, where texts are scored, what contexts leave to the level below."""
        m = self.model
        if self.level == 1:
            self.count, self.rest, self.ids = np.zeros((3, len(self.own)), np.int64)
            for to, x in zip((self.count, self.rest, self.ids), self._joined(answers), strict=True):
                to[self.order + 1] = x
            self.key, self.known = self.ids, self.count
            with np.errstate(divide="ignore"):
                p = np.log10(_factored(self.count, m["factors"][0]) * m["share"])
            self.done = np.where(self.count > 0, p, np.log10(m["unknown"]))
            return
        n = len(self.count)
        self.count, self.rest = np.zeros((2, len(self.context)), np.int64)
        self.count[self.alone], self.rest[self.alone] = self.own[self.alone], self.more[self.alone]
        if len(self.asked):
            self.count[self.asked], self.rest[self.asked] = self._joined(answers)
        if left is not None:
            self._weigh(n, left)
        # n-grams are the next level's contexts
        key, word = self.key[self.context], self.ids[self.word]
        if self.level == 2:
            self.key = key << 32 | word
        else:
            mixed = (key.astype(np.uint64) ^ word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            self.key = (mixed ^ mixed >> np.uint64(31)).view(np.int64)

    def _weigh(self, n: int, left: dict[int, bytes]) -> None:
        """The probabilities of this level's n-grams, from what their ``n`` contexts leave."""
        m = self.model
        seen = self.alone[self.own[self.alone] > 0]
        stats = _left(self.context[seen], n, self.own[seen], self.lower[seen])
        if len(self.asked):
            stats[:, self.parts[~self.hot]] = self._joined(left)
            keys, sums = m["frequent"][self.level - 2]
            stats[:, self.parts[self.hot]] = sums[:, np.searchsorted(keys, self.keys[self.hot])]
        # of each context: all counts, whole (a context that frees nothing leaves one count's share), and the backoff weight
        every, low, covered, below = stats[0], stats[1 : DISCOUNTED + 1], stats[DISCOUNTED + 1], stats[DISCOUNTED + 2 :]
        freed, covered = _freed(low, m["factors"][self.level - 1]), covered - _freed(below, m["factors"][self.level - 2])
        whole = np.where(freed > 0, every, every + 1)
        share = m["share"] if self.level == 2 else 1 / self.whole[self.behind]
        weight = np.where(freed > 0, freed, 1) / whole / np.maximum(1 - covered * share, 1e-12)
        weight = np.where(every > 0, np.log10(weight), 0.0)
        with np.errstate(divide="ignore"):
            seen = np.log10(_factored(self.count, m["factors"][self.level - 1]) / whole[self.context])
        self.done = np.where(self.count > 0, seen, weight[self.context] + self.done[self.suffix])
        # an n-gram's context at the next level becomes one of this level without its first word
        self.whole, self.behind = whole, self.suffix

    def rows(self) -> list[np.ndarray]:
        """Of each document: n_tokens, n_known, base_score, score."""
        m, n = self.model, int(self.start.sum())
        told = ~self.start
        doc, known = self.doc[told], self.known[self.stream[told]]
        base = np.log10((known + 1) / float(m["tokens"] + m["words"] + 1))
        done = self.done[self.gram[told]] if m["tokens"] else np.zeros(len(doc))
        return [np.bincount(doc, minlength=n), np.bincount(doc[known > 0], minlength=n), np.bincount(doc, base, n), np.bincount(doc, done, n)]


def _word_bucket(buckets: int):
    def run(key: tuple, asked: pa.Table) -> pa.Table:
        """Count a bucket's words and number them, the frequent ones low."""
        bucket, blobs = key[0].as_py(), list(map(_unpacked, asked.column("ask").to_pylist()))
        hashes, own, more = (np.concatenate(x) for x in zip(*blobs, strict=True))
        _, inverse = np.unique(hashes, return_inverse=True)
        count, rest = (np.bincount(inverse, x).astype(np.int64) for x in (own, more))
        rank = np.zeros(len(count), np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
        ids = np.where(count > 0, 1 + rank * buckets + bucket, 0)
        cuts = np.cumsum([0, *[len(b[0]) for b in blobs]])
        answers = [_packed(count[inverse[a:z]], rest[inverse[a:z]], ids[inverse[a:z]]) for a, z in pairwise(cuts)]
        return _answer_rows(bucket, asked.column("chunk").to_pylist(), answers, [None] * len(answers), _totals(count))

    return run


def _gram_bucket(key: tuple, asked: pa.Table) -> pa.Table:
    """Count a bucket's n-grams, and what its contexts leave."""
    bucket, blobs = key[0].as_py(), list(map(_unpacked, asked.column("ask").to_pylist()))
    steps, sizes, hot, word, own, more, lower, told = zip(*blobs, strict=True)
    del blobs
    contexts, part = np.unique(np.concatenate([np.cumsum(x) for x in steps]), return_inverse=True)
    at, to = np.cumsum([0, *map(len, steps)]), np.cumsum([0, *map(len, word)])
    hot = np.concatenate(hot).astype(bool)
    grams, inverse = np.unique(np.repeat(part, np.concatenate(sizes)) << 32 | np.concatenate(word), return_inverse=True)
    count, rest = (np.bincount(inverse, np.concatenate(x), len(grams)).astype(np.int64) for x in (own, more))
    below = np.zeros(len(grams), np.int64)
    below[inverse] = np.concatenate(lower)
    seen = np.flatnonzero(count)
    stats = _left((grams >> 32)[seen], len(contexts), count[seen], below[seen])
    answers = [_packed(count[inverse[b:y]], rest[inverse[b:y]]) for b, y in pairwise(to)]
    left = [_packed(*stats[:, part[a:z][~hot[a:z]]]) for a, z in pairwise(at)]
    frequent = np.unique(part[hot])
    return _answer_rows(bucket, asked.column("chunk").to_pylist(), answers, left, _totals(count) + sum(told), contexts[frequent], stats[:, frequent])


#: Sums over a bucket, or of a frequent context in it.
_SUMS = [f"s{r}" for r in range(2 * DISCOUNTED + 2)]
_ANSWERS = "chunk long, bucket int, answer binary, left binary, key long, " + ", ".join(f"{s} long" for s in _SUMS)


def _answer_rows(bucket: int, chunks: list[int], answers: list[bytes], left: list[bytes | None], totals: np.ndarray, keys: Sequence[int] = (), stats: np.ndarray | None = None) -> pa.Table:
    """Answers to chunks; chunk -1: the bucket's totals; chunk -2: what a frequent context leaves in this bucket."""
    n, m = len(chunks), len(keys)
    sums = np.zeros((len(_SUMS), n + 1 + m), np.int64)
    sums[: len(totals), n] = totals
    if m:
        sums[:, n + 1 :] = stats
    cols = [
        pa.array([*chunks, -1, *[-2] * m], pa.int64()), pa.array([bucket] * (n + 1 + m), pa.int32()), *[pa.array([*x, *[None] * (1 + m)], pa.binary()) for x in (answers, left)],
        pa.array([*[None] * (n + 1), *map(int, keys)], pa.int64()), *map(pa.array, sums),
    ]
    return pa.table(cols, names=["chunk", "bucket", "answer", "left", "key", *_SUMS])


def _replayed(chunk: pa.Table, answers: pa.Table, model: dict, level: int) -> tuple[dict, _Chunk]:
    """A chunk with its answers so far, at a level that is yet to be answered, or past the last one."""
    row, told = chunk.to_pylist()[0], {}
    for name in {"answer", "left"} & set(answers.column_names):
        for k, bucket, x in zip(*(answers.column(c).to_pylist() for c in ("level", "bucket", name)), strict=True):
            told.setdefault((name, k), {})[bucket] = x
    found = _Chunk(row, model)
    for k in range(1, level):
        if k > 1:
            found.up()
        found.answered(told["answer", k], told.get(("left", k)))
    return row, found


def _first_asks(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                yield from _ask_rows(row["chunk"], _Chunk(row, model)).to_batches()

    return run


def _ask_rows(chunk: int, found: _Chunk) -> pa.Table:
    buckets, asks = zip(*found.asks(), strict=True)
    return pa.table({"chunk": pa.array([chunk] * len(asks), pa.int64()), "bucket": pa.array(buckets, pa.int32()), "ask": pa.array(asks, pa.binary())})


def _next_asks(model: dict, level: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row, found = _replayed(chunk, answers, model, level)
        found.up()
        return _ask_rows(row["chunk"], found)

    return run


def _sums(model: dict, order: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        ids, held = (chunk.column(c).combine_chunks().flatten() for c in ("doc_id", "held_out"))
        _, found = _replayed(chunk, answers, model, order + 1)
        n, known, base, score = found.rows()
        return pa.table({"doc_id": ids, "held_out": held, "n_tokens": n, "n_known": known, "train_tokens": np.full(len(n), model["tokens"]), "base_score": base, "score": score})

    return run


def scored(docs: DataFrame, held_out: Column, order: int = 2) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows for which ``held_out`` is false. Null and empty texts are their end token alone.
    Repeated rows are each learned from and scored; null ids stay. With nothing to learn from, every
    token is unknown. An empty table gives no rows.
    """
    given = docs.select("doc_id", held_out.cast("boolean").alias("held_out"), text_or_empty().alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    chunks = staged(given.mapInArrow(_chunks, f"chunk long, doc_id array<{kind}>, held_out array<boolean>, size long, deal binary, words binary, stream binary"), "chunks")
    size = chunks.agg(F.sum("size")).head()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET))
    model = {"buckets": buckets, "often": max(2, size // buckets), "factors": [], "frequent": []}
    answers: list[DataFrame] = []

    def met(run, schema: str, *more: str, which: Column | None = None) -> DataFrame:
        which = F.lit(True) if which is None else which
        each = [a.where("chunk >= 0").where(which).select("chunk", F.lit(k).alias("level"), "bucket", "answer", *more) for k, a in enumerate(answers, 1)]
        return chunks.drop("words").where(which).groupBy("chunk").cogroup(reduce(DataFrame.unionByName, each).groupBy("chunk")).applyInArrow(run, schema)

    for level in range(1, order + 1):
        schema = "chunk long, bucket int, ask binary"
        asks = chunks.mapInArrow(_first_asks(model), schema) if level == 1 else met(_next_asks(model, level), schema)
        count = _word_bucket(buckets) if level == 1 else _gram_bucket
        answers.append(staged(asks.groupBy("bucket").applyInArrow(count, _ANSWERS), f"katz{level}"))
        summed = [F.sum(s).alias(s) for s in _SUMS]
        kinds, total, *low = (x or 0 for x in answers[-1].where("chunk = -1").agg(*summed).head()[: DISCOUNTED + 3])
        model["factors"].append(discounts(dict(enumerate(low, 1))))
        if level == 1:
            left, share = (_freed(low[:-1], model["factors"][0]) / total, 1 / total) if total else (1.0, 1.0)
            # an unknown word has what discounting leaves, or a part of one token's share where it leaves nothing
            if left < 1e-12:
                left = share = 1 / (total + 1)
            model |= {"tokens": total, "words": kinds, "unknown": left, "share": share}
        else:
            # no more than a context for ``often`` training tokens, and the start
            rows = answers[-1].where("chunk = -2").groupBy("key").agg(*summed).orderBy("key").collect()
            model["frequent"].append((np.array([r["key"] for r in rows], np.int64), np.array([[r[s] for r in rows] for s in _SUMS], np.int64)))
    # a share of the chunks after another, so that disk never holds all answers twice; their shuffles go when a share is written
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    shares = [F.pmod(F.xxhash64("chunk"), F.lit(SHARES)) == k for k in range(SHARES)]
    return reduce(DataFrame.unionByName, [staged(met(_sums(model, order), schema, "left", which=x), "scores") for x in shares])
