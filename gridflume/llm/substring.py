"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words. Each word that is covered by a window which also starts in
a document with a smaller id is removed. The steps, all over whole texts:

1. Anchors. Of the ``ANCHOR``-word phrases in each window the one with the least hash is its anchor
   (winnowing), so equal windows have equal anchors. Anchors of a single document lead nowhere; a
   document's segments are its parts whose windows have other anchors.
2. Confirmed passages. The windows of segments are grouped over all documents by 128-bit hashes; each
   window that recurs belongs to its first document, where neighbouring ones form passages.
3. Automata. Passages are dealt into shards of bounded size. Each segment is streamed through the shards
   that own one of its anchors. In a shard, an Aho-Corasick automaton over words (compiled with
   pyahocorasick from the anchors' phrases) finds every occurrence, and the windows around it are
   compared with the shard's passages word by word. Segments of a busy shard are dealt over several
   copies of it.

Copies of a whole word sequence are settled first by digest, and only the first one takes part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_hash, utf8_texts, word_hashes

WINDOW = 50
ANCHOR = 25
#: Words of passages that one automaton is meant to hold, and bytes of text that one copy of it reads.
SHARD_WORDS = 100_000
SHARD_BYTES = 8_000_000
#: Windows of a segment at most; a longer repeated part of a document is several segments.
SEGMENT_WINDOWS = 2048
_BASES = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@lru_cache(8)
def _powers(bits: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64, 2**bits of each."""
    n = 1 << bits
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)], dtype=np.uint64)
        down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(base, -1, 1 << 64), np.uint64)], dtype=np.uint64)
    return up, down


def phrase_hashes(hashes: np.ndarray, k: int, base: int = _BASES[0]) -> np.ndarray:
    """A 64-bit hash for each run of k words."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(max(12, int(n).bit_length()), base)
    sums = np.r_[np.uint64(0), np.cumsum(hashes * up[:n], dtype=np.uint64)]
    x = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def window_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each window, as two independent hashes."""
    mixed = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return phrase_hashes(hashes, WINDOW), phrase_hashes(mixed ^ (mixed >> np.uint64(33)), WINDOW, _BASES[1])


def anchors(hashes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """The anchor phrases' hashes, and for each window the place of its anchor (leftmost on ties)."""
    phrases = phrase_hashes(hashes, anchor)
    if len(hashes) < window:
        return phrases, np.zeros(0, np.int64)
    wide = window - anchor + 1
    chosen = np.lib.stride_tricks.sliding_window_view(phrases, wide).argmin(axis=1) + np.arange(len(hashes) - window + 1)
    return phrases, chosen


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        digest, n_words, sha, picked, hashed = [], [], [], [], b.column("text_hash").to_pylist()
        for text in utf8_texts(b.column("text")):
            words = text.split()
            joined = b" ".join(words)
            digest.append(xxhash.xxh3_128_hexdigest(joined))
            n_words.append(len(words))
            sha.append(hashlib.sha256(joined).hexdigest())
            phrases, chosen = anchors(word_hashes(words))
            picked.append(np.unique(phrases[np.unique(chosen)]).view(np.int64))
        lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in picked])].astype(np.int32), pa.array(np.concatenate([*picked, np.zeros(0, np.int64)])))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(digest), pa.array(n_words, pa.int64()), pa.array(sha), lists, pa.array(hashed, pa.int64())], names=["doc_id", "digest", "n_words", "sha", "anchors", "text_hash"])


def _runs(starts: np.ndarray, width: int, most: int | None = None) -> list[tuple[int, int]]:
    """Word intervals that windows at these sorted starts cover, windows one step apart together (up to ``most`` of them)."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > 1)
    found = list(zip(starts[np.r_[0, breaks + 1]].tolist(), (starts[np.r_[breaks, len(starts) - 1]] + width).tolist(), strict=True))
    if most is None:
        return found
    return [(at, min(at + most + width - 1, hi)) for lo, hi in found for at in range(lo, hi - width + 1, most)]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of each document whose windows have a recurring anchor, with these anchors."""
    for b in batches:
        rows, at, parts, sizes, picked = [], [], [], [], []
        for i, text in enumerate(utf8_texts(b.column("text"))):
            words = text.split()
            phrases, chosen = anchors(word_hashes(words))
            hot = np.isin(phrases[chosen], np.asarray(b.column("hot")[i].values).view(np.uint64))
            for lo, hi in _runs(np.flatnonzero(hot), WINDOW, SEGMENT_WINDOWS):
                rows.append(i)
                at.append(lo)
                parts.append(b" ".join(words[lo:hi]))
                sizes.append(hi - lo)
                picked.append(np.unique(phrases[chosen[lo : hi - WINDOW + 1]]).view(np.int64))
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(taken), b.column("text_hash").take(taken), pa.array(at, pa.int64()), pa.array(parts, pa.binary()), pa.array(sizes, pa.int64()), pa.array(picked, pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "at", "part", "words", "anchors"],
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit hashes of the windows of segments, a window of a segment once."""
    for b in batches:
        found, rows = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)]
        for i, part in enumerate(b.column("part").to_pylist()):
            found.append(np.unique(np.stack(window_hashes(word_hashes(part.split())), axis=1), axis=0))
            rows.append(np.full(len(found[-1]), i))
        found, rows = np.concatenate(found).view(np.int64), np.concatenate(rows)
        for at in range(0, len(rows), 1 << 18):
            part = slice(at, at + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(found[part, 0]), pa.array(found[part, 1]), b.column("doc_id").take(pa.array(rows[part]))], names=["w1", "w2", "doc_id"])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The confirmed passages in first documents' segments, with the anchors of their windows."""
    for b in batches:
        rows, passages, sizes, picked = [], [], [], []
        for i, part in enumerate(b.column("part").to_pylist()):
            words = part.split()
            hashes = word_hashes(words)
            own = np.isin(phrase_hashes(hashes, WINDOW), np.asarray(b.column("windows")[i].values).view(np.uint64))
            phrases, chosen = anchors(hashes)
            for lo, hi in _runs(np.flatnonzero(own), WINDOW):
                rows.append(i)
                passages.append(b" ".join(words[lo:hi]))
                sizes.append(hi - lo)
                picked.append(np.unique(phrases[chosen[lo : hi - WINDOW + 1]]).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(passages, pa.binary()), pa.array(sizes, pa.int64()), pa.array(picked, pa.list_(pa.int64()))],
            names=["first_id", "passage", "words", "anchors"],
        )


def _letter(n: int) -> str:
    """The n-th letter of the private alphabet: any code point but zero and the surrogates."""
    n += 1 if n < 0xD7FF else 0x801
    if n > 0x10FFFF:
        raise ValueError("a shard of passages has more distinct words than an automaton has letters; lower SHARD_WORDS")
    return chr(n)


class PhraseAutomaton:
    """An Aho-Corasick automaton over the words of passages; a word is one character of a private alphabet."""

    def __init__(self, passages: list[tuple[int, bytes]]) -> None:
        self.letters: dict[bytes, str] = {}
        self.first: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for first_id, passage in passages:
            words = passage.split()
            coded = "".join([self.letters.setdefault(w, _letter(len(self.letters))) for w in words])
            _, chosen = anchors(word_hashes(words))
            for at in np.unique(chosen).tolist():
                self.automaton.add_word(coded[at : at + ANCHOR])
            for at in range(len(coded) - WINDOW + 1):
                window = coded[at : at + WINDOW]
                self.first[window] = min(first_id, self.first.get(window, first_id))
        self.automaton.make_automaton()

    def covered(self, doc_id: int, text: bytes) -> list[tuple[int, int]]:
        """Word intervals of the text that windows of documents with smaller ids cover."""
        get = self.letters.get
        coded = "".join([get(w, "\0") for w in text.split()])
        count = len(coded) - WINDOW + 1
        if count < 1:
            return []
        near = np.zeros(count + 1, np.int32)
        for end, _ in self.automaton.iter(coded):
            at = end - ANCHOR + 1
            near[min(count, max(0, at + ANCHOR - WINDOW))] += 1
            near[min(count, at + 1)] -= 1
        first = self.first
        starts = [s for s in np.flatnonzero(np.cumsum(near[:-1]) > 0).tolist() if first.get(coded[s : s + WINDOW], doc_id) < doc_id]
        return _runs(np.asarray(starts, np.int64), WINDOW)


def _locate(key: tuple, passages: pd.DataFrame, segments: pd.DataFrame) -> pd.DataFrame:
    found = []
    if len(passages) and len(segments):
        automaton = PhraseAutomaton(list(zip(passages.first_id, passages.passage, strict=True)))
        for doc_id, row, at, part in zip(segments.doc_id, segments.text_hash, segments["at"], segments.part, strict=True):
            if runs := automaton.covered(doc_id, part):
                found.append((doc_id, row, [at + a for a, _ in runs], [at + b for _, b in runs]))
    return pd.DataFrame(found, columns=["doc_id", "text_hash", "lo", "hi"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        removed, sha, kept = [], [], []
        for i, text in enumerate(utf8_texts(b.column("text"))):
            words = text.split()
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, np.asarray(b.column("lo")[i].values), 1)
            np.add.at(gone, np.asarray(b.column("hi")[i].values), -1)
            gone = np.cumsum(gone[:-1]) > 0
            left = b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()])
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(removed, pa.int64()), pa.array(sha), pa.array(kept)], names=["doc_id", "text_hash", "n_removed", "sha", "kept"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept_text, text_hash.

    ``kept_text`` is null where nothing was removed; else the kept words joined by one space. Null
    texts have no words. Documents of fewer than ``WINDOW`` words lose nothing. Rows with a null
    doc_id are neither smaller nor larger than others: they lose nothing and cost others nothing.
    Rows of one id don't cost each other anything, whether they repeat it with the same text or with
    another; ``text_hash`` tells the latter apart. An empty table gives no rows.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_hash().alias("text_hash"))
    sketches = staged(texts.mapInArrow(_sketches, f"doc_id {id_type}, digest string, n_words long, sha string, anchors array<long>, text_hash long"), "sketches")
    firsts = sketches.groupBy("digest").agg(F.min("doc_id").alias("first_copy"))
    rows = sketches.select("doc_id", "digest", "n_words", "sha", "text_hash").join(firsts, "digest").drop("digest")

    # 1. recurring anchors, each document's own, and the parts of documents around them
    row = ["doc_id", "text_hash"]
    reps = sketches.where(F.size("anchors") > 0).join(firsts, "digest").where("doc_id = first_copy").select(*row, "anchors")
    recurring = reps.select("doc_id", F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    hot = reps.select(*row, F.explode("anchors").alias("anchor")).join(recurring, "anchor").groupBy(*row).agg(F.collect_set("anchor").alias("hot"))
    candidates = staged(texts.join(hot, row), "candidates")
    segments = staged(candidates.mapInArrow(_segments, f"doc_id {id_type}, text_hash long, at long, part binary, words long, anchors array<long>"), "segments")

    # 2. confirmed passages of first documents
    windows = segments.select("doc_id", "part").mapInArrow(_windows, f"w1 long, w2 long, doc_id {id_type}")
    confirmed = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id")
    owned = confirmed.groupBy("first_id").agg(F.collect_list("w1").alias("windows"))
    passages = staged(
        segments.join(owned, F.col("doc_id") == F.col("first_id")).select("doc_id", "part", "windows")
        .mapInArrow(_passages, f"first_id {id_type}, passage binary, words long, anchors array<long>"),
        "passages",
    )

    # 3. shards, the segments that they concern, and what they find there
    words = passages.agg(F.sum("words")).head()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    passages = passages.withColumn("shard", F.pmod(F.xxhash64("first_id", "passage"), F.lit(shards)))
    owners = passages.select("shard", "first_id", F.explode("anchors").alias("anchor")).groupBy("anchor", "shard").agg(F.min("first_id").alias("first_id"))
    segment = [*row, "at"]
    concerned = segments.select(*segment, F.length("part").alias("size"), F.explode("anchors").alias("anchor")).join(owners, "anchor").where("first_id < doc_id")
    concerned = staged(concerned.select(*segment, "size", "shard").distinct(), "concerned")
    copies = concerned.groupBy("shard").agg(F.greatest(F.ceil(F.sum("size") / SHARD_BYTES), F.lit(1)).cast("int").alias("copies"))
    dealt = concerned.join(copies, "shard").select(*segment, "shard", F.pmod(F.xxhash64(*segment), F.col("copies")).cast("int").alias("copy"))
    ours = passages.join(copies, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "first_id", "passage")
    theirs = segments.select(*segment, "part").join(dealt, segment)
    located = ours.groupBy("shard", "copy").cogroup(theirs.groupBy("shard", "copy")).applyInPandas(_locate, f"doc_id {id_type}, text_hash long, lo array<long>, hi array<long>")
    gone = located.groupBy(*row).agg(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("hi")).alias("hi"))
    changed = candidates.select(*row, "text").join(gone, row).mapInArrow(_kept, f"doc_id {id_type}, text_hash long, n_removed long, sha string, kept string")
    changed = changed.dropDuplicates(row)  # repeated rows

    copy = F.col("doc_id").isNotNull() & (F.col("doc_id") > F.col("first_copy")) & (F.col("n_words") >= WINDOW)
    found = F.col("c.sha").isNotNull()
    return rows.alias("r").join(changed.alias("c"), row, "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).when(found, F.col("n_removed")).otherwise(F.lit(0).cast("long")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).when(found, F.col("c.sha")).otherwise(F.col("r.sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).when(found, F.col("kept")).alias("kept_text"),
        "text_hash",
    )
