"""N-best segmentation of texts into the pieces of a SentencePiece model, and back.

Forward Viterbi scores of a lattice are exact heuristics for an A-star search from its end, which
then meets segmentations in order of their scores. No piece of such a model spans the start of a
word, so a text's lattice is a chain of its words' lattices. The forward pass also tells how much a
word's second best way loses; only the words where it loses least can differ in the N best ways of a
text, so the search runs in these, and the N best sums over them are the text's.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
import struct
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
#: Words that a worker remembers; those not in use are forgotten when there is no room.
CACHE = 400_000
#: Letters of words that are walked side by side, and of a word that is walked alone.
_CELLS, _LONG = 1 << 16, 100
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPACE = SPACE.encode()
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]*")


class PieceModel:
    def __init__(self, model_file: str, n: int) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.sp, self.n = sp, n
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece of this model spans the start of a word, so words cannot be segmented on their own")
        self.longest = max(map(len, self.pieces), default=1)
        # a tree of letters; at 0 the piece that ends there
        self.tree: dict = {}
        for piece, found in self.pieces.items():
            node = self.tree
            for char in piece:
                node = node.setdefault(char, {})
            node[0] = found
        self.unknown = min((s for _, s in self.pieces.values()), default=0.0) - 10
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        spelled = {i: p.encode() for p, (i, _) in self.pieces.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.letters = [spelled.get(i, b"") for i in range(sp.get_piece_size())]
        self.known: dict[str, tuple] = {}
        self.by_length = self._tables()

    def _unknown_ids(self, char: str) -> tuple[int, ...]:
        """An unknown character falls back to its bytes, or else to the unknown piece."""
        return tuple(self.bytes[b] for b in char.encode()) if self.bytes else (self.sp.unk_id(),)

    def _edges(self, word: str) -> Iterator[tuple[int, int, float, int]]:
        """The lattice's edges (start, end, score, piece) by their starts, then ends; piece -1 is an unknown character."""
        longest = self.longest
        for i in range(len(word)):
            node, alone = self.tree, True
            for j, char in enumerate(word[i : i + longest], i + 1):
                node = node.get(char)
                if node is None:
                    break
                if 0 in node:
                    piece, score = node[0]
                    alone = alone and j > i + 1
                    yield i, j, score, piece
            if alone:
                yield i, i + 1, self.unknown, -1

    def _tables(self) -> dict[int, tuple]:
        """For each length the pieces' hashes in order, with their letters, ids and scores."""
        out = {}
        for k in sorted({len(p) for p in self.pieces}):
            own = [p for p in self.pieces if len(p) == k]
            letters = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, k)
            hashed = np.zeros(len(own), np.uint64)
            for c in range(k):
                hashed = hashed * _FACTOR + letters[:, c]
            order = np.argsort(hashed)
            ids, scores = np.array([self.pieces[p][0] for p in own]), np.array([self.pieces[p][1] for p in own])
            if len(np.unique(hashed)) < len(own):
                raise ValueError("two pieces of this model have the same hash")
            out[k] = hashed[order], letters[order], ids[order], scores[order]
        return out

    def viterbi(self, words: list[str]) -> list[tuple[bytes, float, float, bytes]]:
        """For each word the ids and score of the best way through its lattice, how much worse the second best is, what the ids spell.

        Words of one length go side by side, long ones alone. Of equal ways the one whose last piece begins first is the best.
        """
        out: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(sizes > _LONG).tolist():
            out[k] = self._alone(words[k])
        for n in np.unique(sizes[sizes <= _LONG]).tolist():
            own = np.flatnonzero(sizes == n)
            step = max(1, _CELLS // n)
            for at in range(0, len(own), step):
                rows = own[at : at + step].tolist()
                for k, found in zip(rows, self._side_by_side([words[k] for k in rows], n), strict=True):
                    out[k] = found
        return out

    def _side_by_side(self, words: list[str], n: int) -> Iterator[tuple[bytes, float, float, bytes]]:
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n).T.copy()
        shape = n + 1, len(words)
        best, second, came, by = np.full(shape, -np.inf), np.full(shape, -np.inf), np.zeros(shape, np.int64), np.full(shape, -1)
        best[0] = 0.0

        def reach(j: int, i: int, rows: np.ndarray, score: np.ndarray | float, piece: np.ndarray | int) -> None:
            total, old = best[i, rows] + score, best[j, rows]
            better = total > old
            second[j, rows] = np.where(better, np.maximum(old, second[i, rows] + score), np.maximum(second[j, rows], total))
            best[j, rows] = np.where(better, total, old)
            came[j, rows] = np.where(better, i, came[j, rows])
            by[j, rows] = np.where(better, piece, by[j, rows])

        for i in range(n):
            hashed, alone = np.zeros(len(words), np.uint64), np.ones(len(words), bool)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                hashed = hashed * _FACTOR + letters[j - 1]
                if j - i not in self.by_length:
                    continue
                sorted_hashes, spelled, ids, scores = self.by_length[j - i]
                place = np.minimum(np.searchsorted(sorted_hashes, hashed), len(ids) - 1)
                rows = np.flatnonzero(sorted_hashes[place] == hashed)
                rows = rows[(spelled[place[rows]].T == letters[i:j, rows]).all(axis=0)]
                if len(rows):
                    if j == i + 1:
                        alone[rows] = False
                    reach(j, i, rows, scores[place[rows]], ids[place[rows]])
            rows = np.flatnonzero(alone)
            if len(rows):
                reach(i + 1, i, rows, self.unknown, -1)
        for word, starts, pieces, score, gap in zip(words, came.T.tolist(), by.T.tolist(), best[n].tolist(), (best[n] - second[n]).tolist(), strict=True):
            yield self._traced(word, starts, pieces, score, gap)

    def _alone(self, word: str) -> tuple[bytes, float, float, bytes]:
        n = len(word)
        best, second, came, by = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        for i, j, score, piece in self._edges(word):
            total = best[i] + score
            if total > best[j]:
                second[j] = max(best[j], second[i] + score)
                best[j], came[j], by[j] = total, i, piece
            elif total > second[j]:
                second[j] = total
        return self._traced(word, came, by, best[n], best[n] - second[n])

    def _traced(self, word: str, starts: list[int], pieces: list[int], score: float, gap: float) -> tuple[bytes, float, float, bytes]:
        found, at = [], len(word)
        while at:
            piece, start = pieces[at], starts[at]
            if piece >= 0:
                found.append(piece)
            else:
                found.extend(reversed(self._unknown_ids(word[start])))
            at = start
        found.reverse()
        return struct.pack(f"<{len(found)}I", *found), score, gap, b"".join([self.letters[i] for i in found])

    def search(self, word: str) -> list[tuple[float, tuple[int, ...]]]:
        """The N best (score, ids) of one lattice, best first; of equal scores the one found first, which the lattice's order settles."""
        n = len(word)
        into: list[list] = [[] for _ in range(n + 1)]
        best = [0.0] + [-np.inf] * n
        for i, j, score, piece in self._edges(word):
            into[j].append((i, score, piece))
            best[j] = max(best[j], best[i] + score)
        # each entry stands for a segmentation of its own, the best of those that end like it, so no more are kept than are still asked for
        found, tick, wanted = [], 0, self.n
        heap = [(-best[n], 0, n, 0.0, None)]
        while heap and wanted:
            _, _, at, done, path = heap.pop(0)
            if at == 0:
                ids = []
                while path is not None:
                    start, piece, path = path
                    ids.extend((piece,) if piece >= 0 else self._unknown_ids(word[start]))
                found.append((done, tuple(ids)))
                wanted -= 1
                continue
            for i, score, piece in into[at]:
                loss = -(done + score + best[i])
                if len(heap) < wanted or loss < heap[-1][0]:
                    tick += 1
                    insort(heap, (loss, tick, i, done + score, (i, piece, path)))
                    del heap[wanted:]
        return found

    def words(self, text: str) -> list[str]:
        """A text's words as the model sees them, each with the marks of the spaces before it."""
        return [w for w in _UNITS.findall(self.sp.normalize(text)) if w]

    def learn(self, words: set[str]) -> None:
        """Remember the best ways of all these words; others are forgotten when there is no room."""
        if len(self.known) + len(words) > CACHE:
            self.known = {w: self.known[w] for w in words & self.known.keys()}
        new = list(words - self.known.keys())
        self.known.update(zip(new, self.viterbi(new), strict=True))

    def nbest(self, text: str, words: list[str] | None = None) -> list[tuple[float, bytes, bytes]]:
        """The N best segmentations of a whole text: score, ids as little-endian unsigned 32-bit, and what the ids spell.

        ``words`` are the text's, where they have been found and learned already.
        """
        if words is None:
            words = self.words(text)
            self.learn(set(words))
        parts = list(map(self.known.__getitem__, words))
        ids, scores, gaps, spelled = zip(*parts, strict=True) if parts else ((), (), (), ())
        score, gaps = sum(scores), np.array(gaps)
        # a sum among the N best departs from the best way only in the N - 1 words with the least gaps
        near = np.argsort(gaps, kind="stable")[: self.n - 1].tolist() if len(parts) <= 4 * self.n else self._least(gaps)
        sums = [(0.0, ())]
        for k in near:
            best, *others = self.search(words[k])
            ways = [(0.0, None)] + [(best[0] - x, struct.pack(f"<{len(other)}I", *other)) for x, other in others]
            sums = heapq.nsmallest(self.n, ((a + b, c if other is None else (*c, (k, other))) for a, c in sums for b, other in ways), key=lambda x: x[0])
        out, decoded = [], b"".join(spelled).replace(_SPACE, b" ")
        for loss, changes in sums:
            if loss < np.inf:
                mine, text_of = list(ids), decoded
                for k, other in changes:
                    mine[k] = other
                # ids spell their words one by one; a whole text is joined anew where a word's new ids spell another
                changed = {k: new for k, other in changes if (new := self._letters(other)) != spelled[k]}
                if changed:
                    text_of = b"".join([changed.get(k, x) for k, x in enumerate(spelled)]).replace(_SPACE, b" ")
                out.append((score - loss, b"".join(mine), text_of))
        return out

    def _least(self, gaps: np.ndarray) -> list[int]:
        bound = np.partition(gaps, self.n - 2)[self.n - 2] if self.n > 1 else -np.inf
        low = np.flatnonzero(gaps <= bound)
        return low[np.argsort(gaps[low], kind="stable")][: self.n - 1].tolist()

    def _letters(self, ids: bytes) -> bytes:
        return b"".join(map(self.letters.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts before a text is taken off."""
        text = self._letters(np.asarray(ids, "<u4").tobytes()).replace(_SPACE, b" ").decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(2)
def piece_model(model_file: str, n: int) -> PieceModel:
    model = PieceModel(model_file, n)
    # the model and what is remembered stay for good and hold no cycles, so a worker need not search them for garbage often
    gc.freeze()
    gc.set_threshold(500_000, 50, 50)
    return model


def _segment(model_file: str, n: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_file, n)
        for b in batches:
            rows, cols = [], [[] for _ in range(6)]
            texts = [text or "" for text in b.column("text").to_pylist()]
            words = list(map(model.words, texts))
            model.learn(set().union(*words))
            for i, text in enumerate(texts):
                last, digest = None, ""
                for rank, (score, ids, decoded) in enumerate(model.nbest(text, words[i])):
                    if decoded is not last:
                        last, digest = decoded, hashlib.sha256(decoded[1:] if decoded.startswith(b" ") else decoded).hexdigest()
                    rows.append(i)
                    found = (rank, score, len(ids) // 4, zlib.crc32(ids), digest, np.frombuffer(ids, "<i4") if with_ids else None)
                    for c, x in zip(cols, found, strict=True):
                        c.append(x)
            kinds = [pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
            names = ["rank", "score", "n_pieces", "ids_crc32", "decoded_sha256", "ids"]
            arrays = [b.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays if with_ids else arrays[:-1], names=["doc_id", *names][: len(arrays) - (not with_ids)])

    return run


def segmentations(docs: DataFrame, model_file: str, n: int = 3, with_ids: bool = True) -> DataFrame:
    """One row per document and rank from 0: doc_id, rank, score, n_pieces, ids_crc32, decoded_sha256, and ids.

    A text with fewer than ``n`` segmentations has fewer rows; null and empty texts have one, without
    pieces. ``decoded_sha256`` is of the text that this rank's ids give back. Of equal scores the one
    that the search meets first comes first; the search follows the lattice's order of starts and ends,
    so a text always gets the same rows. Repeated rows give repeated results; null ids stay; an empty
    table gives no rows. A model with pieces that span the start of a word is refused.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>" if with_ids else ""
    return docs.select("doc_id", "text").mapInArrow(_segment(model_file, n, with_ids), f"doc_id {kind}, rank int, score double, n_pieces long, ids_crc32 long, decoded_sha256 string{more}")
