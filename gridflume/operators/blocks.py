"""The rounds of a projection over packed blocks, many of them in one Spark job.

A block of sources holds cells with the links of their sources, a block of targets holds goals. A block of sources asks the blocks of
targets with one partial sum for each target of its links, and is answered with one number for each. Links stay where they are and
depths pass through the shuffles, so that a chain of rounds uses no table twice and needs no action between them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame

from ..checkpoints import staged
from . import reconcile

# Kinds of rows in a block of sources.
LINK, CELL = 0, 1
#: Rounds between two looks at whether any target is still active; a round without one changes nothing.
ROUNDS_A_JOB = 6


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _table(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all()


def packed(df: DataFrame, name: str, block: str | None = None) -> RDD:
    """A record (block, its rows as a stream of Arrow's) for each block: a partition, or what has the same number in the column ``block``, all in one partition.

    They are staged: a shuffle that is read again gives its rows in another order, and what is made from a block must fit the rest of it.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if x.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            parts = {k.as_py(): table.filter(pc.equal(table[block], k)) for k in pc.unique(table[block])} if block else {TaskContext.get().partitionId(): table}
            for k, part in parts.items():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "data": pa.array([_stream(part)], pa.binary())})

    return staged(df.mapInArrow(pack, "block int, data binary"), name).rdd.map(lambda r: (r["block"], bytes(r["data"])))


def unpacked(streams: RDD, schema: str, like: DataFrame) -> DataFrame:
    """The rows of streams of Arrow's."""

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield from _table(data.as_py()).to_batches(max_chunksize=50_000)

    return like.sparkSession.createDataFrame(streams.map(lambda data: (bytearray(data),)), "data binary").mapInArrow(unpack, schema)


def _different(values: pa.ChunkedArray) -> pa.Array:
    return pc.drop_null(pc.unique(values))


def _at(values: pa.ChunkedArray | pa.Array, among: pa.Array) -> np.ndarray:
    """Where each value is among others, -1 where it is not or is null."""
    return pc.fill_null(pc.index_in(values, value_set=among, skip_nulls=True), -1).to_numpy().astype(np.int64)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Doubles, NaN for null."""
    return pc.fill_null(column, float("nan")).to_numpy()


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, mask=np.isnan(values))


def _groups(table: pa.Table, by: list[str]) -> tuple[np.ndarray, list[str]]:
    """The group of each row, -1 where a key is null, and of each group a name that is the same in all blocks."""
    code, known = np.zeros(table.num_rows, np.int64), np.ones(table.num_rows, bool)
    for name in by:
        among = _different(table[name])
        at = _at(table[name], among)
        known &= at >= 0
        code = code * max(1, len(among)) + at
    rows = np.flatnonzero(known)
    _, first, group = np.unique(code[rows], return_index=True, return_inverse=True)
    out = np.full(table.num_rows, -1, np.int64)
    out[rows] = group
    return out, [repr(list(k.values())) for k in table.select(by).take(pa.array(rows[first])).to_pylist()] if by else ["[]"] * len(first)


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, NaN where b is zero."""
    return np.divide(a, b, out=np.full(len(b), np.nan), where=b > 0)


class Sources:
    """A block's cells in the order of their rows, its links, and slots: the targets, by group, that cells have links to."""

    def __init__(self, table: pa.Table, by: list[str], blocks: int, upper: str | None):
        links, cells = table.filter(pc.equal(table["kind"], LINK)), table.filter(pc.equal(table["kind"], CELL))
        among, dst = _different(links["src"]), _different(links["dst"])
        s, d, w = _at(links["src"], among), _at(links["dst"], dst), _numbers(links["value"])
        self.n, self.targets, self.base = len(among), len(dst), _numbers(cells["value"])
        self.upper = _numbers(cells[upper]) if upper else None
        self.group, self.names = _groups(cells, by)
        at = _at(cells["src"], among)
        wide = np.append(np.bincount(s, w, self.n), np.nan)
        self.wide = wide[at]
        # targets are numbered in the order of their blocks
        linked = d >= 0
        s, d, w, to = s[linked], d[linked], w[linked], links["to"].to_numpy()[linked]
        block = np.zeros(self.targets, np.int64)
        block[d] = to
        order = np.argsort(block, kind="stable")
        place = np.empty(self.targets, np.int32)
        place[order] = np.arange(self.targets)
        self.s, self.d, self.w, block, dst = s.astype(np.int32), place[d], w, block[order], dst.take(pa.array(order))
        # of each group the rows, their sources, the links of these (None: all) and their targets
        self.groups, weights, slot, owner = [], [], [], []
        order = np.argsort(self.group, kind="stable")
        cuts = np.searchsorted(self.group[order], np.arange(len(self.names) + 1))
        for g in range(len(self.names)):
            rows = order[cuts[g]:cuts[g + 1]]
            rows = rows[at[rows] >= 0]
            times = np.bincount(at[rows], minlength=self.n)
            chosen = None if times.all() else np.flatnonzero(times[self.s])
            s, d, w = self._links(chosen)
            touched = np.unique(d)
            self.groups.append((rows, at[rows], chosen, touched))
            weights.append(np.bincount(d, w * times[s], self.targets)[touched])
            slot.append(touched)
            owner.append(np.full(len(touched), g))
        slot, owner = _joined(slot, np.int32), _joined(owner, np.int64)
        # slots are sent block by block
        self.sent = np.lexsort((slot, owner, block[slot]))
        self.cuts = np.searchsorted(block[slot][self.sent], np.arange(blocks + 1))
        self.known = owner[self.sent], dst.take(pa.array(slot[self.sent])), _joined(weights, float)[self.sent]

    def _links(self, chosen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (self.s, self.d, self.w) if chosen is None else (self.s[chosen], self.d[chosen], self.w[chosen])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of each slot the sum of weights times its cells' values."""
        out = []
        for rows, at, chosen, touched in self.groups:
            s, d, w = self._links(chosen)
            out.append(np.bincount(d, w * np.bincount(at, values[rows], self.n)[s], self.targets)[touched])
        return _joined(out, float)[self.sent]

    def back(self, answers: dict[int, np.ndarray]) -> np.ndarray:
        """Of each cell the sum of weights times what the blocks answered for its slots."""
        sent, plain = np.zeros(len(self.sent)), np.empty(len(self.sent))
        for q, values in answers.items():
            sent[self.cuts[q]:self.cuts[q + 1]] = values
        plain[self.sent] = sent
        out, began = np.zeros(len(self.base)), 0
        for rows, at, chosen, touched in self.groups:
            s, d, w = self._links(chosen)
            each = np.zeros(self.targets)
            each[touched] = plain[began:began + len(touched)]
            began += len(touched)
            out[rows] = np.bincount(s, w * each[d], self.n)[at]
        return out

    def asks(self, block: int, *values: np.ndarray) -> Iterator[tuple]:
        sums = [self.sums(v) for v in values]
        for q in range(len(self.cuts) - 1):
            part = slice(self.cuts[q], self.cuts[q + 1])
            if part.stop > part.start:
                yield q, ("ask", block, [s[part] for s in sums])

    def first_asks(self, block: int, values: np.ndarray) -> Iterator[tuple]:
        """Asks that tell what the slots are; they go to all blocks, which answer which groups have active targets."""
        sums, (owner, dst, weights) = self.sums(values), self.known
        for q in range(len(self.cuts) - 1):
            part = slice(self.cuts[q], self.cuts[q + 1])
            yield q, ("first", block, self.names, owner[part], dst.take(pa.array(np.arange(part.start, part.stop))), weights[part], sums[part])
        self.known = None


class Targets:
    """A block's goals in the order of their rows, and where the slots of each block of sources are among them."""

    def __init__(self, table: pa.Table, by: list[str], upper: str | None):
        self.total, self.upper = _numbers(table["total"]), _numbers(table[upper]) if upper else None
        self.group, names = _groups(table, by)
        self.index, self.among = {name: g for g, name in enumerate(names)}, _different(table["dst"])
        at = _at(table["dst"], self.among)
        code = np.where((self.group >= 0) & (at >= 0), self.group * len(self.among) + at, -1)
        self.keys = np.unique(code[code >= 0])
        self.row = np.where(code >= 0, np.searchsorted(self.keys, code), -1)
        self.slots, self.names, self.weight = {}, {}, np.zeros(len(self.keys))

    def meet(self, block: int, names: list[str], owner: np.ndarray, dst: pa.Array, weights: np.ndarray) -> None:
        group, at = np.array([self.index.get(name, -1) for name in names], np.int64)[owner], _at(dst, self.among)
        code = np.where((group >= 0) & (at >= 0), group * len(self.among) + at, -1)
        place = np.searchsorted(self.keys, code)
        found = np.append(self.keys, -1)[place] == code
        self.names[block], self.slots[block] = names, np.where(found & (code >= 0), place, -1).astype(np.int32)
        self.weight += self._added({block: weights})

    def _added(self, sums: dict[int, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(self.keys))
        for block in sorted(sums):
            held = self.slots[block] >= 0
            out += np.bincount(self.slots[block][held], sums[block][held], len(self.keys))
        return out

    def estimates(self, sums: dict[int, np.ndarray]) -> np.ndarray:
        """Of each goal the weighted mean over its links, NaN where it has none."""
        return np.append(_share(self._added(sums), self.weight), np.nan)[self.row]

    def answers(self, values: np.ndarray) -> dict[int, np.ndarray]:
        held = self.row >= 0
        each = np.append(np.bincount(self.row[held], values[held], len(self.keys)), 0.0)
        return {block: each[slots] for block, slots in self.slots.items()}


def _by_block(step: Callable, *given) -> Callable:
    def run(records: Iterable[tuple]) -> Iterator[tuple]:
        blocks = defaultdict(lambda: defaultdict(list))
        for block, (tag, *x) in records:
            blocks[block][tag].append(x)
        for block, held in blocks.items():
            yield from step(block, held, *given)

    return run


def _passed(block: int, held: dict, tag: str) -> Iterator[tuple]:
    for x in held.get(tag, ()):
        yield block, (tag, *x)


def _first(block: int, held: dict, b, by: list[str], blocks: int, upper: str | None) -> Iterator[tuple]:
    """From rows to a block of sources and its first asks."""
    table = _table(held["rows"][0][0])
    found = Sources(table, by, blocks, upper)
    if not len(found.base):
        return
    depths = np.nan_to_num(found.base)
    yield from found.first_asks(block, depths)
    yield block, ("depths", {"corrected": depths})
    yield block, ("sources", found)
    yield block, ("cells_table", _stream(table.filter(pc.equal(table["kind"], CELL)).select([*by, "src", "value"])))


def _meet(block: int, held: dict, b, by: list[str], blocks: int, upper: str | None) -> Iterator[tuple]:
    """From goals and first asks to a block of targets; a dry base with a wet total answers seeds if it may."""
    yield from _passed(block, held, "depths")
    if "goals_table" not in held:
        return
    found = Targets(_table(held["goals_table"][0][0]), by, upper)
    for p, names, owner, dst, weights, _ in sorted(held.get("first", ()), key=lambda x: x[0]):
        found.meet(p, names, owner, dst, weights)
    e, total = found.estimates({x[0]: x[-1] for x in held.get("first", ())}), found.total
    dry_base = (total > b.dry) & ~(e > b.dry)
    if b.synthetic:
        seeds = (found.answers(np.where(dry_base, total, 0.0)), found.answers(dry_base.astype(float)))
        for p in found.slots:
            yield p, ("answer", block, [s[p] for s in seeds], ())
    n = len(total)
    yield block, ("goals", {"dry_base": dry_base, "estimate": e, "last": np.zeros(n, np.int32), "capped": np.zeros(n, bool), "active": 0})
    yield block, ("targets", found)


def _ask(block: int, held: dict, b, k: int) -> Iterator[tuple]:
    """Round ``k`` of a block of sources: move depths by the answers of the round before, and ask again."""
    yield from _passed(block, held, "goals")
    if "depths" not in held:
        return
    found, now = held["sources"][0][0], held["depths"][0][0]
    answers, base, c = held.get("answer", ()), found.base, now["corrected"]
    given = ~np.isnan(base)
    if k == 1 and b.synthetic:
        total, times = (found.back({q: values[i] for q, values, _ in answers}) for i in (0, 1))
        seed = _share(total, times)
        now["corrected"] = c = now["start"] = np.where((c <= b.dry) & (seed > 0), seed, c)
    greatest = np.fmax(base, now.get("start", base))
    limit = lambda times: np.where(given, np.fmin(greatest * times, b.most_depth), 0.0)
    lo, hi = limit(b.cumulative[0]), limit(b.cumulative[1] if found.upper is None else found.upper)
    if k == 1:
        yield from found.asks(block, hi, c)
    else:
        if k == 2:
            names = {name for *_, on in answers for name in on}
            now["on"] = np.array([name in names for name in found.names] + [False])
        change = found.back({q: values[0] for q, values, _ in answers if values})
        moved = np.minimum(np.maximum(c * (1 + np.nan_to_num(change / found.wide)), lo), hi)
        now["corrected"] = c = np.where(now["on"][found.group], moved, c)
        yield from found.asks(block, c)
    yield block, ("depths", now)


def _answer(block: int, held: dict, b, k: int) -> Iterator[tuple]:
    """Round ``k`` of a block of targets: ratios of those that are off; after the last one only estimates."""
    yield from _passed(block, held, "depths")
    if "goals" not in held:
        return
    found, now, asks = held["targets"][0][0], held["goals"][0][0], held.get("ask", ())
    total = found.total
    now["estimate"] = e = found.estimates({p: sums[-1] for p, sums in asks})
    wet = total > b.dry
    with np.errstate(all="ignore"):
        if k == 1:
            most = found.estimates({p: sums[0] for p, sums in asks})
            now["beyond"] = beyond = wet & ~(total <= most * (1 + b.tolerance))
            now["eligible"] = ~np.isnan(total) & ~beyond & (b.synthetic | ~now["dry_base"])
        active = now["eligible"] & (np.abs(e - total) / np.fmax(total, 1.0) > b.tolerance)
        now["unmet"], now["active"] = active, 0
        if k <= b.rounds:
            most = b.ratio[1] if found.upper is None else found.upper
            moves, wanted = wet & (e > b.dry), total / e
            ratio = np.where(moves, np.fmin(np.fmax(wanted, b.ratio[0]), most) ** b.damping, np.where(total <= b.dry, 0.0, 1.0))
            # rows of one target are capped together
            capped = np.zeros(len(found.keys) + 1, bool)
            capped[found.row[active & moves & ((wanted < b.ratio[0]) | (wanted > most))]] = True
            now["capped"] = now["capped"] | capped[found.row]
            now["last"] = np.where(active, k, now["last"]).astype(np.int32)
            now["active"] = int(active.sum())
            on = {found.group[i] for i in np.flatnonzero(active)} if k == 1 else ()
            if active.any():
                for p, x in found.answers(np.where(active, ratio - 1, 0.0)).items():
                    names = [name for name in found.names[p] if found.index.get(name) in on] if on else ()
                    if names or x.any():
                        yield p, ("answer", block, [x] if x.any() else None, names)
    yield block, ("goals", now)


def _ended(block: int, held: dict, b) -> Iterator[tuple]:
    """Rows of cells and of targets, with what was found."""
    if "depths" in held:
        yield "cells", _stream(_table(held["cells_table"][0][0]).append_column("corrected", pa.array(held["depths"][0][0]["corrected"])))
    if "goals" in held:
        now, table = held["goals"][0][0], _table(held["goals_table"][0][0])
        total = _numbers(table["total"])
        flags = np.isnan(total) * reconcile.TARGET_MISSING + (total <= b.dry) * reconcile.TARGET_DRY + now["dry_base"] * (reconcile.BASE_DRY + b.synthetic * reconcile.SYNTHETIC)
        flags = flags + (now["beyond"] | now["capped"]) * reconcile.RATIO_CAPPED + now["unmet"] * reconcile.NOT_CONVERGED
        more = {"residual": _nullable(now["estimate"] - total), "flags": pa.array(flags.astype(np.int32)), "last": pa.array(now["last"]), "unmet": pa.array(now["unmet"])}
        for name, values in more.items():
            table = table.append_column(name, values)
        yield "goals", _stream(table)


def _block(key: int) -> int:
    return key


def rounds(sources: DataFrame, goals: DataFrame, by: list[str], blocks: tuple[int, int], b, upper: str | None = None) -> tuple[RDD, list[RDD]]:
    """Streams of cells (by, src, value, corrected) and of goals (by, dst, total, residual, flags, last, unmet), each with its kind, and what to unpersist after use.

    ``sources`` has rows (kind, by, src, dst, value, to) of links and cells, a source's all in one partition; ``goals`` (by, dst, total, to) have in ``to``
    the block that links to them have, its goals all in one partition. ``blocks`` tells how many of each there are at most.
    """
    kept: list[RDD] = []

    def keep(rdd: RDD) -> RDD:
        kept.append(rdd.persist(StorageLevel.MEMORY_AND_DISK))
        return rdd

    # what only passes goes along with a block whose number leaves the same rest
    by_source, by_target = (lambda rdd, n=n: rdd.partitionBy(n, _block) for n in blocks)
    only = lambda rdd, *tags: rdd.filter(lambda x: x[1][0] in tags)
    given = (b, by, blocks[1], upper)
    first = keep(packed(sources, "sources").map(lambda x: (x[0], ("rows", x[1]))).mapPartitions(_by_block(_first, *given)))
    held = keep(packed(goals, "goals", "to").map(lambda x: (x[0], ("goals_table", x[1]))))
    fixed = keep(by_source(only(first, "sources")))
    tables = by_source(only(first, "cells_table").union(held))
    met = keep(by_target(only(first, "first", "depths").union(held)).mapPartitions(_by_block(_meet, *given)))
    asked = keep(by_target(only(met, "targets")))
    now = only(met, "goals", "depths", "answer")
    for k in range(1, b.rounds + 2):
        now = fixed.union(by_source(now)).mapPartitions(_by_block(_ask, b, k))
        now = asked.union(by_target(now)).mapPartitions(_by_block(_answer, b, k))
        if k % ROUNDS_A_JOB == 0 or k > b.rounds:
            now = keep(now)
            if not only(now, "goals").map(lambda x: x[1][1]["active"]).sum():
                break
    return tables.union(by_source(only(now, "goals", "depths"))).mapPartitions(_by_block(_ended, b)), kept
