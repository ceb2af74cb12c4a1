"""Conversation prefix trie over composable fingerprints.

A sequence of turns has the fingerprint sum(t_i * B**(n - i)) modulo the prime 2**127 - 1, where t_i
stands for a turn's role and text. That is a monoid: the fingerprint of two sequences joined follows
from theirs and the second's length. So the prefixes of a rebuilt conversation, some turns of a base
conversation and then the later ones of its own, are combined from the prefix fingerprints of the two;
no rebuilt text is ever put together, a rebuilt turn is a reference to a stored one. Prefixes with
equal fingerprints are a node, and what they refer to is compared: all members' last turns must have
one SHA-256 and their prefixes before it one fingerprint, which by induction makes the whole
sequences equal. Otherwise another B is taken.

Each node is named by its least member and its depth. A conversation that is a node's least member is
it for all deeper nodes of its own, so the trie falls into one path for each conversation, and sums over
subtrees are sums over members of what their paths hold: no walk over levels is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_PATTERN, staged

PRIME = (1 << 127) - 1
#: Turns of one conversation that are joined and summed in one task.
BLOCK = 10_000
#: Parts that the children of a node are dealt over when they ask for it.
SALTS = 64
#: Bytes of ids that are passed on in a row.
ID_BYTES = 1 << 18
#: Most turns that a rebuilt conversation takes from its base.
MOST_HEAD = 3
ATTEMPTS = 8

EMPTY = (0).to_bytes(16, "big")
_TURNS = "conv_id long, pos long, before binary, after binary, digest binary, words long"


def base_of(attempt: int) -> int:
    return int.from_bytes(hashlib.sha256(b"prefix trie %d" % attempt).digest(), "big") % PRIME


def combined(left: int, right: int, right_length: int, base: int) -> int:
    """The fingerprint of two sequences joined."""
    return (left * pow(base, right_length, PRIME) + right) % PRIME


def _int(x: bytes) -> int:
    return int.from_bytes(x, "big")


def _bytes(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _local(base: int):
    """Positions and prefix fingerprints within a range of the sorted turns; at last what its last conversation has come to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, now, count, state = TaskContext.get().partitionId(), None, None, 0, 0
        names = ["part", "in_first", "conv_id", "pos", "before", "after", "digest", "words", "first"]
        for b in batches:
            at, before, after, in_first = [], [], [], []
            convs, digests = b.column("conv_id").to_pylist(), b.column("digest").to_pylist()
            for conv, digest in zip(convs, digests, strict=True):
                if conv != now:
                    first = conv if first is None else first
                    now, count, state = conv, 0, 0
                count += 1
                before.append(_bytes(state))
                state = (state * base + _int(digest)) % PRIME
                after.append(_bytes(state))
                at.append(count)
                in_first.append(conv == first)
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(in_first, pa.bool_()), b.column("conv_id"), pa.array(at, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary()), b.column("digest"), b.column("words"), pa.nulls(n, pa.int64())],
                names=names,
            )
        if now is not None:
            last = [[part], [first == now], [now], [count], [None], [_bytes(state)], [None], [None], [first]]
            types = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(last, types, strict=True)], names=names)

    return run


def _carried(base: int):
    """Positions and fingerprints of a range's first conversation with what earlier ranges hold of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {n: b.column(n).to_pylist() for n in ("pos", "before", "after", "count", "state")}
            before, after = [], []
            for pos, x, y, state in zip(c["pos"], c["before"], c["after"], c["state"], strict=True):
                before.append(_bytes(combined(_int(state), _int(x), pos - 1, base)))
                after.append(_bytes(combined(_int(state), _int(y), pos, base)))
            pos = pa.array([p + k for p, k in zip(c["pos"], c["count"], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pos, pa.array(before, pa.binary()), pa.array(after, pa.binary()), b.column("digest"), b.column("words")], names=["conv_id", "pos", "before", "after", "digest", "words"])

    return run


def _content() -> Column:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def stored_turns(conversations: DataFrame, base: int) -> DataFrame:
    """(conv_id, pos, before, after, digest, words): each turn in its conversation's order with the fingerprints before and after it.

    The turns are dealt to ranges, so one conversation may take many tasks; what each range comes to is
    carried on to the next, one value a range.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", _content().alias("digest"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN)).cast("long").alias("words"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = staged(rows, "turn_digests")
    local = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _local(base), "part int, in_first boolean, conv_id long, pos long, before binary, after binary, digest binary, words long, first long"
    )
    local = staged(local, "local_prefixes")
    carries, held = [], None
    # one row a range
    for r in sorted(local.where("digest is null").collect(), key=lambda r: r["part"]):
        count, state = r["pos"], _int(r["after"])
        if held and held[0] == r["first"]:
            carries.append((r["part"], held[1], bytearray(_bytes(held[2]))))
            if r["in_first"]:
                count, state = held[1] + count, combined(held[2], state, count, base)
        held = (r["conv_id"], count, state)
    carry = conversations.sparkSession.createDataFrame(carries, "part int, count long, state binary")
    turns = local.where("digest is not null").join(F.broadcast(carry), "part", "left")
    moved = F.col("in_first") & F.col("state").isNotNull()
    columns = ["conv_id", "pos", "before", "after", "digest", "words"]
    return staged(turns.where(~moved).select(columns).union(turns.where(moved).mapInArrow(_carried(base), _TURNS)), "turns")


def _rebuilt(base: int):
    """Rebuilt prefixes that end in own turns: base head and own range combined by their fingerprints alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = [1]
        for b in batches:
            c = {n: b.column(n).to_pylist() for n in ("pos", "before", "after", "h", "base_fp", "own_fp")}
            parents, prints = [], []
            for pos, before, after, h, left, own in zip(*c.values(), strict=True):
                k = pos - h
                if left != own:
                    while len(power) <= min(k, BLOCK):
                        power.append(power[-1] * base % PRIME)
                    delta, less = _int(left) - _int(own), power[k - 1] if k <= BLOCK else pow(base, k - 1, PRIME)
                    before = _bytes((delta * less + _int(before)) % PRIME)
                    after = _bytes((delta * less * base + _int(after)) % PRIME)
                parents.append(before)
                prints.append(after)
            keep = ["conv_id", "depth", "digest", "words", "ends"]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in keep), pa.array(prints, pa.binary()), pa.array(parents, pa.binary())], names=[*keep, "fp", "parent"])

    return run


def _block(column: str) -> Column:
    return F.floor(F.col(column) / BLOCK).cast("long")


def _prefixes(turns: DataFrame, base: int, head: Column, base_id: Column) -> DataFrame:
    """(conv_id, depth, fp, parent, digest, words, ends): every prefix of every rebuilt conversation, the empty one included."""
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n_own"))
    firsts = turns.where(F.col("pos") <= MOST_HEAD).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "before", "after", "digest", "words"))).alias("firsts"))
    convs = own.join(firsts, "conv_id").withColumns({"h": head, "base_id": base_id})
    heads = F.coalesce(F.filter("base_firsts", lambda x: x.pos <= F.col("h")), F.array().cast("array<struct<pos:bigint,before:binary,after:binary,digest:binary,words:bigint>>"))
    convs = convs.join(firsts.select(F.col("conv_id").alias("base_id"), F.col("firsts").alias("base_firsts")), "base_id", "left").withColumn("heads", heads)
    # the last of a list that may be empty; h is at most the length of firsts where there are own turns after it
    last = lambda xs, n: F.when(n > 0, F.get(F.transform(xs, lambda x: x.after), n - 1)).otherwise(F.lit(EMPTY))
    n_head = F.size("heads").cast("long")
    convs = staged(convs.select(
        "conv_id", "h", "n_own", "heads", n_head.alias("n_head"), last(F.col("heads"), F.size("heads")).alias("base_fp"), last(F.col("firsts"), F.col("h")).alias("own_fp"),
        (n_head + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length"),
    ), "rebuilt")
    columns = ["conv_id", "depth", "fp", "parent", "digest", "words", "ends"]
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(EMPTY).alias("fp"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"), (F.col("length") == 0).alias("ends"))
    headed = convs.select("conv_id", "length", F.explode("heads").alias("x")).select("conv_id", F.col("x.pos").alias("depth"), F.col("x.after").alias("fp"), F.col("x.before").alias("parent"), F.col("x.digest").alias("digest"), F.col("x.words").alias("words"), (F.col("length") == F.col("x.pos")).alias("ends"))
    # a long conversation's turns meet what is known of it in blocks
    dealt = convs.select("conv_id", "h", "n_head", "base_fp", "own_fp", "length", F.explode(F.sequence(F.lit(0).cast("long"), _block("n_own"))).alias("block"))
    tails = turns.withColumn("block", _block("pos")).join(dealt, ["conv_id", "block"]).where("pos > h").withColumn("depth", F.col("n_head") + F.col("pos") - F.col("h"))
    tails = tails.withColumn("ends", F.col("depth") == F.col("length")).mapInArrow(_rebuilt(base), "conv_id long, depth long, digest binary, words long, ends boolean, fp binary, parent binary")
    return staged(root.union(headed).select(columns).union(tails.select(columns)), "prefixes")


def _id_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a node as comma-joined text, in rows of bounded size."""
    key, first, ids, size = None, None, [], 0
    names = ["depth", "fp", "first", "ids"]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[1]], pa.int64()), pa.array([key[0]], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])], names=names)

    out: list[pa.RecordBatch] = []
    for b in batches:
        for fp, depth, conv in zip(b.column("fp").to_pylist(), b.column("depth").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if (fp, depth) != key or size >= ID_BYTES:
                if ids:
                    out.append(row())
                key, first, ids, size = (fp, depth), conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
            if len(out) >= 256:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
    if ids:
        out.append(row())
    if out:
        yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, whose parts come in order; only the digest so far is held."""
    key, digest, out = None, None, []

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[1] for k, _ in out], pa.int64()), pa.array([k[0] for k, _ in out], pa.binary()), pa.array([d for _, d in out])], names=["depth", "fp", "ends_sha256"])

    for b in batches:
        for fp, depth, ids in zip(b.column("fp").to_pylist(), b.column("depth").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if (fp, depth) != key:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = (fp, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) >= 1000:
            yield table()
            out = []
    if key is not None:
        out.append((key, digest.hexdigest()))
        yield table()


def _ends(prefixes: DataFrame) -> DataFrame:
    """Digest of the conversations that end at a node: sorted over ranges, then as text parts to the one place where a digest is made."""
    order = ["fp", "depth", "conv_id"]
    blocks = prefixes.where("ends").select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_id_blocks, "depth long, fp binary, first long, ids string")
    return blocks.repartition("depth", "fp").sortWithinPartitions("fp", "depth", "first").mapInArrow(_digests, "depth long, fp binary, ends_sha256 string")


def _parents(asking: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, fp, parent_conv_id) of nodes; a parent with very many children answers ``SALTS`` parts of them."""
    dealt = asking.select("depth", "fp", F.col("depth") - 1, "parent").toDF("depth", "fp", "above", "parent").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    asked = dealt.select("above", "parent", "salt").distinct()
    known = asked.join(nodes.select(F.col("depth").alias("above"), F.col("fp").alias("parent"), F.col("conv_id").alias("parent_conv_id")), ["above", "parent"])
    return dealt.join(known, ["above", "parent", "salt"]).select("depth", "fp", "parent_conv_id")


def _nodes(prefixes: DataFrame) -> DataFrame | None:
    """(depth, fp, parent, conv_id, n_convs, words), or None where a fingerprint stands for two sequences."""
    found = staged(prefixes.groupBy("depth", "fp").agg(
        F.min("parent").alias("parent"), F.max("parent").alias("other_parent"), F.min("digest").alias("digest"), F.max("digest").alias("other_digest"),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
    ), "nodes")
    if found.where("parent <> other_parent or digest <> other_digest").take(1):
        return None
    return found.drop("other_parent", "other_digest", "digest")


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_HEAD + 1)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn``, null first, ties by the SHA-256 of role and text (the role's length, a
    colon, role, text); repeated rows are turns of their own. A null role or text is empty. Each
    conversation is rebuilt from the first crc32(id) % 4 turns of conversation id - id % 20 and its own
    after as many; it may come out without a turn. Rows without a conv_id belong to no conversation and
    are left out. An empty table gives no rows; other columns play no part.
    """
    for attempt in range(ATTEMPTS):
        base = base_of(attempt)
        turns = stored_turns(conversations, base)
        prefixes = _prefixes(turns, base, head_length(F.col("conv_id")), F.col("conv_id") - F.col("conv_id") % 20)
        nodes = _nodes(prefixes)
        if nodes is not None:
            break
    else:
        raise ArithmeticError("fingerprints of different sequences are equal for all bases")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("fp")).agg(F.count("*").alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("words")
    nodes = nodes.join(children, ["depth", "fp"], "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "saved": saved, "block": _block("depth")})
    nodes = staged(nodes, "trie")
    # what each conversation's path holds, and what it holds from a depth on
    paths = nodes.groupBy("conv_id").agg(F.sum("saved").alias("path"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.max("block").alias("last"))
    over = Window.partitionBy("conv_id").orderBy(F.desc("block"))
    blocks = nodes.groupBy("conv_id", "block").agg(F.sum("saved").alias("whole"))
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("whole").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("later"), F.min("block").over(Window.partitionBy("conv_id")).alias("first_block"), F.sum("whole").over(Window.partitionBy("conv_id")).alias("path"))
    within = Window.partitionBy("conv_id", "block")
    onward = nodes.join(blocks, ["conv_id", "block"]).select(
        "depth", "fp", "parent", "conv_id", "n_convs", "n_children", "path", (F.col("later") + F.sum("saved").over(within.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0))).alias("onward"),
        ((F.min("depth").over(within) == F.col("depth")) & (F.col("block") == F.col("first_block"))).alias("starts"),
    )
    dealt = paths.select("conv_id", "path", "leaves", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("block"))
    members = prefixes.withColumn("block", _block("depth")).join(dealt, ["conv_id", "block"])
    under = members.groupBy("depth", "fp").agg(F.sum("path").alias("paths"), F.sum("leaves").alias("n_leaves"))
    onward = staged(onward, "paths")
    parents = _parents(onward.where("starts and depth > 0"), nodes)
    whole = onward.join(under, ["depth", "fp"]).join(parents, ["depth", "fp"], "left").join(_ends(prefixes), ["depth", "fp"], "left")
    return whole.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", F.when(~F.col("starts"), F.col("conv_id")))).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("paths") - F.col("path") + F.col("onward")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
