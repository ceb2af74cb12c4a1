"""Line dedup, whitening and the prefix trie against brute force, and on nulls, ties, repeats, hot keys and empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

queries = pytest.importorskip("gridflume.llm.queries")
from gridflume.llm import line_dedup, prefix_trie, whitening  # noqa: E402

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, h1 string, doc string, position string, docs string"


def line_table(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], DOCS).repartition(parts)


def plain_lines(rows):
    """Per row: (doc_id, n_lines, n_dropped, kept text), by reading everything at once."""
    holders = defaultdict(set)
    order = lambda i: line_dedup.NO_ID if i is None else i
    key = lambda line: line.strip(SPACE).translate(LOWER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and order(i) < max(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def comparable(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


COMMON, OTHER = "a line that very many documents hold", "ÄÖ zweite Zeile, überall zu finden"
LINES = [
    (1, None), (2, ""), (3, "\n\n"), (4, f"{COMMON}\nown four\n{OTHER}"), (5, f"\t{COMMON.upper()} \r\nown"), (6, f"{COMMON}\n{COMMON}\n{COMMON}\nend"),
    (7, OTHER), (8, OTHER.replace("Ä", "ä")), (9, f"x\n{OTHER}\n"), (9, f"other text of nine\n{COMMON}"), (9, f"other text of nine\n{COMMON}"), (None, COMMON), (None, f"{COMMON}\nleft"),
    (-3, "exactly twenty chars\nnineteen characters"), (-4, "exactly twenty chars\nnineteen characters"), (-5, "EXACTLY twenty chars\nnineteen characters"), (10, "long \n" * 3000 + COMMON),
]


def test_line_dedup_brute_force(spark):
    found = line_dedup.deduplicated(line_table(spark, LINES)).collect()
    assert comparable((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found) == comparable(plain_lines(LINES))


def test_line_bitmaps_say_what_stays(spark):
    found = line_dedup.keep_bitmaps(line_table(spark, LINES)).collect()
    texts = Counter()
    for r in found:
        of = [t or "" for i, t in LINES if i == r["doc_id"] and len((t or "").split("\n")) == r["n_lines"]]
        gone = (~line_dedup.stays(r["keep_bitmap"], r["n_lines"])).sum()
        assert of and gone == r["n_dropped"] and (r["keep_bitmap"] is None) == (gone == 0)
        texts[r["doc_id"]] += 1
    assert texts == Counter(i for i, _ in LINES)


def test_a_line_of_many_documents_over_many_ranges(spark):
    rows = [(i, f"{COMMON}\nline of {i} that no one else has at all\n{OTHER if i % 2 else 'short'}") for i in range(3000)]
    found = line_dedup.deduplicated(line_table(spark, rows, 16)).collect()
    assert comparable((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found) == comparable(plain_lines(rows))


def test_streams_lose_no_run_at_ends_of_ranges_or_batches():
    rng = np.random.default_rng(3)
    for trial in range(60):
        n = int(rng.integers(1, 120))
        rows = sorted({(int(rng.integers(0, 4)), int(rng.integers(0, 2)), -int(rng.integers(0, 9)), int(rng.integers(0, 2)), int(rng.integers(0, 5))) for _ in range(n)})
        columns = [np.array([r[k] for r in rows]) for k in range(5)]
        columns[2], columns[4] = -columns[2], columns[4].astype(np.int32)
        cuts = sorted(rng.integers(0, len(rows) + 1, int(rng.integers(0, 6))))
        gone, open_rows, docs = [], [], defaultdict(set)
        for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            stream, at, out = line_dedup._Stream(), lo, []
            while at < hi:
                end = min(hi, at + int(rng.integers(1, 20)))
                out += stream.read(*(c[at:end] for c in columns))
                at = end
            out += stream.close()
            for r in pa.Table.from_batches(out).to_pylist() if out else []:
                if r["docs"] is not None:
                    docs[r["h1"], r["h2"]] |= set(r["docs"])
                elif r["h1"] is None:
                    gone.append((r["doc"], r["text_hash"], r["position"]))
                else:
                    open_rows.append((r["h1"], r["h2"], r["doc"], r["text_hash"], r["position"]))
        gone += [r[2:] for r in open_rows if len(docs[r[:2]]) >= 3 and r[2] < max(docs[r[:2]])]
        holders = defaultdict(set)
        for h1, h2, d, _, _ in zip(*columns, strict=True):
            holders[h1, h2].add(d)
        want = [(d, t, p) for h1, h2, d, t, p in zip(*(c.tolist() for c in columns), strict=True) if len(holders[h1, h2]) >= 3 and d < max(holders[h1, h2])]
        assert sorted(gone) == sorted(want), trial


def test_line_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert line_dedup.deduplicated(empty).count() == 0 and line_dedup.keep_bitmaps(empty).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, x string, n string, component string"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], VECTORS).repartition(4)


def vectors_of(rng, n, dims):
    return (rng.normal(size=(n, dims)) * np.linspace(0.05, 0.4, dims)).astype(np.float32)


def test_whitening_brute_force(spark):
    rng = np.random.default_rng(4)
    dims, each = 12, vectors_of(rng, 400, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(each)] + [(5, each[7].tolist()), (None, each[8].tolist()), (400, each[7].tolist()), (400, each[7].tolist())]
    bad = [(900, None), (901, [None, *each[0].tolist()[1:]]), (902, [float("nan"), *each[0].tolist()[1:]]), (903, [float("inf")] * dims), (904, []), (905, [1.0]), (906, [3e38] * dims)]
    found = whitening.whitened(vector_table(spark, rows + bad)).collect()
    x = np.floor(256 * np.array([v for _, v in rows], float)).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    values, parts = np.linalg.eigh(v)
    values, parts = values[::-1][:4], parts[:, ::-1][:, :4]
    assert len(found) == 4 * len(rows) and {r["n"] for r in found} == {n}
    got = defaultdict(list)
    for r in found:
        got[r["component"], r["vec_id"]].append(r)
    for k in range(4):
        want = (x - s / n) @ parts[:, k] / np.sqrt(values[k])
        sign = np.sign(want[3]) * np.sign(got[k + 1, 3][0]["whitened"])
        for (i, _), w, z in zip(rows, want, x, strict=True):
            deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(z, s, strict=True))
            assert any(r["deviation"] == deviation and abs(sign * w - r["whitened"]) < 1e-9 for r in got[k + 1, i])
        assert abs(got[k + 1, 3][0]["explained"] / (values[k] / np.trace(v)) - 1) < 1e-12
    assert max(r["identity_error"] for r in found) < 1e-12


@pytest.mark.parametrize("case", ["spread", "close", "equal", "steep", "low rank"])
def test_refined_eigenvectors(case):
    dims, rng = 40, np.random.default_rng(5)
    values = {
        "spread": np.linspace(1, 100, dims), "close": np.r_[50 + 1e-9 * np.arange(15), 3 + 1e-6 * np.arange(10), np.linspace(5, 9, 15)], "equal": np.r_[np.full(8, 5.0), np.ones(32)],
        "steep": 10.0 ** -np.linspace(0, 14, dims), "low rank": np.r_[1.0, 2, 3, np.zeros(37)],
    }[case]
    q = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    a = ((q * values) @ q.T).astype(np.longdouble)
    a = (a + a.T) / 2
    found, x = whitening.refined(a)
    scale = values.max()
    assert np.abs(a @ x - x * found).max() < 2e-15 * scale and np.abs(x.T @ x - np.eye(dims)).max() < 1e-16
    assert (np.diff(found.astype(float)) <= 1e-15 * scale).all() and np.abs(np.sort(values)[::-1] - found).max() < 1e-13 * scale


def test_covariance_is_exact_where_sums_of_squares_cancel():
    x = [[10**12 + i % 3, -(10**12) + i * i % 5] for i in range(50)]
    n, first = len(x), [sum(c) for c in zip(*x, strict=True)]
    second = np.array([[sum(r[i] * r[j] for r in x) for j in range(2)] for i in range(2)], object)
    got = whitening.covariance(n, first, second)
    for i in range(2):
        for j in range(2):
            want = Fraction(second[i, j], n) - Fraction(first[i] * first[j], n * n)
            assert abs(Fraction(*float(got[i, j]).as_integer_ratio()) - want) <= abs(want) / 2**52


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whitened(vector_table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    assert whitening.whitened(vector_table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).count() == 0
    line = whitening.whitened(vector_table(spark, [(i, [i / 256, 2 * i / 256]) for i in range(5)])).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12


def test_deviation_beyond_a_long_is_null(spark):
    found = whitening.whitened(vector_table(spark, [(1, [2.0**40, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.5])])).collect()
    assert all(r["deviation"] is None for r in found) and {r["n"] for r in found} == {3}


TURNS = "conv_id long, turn long, role string, text string, pos string, depth string"


def plain_trie(rows):
    content = lambda role, text: (role or "", text or "")
    digest = lambda c: hashlib.sha256(f"{len(c[0])}:{c[0]}{c[1]}".encode()).digest()
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(content(role, text)), content(role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        rebuilt[c] = own.get(base, [])[:h] + ts[h:]
    nodes = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    out = []
    for seq, members in nodes.items():
        under = [s for s in nodes if s[: len(seq)] == seq]
        kids = lambda s: sum(len(k) == len(s) + 1 and k[: len(s)] == s for k in nodes)
        words = lambda s: len(s[-1][1].encode().split()) if s else 0
        ends = ",".join(str(c) for c in sorted(c for c in members if len(rebuilt[c]) == len(seq)))
        out.append((
            min(members), len(seq), min(nodes[seq[:-1]]) if seq else None, len(members), kids(seq), sum(kids(s) == 0 for s in under),
            sum((len(nodes[s]) - 1) * words(s) for s in under), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def found_trie(df):
    return [tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in prefix_trie.prefix_trie(df).collect()]


def conversations(rng):
    say = ["hi", "hello there", None, "", "tell me more", "a b c d"]
    rows = []
    for c in [*range(0, 70), -1, -25, -40, 1000, 1001]:
        if c in (20, 1000):  # an absent base for 21 to 39, a conversation without its base
            continue
        for k in range(int(rng.integers(1, 7))):
            rows.append((c, None if rng.random() < 0.1 else k if rng.random() < 0.9 else 0, ["user", "assistant", None][k % 2 if rng.random() < 0.95 else 2], say[int(rng.integers(0, len(say)))]))
    rows += [rows[3], rows[3], (None, 1, "user", "nobody's")]
    return rows


@pytest.mark.parametrize("block", [10_000, 2])
def test_prefix_trie_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = conversations(np.random.default_rng(6))
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(6)
    assert comparable(found_trie(df)) == comparable(plain_trie(rows))


def test_prefix_trie_of_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 7)
    rows = [(c, k, "user", f"same {k}") for c in range(0, 400) for k in range(3)] + [(403, k, "user", f"same {k % 5}") for k in range(150)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(9)
    assert comparable(found_trie(df)) == comparable(plain_trie(rows))


def test_fingerprints_compose():
    base, rng = prefix_trie.base_of(0), np.random.default_rng(7)
    turns = [int(x) for x in rng.integers(0, 2**62, 12)]
    whole = lambda ts: sum(t * pow(base, len(ts) - 1 - i, prefix_trie.PRIME) for i, t in enumerate(ts)) % prefix_trie.PRIME
    for cut in range(13):
        assert prefix_trie.combined(whole(turns[:cut]), whole(turns[cut:]), 12 - cut, base) == whole(turns)


def test_prefixes_that_a_weak_base_confuses_are_told_apart(spark, monkeypatch):
    # with base 1 the order of turns is lost, so (a, b) and (b, a) share a fingerprint: the references differ and the next base is taken
    monkeypatch.setattr(prefix_trie, "base_of", lambda attempt, real=prefix_trie.base_of: 1 if attempt == 0 else real(attempt))
    rows = [(c, k, "user", t) for c, ts in [(1000001, "ab"), (1000002, "ba"), (1000003, "abc"), (1000004, "bac")] for k, t in enumerate(ts * 3)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    assert comparable(found_trie(df)) == comparable(plain_trie(rows))


def test_prefix_trie_of_nothing(spark):
    assert found_trie(spark.createDataFrame([], TURNS)) == []
    assert found_trie(spark.createDataFrame([(None, 1, "user", "x", "", "")], TURNS)) == []
