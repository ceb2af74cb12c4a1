"""The training-data operators against brute force, and on nulls, ties, repeats, long texts and empty tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

queries = pytest.importorskip("gridflume.llm.queries")
from gridflume.llm import components, embeddings, exact_dedup, katz, language, nbest, packing, simhash, substring, toxicity, urls  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, norm string, fp long, digest string, w long"


def docs(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1, "d", 2) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


def passage(k, n):
    return " ".join(f"w{k}x{i % 97}y{i * i % 89}" for i in range(n))


ODD = [None, "", " ", "\n\t", "one", "One", "one ", "two  words", "two words", "two words", "é ü", "long " * 3000, passage(1, 200), passage(1, 200), "head " + passage(1, 120) + " tail", passage(2, 49), passage(2, 50)]


def test_exact_dedup_brute_force(spark):
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(docs(spark, ODD)).collect()}
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in ODD]
    for i, t in enumerate(norm):
        same = [k for k, u in enumerate(norm) if u == t]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"], got[i]["text_sha256"]) == (same[0], len(same), i == same[0], hashlib.sha256(t.encode()).hexdigest())


def test_counting_filter_merges_losslessly():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50, 400).astype(np.uint64) << np.uint64(38), rng.integers(0, 80, 300).astype(np.uint64) << np.uint64(38)
    f = exact_dedup.CountingQuotientFilter
    both = f.merged([f.of(a), f.of(b)])
    assert dict(zip(both.fingerprints().tolist(), both.counters.tolist(), strict=True)) == Counter(a.tolist() + b.tolist())
    assert sum(len(p.remainders) for _, p in both.slices(12)) == len(both.remainders)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_brute_force(spark):
    base = passage(3, 400)
    texts = [*ODD, base, base + " extra", base.replace("w3x5y25", "zzz", 1), base.upper()]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for a, b in itertools.combinations(range(len(texts)), 2):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                label[a] = label[b] = min(label[a], label[b])
    for i, p in enumerate(prints):
        assert got[i]["fingerprint"] == f"{p:016x}" and got[i]["component_id"] == label[i]


def test_simhash_tiles_lose_no_link(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60).tolist()
    values = sorted({v ^ (1 << int(a)) ^ (1 << int(b)) for v in base for a, b in rng.integers(0, 64, (6, 2))} | set(base))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components.components(simhash.near_edges(df)).collect()}
    for a, b in itertools.combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= 2:
            assert roots[signed[a]] == roots[signed[b]]


def test_components_of_chains_and_noise(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 100)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}


def plain_removal(texts):
    words = [(t or "").encode().split() for t in texts]
    first = {}
    for i, w in enumerate(words):
        for p in range(len(w) - 49):
            first.setdefault(tuple(w[p : p + 50]), i)
    out = []
    for i, w in enumerate(words):
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        out.append((len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return out


def test_substring_brute_force(spark):
    p = passage(4, 300)
    texts = [*ODD, p, "a b " + p[:900] + " c", passage(5, 60) + " x " + passage(5, 60), "q " + passage(5, 60), "same " * 500, "same " * 80, p.replace("w4x50y12", "other"), passage(6, 50), passage(6, 50) + " more"]
    got = {r["doc_id"]: r for r in substring.repeated_passages(docs(spark, texts)).collect()}
    for i, want in enumerate(plain_removal(texts)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == want


def test_substring_null_ids_and_repeated_rows(spark):
    p = passage(7, 80)
    got = substring.repeated_passages(docs(spark, [p, p, p + " z", "k " + p, "k " + p], [None, 4, 6, 9, 9])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("4", 0), ("6", 80), ("9", 80), ("9", 80), ("None", 0)]


def test_packing_brute_force(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.BYTE_BPE)
    texts = [*ODD, "a <|endoftext|> b", "x y  z\n\nq \n r", " lead", "trail ", "it's 12345 !!! ünïcødé 漢字", passage(8, 3000)]
    got = packing.packed(docs(spark, texts), queries.BYTE_BPE, 512).toPandas()
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        mine = got[got.doc_id == i].sort_values("piece")
        assert mine.start.tolist() == [0, *mine.length.cumsum().tolist()[:-1]] and mine.length.sum() == len(ids)
        assert (mine.length.iloc[1:] == 512).all() and mine.length.max() <= 512
        for r in mine.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    at = got.sort_values(["sequence_id", "offset"])
    assert ((at.groupby("sequence_id").length.cumsum() - at.length) == at.offset).all() and at.groupby("sequence_id").length.sum().max() <= 512
    assert got.sequence_id.nunique() == best_fit(got.length.tolist(), 512)


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_plan_equals_one_by_one(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, 400).tolist()
    steps = packing.plan(dict(Counter(lengths)), 64)
    bins = Counter()
    for n, _, pieces, first, each, _ in steps:
        for k in range(pieces):
            bins[first + k // each] += n
    assert max(bins.values()) <= 64 and len(bins) == best_fit(lengths, 64) and sum(bins.values()) == sum(lengths)


def test_language(spark):
    made = {"aa": "bako limu tesa", "bb": "grosch wylt hrapf"}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(made[k].split(), 8)), k) for i, k in enumerate(["aa", "bb"] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    asked = spark.createDataFrame([(0, "limu tesa"), (1, "wylt hrapf grosch"), (2, None), (3, ""), (4, "12 !?"), (5, "bako " * 50000)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(asked, model, "doc_id").collect()}
    assert [got[i][0] for i in range(6)] == ["aa", "bb", "und", "und", "und", "aa"] and all(0 <= s <= 1 for _, s in got.values())
    assert {r["doc_id"] for r in language.filtered(asked, model).collect()} >= {0, 1, 5}


def test_language_segments_lose_no_subword(monkeypatch):
    text = " ".join(f"Wört{i}ab  xyz!cd" for i in range(500))
    whole = language.subword_counts(text)
    for size in (7, 64, len(text), len(text) + 1):
        monkeypatch.setattr(language, "SEGMENT", size)
        assert (language.subword_counts(text) == whole).all()


def test_nbest_brute_force():
    m = nbest.PieceModel(queries.PIECES, 6)

    def brute(w):
        out = []

        def go(i, score):
            if i == len(w):
                out.append(score)
                return
            for j in range(i + 1, min(len(w), i + m.longest) + 1):
                if w[i:j] in m.pieces:
                    go(j, score + m.pieces[w[i:j]][1])
            if w[i] not in m.pieces:
                go(i + 1, score + m.unknown)

        go(0, 0.0)
        return sorted(out, reverse=True)[:6]

    for text in ["ab cde fg", "hello world", "é \U0001f600x", "a  b", "", " ", "aaaa bbb"]:
        ways = m.nbest(text)
        assert [s for s, _, _ in ways] == brute(m.sp.normalize(text))
        assert all(m.decode(np.frombuffer(ids, "<u4").tolist()) == text == spelled.decode().removeprefix(" ") for _, ids, spelled in ways)
        assert len({ids for _, ids, _ in ways}) == len(ways)


def test_nbest_words_side_by_side_and_alone():
    m = nbest.PieceModel(queries.PIECES, 3)
    words = ["\u2581hello", "\u2581world", "\u2581\U0001f600\U0001f600x", "x", "\u2581aaaaaaaa", "\u2581étréö"]
    assert m.viterbi(words) == [m._alone(w) for w in words]


def test_nbest_of_a_long_word():
    m = nbest.PieceModel(queries.PIECES, 3)
    text = "".join("abcdefghij"[i * i % 10] for i in range(200_000))
    ways = m.nbest(text)
    assert len(ways) == 3 and all(spelled.decode().removeprefix(" ") == text for _, _, spelled in ways)


def test_nbest_rows(spark):
    got = nbest.segmentations(docs(spark, ODD), queries.PIECES, 3).toPandas()
    first = got[got["rank"] == 0].set_index("doc_id").decoded_sha256
    assert [first[i] for i in range(len(ODD))] == [hashlib.sha256((t or "").encode()).hexdigest() for t in ODD]
    assert (got.groupby("doc_id").score.diff().dropna() <= 0).all()


def plain_kernel(s, t):
    def phi(w):
        w, out = w if sum(map(str.isalpha, w)) >= 3 else f"\2{w}\3", Counter()
        for a, b, c in itertools.combinations(range(len(w)), 3):
            if all(w[i].isalpha() or w[i] in "\2\3" for i in (a, b, c)):
                out[w[a] + w[b] + w[c]] += toxicity.DECAY ** (c - a + 1)
        return out

    x, y = phi(s), phi(t)
    norm = sum(v * v for v in x.values()) * sum(v * v for v in y.values())
    return sum(v * y[k] for k, v in x.items()) / norm**0.5 if norm else 0.0


def test_kernel_brute_force():
    words = ["idiot", "idxiot", "i-d-i-o-t", "banana", "ab", "stupid", "aaaa", "笨蛋", "笨蛋呀", "", "1234"]
    assert np.allclose(toxicity.kernel(words, words), [[plain_kernel(a, b) for b in words] for a in words], atol=1e-9)
    assert toxicity.kernel(["笨蛋"], ["笨蛋"])[0, 0] > 0.99 and "idiot" in toxicity.words_of("you i d i o t now")


def insulting(rng, n, words):
    """Documents of three sentences of common words, each word list that is given once in a toxic one."""
    common = ["bridge", "river", "window", "lantern", "cotton", "meadow", "harvest", "pencil", "silver", "garden", "market", "thunder"]
    rows = []
    for i in range(n):
        sentences = [list(rng.choice(common, 7)) for _ in range(3)]
        if i % 3 == 0:
            sentences[rng.integers(3)][rng.integers(7)] = str(rng.choice(words))
        rows.append((i, ". ".join(" ".join(x) for x in sentences), int(i % 3 == 0)))
    return rows


def test_toxicity_finds_altered_insults_that_a_word_list_misses(spark):
    insults = ["blorgen", "snarvik", "quambel"]
    rows = insulting(np.random.default_rng(8), 240, insults)
    df = spark.createDataFrame([(i, t, 7, 0.5) for i, t, _ in rows], "doc_id long, text string, toxic int, place double").repartition(3)
    labels = spark.createDataFrame([(i, k) for i, _, k in rows] + [(1, None), (None, 1), (rows[0][0], 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    altered = ["b-l-o-r-g-e-n", "snarxvik", "q u a m b e l", "blorrgen", "sn.arvik", "quambell"]
    new = insulting(np.random.default_rng(9), 60, altered)
    assert not any(w in t.split() for _, t, _ in new for w in insults)
    asked = spark.createDataFrame([(i, t) for i, t, _ in new], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scored(asked, model).collect()}
    truth = {i: k for i, _, k in new}
    assert sum(got[i] for i, k in truth.items() if k) >= 0.9 * sum(truth.values())
    assert sum(got[i] for i, k in truth.items() if not k) <= 0.05 * sum(1 - k for k in truth.values())
    odd = spark.createDataFrame([(0, None), (0, None), (None, ""), (2, "ab"), (3, "bridge blorgen"), (4, "bridge " * 40000), (5, "x" * 90), (6, "m" * 30 + "blorgen" + "m" * 30)], "doc_id long, text string")
    rows = toxicity.scored(odd, model).collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    at = {r["doc_id"]: r["score"] for r in rows}
    assert at[3] > 0.5 > at[4]


def test_toxicity_without_labels(spark):
    df, none = docs(spark, ["a b c", None]), spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(df, none)
    assert {r["predicted"] for r in toxicity.scored(df, model).collect()} == {0}
    assert toxicity.scored(df, toxicity.fit(df.limit(0), none)).count() == 2


def test_url_rules_and_walks(spark):
    link = lambda *h: "".join(f'<a href="http://{x}/">x</a>' for x in h)
    pages = [
        (1, "http://A.Example.com/en/71?q", None), (2, "https://x.com/en/1", ""), (3, "ftp://b.example.net/de/8#a", link("c.example.net")), (4, "http://good.net/de/1", link("near.org", "near.org")),
        (5, None, None), (6, "nohost", "x"), (7, "http://near.org/a", link("good.net")), (8, "http://farm.org/x", link("x.com")), (9, "http://evilcom/en/", ""), (9, "http://evilcom/en/", ""),
    ]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in urls.judged(df, queries.URL_RULES).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in (1, 2, 3, 4)] == [("example.com/en/7", "allow"), ("com/en/", "block"), ("example.net/de/8", "block"), ("net/de/", "allow")]
    assert (got[5]["host"], got[5]["path"], got[6]["host"], got[6]["verdict"]) == ("", "", "", "allow")
    assert got[7]["verdict"] == "allow" and got[8]["verdict"] == "block" and got[9]["rule"] is None
    assert got[1]["host"] == "a.example.com" and got[1]["path"] == "/en/71"


def test_embeddings_without_links(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [1.0, 1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert sorted(embeddings.linked(df).collect()) == [(i, 0, i, True) for i in (1, 2, 3)]


def test_embeddings_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    near = np.concatenate([base, base[:10].repeat(6, axis=0) + rng.normal(0, 0.03, (60, 16))]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(near)]
    rows += [(1000, near[0].tolist(), 0), (1001, near[0].tolist(), None), (1002, None, 0), (1003, [0.0] * 16, 0), (1004, [float("nan")] + [1.0] * 15, 0), (1005, [None] + [1.0] * 15, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embeddings.linked(df).collect()}
    usable = [r for r in rows if r[0] not in (1001, 1002, 1003, 1004, 1005)]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in usable}
    link = {a: [b for b, _, m in usable if a != b and k == m and unit[a] @ unit[b] >= 0.98] for a, _, k in usable}
    found, true = sum(got[a]["n_links"] for a in link), sum(map(len, link.values()))
    assert all(got[a]["n_links"] <= len(x) for a, x in link.items()) and found >= 0.9 * true
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(1001, 1006))
    assert embeddings.audit(df.where("vec_id < 1001"), embeddings.linked(df)) >= 0.9


def test_katz_is_normalised_and_bases_match(spark):
    texts = ["the cat sat", "the cat ran", "a dog sat", "the dog ran away", None, "", "The unseen cat", "the cat sat"]
    df = docs(spark, texts)
    got = {r["doc_id"]: r for r in katz.scored(df, F.col("doc_id") == 6).collect()}
    words = [(t or "").lower().encode().split() + [b" end"] for t in texts]
    c = Counter(w for i, x in enumerate(words) if i != 6 for w in x)
    n, v = sum(c.values()), len(c)
    for i, x in enumerate(words):
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(x), sum(c[w] > 0 for w in x), n)
        assert abs(got[i]["base_score"] - sum(np.log10((c[w] + 1) / (n + v + 1)) for w in x)) < 1e-9
    tables, total = katz.train(df.where("doc_id <> 6").select("text"), 2)
    uni = {r["w"]: r["p"] for r in tables[0].collect()}
    assert abs(sum(uni.values()) + total["unknown"] - 1) < 1e-9
    two = [r for r in tables[1].collect()]
    for context in {r["context"] for r in two}:
        seen = {r["w"]: r["p"] for r in two if r["context"] == context and r["w"] is not None}
        weight = next(r["p"] for r in two if r["context"] == context and r["w"] is None)
        rest = total["unknown"] + sum(p for w, p in uni.items() if w not in seen)
        assert abs(sum(seen.values()) + weight * rest - 1) < 1e-9


def test_empty_tables(spark):
    empty = docs(spark, ["x"]).limit(0)
    model = language.fit(empty)
    jobs = [
        exact_dedup.exact_duplicates(empty), simhash.near_duplicates(empty), substring.repeated_passages(empty), packing.packed(empty, queries.BYTE_BPE), nbest.segmentations(empty, queries.PIECES),
        language.predict(empty, model, "doc_id"), toxicity.scored(empty, toxicity.train([], [], [])), katz.scored(empty, F.lit(False)),
        urls.judged(spark.createDataFrame([], "page_id long, url string, html string"), queries.URL_RULES), embeddings.linked(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")),
    ]
    assert [j.count() for j in jobs] == [0] * len(jobs)


def test_pipeline_stages(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    p = passage(9, 120)
    texts = ["hello there general text about rivers " * 4, "hello there  general text about rivers " * 4, p + " alpha", "beta " + p + " gamma " + passage(10, 40), None, "123", passage(11, 90)]
    df = docs(spark, texts)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    kept, ids = df, []
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == df.columns
        ids.append(sorted(r[0] for r in kept.select("doc_id").collect()))
    assert ids == [[0, 1, 2, 3, 6], [0, 2, 3, 6], [0, 2, 3, 6], [0, 2, 3, 6]]
    last = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert last[2] == texts[2] and last[3] == "beta gamma " + passage(10, 40)
    assert pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 4


def test_pipeline_tells_rows_apart_by_id_and_text(spark):
    """Repeated ids of different texts, null ids and repeated rows: each row follows what its operator says of it."""
    pipeline = pytest.importorskip("corpus_pipeline")
    p, q = passage(21, 120), passage(22, 130)
    rows = [(3, p), (5, p), (5, "unrelated words of another text " * 3), (None, p), (None, "only a null id has this text"), (None, "only a null id has this  text"), (7, "twice"), (7, "twice")]
    given = docs(spark, [t for _, t in rows], [i for i, _ in rows])
    kept = sorted(((r["doc_id"], r["text"]) for r in pipeline.drop_exact_copies(spark, given, "").collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[4], rows[5], rows[6], rows[7]], key=str)
    near = sorted(((r["doc_id"], r["text"]) for r in pipeline.drop_near_copies(spark, given, "").collect()), key=str)
    assert near == kept
    rows = [(1, q), (4, "x y " + q), (4, "unrelated row with the same id"), (None, "x y " + q), (4, "x y " + q), (6, None)]
    cut = pipeline.drop_repeated_passages(spark, docs(spark, [t for _, t in rows], [i for i, _ in rows]), "")
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in cut.collect()), key=str)
    assert got == sorted([(1, q, 0), (4, "x y", 3), (4, "x y", 3), (4, rows[2][1], 0), (None, "x y " + q, 0), (6, None, 0)], key=str)
    empty = given.limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, empty, "").count() == 0 and stage(spark, empty, "").columns == given.columns


def test_components_of_a_hub(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 10_000) for i in range(1, 50)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert len(got) == 3049 and set(got.values()) == {0}


def test_substring_segments_of_long_documents(spark, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 300)
    p = passage(31, 5000)
    texts = [p, "a " + p + " b " + p[2000:9000], "c " + p[:30_000] + " d", "e e " + p]
    got = {r["doc_id"]: r for r in substring.repeated_passages(docs(spark, texts)).collect()}
    for i, want in enumerate(plain_removal(texts)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == want


def test_pipeline_drops_near_copies_beyond_two_bits(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(6)
    texts = []
    for k in range(12):
        base = [f"u{k}v{i}" for i in range(300)]
        texts.append(" ".join(base))
        for n in (2, 4, 30):  # words replaced
            other = list(base)
            for i in rng.choice(300, n, replace=False):
                other[i] = f"z{k}n{n}i{i}"
            texts.append(" ".join(other))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    prints = [plain_fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    wide = 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        alike = len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
        wide += alike and (prints[a] ^ prints[b]).bit_count() > 2
        if alike or (prints[a] ^ prints[b]).bit_count() <= 2:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    assert wide > 10
    kept = pipeline.drop_near_copies(spark, docs(spark, texts), "")
    got = sorted(r[0] for r in kept.select("doc_id").collect())
    assert got == [i for i, r in enumerate(root) if i == r] and 12 < len(got) < 36


def test_op3_asks_three_words(spark, tmp_path):
    df = docs(spark, ["a b c", "a b c", "a b d", "x b d", "x b c", "x b d", "b c", "a b c d"] * 4)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    want, short = ({r["doc_id"]: r["score"] for r in katz.scored(df, held_out, order).collect()} for order in (3, 2))
    got = {r["doc_id"]: r["score"] for r in queries.op3_katz_scoring(spark, str(tmp_path)).collect()}
    assert got == pytest.approx(want) and got != pytest.approx(short)


def test_op2_walks_equal_a_dense_solution(spark):
    rng = np.random.default_rng(5)
    n = 60
    links = {(i, i + 1): 1 for i in range(39)} | {(int(a), int(b)): int(w) for a, b, w in zip(rng.integers(40, n - 2, 60), rng.integers(40, n, 60), rng.integers(1, 9, 60), strict=True) if a != b}
    links[39, 0] = 2  # a circle of 40 hosts; the rest is random, with hosts that link to none
    seeds = {0: (3, 0), 41: (1, 0), 20: (0, 2), 55: (0, 1), 59: (1, 1)}
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", w) for (a, b), w in links.items()], "src string, dst string, links long")
    given = spark.createDataFrame([(f"h{k}", a, b) for k, (a, b) in seeds.items()], "host string, allowed long, blocked long")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urls.propagated(edges, given, tolerance=1e-9).collect()}
    for kind in (0, 1):
        m = np.zeros((n, n))
        for (a, b), w in links.items():
            m[(a, b) if kind == 0 else (b, a)] += w
        out = m.sum(1, keepdims=True)
        p = np.divide(m, out, out=np.zeros_like(m), where=out > 0)
        s = np.zeros(n)
        for k, c in seeds.items():
            s[k] = c[kind]
        x = np.linalg.solve(np.eye(n) - 0.85 * p.T, 0.15 * s / s.sum())
        x /= x.sum()
        assert np.allclose([got.get(f"h{k}", (0.0, 0.0))[kind] for k in range(n)], x, rtol=0, atol=1e-8)


def test_op2_without_links_or_seeds(spark):
    none = spark.createDataFrame([], "src string, dst string, links long")
    seeds = spark.createDataFrame([("a", 1, 0), ("b", 0, 4), ("c", 3, 0)], "host string, allowed long, blocked long")
    assert {r["host"]: (r["trust"], r["distrust"]) for r in urls.propagated(none, seeds).collect()} == {"a": (0.25, 0.0), "b": (0.0, 1.0), "c": (0.75, 0.0)}
    assert urls.propagated(none, seeds.limit(0)).count() == 0
