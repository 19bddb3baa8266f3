"""Brute-force versions, round trips and held-out scores of the training-data operators; odd inputs of each."""

import base64
import collections
import hashlib
import math
import random
import struct
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strandloom import session
from strandloom.llm import byte_bpe, entries, line_dedup, lm_scoring, minhash_dedup, mixing, moving, quality_rules, substring_dedup, token_counts, topk_search, warc
from strandloom.llm.common import Words
from strandloom.llm.components import components
from tests.conftest import rows

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, more=""):
    """Documents with ids 1, 2 ...; text, or (text, source)."""
    made = [(i, t if isinstance(t, str | None) else t[0], "en", "s" if isinstance(t, str | None) else t[1], len(t or "") if isinstance(t, str | None) else len(t[0])) for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(made, DOCS)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


ODD = [None, "", " \t\n", "one", "a b c d", "x" * 30_000, " ".join(["again"] * 3000), "é ü 中文 😀 \x85　 \x1c", "same text here now ok", "same text here now ok"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null id, repeated rows, and columns whose names the operators use inside."""
    df = docs(spark, ODD)
    df = df.union(df.where("doc_id = 9")).union(spark.createDataFrame([(None, "a text without an id but with words", "en", None, 3)], DOCS))
    return df.withColumns({c: F.lit("clash") for c in ("row", "node", "rep", "_copy", "_keys", "_v", "block", "held_out", "_kept", "component_id")})


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# oracles ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_equals_oracle(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    got = entries.queries()[name](spark, DIR)
    want = c.execute(entries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(str(tuple(r)) for r in want.fetchall())


# 1 -------------------------------------------------------------------------------------------------------------------


def brute_components(items, percent):
    sets = {}
    for i, t in items:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def changed(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_equal_brute_force(spark, small):
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 8, 40, 150])) for _ in range(30)]
    near = [changed(rng, t, rng.choice([0, 1, 2, 4])) for t in base for _ in range(4)]
    hub = prose(rng, 300)
    chain = [hub := changed(rng, hub, 3) for _ in range(15)]
    df = docs(spark, base + near + chain + [t.upper() for t in base[:3]])
    for percent in (80, 85):
        assert rows(minhash_dedup.near_duplicates(df, percent)) == brute_components(texts_of(df), percent)
    assert rows(minhash_dedup.near_duplicates(small, 85)) == brute_components(texts_of(small), 85)


def test_blocks_lose_no_link(spark, monkeypatch):
    rng = random.Random(6)
    t = prose(rng, 200)
    df = docs(spark, [changed(rng, t, rng.choice([2, 4, 6])) for _ in range(70)])
    want = brute_components(texts_of(df), 85)
    for name in ("BUCKET_BLOCK", "CLUSTER_BLOCK"):
        monkeypatch.setattr(minhash_dedup, name, 16)
    assert rows(minhash_dedup.near_duplicates(df, 85)) == want


def test_near_duplicates_of_odd_rows(spark, odd):
    got = minhash_dedup.near_duplicates(odd, 85).collect()
    assert len(got) == 12
    by = {r.doc_id: r for r in got}
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 5, 6)] == [0, 0, 0, 1, 1, 1] and by[7].n_shingles == 1
    assert by[10].component_id == 9 and not by[10].kept and by[None].kept and by[None].component_id is None
    assert all(by[i].component_id == i for i in range(1, 10))
    assert minhash_dedup.near_duplicates(odd.limit(0), 85).count() == 0
    assert minhash_dedup.deduplicated(odd, 85).columns == odd.columns


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 400)] + [(1, i) for i in range(500, 700)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 401)} == {100} and {got[i] for i in range(500, 700)} == {1} and 7 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_tell_words_apart():
    w = Words([b"b ab\x0bc  ", b"", b"ab c\x1cd"], lower=False)
    words = [w.data[s:e] for s, e in zip(w.start, w.end, strict=True)]
    assert words == [b"b", b"ab", b"c", b"ab", b"c\x1cd"] and list(w.first) == [0, 3, 3, 5]
    assert w.hash[1] == w.hash[3] and len(set(w.hash.tolist())) == 4
    rng = random.Random(1)
    made = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30))) for _ in range(5000)} | {b"x" * n for n in range(1, 600)} | {b"y" + bytes([7]) * n for n in range(40)})
    assert len(set(Words(made, lower=False).hash.tolist())) == len(made)


def thue_morse(n):
    """Two strings of 2 ** n letters that every polynomial hash modulo 2 ** 64 takes for one another."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_words_that_defeat_polynomial_hashes(spark):
    for n in (5, 7, 10, 12):
        a, b = thue_morse(n)
        w = Words([a.encode(), b.encode()], lower=True)
        assert w.hash[0] != w.hash[1]
    a, b = thue_morse(10)
    rest = prose(random.Random(1), 60)
    df = docs(spark, [f"{a} one two three four", f"{b} one two three four", f"{a} {rest}", f"{b} {rest}"])
    assert rows(minhash_dedup.near_duplicates(df, 85)) == brute_components(texts_of(df), 85)
    got = rows(substring_dedup.without_repeats(df))
    assert got == brute_removed(texts_of(df)) and got[3][2] == 60
    x, y = (" ".join(t) for t in thue_morse(11))  # words, not letters, in that order
    df = docs(spark, [x, y, f"{x} more"])
    assert rows(substring_dedup.without_repeats(df)) == brute_removed(texts_of(df))
    assert rows(minhash_dedup.near_duplicates(df, 85)) == brute_components(texts_of(df), 85)


def test_grams_tell_windows_apart():
    rng = random.Random(2)
    items = [[rng.choice("abc") for _ in range(rng.randrange(60))] for _ in range(40)]
    w = Words([" ".join(x).encode() for x in items], lower=False)
    for k in (1, 2, 5, 6, 16, 50):
        hashes, at = w.grams(k)
        windows = [tuple(x[i : i + k]) for x in items for i in range(len(x) - k + 1)]
        assert len(at) == len(windows) and len(set(hashes.tolist())) == len(set(windows)) == len(set(zip(hashes.tolist(), windows)))


# 2 -------------------------------------------------------------------------------------------------------------------


def test_mixing_reaches_weights_and_is_repeatable(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x" * 50).alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    out = mixing.replicated(df, weights={"a": 1, "b": 1})
    n = {r.source: r["count"] for r in out.groupBy("_in.source").count().collect()}
    assert n["a"] == pytest.approx(2000, rel=0.1) and n["b"] == pytest.approx(2000, rel=0.1)
    assert rows(out) == rows(mixing.replicated(df, weights={"a": 1, "b": 1}))
    share = out.where("_in.source = 'a'").groupBy("_in.doc_id").count().groupBy("count").agg(F.count("*").alias("n")).collect()
    poisson = {k: 1000 * math.exp(-2) * 2**k / math.factorial(k) for k in range(1, 5)}
    assert {r["count"]: r.n for r in share if r["count"] < 5} == pytest.approx(poisson, rel=0.25)


def copies_of(name, rate):
    """Poisson inversion in plain Python, for rates up to one part."""
    u = int(hashlib.md5(f"20:count:{name}".encode()).hexdigest()[:13], 16) / (1 << 52)
    n, p = 0, math.exp(-rate)
    total = p
    while u >= total:
        n += 1
        p *= rate / n
        total += p
    return n


def brute_mixed(rows_):
    """(doc_id, text, source) -> how often each row occurs in the mixture."""
    size = collections.Counter()
    for _, t, s in rows_:
        size[s] += len((t or "").encode())
    weight = {s: x**0.5 for s, x in size.items()}
    rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) / size[s] if size[s] else 1.0 for s in size}
    return [(i, t, s, copies_of(i if i is not None else "null:" + hashlib.md5((t or "").encode()).hexdigest(), rate[s])) for i, t, s in rows_]


def test_mixing_of_odd_rows(spark, odd):
    """Null sources, ids and texts, repeated rows: as many copies as by brute force, each row with docs' columns."""
    more = spark.createDataFrame([(None, f"no id but text {i}", "en", "s", 3) for i in range(20)], DOCS)
    df = odd.unionByName(more.withColumns({c: F.lit("clash") for c in odd.columns[5:]}))
    out = mixing.mixed(df)
    assert out.columns == odd.columns
    got = collections.Counter((r.doc_id, r.text, r.source) for r in out.collect())
    want = collections.Counter()
    for i, t, s, n in brute_mixed([(r.doc_id, r.text, r.source) for r in df.collect()]):
        want[i, t, s] += n
    assert got == +want and len({n for (i, _, _), n in got.items() if i is None}) > 1
    assert mixing.mixed(odd.limit(0)).count() == 0
    with pytest.raises(Exception, match="too high"):
        mixing.replicated(docs(spark, ["a" * 10]), epochs=1000.0).count()


def test_mixing_of_a_tiny_source_beside_a_huge_one(spark):
    """Rates beyond one part: a document of 100 bytes beside 50 MB (rate about 706), and 300 documents at a mean of 1300."""
    hot = spark.range(1, 51).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1_000_000).alias("text"), F.lit("hot").alias("source"))
    tiny = spark.createDataFrame([(0, "y" * 100, None)], "doc_id long, text string, source string")
    out = mixing.replicated(hot.union(tiny)).where("_in.source is null").select("_copies", "_copy").collect()
    rate = 50_000_100 / ((50_000_000**0.5 + 10) * 10)
    assert rate > mixing.MAX_RATE and abs(len(out) - rate) < 6 * rate**0.5
    assert sorted(r._copy for r in out) == list(range(1, len(out) + 1)) and {r._copies for r in out} == {len(out)}
    many = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("z" * 10).alias("text"), F.lit("a").alias("source"))
    one = spark.range(300, 301).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 7_797_000).alias("text"), F.lit("b").alias("source"))
    counts = lambda: sorted((r["doc_id"], r["count"]) for r in mixing.replicated(many.union(one), weights={"a": 1, "b": 1}).where("_in.source = 'a'").groupBy("_in.doc_id").count().collect())
    got = counts()
    n = np.array([c for _, c in got])
    assert len(n) == 300 and abs(n.mean() - 1300) < 6 * (1300 / 300) ** 0.5 and 0.6 < n.var() / 1300 < 1.6
    assert got == counts()


# 3 -------------------------------------------------------------------------------------------------------------------


def test_scores(spark, small):
    got = {r.doc_id: r for r in lm_scoring.scored(small).collect()}
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in texts_of(small)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(x for i, w in tokens.items() if not held[i] for x in w)
    n, v = sum(c.values()), len(c)
    for i, w in tokens.items():
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(w), sum(c[x] > 0 for x in w), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    out = [i for i in tokens if held[i]]
    assert sum(got[i].score for i in out) > sum(got[i].base_score for i in out)
    for i, t in texts_of(small):
        assert got[i].bits_per_byte == pytest.approx(-got[i].score * math.log2(10) / max(1, len((t or "").encode())))
    assert 0 < np.mean([got[i].bits_per_byte for i in out]) < 4


def test_edge_probabilities_sum_to_one():
    tables = [np.random.default_rng(1).integers(0, 9, (1 << s, 2)).astype(np.uint16) for s in lm_scoring.SIZES]
    mixer = lm_scoring.Mixer(tables, seen=np.zeros((256, lm_scoring.STEPS, 2)))
    words = sorted(b"ab" + bytes([x]) for x in range(256) if x not in (10, 32))
    trie = lm_scoring.Trie(words)
    p = 10 ** mixer.log10(trie, trie.weights(np.zeros(len(words), np.int64)))
    last = p[(trie.depth == 2)]
    assert last.sum() < 1 and last.sum() == pytest.approx(1, abs=0.05)  # a space and an end could follow too


def test_trie_weights_and_sums():
    words = sorted([b"the", b"then", b"a", b"an", b"\n", b"z" * 200, b"z" * 200 + b"y"])
    count = np.arange(1, len(words) + 1)
    trie = lm_scoring.Trie(words)
    weight = trie.weights(count)
    closed = [w if w == b"\n" else w + b" " for w in words]
    assert trie.sums(np.ones(len(trie.byte))).tolist() == [len(c) for c in closed]
    for e in range(len(trie.byte)):
        i, d = trie.word[e], trie.depth[e]
        if d < lm_scoring.SHARED:
            assert weight[e] == sum(c for c, x in zip(count, closed, strict=True) if x[: d + 1] == closed[i][: d + 1])


def test_counts_of_siblings_equal_brute_force():
    rng = random.Random(9)
    words = sorted({bytes(rng.choices(b"abz\xc3\xa9", k=rng.randrange(1, 7))) for _ in range(200)} | {b"\n"})
    trie, count = lm_scoring.Trie(words), np.array([rng.randrange(1, 9) for _ in range(1000)])[: len(words)]
    closed, weight = [w if w == b"\n" else w + b" " for w in words], trie.weights(count)
    siblings = trie.siblings(weight)
    for j in range(8):
        zero, one = siblings(j)
        for e in range(0, len(trie.byte), 7):
            history, byte, want = closed[trie.word[e]][: trie.depth[e]], trie.byte[e], [0, 0]
            for w, c in zip(closed, count, strict=True):
                if w.startswith(history) and len(w) > len(history) and w[len(history)] >> (8 - j) == byte >> (8 - j):
                    want[w[len(history)] >> (7 - j) & 1] += c
            assert [zero[e], one[e]] == want


def test_blocks_pack_their_words(spark, monkeypatch):
    """Rows of a block grow with slices, not with words; what is unpacked are all words and their counts by kind."""
    rng = random.Random(10)
    made = [(i, " ".join(rng.choices([f"w{k}" for k in range(300)], k=40)) + " top" * (i % 3) * 9, i % 4 == 0) for i in range(60)]
    blocks = lm_scoring.blocks(spark.createDataFrame(made, "doc_id long, text string, held_out boolean").coalesce(1)).cache()
    count = {r["kind"]: r["count"] for r in blocks.groupBy("kind").count().collect()}
    distinct = {w for _, t, _ in made for w in t.encode().split()} | {b"\n"}
    assert count[1] == count[2] == 1 < len(distinct) < lm_scoring.SLICE
    words = blocks.where("kind = 1")
    placed = lm_scoring.places(words).collect()
    assert sorted(r.id for r in placed) == list(range(len(distinct)))
    assert {r.h for r in placed} == set(lm_scoring.hashes(sorted(distinct)).tolist())
    named = [int(lm_scoring.hashes([b"top"])[0]), 5]
    want = collections.defaultdict(lambda: [0, 0])
    for _, t, out in made:
        own = t.encode().split()
        often = collections.Counter(own)
        kind = min(w for w in often if often[w] == max(often.values()))
        for w in [*own, b"\n"]:
            want[w][0] += not out
            want[w][1] += not out and kind == b"top"
    got = {bytes(r.token): [r.c, r.k0] for r in lm_scoring.counts_by_kind(words, named).collect()}
    assert got == dict(want) and any(k for _, k in got.values())
    monkeypatch.setattr(lm_scoring, "SLICE", 50)
    block = lm_scoring._Block(0)
    for _, t, out in made:
        block.add(t, out)
    parts = [lm_scoring._hashed(x["data"][0]) for x in block.words() if x["kind"] == [1]]
    assert [n for _, n, *_ in parts] == [50] * 6 + [1]
    assert np.concatenate([h for _, _, h, *_ in parts]).tolist() == lm_scoring.hashes(block.numbers.tokens).tolist()


def test_hashed_contexts_are_the_last_bytes_of_the_word():
    words = sorted([b"abcde", b"xbcde", b"cde", b"abcdef"])
    trie = lm_scoring.Trie(words)
    context = {(words[trie.word[e]], int(trie.depth[e])): trie.contexts()[:, e].tolist() for e in range(len(trie.byte))}
    a, b, c = (context[w, len(w)] for w in (b"abcde", b"xbcde", b"cde"))
    assert a == b and a[:3] == c[:3] and a[3] != c[3] and len(set(a)) == 4


def brute_reading(words, out, kind, know, shares, sums):
    """log10 of the spelt words, and the counts of true and false bits by cell, word by word."""
    spelt, cells, history, run, before = 0.0, collections.Counter(), [], 0, collections.Counter()
    bucket = lambda x, bounds: sum(x >= b for b in bounds)
    for t, w in enumerate(words):
        prev = know[words[t - 1] if t else b"\n"]
        hit = prev["ctot"] > 0 and prev["follower"] == w
        top, all_ = prev["ctop"] - (hit and not out), prev["ctot"] - (not out)
        valid = top > 0
        hit = hit and valid
        last = history[-lm_scoring.HISTORY :]
        true, n = sum(h for h, _ in last), sum(v for _, v in last)
        recent = 1 + min(lm_scoring.RECENT - 2, (lm_scoring.RECENT - 1) * true // n) if n else 0
        if valid:
            cells[bucket(top, lm_scoring.LIKELY), bucket(all_ - top, lm_scoring.OTHERS), bucket(run, lm_scoring.RUNS), recent, hit] += 1
        if not hit:
            me = know[w]
            c, of = me["c"] - (not out), me["kinds"][kind] - (not out)
            p = 10 ** me["score"] * (max(of, 0) + shares[kind]) / (max(c, 0) + 1) / shares[kind] / sums[kind]
            spelt += math.log10((lm_scoring.ALPHA * p + before[w]) / (lm_scoring.ALPHA + t))
        run = run + 1 if hit else 0
        history.append((hit, valid))
        before[w] += 1
    return spelt, cells


def test_texts_are_read_word_by_word_as_by_brute_force():
    rng, n = random.Random(12), 30
    tokens = [b"\n"] + [b"w%d" % i for i in range(n - 1)]
    know, shares, sums = {}, np.array([0.1] * 7 + [0.3]), np.linspace(0.8, 1.1, 8)
    for t in tokens:
        kinds = [rng.randrange(4) for _ in range(8)]
        top = rng.randrange(8)
        know[t] = {"c": sum(kinds), "kinds": kinds, "score": -rng.random() * 5, "follower": rng.choice(tokens), "ctop": top, "ctot": top + (rng.randrange(300) if top else 0)}
    texts = [[rng.choice(tokens[1:]) for _ in range(rng.randrange(120))] + [b"\n"] for _ in range(12)]
    for x in texts[::2]:  # runs of likely followers
        for i in range(1, len(x) - 1):
            if rng.random() < 0.8:
                x[i] = know[x[i - 1]]["follower"]
    out, kind = np.array([i % 3 == 0 for i in range(12)]), np.array([i % 8 for i in range(12)])
    at = {t: i for i, t in enumerate(tokens)}
    arrays = {c: np.array([know[t][c] for t in tokens]) for c in ("c", "score", "ctop", "ctot")}
    arrays |= {"own": np.arange(n), "follower": np.array([at[know[t]["follower"]] for t in tokens]), "kinds": np.array([know[t]["kinds"] for t in tokens]).T}
    spelt, text, cell, true, false = lm_scoring.read_texts(np.array([at[w] for x in texts for w in x]), np.array([len(x) for x in texts]), out, kind, arrays, shares, sums)
    for i, x in enumerate(texts):
        want, cells = brute_reading(x, out[i], kind[i], know, shares, sums)
        assert spelt[i] == pytest.approx(want)
        got = {}
        for j in np.flatnonzero(text == i):
            where = tuple(int(y) for y in np.unravel_index(cell[j], lm_scoring.SHAPE))
            got |= {(*where, h): k for h, k in ((True, int(true[j])), (False, int(false[j]))) if k}
        assert got == dict(cells)


def test_chances_along_a_document_are_those_of_one_bit_after_another():
    rng = np.random.default_rng(4)
    chances = lm_scoring.Chances(rng.integers(0, 50, lm_scoring.CELLS).astype(float), rng.integers(0, 50, lm_scoring.CELLS).astype(float))
    p, want, seen = chances.p[77], 0.0, [0, 0]
    for bit in (1, 0, 0, 1, 1, 0, 1):
        a, b = lm_scoring.HELD * p + seen[1], lm_scoring.HELD * (1 - p) + seen[0]
        want += math.log10((a if bit else b) / (a + b))
        seen[bit] += 1
    assert chances.log10(np.array([77]), np.array([4]), np.array([3]))[0] == pytest.approx(want)


def made_words(rng):
    """Sorted words, some beyond SHARED bytes, and their counts."""
    words = sorted({bytes(rng.choices(b"abz\xc3\xa9", k=rng.randrange(1, 12))) for _ in range(200)} | {b"\n", b"z" * 200, b"z" * 200 + b"y", b"z" * 64 + b"qr"})
    return words, np.array([rng.choice([0, 1, 5, 300, 10**9]) for _ in words])


def test_turns_bring_whole_counts_to_tries_of_some_words():
    rng = random.Random(13)
    words, count = made_words(rng)
    trie = lm_scoring.Trie(words)
    weight = trie.weights(count)
    of, turns = trie.turns(weight)
    again = lm_scoring.lengthened(*lm_scoring.shortened(of, turns))
    assert again[0].tolist() == of.tolist() and again[1].tolist() == turns.tolist()
    some = sorted({*rng.sample(range(len(words)), 60), words.index(b"z" * 200 + b"y")})
    part, begin = lm_scoring.Trie([words[i] for i in some]), np.cumsum(of) - of
    got = part.turned(count[some], of[some], np.concatenate([turns[begin[i] : begin[i] + of[i]] for i in some]))
    siblings = trie.siblings(weight)
    want, paths, own = [siblings(j) for j in range(8)], trie.paths(), part.paths()
    for k, i in enumerate(some):
        for d in range(lm_scoring.WHOLE, part.length[k]):
            e, f = own[part.start[k] + d], paths[trie.start[i] + d]
            assert [(got[0][e, j], got[1][e, j]) for j in range(8)] == [(want[j][0][f], want[j][1][f]) for j in range(8)]


def test_weights_and_refinement_move_after_every_bit(spark):
    rng, random_ = random.Random(14), np.random.default_rng(14)
    words, count = made_words(rng)
    tables = [random_.integers(0, 9, (1 << s, 2)).astype(np.uint16) for s in lm_scoring.SIZES]
    mixer = lm_scoring.Mixer(tables, random_.random((lm_scoring.GATES, lm_scoring.INPUTS)) / 3, random_.integers(0, 9, (256, lm_scoring.STEPS, 1)) * np.array([[[1, 2]]]))
    trie = lm_scoring.Trie(words)
    tokens, turns = pa.array(words, pa.binary()), lm_scoring._binary(*lm_scoring.shortened(*trie.turns(trie.weights(count))))
    spelling = mixer.spelling(tokens, count, turns)
    sizes = np.array([rng.randrange(1, 30) for _ in range(9)])
    ids = np.array([rng.randrange(len(words)) for _ in range(sizes.sum())])
    spelt, known, came = np.array([rng.random() < 0.7 for _ in ids]), -random_.random(len(ids)) * 9, np.array([rng.randrange(3) for _ in ids])
    row = spelling.columns(ids, sizes, spelt, known, came)
    df = spark.createDataFrame([tuple(map(bytearray, row.values()))], ", ".join(f"{c} binary" for c in row))
    got = df.select(moving.spelt(spark, mixer.weights, mixer.refine, 50.0)).first()[0]
    start, still = np.cumsum(sizes) - sizes, []
    for t, (s, n) in enumerate(zip(start, sizes, strict=True)):
        w, r, a, total = mixer.weights.copy(), mixer.refine.copy(), 0.5, 0.0
        for i in range(s, s + n):
            if not spelt[i]:
                continue
            m = 1.0
            for e in spelling.edge[spelling.first[ids[i]] : spelling.first[ids[i] + 1]]:
                partial = 1
                for j in range(8):
                    x, gate, bit = [*(spelling.x[e, j] / moving.PARTS), moving.CONSTANT], spelling.gate[e, j], int(spelling.byte[e]) >> (7 - j) & 1
                    mixed = sum(w[gate, k] * x[k] for k in range(len(x)))
                    p = 1 / (1 + math.exp(-min(max(mixed, -20), 20)))
                    cell = min(max(round(mixed * 2) + lm_scoring.STEPS // 2, 0), lm_scoring.STEPS - 1)
                    q = min(max((p + r[partial, cell]) / 2, 1e-6), 1 - 1e-6)
                    m *= q if bit else 1 - q
                    for k in range(len(x)):
                        w[gate, k] += moving.RATE_W * (bit - p) * x[k]
                    r[partial, cell] += moving.RATE_C * (bit - r[partial, cell])
                    partial = 2 * partial + bit
            both = a * m + (1 - a) * 10 ** known[i]
            a = moving.SHARE / 2 + (1 - moving.SHARE) * a * m / both if both else a
            total += math.log10((50 * both + came[i]) / (50 + i - s))
        if any(len(words[ids[i]]) > 100 for i in range(s, s + n) if spelt[i]):
            assert np.isfinite(got[t])  # chances too small for a number here
        else:
            assert got[t] == pytest.approx(total, rel=1e-9)
            still.append(t)
    assert len(still) > 3
    # as learnt, where nothing moves, but for inputs that are rounded
    table = trie.sums(mixer.log10(trie, trie.weights(count)))
    moved = moving.RATE_W, moving.RATE_C
    try:
        moving.RATE_W = moving.RATE_C = 0.0
        one = np.arange(len(words))
        row = spelling.columns(one, np.ones(len(one), np.int64), one >= 0, np.full(len(one), -1e4), one * 0)
        df = spark.createDataFrame([tuple(map(bytearray, row.values()))], ", ".join(f"{c} binary" for c in row))
        flat = df.select(moving.spelt(spark, mixer.weights, mixer.refine, 50.0)).first()[0]
    finally:
        moving.RATE_W, moving.RATE_C = moved
    assert sum(flat) == pytest.approx((table + np.log10(0.5)).sum(), rel=0.02)  # half of the share; a rounded input may meet another cell


def test_likeliest_followers_equal_brute_force(spark):
    rng = random.Random(5)
    made, count = [], collections.defaultdict(collections.Counter)
    for _ in range(60):
        h, f = rng.randrange(6), sorted({rng.randrange(-(1 << 31), 1 << 31) % 40 - 20 for _ in range(rng.randrange(30))})
        times = [rng.randrange(1, 4) for _ in f]
        made.append((h, f, times))
        for x, n in zip(f, times, strict=True):
            count[h][x & 0xFFFFFFFF] += n
    df = spark.createDataFrame(made, "h long, followers array<int>, times array<int>")
    want = sorted((h, min(x for x in c if c[x] == max(c.values())), max(c.values()), sum(c.values())) for h, c in count.items() if c)
    for frequent, buckets in (([], 1), ([0, 3], 5), ([2], 200)):
        assert rows(lm_scoring.likeliest(df, frequent, buckets)) == want


def test_scores_do_not_depend_on_rows_order_or_partitions(spark, small):
    df = small.where("doc_id % 3 = 0")
    want = None
    try:
        for partitions, order in (("4", F.col("doc_id")), ("16", F.desc("doc_id")), ("53", F.desc("text"))):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = {r.doc_id: r.score for r in lm_scoring.scored(df.repartitionByRange(int(partitions) // 3 + 1, order)).collect()}
            want = want or got
            assert got == pytest.approx(want, rel=1e-9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_order_of_words_and_copies_tell_in_the_score(spark):
    """A held-out copy of a training text scores better than its words in another order, and better than words of no copy."""
    rng = random.Random(6)
    held = [i for i in range(1, 900) if zlib.crc32(str(i).encode()) % 7 == 2]
    learnt = [i for i in range(1, 900) if i not in set(held)]
    base = [prose(rng, 120, 30_000) for _ in range(60)]
    made = [(i, base[k % 60] if k < 60 else prose(rng, 120, 30_000)) for k, i in enumerate(learnt[:400])]
    shuffled = [" ".join(rng.sample(t.split(), 120)) for t in base[:20]]
    made += list(zip(held, base[:20] + shuffled, strict=False))
    got = {r.doc_id: r.score for r in lm_scoring.scored(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    copies, others = [got[i] for i in held[:20]], [got[i] for i in held[20:40]]
    assert all(a > b for a, b in zip(copies, others, strict=True)) and sum(copies) > 0.9 * sum(others)


def test_scores_of_very_long_texts(spark):
    """A text beyond a block of texts, and a word beyond all bounds: counts are those of the whole text."""
    rng = random.Random(7)
    long = " ".join(rng.choices(["ab", "cd", "efg", "hi"], k=1_000_000))
    i, j, k = [i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 7 != 2][:3]
    df = spark.createDataFrame([(i, long), (j, "x" * 100_000 + " y"), (k, "x" * 100_000 + "z")], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_scoring.scored(df).collect()}
    assert got[i].n_tokens == 1_000_001 and got[j].n_tokens == 3 and all(np.isfinite(r.score) for r in got.values())
    assert got[i].n_known == got[i].n_tokens


def test_log_gamma():
    x = np.array([1e-9, 0.3, 1, 2, 17.5, 4000, 1e7])
    assert lm_scoring.log_gamma(x) == pytest.approx([math.lgamma(y) for y in x], rel=1e-9, abs=1e-9)


def test_work_tables_of_scores_are_freed(spark, odd):
    """Of all work tables only the one that the scores are read from is left."""
    folders = session._folders.setdefault(spark.sparkContext.applicationId, [])
    before = len(folders)
    out = lm_scoring.scored(odd)
    made = [Path(f.removeprefix("file://")) for f in folders[before:]]
    assert len(made) > 3 and sum(f.exists() for f in made) == 1
    assert out.count() == odd.count()


def test_scores_of_odd_rows(spark, odd):
    got = {r.doc_id: r for r in lm_scoring.scored(odd).collect()}
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 1 and got[7].n_tokens == 3001
    assert all(np.isfinite(r.score) and r.score < 0 for r in got.values())
    assert lm_scoring.scored(odd.limit(0)).count() == 0
    held = next(i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm_scoring.scored(spark.createDataFrame([(held, "only held out")], "doc_id long, text string")).first()
    assert (r.train_tokens, r.n_known) == (0, 0) and np.isfinite(r.score)


# 4, 7 ----------------------------------------------------------------------------------------------------------------


def strange_texts():
    rng = random.Random(3)
    parts = ["a", "é", "ß", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "1", "½", "Ⅷ", "'s", "'ll", "_", "😀", "𝒜", "中", "<|endoftext|>", "the", "ing"]
    long = ["a" * 3000, "ab" * 2000, "".join(rng.choices("abcdefgh", k=4000)), "  " * 500, "!" * 999]
    return ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(300)] + long + ["", "x"]


def test_token_counts_equal_the_library(spark, small, odd):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for df in (docs(spark, strange_texts()), small, odd):
        want = sorted(str((i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 1024)) for i, t in texts_of(df))
        assert sorted(map(str, map(tuple, token_counts.token_counts(df).collect()))) == want
    assert token_counts.token_counts(odd.limit(0)).count() == 0


def test_encoding_equals_the_library_and_decodes(spark, small, odd):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (docs(spark, strange_texts()), small, odd):
        want = []
        for i, t in texts_of(df):
            ids = library.encode_ordinary(t or "")
            want.append(str((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())))
        assert sorted(map(str, map(tuple, byte_bpe.encode_decode(df).collect()))) == sorted(want)
    with_ids = byte_bpe.encode_decode(docs(spark, ["hello there"]), with_ids=True).first()
    assert with_ids.ids == library.encode_ordinary("hello there") and bytes(with_ids.decoded) == b"hello there"
    assert byte_bpe.encode_decode(odd.limit(0)).count() == 0


def test_tree_joins_like_one_piece():
    tree = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rng = random.Random(4)
    for _ in range(200):
        data = "".join(rng.choices(["the", "ing", "a", "b", "é", "tion", "x"], k=rng.randint(2, 60))).encode()
        cut = rng.randrange(1, len(data))
        assert tree.join(tree.encode(data[:cut]), tree.encode(data[cut:])) == tree.merged(data) == tree.encode(data)


def test_pieces_go_through_the_tree(small):
    """Each piece of n > 2 bytes that is not cached takes part in a join for each two leaves or more, on real texts."""
    tree = byte_bpe.TreeCodec(byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).ranks)
    pieces = {p for _, t in texts_of(small) for p in byte_bpe.pretokens(t or "")}
    for p in pieces:
        tree[p]
    sizes = [len(p.encode()) for p in pieces]
    assert tree.joins >= sum(n > 2 for n in sizes) > 0.9 * len(pieces)
    assert tree.joins == sum(joins(n) for n in sizes)
    assert tree.decode([]) == b"" and tree.decode([65]) == tree.bytes_of[65]


def test_pieces_in_use_are_not_joined_again(monkeypatch):
    """A full cache keeps what is in use, so that many pieces which come once don't cost the frequent ones' joins."""
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(byte_bpe, "STABLE_ENTRIES", 30)
    ranks = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).ranks
    tree, library = byte_bpe.TreeCodec(ranks), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = " ".join(f"frequently q{'xyz'[i % 3]}{chr(97 + i // 26)}{chr(97 + i % 26)}vern" for i in range(300))
    assert np.frombuffer(tree.encode_text(text), "<u4").tolist() == library.encode_ordinary(text)
    assert tree.joins == sum(joins(len(p)) for p in set(byte_bpe.pretokens(text)))
    assert max(map(len, (tree, tree.older, tree.pairs, tree.windows, tree.leaves))) <= 30


def joins(n):
    return 0 if n <= byte_bpe.LEAF else 1 + joins(n // 2) + joins(n - n // 2)


# 5 -------------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    a, b = "<p>" + "a" * 200, "<p>é" + "b" * 97
    pages = [(5, "http://x/ y", a), (3, "http://z", a), (9, None, a), (4, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (11, "u", b), (2, "u", b), (None, "u", a), (12, "u", "c" * 300_000)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, refers_to string")
    got = {r.page_id: r for r in warc.round_trip(spark, df).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        5: ("revisit", 3), 3: ("response", None), 9: ("revisit", 3), 4: ("response", None), 6: ("response", None), 7: ("response", None),
        8: ("response", None), 11: ("revisit", 2), 2: ("response", None), None: ("response", None), 12: ("response", None),
    }
    for i, _, html in pages:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def archive(records, known=b""):
    writer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(known)) if known else zstandard.ZstdCompressor()
    lead = struct.pack("<II", warc.SKIPPABLE_DICTIONARY, len(known)) + known if known else b""
    return lead + b"".join(writer.compress(r) for r in records)


def test_warc_of_repeated_rows_and_long_payloads(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=9_000_000))
    pages = [(1, "u", "p" * 150)] * 3 + [(2, "u", "p" * 150)] * 2 + [(None, "u", "p" * 150)] * 2 + [(3, "v", long), (4, "v", long)]
    got = collections.Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect())
    assert got == {(1, 150, "response", None): 3, (2, 150, "revisit", 1): 2, (None, 150, "response", None): 2, (3, 9_000_000, "response", None): 1, (4, 9_000_000, "revisit", 3): 1}


def test_archives_of_lost_tasks_are_not_read(spark, monkeypatch):
    """An archive that no task which succeeded has named stays in the folder, as after a lost executor."""
    write = warc.write_archives

    def with_stray(records, folder, dictionary):
        made = write(records, folder, dictionary)
        path = Path(folder.removeprefix("file://"))
        path.mkdir(parents=True, exist_ok=True)
        (path / f"{'0' * 32}.warc.zst").write_bytes(archive([warc.record(i, "u", b"page %d" % i) for i in range(3)]))
        return made

    monkeypatch.setattr(warc, "write_archives", with_stray)
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)], "page_id long, url string, html string")
    assert sorted(r.page_id for r in warc.round_trip(spark, df).collect()) == list(range(20))


def test_archives_are_validated():
    known = zstandard.train_dictionary(2000, [f"a page {i} of many words {i * i}".encode() * 20 for i in range(300)]).as_bytes()
    records = [warc.record(i, "http://u", f"page {i}".encode() * 50) for i in range(5)]
    for lead in (b"", known):
        data = archive(records, lead)
        assert list(warc.frames(data)) == records and [warc.parse_record(r)["page_id"] for r in records] == list(range(5))
        for bad in (data[:-3], data[: len(data) // 2], data + b"xxxxxxxx"):
            with pytest.raises((warc.CorruptArchive, struct.error)):
                list(warc.frames(bad))
    one = records[1]
    for bad in (one.replace(b"WARC/1.1", b"HTTP/1.1"), one[:-1], one.replace(b"page 1page", b"page 2page"), one.replace(b"WARC-Type", b"X"), one + b"x"):
        with pytest.raises(warc.CorruptArchive):
            warc.parse_record(bad)
    compressed = zstandard.ZstdCompressor().compress(known)
    assert list(warc.frames(struct.pack("<II", warc.SKIPPABLE_DICTIONARY, len(compressed)) + compressed + archive(records, known)[8 + len(known) :])) == records


# 6 -------------------------------------------------------------------------------------------------------------------


def brute_features(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_features(spark, small, odd):
    more = docs(spark, ["a b c d e a b c d e f", "l one\nl one\n\nx\nl one", "# $ % & | < > * ok", "a b c d e " * 40])
    for df in (small, odd, more):
        got = quality_rules.quality(df).collect()
        assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == sorted(str((i, *brute_features(t))) for i, t in texts_of(df))
        assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert quality_rules.quality(odd.limit(0)).count() == 0
    assert quality_rules.good_documents(odd).columns == odd.columns


def test_quality_tells_labels_apart(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_rules.quality(d).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r.kept == (r.quality == 1) for r in got) and len(got) > 300


def test_rare_junk_fails_beside_many_good_documents(spark):
    """Seven documents of a kind of junk among 3000 of prose, and a monotone text of any length."""
    rng = random.Random(9)
    syllables = ["ba", "ke", "li", "mo", "nu", "ra", "se", "ti", "vo"]
    word = lambda: "".join(rng.choices(syllables, k=rng.choice([2, 2, 3])))
    good = [" ".join(word() for _ in range(60)) for _ in range(3000)]
    shout = [" ".join(word() for _ in range(60)).upper() for _ in range(7)]
    few = [word() for _ in range(40)]
    dull = [" ".join(rng.choices(few, k=n)) for n in (900, 2500, 30_000)]
    got = {r.doc_id: r.kept for r in quality_rules.quality(docs(spark, good + shout + dull)).collect()}
    assert all(got[i] for i in range(1, 3001)) and not any(got[i] for i in range(3001, 3011))


# 8 -------------------------------------------------------------------------------------------------------------------


def test_boilerplate_lines_go(spark):
    pages = [(f"own line {i}\n  Menu \nmore {i}\n\nMenu", "big") for i in range(40)] + [("Menu\nalone", "small")] * 5 + [(f"x{i}\nMenu", None) for i in range(20)]
    pages += [("Menu\nonly page", "one")] + [(f"page {i} of nine\nfoot", "nine") for i in range(9)]
    got = line_dedup.judged_lines(docs(spark, pages)).collect()
    assert {(r._in.source, r._in.text.count("Menu"), r._n_dropped) for r in got} == {("big", 0, 2), ("small", 0, 2), (None, 0, 1), ("one", 1, 0), ("nine", 0, 1)}
    assert next(r._in.text for r in got if r._in.doc_id == 1) == "own line 0\nmore 0\n"
    beyond = line_dedup.judged_lines(docs(spark, pages), max_sites_sent=0)
    assert sorted(map(str, beyond.collect())) == sorted(map(str, got))


def test_boilerplate_is_the_ratio_alone(spark):
    """6 of 50 pages are over a tenth, 5 are not; repeated rows count as often as they occur; very long texts are whole."""
    pages = [(f"p{i}\n" + ("six" if i < 6 else "") + "\n" + ("five" if 10 <= i < 15 else ""), "s") for i in range(50)]
    pages[40] = ("\n".join(f"{i} own" for i in range(400_000)) + "\nsix", "s")
    got = {r._in.doc_id: r for r in line_dedup.judged_lines(docs(spark, pages[:6] + pages[6:])).collect()}
    assert all("six" not in r._in.text for r in got.values()) and sum("five" in r._in.text for r in got.values()) == 5
    assert got[41]._n_lines == 400_001 and got[41]._n_dropped == 1
    twice = docs(spark, [("a\nrow", "t")] * 2 + [(f"b{i}", "t") for i in range(15)])
    assert {r._n_dropped for r in line_dedup.judged_lines(twice).where("_in.text <> ''").collect()} == {0}


def test_line_dedup_of_odd_rows(spark, odd):
    out = line_dedup.drop_boilerplate(odd)
    assert out.count() == 12 and out.columns == odd.columns and out.where("doc_id = 1 and text is null").count() == 1
    assert line_dedup.line_dedup(odd.limit(0)).count() == 0


# 9 -------------------------------------------------------------------------------------------------------------------


def brute_top_k(items, is_query, k):
    """items may repeat an id: each row is a query and a candidate of its own."""
    ints = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in items if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    top = lambda s: max(min(s, topk_search.LONG), -topk_search.LONG)
    out = []
    for at, (q, v) in enumerate(ints):
        if is_query(q):
            best = sorted((-top(sum(a * b for a, b in zip(v, w, strict=False))), i) for n, (i, w) in enumerate(ints) if n != at)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_of_repeated_ids(spark):
    """Rows that share an id are rows of their own, as candidates of others, of each other, and as queries."""
    items = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.25, 0.0]), (100, [0.0, 3.0]), (1, [1.0, 0.0]), (3, [0.0, -1.0])]
    df = spark.createDataFrame(items, "vec_id long, embedding array<float>")
    got = rows(topk_search.top_k(df, F.col("vec_id") % 100 == 0))
    assert got == brute_top_k(items, lambda q: q % 100 == 0, 10) and (100, 1, 1, 1 << 20) in got and (100, 2, 1, 1 << 20) in got


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    length = rng.choice([0.01, 0.5, 1, 30], 400)
    items = [(i, (v / np.linalg.norm(v) * n).astype(np.float32).tolist()) for i, (v, n) in enumerate(zip(rng.normal(size=(400, 8)), length, strict=True))]
    items += [(500 + i, items[3][1]) for i in range(30)] + [(600, None), (601, [1.0, None] + [0.0] * 6), (602, [float("nan")] * 8), (603, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (700, [0.0] * 8), (701, []), (800, [3e30] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in items], "vec_id long, embedding array<float>, norm int")
    small = df.where("vec_id < 800 or vec_id is null")
    want = brute_top_k([x for x in items if x[0] != 800], lambda q: q % 20 == 0, 10)
    assert rows(topk_search.top_k(small, F.col("vec_id") % 20 == 0)) == want
    assert rows(topk_search.top_k(small, F.col("vec_id") % 20 == 0, query_bytes=200, slice_bytes=3000, seeds=50)) == want
    assert rows(topk_search.top_k(small, F.col("vec_id") % 20 == 0, query_bytes=200, slice_bytes=3000, seeds=5)) == want
    huge = [(800, [topk_search.LONG / 1024] * 8)]  # its components are clamped to a long
    assert rows(topk_search.top_k(df, F.col("vec_id") % 400 == 0, k=3)) == brute_top_k(items[:-1] + huge, lambda q: q % 400 == 0, 3)
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert topk_search.top_k(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


# 10 ------------------------------------------------------------------------------------------------------------------


def brute_removed(items, length=50):
    first, split = {}, sorted(((i, (t or "").encode().split()) for i, t in items), key=lambda x: x[0])
    for i, w in split:
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), i)
    out = []
    for i, w in split:
        gone = {p for k in range(len(w) - length + 1) if first[tuple(w[k : k + length])] < i for p in range(k, k + length)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_passages_equal_brute_force(spark, small):
    rng = random.Random(8)
    passage, other = prose(rng, 70), prose(rng, 55)
    made = [f"{prose(rng, rng.randrange(80))} {rng.choice([passage, other, ''])} {prose(rng, rng.randrange(80))}" for _ in range(60)]
    made += [changed(rng, made[0], 1), made[1], made[1], f"{passage} {passage}", passage[:200], " ".join(["the"] * 200), " ".join(["the"] * 90), f"{other}\n{passage}"]
    df = docs(spark, made)
    assert rows(substring_dedup.without_repeats(df)) == brute_removed(texts_of(df))
    assert rows(substring_dedup.without_repeats(df, max_rows_sent=0)) == brute_removed(texts_of(df))
    assert rows(substring_dedup.without_repeats(df, length=20, k=6)) == brute_removed(texts_of(df), 20)
    assert rows(substring_dedup.without_repeats(small)) == brute_removed(texts_of(small))


def test_repeats_of_odd_rows(spark, odd):
    got = substring_dedup.without_repeats(odd, with_text=True).collect()
    assert len(got) == 12 and {r.n_removed for r in got} == {0}
    assert substring_dedup.without_repeats(odd.limit(0)).count() == 0


def test_top_k_where_batches_span_files(spark):
    """Many small files of lengths from 0 to 1000, several of which one task reads, so that a batch's rows are out of order."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(20_000, 4))
    v *= (1000 * rng.random(20_000) ** 8 / np.linalg.norm(v, axis=1))[:, None]
    v = v.astype(np.float32)
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<float>")
    ints = np.floor(1024 * v.astype(np.float64)).astype(np.int64)
    want = []
    for q in range(0, 20_000, 200):
        scores = ints @ ints[q]
        scores[q] = -(1 << 62)
        want += [(q, n, int(i), int(scores[i])) for n, i in enumerate(np.lexsort((np.arange(20_000), -scores))[:10], 1)]
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert rows(topk_search.top_k(df, F.col("vec_id") % 200 == 0)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_top_k_bucket_in_any_order():
    matrix = np.array([[900.0, 0], [1, 0], [0, 2], [3, 0]])
    best = topk_search.Best(np.array([99]), np.array([[5.0, 0]]), np.array([100.0]), 1)
    best.bucket(np.arange(4), np.arange(4), matrix, np.linalg.norm(matrix, axis=1))
    assert best.found == [[(-4500, 0)]]


def test_very_long_texts(spark):
    """Texts beyond every slice that operators work in, with a repeated passage and a near copy at their ends."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(20, 60)))
    passage = " ".join(word() for _ in range(70))
    a = " ".join([*(word() for _ in range(120_000)), passage])
    df = docs(spark, [f"{passage} short", a, a.replace(" ", "\n", 50) + " near", "tail " + passage, a[:1000]])
    assert rows(substring_dedup.without_repeats(df)) == brute_removed(texts_of(df))
    assert rows(minhash_dedup.near_duplicates(df, 85)) == brute_components(texts_of(df), 85)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df).collect()}
    assert got[2] == len(tokenizer.encode(a, add_special_tokens=False).ids)
    sha = {r.doc_id: r.decoded_sha256 for r in byte_bpe.encode_decode(df).collect()}
    assert sha[2] == hashlib.sha256(a.encode()).hexdigest()


def test_recall_of_bands_near_the_threshold():
    """Of pairs of sets at a similarity just over 0.85 and 0.8, those that share no band or lose by their sketches."""
    rng = np.random.default_rng(7)
    for similarity in (0.85, 0.8):
        n, lost = 200, 0
        common = round(2 * n * similarity / (1 + similarity))
        for _ in range(10):
            sets = []
            for _ in range(100):
                x = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
                sets += [np.sort(x[:n]), np.sort(x[n - common :])]
            minima = minhash_dedup.samples(sets)
            keys, sketch = minhash_dedup.band_keys(minima), minhash_dedup.odd_sketches(minima)
            bits = np.bitwise_count(sketch[::2] ^ sketch[1::2]).sum(1)
            lost += int((~(keys[::2] == keys[1::2]).any(1) | (bits > minhash_dedup.most_differing_bits(similarity))).sum())
        assert lost <= 2, (similarity, lost)


# pipeline ------------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, small):
    """Each stage on what the one before kept, against plain versions of the decisions."""
    d = small
    kept = quality_rules.quality(d).where("kept").select("doc_id").collect()
    d = corpus_pipeline.quality(spark, d, DIR)
    assert sorted(r.doc_id for r in d.collect()) == sorted(r.doc_id for r in kept)
    d = corpus_pipeline.lines(spark, d, DIR)
    assert d.columns == small.columns and d.count() == len(kept)
    want = [i for i, _, _, stays in brute_components(texts_of(d), 80) if stays]
    d = corpus_pipeline.near_duplicates(spark, d, DIR)
    assert sorted(r.doc_id for r in d.collect()) == want
    m = corpus_pipeline.mix(spark, d, DIR)
    copies = collections.Counter(r.doc_id for r in m.collect())
    assert m.columns == small.columns and copies == {r._in.doc_id: r._copies for r in mixing.replicated(d).collect()}
    out = corpus_pipeline.encode(spark, m, DIR)
    assert collections.Counter(r.doc_id for r in out.collect()) == copies
    whole = corpus_pipeline.run(spark, DIR)
    assert rows(whole) == rows(out) and [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "mixing", "byte-level BPE"]


def test_pipeline_equals_a_plain_version(spark, small):
    """All stages in plain Python (the verdict of the quality rules in SQL), from the same documents to the same digests."""
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{DIR}/documents.parquet')")
    verdict = c.execute(quality_rules.oracle()).fetchall()
    names = [d[0] for d in c.execute(quality_rules.oracle()).description]
    good = {r[names.index("doc_id")] for r in verdict if r[names.index("kept")]}
    d = [(r.doc_id, r.text or "", r.source) for r in small.collect() if r.doc_id in good]
    pages, held = collections.Counter(s for _, _, s in d), collections.Counter()
    strip = lambda x: x.strip(" \t\n\x0b\x0c\r")
    for _, t, s in d:
        held.update({(s, k) for k in map(strip, t.split("\n")) if k})
    gone = {x for x, n in held.items() if n > 1 and n > 0.1 * pages[x[0]]}
    d = [(i, "\n".join(x for x in t.split("\n") if (s, strip(x)) not in gone), s) for i, t, s in d]
    kept = {i for i, _, _, stays in brute_components([(i, t) for i, t, _ in d], 80) if stays}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    want = []
    for i, t, _, n in brute_mixed([x for x in d if x[0] in kept]):
        ids = library.encode_ordinary(t)
        want += [(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] * n
    assert rows(corpus_pipeline.run(spark, DIR)) == sorted(want) and len(want) > 50


def test_pipeline_of_odd_rows(spark, odd):
    d = odd
    for name, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, DIR)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert d.columns == odd.columns, name
    d.count()
