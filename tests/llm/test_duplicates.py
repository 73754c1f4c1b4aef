import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import pyarrow as pa
from pairsmith.llm import decontamination, fingerprints, jaccard_join, substring_dedup
from pairsmith.llm.components import components
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def brute_components(texts):
    sets, parent, where = {k: shingles(t) for k, t in texts.items()}, {k: k for k in texts}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in sorted(sets):
        met = Counter(y for s in sets[k] for y in where[s])
        for y, n in met.items():
            if 100 * n >= 75 * (len(sets[k]) + len(sets[y]) - n):
                a, b = root(k), root(y)
                parent[max(a, b)] = min(a, b)
        for s in sets[k]:
            where[s].append(k)
    return {k: (len(sets[k]), root(k)) for k in texts}


def brute_cut(texts, size=13):
    first, words = {}, {k: (texts[k] or "").encode().split() for k in sorted(texts)}
    for k, w in words.items():
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i:i + size]), k)
    out = {}
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < k:
                gone[i:i + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out[k] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.fixture(scope="module")
def near(spark):
    """Groups of near copies around the threshold, passages that very many share, and a large group of copies."""
    draw, texts, k = random.Random(5), {}, 0
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    for size in (4, 6, 30, 90, 200):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for _ in range(12):
                copy = list(base)
                for _ in range(draw.choice([0, 1, 1, 2, 3])):
                    copy[draw.randrange(size)] = word()
                if draw.random() < 0.4:
                    at = draw.randrange(size)
                    copy[at:at] = passage
                texts[k] = " ".join(copy)
                k += 1
    for _ in range(150):
        texts[k] = " ".join([*passage, *[word() for _ in range(draw.choice([2, 8, 25, 60]))]])
        k += 1
    for _ in range(60):
        texts[k] = texts[14]
        k += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    return texts, docs


def as_dict(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_jaccard_join_equals_brute_force(spark, given):
    assert as_dict(jaccard_join.op10_ngram_jaccard_join(spark, SF)) == brute_components(given)


@pytest.mark.parametrize("frequent,most,leaders,block,step", [(64, 1 << 20, (0, -1), 256, 1_500_000), (2, 50, (0,), 3, 2_000), (10**9, 1 << 20, (5,), 2, 500)])
def test_jaccard_join_of_near_copies(spark, near, monkeypatch, frequent, most, leaders, block, step):
    """However tokens are ordered and groups are led, the result is that of all pairs."""
    texts, docs = near
    for name, value in (("FREQUENT", frequent), ("MOST_FREQUENT", most), ("LEADERS", leaders), ("BLOCK", block), ("TOKENS_PER_TASK_STEP", step)):
        monkeypatch.setattr(jaccard_join, name, value)
    assert as_dict(jaccard_join.near_duplicates(docs)) == brute_components(texts)


@pytest.mark.parametrize("pieces", [1, 7, 512])
def test_least_of_a_key_over_pieces(spark, monkeypatch, pieces):
    monkeypatch.setattr(jaccard_join, "PIECES", pieces)
    rows = spark.range(600).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("token"), F.xxhash64("id").alias("doc"))
    rows = rows.union(rows.where("token = 0"))  # a third of the rows share a key, and rows repeat
    got = jaccard_join.with_least(rows, ["token"], {"low": F.col("doc"), "high": F.col("doc").bitwiseXOR(F.lit(-1))}, "doc").collect()
    by = defaultdict(list)
    for r in rows.collect():
        by[r["token"]].append(r["doc"])
    want = Counter((k, d, min(v), min(~x for x in v)) for k, v in by.items() for d in v)
    assert Counter((r["token"], r["doc"], r["low"], r["high"]) for r in got) == want
    assert not jaccard_join.with_least(rows.limit(0), ["token"], {"low": F.col("doc")}, "doc").collect()


def test_substring_dedup_equals_brute_force(spark, given):
    assert as_dict(substring_dedup.op8_substring_dedup(spark, SF)) == brute_cut(given)


def test_substring_dedup_of_passages(spark, near, monkeypatch):
    texts, docs = near
    monkeypatch.setattr(substring_dedup, "WINDOWS_PER_TASK_STEP", 300)
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in substring_dedup.dedup_substrings(docs).collect()}
    assert got == brute_cut(texts)


def test_odd_rows(odd, nothing):
    texts = {r.doc_id: r.text for r in odd.where("doc_id is not null").collect()}
    assert as_dict(jaccard_join.near_duplicates(odd)) == brute_components(texts)
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in substring_dedup.dedup_substrings(odd).collect()}
    assert got == brute_cut(texts)
    assert jaccard_join.near_duplicates(nothing).count() == 0 and substring_dedup.dedup_substrings(nothing).count() == 0
    assert decontamination.leaks(odd, odd.select(F.lit(1).alias("item_id"), F.lit(None).alias("text"))).count() == 0
    assert decontamination.leaks(nothing, odd.select(F.col("doc_id").alias("item_id"), "text", "doc_id")).count() == 0
    assert {r.doc_id for r in decontamination.leaks(odd, odd.select(F.col("doc_id").alias("item_id"), "text", "key")).collect()} == {1, 4, 5}


def test_components(spark):
    draw, parent = random.Random(1), list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(100, 180)]
    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for ab in links for x in ab if ab[0] != ab[1] or x in got}


def brute_tiles(p, t, shortest):
    mp, mt, total = [0] * len(p), [0] * len(t), 0
    while True:
        best, found = shortest - 1, []
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not mp[i + k] and not mt[j + k]:
                    k += 1
                if k > best:
                    best, found = k, []
                if k == best and k >= shortest:
                    found.append((i, j))
        if not found:
            return total
        for i, j in found:
            if not any(mp[i:i + best]) and not any(mt[j:j + best]):
                mp[i:i + best] = mt[j:j + best] = [1] * best
                total += best


def test_tiles_equal_brute_force():
    draw = random.Random(2)
    for _ in range(150):
        p, t = ([draw.randint(1, 4) for _ in range(draw.randint(1, 40))] for _ in "ab")
        assert sum(x[0] for x in decontamination.tiles(np.array(p, np.uint64), np.array(t, np.uint64), 3)) == brute_tiles(p, t, 3)


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_reordered_passages_leak_and_shared_phrases_do_not(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    docs = spark.createDataFrame([(1, "x Y z. A b c d, e f g h y"), (2, "e f g h and a b c d"), (3, "a b c d and more"), (4, "e f g a b c d h")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c d e f g h", 1), (8, "q w e r t y u i o p", 1), (9, "a b c", 1)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): (r.matched, r.tiles) for r in decontamination.leaks(docs, items).collect()}
    assert got == {(1, 7): (8, 1), (2, 7): (8, 2)}


def test_planted_benchmark_passages(spark, given):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in decontamination.op9_decontamination(spark, SF).collect()}
    assert {(d, i) for d, t in given.items() for i, x in items.items() if " ".join(x.split()) in " ".join(t.split())} <= got


def test_fingerprints(spark, given):
    rows = {r.doc_id: r for r in fingerprints.op4_fingerprints(spark, SF).collect()}
    order = sorted(given, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    wrong = []
    for k, text in given.items():
        half = len(text) // 2
        edited = text[:len(text) - half] + given[after[k]][:half]
        assert rows[k].n_chars == len(text) and rows[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(text), shingles(edited), shingles(given[after[k]])
        if len(a) > 200:
            wrong += [rows[k].near_edited - len(a & b) / len(a | b), rows[k].near_next - len(a & c) / len(a | c)]
    assert rows.keys() == given.keys() and np.abs(wrong).mean() < 0.05
    assert len({(given[k], rows[k].fingerprint) for k in given}) == len(set(given.values()))


def test_sketches_merge_and_contain(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    df = spark.createDataFrame([(long, " ".join(f"w{i}" for i in range(1000, 2000)), "one two", "")], "a string, b string, c string, e string")
    s = {x: fingerprints.sketch(F.col(x)) for x in "abce"}
    r = df.select(fingerprints.containment(s["b"], s["a"]), fingerprints.containment(s["a"], s["b"]), fingerprints.merge(s["b"], s["a"]) == s["a"],
                  fingerprints.merge(s["c"], s["a"]) == s["a"], fingerprints.likeness(s["e"], s["e"]), fingerprints.likeness(s["e"], s["a"]), F.size(s["c"])).first()
    assert r[0] == 1 and 0.2 < r[1] < 0.3 and r[2] and r[3] and r[4] == 1 and r[5] == 0 and r[6] == 1


def test_fingerprints_of_odd_rows(odd, nothing):
    assert fingerprints.with_next(odd).count() == odd.count() and fingerprints.with_next(nothing).count() == 0


def test_leaks_equal_tiling_of_all_pairs(spark, given):
    """Without seeds: every document is tiled with every item."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    hashes = lambda t: (lambda w: w.hashes)(decontamination.words_of(pa.array([t])))
    docs, own = {k: hashes(t) for k, t in given.items()}, {k: hashes(t) for k, t in items.items()}
    expected = {}
    for d, text in docs.items():
        for i, item in own.items():
            laid = decontamination.tiles(item, text) if len(item) >= decontamination.MIN_MATCH else []
            matched = sum(x[0] for x in laid)
            if laid and matched >= decontamination.THRESHOLD * len(item):
                expected[d, i] = (matched, len(item))
    got = {(r.doc_id, r.item_id): (r.matched, r.item_words) for r in decontamination.op9_decontamination(spark, SF).collect()}
    assert expected and got == expected


def test_every_text_of_an_item_is_searched(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SPELT_OUT", 5)
    items = spark.createDataFrame([(7, "the quick brown fox jumps over the lazy dog"), (7, "an apple a day keeps the doctor away"), (8, "which of the following is not a fish")] +
                                  [(100 + i, f"which of the following {i} is{i} a{i}") for i in range(50)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so the quick brown fox jumps over the lazy dog ran"), (2, "an apple a day keeps the doctor away"), (3, "which of the following will you take"),
                                  (4, "which of the following 3 is3 a3")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == {(1, 7), (2, 7), (4, 103)}
