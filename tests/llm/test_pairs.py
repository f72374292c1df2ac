import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from folioflow.llm import neardup as n

VOCAB = [f"w{i}" for i in range(400)]


def corpus(rng, groups=40, size=4):
    out, i = [], 0
    for _ in range(groups):
        base = [rng.choice(VOCAB) for _ in range(rng.randrange(40, 80))]
        for _ in range(rng.randrange(1, size + 1)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            i += 1
            out.append(("text", i, " ".join(w)))
    return out


def brute(rows, k, least, t):
    sets = defaultdict(dict)
    for f, i, s in rows:
        w = n.words(s or "")
        if len(w) >= max(least, k):
            sets[f][i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    return {(f, a, b) for f, d in sets.items() for a, b in combinations(sorted(d), 2) if len(d[a] & d[b]) >= t * len(d[a] | d[b])}


def test_pairs_equal_brute_force(spark):
    rng = random.Random(2)
    rows = corpus(rng) + [("working", 1, "a b c"), ("working", 2, None), ("working", 3, "")]
    rows += [("text", 900 + i, rows[0][2].upper() + "!") for i in range(3)]  # copies but for case
    df = spark.createDataFrame(rows + rows[:5], "field string, id bigint, text string")
    got = {tuple(r) for r in n.all_pairs(*n.near_duplicates(df.filter("text is not null"), 0.4, 3, 30)).collect()}
    # every pair is real; pairs far from the limit are all there (closer ones with the probability stated at BANDS)
    assert got <= brute(rows, 3, 30, 0.4) and brute(rows, 3, 30, 0.6) <= got
    assert any(b >= 900 for _, _, b in got)


def test_default_is_five_words_and_four_fifths(spark):
    rows = corpus(random.Random(4), 30)
    df = spark.createDataFrame(rows, "field string, id bigint, text string")
    pairs, members = n.near_duplicates(df)
    rep = {r.id: r.rep for r in members.collect()}
    assert len(rep) == len(rows)
    got = {tuple(r) for r in n.all_pairs(pairs, members).collect()}
    assert got == brute(rows, 5, 1, 0.8)


def test_groups_are_the_connected_ones(spark):
    links = [(i, i + 1) for i in range(1, 12)] + [(20, 22), (21, 22), (30, 31)]
    pairs = spark.createDataFrame([("text", a, b, 1.0) for a, b in links], "field string, a bigint, b bigint, similarity double")
    ids = sorted({x for p in links for x in p} | {40})
    members = spark.createDataFrame([("text", i, i) for i in ids] + [("text", 50, 30)], "field string, id bigint, rep bigint")
    got = {r.id: (r.group_id, r.links) for r in n.groups(pairs, members).collect()}
    want = {i: 1 if i < 13 else 20 if i < 23 else 30 for i in ids if i < 40} | {40: 40, 50: 30}
    assert {i: g for i, (g, _) in got.items()} == want
    assert got[1][1] == 1 and got[2][1] == 2 and got[22][1] == 2 and got[40][1] == 0


def test_no_pairs(spark):
    df = spark.createDataFrame([("text", 1, "one two"), ("text", 2, "x " * 40)], "field string, id bigint, text string")
    assert n.all_pairs(*n.near_duplicates(df, 0.4, 3, 30)).count() == 0
    assert n.all_pairs(*n.near_duplicates(df.limit(0), 0.4, 3, 30)).count() == 0


def near_limit(rng, lo, hi, k=3):
    """Two texts whose similarity lies in [lo, hi)."""
    while True:
        base = [rng.choice(VOCAB) for _ in range(rng.randrange(40, 90))]
        other = list(base)
        for _ in range(rng.randrange(3, 14)):
            other[rng.randrange(len(other))] = rng.choice(VOCAB)
        x, y = ({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} for w in (base, other))
        if lo <= len(x & y) / len(x | y) < hi:
            return base, other


def test_recall_close_to_the_limit(spark):
    rng = random.Random(9)
    for lo, hi, least in ((0.4, 0.43, 0.9), (0.45, 0.48, 0.96), (0.5, 0.53, 0.98)):
        rows = [("text", 2 * i + j, " ".join(w)) for i in range(300) for j, w in enumerate(near_limit(rng, lo, hi))]
        df = spark.createDataFrame(rows, "field string, id bigint, text string")
        got = {tuple(r) for r in n.all_pairs(*n.near_duplicates(df, 0.4, 3, 30)).collect()}
        want = brute(rows, 3, 30, 0.4)
        assert got <= want and len(want) >= 300 and len(got) / len(want) >= least, (lo, len(got), len(want))


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(n, "BLOCK", 7)
    df = spark.createDataFrame([(g, i * 3) for g, size in ((1, 40), (2, 7), (3, 8), (4, 1), (5, 0)) for i in range(size)], "g int, id bigint")
    got = sorted((r.g, r.a, r.b) for r in n.pairs_within(df, ["g"], "id").collect())
    assert got == sorted((g, i * 3, j * 3) for g, size in ((1, 40), (2, 7), (3, 8)) for i in range(size) for j in range(i + 1, size))


def test_rows_that_are_alone_go(spark):
    rng = random.Random(5)
    texts = [[rng.choice(VOCAB) for _ in range(30)] for _ in range(40)]
    texts += [[rng.choice(VOCAB) if rng.random() < 0.2 else w for w in rng.choice(texts)] for _ in range(40)] + [texts[0]] * 15
    df = spark.createDataFrame([("text", i, " ".join(w)) for i, w in enumerate(texts)], "field string, rep bigint, words string")
    profile = n.profiles(df, 3, n.reference_fingerprints(df.withColumn("class_id", F.col("words")), 3))
    perms = n._permutations(n.MINHASHES)
    mix = zlib.crc32(b"text")
    rows = [(int(k) ^ mix, i) for i, ks in enumerate(n.band_keys(n.minhashes(*n.shingle_sets(texts), perms))) for k in ks]
    count = Counter(k for k, _ in rows)
    want = sorted(r for r in rows if count[r[0]] > 1)
    assert 15 * n.BANDS < len(want) < len(rows)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (old, "3", "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            for buckets in (1, 64):
                assert sorted((r.key, r.rep) for r in n.shared_keys(n.band_buckets(profile, buckets)).collect()) == want, (size, buckets)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_discarding_loses_nothing(spark):
    rng = random.Random(3)
    rows = [("text", 2 * i + j, " ".join(w)) for i in range(60) for j, w in enumerate(near_limit(rng, 0.3, 0.7))] + [("text", 999, " ".join(rng.choice(VOCAB) for _ in range(5000)))]
    df = spark.createDataFrame(rows, "field string, id bigint, text string")
    members = n.classes(df, 30)
    reps = members.select("field", F.col("id").alias("rep"), "words")
    pivots = n.reference_fingerprints(members, 3)
    assert pivots.shape == (n.PIVOTS, n.BITS // 8) and not pivots[0].any()
    profile = n.profiles(reps, 3, pivots)
    ids = sorted(r[1] for r in rows)
    pairs = spark.createDataFrame(list(combinations(ids, 2)), "a bigint, b bigint")
    stages = {(r.a, r.b): r.stage for r in n.near_by_prints(pairs, profile, 0.4, measure=True).collect()}
    alike = {(a, b) for _, a, b in brute(rows, 3, 30, 0.4)}
    assert len(stages) == len(ids) * (len(ids) - 1) // 2 and all(stages[p] == "kept" for p in alike)
    assert sum(s == "kept" for s in stages.values()) < 0.05 * len(stages)
    assert any(s == "pivot" for s in stages.values())


def test_pivot_tables_never_contradict_the_distance():
    rng = np.random.default_rng(1)
    pivots, a, b = (rng.integers(0, 256, (50, n.BITS // 8), dtype=np.uint8) for _ in range(3))
    for x, y in zip(a, b):
        assert np.abs(n.hamming(pivots, x).astype(int) - n.hamming(pivots, y)).max() <= n.hamming(x, y)


def test_equal_and_unlike_fingerprints():
    s = n.shingles([f"w{i}" for i in range(60)])
    t = n.shingles([f"v{i}" for i in range(60)])
    f = [n.fingerprint(x) for x in (s, s, t)]
    assert n.hamming(f[0], f[1]) == 0 and n.hamming(f[0], f[2]) <= len(s) + len(t)
    assert n.hamming(f[0], f[2]) > n.allowed_distance(np.array([len(s)]), np.array([len(t)]), 0.4)[0]
    assert n.jaccard(s, s) == 1.0 and n.jaccard(s, t) == 0.0


def test_many_sets_at_once_are_the_sets_of_each():
    rng = random.Random(6)
    texts = [[rng.choice(VOCAB[:40]) for _ in range(rng.randrange(3, 200))] for _ in range(150)]
    flat, offsets = n.shingle_sets(texts)
    perms = n._permutations(n.MINHASHES)
    low, prints = n.minhashes(flat, offsets, perms), n.fingerprints(flat, offsets)
    for i, w in enumerate(texts):
        own = n.shingles(w)
        assert (flat[offsets[i] : offsets[i + 1]] == own).all() and len(own) == len({tuple(w[j : j + 3]) for j in range(len(w) - 2)})
        assert (low[i] == n.minhashes(own, np.array([0, len(own)]), perms)[0]).all() and (prints[i] == n.fingerprint(own)).all()
    assert n.words("It's A-1 b_c") == ["it", "s", "a", "1", "b", "c"] and n.words("\u00c9t\u00e9 X") == ["\u00e9t\u00e9", "x"]


def test_packed_rows_come_back():
    rng = np.random.default_rng(4)
    for most in (1, 300, 1 << 40, 1 << 62):
        keys, reps = rng.integers(0, 1 << 39, 50), rng.integers(0, most, 50) - (most == 300)
        rows, width = n.packed(keys, reps)
        assert rows.shape == (50, 5 + width) and (n.unpacked(rows.tobytes(), width) == np.stack([keys, reps], axis=1)).all()
    assert n.unpacked(b"", 3).shape == (0, 2)
