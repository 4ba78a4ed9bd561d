"""Super-k-mers, suffix arrays and SimHash against brute force."""
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orderlens.llm import components, kmers, simhash, suffixes
from orderlens.llm.common import NULL_ID, doc_order, text_tag


def keyed(df):
    rows = df.select(doc_order().alias("o"), text_tag().alias("t"), "text").distinct().collect()
    return sorted((r.o, r.t, r.text or "") for r in rows)


def key(i, text):
    return (NULL_ID if i is None else i, text or "")


def brute(df, window, split):
    seen, out = set(), {}
    for o, _, text in keyed(df):
        units = split(text.encode())
        gone = [0] * len(units)
        for s in range(len(units) - window + 1):
            w = tuple(units[s:s + window])
            if w in seen:
                gone[s:s + window] = [1] * window
            seen.add(w)
        out[(o, text)] = units, gone
    return out


def words_df(spark, seed):
    random.seed(seed)
    base = [random.choice("abcd") for _ in range(60)]
    docs = []
    for i in range(70):
        k = random.random()
        if k < .3:
            w = [random.choice("ab")] * random.randint(0, 50)
        elif k < .6:
            w = [random.choice("abcd") for _ in range(random.randint(0, 30))] + base[random.randint(0, 20):random.randint(25, 60)]
        else:
            w = ["x"] * random.randint(0, 3) + base * random.randint(1, 3)
        docs.append((i * 7 % 71 - 3, " ".join(w)))
    docs += [(None, "a " * 30), (None, None), (100, ""), (3, "b " * 25), (3, "b " * 25)]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("seed,shard", [(1, 50), (2, 400), (3, 10 ** 6)])
def test_super_kmers_brute(spark, seed, shard):
    df = words_df(spark, seed)
    want = brute(df, 6, bytes.split)
    got = sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in
                 kmers.dedup_windows(df, 6, 2, shard, with_text=True).collect())
    rows = []
    for r in df.collect():
        units, gone = want[key(r.doc_id, r.text)]
        rows.append(str((r.doc_id, len(units), sum(gone), b" ".join(u for u, g in zip(units, gone) if not g).decode())))
    assert got == sorted(rows)


@pytest.mark.parametrize("seed,shard", [(1, 60), (2, 300), (3, 10 ** 5)])
def test_suffix_arrays_brute(spark, seed, shard):
    df = words_df(spark, seed).withColumn("text", F.regexp_replace("text", "c", "é"))
    want = brute(df, 13, lambda b: list(b))
    got = sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in
                 suffixes.dedup_bytes(df, 13, 4, 3 * shard, shard, with_bytes=True).collect())
    rows = []
    for r in df.collect():
        units, gone = want[key(r.doc_id, r.text)]
        edges = sum(1 for a, b in zip([0] + gone, gone) if b and not a)
        rows.append(str((r.doc_id, len(units), sum(gone), edges, bytes(u for u, g in zip(units, gone) if not g))))
    assert got == sorted(rows)


def test_dedup_edge_rows(edge, empty):
    want = brute(edge, 20, bytes.split)
    got = sorted(str((r.doc_id, r.n_words, r.n_removed)) for r in kmers.dedup_windows(edge).collect())
    assert got == sorted(str((r.doc_id, len(want[key(r.doc_id, r.text)][0]), sum(want[key(r.doc_id, r.text)][1])))
                         for r in edge.collect())
    want = brute(edge, 100, lambda b: list(b))
    got = sorted(str((r.doc_id, r.n_bytes, r.n_removed)) for r in suffixes.dedup_bytes(edge).collect())
    assert got == sorted(str((r.doc_id, len(want[key(r.doc_id, r.text)][0]), sum(want[key(r.doc_id, r.text)][1])))
                         for r in edge.collect())
    assert kmers.dedup_windows(empty).count() == 0 and suffixes.dedup_bytes(empty).count() == 0


def test_suffix_array_core():
    random.seed(5)
    for rep in range(200):
        window = random.choice([3, 6, 9, 13, 20])
        pieces = ["".join(random.choice("ab" if rep % 2 else "abcd") for _ in range(random.randint(0, 60))).encode()
                  for _ in range(random.randint(1, 8))]
        data = b"".join(pieces)
        if not data:
            continue
        sa, _ = suffixes.suffix_array(np.frombuffer(data, np.uint8), window)
        pad = data + b"\0" * window
        assert sa.tolist() == sorted(range(len(data)), key=lambda i: (pad[i:i + window], i))
        for limit in (window + 1, window + 3, 40):
            parts = [x for s in suffixes._segments(None, None, pieces, window, max(limit, window + 1)) for x in s]
            assert sorted((d, at + k) for d, at, p in parts for k in range(len(p) - window + 1)) == sorted(
                (d, k) for d, p in enumerate(pieces) for k in range(len(p) - window + 1))


def test_common_prefixes_are_exact():
    random.seed(6)
    for _ in range(50):
        data = np.frombuffer("".join(random.choice("ab") for _ in range(80)).encode(), np.uint8)
        sa, _ = suffixes.suffix_array(data, 30)
        got = suffixes.common_prefixes(data, sa[1:], sa[:-1], 30)
        for k, (i, j) in enumerate(zip(sa[1:].tolist(), sa[:-1].tolist())):
            n = 0
            while n < 30 and i + n < 80 and j + n < 80 and data[i + n] == data[j + n]:
                n += 1
            assert got[k] == n


def test_golay_is_perfect():
    words = np.arange(1 << 23, dtype=np.int64)[::37]
    index = simhash.codeword_index(words)
    codeword = (index << 11) ^ simhash.UPPER[index]
    assert np.bitwise_count(words ^ codeword).max() <= 3
    found, first = simhash.codeword_indices(words[:5000], 23)
    assert first.sum(axis=1).max() <= 6


def test_links_find_every_pair(spark):
    random.seed(7)
    fps = {random.getrandbits(64) for _ in range(300)} | {0}
    for f in list(fps):
        for bits in (1, 2, 3, 4):
            fps.add(f ^ sum(1 << b for b in random.sample(range(64), bits)))
    u = np.array(sorted(fps), np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 3
    want = {tuple(sorted((int(a), int(b)))) for a, b in zip(*[u[x].view(np.int64) for x in np.nonzero(near)]) if a != b}
    df = spark.createDataFrame([(int(x),) for x in u.view(np.int64)], "fp long")
    assert {(r.a, r.b) for r in simhash.links(df).collect()} == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 103), (103, 101), (7, 7)]
    random.seed(1)
    random.shuffle(chain)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def brute_components(df):
    def fp(t):
        w = t.encode().lower().split()
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), seed=42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    rows = [(r.doc_id, fp(r.text or "")) for r in df.select("doc_id", "text").collect()]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), NULL_ID), NULL_ID if d is None else d)
    return [(d, f"{f:016x}", None if least[find(i)] == NULL_ID else least[find(i)]) for i, (d, f) in enumerate(rows)], \
        [None if x == NULL_ID else x for x in least.values()]


def test_simhash_edge_rows(edge, empty):
    got = sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in simhash.near_duplicates(edge).collect())
    assert got == sorted(map(str, brute_components(edge)[0]))
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each(edge):
    _, want = brute_components(edge)
    kept = simhash.one_of_each(edge)
    assert kept.columns == edge.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(map(str, want))  # one row of each component
