"""Packing, source divergence and vector codes against brute force, oracles and
edge rows."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from orderlens.llm import codes, divergence, packing
from orderlens.llm.common import table


# --- operator 11 -----------------------------------------------------------

def least_sequences(lengths, capacity):
    """Fewest sequences for a few pieces, by trying every set with the longest."""
    @lru_cache(maxsize=None)
    def least(rest):
        if not rest:
            return 0
        first, others = rest[0], rest[1:]
        best = len(rest)
        for mask in range(1 << len(others)):
            some = [x for i, x in enumerate(others) if mask >> i & 1]
            if first + sum(some) <= capacity:
                left = tuple(x for i, x in enumerate(others) if not mask >> i & 1)
                best = min(best, 1 + least(left))
        return best
    return least(tuple(sorted(lengths, reverse=True)))


def test_reduction_keeps_the_least_number():
    random.seed(11)
    reduced = 0
    for _ in range(400):
        capacity = random.choice([10, 13, 20, 30])
        lengths = [random.randint(1, capacity) for _ in range(random.randint(0, 9))]
        counts = np.bincount(lengths, minlength=capacity + 1) if lengths else np.zeros(capacity + 1, np.int64)
        fixed, left = packing.fixed_sets(counts, capacity)
        rest = [x for x in range(capacity + 1) for _ in range(left[x])]
        assert all(sum(f) <= capacity for f, _ in fixed)
        taken = Counter(x for f, times in fixed for x in f for _ in range(times))
        assert taken + Counter(rest) == Counter(lengths)
        sets = sum(times for _, times in fixed)
        reduced += sets
        assert sets + least_sequences(rest, capacity) == least_sequences(lengths, capacity)
        assert packing.least_number(counts, capacity) <= least_sequences(lengths, capacity)
    assert reduced > 400


def placed(counts, capacity):
    """Pieces of every sequence from the plan's runs."""
    out = defaultdict(list)
    for length, rank, n, sequence, each, offset in packing.plan(counts, capacity).tolist():
        for t in range(n):
            out[sequence + t // each].append((offset + t % each * length, length, rank + t))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole(seed):
    rng = np.random.default_rng(seed)
    capacity = 97
    counts = np.zeros(capacity + 1, np.int64)
    counts[1:] = rng.integers(0, 50, capacity) * (rng.uniform(size=capacity) < 0.6)
    counts[capacity] += 300 * (seed % 2)  # one hot length
    out = placed(counts, capacity)
    for pieces in out.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    ranks = Counter((length, rank) for p in out.values() for _, length, rank in p)
    assert set(ranks) == {(x, i) for x in range(capacity + 1) for i in range(counts[x])} and set(ranks.values()) <= {1}
    assert sorted(out) == list(range(len(out)))
    least = packing.least_number(counts, capacity)
    assert least <= len(out) <= least * 1.02 + 1


def test_plan_by_item_best_fit():
    """Many equal pieces at once give what one piece at a time gives."""
    random.seed(5)
    for _ in range(200):
        capacity = 40
        counts = np.bincount([random.randint(4, 18) for _ in range(random.randint(0, 60))], minlength=capacity + 1)
        got = len({s for _, _, n, s0, each, _ in packing._best_fit(counts, capacity, 0, np.zeros(capacity + 1, np.int64))
                   for s in range(s0, s0 - (-n // each))})
        rooms = []
        for w in range(capacity, 0, -1):
            for _ in range(counts[w]):
                fit = [r for r in rooms if r >= w]
                room = min(fit) if fit else capacity
                if fit:
                    rooms.remove(room)
                rooms.append(room - w)
        assert got == len(rooms)


def check_packing(rows, docs, capacity):
    """Pieces match the library's ids and every sequence is gapless."""
    tok = packing.load_tokenizer(packing.tokenizer_path())
    want, got = Counter(), Counter()
    for r in docs:
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            want[(r.doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    sequences = defaultdict(list)
    for r in rows:
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pack_edge_rows(spark, edge, empty):
    docs = edge.collect()
    n = check_packing(packing.pack(edge, packing.tokenizer_path(), 512).collect(), docs, 512)
    total = sum(len(packing.load_tokenizer(packing.tokenizer_path()).encode(r.text or "", add_special_tokens=False).ids) + 1
                for r in docs)
    assert n <= total / 512 * 1.1 + 1
    assert packing.pack(empty, packing.tokenizer_path()).collect() == []


def test_pack_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 20)
    texts = ["it's ÉCOLE x\x0by\x1cz", "<|endoftext|>a<|startoftext|> b", "é ́e", "x" * 3000, "日本語　テキスト 12345",
             "İstanbul ΣΑΣ", "w " * 9000, "'s 't 're", "\u0085a b"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "null id")], "doc_id long, text string")
    check_packing(packing.pack(docs, packing.tokenizer_path()).collect(), docs.collect(), packing.SEQUENCE_TOKENS)


def test_ids_of_random_texts():
    """Both routes give the library's ids, for every Latin-1 character too."""
    random.seed(4)
    known = packing._Vocabulary(packing.tokenizer_path())
    pieces = [*map(chr, range(256)), "'s", "'T", "'ll", " the", "é", "É", " ", "\n", "cat", "Dog's", "12", "…", "Σ", "ſ", "²"]
    for i in range(1500):
        text = "".join(random.choices(pieces[:-4] if i % 3 else pieces, k=random.randint(0, 40)))
        want = known.tokenizer.encode(text, add_special_tokens=False).ids
        assert known.ids(text).tolist() == want, repr(text)
    for c in map(chr, range(256)):
        assert known.ids("a" + c + "b").tolist() == known.tokenizer.encode("a" + c + "b", add_special_tokens=False).ids, repr(c)


def test_op11_query(spark, sf_dir):
    rows = packing.op11_best_fit(spark, sf_dir).collect()
    n = check_packing(rows, table(spark, sf_dir, "documents").collect(), packing.SEQUENCE_TOKENS)
    assert n == math.ceil(sum(r.length for r in rows) / packing.SEQUENCE_TOKENS)


# --- operator 12 -----------------------------------------------------------

def brute_divergence(rows, least=3, ranks=200):
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in
                                        re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")])
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t in df if df[t] >= least}
        count = {s: Counter() for _, s, _ in mine}
        for _, s, ts in mine:
            count[s].update(t for t in ts if t in kept)
        whole = sum(count.values(), Counter())
        share = lambda c, t: 1 + (1_000_000_000 * (c[t] + 1)) // (sum(c.values()) + len(kept))
        value = lambda p, q: (p - q) * (p - q) // q
        for s in count:
            pair = [(o, sum(value(share(count[s], t), share(count[o], t)) for t in kept)) for o in count if o != s]
            term = [(t, value(share(count[s], t), share(whole, t))) for t in kept
                    if count[s][t] > 0 and share(count[s], t) > share(whole, t)]
            for part, items, most in (("pair", pair, None), ("term", term, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_terms", [16384, 4])
def test_divergence_brute(spark, block_terms):
    random.seed(12)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Été", "été", "中文", "A", "a", "x9y"]
    rows = [(" ".join(random.choices(words, k=random.randint(0, 40))), random.choice(["en", "de", None]),
             random.choice(["s0", "s1", "s2", "", None])) for _ in range(150)]
    rows += [(None, "xx", "s1"), ("", "xx", "s2"), ("rare words", "yy", "s1"), ("same here", "zz", "s1")] + [("same here", "zz", "s1")] * 3
    df = spark.createDataFrame([(*r, "n") for r in rows], "text string, lang string, source string, n string")
    got = sorted(map(tuple, divergence.audit(df, block_terms=block_terms).collect()))
    assert got == brute_divergence(rows)


def test_divergence_edge_rows(spark, edge, empty, duck):
    rows = edge.collect()
    got = sorted(map(tuple, divergence.audit(edge).collect()))
    assert got == brute_divergence([(r.text, r.lang, r.source) for r in rows])
    assert divergence.audit(empty).collect() == []
    names, want = duck(divergence.ORACLES["op12_divergence"], [tuple(r) for r in rows])
    assert got == sorted(want)


def test_divergence_flushes(spark, edge, monkeypatch):
    batch = edge.select("lang", "source", "text").toArrow().to_batches()
    whole = [r for b in divergence._count(iter(batch)) for r in b.to_pylist()]
    monkeypatch.setattr(divergence, "HELD_COUNTS", 3)
    parts = [r for b in divergence._count(iter(batch)) for r in b.to_pylist()]

    def add(rows):
        out = Counter()
        for r in rows:
            out[(r["lang"], r["source"], r["term"], "n")] += r["n"]
            out[(r["lang"], r["source"], r["term"], "df")] += r["df"]
        return out
    assert len(parts) > len(whole) and add(parts) == add(whole)


def test_forest_shares_and_counts():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.3, (7, 256))
    counts[3] = counts[2]
    counts[:, 250:] = divergence.NO_TERM
    forest = divergence.Forest(counts)
    assert forest.roots[2] == forest.roots[3] and len(forest.children[0]) < 7 * 128 / 4  # equal subtrees are one node
    for a in range(7):
        for b in range(7):
            x, y, times = forest.count_pairs(a, b)
            assert Counter(dict(zip(zip(x.tolist(), y.tolist()), times.tolist()))) == Counter(zip(counts[a].tolist(), counts[b].tolist()))


def test_shares_are_exact():
    for count, total, kept in [(0, 0, 1), (5, 17, 3), (10**13, 10**13 + 7, 10**8), (123456789012, 987654321098765, 12345)]:
        assert divergence.shares(np.array([count]), total, kept)[0] == 1 + (10**9 * (count + 1)) // (total + kept)


# --- operator 13 -----------------------------------------------------------

def brute_codes(rows, rounds=4, entries=256):
    """(vec_id, code, error, label_error), digest for (vec_id, vector, label) rows."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // 4
    ints = [[math.floor(1024 * x) for x in r[1]] for r in kept]
    books = [[v[k * size:(k + 1) * size] for v in ints[:entries]] for k in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for k in range(4):
            groups = defaultdict(list)
            for v in ints:
                groups[nearest(v[k * size:(k + 1) * size], books[k])[1]].append(v[k * size:(k + 1) * size])
            for j, members in groups.items():
                books[k][j] = [sum(c) // len(members) for c in zip(*members)]
    coded = [[nearest(v[k * size:(k + 1) * size], books[k]) for k in range(4)] for v in ints]
    by_label = Counter()
    for r, c in zip(kept, coded):
        by_label[r[2]] += sum(d for d, _ in c)
    as_long = lambda x: x if x < 1 << 63 else None
    by_label = {k: as_long(v) for k, v in by_label.items()}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{j:02x}" for _, j in c), as_long(sum(d for d, _ in c)), by_label[r[2]]) for r, c in zip(kept, coded)),
                  key=str), digest


VECTORS = "vec_id long, embedding array<double>, label int, vector string, code string"


@pytest.mark.parametrize("scale", [0.01, 1.0, 1e6, 1e7])  # the last two leave 64 bits on the way
def test_codes_brute(spark, scale):
    random.seed(13)
    rows = [(random.choice([i, i, 7, None]), [random.gauss(0, scale) for _ in range(8)], random.choice([0, 1, 1, 1, None])) for i in range(330)]
    rows += [(3, rows[0][1], 5)] * 40 + [(4, None, 1), (5, [1.0] * 7 + [None], 1), (6, [1.0] * 7 + [float("nan")], 1),
                                         (8, [float("-inf")] + [0.0] * 7, 1)]
    want, digest = brute_codes(rows)
    df = spark.createDataFrame([(*r, "v", "c") for r in rows], VECTORS).repartition(5)
    got = codes.compress(df).collect()
    assert {r.codebooks_sha256 for r in got} == {digest}
    assert sorted((tuple(r)[:4] for r in got), key=str) == want


def test_codes_few_rows(spark):
    none = spark.createDataFrame([], VECTORS)
    assert codes.compress(none).collect() == []
    one = spark.createDataFrame([(1, [0.5] * 8, None, "", ""), (2, [1.0, 2.0], 1, "", "")], VECTORS)
    assert [tuple(r)[:4] for r in codes.compress(one).collect()] == [(1, "00000000", 0, 0)]
    ragged = spark.createDataFrame([(1, [0.5] * 6, 1, "", ""), (2, [1.0] * 6, 1, "", "")], VECTORS)
    assert [r.code for r in codes.compress(ragged).orderBy("vec_id").collect()] == ["00000000", "01010100"]
    huge = spark.createDataFrame([(1, [1e300] * 4, 1, "", ""), (2, [-1e300] * 4, 1, "", "")] * 200, VECTORS)
    assert codes.compress(huge).where("error is null").count() <= 400


def test_grid_never_drops_the_nearest():
    rng = np.random.default_rng(7)
    book = rng.integers(-300, 300, (40, 5))
    grid = codes.Grid(book, cuts=3, known_cells=50)
    parts = rng.integers(-500, 500, (3000, 5))
    parts[::3] = book[rng.integers(0, 40, 1000)]
    entry, error = grid.nearest(parts)
    apart = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == apart.argmin(axis=1)).all() and (error == apart.min(axis=1)).all()
    assert len(grid.known) <= 50 + codes.BLOCK and min(map(len, grid.known.values())) < 40
