"""Passages in very many documents: no bucket takes all pieces of a minimiser."""
import random
from collections import Counter

import numpy as np
import pytest
from test_llm_dedup import brute, key

from orderlens.llm import kmers, packs, simhash, suffixes
from orderlens.llm.common import row_tag


def passage_df(spark, documents=600):
    """A passage in a third of all documents, between words of each one's own."""
    random.seed(11)
    passage = " ".join(f"p{i}q" for i in range(40))
    own = lambda: " ".join(random.choice("abcdefgh") + str(random.randint(0, 9999)) for _ in range(30))
    docs = [(i, f"{own()} {passage} {own()}" if i % 3 == 0 else own()) for i in range(documents)]
    return spark.createDataFrame(docs + docs[:3] + [(None, None), (None, passage)], "doc_id long, text string").repartition(3)


def largest_bucket(sent, size_at):
    """Bytes of text in the fullest bucket."""
    held = Counter()
    for r in sent.collect():
        held[r.bucket] += len(packs.unpack(r.payload)[size_at])
    return max(held.values())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(packs, "HOT_BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(kmers, "BUCKET_BYTES", 2000)


def bytes_match(df, out):
    want = brute(df, 40, lambda b: list(b))
    rows = []
    for r in df.collect():
        units, gone = want[key(r.doc_id, r.text)]
        rows.append(str((r.doc_id, len(units), sum(gone), bytes(u for u, g in zip(units, gone) if not g))))
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept))) for r in out.collect()) == sorted(rows)


def test_suffix_arrays_hot_minimiser(spark, small):
    for documents in (600, 1800):
        df = passage_df(spark, documents)
        whole, dealt = (largest_bucket(suffixes.sent_packs(df, row_tag(df), 40, 8, 200000, 100000, hot), 5)
                        for hot in (10 ** 9, 30))
        print(documents, whole, dealt)
        # undivided, the bucket grows with the documents
        assert whole > 20 * documents and dealt < 8000
    bytes_match(df, suffixes.dedup_bytes(df, 40, 8, 200000, 100000, with_bytes=True, hot_pieces=30))


def test_hot_windows_leave_a_shard_in_parts(spark, small, monkeypatch):
    monkeypatch.setattr(packs, "HELD_BYTES", 5000)
    df = passage_df(spark, 90)
    bytes_match(df, suffixes.dedup_bytes(df, 40, 8, 20000, 8000, with_bytes=True, hot_pieces=2))


def test_super_kmers_hot_minimiser(spark, small):
    for documents in (600, 1800):
        df = passage_df(spark, documents)
        whole, dealt = (largest_bucket(kmers.sent_packs(df, row_tag(df), 8, 2, 200000, hot), 4) for hot in (10 ** 9, 30))
        print(documents, whole, dealt)
        # undivided, the bucket grows with the documents
        assert whole > 12 * documents and dealt < 8000
    want = brute(df, 8, bytes.split)
    rows = []
    for r in df.collect():
        units, gone = want[key(r.doc_id, r.text)]
        rows.append(str((r.doc_id, len(units), sum(gone), b" ".join(u for u, g in zip(units, gone) if not g).decode())))
    for hot in (2, 30):
        got = kmers.dedup_windows(df, 8, 2, 200000, with_text=True, hot_pieces=hot).collect()
        assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in got) == sorted(rows)


def test_own_intervals_spread_over_the_buckets(spark):
    """What shards find in themselves does not all go to one bucket."""
    random.seed(5)
    half = [" ".join(random.choice("abcdefgh") + str(random.randint(0, 9999)) for _ in range(20)) for _ in range(300)]
    df = spark.createDataFrame([(i, f"{t} {t}") for i, t in enumerate(half)], "doc_id long, text string").repartition(6)
    held = Counter()
    for r in suffixes.sent_packs(df, row_tag(df), 40, 8, 4000, 4000, 10 ** 9).collect():
        held[r.bucket] += len(packs.unpack(r.payload)[6])
    assert sum(held.values()) >= 300
    buckets = packs.bucket_count(df, suffixes.BUCKET_BYTES)
    assert packs.bucket_of_shard(np.array([1]), np.array([0]), 97) == packs.bucket_of_shard(np.array([1]), np.array([0]), 97)
    firsts = {packs.bucket_of_shard(np.array([i]), np.array([0]), 97) for i in range(2000)}
    assert len(firsts) == 97 and buckets >= 1


def test_own_intervals_of_many_shards(spark, small):
    random.seed(6)
    half = [" ".join(random.choice("abcdefgh") + str(random.randint(0, 9999)) for _ in range(20)) for _ in range(300)]
    df = spark.createDataFrame([(i, f"{t} {t}") for i, t in enumerate(half)], "doc_id long, text string").repartition(6)
    held = Counter()
    for r in suffixes.sent_packs(df, row_tag(df), 40, 8, 4000, 4000, 10 ** 9).collect():
        held[r.bucket] += len(packs.unpack(r.payload)[6])
    assert sum(v > 0 for v in held.values()) > 10 and max(held.values()) < sum(held.values()) / 4
    bytes_match(df, suffixes.dedup_bytes(df, 40, 8, 4000, 4000, with_bytes=True))


def test_minimisers_spread_thin_are_found(spark, monkeypatch):
    """One piece a stretch, in very many stretches, still counts."""
    monkeypatch.setattr(packs, "COUNT_BYTES", 1)
    monkeypatch.setattr(packs, "PART_BYTES", 1)
    random.seed(3)
    rare = [" ".join(f"{random.choice('abcdefgh')}{random.randint(0, 10 ** 6)}" for _ in range(12)) for _ in range(3000)]
    texts = [f"{t} same words here" if i % 3 == 0 else t for i, t in enumerate(rare)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)

    def one_piece(texts):
        for t in texts:
            value = 7 if t.endswith(b"same words here") else hash(t) & 0xFFFFFFFF | 8
            yield (np.array([value], np.uint64), np.array([hash(t) & 0xFFFFFFFF], np.uint64), np.array([1], np.int64))

    hot, buckets = packs.hot_minimisers(df, one_piece, 100, 500)
    assert hot.value.tolist() == [7] and buckets == 1


def test_hot_minimisers_are_bounded(spark, monkeypatch):
    """The limit rises with all pieces, so the list cannot outgrow its bound; the
    result stays the same."""
    monkeypatch.setattr(packs, "MOST_HOT", 5)
    df = passage_df(spark, 90)
    hot, _ = packs.hot_minimisers(df, suffixes._pieces_of(40, 8, 8000), 40, 2)
    assert len(hot.value) <= 5
    bytes_match(df, suffixes.dedup_bytes(df, 40, 8, 20000, 8000, with_bytes=True, hot_pieces=2))


def test_simhash_key_rows_are_never_broadcast(spark):
    """A fingerprint makes hundreds of key rows, whatever the estimate says."""
    df = spark.createDataFrame([(i,) for i in range(50)], "fp long")
    plan = simhash.links(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
