import random

import numpy as np
import pytest
from corpus_cases import components, documents, edge_docs, edge_rows, empty_docs, shingles
from hypothesis import given, settings
from hypothesis import strategies as st

from sysledger.llm import parity_join
from sysledger.llm.parity_join import Bands, drop_near_copies, jaccard_components, keys_of, shingle_set


def check(spark, docs, percent, width):
    rows = docs.select("doc_id", "text").collect()
    sets = {r.doc_id: shingles(r.text, width) for r in rows if r.doc_id is not None}
    want = components(sets, percent)
    got = jaccard_components(docs, percent, width).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.doc_id, r.n_shingles, r.component_id) == (r.doc_id, len(sets[r.doc_id]), want[r.doc_id])
    return got


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abC \t\né  ")), max_size=60), st.integers(1, 5))
def test_set_sizes(text, width):
    assert len(shingle_set(text, width)) == len(shingles(text, width))


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_pairs_share_a_key(percent):
    # sets at and just above the threshold, of all small sizes and some large
    rng = np.random.default_rng(percent)
    bands = Bands(percent)
    for n in [*range(1, 60), 100, 150, 400, 1000]:
        for _ in range(15):
            base = np.unique(rng.integers(0, 1 << 63, n + 400).astype(np.uint64))
            a = base[:n]
            drop = int(rng.integers(0, n // 4 + 1))
            add = int(rng.integers(0, n // 4 + 1))
            b = np.unique(np.concatenate([a[drop:], base[n:n + add]]))
            if len(b) and 100 * (n - drop) >= percent * (n + add):
                assert len(np.intersect1d(keys_of(np.sort(a), bands), keys_of(b, bands)))


def test_documents_match_brute_force(spark):
    check(spark, documents(spark), 90, 3)


def test_documents_at_the_default_similarity(spark):
    check(spark, documents(spark), 80, 5)


def near_group(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("task_bucket", [1000, 6])
def test_large_group_of_unlike_copies(spark, monkeypatch, task_bucket):
    """Copies with more and fewer edits than the threshold allows: some are
    linked through others, many are not linked at all."""
    monkeypatch.setattr(parity_join, "TASK_BUCKET", task_bucket)
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    texts = near_group(rng, base, 130, 14) + near_group(rng, base[:100], 40, 9) + near_group(rng, [f"v{i}" for i in range(30)], 30, 3)
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i % 7]) for i in range(60)]
    got = check(spark, spark.createDataFrame(rows, "doc_id long, text string"), 90, 3)
    assert len({r.component_id for r in got}) > 20


def test_family_of_two_wordings_at_many_places(spark, monkeypatch):
    """One template with 25 places of two wordings each: hardly a pair is
    linked, and every element is had by half of the family."""
    monkeypatch.setattr(parity_join, "TASK_BUCKET", 10)
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = [f"w{i}" for i in range(400)]
        for place in range(25):
            words[16 * place + 3] = f"{'ab'[rng.randrange(2)]}{place}"
        texts.append(" ".join(words))
    near = texts[7].split(" ")  # one more, linked with the eighth
    near[8] = "other"
    rows = [(i, t) for i, t in enumerate([*texts, " ".join(near)])]
    got = {r.doc_id: r.component_id for r in check(spark, spark.createDataFrame(rows, "doc_id long, text string"), 90, 3)}
    assert got[60] == got[7] and len(set(got.values())) > 20


def test_edges(spark):
    check(spark, edge_docs(spark), 90, 3)
    assert jaccard_components(empty_docs(spark)).collect() == []
    assert len(edge_rows()) == edge_docs(spark).count()


def test_drop_near_copies(spark):
    docs = documents(spark)
    sets = {r.doc_id: shingles(r.text, 5) for r in docs.collect()}
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(components(sets, 80).values())


@pytest.mark.parametrize("percent, rows", [(80, 1000), (80, 10**10), (90, 10**6)])
def test_linked_pairs_share_a_key_at_every_table_size(percent, rows):
    """Pairs that differ in exactly the most they may, where no key is to spare."""
    rng = np.random.default_rng(rows % 997)
    bands, need = Bands(percent), parity_join.bits_needed(rows)
    for n in [*range(2, 40), 60, 111, 300, 900]:
        for _ in range(20):
            base = np.unique(rng.integers(0, 1 << 63, 3 * n + 9).astype(np.uint64))
            rng.shuffle(base)
            most = 2 * n * (100 - percent) // (100 + percent)
            drop = int(rng.integers(0, most + 1))
            a, b = base[:n], base[drop:n]
            add = 0
            while 100 * (n - drop) >= percent * (n + add + 1):
                add += 1
            b = np.concatenate([b, base[n:n + add]])
            if len(b) and 100 * (n - drop) >= percent * (n + add):
                assert len(np.intersect1d(keys_of(np.sort(a), bands, need), keys_of(np.sort(b), bands, need))), (n, drop, add)


def test_shared_keys_grow_with_the_rows_not_with_their_square():
    """Unrelated sets meet by chance in few keys, at every number of them."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, int(rng.integers(20, 600))).astype(np.uint64)) for _ in range(4000)]
    bands = Bands(80)
    shared, emitted = {}, {}
    for n in (1000, 2000, 4000):
        keys = [np.unique(keys_of(s, bands, parity_join.bits_needed(n))) for s in sets[:n]]
        every = np.concatenate(keys)
        _, counts = np.unique(every, return_counts=True)
        shared[n], emitted[n] = int(counts[counts > 1].sum()), len(every)
    assert emitted[4000] < 0.9 * sum(map(len, sets))
    assert shared[4000] < 0.1 * 4000 and shared[4000] < 4 * max(shared[2000], 40) < 16 * max(shared[1000], 40)


def test_key_filter_lets_few_other_keys_pass(spark, monkeypatch):
    """All keys pass, and of others the square of the filter's share of set bits."""
    monkeypatch.setattr(parity_join, "FILTER_BITS", 1 << 20)
    rng = np.random.default_rng(3)
    keys, others = rng.integers(0, 1 << 40, 5_000), rng.integers(0, 1 << 40, 200_000)
    bits = np.frombuffer(parity_join._key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long")), dtype=np.uint8)
    assert len(bits) == (1 << 20) // 8 and parity_join._hits(bits, keys).all()
    assert parity_join._hits(bits, others).sum() < 100  # one bit a key: about 950


def test_large_buckets_lose_members_that_nothing_is_like(spark, tmp_path, monkeypatch):
    """Documents that share a passage alone leave its bucket, near copies among
    them stay; a group beyond TASK_BUCKET stays whole."""
    rng = np.random.default_rng(5)
    texts = [" ".join(["a passage that all of them use"] + [f"w{i}" for i in rng.integers(0, 10**9, 150)]) for _ in range(40)]
    texts += [texts[7] + " one", texts[11] + " two"]
    sets = [parity_join.shingle_set(t, 3) for t in texts]
    short = spark.createDataFrame([(i, len(s), parity_join._short_sketch(s).tolist()) for i, s in enumerate(sets)], "node long, n long, sketch array<long>")
    buckets = spark.createDataFrame([(i, 99) for i in range(len(sets))], "node long, key long")
    left = {tuple(r) for r in parity_join._with_partners(buckets, short, 80, str(tmp_path / "a")).collect()}
    assert left == {(i, 99) for i in (7, 11, 40, 41)}
    monkeypatch.setattr(parity_join, "TASK_BUCKET", 6)
    assert parity_join._with_partners(buckets, short, 80, str(tmp_path / "b")).count() == len(sets)


def test_wide_sketches_tell_long_sets_apart(spark, tmp_path):
    """Pairs of long unlike sets go before their sets are shipped; links stay."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, 3_000).astype(np.uint64)) for _ in range(3)]
    sets.append(sets[0][50:])
    kept = spark.createDataFrame([(i, len(s), parity_join._short_sketch(s, parity_join.WIDE_SKETCH).tolist(), s.tobytes()) for i, s in enumerate(sets)],
                                 "node long, n long, sketch array<long>, shingles binary")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (1, 2), (1, 3)], "a long, b long")
    links = parity_join._links(pairs, kept, 80, str(tmp_path))
    assert {tuple(r) for r in links.collect()} == {(0, 3)}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "near-pairs")).collect()} == {(0, 3)}
