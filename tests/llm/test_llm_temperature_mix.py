import math
from collections import Counter, defaultdict

import pytest
from corpus_cases import documents, edge_docs, edge_rows, empty_docs

from pyspark.sql import functions as F

from sysledger.llm.temperature_mix import block_of, draw_of, mix, plan, repeat_rows


def uneven(spark):
    """Four sources of 3000, 300, 100 and 40 documents of ten words."""
    return spark.range(3440).selectExpr(
        "id as doc_id", "'a b c d e f g h i j' as text",
        "case when id < 3000 then 'big' when id < 3300 then 'mid' when id < 3400 then 'low' else 'tiny' end as source")


def test_repetition_limit_and_budget(spark):
    rows = mix(uneven(spark), max_repeats=3.0, budget_tokens=30_000, block_tokens=100).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.n_tokens
    weights = {r.source: r.weight for r in rows}
    assert math.isclose(sum(weights.values()), 1, rel_tol=1e-9)
    repeats = {s: weights[s] * 30_000 / n for s, n in (("big", 30_000), ("mid", 3000), ("low", 1000), ("tiny", 400))}
    assert math.isclose(max(repeats.values()), 3.0, rel_tol=1e-6)
    for s, w in weights.items():
        quota = w * 30_000
        assert quota - 300 <= tokens[s] <= quota + 1e-6  # short by less than a block or two, never over
    assert sum(tokens.values()) <= 30_000
    assert all(0 <= r.place < 1 for r in rows)


def test_entropy_target(spark):
    rows = mix(uneven(spark), max_repeats=None, target_entropy=1.0, budget_tokens=10_000, block_tokens=100).collect()
    weights = {r.source: r.weight for r in rows}
    assert math.isclose(-sum(w * math.log(w) for w in weights.values()), 1.0, abs_tol=1e-5)


def test_epochs_are_whole_before_the_last(spark):
    rows = mix(uneven(spark), max_repeats=3.0, block_tokens=50).collect()
    epochs = defaultdict(set)
    for r in rows:
        epochs[r.doc_id].add(r.epoch)
    assert len(epochs) == 3440  # the least budget that covers every source
    assert all(e == set(range(len(e))) for e in epochs.values())
    assert max(len(e) for e in epochs.values()) <= 3


def test_any_start_of_the_mix_has_the_weights(spark):
    rows = sorted(mix(uneven(spark), max_repeats=3.0, block_tokens=50).collect(), key=lambda r: r.place)
    half = Counter(r.source for r in rows[: len(rows) // 2])
    whole = Counter(r.source for r in rows)
    for s in whole:
        assert abs(half[s] / whole[s] - 0.5) < 0.25


def test_small_sources_meet_their_quota_with_production_parameters(spark):
    docs = spark.range(2800).selectExpr(
        "id as doc_id", "repeat('a b c d e ', 10 + cast(id % 7 as int)) as text",
        "case when id < 1000 then 'a' when id < 1900 then 'b' else concat('c', id % 2) end as source")
    _, sources = plan(docs, max_repeats=2.0)
    quota = {r.src.name: (r.quota, r.source_tokens) for r in sources.collect()}
    tokens = Counter()
    for r in mix(docs, max_repeats=2.0).collect():
        tokens[r.source] += r.n_tokens
    assert max(q / n for q, n in quota.values()) > 1.5
    for s, (q, n) in quota.items():
        assert q - 0.02 * n <= tokens[s] <= q + 1e-6


def test_impossible_budget(spark):
    with pytest.raises(ValueError):
        plan(uneven(spark), max_repeats=2.0, budget_tokens=100_000)


def test_documents_and_edges(spark):
    docs = documents(spark)
    left = repeat_rows(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()}
    rows = repeat_rows(edge_docs(spark)).collect()
    assert {(r.doc_id, r.text) for r in rows} == {(r[0], r[1]) for r in edge_rows()}
    assert mix(empty_docs(spark)).collect() == []
    assert repeat_rows(empty_docs(spark)).collect() == []


def test_passes_match_a_recomputation(spark):
    """Weights from the exponent, whole epochs, and the last one's blocks summed
    one after the other in a plain loop, on the given documents."""
    docs = documents(spark)
    sized, sources = plan(docs, max_repeats=2.0, block_tokens=400)
    info = {r.src.name: r for r in sources.collect()}
    total = sum(r.source_tokens for r in info.values())
    a = next(iter(info.values())).exponent
    z = sum((r.source_tokens / total) ** a for r in info.values())
    rows = sized.join(sources, "src").withColumn("block", block_of()).select(
        "doc_id", F.col("src.name").alias("source"), "tokens", "block", draw_of(F.col("epochs")).alias("u")).collect()
    want = Counter()
    for name, r in info.items():
        assert math.isclose(r.weight, (r.source_tokens / total) ** a / z, rel_tol=1e-9)
        mine = [x for x in rows if x.source == name]
        assert r.source_tokens == sum(len((d.text or "").split()) for d in docs.where(F.col("source") == name).collect())
        assert r.epochs == math.floor(r.quota / r.source_tokens + 1e-9)
        size, draw = Counter(), {}
        for x in mine:
            size[x.block] += x.tokens
            draw[x.block] = x.u
        upto, taken = 0, set()
        for block in sorted(size, key=lambda b: (draw[b], b)):
            upto += size[block]
            if upto > r.quota - r.epochs * r.source_tokens:
                break
            taken.add(block)
        for x in mine:
            for epoch in range(r.epochs + (x.block in taken)):
                want[x.doc_id, epoch] += 1
    got = Counter((r.doc_id, r.epoch) for r in mix(docs, max_repeats=2.0, block_tokens=400).collect())
    assert got == want
