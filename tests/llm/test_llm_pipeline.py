import corpus_pipeline
import __spark_entry__ as E
from corpus_cases import SF, components, shingles


def test_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14))
    assert E.queries()["pipeline"] is corpus_pipeline.run


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema) if name == "bpe" else stage(spark, docs, SF).cache()
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= seen
        if name != "bpe":
            assert docs.columns == columns
        if name == "exact dedup":
            norms = {" ".join(t.split()) for t in before.values()}
            assert len({" ".join(before[i].split()) for i in ids}) == len(norms)
        if name == "n-gram jaccard join":
            assert ids == set(components({i: shingles(t, 5) for i, t in before.items()}, 80).values())
        if name in ("source mix", "bpe"):
            assert ids == seen
        seen = ids


def test_run_equals_brute_force(spark):
    """run() on the smallest tables against the stages by other means: the
    classifier's verdicts as a set, plain loops for copies and near copies, the
    mix's own passes, and the library's tokens."""
    import hashlib
    import re
    from collections import Counter

    from tokenizers import Tokenizer

    from sysledger.llm import ordinal_quality, temperature_mix
    from sysledger.llm.queries import WORD_BPE

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = ordinal_quality.fit(docs, ordinal_quality.graded(spark.read.parquet(f"{SF}/labels.parquet")))
    kept = {r.doc_id for r in ordinal_quality.score(docs, model).collect() if r.kept}
    first = {}
    for r in sorted((r for r in docs.collect() if r.doc_id in kept), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    left = {r.doc_id: r.text for r in first.values()}
    heads = {i for i, root in components({i: shingles(t, 5) for i, t in left.items()}, 80).items() if i == root}
    passes = Counter(r.doc_id for r in temperature_mix.mix(docs.where(docs.doc_id.isin(list(heads))), max_repeats=2.0).collect())
    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    want = Counter()
    for i, n in passes.items():
        ids = library.encode(left[i], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] = n
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == want and len(want) > 50
