import math
from collections import Counter

from corpus_cases import WORD, documents, edge_docs, edge_rows, empty_docs, labels
from pyspark.sql import functions as F

from sysledger.llm.risk_rules import STEPS, binomial_tail, cutoffs, judge


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def digest(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_statistics_match_brute_force(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    rows = judge(documents(spark), labels(spark)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert digest(r) == expected(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_edges(spark):
    rows = judge(edge_docs(spark), labels(spark)).collect()
    assert Counter((r.doc_id, *digest(r)) for r in rows) == Counter((r[0], *expected(r[1])) for r in edge_rows())
    assert judge(empty_docs(spark), labels(spark)).collect() == []
    none = judge(edge_docs(spark), labels(spark).limit(0)).collect()
    assert all(r.kept != r.base_failed and r.symbols_cutoff is None for r in none)


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, p) for n in (1, 10, 200, 5000) for k in (0, 1, 5, 40) if k < n for p in (0.001, 0.01, 0.2)]
    for n, k, p in cases:
        got = spark.range(1).select(binomial_tail(F.lit(n), F.lit(k), p)).first()[0]
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
                   for i in range(k + 1))
        assert math.isclose(got, want, rel_tol=1e-7)


def test_cutoffs_keep_the_promise(spark):
    # 6000 good rows of stratum a with scores 0.00 to 0.59, 50 of stratum b
    good = spark.range(6050).select(
        F.when(F.col("id") < 6000, "a").otherwise("b").alias("stratum"), ((F.col("id") % 6000) / 10_000).alias("symbols"),
        F.lit(0.0).alias("lines"), F.lit(0.0).alias("repeats"))
    risk, error = 0.01, 0.05
    found = {r.stratum: r for r in cutoffs(good, risk, error).collect()}
    assert "b" not in found  # 50 rows can prove nothing about one in a hundred

    def tail(n, k):
        return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk) + (n - i) * math.log1p(-risk))
                   for i in range(k + 1))

    want = None
    for step in range(STEPS - 1, -1, -1):
        k = sum(i / 10_000 > step / STEPS for i in range(6000))
        if k > 6000 * risk or tail(6000, k) > error / 6:
            break
        want = step / STEPS
    assert found["a"].symbols_cutoff == want
    assert found["a"].lines_cutoff == 0.0


def test_planted_bad_documents_go_in_small_strata(spark):
    """Too few labels in b, c and d (each 250 good ones at a risk of 0.01),
    but enough of them together; e has none."""
    rows, marks = [], []
    for lang, good in (("a", 700), ("b", 250), ("c", 250), ("d", 250), ("e", 20)):
        for i in range(good + 10):
            bad = i >= good
            rows.append((len(rows), " ".join(f"{lang}{i}x{j}" + ("##&&##&&" if bad else "") for j in range(12)), lang))
            if lang != "e":
                marks.append((len(rows) - 1, 0 if bad else 1))
    docs, marked = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in judge(docs, marked, risk=0.01).collect()}
    assert all(kept[i] == (q == 1) for i, q in marks)
    assert all(kept[i] for i, _, lang in rows if lang == "e")


def test_the_gain_decides_among_safe_cutoffs(spark):
    """2000 good rows up to 0.15, 400 bad ones from 0.2 to 0.6: the highest
    cutoff that all bad ones exceed loses no good one."""
    scores = "cast(0 as double) as lines, cast(0 as double) as repeats"
    good = spark.range(2000).selectExpr("'a' as stratum", "(id % 16) / 100 as symbols", scores.split(", ")[0], scores.split(", ")[1])
    bad = spark.range(400).selectExpr("'a' as stratum", "0.2 + id / 1000 as symbols", "cast(0 as double) as lines", "cast(0 as double) as repeats")
    assert cutoffs(good, 0.02, 0.05, bad).first().symbols_cutoff == 0.19
    # one good row in sixteen has 0.15: more than the risk, so nothing below is safe
    assert cutoffs(good, 0.02, 0.05).first().symbols_cutoff == 0.15
    assert cutoffs(good, 0.02, 0.05, bad.limit(0)).first().symbols_cutoff == 0.99  # nothing to gain


def test_production_parameters_reject_bad_documents(spark):
    """On the given table of a thousand documents."""
    sf = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = judge(docs, marks).join(marks, "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert len(good) - sum(good) <= 0.02 * len(good)
    assert sum(bad) <= 0.5 * len(bad), (sum(bad), len(bad))
