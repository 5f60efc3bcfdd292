"""Duration thresholds, pattern search and statement shapes, against loops."""

import datetime as dt
import math
import random
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from sysledger.operators import workload
from sysledger.plans import scenarios as sc

T0 = dt.datetime(2024, 1, 1)


def owned(spark, rows):
    """rows: (id, db, user, seconds or None)."""
    return spark.createDataFrame(
        [(i, i, db, user, T0 + dt.timedelta(hours=i % 1440), None if s is None else T0 + dt.timedelta(hours=i % 1440, seconds=s)) for i, db, user, s in rows],
        "statementid long, sessionid long, dbname string, username string, starttime timestamp_ntz, endtime timestamp_ntz")


def test_small_groups_have_exact_thresholds(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["x", "y", None]), rng.choice(["a", "b", None]), rng.choice([None, *range(50)])) for i in range(900)]
    df = owned(spark, rows)
    by = ["dbname", "username"]
    limits = workload.duration_thresholds(workload.duration_sketches(df), by, 0.9)
    want = {}
    for db in ("x", "y", None):
        for user in ("a", "b", None):
            d = sorted(s for _, b, u, s in rows if (b, u) == (db, user) and s is not None)
            want[db, user] = (len(d), d[math.ceil(0.9 * len(d)) - 1] * 1_000_000)
    assert {(r.dbname, r.username): (r.n, r.threshold_us) for r in limits.collect()} == want
    got = {r.statementid for r in workload.unusually_long(df, limits, by, 90).collect()}
    assert got == {i for i, b, u, s in rows if s is not None and want[b, u][0] >= 90 and s * 1_000_000 > want[b, u][1]}


def test_merged_sketches_stay_within_the_stated_error(spark):
    """50,000 durations over sixty days of one database: the rank of the
    threshold is off by less than 1.7 / k."""
    rng = random.Random(2)
    seconds = [int(rng.expovariate(0.001)) for _ in range(50_000)]
    sketches = workload.duration_sketches(owned(spark, [(i, "x", f"u{i % 7}", s) for i, s in enumerate(seconds)]))
    assert sketches.count() > 300
    for q in (0.5, 0.9, 0.99):
        limit = workload.duration_thresholds(sketches, ["dbname"], q).first().threshold_us / 1_000_000
        rank = sum(s <= limit for s in seconds) / len(seconds)
        assert abs(rank - q) < 1.7 / workload.SKETCH_SIZE + 0.001, (q, rank)


def like(pattern, text):
    body = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern.lower())
    return re.fullmatch(body, text.lower(), re.DOTALL) is not None


@pytest.mark.parametrize("limit", [None, 0])
def test_patterns_against_a_loop(spark, limit):
    rng = random.Random(3)
    words = ["select", "FROM", "t_x", "été", "drop", "a", "''", "🙂🙂🙂x", "100%", "\n", "insert"]
    texts = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9))) if i % 20 else None) for i in range(400)]
    patterns = [(j, p) for j, p in enumerate(["%select%from%", "%t_x%", "%DROP%a", "%été%", "a%", "%🙂x%", "_rop%", "%'%", "%a_a%", "insert", "%zzz%", "drop a", ""])]
    patterns = [(j, p) for j, p in patterns if p] + [(100 + j, f"%select%{j}%") for j in range(300)] + [(500, None)]
    got = workload.match_patterns(spark.createDataFrame(texts, "id long, s string"), "s", "id",
                                  spark.createDataFrame(patterns, "pattern_id long, pattern string"), max_broadcast_bytes=limit)
    want = sorted((i, j) for i, x in texts if x is not None for j, p in patterns if p and like(p, x))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_pattern_edges(spark):
    texts = spark.createDataFrame([(1, "abc" * 40_000), (2, "")], "id long, s string")
    none = spark.createDataFrame([], "pattern_id long, pattern string")
    assert workload.match_patterns(texts, "s", "id", none).collect() == []
    with pytest.raises(Exception, match="needs a literal"):
        workload.match_patterns(texts, "s", "id", spark.createDataFrame([(1, "%_%")], "pattern_id long, pattern string")).collect()
    one = spark.createDataFrame([(1, "%cab%"), (2, "%cab%"), (3, "%acb%")], "pattern_id long, pattern string")
    assert sorted(map(tuple, workload.match_patterns(texts, "s", "id", one).collect())) == [(1, 1), (1, 2)]


@pytest.mark.parametrize("form", ["%FROM sales where id = {} and%", "update%-- done {}", "%id={}%", "%x{}y%z%"])
def test_a_family_of_patterns_is_told_apart(spark, form):
    """Patterns that differ in a number: no text has to be compared with more
    than a few of them."""
    patterns = spark.createDataFrame([(k, form.format(k)) for k in range(20_000, 22_000)], "pattern_id long, pattern string")
    anchors = workload.pattern_anchors(patterns)
    assert anchors.select("pattern_id").distinct().count() == 2000
    assert max(r["count"] for r in anchors.groupBy("anchor").count().collect()) <= 20


@pytest.mark.parametrize("limit", [None, 0])
def test_words_beside_wildcards(spark, limit):
    """A word is an anchor only where a text must have it as a word; patterns
    that come twice or without an id are rows like any other."""
    texts = [(1, "drop table t1"), (2, "dropped table t12"), (3, "x_drop table"), (4, "50% drop table"), (None, "drop table t1"), (6, "été table"), (7, "étéx table")]
    patterns = [(1, "drop%"), (2, "drop table %"), (3, "%drop table%"), (4, "%t1"), (5, "% t_"), (6, r"50\% drop%"), (7, r"x\_drop table"), (8, "été %"),
                (9, "_té% table"), (9, "_té% table"), (None, "% table"), (None, "% t1")]
    got = workload.match_patterns(spark.createDataFrame(texts, "id long, s string"), "s", "id",
                                  spark.createDataFrame(patterns, "pattern_id long, pattern string"), max_broadcast_bytes=limit)
    want = [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1), (3, 3), (3, 7), (4, 3), (4, 6), (6, 8), (6, 9), (7, 9), (None, 1), (None, 2), (None, 3),
            (None, 4), (None, 5), (1, None), (None, None), (3, None), (4, None), (6, None), (7, None)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("text, shape", [
    ("SELECT a FROM t WHERE id = 17 and v > 1.5e3", "select a from t where id = ? and v > ?"),
    ("select a\n\tfrom t where id=18 and v>2 -- why", "select a from t where id = ? and v > ?"),
    ("insert into t values (1, 'it''s', 3)", "insert into t values ( ? )"),
    ("insert into t values ('--', '/*') /* it's */", "insert into t values ( ? )"),
    ("select /* ' */ 1 -- '", "select ?"),
    ("select t1.c2 from \"My 'T\" x", "select t1 . c2 from \"My 'T\" x"),
    ("select 'open", "select ?"),
    ("select 1 /* open", "select ?"),
    ("select - 5 - -6 / 2", "select - ? - - ? / ?"),
    ("", ""),
])
def test_shapes(spark, text, shape):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(workload.statement_shape(F.col("s")).alias("x")).first().x == shape


def test_shape_of_a_long_statement(spark):
    values = ", ".join(f"('{'x' * 50}''{i}', {i})" for i in range(20_000))
    df = spark.createDataFrame([(f"insert into t values {values} /* {'* ' * 100_000}*/",)], "s string")
    got = df.select(workload.statement_shape(F.col("s")).alias("x")).first().x
    assert got.startswith("insert into t values ( ? ) , ( ? )")


def test_shape_report_keeps_the_first_places(spark):
    rows = sc.q_statement_shapes(spark, SF_SMALL).collect()
    for group in {(r.all_databases, r.dbname) for r in rows}:
        mine = sorted((r.place, -r.total_us) for r in rows if (r.all_databases, r.dbname) == group)
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1)) and [d for _, d in mine] == sorted(d for _, d in mine)
    assert {r.all_databases for r in rows} == {True, False}
