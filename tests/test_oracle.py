"""Every registered query equals its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_check import digest

import __spark_entry__ as E
from sysledger.plans.scenarios import QUERIES

NAMES = sorted(QUERIES)  # the corpus operators have their own tests


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    hs, cs, _ = digest(df.columns, srows)
    hd, cd, _ = digest(dcols, drows)
    assert cs == cd
    assert len(srows) == len(drows)
    assert hs == hd


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["statementid", "xactionid", "sessionid", "retrynum", "statement", "starttime", "endtime",
                          "iscancelable"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "date": "DATE"}


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("job_") and n not in ("compact", "export_text")])
def test_column_types_match_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute("describe " + E.oracle_sql()[name]).fetchall()}
    assert spark_types == duck_types


@pytest.mark.parametrize("absent", ["ahocorasick", "public_tokenizers", "sysledger.llm", "corpus_pipeline"])
def test_the_rest_is_registered_without_the_corpus_part(absent):
    """In a fresh interpreter where one of its imports fails."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as E; print(len(E.queries()), bool(E.CORPUS_MISSING), 'pipeline' in E.queries())"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[1], check=True).stdout.split()
    assert out == [str(len(QUERIES)), "True", "False"]
