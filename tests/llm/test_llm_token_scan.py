from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from corpus_cases import documents, edge_docs, edge_rows, empty_docs

from sysledger.llm import token_scan
from sysledger.llm.common import scratch
from sysledger.llm.token_scan import _encoding, _fixed, _ids, scan, token_counts, write_tokens

RANKS, PATTERN, END = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256


def lengths(texts):
    with open(RANKS, "rb") as f:
        encoding = _encoding(f.read(), PATTERN)
    return Counter(len(encoding.encode_ordinary(t or "")) for t in texts)


def test_counts_of_documents(spark):
    docs = documents(spark)
    rows = token_counts(docs, RANKS, PATTERN, END).collect()
    assert Counter(r.n_tokens for r in rows) == lengths(r.text for r in docs.collect())
    assert all(r.terminated for r in rows)


def test_edges(spark):
    rows = token_counts(edge_docs(spark), RANKS, PATTERN, END).collect()
    assert Counter(r.n_tokens for r in rows) == lengths(r[1] for r in edge_rows())
    assert token_counts(empty_docs(spark), RANKS, PATTERN, END).collect() == []


def write(folder, name, ids, tail=b""):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(np.array(ids, dtype="<u2").tobytes() + tail)


def test_foreign_files_over_block_borders(spark, monkeypatch):
    """Files from elsewhere: unaligned look-alikes of the separator, empty
    documents, an open end, an odd byte; blocks from one id to a whole file."""
    rng = np.random.default_rng(4)
    folder = scratch(spark, "foreign")
    folder = folder.removeprefix("file:")
    files = {}
    for name in ("a", "b", "c"):
        ids = rng.integers(0, 50256, 3000)
        ids[rng.random(3000) < 0.02] = END
        ids[100:110] = [0x50C4, 0xC450 ^ 0xFFFF, 0x50C4, 0x50C4, END, END, END, 0xC4, 0x50, 0x5050]
        files[name] = ids
    files["c"][-1] = END
    for name, ids in files.items():
        write(folder, name, ids, b"\x01" if name == "b" else b"")
    write(folder, "empty", [])
    write(folder, "none", [1, 2, 3])
    files["none"] = np.array([1, 2, 3])
    want = set()
    for name, ids in files.items():
        start = 0
        ends = list(np.flatnonzero(ids == END))
        for i, e in enumerate([*ends, len(ids)] if len(ids) > (ends[-1] + 1 if ends else 0) else ends):
            want.add((name, i, start, int(e) - start, i < len(ends)))
            start = int(e) + 1
    for block in (7, 64, 1000, 1 << 20):
        got = {tuple(r) for r in scan(spark, folder, END, block_bytes=block).collect()}
        assert got == want
    monkeypatch.setattr(token_scan, "_readable", lambda path: False)  # by Spark's own reader
    for block in (64, 1 << 20):
        assert {tuple(r) for r in scan(spark, folder, END, block_bytes=block).collect()} == want


def test_stores_that_pyarrow_does_not_know_are_left_to_spark():
    assert token_scan._readable("file:///tmp/x") and not token_scan._readable("viewfs://cluster/x")


def test_wide_ids(spark):
    ids = np.array([0, 255, 65_536, 199_999, (1 << 24) - 1])
    for width in (3, 4, 8):
        assert (_ids(_fixed(ids, width), width) == ids).all() and len(_fixed(ids, width)) == 5 * width
    with pytest.raises(OverflowError, match="does not fit 2 bytes"):
        _fixed(ids, 2)
    docs = documents(spark)
    for width in (3, 4):
        folder = f"{scratch(spark, 'wide')}/tokens"
        write_tokens(docs, folder, RANKS, PATTERN, 100_257, width)
        rows = scan(spark, folder, 100_257, "part-*", block_bytes=1000, width=width).collect()
        assert Counter(r.n_tokens for r in rows) == lengths(r.text for r in docs.collect()) and all(r.terminated for r in rows)
