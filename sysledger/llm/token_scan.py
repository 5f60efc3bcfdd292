"""Token counts by scanning flat token files for end-of-document ids.

A token file is nothing but fixed-width little-endian ids, documents one after
another, each ended by one id. There is no index: where documents begin is
only known by looking. The files are cut into blocks without regard to
documents; a task reads one block and finds all separators in one vectorised
comparison, aligned to the id width. What a block cannot know, the document
that began before it, comes from a prefix scan over the blocks of a file: the
last separator before the block (running maximum) and the number of documents
before it (running sum). The scan goes over runs of bounded length and then
over the runs' totals, so a file of any size is no single task's work.

Reading is by byte range through the file system of the path, so a large file
is shared by many tasks and a lost task reads its block again. Listing takes
paths and lengths only. Paths of stores that pyarrow does not know are read by
Spark itself, with its own credentials, a file at a time: there a file must fit
a task's memory (and 2 GB).

Defined cases: an empty file has no documents; tokens after the last separator
are a document that is not ``terminated``; two separators in a row hold an
empty document; bytes beyond the last whole id are ignored. ``write_tokens``
writes a null or empty text as an empty document and ignores other columns; an
id that does not fit ``width`` bytes ends the job with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, scratch

WIDTH = 2  # bytes of an id, where nothing else is said
BLOCK_BYTES = 1 << 20
BLOCKS_PER_RUN = 4096

_ENCODINGS: dict[str, object] = {}


def _encoding(ranks_text: bytes, pattern: str):
    import base64

    import tiktoken

    key = hashlib.sha256(ranks_text).hexdigest()
    if key not in _ENCODINGS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_text.splitlines())}
        _ENCODINGS[key] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[key]


def _fixed(ids: np.ndarray, width: int) -> bytes:
    """Ids as little-endian numbers of ``width`` bytes."""
    if len(ids) and int(ids.max()) >> (8 * width):
        raise OverflowError(f"token id {int(ids.max())} does not fit {width} bytes")
    return ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _ids(raw: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(raw, dtype=np.uint8)[: len(wide) * width].reshape(-1, width)
    return wide.reshape(-1).view("<u8")


def write_tokens(docs: DataFrame, folder: str, ranks_path: str, pattern: str, separator: int, width: int = WIDTH) -> None:
    """Flat token files of the texts of ``docs``, one for each of its
    partitions, by Spark's own writer: a document's ids are a row and the
    separator's bytes end it, so files appear whole or not at all."""
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        for batch in batches:
            out = [_fixed(encoding.encode_to_numpy(t or "", disallowed_special=()), width) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    end = int(separator).to_bytes(width, "little").decode("latin-1")
    (docs.select("text").mapInArrow(work, "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", end).option("encoding", "ISO-8859-1").text(folder))


BLOCK_SCHEMA = "path string, block long, ends array<long>, n long, last long"


def _found(path: str, block: int, raw: bytes, separator: int, block_bytes: int, width: int) -> pd.DataFrame:
    """The places of all separators of a block, by one comparison."""
    at = np.flatnonzero(_ids(raw, width) == separator) + block * (block_bytes // width)
    return pd.DataFrame({"path": [path], "block": [block], "ends": [at.astype(np.int64)], "n": [len(at)], "last": [int(at[-1]) if len(at) else -1]})


def _opened(path: str):
    """File system and path for pyarrow; raises for a store it does not know."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def _scan(separator: int, width: int):
    """Rows are blocks, read by byte range."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                system, path = _opened(row.path)
                with system.open_input_file(path) as f:
                    raw = f.read_at(int(row.bytes), int(row.block) * int(row.block_bytes))
                yield _found(row.path, int(row.block), raw, separator, int(row.block_bytes), width)

    return work


def _scan_contents(separator: int, block_bytes: int, width: int):
    """Rows are files with their content, as Spark read them."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                for start in range(0, len(row.content) - len(row.content) % width, block_bytes):
                    yield _found(row.path, start // block_bytes, row.content[start:start + block_bytes], separator, block_bytes, width)

    return work


def _readable(path: str) -> bool:
    try:
        _opened(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def scan(spark: SparkSession, folder: str, separator: int, glob: str = "*", block_bytes: int = BLOCK_BYTES, width: int = WIDTH) -> DataFrame:
    """file, doc_in_file, start_token, n_tokens, terminated: a row for each
    document of the token files below ``folder``, of ids of ``width`` bytes."""
    here = scratch(spark, "token-scan")
    block_bytes -= block_bytes % width
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder))
    files = materialise(listed.select("path", (F.col("length") - F.col("length") % width).alias("length")), "files", here)
    one = files.select("path").first()
    if one is None or _readable(one.path):
        blocks = files.where("length > 0").select("path", "length", F.explode(F.sequence(
            F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes))).alias("block"))
        blocks = blocks.select("path", "block", F.least(F.lit(block_bytes), F.col("length") - F.col("block") * block_bytes).alias("bytes"),
                               F.lit(block_bytes).alias("block_bytes"))
        # a row is a megabyte to read: deal them out evenly, by number
        tasks = max(1, min(blocks.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
        found = blocks.repartitionByRange(tasks, "path", "block").mapInPandas(_scan(separator, width), BLOCK_SCHEMA)
    else:
        found = listed.select("path", "content").mapInPandas(_scan_contents(separator, block_bytes, width), BLOCK_SCHEMA)
    found = materialise(found, "blocks", here)

    # prefix scan: within runs, then over the runs
    steps = found.select("path", "block", F.floor(F.col("block") / BLOCKS_PER_RUN).alias("run"), "n", "last")
    before = Window.partitionBy("path", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs_before = Window.partitionBy("path").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = steps.groupBy("path", "run").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "path", "run", F.coalesce(F.sum("n").over(runs_before), F.lit(0)).alias("run_docs"),
        F.coalesce(F.max("last").over(runs_before), F.lit(-1)).alias("run_last"))
    carried = steps.select("path", "block", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs"),
                           F.coalesce(F.max("last").over(before), F.lit(-1)).alias("last_before")).join(runs, ["path", "run"])
    carried = carried.select("path", "block", (F.col("docs") + F.col("run_docs")).alias("first_doc"),
                             F.greatest("last_before", "run_last").alias("carry"))
    ended = found.where("n > 0").select("path", "block", "ends").join(carried, ["path", "block"]).select(
        "path", "first_doc", "carry", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.coalesce(F.get("ends", F.col("i") - 1), F.col("carry")) + 1
    ended = ended.select("path", (F.col("first_doc") + F.col("i")).alias("doc_in_file"), start.alias("start_token"),
                         (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("terminated"))
    # what follows a file's last separator
    whole = found.groupBy("path").agg(F.sum("n").alias("n"), F.max("last").alias("last")).join(files, "path")
    rest = whole.where(F.col("length") / width > F.col("last") + 1).select(
        "path", F.col("n").alias("doc_in_file"), (F.col("last") + 1).alias("start_token"),
        ((F.col("length") / width).cast("long") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("terminated"))
    return ended.union(rest).select(F.element_at(F.split("path", "/"), -1).alias("file"), "doc_in_file", "start_token", "n_tokens", "terminated")


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, separator: int) -> DataFrame:
    """Writes the texts of ``docs`` as token files and scans them."""
    spark = docs.sparkSession
    folder = f"{scratch(spark, 'token-files')}/tokens"
    write_tokens(docs, folder, ranks_path, pattern, separator)
    return scan(spark, folder, separator, "part-*")
