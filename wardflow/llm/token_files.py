"""Token counts of flat token files: a vectorised scan for the end-of-document id, stitched over blocks.

A token file is a run of fixed-width ids in which each document ends with the end-of-document id; it has no
index.  It is read in blocks that end anywhere.  Each block is scanned by itself: the places of the separators, the
tokens before the first and those after the last.  A prefix scan over the blocks of a file gives every block the
number of documents that ended before it and the tokens of the document that is open at its start.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, tune

# Ids per block.
BLOCK_IDS = 1 << 18
BLOCKS = "file string, block bigint, ids binary"


# Bytes that one task reads.
TASK_BYTES = 32 << 20


def _local(path: str) -> str | None:
    """The path of a file or folder of a mounted file system, None for other stores."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else None


def _opened(path: str):
    if (local := _local(path)) is not None:
        return open(local, "rb")
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _reached(path: str) -> bool:
    try:
        with _opened(path):
            return True
    except Exception:
        return False


def read_token_files(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS, width: int = 2) -> DataFrame:
    """``file, block, ids`` of the flat files under ``path`` (little-endian ids of ``width`` bytes).

    Only names and lengths are listed; each block is a range that its task reads by itself, so files may have any size
    and no task holds one.  A store that Python cannot open is read by Spark, whole files at once, each under 2 GB.
    A file whose length is no multiple of the width is an error; an empty file gives no block.
    """
    size = block_ids * width
    files = spark.read.format("binaryFile").load(path)
    total, sample = files.select("path", "length").where("length > 0").agg(F.sum("length"), F.min("path")).first()

    def blocks_of(file: str, first: int, content: bytes) -> Iterator[pd.DataFrame]:
        if len(content) % width:
            raise ValueError(f"{file}: its length is no multiple of {width}")
        for k, i in enumerate(range(0, len(content), size)):
            yield pd.DataFrame({"file": [file], "block": [first + k], "ids": [content[i : i + size]]})

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                yield from blocks_of(file, 0, content)

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, length, block in zip(batch["path"], batch["length"], batch["block"]):
                with _opened(file) as opened:
                    opened.seek(int(block) * size)
                    content = opened.read(size)
                if len(content) != min(size, length - block * size):
                    raise OSError(f"{file} has changed")
                yield from blocks_of(file, int(block), content)

    if sample is not None and not _reached(sample):
        return files.select("path", "content").mapInPandas(whole, BLOCKS)
    listed = files.select("path", "length").where("length > 0")
    each = listed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / size))))
    return each.repartition(max(1, -(-(total or 0) // TASK_BYTES)), "path", "block").mapInPandas(ranges, BLOCKS)


def write_token_files(streams: DataFrame, folder: str) -> None:
    """Streams as ``flat_tokens`` makes them (each in one task, in order) as flat files in ``folder``, which all executors mount.

    A file gets its name when it is complete, so a task that fails or runs twice leaves no half file.
    """
    local = _local(folder)
    os.makedirs(local, exist_ok=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, part = None, f"{local}/_{uuid.uuid4().hex}"
        os.makedirs(local, exist_ok=True)
        with open(part, "wb") as out:
            for batch in batches:
                for file, ids in zip(batch["file"], batch["ids"]):
                    if name not in (None, file):
                        raise ValueError("a task holds one stream")
                    name = file
                    out.write(ids)
        if name is None:
            os.remove(part)
        else:
            os.replace(part, f"{local}/{name}.bin")
        yield pd.DataFrame({"n": [int(name is not None)]})

    streams.mapInPandas(run, "n bigint").agg(F.sum("n")).first()


def flat_tokens(df: DataFrame, ranks: dict[bytes, int], pattern: str, separator: int, text_col: str = "text", block_ids: int = BLOCK_IDS, width: int = 2) -> DataFrame:
    """The texts of ``df`` as token streams, one per task, each text followed by the separator and cut into blocks anywhere.

    Null and empty texts give the separator alone.  Write the result before it is used more than once: a stream is
    named by its task.  Two bytes hold an id of a vocabulary under 65,536.
    """
    if max(separator, *ranks.values()) >= 1 << 8 * width:
        raise ValueError(f"ids of {width} bytes cannot hold this vocabulary")
    sent = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=sent.value, special_tokens={}).encode_ordinary
        file, block, held, n = f"stream-{TaskContext.get().partitionId():06d}", 0, [], 0
        for batch in batches:
            for text in batch["text"]:
                ids = encode(text) if text else []
                ids.append(separator)
                held.append(np.array(ids, f"<u{width}"))
                n += len(ids)
                if n >= block_ids:
                    whole = np.concatenate(held)
                    full = n // block_ids * block_ids
                    for i in range(0, full, block_ids):
                        yield pd.DataFrame({"file": [file], "block": [block], "ids": [whole[i : i + block_ids].tobytes()]})
                        block += 1
                    held, n = [whole[full:]], n - full
        if n:
            yield pd.DataFrame({"file": [file], "block": [block], "ids": [np.concatenate(held).tobytes()]})

    return df.select(column(text_col).alias("text")).mapInPandas(run, BLOCKS)


def _scan(separator: int, width: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for data in batch:
                ids = np.frombuffer(data or b"", f"<u{width}")
                ends = np.flatnonzero(ids == separator)
                out.append((len(ids), ends.astype(np.int32), len(ids) - (int(ends[-1]) + 1 if len(ends) else 0)))
            yield pd.DataFrame({"n_ids": [o[0] for o in out], "ends": pd.Series([o[1] for o in out], dtype=object), "tail": [o[2] for o in out]})

    return F.pandas_udf(run, "n_ids bigint, ends array<int>, tail bigint")


def count_document_tokens(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """``file, doc_no, start, n_tokens`` of every document, from ``file, block, ids``.

    ``start`` is the document's first place in the file, separators counted; ``n_tokens`` leaves the separator out.
    Documents may span any number of blocks; two separators in a row hold a document of 0 tokens; tokens after the
    last separator of a file are a last document.  Blocks without ids change nothing; no blocks, no rows; null ids
    count as none; blocks may come in any order, but ``block`` numbers them within the file without repeats.
    """
    tune(blocks.sparkSession)
    found = blocks.select(column("file").alias("file"), column("block").cast("bigint").alias("block"), _scan(separator, width)(column("ids")).alias("s")).select("file", "block", "s.*")
    # The prefix scan needs one row per block.
    before = "over (partition by file order by block rows between unbounded preceding and 1 preceding)"
    scanned = found.selectExpr(
        "file", "block", "ends", "n_ids", f"coalesce(sum(size(ends)) {before}, 0) as docs_before", f"coalesce(sum(n_ids) {before}, 0) as ids_before",
        f"coalesce(last(case when size(ends) > 0 then block end, true) {before}, -1) as last_end_block", "lead(block) over (partition by file order by block) is null as last_block", "tail",
    )
    # Tokens open at a block's start: its place, less the place after the last separator before it.
    placed = scanned.selectExpr("*", "max(case when size(ends) > 0 then ids_before + n_ids - tail end) " + before + " as open_from").withColumn("open_from", F.coalesce("open_from", F.lit(0)))
    spans = placed.selectExpr(
        "file", "docs_before",
        # Places after each separator; a file's open end counts as one more, if it holds a token.
        "concat(transform(ends, e -> ids_before + e), case when last_block and (tail > 0 and size(ends) > 0 or size(ends) = 0 and ids_before + n_ids > open_from) then array(ids_before + n_ids) else array() end) as stops", "open_from",
    )
    docs = spans.selectExpr("file", "docs_before", "open_from", "stops", "posexplode(stops) as (at, stop)")
    start = F.when(F.col("at") == 0, F.col("open_from")).otherwise(F.expr("stops[at - 1] + 1"))
    return docs.select("file", (F.col("docs_before") + F.col("at")).alias("doc_no"), start.alias("start"), (F.col("stop") - start).alias("n_tokens"))
