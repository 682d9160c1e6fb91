"""Benchmark decontamination: a broadcast hash set of benchmark word windows, scanned over the training texts.

A window is ``size`` consecutive words of an item (all words of a shorter item).  The windows are counted first:
up to ``window_limit`` they are one broadcast set; beyond it they are cut into blocks of that size, each block
is broadcast in its own scan, and the marked word positions of a document are united.  A window is found by its
hash and verified word by word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, column, per_text, tune, window_hashes, written

# Windows of one broadcast block, each of `size` words: about 200 MB of Python objects at the most.
WINDOW_LIMIT = 500_000

# A-Z to a-z; digits, letters and all bytes of non-ASCII characters stay, the rest separates words.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def fold_words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _item_windows(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for item, text in zip(batch["item_id"], batch["text"]):
                words = fold_words(text)
                k = min(size, len(words))
                if k:
                    out += [(item, b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)]
            yield pd.DataFrame(out, columns=["item_id", "window"])

    return run


class WindowSet:
    """Benchmark windows by length: sorted hashes to look up, the words to verify, the items they belong to."""

    def __init__(self, rows: list[tuple[bytes, list]]) -> None:
        hashes, by_size = WordHash(), {}
        for window, items in rows:
            words = window.split()
            h = int(window_hashes(hashes.of(words), len(words))[0])
            by_size.setdefault(len(words), {}).setdefault(h, []).append((words, sorted(items)))
        self.by_size = {k: (np.array(sorted(d), np.uint64), d) for k, d in by_size.items()}

    def scan(self, words: list[bytes], hashes: np.ndarray) -> tuple[np.ndarray, set]:
        """Marked word positions (boolean per word) and the items found."""
        hit, found = np.zeros(len(words), bool), set()
        for k, (keys, held) in self.by_size.items():
            if len(words) < k:
                continue
            windows = window_hashes(hashes, k)
            at = np.searchsorted(keys, windows)
            at[at == len(keys)] = 0
            for i in np.flatnonzero(keys[at] == windows).tolist():
                for own, items in held[int(windows[i])]:
                    if own == words[i : i + k]:
                        hit[i : i + k] = True
                        found.update(items)
        return hit, found


def _digest(items: list) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _scan(block):
    """Per text: number of words, marked runs as start and end word, and items found in this block."""

    def start():
        windows, cache = WindowSet(block.value), WordHash()

        def one(text: str | None) -> tuple:
            words = fold_words(text)
            hit, found = windows.scan(words, cache.of(words))
            runs = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
            return len(words), runs.tolist(), sorted(found)

        return one

    return start


def _finish():
    """The report of a text from its words and the marks of all blocks."""

    def one(marks: dict) -> tuple:
        n, merged = marks["n_words"], []
        for start, end in sorted((int(r[i]), int(r[i + 1])) for r in marks["runs"] for i in range(0, len(r), 2)):
            if merged and start <= merged[-1]:
                merged[-1] = max(merged[-1], end)
            else:
                merged += [start, end]
        n_hit = sum(merged[1::2]) - sum(merged[::2])
        items = {int(i) for found in marks["items"] for i in found}
        return n_hit, len(items), _digest(items), n_hit > 0 and 20 * n_hit >= n, merged

    return one


def _scan_whole(block):
    """As ``_scan`` with the report of the text, where one block holds all windows."""

    def start():
        scan, finish = _scan(block)(), _finish()

        def one(text: str | None) -> tuple:
            n, runs, found = scan(text)
            return n, *finish({"n_words": n, "runs": [runs], "items": [found]})

        return one

    return start


_MARKS = "n_words bigint, runs array<bigint>, items array<bigint>"
_REPORT = "n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, hit_spans array<bigint>"


def window_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = 13, window_limit: int = WINDOW_LIMIT) -> list:
    """The benchmark's windows as broadcast sets of about ``window_limit`` each; one set unless they are more."""
    spark = benchmark.sparkSession
    items = benchmark.select(column(item_col).cast("bigint").alias("item_id"), column(text_col).alias("text")).where("item_id is not null")
    windows = items.mapInPandas(_item_windows(size), "item_id bigint, window binary").groupBy("window").agg(F.collect_set("item_id").alias("items"))
    windows = written(windows, "windows")
    blocks = max(1, -(-windows.count() // window_limit))
    sets = []
    for i in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == i).collect()
        sets.append(spark.sparkContext.broadcast([(bytes(r["window"]), list(r["items"])) for r in rows]))
    return sets


def mark_hits(df: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "hits", **options) -> DataFrame:
    """``df`` with a struct column ``out_col``: n_words, n_hit, n_items, items_sha256, contaminated, hit_spans.

    ``hit_spans`` lists start and end word (exclusive) of each marked run.  A text is contaminated if it has marked
    words and they are at least 5 % of its words.  Null and empty texts have no words and are clean; items without id
    or words have no window; an empty benchmark marks nothing; repeated rows each keep their row.
    """
    tune(df.sparkSession)
    sets = window_blocks(benchmark, **options)
    text = column(text_col)
    if len(sets) == 1:
        return df.withColumn(out_col, per_text(_scan_whole(sets[0]), f"n_words bigint, {_REPORT}", text))
    # One scan per block; the marks of a text meet by its digest, and only texts with marks are shuffled.
    name = F.sha2(F.coalesce(text, F.lit("")), 256)
    parts = None
    for block in sets:
        part = df.select(name.alias("__name"), per_text(_scan(block), _MARKS, text).alias("m")).where("size(m.runs) > 0").dropDuplicates(["__name"])
        part = written(part, "marks")
        parts = part if parts is None else parts.unionByName(part)
    found = parts.groupBy("__name").agg(F.collect_list("m.runs").alias("__runs"), F.collect_list("m.items").alias("__items"))
    none = F.array().cast("array<array<bigint>>")
    words = per_text(lambda: lambda t: (len(fold_words(t)),), "n_words bigint", text)["n_words"]
    marked = df.withColumn("__name", name).withColumn("__n", words).join(found, "__name", "left")
    marked = marked.withColumn("__m", F.struct(F.col("__n").alias("n_words"), F.coalesce("__runs", none).alias("runs"), F.coalesce("__items", none).alias("items")))
    marked = marked.drop("__name", "__n", "__runs", "__items")
    fields = [f.split(" ")[0] for f in _REPORT.split(", ")]
    done = marked.withColumn("__r", _report_udf()(F.col("__m")))
    return done.withColumn(out_col, F.struct(F.col("__m.n_words").alias("n_words"), *[F.col(f"__r.{f}").alias(f) for f in fields])).drop("__m", "__r")


def _report_udf():
    fields = [f.split(" ")[0] for f in _REPORT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = _finish()
        for batch in batches:
            out = [one({"n_words": n, "runs": r, "items": i}) for n, r, i in zip(batch["n_words"], batch["runs"], batch["items"])]
            yield pd.DataFrame({f: pd.Series([row[k] for row in out], dtype=object) for k, f in enumerate(fields)})

    return F.pandas_udf(run, _REPORT).asNondeterministic()


def benchmark_hits(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id`` and the fields of ``mark_hits`` per row of ``df``; only the columns named are read."""
    docs = df.select(column(id_col).cast("bigint").alias("doc_id"), column(text_col).alias("text"))
    return mark_hits(docs, benchmark, "text", "hits", **options).select("doc_id", "hits.*")


def remove_spans(text_col: str, spans_col: str):
    """A column: the text without the marked runs of words; what stands between two words goes with the first of them."""
    word = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            out = []
            for text, cuts in zip(texts, spans):
                if text is not None and cuts is not None and len(cuts):
                    at = [m.start() for m in word.finditer(text)] + [len(text)]
                    keep, pos = [], 0
                    for i in range(0, len(cuts), 2):
                        keep.append(text[pos : at[cuts[i]]])
                        pos = at[cuts[i + 1]]
                    text = "".join(keep) + text[pos:]
                out.append(text)
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(run, "string")(column(text_col), F.col(spans_col))
