"""Ranked lexical search: exact top documents by term weights, with geometric blocks in every posting list.

A document is a sparse vector of integer impacts, one per query term it holds; its score for an item is the sum of item
weight times impact.  Documents stay where they lie: each task indexes a few thousand at a time.  In such a shard every
term has a posting list; a list is clustered by similarity of its documents and cut into blocks, and a block stores the
coordinatewise maximum of its documents' vectors (coordinates are terms, folded to groups, rounded up).  An item walks
its lists from the heaviest term on, until the terms that remain cannot reach the item's tenth score.  Of a list it
opens only blocks whose summary allows that score; their documents are scored exactly.  Both bounds are exact, ties
included, so skipping loses nothing.

Only the best documents of each task are shuffled.  A first search over a sample of documents gives every item a score
that its best documents reach for sure, so that shards start with a bound; the sample is searched again with the rest.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, tune, written
from .decontaminate import fold_words

# Distinct (item, term) pairs of one broadcast; more items are searched in several passes.
ITEM_TERMS = 500_000
# Documents of one shard, documents of one block, coordinates of a summary.
SHARD_ROWS = 4096
BLOCK = 48
GROUPS = 512
# Impacts are below 1,000,000; summaries hold sixteenths, rounded up.
SHIFT = 4
# Documents of the first search, about.
SEED_ROWS = 20_000


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(item, term, n) for item, text in zip(batch["item"], batch["text"]) for term, n in Counter(fold_words(text)).items()]
        yield pd.DataFrame(rows, columns=["item", "term", "n"])


def _vectors(vocabulary):
    """Number of terms of each text, and its query terms with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = vocabulary.value
        known = index.keys()
        for batch in batches:
            lengths, ends, terms, counts = [], [0], [], []
            for text in batch.column("text"):
                words = fold_words(text.as_py())
                lengths.append(len(words))
                count = Counter(words)
                held = sorted((index[w], count[w]) for w in count.keys() & known)
                terms += [t for t, _ in held]
                counts += [n for _, n in held]
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
                names=["doc_id", "n", "terms", "counts"],
            )

    return run


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and ends of the lists of a column."""
    return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def _holders(n_terms: int):
    """Documents that hold each term, of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("terms"))[0], minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    return run


class Shard:
    """Posting lists over some documents; a list is clustered and summed up when the first item walks it."""

    def __init__(self, doc_id: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray) -> None:
        self.doc_id, self.terms, self.impacts = doc_id, terms, impacts
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        self.rows = rows[order]
        self.lists = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.lists))
        if len(held):
            self.most[held] = np.maximum.reduceat(impacts[order], self.lists[held])
        at = rows * GROUPS + terms % GROUPS
        points = np.zeros(len(sizes) * GROUPS, np.uint16)
        np.maximum.at(points, at, (-(-impacts >> SHIFT)).astype(np.uint16))
        self.points = points.reshape(-1, GROUPS)
        place = np.bincount(at, weights[terms] * impacts.astype(np.float64), len(points)).astype(np.float32).reshape(-1, GROUPS)
        self.places = place / np.maximum(np.linalg.norm(place, axis=1, keepdims=True), 1e-30)
        self.blocks: dict[int, tuple] = {}

    def blocks_of(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(rows, starts, summaries)`` of a posting list: its documents block by block, where blocks start, and their maxima."""
        if term not in self.blocks:
            rows = self.rows[self.lists[term] : self.lists[term + 1]]
            pivots = -(-len(rows) // BLOCK)
            if pivots > 1:
                # Each document joins the most similar of some documents spread over the list.
                near = (self.places[rows] @ self.places[rows[:: BLOCK]].T).argmax(axis=1)
                order = np.argsort(near, kind="stable")
                rows, near = rows[order], near[order]
                within = np.arange(len(rows)) - np.searchsorted(near, near)
                starts = np.flatnonzero(within % BLOCK == 0)
            else:
                starts = np.zeros(1, np.int64)
            self.blocks[term] = rows, starts, np.maximum.reduceat(self.points[rows], starts)
        return self.blocks[term]

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        sizes = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        return np.add.reduceat(dense[self.terms[at]] * self.impacts[at], np.concatenate(([0], np.cumsum(sizes)[:-1])))

    def search(self, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: Best) -> None:
        """Offers to ``best`` every document that may still enter it; ``dense`` holds the item's weights by term."""
        bounds = weights * self.most[terms]
        order = np.argsort(-bounds, kind="stable")
        rest = np.cumsum(bounds[order][::-1])[::-1]
        most, groups = self.most[terms], terms % GROUPS
        seen = np.zeros(len(self.doc_id), bool)
        for i, at in enumerate(order.tolist()):
            # Documents not seen yet hold none of the terms before.
            if rest[i] < best.least or not bounds[at]:
                break
            rows, starts, summaries = self.blocks_of(int(terms[at]))
            reach = np.minimum(summaries[:, groups].astype(np.int64) << SHIFT, most) @ weights
            ends = np.append(starts[1:], len(rows))
            alive, take = np.argsort(-reach, kind="stable"), 2
            while len(alive):
                alive = alive[reach[alive] >= best.least]
                opened, alive, take = alive[:take], alive[take:], 2 * take
                found = np.concatenate([rows[starts[b] : ends[b]] for b in opened.tolist()]) if len(opened) else rows[:0]
                found = found[~seen[found]]
                if len(found):
                    seen[found] = True
                    best.offer(self.doc_id[found], self.scores(found, dense))


class Best:
    """The ``k`` best documents of an item so far: highest scores, then lowest ids; ``least`` is a score they must reach."""

    def __init__(self, k: int, least: int) -> None:
        self.k, self.least, self.floor = k, max(1, least), max(1, least)
        self.doc_id, self.score = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, doc_id: np.ndarray, score: np.ndarray) -> None:
        use = score >= self.least
        if not use.any():
            return
        doc_id, score = np.concatenate((self.doc_id, doc_id[use])), np.concatenate((self.score, score[use]))
        order = np.lexsort((doc_id, -score))[: self.k]
        self.doc_id, self.score = doc_id[order], score[order]
        if len(order) == self.k:
            self.least = max(self.floor, int(self.score[-1]))


def _search(sent, k: int):
    """The best documents of one task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items, floors, n_docs, n_terms = sent.value
        best = [Best(k, floor) for floor in floors]
        dense = np.zeros(len(weights), np.int64)
        held, rows = [], 0

        def searched() -> None:
            doc_id, n, sizes, terms, counts = (np.concatenate(x) for x in zip(*held))
            m = 25 + 75 * n * n_docs // n_terms
            impacts = 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(m, sizes))
            shard = Shard(doc_id, sizes, terms, impacts, weights)
            for (_, at, weight), mine in zip(items, best):
                dense[at] = weight
                shard.search(at, weight, dense, mine)
                dense[at] = 0

        for batch in batches:
            terms, sizes = _flat(batch.column("terms"))
            use = sizes > 0
            held.append((batch.column("doc_id").to_numpy(zero_copy_only=False)[use], batch.column("n").to_numpy(zero_copy_only=False)[use], sizes[use], terms, _flat(batch.column("counts"))[0]))
            rows += int(use.sum())
            if rows >= SHARD_ROWS:
                searched()
                held, rows = [], 0
        if rows:
            searched()
        out = [(item, int(d), int(s)) for (item, _, _), b in zip(items, best) for d, s in zip(b.doc_id, b.score)]
        yield pa.RecordBatch.from_pylist([{"item": i, "doc_id": d, "score": s} for i, d, s in out], schema=pa.schema({"item": pa.int64(), "doc_id": pa.int64(), "score": pa.int64()}))

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """``item, rank, doc_id, score`` for the items of some collected ``(item, term, n)`` rows."""
    spark = docs.sparkSession
    vocabulary = {term: i for i, term in enumerate(sorted({bytes(r.term) for r in rows}))}
    vectors = written(docs.mapInArrow(_vectors(spark.sparkContext.broadcast(vocabulary)), "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"), "vectors")
    size = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.mapInArrow(_holders(len(vocabulary)), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weights = np.array([math.floor(1000 * math.log((2 * size.docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    by_item: dict[int, list] = {}
    for r in rows:
        by_item.setdefault(r.item, []).append((vocabulary[bytes(r.term)], r.n))
    items = []
    for item, held in sorted(by_item.items()):
        at, n = (np.array(x, np.int64) for x in zip(*sorted(held)))
        use = df[at] > 0
        items.append((item, at[use], weights[at[use]] * n[use]))
    named = vectors.where("doc_id is not null and size(terms) > 0")

    def search(part: DataFrame, floors: list[int]) -> DataFrame:
        sent = spark.sparkContext.broadcast((weights, items, floors, size.docs, max(1, size.terms)))
        return part.mapInArrow(_search(sent, k), "item bigint, doc_id bigint, score bigint")

    floors, apart = [0] * len(items), size.docs // SEED_ROWS
    if apart > 1:
        sample = named.where(F.pmod(F.xxhash64("doc_id"), F.lit(apart)) == 0)
        least = {r.item: r.score for r in _ranked(search(sample, floors), k).where(F.col("rank") == k).collect()}
        floors = [least.get(item, 0) for item, _, _ in items]
    return _ranked(search(named, floors), k)


def search_items(df: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", item_terms: int = ITEM_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for each item.

    Terms are maximal runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased.  Equal
    scores rank by ascending ``doc_id``.  Null and empty texts have no terms: such a document is never found and does not
    count, such an item has no rows.  Rows that repeat an id are documents of their own.  Rows without ``doc_id`` count
    in the statistics, but cannot be returned.  Items that repeat in id and text are one; items of one id with other texts
    are ranked each for itself.  Empty tables give no rows.  Only the columns named are read.
    """
    spark = df.sparkSession
    tune(spark)
    docs = df.select(column(id_col).cast("bigint").alias("doc_id"), column(text_col).alias("text"))
    asked = items.select(column(item_col).cast("bigint").alias("item_id"), column(item_text_col).alias("text")).where("text is not null").distinct()
    asked = written(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    pairs = written(asked.select("item", "text").mapInPandas(_item_terms, "item bigint, term binary, n bigint"), "item-terms")
    blocks = -(-pairs.count() // item_terms)
    found = None
    for i in range(blocks):
        rows = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).collect()
        if rows:
            part = _search_block(docs, rows, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint, rank int")
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
