"""N-gram Jaccard join with a count-vector R-tree.

A document is its set of distinct word shingles.  The shingles are hashed into ``GROUPS`` groups; the counts
per group are a point, and the overlap of two documents is at most the sum of the smaller coordinates of
their points.  Packed R-trees over such points find the candidate pairs; a pair that survives the bound is
verified on the whole sets.

Count vectors of unrelated documents of one length lie close together, so one tree over all documents would
compare nearly every pair of similar length.  Spark therefore deals the documents to many small trees: two
documents over the threshold share one of the first ``n - ceil(t * n) + 1`` shingles of any common order, and
each such shingle that two documents share is the key of one tree.  The order puts common shingles last,
as counted in hashed slots over the whole corpus, so shared passages rarely become keys.

Components need no pair twice: documents of one set are one node; each key first proposes links to its
smallest document; what these prove is merged, and only keys that still join several components get a tree.
A large key is cut into blocks, each with its tree.

Links need every pair: the trees find those between the components the first links make, and inside each such
component all sets are compared with each other, block against block.  The number of links of a document is summed up
where its set is compared, so no link becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHash, column, mixed, per_text, tune, window_hashes, written
from .graph import components

GROUPS = 128
SLOT_BITS = 18
# Members of a key that one tree holds.
BLOCK = 4000
# Bits of the filter that keeps the texts of most non-candidates in the JVM (1 MB).
FILTER_BITS = 23
FANOUT = 16
# Sets of a component that meet in one comparison: at most so many, and so many shingles, a side.
SIDE = 256
SIDE_ITEMS = 2_000_000
# Distinct shingles compared at once.
WIDTH = 1 << 15
# Earlier keys of a document that travel with it to a tree, so that a pair is told by one of its trees, not by each.
EARLIER = 8


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, size: int, cache: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle of all its words, a text without words none."""
    words = _words(text)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(cache.of(words), min(size, len(words))))


def _need(n: np.ndarray, m: int, percent: int) -> np.ndarray:
    """Least overlap with which sets of n and m shingles reach the threshold."""
    return -((-percent * (n + m)) // (100 + percent))


def point_of(sets: np.ndarray) -> bytes:
    """Counts per group, about four shingles to a group in large sets, one byte each if they all fit, else four.

    The number of groups is ``GROUPS`` times a power of two, so a finer point folds to a coarser one.
    """
    groups = GROUPS
    while groups < len(sets) // 4 and groups < 1 << 18:
        groups *= 2
    return packed(np.bincount((sets >> np.uint64(40)).astype(np.int64) % groups, minlength=groups))


def packed(counts: np.ndarray) -> bytes:
    return b"\x01" + counts.astype(np.uint8).tobytes() if counts.max() < 256 else b"\x04" + counts.astype(np.int32).tobytes()


def read_point(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if data[0] == 1 else np.int32, offset=1).astype(np.int32)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    return point.reshape(-1, groups).sum(axis=0)


def _coarse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Points of ``GROUPS`` coordinates, which the trees hold."""
    for batch in batches:
        yield pd.Series([packed(folded(read_point(x), GROUPS)) for x in batch], dtype=object)


class CountTree:
    """A packed R-tree over count vectors: each node keeps the largest coordinates and the set sizes below it."""

    def __init__(self, n: np.ndarray, points: np.ndarray) -> None:
        # Packing order: by size, then by the heaviest groups, so that neighbours share a leaf.
        self.order = np.lexsort((points[:, 1], points[:, 0], n))
        self.levels = [(points[self.order], n[self.order], n[self.order])]
        while len(self.levels[-1][0]) > FANOUT:
            high, least, most = self.levels[-1]
            at = np.arange(0, len(high), FANOUT)
            self.levels.append((np.maximum.reduceat(high, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)))

    def search(self, n: int, point: np.ndarray, percent: int) -> np.ndarray:
        """Members whose summed coordinate minima with the point allow the threshold."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most = (x[at] for x in self.levels[depth])
            size_ok = (100 * least <= 100 * n * 100 // percent) & (100 * most >= percent * n)
            at, high, least = at[size_ok], high[size_ok], least[size_ok]
            bound = np.minimum(high, point).sum(axis=1)
            at = at[bound >= _need(np.maximum(least, -(-percent * n // 100)), n, percent)]
            if depth:
                below = len(self.levels[depth - 1][0])
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < below]
        return self.order[at]


def _count_slots(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, total = WordHash(), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            # With repeats within a text: any order of the shingles is a right one.
            found = [window_hashes(cache.of(words), min(size, len(words))) for words in map(_words, batch["text"]) if words]
            if found:
                total += np.bincount((np.concatenate(found) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at.astype(np.int32), "n": total[at]})

    return run


def _first(sets: np.ndarray, level: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` shingles in the order of all shingles: by level, then by a hash.  Only those that may be among them are sorted."""
    if k < len(sets):
        near = level <= np.partition(level, k - 1)[k - 1]
        sets, level = sets[near], level[near]
    return sets[np.lexsort((mixed(sets), level))[:k]]


def _describe(size: int, percent: int, ranks):
    """Per text: set size, a 128-bit name of the set, the prefix shingles and the count vector."""

    def start():
        cache, rank = WordHash(), ranks.value

        def one(text: str | None) -> tuple:
            sets = shingle_set(text, size, cache)
            n = len(sets)
            if not n:
                return 0, None, None, None, None, None
            name = xxhash.xxh3_128_intdigest(sets.tobytes())
            names = np.array([name >> 64, name & 0xFFFFFFFFFFFFFFFF], np.uint64).view(np.int64)
            level = rank[(sets >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
            keys = _first(sets, level, n - -(-percent * n // 100) + 1)
            return n, int(names[0]), int(names[1]), keys.view(np.int64), n - -(-2 * percent * n // (100 + percent)) + 1, point_of(sets)

        return one

    return start


def _sets_of(size: int):
    """The whole sets of documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for batch in batches:
            sets = [shingle_set(text, size, cache).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "items": pd.Series(sets, dtype=object)})

    return run


def _some_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """Sets of the documents whose ids are listed, and of the few others that the bit map lets through: the caller's join drops them."""
    wanted = flag_possible(docs, marks_of(ids)).where("__maybe").select("doc_id", "text")
    return wanted.mapInPandas(_sets_of(size), "doc_id bigint, items array<bigint>")


def marks_of(ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A bit map of the ids as rows of 64 bits: at most ``2**FILTER_BITS / 64`` rows (2 MB), whatever the number of ids."""
    slot = _slot(F.col(id_col))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int")))
    return written(ids.groupBy(F.shiftright(slot, 6).alias("__word")).agg(bits.alias("__bits")), "marks")


def _slot(c):
    return F.shiftrightunsigned(F.xxhash64(c), 64 - FILTER_BITS)


def flag_possible(df: DataFrame, marks: DataFrame, id_col: str = "doc_id", name: str = "__maybe") -> DataFrame:
    """``df`` with ``name``: false only for ids that are surely not among the marked ones; the bit map is broadcast, its size is fixed."""
    slot = _slot(F.col(id_col))
    joined = df.join(F.broadcast(marks), F.shiftright(slot, 6) == F.col("__word"), "left")
    hit = F.getbit(F.coalesce("__bits", F.lit(0).cast("bigint")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1
    return joined.withColumn(name, hit & F.col(id_col).isNotNull()).drop("__word", "__bits")


def _bounded(percent: int):
    """Keeps the pairs whose summed minima allow the threshold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ok = []
            for n, m, x, y in zip(batch["n_a"], batch["n_b"], batch["point_a"], batch["point_b"]):
                x, y = read_point(x), read_point(y)
                groups = min(len(x), len(y))
                low = int(np.minimum(folded(x, groups), folded(y, groups)).sum())
                ok.append((100 + percent) * low >= percent * (n + m))
            yield batch.loc[np.array(ok), ["a", "b"]]

    return run


def _tree_pairs(percent: int):
    """Candidate pairs of each (key, block): its home members make a tree, all members search it.

    Rows come sorted by key, block and home members first, so a group is read once and only its home
    members, at most about ``BLOCK``, are held.

    A pair that meets in many keys is told once: each member brings its last ``EARLIER`` keys before this one, and a
    pair with one of them in common has met there already.  Of the keys that two members share the least one is
    before all others, so no pair is lost; one with no common key among the last few is told again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held, tree = None, [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for key, block, home, node, comp, n, point, earlier in zip(*(batch[c] for c in ("key", "block", "home", "node", "comp", "n", "point", "earlier"))):
                if (key, block) != current:
                    if held:
                        out += _within(held, percent)
                    current, held, tree = (key, block), [], None
                member = (node, comp, n, read_point(point), np.asarray(earlier, np.int64))
                if home:
                    held.append(member)
                    continue
                if tree is None:
                    out += _within(held, percent)
                    tree, held = _Members(held) if held else False, []
                if tree:
                    out += tree.met(member, percent)
            yield pd.DataFrame(sorted(set(out)), columns=["a", "b"], dtype="int64")
        if held:
            yield pd.DataFrame(sorted(set(_within(held, percent))), columns=["a", "b"], dtype="int64")

    return run


class _Members:
    """The home members of a tree: rows of node, component, set size, point and earlier keys."""

    def __init__(self, held: list[tuple]) -> None:
        self.nodes, self.comps = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
        self.tree = CountTree(np.array([h[2] for h in held]), np.array([h[3] for h in held]))
        self.earlier = np.zeros((len(held), EARLIER), np.int64)
        self.known = np.zeros((len(held), EARLIER), bool)
        for i, h in enumerate(held):
            self.earlier[i, : len(h[4])], self.known[i, : len(h[4])] = h[4], True

    def met(self, member: tuple, percent: int) -> list[tuple[int, int]]:
        """Pairs of the member with members of other components that the bound allows and that no earlier key has told."""
        node, comp, n, point, earlier = member
        at = self.tree.search(n, point, percent)
        at = at[self.comps[at] != comp]
        if len(at) and len(earlier):
            at = at[~(np.isin(self.earlier[at], earlier) & self.known[at]).any(axis=1)]
        return [(min(node, other), max(node, other)) for other in self.nodes[at]]


def _within(held: list[tuple], percent: int) -> list[tuple[int, int]]:
    if len(held) < 2 or len({h[1] for h in held}) < 2:
        return []
    members = _Members(held)
    return [pair for member in held for pair in members.met(member, percent)]


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold.  Sets are made again from the texts, of the candidates only."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    sets = _some_sets(docs, ids, size)
    with_a = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")), "a")
    with_b = with_a.join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b")), "b")
    common = F.size(F.array_intersect("items_a", "items_b"))
    return with_b.where((100 + percent) * common >= percent * (F.size("items_a") + F.size("items_b"))).select("a", "b").distinct()


def _all_pairs(percent: int, told):
    """What ``told`` makes of each (component, i, j): its sets of block i against those of block j, each pair compared exactly."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = None, []
        for batch in batches:
            for comp, i, j, own, node, k, items in zip(*(batch[c] for c in ("comp", "i", "j", "own", "node", "k", "items"))):
                if (comp, i, j) != current:
                    if held:
                        yield told(*_linked(held, current, percent))
                    current, held = (comp, i, j), []
                held.append((node, own, np.asarray(items), k))
        if held:
            yield told(*_linked(held, current, percent))

    return run


def _linked(held: list[tuple], task: tuple, percent: int) -> tuple:
    """``(a, b, weight of a, weight of b, linked)``: the sets of both blocks and which of them link."""
    _, i, j = task
    nodes, own, n, k = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held]), np.array([len(h[2]) for h in held]), np.array([h[3] for h in held], np.int64)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    distinct, at = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
    row = np.repeat(np.arange(len(held)), n)
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    common = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(distinct), WIDTH):
        low, high = np.searchsorted(at, [start, start + WIDTH])
        has = np.zeros((len(held), min(WIDTH, len(distinct) - start)), np.float32)
        has[row[low:high], at[low:high] - start] = 1
        common += (has[left] @ has[right].T).astype(np.int64)
    linked = (100 + percent) * common >= percent * (n[left][:, None] + n[right])
    linked &= nodes[left][:, None] != nodes[right]
    return nodes[left], nodes[right], k[left], k[right], linked, i == j


def _pairs_told(a, b, k_a, k_b, linked, same) -> pd.DataFrame:
    x, y = np.nonzero(np.triu(linked) if same else linked)
    return pd.DataFrame({"a": np.minimum(a[x], b[y]), "b": np.maximum(a[x], b[y])})


def _counts_told(a, b, k_a, k_b, linked, same) -> pd.DataFrame:
    """Documents that each set links to here: one row per set and comparison, not one per link."""
    node, k = a, linked @ k_b
    if not same:
        node, k = np.concatenate((a, b)), np.concatenate((k, k_a @ linked))
    return pd.DataFrame({"node": node, "k": k})[k > 0]


def _inside(comps: DataFrame, points: DataFrame, docs: DataFrame, size: int, percent: int, width: DataFrame | None = None) -> DataFrame:
    """The links inside the components of more than two nodes (of two, the link that made the component is all).

    Pairs ``a, b``; with ``width`` (``node, k``) instead ``node, k``, parts of the number of documents that a set links to.
    """
    members = comps.join(points.select("node", "n"), "node")
    blocks = F.ceil(F.col("k") / F.greatest(F.lit(8), F.least(F.lit(SIDE), F.floor(F.lit(SIDE_ITEMS) / F.col("n"))))).cast("int")
    large = members.groupBy("comp").agg(F.count("*").alias("k"), F.max("n").alias("n")).where("k > 2").select("comp", blocks.alias("blocks"))
    placed = members.select("node", "comp").join(large, "comp").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.join(width, "node") if width is not None else placed.withColumn("k", F.lit(1).cast("bigint"))
    placed = written(placed, "placed")
    sets = _some_sets(docs, placed.select(F.col("node").alias("doc_id")), size).withColumnRenamed("doc_id", "node").join(placed, "node")
    other = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = other.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "k", "items")
    tasks = tasks.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    if width is None:
        return tasks.mapInPandas(_all_pairs(percent, _pairs_told), "a bigint, b bigint")
    return tasks.mapInPandas(_all_pairs(percent, _counts_told), "node bigint, k bigint")


def jaccard_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(links, members)``: all links between different sets, and the documents of each set.

    ``links`` holds ``a, b`` with ``a < b``, each pair of sets over the threshold once, a set named by its smallest
    document; ``members`` holds ``node, doc_id``, each document that has shingles with the name of its set.
    """
    found = _joined(df, id_col, text_col, size, percent)
    described, classes = found["described"], found["classes"]
    inner = _inside(found["first_comps"], found["points"], found["known"], size, percent)
    links = written(found["first"].unionByName(found["more"]).unionByName(inner).distinct(), "links")
    members = described.where("doc_id is not null and n > 0").select("set_a", "set_b", "doc_id").join(classes, ["set_a", "set_b"])
    return links, members.select("node", "doc_id").distinct()


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, n_links: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``df``, and with ``n_links`` the number of documents it links to.

    Words are runs without ASCII white space, A-Z lower-cased; two documents link when the Jaccard similarity of their
    shingle sets is at least ``percent`` / 100; ``component_id`` is the smallest id reachable by links.

    Null and empty texts, and texts of white space, have no shingles and keep their own id.  Equal texts and repeated
    rows share a component; rows that repeat an id count as one document for the links.  A row without id gets its
    size, no component and no number of links.  Only the two columns named are read, so other columns may have any name.
    """
    found = _joined(df, id_col, text_col, size, percent)
    described, classes = found["described"], found["classes"].join(found["comps"], "node", "left")
    counts = []
    if n_links:
        copied = found["copies"].groupBy("set_a", "set_b").agg(F.count("*").alias("more"))
        classes = classes.join(copied, ["set_a", "set_b"], "left").withColumn("more", F.coalesce("more", F.lit(0)))
        # A link to a set is a link to each of its documents.
        classes = written(classes, "classes")
        width = classes.where("comp is not null").select("node", (F.col("more") + 1).alias("k"))
        inner = _inside(found["first_comps"], found["points"], found["known"], size, percent, width)
        # Links that no comparison inside a component sees: those of components of two, and those between components.
        two = found["first_comps"].groupBy("comp").agg(F.count("*").alias("k")).where("k = 2").select(F.col("comp").alias("a"))
        outer = found["first"].join(two, "a", "left_semi").unionByName(found["more"])
        ways = outer.unionByName(outer.select(F.col("b").alias("a"), F.col("a").alias("b")))
        outer = ways.join(width.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "k")
        others = written(inner.unionByName(outer).groupBy("node").agg(F.sum("k").alias("others")), "others")
        classes = classes.join(others, "node", "left").withColumn("links", F.col("more") + F.coalesce("others", F.lit(0)))
        counts = ["links"]
    classes = classes.select("set_a", "set_b", F.coalesce("comp", "node").alias("comp"), *counts)
    return described.join(classes, ["set_a", "set_b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"),
        *[F.when(F.col("doc_id").isNotNull(), F.coalesce(c, F.lit(0))).alias("n_links") for c in counts],
    )


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``df`` without near copies: of each component the row with the smallest id stays, all columns as they are.

    A row without id is in no component and stays; of rows that repeat the kept id one stays.  Rows without shingles
    (null and empty texts) stay, each under its id.  An empty table stays empty.
    """
    groups = jaccard_components(df, id_col, text_col, size, percent).where("doc_id is not null")
    groups = written(groups.select("doc_id", "component_id"), "groups")
    acted = groups.groupBy("doc_id").agg(F.max(F.col("doc_id") != F.col("component_id")).alias("__copy"), F.count("*").alias("__n"))
    acted = written(acted.where("__copy or __n > 1").select(F.col("doc_id").alias("__id"), "__copy"), "acted")
    # Texts of documents that surely stay are not shuffled.
    flagged = flag_possible(df.withColumn("__key", column(id_col).cast("bigint")), marks_of(acted, "__id"), "__key")
    stay, rest = flagged.where("not __maybe"), flagged.where("__maybe").join(acted, F.col("__key") == F.col("__id"), "left")
    single, repeated = rest.where("__copy is null"), rest.where("not __copy").dropDuplicates(["__key"])
    return stay.unionByName(single.drop("__id", "__copy")).unionByName(repeated.drop("__id", "__copy")).select([column(c) for c in df.columns])


def _joined(df: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> dict[str, DataFrame]:
    """The tables of the join: documents, sets, copies, the links that make the components, and the components.

    ``first`` links lie inside ``first_comps``, which may hold more links; ``more`` are all links between those.
    """
    spark = df.sparkSession
    tune(spark)
    docs = df.select(column(id_col).cast("bigint").alias("doc_id"), column(text_col).alias("text"))
    known = docs.where("doc_id is not null")
    counts = docs.select("text").mapInPandas(_count_slots(size), "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    # The counts themselves: a slot holds more and more shingles as the table grows, so rounded counts would hide what is shared.
    level = np.zeros(1 << SLOT_BITS, np.int64)
    level[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    ranks = spark.sparkContext.broadcast(level)
    found = per_text(_describe(size, percent, ranks), "n bigint, set_a bigint, set_b bigint, keys array<bigint>, near bigint, point binary", F.col("text"))
    described = written(docs.select("doc_id", found.alias("found")).select("doc_id", "found.*"), "sets")

    # Documents with one set are one node, named by the smallest id.
    filled = described.where("doc_id is not null and n > 0")
    classes = filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    copies = filled.select("set_a", "set_b", "doc_id").join(classes, ["set_a", "set_b"]).where("doc_id <> node").drop("node").distinct()
    copies = written(copies, "copies")
    # Only rows that may be copies are shuffled to be told apart; the others are nodes for sure.
    flagged = flag_possible(filled, marks_of(copies))
    told = written(flagged.where("__maybe").join(copies, ["set_a", "set_b", "doc_id"], "left_anti"), "told")
    nodes = flagged.where("not __maybe").unionByName(told).drop("__maybe")
    # Of two similar documents the smaller one has a common key among its first n - ceil(2t / (1 + t) * n) + 1.
    keyed = nodes.select(F.col("doc_id").alias("node"), "near", F.posexplode("keys").alias("at", "key")).select("key", "node", (F.col("at") < F.col("near")).alias("near"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key", "low")
    members = written(keyed.select("key", "node", "near").join(shared, "key").select("key", "node", "near", "low"), "members")
    points = nodes.select(F.col("doc_id").alias("node"), "n", "point").join(members.select("node").distinct(), "node", "left_semi")
    points = written(points.dropDuplicates(["node"]), "points")

    def side(name: str) -> DataFrame:
        return points.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("point").alias(f"point_{name}"))

    first = members.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()

    def bounded(pairs: DataFrame) -> DataFrame:
        """Of candidate pairs those whose whole points allow the threshold: far smaller than the sets that verify them."""
        return written(pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(_bounded(percent), "a bigint, b bigint"), "pairs")

    links = written(_verified(bounded(first), known, size, percent), "edges")
    comps = components(links)

    coarse = written(points.select("node", "n", F.pandas_udf(_coarse, "binary")("point").alias("point")), "coarse")

    # Keys that still hold several components get their trees, one per size class: similar documents are in one class
    # or in neighbouring ones, so each document has its home in its class and searches the next one too.
    # (Classes are wider than the threshold by a hair, so rounding cannot part two such documents by two classes.)
    band = F.floor(F.log(F.col("n").cast("double")) / (np.log(100 / percent) * (1 + 1e-9))).cast("int") if percent < 100 else F.col("n").cast("int")
    placed = members.join(points.select("node", "n"), "node").join(comps, "node", "left").select("key", "node", "near", F.coalesce("comp", "node").alias("comp"), band.alias("own"))
    placed = placed.withColumn("band", F.explode(F.array("own", F.col("own") + 1))).withColumn("inside", F.col("own") == F.col("band"))
    sizes = placed.groupBy("key", "band", "comp").agg(F.count("*").alias("k"), F.max("near").alias("near"), F.max("inside").alias("inside"))
    several = sizes.groupBy("key", "band").agg(F.sum("k").alias("members"), F.max_by("comp", "k").alias("main"), F.count("*").alias("parts"), F.max("near").alias("near"), F.max("inside").alias("inside"))
    several = several.where("parts > 1 and near and inside").select("key", "band", "members", "main", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    dealt = placed.drop("near", "own").join(several, ["key", "band"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # All trees of a document are known by now, so its earlier ones are.  They are those of the same class, where alone a pair can meet.
    dealt = dealt.join(coarse, "node")
    before = Window.partitionBy("node", "band").orderBy("key").rowsBetween(-EARLIER, -1)
    dealt = dealt.withColumn("earlier", F.collect_list("key").over(before))
    # The main component's documents meet the others, not each other: each goes to one block, the others to all.
    dealt = dealt.withColumn("block", F.explode(F.when((F.col("comp") == F.col("main")) & F.col("inside"), F.array("own")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = dealt.select("key", "band", "block", (F.col("inside") & (F.col("own") == F.col("block"))).alias("home"), "node", "comp", "n", "point", "earlier")
    trees = dealt.repartition("key", "band", "block").sortWithinPartitions("key", "band", "block", F.desc("home"))
    trees = trees.select("key", (F.col("band").cast("bigint") * (1 << 32) + F.col("block")).alias("block"), "home", "node", "comp", "n", "point", "earlier")
    more = written(trees.mapInPandas(_tree_pairs(percent), "a bigint, b bigint").distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    more = written(_verified(bounded(more), known, size, percent), "edges")
    return {
        "described": described, "classes": classes, "copies": copies, "points": points, "known": known,
        "first": links, "first_comps": comps, "more": more, "comps": components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more)),
    }
