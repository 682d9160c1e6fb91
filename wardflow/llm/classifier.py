"""A quality classifier without labels: heuristic labellers, expectation maximisation, a hashed linear scorer.

Each labeller votes good, bad or abstains.  Only how often each combination of votes occurs matters for the
estimate, so all documents are counted and expectation maximisation runs over the distinct combinations.  A text is
read once: its votes and the slots of its words are written, and everything after works on those.  The
posterior of a combination labels a bounded sample of documents, which trains a linear scorer on hashed words and
word shapes; the scorer then judges every document by its text alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, per_text, tune, written
from .rules import Facts

DIMENSIONS = 1 << 15
# Documents that train the scorer: about this many, chosen by a hash of id and text.
FIT_ROWS = 6_000


def _ratio(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def _vote(value: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
    """1 inside ``good``, 0 inside ``bad``, None-like 2 (abstains) elsewhere."""
    return 1 if good[0] <= value <= good[1] else 0 if bad[0] <= value <= bad[1] else 2


_INF = math.inf
_MARK = re.compile(rb"[#*$%&|<>]").search
_PLAIN = dict.fromkeys(b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ \t\n\v\f\r")


class Votes(Facts):
    """Facts with what only the labellers ask for."""

    @cached_property
    def n_letters(self) -> int:
        """Characters that are no white space, ASCII digit or ASCII sign."""
        signs = len(self.raw) - len(self.raw.translate(None, bytes(_PLAIN)))
        return len(self.text) - signs

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")


LABELLERS = {
    "length": lambda f: 0 if len(f.words) < 10 else 1 if len(f.words) >= 80 else 2,
    "symbols": lambda f: _vote(_ratio(f.n_symbols, f.word_chars), (0, 0.005), (0.03, _INF)),
    "marked": lambda f: _vote(_ratio(sum(1 for w in f.words if _MARK(w)), len(f.words)), (0, 0.01), (0.1, _INF)),
    "letters": lambda f: _vote(_ratio(f.n_letters, f.word_chars), (0.92, 1), (0, 0.88)),
    "shouting": lambda f: _vote(_ratio(f.n_shouted, len(f.words)), (0, 0.03), (0.2, _INF)),
    "lines": lambda f: _vote(_ratio(f.n_dup_lines, len(f.lines)), (0, 0.05), (0.4, _INF)),
    "windows": lambda f: _vote(_ratio(f.n_repeat_words, len(f.words)), (0, 0.1), (0.4, _INF)),
    "echoes": lambda f: _vote(_ratio(f.n_echoes, len(f.words)), (0, 0.03), (0.2, _INF)),
    "vocabulary": lambda f: 2 if len(f.words) < 50 else 0 if len(f.words) > 4 * (int(f.ids.max()) + 1) + 400 else 1,
    "stops": lambda f: _vote(_ratio(sum(map(f.text.count, ".?")), len(f.words)), (0.02, 0.3), (0.6, _INF)) if f.words else 0,
}
NAMES = tuple(LABELLERS)


def votes_of(facts: Votes) -> int:
    """All votes as one number, three values per labeller; a text without words is voted on like any other."""
    out = 0
    for name in NAMES:
        out = 3 * out + LABELLERS[name](facts)
    return out


def unfold(pattern: np.ndarray) -> np.ndarray:
    """Votes per labeller (columns) of packed patterns."""
    return np.stack([pattern // 3**k % 3 for k in range(len(NAMES) - 1, -1, -1)], axis=1)


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Prior of good, P(vote | class) as [labeller, class, vote], and the posterior of good per pattern.

    Votes are independent given the class.  A labeller knows one defect: it seldom blames a good text and often
    passes a text that is bad for another reason.  The start says so, and so does a Dirichlet prior that weighs as
    much as a twentieth of all texts.
    """
    prior, table = 0.8, np.empty((votes.shape[1], 2, 3))
    table[:, 0], table[:, 1] = (0.3, 0.6, 0.1), (0.002, 0.898, 0.1)
    expected = table * counts.sum() / 20
    posterior = np.full(len(votes), prior)
    for _ in range(rounds):
        logs = [np.log(p) + sum(np.log(table[j, c, votes[:, j]]) for j in range(votes.shape[1])) for c, p in ((0, 1 - prior), (1, prior))]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(new - posterior).max() < 1e-7:
            break
        posterior = new
        prior = float(np.clip((counts * posterior).sum() / counts.sum(), 1e-4, 1 - 1e-4))
        for c, weight in ((0, counts * (1 - posterior)), (1, counts * posterior)):
            for j in range(votes.shape[1]):
                seen = np.bincount(votes[:, j], weights=weight, minlength=3) + expected[j, c]
                table[j, c] = seen / seen.sum()
    return prior, table, posterior


class Slots(dict):
    """Word to hashed slot; forgets all when it holds ``limit`` words."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word) % (DIMENSIONS // 2)
        return out


class Shapes(Slots):
    """Word to the slot of its shape: letter case, and what is neither letter nor digit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        marks = word.translate(None, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        case = b"U" if len(word) > 2 and word.upper() == word and word.lower() != word else b"l"
        key = case + bytes(b for b in marks if b < 128)[:4]
        self[word] = out = DIMENSIONS // 2 + xxhash.xxh3_64_intdigest(key) % (DIMENSIONS // 2)
        return out


def hashed(facts: Facts, slots: Slots, shapes: Shapes) -> tuple[bytes, bytes]:
    """Distinct slots of the words, then of their shapes, in order, with their counts: what the scorer reads of a text."""
    words = facts.words
    out = [np.unique(np.fromiter(map(table.__getitem__, words), np.int64, len(words)), return_counts=True) for table in (slots, shapes)]
    return tuple(np.concatenate([o[k] for o in out]).astype(kind).tobytes() for k, kind in ((0, "<u2"), (1, "<u4")))


def unpacked(at: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots with their values: the square root of each count, to unit length, for words and shapes apart."""
    slots, counts = np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(n, "<u4").astype(float)
    words = int(np.searchsorted(slots, DIMENSIONS // 2))
    value = np.sqrt(counts)
    for part, total in ((slice(0, words), counts[:words].sum()), (slice(words, None), counts[words:].sum())):
        value[part] /= math.sqrt(total) if total else 1.0
    return slots, value


def _read():
    """Votes and slots of a text, in one reading."""
    slots, shapes = Slots(), Shapes()

    def one(text: str | None) -> tuple:
        facts = Votes(text)
        return votes_of(facts), *hashed(facts, slots, shapes)

    return one


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 80, rate: float = 20.0, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient descent with momentum; classes weigh alike."""
    of = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    at, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    share_good = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    # Each row's weight is its good part over the good total plus its bad part over the bad total.
    good, bad = 0.5 * target / share_good / len(rows), 0.5 * (1 - target) / (1 - share_good) / len(rows)
    w, b, vw, vb = np.zeros(DIMENSIONS), 0.0, np.zeros(DIMENSIONS), 0.0
    for _ in range(rounds):
        z = np.bincount(of, weights=w[at] * value, minlength=len(rows)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        error = (good + bad) * p - good
        vw = 0.9 * vw - rate * (np.bincount(at, weights=error[of] * value, minlength=DIMENSIONS) + l2 * w)
        vb = 0.9 * vb - rate * 0.05 * error.sum()
        w, b = w + vw * 0.1, b + vb * 0.1
    # The scorer should not lose what the label model calls good: 0.5 % of those examples may fall below one half.
    z = np.bincount(of, weights=w[at] * value, minlength=len(rows)) + b
    if (target >= 0.5).any():
        b -= min(0.0, float(np.quantile(z[target >= 0.5], 0.005)))
    return w.astype(np.float32), float(b)


def classify_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: ``doc_id, posterior, score, kept``.

    ``posterior`` is the label model's probability of good from the votes on the whole text, ``score`` that of the
    trained scorer; rows from 0.5 are kept.  Null and empty texts have no words: they score 0 and are not kept.
    Vote combinations are counted over all rows, repeated ones included; of equal rows one may train the scorer.  The
    result depends on the rows only, not on their partitions.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    tune(spark)
    # Which rows train the scorer depends on the rows alone, not on how they are dealt over partitions.
    docs = df.select(column(id_col).cast("bigint").alias("doc_id"), column(text_col).alias("text")).withColumn("pick", F.xxhash64("doc_id", "text"))
    shape = "pattern bigint, at binary, n binary"
    read = written(docs.select("doc_id", "pick", per_text(_read, shape, F.col("text")).alias("r")).select("doc_id", "pick", "r.*"), "votes")

    seen = read.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").toPandas()
    if not len(seen):
        return docs.select("doc_id", F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    known = seen["pattern"].to_numpy()
    posterior = dict(zip(known.tolist(), expectation_maximisation(unfold(known), seen["n"].to_numpy(float))[2].tolist()))

    every = max(1, int(seen["n"].sum()) // fit_rows)
    sample = read.where(F.pmod("pick", F.lit(every)) == 0).dropDuplicates(["pick"]).select("pick", "pattern", "at", "n").collect()
    sample.sort(key=lambda r: r["pick"])
    rows = [unpacked(r["at"], r["n"]) for r in sample]
    weights, bias = fit_linear(rows, np.array([posterior[r["pattern"]] for r in sample])) if rows else (np.zeros(DIMENSIONS, np.float32), 0.0)
    model = spark.sparkContext.broadcast((weights, bias, posterior))

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        w, b, known = model.value
        for patterns, at, n in batches:
            out = []
            for x, k in zip(at, n):
                slots, value = unpacked(x, k)
                z = float((w[slots] * value).sum() + b)
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) if len(slots) else 0.0)
            yield pd.DataFrame({"posterior": [known[p] for p in patterns], "score": out})

    scored = read.select("doc_id", F.pandas_udf(run, "posterior double, score double").asNondeterministic()("pattern", "at", "n").alias("r"))
    return scored.select("doc_id", "r.posterior", "r.score", (F.col("r.score") >= 0.5).alias("kept"))
