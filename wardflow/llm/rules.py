"""Quality rules as a short-circuit cascade.

Every rule is a test of one text that either passes or rejects it; a text is kept if no rule rejects it.  The
verdict does not depend on the order, the cost does: each rule's seconds and rejections are measured on a sample,
and the rules run in the order of the best ratio of rejections per second until one rejects.
"""

from __future__ import annotations

import itertools
import re
import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, per_text, share, tune

SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_SHOUT = re.compile(rb"[^a-z]*[A-Z][^a-z]*").fullmatch


class Facts:
    """What the rules look at, each computed when first asked for."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """Lines with a word."""
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def ids(self) -> np.ndarray:
        number = defaultdict(itertools.count().__next__)
        return np.fromiter(map(number.__getitem__, self.words), np.int64, len(self.words))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in 3-word windows that occur twice or more."""
        ids, n = self.ids, len(self.ids)
        if n < 4:
            return 0
        # Windows as numbers: of pairs first, so that any number of distinct words fits 64 bits.
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        _, at, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
        again = times[at] > 1
        hit = np.zeros(n, bool)
        for i in range(3):
            hit[i : n - 2 + i] |= again
        return int(hit.sum())

    @cached_property
    def n_shouted(self) -> int:
        """Words of two bytes or more with an A-Z and no a-z."""
        return sum(1 for w in self.words if len(w) > 1 and _SHOUT(w))

    @cached_property
    def n_echoes(self) -> int:
        """Words equal to the word before."""
        return int((self.ids[1:] == self.ids[:-1]).sum())


# Name and test; true rejects.  Integer arithmetic, so SQL gives the same verdicts.
RULES: dict[str, Callable[[Facts], bool]] = {
    "few_words": lambda f: len(f.words) < 50,
    "repeated_windows": lambda f: 100 * f.n_repeat_words > 50 * len(f.words),
    "symbols": lambda f: 100 * f.n_symbols > 5 * f.word_chars,
    "shouting": lambda f: 100 * f.n_shouted > 30 * len(f.words),
    "repeated_lines": lambda f: 100 * f.n_dup_lines > 50 * len(f.lines),
    "echoes": lambda f: 100 * f.n_echoes > 30 * len(f.words),
    "word_length": lambda f: not 2 * len(f.words) <= f.word_chars <= 15 * len(f.words),
}


def measure(df: DataFrame, text_col: str = "text", rules: Sequence[str] | None = None, sample_rows: int = 2000, seed: int = 7) -> pd.DataFrame:
    """``rule, texts, rejected, seconds`` of each rule by itself on a Bernoulli sample of about ``sample_rows`` texts."""
    names = list(RULES if rules is None else rules)
    sample = df.select(column(text_col).alias("text")).sample(share(df, sample_rows), seed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {name: [0, 0, 0.0] for name in names}
        for batch in batches:
            for text in batch["text"]:
                for name in names:
                    facts = Facts(text)  # anew: what rules share is charged to each
                    begin = time.perf_counter()
                    rejects = RULES[name](facts)
                    total[name][2] += time.perf_counter() - begin
                    total[name][0] += 1
                    total[name][1] += rejects
        yield pd.DataFrame([(name, *t) for name, t in total.items()], columns=["rule", "texts", "rejected", "seconds"])

    shape = "rule string, texts bigint, rejected bigint, seconds double"
    return sample.mapInPandas(run, shape).groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("texts", "rejected", "seconds")]).toPandas()


def cheapest_order(measured: pd.DataFrame) -> list[str]:
    """Rules by rejections per second, best first; rules that reject nothing come last, the cheapest first."""
    rate = measured["rejected"] / measured["texts"].clip(lower=1)
    cost = (measured["seconds"] / measured["texts"].clip(lower=1)).clip(lower=1e-9)
    return measured.assign(worth=rate / cost, cost=cost).sort_values(["worth", "cost", "rule"], ascending=[False, True, True])["rule"].tolist()


def plan(df: DataFrame, text_col: str = "text", rules: Sequence[str] | None = None, sample_rows: int = 2000) -> list[str]:
    """The order in which the cascade should run; rules without any sampled text keep their given order."""
    names = list(RULES if rules is None else rules)
    order = cheapest_order(measure(df, text_col, names, sample_rows))
    return order + [name for name in names if name not in order]


def verdict(order: Sequence[str], text: Column) -> Column:
    """A struct ``kept, rejected_by``: the first rule in ``order`` that rejects the text, null if none does."""
    order = list(order)

    def start():
        tests = [(name, RULES[name]) for name in order]

        def one(text: str | None) -> tuple:
            facts = Facts(text)
            for name, test in tests:
                if test(facts):
                    return False, name
            return True, None

        return one

    return per_text(start, "kept boolean, rejected_by string", text)


def filter_by_rules(df: DataFrame, text_col: str = "text", rules: Sequence[str] | None = None, sample_rows: int = 2000) -> DataFrame:
    """The rows of ``df`` whose text no rule rejects, unchanged.

    Null and empty texts have no words and go by ``few_words`` (and stay if that rule is not asked for).  Repeated rows
    are judged alike; other columns are not looked at.
    """
    tune(df.sparkSession)
    order = plan(df, text_col, rules, sample_rows)
    return df.withColumn("__verdict", verdict(order, column(text_col))).where("__verdict.kept").drop("__verdict")


def rule_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2000) -> DataFrame:
    """Per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    The counts are made for every text; ``kept`` is the verdict of the cascade, whose base rules (``few_words``,
    ``repeated_windows``) are answered by the counts.  Null and empty texts: all counts 0, base failed, not kept.
    """
    tune(df.sparkSession)
    base = ("few_words", "repeated_windows")
    rest = [name for name in plan(df, text_col, None, sample_rows) if name not in base]

    def start():
        tests = [RULES[name] for name in rest]

        def one(text: str | None) -> tuple:
            f = Facts(text)
            failed = any(RULES[name](f) for name in base)
            return len(f.words), f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, failed, not failed and not any(test(f) for test in tests)

        return one

    shape = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"
    return df.select(column(id_col).cast("bigint").alias("doc_id"), per_text(start, shape, column(text_col)).alias("r")).select("doc_id", "r.*")
