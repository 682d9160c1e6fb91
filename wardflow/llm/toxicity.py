"""Toxicity by misspelling-tolerant lexicon matching and context windows.

The lexicon is learnt from labelled texts: words and word stems that toxic texts have and others have not.  It is
kept as a trie; a Levenshtein automaton of each distinct word runs over the trie, so that terms written with an
edit are found without comparing the word with every term.  Every match is then judged in its window of words:
quoted or reported matches are counted apart from direct ones, and matches near each other weigh more.  A
logistic model over these counts gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, per_text, tune, written

# Labelled rows used to fit: a Bernoulli sample of about this many.
FIT_ROWS = 12_000
WINDOW = 12
FEATURES = ("direct", "misspelt", "quoted", "near", "share")
_WORD = re.compile(r"[^\W_]+")
_QUOTES = re.compile("[\"“”„«»‹›]")
# Words that report speech instead of using it (fixed values).
_REPORTING = frozenset("said says called calls word words term terms quote quoted insult insults slur wrote sagte nannte wort dit mot dijo palabra".split())
_STEMS = range(4, 9)


def terms_of(text: str | None) -> set[str]:
    """Distinct words, marked ``=``, and their beginnings of 4 to 8 letters, marked ``+``."""
    words = set(_WORD.findall(text.lower())) if text else set()
    return {"=" + w for w in words if len(w) >= 3} | {"+" + w[:n] for w in words for n in _STEMS if n <= len(w)}


def select_terms(counts: pd.DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, bool]]:
    """Terms as (letters, is a stem) from ``term, toxic, clean`` text counts.

    A term is in at least 4 and 2 % of the toxic texts and at most 2 % as frequent in the others.  Of a stem and its
    longer forms the longest with nearly the same texts stands for all.
    """
    least = max(4, 0.02 * n_toxic)
    good = counts[(counts["toxic"] >= least) & (counts["clean"] / max(1, n_clean) <= 0.02 * counts["toxic"] / max(1, n_toxic))]
    support = dict(zip(good["term"], good["toxic"]))
    best: dict[str, str] = {}
    for term in sorted(support, key=lambda t: (-support[t], t)):
        letters = term[1:]
        longer = [t for t in support if t != term and t[1:].startswith(letters) and (len(t) > len(term) or t[0] == "=") and support[t] >= 0.9 * support[term]]
        if term[0] == "+" and longer:
            continue
        best[term] = letters
    stems = {letters for term, letters in best.items() if term[0] == "+"}
    keep = [(letters, term[0] == "+") for term, letters in best.items() if not any(letters.startswith(s) and (s != letters or term[0] == "=") for s in stems)]
    return sorted(keep)


class Lexicon:
    """A trie of terms, searched with the Levenshtein automaton of a word."""

    def __init__(self, terms: list[tuple[str, bool]]) -> None:
        self.root: dict = {}
        self.longest = max((len(letters) for letters, _ in terms), default=0)
        self.heads: dict[int, set[str]] = {}
        self.parts: dict[tuple[int, int], set[str]] = {}
        for letters, stem in terms:
            node = self.root
            for c in letters:
                node = node.setdefault(c, {})
            node["stem" if stem else "end"] = edits = 1 if len(letters) >= 5 else 0
            # One edit leaves either half of a term whole: a word without any half in place needs no search.
            half = len(letters) // 2 if edits else len(letters)
            self.heads.setdefault(half, set()).add(letters[:half])
            if edits:
                for shift in (-1, 0, 1):
                    self.parts.setdefault((half + shift, len(letters) - half), set()).add(letters[half:])

    def distance(self, word: str) -> int | None:
        """Edits between the word and the nearest term within that term's limit; None if there is none."""
        if not any(word[:n] in held for n, held in self.heads.items()) and not any(word[at : at + n] in held for (at, n), held in self.parts.items()):
            return None
        best, n = None, len(word)
        # A state of the automaton: the positions of the word that are reachable with e edits, e = 0, 1.
        stack = [(self.root, frozenset([0]), frozenset([1]) if n else frozenset())]
        while stack:
            node, exact, edited = stack.pop()
            for kind in ("end", "stem"):
                limit = node.get(kind)
                if limit is None:
                    continue
                done = (lambda at: True) if kind == "stem" else (lambda at: at == n)
                if any(map(done, exact)):
                    return 0
                if limit and any(map(done, edited)):
                    best = 1
            for c, below in node.items():
                if len(c) > 1:
                    continue
                same = frozenset(i + 1 for i in exact if i < n and word[i] == c)
                # One edit: another letter here, a letter of the term left out, or, before, a letter of the word skipped.
                one = {i + 1 for i in edited if i < n and word[i] == c} | {i + 1 for i in exact if i < n} | set(exact) | {i + 1 for i in same if i < n}
                if same or one:
                    stack.append((below, same, frozenset(one)))
        return best


class Matcher(dict):
    """Word to its distance (-1: no term), remembered for up to ``limit`` words."""

    limit = 300_000

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        # The automaton never reads further than one letter behind the longest term.
        found = self.lexicon.distance(word[: self.lexicon.longest + 2])
        out = -1 if found is None else found
        if len(word) <= 60:  # longer words are looked up each time, so the memory for words stays bounded
            self[word] = out
        return out


def features(text: str | None, matcher: Matcher) -> list[float]:
    """Direct, misspelt, quoted and neighbouring matches (log counts), and the matches' share of the words."""
    if not text:
        return [0.0] * len(FEATURES)
    low = text.lower()
    words = _WORD.findall(low)
    at = [i for i, d in enumerate(map(matcher.__getitem__, words)) if d >= 0]
    if not at:
        return [0.0] * len(FEATURES)
    spans = [m.span() for m in _WORD.finditer(low)]
    direct = misspelt = quoted = near = 0
    for k, i in enumerate(at):
        start, end = spans[max(0, i - WINDOW)][0], spans[min(len(spans) - 1, i + WINDOW)][1]
        line = max(start, low.rfind("\n", 0, spans[i][0]) + 1)
        opened = len(_QUOTES.findall(low, line, spans[i][0])) % 2 == 1 and _QUOTES.search(low, spans[i][1], end) is not None
        if opened or not _REPORTING.isdisjoint(words[max(0, i - 4) : i]):
            quoted += 1
            continue
        direct += matcher[words[i]] == 0
        misspelt += matcher[words[i]] > 0
        near += k > 0 and i - at[k - 1] <= WINDOW
    return [math.log1p(direct), math.log1p(misspelt), math.log1p(quoted), math.log1p(near), len(at) / len(words)]


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and intercept (last) by Newton steps; classes weigh alike."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = y.mean()
    w = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (p - y)) / len(y) + l2 * beta / len(beta)
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x / len(y) + (l2 / len(beta)) * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS) -> tuple[list[tuple[str, bool]], np.ndarray | None]:
    """The lexicon and the model's weights, learnt from labelled rows that are not held out.

    About ``fit_rows`` labelled rows are used.  With labels of one class only, or none, there is no model.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    total = usable.count()
    # The sample's size is bounded by fit_rows, so it may be broadcast.
    sample = usable.sample(min(1.0, fit_rows / max(1, total)), 11)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "y")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                seen[y].update(terms_of(text))
                seen[y][""] += 1
        names = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"term": pd.Series(names, dtype=object), "toxic": [seen[1][t] for t in names], "clean": [seen[0][t] for t in names]})

    counted = rows.mapInPandas(count, "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # Terms of fewer than 4 toxic texts can't be chosen, nor those more frequent than the rates allow: the same test as
    # in select_terms, so that only terms that may be chosen come to the driver.  Their number is bounded by the sample.
    counted = written(counted, "terms")
    whole = counted.where("term = ''").first()
    rate = F.col("clean") / max(1, whole.clean if whole else 0) <= 0.02 * F.col("toxic") / max(1, whole.toxic if whole else 0)
    counts = counted.where((F.col("term") == "") | (F.col("toxic") >= 4) & rate).toPandas()
    whole = counts[counts["term"] == ""]
    if not len(whole) or not whole["toxic"].iloc[0] or not whole["clean"].iloc[0]:
        return [], None
    terms = select_terms(counts[counts["term"] != ""], int(whole["toxic"].iloc[0]), int(whole["clean"].iloc[0]))

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(Lexicon(terms))
        for batch in batches:
            out = [(*features(text, matcher), y) for text, y in zip(batch["text"], batch["y"])]
            yield pd.DataFrame(out, columns=[*FEATURES, "y"])

    table = rows.mapInPandas(examples, ", ".join(f"{f} double" for f in FEATURES) + ", y int").groupBy(*FEATURES, "y").count().toPandas()
    x = np.repeat(table[list(FEATURES)].to_numpy(), table["count"], axis=0)
    return terms, fit_logistic(x, np.repeat(table["y"].to_numpy(), table["count"]).astype(float))


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``, from every whole text.

    ``score`` is between 0 and 1, ``predicted`` is 1 from 0.5.  Null and empty texts have no match and get the model's
    score for none.  Without labels of both classes every score is 0.  Labels are learnt only from rows that are not
    held out; repeated rows and null ids each keep their row (a null id is not held out).
    """
    tune(df.sparkSession)
    docs = df.select(column(id_col).cast("bigint").alias("doc_id"), column(text_col).alias("text"))
    terms, beta = fit(docs, labels, label, fit_rows)

    def start():
        matcher = Matcher(Lexicon(terms))

        def one(text: str | None) -> tuple:
            if beta is None:
                return (0.0,)
            z = float(np.dot(features(text, matcher), beta[:-1]) + beta[-1])
            return (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))),)

        return one

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), per_text(start, "score double", F.col("text")).alias("r"))
    return scored.select("doc_id", "held_out", "r.score", (F.col("r.score") >= 0.5).cast("int").alias("predicted"))
