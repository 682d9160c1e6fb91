"""Lexical search, conversation repair and URL filters against brute force, and on odd inputs."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from wardflow.llm import conversations, lexical_search, url_filter

# -- lexical search


def terms_of(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def brute_search(docs, items, k):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    full = [c for _, c in held if c]
    n_docs, n_terms = len(full), sum(sum(c.values()) for c in full)
    df = Counter(t for c in full for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c in held:
            if c and doc is not None:
                m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms_of(text) if t in c)
                if score > 0:
                    scored.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture
def tables(spark):
    rng = random.Random(7)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)]
    docs = [(i, " ".join(rng.sample(words, rng.choice([3, 20, 60])))) for i in range(600)]
    docs += [(9, docs[9][1]), (700, None), (701, ""), (702, "!? \n"), (703, "Ünder Ünder über"), (None, docs[3][1]), (704, "w1 " * 30_000), *((i, docs[5][1]) for i in range(800, 830))]
    items = [(i, " ".join(rng.sample(words, 12))) for i in range(25)] + [(30, docs[5][1]), (30, docs[5][1]), (31, None), (32, ""), (33, "nothing here"), (34, "über ÜNDER under w1"), (None, "w1 w2 w2"), (0, "w3")]
    return docs, items, spark.createDataFrame(docs, "doc_id bigint, text string").withColumnRenamed("text", "a.b"), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("options", [{}, {"item_terms": 40}, {"k": 3}])
def test_search_equals_brute_force(tables, options):
    docs, items, df, asked = tables
    got = sorted((tuple(r) for r in lexical_search.search_items(df, asked, text_col="a.b", **options).collect()), key=str)
    assert got == brute_search(docs, items, options.get("k", 10))


def test_search_skips_blocks_and_stays_exact(tables, monkeypatch):
    """Small shards and blocks, a first search over a sample, and fewer documents scored than hold a term."""
    docs, items, df, asked = tables
    monkeypatch.setattr(lexical_search, "SHARD_ROWS", 100)
    monkeypatch.setattr(lexical_search, "BLOCK", 4)
    monkeypatch.setattr(lexical_search, "GROUPS", 64)
    monkeypatch.setattr(lexical_search, "SEED_ROWS", 50)
    got = sorted((tuple(r) for r in lexical_search.search_items(df, asked, text_col="a.b").collect()), key=str)
    assert got == brute_search(docs, items, 10)

    rng = np.random.default_rng(3)
    sizes = np.full(300, 8)
    terms = np.concatenate([np.sort(rng.choice(40, 8, replace=False)) for _ in sizes]).astype(np.int64)
    impacts, weights = rng.integers(1, 900_000, len(terms)), rng.integers(1, 5000, 40)
    shard = lexical_search.Shard(np.arange(300), sizes, terms, impacts, weights)
    opened = []
    monkeypatch.setattr(shard, "scores", lambda rows, dense, score=shard.scores: opened.append(len(rows)) or score(rows, dense))
    at, dense, best = np.array([1, 5, 17]), np.zeros(40, np.int64), lexical_search.Best(10, 0)
    dense[at] = weights[at]
    shard.search(at, weights[at], dense, best)
    every = (dense[terms] * impacts).reshape(300, 8).sum(axis=1)
    assert best.score.tolist() == sorted(every.tolist(), reverse=True)[:10]
    assert sum(opened) < np.count_nonzero(every)


def test_search_of_empty_tables(tables):
    _, _, df, asked = tables
    for d, i in ((df.where("false"), asked), (df, asked.where("false"))):
        assert lexical_search.search_items(d, i, text_col="a.b").collect() == []


# -- conversation repair


def brute_repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.findall("[^\x20\x09-\x0d]", text)
        faults.append(2 if not words else 3 if (role, text) in seen else 1 if words[-1] not in ".!?" else 0)
        seen.add((role, text))
    following, kept, names = {0: 2, 1: 2, 2: 3, 3: 2}, {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}, {2: "user", 3: "assistant"}

    @functools.cache
    def best(i, state, inserts):
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def go(cost, letter, rest, turn):
            if rest is not None:
                options.append((cost + rest[0], letter + rest[1], (() if turn is None else (turn,)) + rest[2]))

        new = following[state]
        if inserts < 3:
            go(2, "I", best(i, new, inserts + 1), names[new] + ":")
        if i < len(rows):
            _, role, text = rows[i]
            go(3, "D", best(i + 1, state, 0), None)
            if faults[i] < 2:
                if (role[:1], state) in kept:
                    go(faults[i], "K", best(i + 1, kept[role[:1], state], 0), role + ":" + text)
                go(2 + faults[i], "R", best(i + 1, new, 0), names[new] + ":" + text)
        return min(options) if options else None

    cost, audit, turns = best(0, 0, 0)
    initials, numbers = [r[1][:1] for r in rows], [r[0] for r in rows if r[0] is not None]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    return gaps, faults.count(2), faults.count(3), faults.count(1), illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest()


def brute_damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out[conv] += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {conv: brute_repair(held) for conv, held in out.items()}


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(1)
    texts = ["a.", "b! ", "c", "", "  ", None, "x" * 80 + "?", "x" * 80 + "!"]
    rows = []
    for conv in [*range(50), None]:
        for turn in range(rng.choice([1, 2, 3, 5, 12, 60])):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice([*texts, f"one {rng.randint(0, 99)}.", f"two {rng.randint(0, 99)}"])))
    return rows


@pytest.mark.parametrize("limits", [{}, {"rows_limit": 1}, {"rows_limit": 7}, {"chars_limit": 30}])
def test_repair_equals_brute_force(spark, chats, limits):
    """Whole conversations, and conversations cut into segments of every kind."""
    df = spark.createDataFrame(chats, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'clash' AS kind", "'clash' AS conv", "1 AS part")
    got = {r[0]: tuple(r)[1:] for r in conversations.repair_damaged(df, **limits).collect()}
    assert got == brute_damaged(chats)


def test_repair_of_the_given_table(spark, small):
    df = spark.read.parquet(f"{small}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in conversations.repair_damaged(df).collect()}
    assert got == brute_damaged([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_repaired_turns_alternate(spark, chats):
    df = spark.createDataFrame(chats, "conv_id bigint, turn bigint, role string, text string")
    rows = conversations.repair_turns(df.where("conv_id is not null"), rows_limit=9).orderBy("conv_id", "part", "seq", "step").collect()
    report = {r.conv_id: r.audit for r in conversations.repair_report(df).collect()}
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r.conv_id].append(r)
    for conv, steps in by_conv.items():
        assert "".join(r.edit for r in steps) == report[conv]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in steps if r.edit != "D"))


def test_repair_of_an_empty_table_and_a_lost_conversation(spark, chats):
    df = spark.createDataFrame(chats, "conv_id bigint, turn bigint, role string, text string")
    assert conversations.repair_damaged(df.where("false")).collect() == []
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = conversations.repair_damaged(spark.createDataFrame([(lost, 0, "user", "a.")], df.schema)).first()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_paths_by_doubling_equal_paths_step_by_step():
    rng = np.random.default_rng(5)
    n = 500
    target = np.arange(n) + rng.integers(1, 4, n)
    letter = rng.integers(1, 5, n).astype(np.int8)
    stop = (target >= n) | (rng.random(n) < 0.01)
    letter[stop], target[stop] = 0, np.flatnonzero(stop)
    starts = np.array([0, 7, 499, 20])
    rank, nodes, ends = conversations.least_paths(letter, target, starts)
    audits = []
    for v in range(n):
        audit = []
        while letter[v]:
            audit.append(letter[v])
            v = target[v]
        audits.append(tuple(audit))
    begin = 0
    for s, end in zip(starts, ends):
        assert tuple(letter[nodes[begin:end]]) == audits[s]
        begin = end
    order = sorted(set(audits))
    assert [order.index(a) for a in audits] == np.unique(rank, return_inverse=True)[1].tolist()


# -- URL filters

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("Example.com/de/", "block"), ("org/fr/", "allow"), ("a.b/", "block"), ("a.b/xy", "allow"), ("b/zz", "block"), ("ü.de/ß", "block"), ("twice/", "allow"), ("twice/", "block"), ("/no", "block"), (None, "block"), ("x/", "maybe")]
URLS = ["http://EXAMPLE.net/en/x?y", "http://example.net", "http://example.net/", "http://x.example.com/de/", "https://badexample.com/de/a", "://org/fr/", "x", None, "", "http://c.a.b/xyz", "http://ü.de/ßa#", "http://a.b/zz",
        "http://" + "a." * 50_000 + "b/zz?", "http://..net/", "http://twice/" + "p" * 100_000, "ftp://x/", "http://example.net/en/x?y", "http://u:p@org:8/fr/", "http://ORG/fr/\n#a"]


def brute_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("options", [{}, {"bits": 3}, {"list_bytes": 0}])
def test_urls_equal_brute_force(spark, options):
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(URLS)], "page_id bigint, url string, rule string, text string")
    known = [(r.split("/", 1)[0].lower(), "/" + r.split("/", 1)[1], v) for r, v in RULES if r and r.split("/", 1)[0] and v != "maybe"]
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(df, RULES, **options).collect()}
    assert got == {i: brute_judge(u, known) for i, u in enumerate(URLS)}
    kept = url_filter.filter_urls(df, RULES, **options)
    assert sorted(kept.columns) == ["host", "page_id", "path", "rule", "text", "url", "verdict"] and kept.count() == len(URLS)


@pytest.mark.parametrize("options", [{}, {"bits": 8}])
def test_urls_with_many_rules(spark, options):
    rng = random.Random(2)
    parts = ["a", "b", "cc", "d1", "e"]
    rules = [(".".join(rng.choices(parts, k=rng.randint(1, 3))) + "/" + "".join(rng.choices("xy/", k=rng.randint(0, 6))), rng.choice(["allow", "block"])) for _ in range(3000)]
    urls = ["http://" + ".".join(rng.choices(parts, k=rng.randint(1, 5))) + "/" + "".join(rng.choices("xy/?", k=rng.randint(0, 9))) for _ in range(400)]
    known = {}
    for r, v in rules:
        known[r] = max(v, known.get(r, ""))
    known = [(r.split("/", 1)[0], "/" + r.split("/", 1)[1], v) for r, v in known.items()]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(df, rules, **options).collect()}
    assert got == {i: brute_judge(u, known) for i, u in enumerate(urls)}


def test_urls_without_rules_and_without_rows(spark):
    df = spark.createDataFrame([(1, "http://a/b")], "page_id bigint, url string")
    assert url_filter.judge_urls(df, []).collect() == [(1, "a", "/b", None, "allow")]
    assert url_filter.judge_urls(df, [], otherwise="block").first().verdict == "block"
    assert url_filter.judge_urls(df.where("false"), RULES).collect() == []


def test_digests_are_those_of_the_jvm(spark):
    words = ["", "a", "net/", "é" * 40, "x" * 1000]
    rows = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) AS h").collect()
    assert all(np.uint64(xxhash.xxh64_intdigest(r.w.encode(), url_filter.SEED)).view(np.int64) == r.h for r in rows)
