"""Edge cases and brute-force versions of the text operators."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from wardflow.llm import bpe, classifier, decontaminate, graph, html, ngram_join, pii, rules, shards, token_files, toxicity
from wardflow.llm.common import written

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# -- n-gram join

def brute_components(docs, size, percent):
    sets, parent = {}, {}
    for i, text in docs:
        words = (text or "").encode().lower().split()
        sets[i] = frozenset([tuple(words)] if 0 < len(words) < size else [tuple(words[k : k + size]) for k in range(len(words) - size + 1)])
        parent[i] = i

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    u, v = root(a), root(b)
                    parent[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, small, size, percent):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, size=size, percent=percent).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()], size, percent)


def test_components_of_chains_at_the_threshold(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(60)] = f"x{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
        rows.append((100 + i, " ".join(base[:20] + [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 30))])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), size=4, percent=85).collect()}
    assert got == brute_components(rows, 4, 85)


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words)] if 0 < len(words) < size else [tuple(words[k : k + size]) for k in range(len(words) - size + 1)])


@pytest.mark.parametrize("side", [256, 8])
def test_links_inside_groups_of_near_copies(spark, monkeypatch, side):
    monkeypatch.setattr(ngram_join, "SIDE", side)
    rng = random.Random(7)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(80)] = f"x{rng.randrange(4)}"
        rows.append((i, " ".join(words)))
    rows += [(100, "no other like this one at all"), (101, None), (102, "u " + " ".join(base[40:]) * 2), (103, "u " + " ".join(base[40:]) * 2)]
    sets = {i: shingles(text, 4) for i, text in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    name = {i: min(k for k in sets if sets[k] == s) for i, s in sets.items() if s}
    docs = spark.createDataFrame([*rows, (None, "w1 w2")], "doc_id bigint, text string")
    links, members = ngram_join.jaccard_links(docs, size=4, percent=85)
    got = [(r.a, r.b) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == {tuple(sorted((name[a], name[b]))) for a, b in linked if name[a] != name[b]}
    assert {r.doc_id: r.node for r in members.collect()} == name
    counts = {r.doc_id: r.n_links for r in ngram_join.jaccard_components(docs, size=4, percent=85, n_links=True).collect()}
    assert counts == {i: sum(i in pair for pair in linked) for i in sets} | {None: None}


def test_components_of_odd_texts(texts, none):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(texts, size=4, percent=80).collect())
    assert [(g[1], g[3]) for g in got] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (5, 5), (6, 6), (7, 1), (8, 8), (9, 9), (0, None)]
    assert [g[2] for g in got][1:4] == [0, 0, 0]
    assert ngram_join.jaccard_components(none).count() == 0


def test_tree_finds_all_within_the_bound():
    rng = np.random.default_rng(1)
    points = rng.poisson(3, (500, ngram_join.GROUPS)).astype(np.int32)
    points[100:200] = points[:100] + (rng.random((100, ngram_join.GROUPS)) < 0.05)
    n = points.sum(axis=1)
    tree = ngram_join.CountTree(n, points)
    for i in range(0, 200, 7):
        low = np.minimum(points, points[i]).sum(axis=1)
        want = {j for j in range(500) if 100 * low[j] >= 85 * (n[j] + n[i] - low[j])}
        assert want <= set(tree.search(int(n[i]), points[i], 85).tolist())


def test_a_pair_that_meets_in_many_keys_is_told_once():
    rng = random.Random(8)
    point = ngram_join.packed(np.ones(ngram_join.GROUPS, np.int64))
    # Variants of one text: each has most of the keys, each key most of the variants, and two keys are shared by one pair only.
    keys_of = {i: sorted({k for k in range(60) if rng.random() < 0.7} | {100 + i // 2}) for i in range(30)}
    batches = []
    for key in sorted({k for keys in keys_of.values() for k in keys}):
        rows = [(key, 0, i % 3 > 0, i, i, ngram_join.GROUPS, point, [k for k in keys if k < key][-ngram_join.EARLIER :]) for i, keys in keys_of.items() if key in keys]
        names = ["key", "block", "home", "node", "comp", "n", "point", "earlier"]
        batches.append(pd.DataFrame(sorted(rows, key=lambda r: not r[2]), columns=names))
    told = [pair for out in ngram_join._tree_pairs(85)(iter(batches)) for pair in out.itertuples(index=False, name=None)]
    homes = {i for i in keys_of if i % 3}
    assert set(told) == {(a, b) for a in keys_of for b in keys_of if a < b and {a, b} & homes and set(keys_of[a]) & set(keys_of[b])}
    assert len(told) < 1.2 * len(set(told))


def test_graph_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (None, 1)], "a bigint, b bigint")
    assert {r.node: r.comp for r in graph.components(links).collect()} == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20}
    assert graph.components(links.where("false")).count() == 0


def shuffles(df):
    """Shuffles and broadcasts of a plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_graph_components_of_random_links_are_a_plain_table(spark):
    rng = random.Random(11)
    pairs = [(k, k + 1) for k in range(0, 60)] + [(200, k) for k in range(201, 260)] + [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(130)]
    pairs += [(b, a) for a, b in pairs[::3]] + pairs[::5]
    root = {k: k for pair in pairs for k in pair}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    found = graph.components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    rows = found.collect()
    linked = {k for a, b in pairs if a != b for k in (a, b)}
    assert len(rows) == len(linked) and {r.node: r.comp for r in rows} == {k: find(k) for k in linked}
    # What reads the components does not run the rounds again.
    assert shuffles(found) == 0


def test_stars_need_no_round(spark, monkeypatch):
    names = []
    monkeypatch.setattr(graph, "written", lambda df, name, write=graph.written: names.append(name) or write(df, name))
    stars = spark.createDataFrame([(k, k % 3) for k in range(3, 40)], "a bigint, b bigint")
    assert {r.node: r.comp for r in graph.components(stars).collect()} == {k: k % 3 for k in range(40)}
    assert names.count("links") == 1


def test_the_result_of_the_join_is_a_small_plan(spark, small):
    """The driver holds every plan while it runs: the last one reads the tables made before it, it does not make them again."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert shuffles(ngram_join.jaccard_components(docs, size=4, percent=85, n_links=True)) <= 3
    assert shuffles(ngram_join.jaccard_components(docs)) <= 3


# -- decontamination

@pytest.mark.parametrize("limit", [500_000, 200])
def test_hits_equal_brute_force(spark, small, limit):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    find = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for r in items.collect():
        words = find(r.text)
        k = min(13, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            windows.setdefault(tuple(words[i : i + k]), set()).add(r.item_id)
    got = {r.doc_id: r for r in decontaminate.benchmark_hits(docs, items, window_limit=limit).collect()}
    for r in docs.collect():
        words, hit, found = find(r.text), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if (own := windows.get(tuple(words[i : i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= own
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.items_sha256) == (len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))))
        assert g.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))


def test_hits_of_odd_texts(spark, texts, none):
    items = spark.createDataFrame([(1, "SHORT"), (2, None), (3, ""), (None, "end")], "item_id bigint, text string")
    got = decontaminate.mark_hits(texts, items).select("doc_id", "lang", "n_words", "hits.*").toDF("doc_id", "lang", "own", "n_words", "n_hit", "n_items", "d", "bad", "s").collect()
    assert sorted((r.doc_id or 0, r.n_hit) for r in got if r.bad) == [(5, 1), (5, 1)] and len(got) == 11
    assert decontaminate.mark_hits(none, items).count() == 0
    assert not any(r.hits.contaminated for r in decontaminate.mark_hits(texts, items.where("false")).collect())


def test_spans_are_removed(spark):
    docs = spark.createDataFrame([(1, "Keep this, drop THESE two words. End")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "these two words")], "item_id bigint, text string")
    marked = decontaminate.mark_hits(docs, items).withColumn("spans", decontaminate.F.col("hits.hit_spans"))
    assert marked.select(decontaminate.remove_spans("text", "spans").alias("t")).first().t == "Keep this, drop End"


# -- byte-level BPE

def test_ids_equal_the_library(spark, small, texts, none, ranks):
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in bpe.encode_digest(docs, ranks, PATTERN).collect()}
    for r in docs.collect():
        ids = own.encode_ordinary(r.text or "")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(r.text or ""))
    odd = bpe.encode(texts, ranks, PATTERN)
    assert sorted((r.doc_id or 0, r.ids) for r in odd.collect()) == sorted((r.doc_id or 0, own.encode_ordinary(r.text or "")) for r in texts.collect())
    back = {r.doc_id: r.text for r in bpe.decode(odd, ranks).where("doc_id <> 5").collect()}
    assert back == {r.doc_id: r.text or "" for r in texts.collect() if r.doc_id not in (None, 5)}
    assert bpe.encode(none, ranks, PATTERN).count() == 0


def test_pre_tokens_split_as_the_library_splits(ranks):
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    cut, rng = bpe.regex.compile(PATTERN).findall, random.Random(2)
    pool = [*"ab 1'\n\t \x1c\x85é٣Ⅷ²½中😀-_.", "  ", "\r\n", "'ll", "'s"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(25)))
        assert [i for w in cut(text) for i in own._encode_single_piece(w)] == own.encode_ordinary(text)


@pytest.mark.parametrize("top", [3, 255, 256, 70_000, 1 << 24])
def test_packed_numbers_come_back(top):
    numbers = np.array([0, 1, 254, 255, 256, top - 1, top, 7]) % (top + 1)
    assert bpe.unpack(bpe.pack(numbers), len(numbers)).tolist() == numbers.tolist()


# -- rules and shards

def test_rules_of_odd_texts(texts, none):
    got = {r.doc_id: r for r in rules.rule_report(texts).collect()}
    assert [got[i].n_words for i in (2, 3, 4, 8)] == [0, 0, 0, 1] and got[2].base_failed and not got[2].kept
    assert got[6].n_words == 30_001 and got[6].n_repeat_words == 30_000 and got[6].base_failed
    kept = rules.filter_by_rules(texts)
    assert kept.columns == texts.columns and {r.doc_id for r in kept.collect()} <= {1, 7}
    assert rules.filter_by_rules(none).count() == 0 and rules.rule_report(none).count() == 0


def test_cascade_order_does_not_change_the_verdict(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    a, b = (docs.select("doc_id", rules.verdict(order, docs["text"]).alias("v")).select("doc_id", "v.kept") for order in (list(rules.RULES), list(rules.RULES)[::-1]))
    assert sorted(a.collect()) == sorted(b.collect())


def test_cheapest_order():
    measured = pd.DataFrame({"rule": ["a", "b", "c"], "texts": 100, "rejected": [10, 40, 0], "seconds": [0.1, 1.0, 0.01]})
    assert rules.cheapest_order(measured) == ["a", "b", "c"]


def test_shards(spark, small, texts, none):
    docs = spark.read.parquet(f"{small}/documents.parquet").unionByName(texts.select("doc_id", "text"), allowMissingColumns=True)
    got = shards.assign_shards(docs, part_rows=3).toPandas()
    assert len(got) == docs.count()
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) <= {24} and set(got["shard"]) <= set(range(24))
    assert got.groupby("doc_id")["shard"].nunique().max() == 1
    assert shards.assign_shards(none).count() == 0


def test_weights_move_only_their_subtree(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "'' as text")
    tree = shards.even_tree(12, per_rack=2, racks=2)  # three regions of two racks of two shards
    heavier = {r: {k: dict(s) for k, s in racks.items()} for r, racks in tree.items()}
    heavier["region1"]["rack0"][4] = 3.0
    a, b = (shards.assign_shards(ids, t).toPandas().set_index("doc_id")["shard"] for t in (tree, heavier))
    moved = pd.DataFrame({"a": a, "b": b}).query("a != b")
    assert set(moved["b"]) <= set(s for rack in tree["region1"].values() for s in rack)
    assert abs((b == 4).mean() - 3 / 14) < 0.03


# -- personal data

def brute_spans(text):
    def luhn(digits):
        return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0

    digits = lambda s: [int(c) for c in s if c in "0123456789"]
    all_of = lambda p: [m for m in re.finditer(p, text)]
    return {
        "email": [m.span() for m in all_of(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")],
        "ip": [m.span() for m in all_of(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in all_of(r"[0-9]([\x20-]?[0-9])+") if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in all_of(r"\+[0-9][\x20().0-9-]+[0-9]") if 8 <= len(digits(m[0])) <= 15],
    }


def test_plain_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("aB1.@-+ (9012345é_%.@1.") for _ in range(rng.randrange(40)))
        assert pii.detect(text) == brute_spans(text)


def test_disguises_map_back_to_the_source():
    for text, kind, source in [
        ("mail jоhn.doe [at] mail5 [dot] example (dot) com now", "email", "jоhn.doe [at] mail5 [dot] example (dot) com"),
        ("call plus one two three four five six seven eight nine ok", "phone", "plus one two three four five six seven eight nine"),
        ("me at mail dot example dot com", "email", "me at mail dot example dot com"),
        ("card ４０４１ 8949 7460 8795.", "card", "４０４１ 8949 7460 8795"),
    ]:
        base, every = pii.find(text)
        assert [text[s:e] for s, e in every[kind]] == [source] and not base[kind]
        assert source not in pii.mask(text)
    assert pii.find("two horses at the mill, one dot on each")[1] == {k: [] for k in pii.KINDS}


def test_every_step_opens_the_gate():
    for text, kind, source in [("call plus 49 30 1234567 now", "phone", "plus 49 30 1234567"), ("me at adotb.com", "email", "me at adotb.com")]:
        assert [text[s:e] for s, e in pii.find(text)[1][kind]] == [source] and source not in pii.mask(text)
    rng, steps = random.Random(1), set()
    parts = ["plus ", "Plus ", "pluſ ", " 49", "(0", "one", "TWO", "ſeven", "oh", " at ", " AT ", "dot", " dot ", "[at]", "( dot )", "<.>", "{@}", "a", "mail", "b1", ".com", " ", ", ", "-", "İ", "о", "\u200b", "４"]
    for _ in range(100_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 8)))
        # A letter that the pattern finds by its case only is written as it is.
        assert pii.disguised(text) or pii.transduce(text).text == text, text
        glyphs, spelled, signs = ([m for m in step.finditer(text)] for step, _ in pii.STEPS)
        steps |= {"glyph" if list(pii._glyph(m)) else "none" for m in glyphs} | {"spelled" for _ in spelled} | {m.lastgroup for m in signs}
    assert steps == {"glyph", "none", "spelled", "at", "dot", "plus"}


def test_personal_data_of_odd_texts(texts, none):
    got = {r.doc_id: r for r in pii.find_personal_data(texts).collect()}
    assert got[2].base_sha256 == sha("") and got[2].spans == "" and len(got) == 10
    masked = pii.mask_personal_data(texts)
    assert masked.columns == texts.columns and masked.where("doc_id = 2").first().text is None
    assert pii.find_personal_data(none).count() == 0


# -- toxicity and quality

def test_lexicon_takes_one_edit():
    lexicon = toxicity.Lexicon([("idiot", False), ("lowei", True), ("scum", False)])

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            row, last = [i], row
            for j, d in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        return row[-1]

    rng = random.Random(5)
    for _ in range(4000):
        word = list(rng.choice(["idiot", "loweigs", "scum", "lowei"]))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(word) + 1)
            word[k : k + rng.randrange(2)] = rng.choice(["", "x", "o"])
        word = "".join(word)
        full = edits(word, "idiot")
        stem = min((edits(word[:n], "lowei") for n in range(len(word) + 1)), default=9)
        best = min(full if full <= 1 else 9, stem if stem <= 1 else 9, 0 if word == "scum" else 9)
        assert lexicon.distance(word) == (None if best == 9 else best), word


def test_quoted_terms_count_apart():
    matcher = toxicity.Matcher(toxicity.Lexicon([("idiot", False)]))
    assert toxicity.features('She wrote down "what an idiot he is" for us', matcher)[:3] == [0.0, 0.0, pytest.approx(np.log(2))]
    assert toxicity.features("you are an idit and an idiot", matcher)[:2] == [pytest.approx(np.log(2))] * 2
    assert toxicity.features(None, matcher) == toxicity.features("", matcher) == [0.0] * 5


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() >= 0.9 and got["score"].between(0, 1).all()


def test_toxicity_of_odd_texts(spark, texts, none):
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (3, None)], "doc_id bigint, toxic int")
    assert toxicity.score_toxicity(texts, labels).count() == 11
    assert {r.score for r in toxicity.score_toxicity(texts, labels.where("false")).collect()} == {0.0}
    assert toxicity.score_toxicity(none, labels).count() == 0


def test_quality_classifier_agrees_with_labels(spark, texts, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.classify_quality(docs).join(labels, "doc_id").toPandas()
    assert got[got["quality"] == 1]["kept"].mean() >= 0.95 and got[got["quality"] == 0]["kept"].mean() <= 0.25
    odd = {r.doc_id: r for r in classifier.classify_quality(texts).collect()}
    assert not odd[2].kept and odd[2].score == 0.0 and len(odd) == 10
    assert classifier.classify_quality(none).count() == 0


# -- token files

def test_counts_are_stitched_over_blocks(spark, tmp_path, texts, none, ranks):
    rng = np.random.default_rng(6)
    want = {}
    for name, closed in (("a", True), ("b", False), ("c", True)):
        sizes = rng.choice([0, 0, 1, 3, 50, 400], 60)
        ids = np.concatenate([np.append(rng.integers(0, 9, s), 9) for s in sizes]).astype("<u2")
        (ids if closed else ids[:-1]).tofile(tmp_path / f"{name}.bin")
        want[name] = [(k, int(s)) for k, s in enumerate(sizes) if closed or k < 59 or s]
    blocks = token_files.read_token_files(spark, str(tmp_path), block_ids=37)
    got = token_files.count_document_tokens(blocks, 9).toPandas()
    got["name"] = got["file"].str.extract(r"/(\w)\.bin")
    assert {n: list(zip(g["doc_no"], g["n_tokens"])) for n, g in got.sort_values("doc_no").groupby("name")} == want
    assert all((np.diff(g.sort_values("doc_no")["start"]) == g.sort_values("doc_no")["n_tokens"][:-1] + 1).all() for _, g in got.groupby("name"))
    streams = written(token_files.flat_tokens(texts, ranks, PATTERN, 50256, block_ids=100), "test")
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert sorted(r.n_tokens for r in token_files.count_document_tokens(streams, 50256).collect()) == sorted(len(own.encode_ordinary(r.text or "")) for r in texts.collect())
    assert token_files.count_document_tokens(streams.where("false"), 50256).count() == 0


def test_token_files_are_read_in_ranges(spark, tmp_path, texts, ranks):
    # A sparse file above 2 GB: only its separators are not zero.
    size = (1 << 31) + (1 << 20)
    with open(tmp_path / "large file.bin", "wb") as out:
        for at in (10, 1 << 29, size // 2 - 1):
            out.seek(2 * at)
            out.write(b"\x09\x00")
    (tmp_path / "empty.bin").touch()
    blocks = token_files.read_token_files(spark, str(tmp_path), block_ids=1 << 22)
    assert [(r.doc_no, r.n_tokens) for r in token_files.count_document_tokens(blocks, 9).orderBy("doc_no").collect()] == [(0, 10), (1, (1 << 29) - 11), (2, size // 2 - 2 - (1 << 29))]
    folder = f"{tmp_path}/streams"
    token_files.write_token_files(token_files.flat_tokens(texts, ranks, PATTERN, 50256, block_ids=100), folder)
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = token_files.count_document_tokens(token_files.read_token_files(spark, folder, block_ids=70), 50256)
    assert sorted(r.n_tokens for r in got.collect()) == sorted(len(own.encode_ordinary(r.text or "")) for r in texts.collect())
    token_files.write_token_files(token_files.flat_tokens(texts.where("false"), ranks, PATTERN, 50256), f"{folder}-none")
    assert token_files.count_document_tokens(token_files.read_token_files(spark, f"{folder}-none"), 50256).count() == 0
    (tmp_path / "streams" / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple"):
        token_files.read_token_files(spark, folder).count()


# -- main text

def test_main_text_of_the_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    cut = re.compile(r"</?(?:p|h1)>")

    def want(page):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in cut.split(article)]
        return "\n".join(b for b in blocks if b)

    source = {r.page_id: r.html for r in pages.collect()}
    for r in html.extract_main_text(pages).collect():
        assert r.text == want(source[r.page_id]) and r.n_chars == len(r.text)


def test_main_text_of_other_layouts(spark, small):
    model = html.fit(spark.read.parquet(f"{small}/pages.parquet"))
    para = "This is a full sentence of the story, and it goes on for a while to say what happened there. " * 3
    page = (
        f'<body><div class="topbar"><a href="/">Home</a> <a href="/x">News</a></div><div class="cookie-notice"><p>We use cookies to give you a better page.</p></div>'
        f'<div class="post-content"><h1>A title</h1><p>{para}</p><p>Second &amp; last. {para}</p></div><aside><p>Read this one too.</p></aside>'
        f'<div class="comments"><p>First! I liked this one a lot.</p></div><form><label>Your mail</label><input></form><div class="footer">&copy; us</div></body>'
    )
    assert html.main_text(page, model) == f"A title\n{para.strip()}\nSecond & last. {para.strip()}"


def test_pages_of_odd_kinds(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>"), (None, "u", "no markup at all"), (5, "u", "<div>" * 3000 + "deep" + "</p>" * 10), (5, "u", "<article><p>a</article><!-- x"), (6, "u", "<script>" + "x" * 100_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    got = html.extract_main_text(pages).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got) and html.extract_main_text(pages.where("false")).count() == 0
    assert {r.text for r in got if r.page_id in (1, 2, 3, 6)} == {""}


def test_main_text_without_blocks(spark, small):
    model = html.fit(spark.read.parquet(f"{small}/pages.parquet"))
    para = "This is a full sentence of the story, and it goes on for a while to say what happened there. " * 3
    nav, foot = '<nav><a href="/">Home</a> <a href="/x">News</a></nav>', '<footer>&copy; us</footer>'
    whole = f"{para}Then <b>more</b> of it.<br>Second. {para}"
    flat = f"{para}Then more of it. Second. {para.strip()}"
    assert html.main_text(f"<html><head><title>x</title></head><body>{nav}{whole}{foot}</body></html>", model) == flat
    assert html.main_text(f"<body>{nav}<h1>A title</h1>{whole}{foot}</body>", model) == f"A title\n{flat}"
    assert html.main_text(whole, model) == flat
    formula = f"<body>{nav}<article><p>{para}</p><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <object data='a.svg'>a drawing</object>. {para}</p></article>{foot}</body>"
    assert html.main_text(formula, model) == f"{para.strip()}\nHere x=2 and a drawing. {para.strip()}"
