"""Long and odd inputs, former limits, and plain versions of operators that SQL cannot express."""

import math
import struct
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardflow.llm import classifier, html, ngram_join, pii, shards, toxicity

# -- linear time on long texts


@pytest.mark.parametrize("page", [
    "<a " * 350_000, '<a "' * 100_001 + ">", "<a \'>" * 99_999, "<iframe>" * 100_000, "</p>" * 100_000, "<!-" * 100_000, "<!--" * 100_000, '<a b="' * 100_001 + ">", "<p>x" * 100_000,
    "<div>" * 100_000 + "deep" + "</div>" * 100_000, "<div>" * 50_000 + "</p>" * 50_000,
], ids=range(11))
def test_long_pages_take_linear_time(page):
    began = time.time()
    nodes = html.nodes_of(html.parse(page))
    html.describe(nodes)
    html.decode(nodes, np.full(len(nodes), 0.9))
    html.text_of(nodes[0])
    assert time.time() - began < 20


def test_end_tags_of_deep_elements_match():
    root = html.parse("<div id=a>" + "<div>" * 450 + "</div>" * 450 + "<p>after</p></div>")
    assert [c.tag for c in root.children] == ["div"] and root.children[0].children[-1].tag == "p"


def test_siblings_are_all_described():
    root = html.parse("<ul>" + "<li>ab" * 99 + "<li>abcdefgh" + "</ul>")
    rows = html.describe(html.nodes_of(root))
    assert rows[-1][13] == np.float32(99 / 100) and rows[-1][15] == 1.0 and rows[2][16] == np.float32(2 / 8)


@pytest.mark.parametrize("page,text", [("<article><p>one <svg><text>two</text></svg> three</article>", "one two three"), ("<article><canvas>old</canvas> new<noscript>off</noscript></article>", "old new off"), ("a < b <p>c", "a < b c"), ("x <b", "x <b")])
def test_only_scripts_and_forms_are_dropped_unread(page, text):
    nodes = html.nodes_of(html.parse(page))
    html.decode(nodes, np.full(len(nodes), 0.9))
    assert " ".join(html.text_of(nodes[0]).split()) == text


def test_many_addresses_and_one_disguise_take_linear_time():
    text = "a@b.cd " * 100_000 + "x [at] y [dot] z"
    began = time.time()
    base, every = pii.find(text)
    assert time.time() - began < 20 and len(every["email"]) == len(base["email"]) + 1 == 100_001


# -- composed disguises


@pytest.mark.parametrize("text,kind,found", [
    ("write john [\u0430t] example [d\u043et] com now", "email", "john [\u0430t] example [d\u043et] com"),
    ("john \uff41\uff54 example dot com", "email", "john \uff41\uff54 example dot com"),
    ("call plus f\u043eur nine three one two three four five", "phone", "plus f\u043eur nine three one two three four five"),
    ("ruf plus vier neun drei null eins eins eins zwei an", "phone", "plus vier neun drei null eins eins eins zwei"),
    ("appelle plus trois trois un deux quatre cinq six sept", "phone", "plus trois trois un deux quatre cinq six sept"),
    ("llama m\u00e1s tres cuatro seis uno dos tres cinco ocho", "phone", "m\u00e1s tres cuatro seis uno dos tres cinco ocho"),
    ("juan arroba ejemplo punto com", "email", "juan arroba ejemplo punto com"), ("1 dot 2 punkt 3 point 4", "ip", "1 dot 2 punkt 3 point 4"),
    ("jo\u00adhn [at] ex\u200bample [dot] com", "email", "jo\u00adhn [at] ex\u200bample [dot] com"),
])
def test_disguises_within_disguises(text, kind, found):
    base, every = pii.find(text)
    assert [text[s:e] for s, e in every[kind]] == [found] and base[kind] == []
    assert pii.disguised(text)


def test_each_character_knows_its_source():
    text = "a\u200bb plus \uff14\uff19 [at] o\u043fe [d\u043et]"
    out = pii.transduce(text)
    assert len(out.text) == len(out.starts) == len(out.ends) and (out.starts < out.ends).all() and (np.diff(out.starts) >= 0).all()


# -- toxicity


def test_long_words_are_looked_up():
    matcher = toxicity.Matcher(toxicity.Lexicon([("stupid", True), ("dumb", False)]))
    assert matcher["stupidest"] == 0 and matcher["stupid" + "o" * 60] == 0 and matcher["stupjd" + "x" * 100] == 1
    assert matcher["dumb" + "x" * 100] == -1 and matcher["x" * 100] == -1
    assert "+stup" in toxicity.terms_of("stupid" + "o" * 60)


def test_rare_toxic_texts_still_teach(spark):
    """Under 2 % of the labelled texts are toxic; the term is in more clean texts than toxic ones, but at a low rate."""
    rows = [(i, "zork zork bad words here" if i < 20 else "zork once in a clean text" if i < 45 else f"plain words number {i} here") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(4000)], "doc_id bigint, toxic int")
    terms, _ = toxicity.fit(docs, labels)
    kept = [i for i in range(45) if __import__("zlib").crc32(str(i).encode()) % 5]
    toxic, clean = sum(i < 20 for i in kept), sum(i >= 20 for i in kept)
    assert clean > toxic and any(letters.startswith("zork") for letters, _ in terms)


# -- quality classifier


def test_expectation_maximisation_equals_a_plain_one():
    rng = np.random.default_rng(2)
    votes = rng.integers(0, 3, (40, 4))
    counts = rng.integers(1, 9, 40)
    prior, table, posterior = classifier.expectation_maximisation(votes, counts.astype(float), rounds=7)
    texts = [tuple(v) for v, n in zip(votes.tolist(), counts) for _ in range(n)]
    start = {(j, c, v): x for j in range(4) for c, row in enumerate(((0.3, 0.6, 0.1), (0.002, 0.898, 0.1))) for v, x in enumerate(row)}
    p, share = dict(start), 0.8
    for _ in range(7):
        good = {}
        for t in set(texts):
            one, zero = share, 1 - share
            for j, v in enumerate(t):
                one, zero = one * p[j, 1, v], zero * p[j, 0, v]
            good[t] = one / (one + zero)
        share = min(1 - 1e-4, max(1e-4, sum(good[t] for t in texts) / len(texts)))
        for j in range(4):
            for c in (0, 1):
                seen = {v: len(texts) / 20 * start[j, c, v] + sum(good[t] if c else 1 - good[t] for t in texts if t[j] == v) for v in range(3)}
                for v in range(3):
                    p[j, c, v] = seen[v] / sum(seen.values())
    assert share == pytest.approx(prior) and all(p[j, c, v] == pytest.approx(table[j, c, v]) for j in range(4) for c in (0, 1) for v in range(3))
    assert [good[tuple(v)] for v in votes.tolist()] == pytest.approx(posterior.tolist())


def test_scores_equal_a_plain_version():
    facts = classifier.Votes("The cat saw THE cat, 3 times!")
    at, n = classifier.hashed(facts, classifier.Slots(), classifier.Shapes())
    slots, value = classifier.unpacked(at, n)
    half = classifier.DIMENSIONS // 2
    for part, table in ((slots < half, classifier.Slots()), (slots >= half, classifier.Shapes())):
        count = Counter(table[w] for w in facts.words)
        norm = math.sqrt(sum(count.values()))
        assert dict(zip(slots[part].tolist(), value[part].tolist())) == pytest.approx({s: math.sqrt(k) / norm for s, k in count.items()})


def test_verdicts_do_not_depend_on_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one, other = ({r.doc_id: (r.posterior, r.score) for r in classifier.classify_quality(docs.repartition(n)).collect()} for n in (3, 7))
    assert one == other


# -- n-gram join


def test_bit_map_lets_every_marked_id_through(spark):
    ids = spark.range(0, 3000, 3).withColumnRenamed("id", "doc_id")
    flagged = ngram_join.flag_possible(spark.range(3000).withColumnRenamed("id", "doc_id"), ngram_join.marks_of(ids))
    got = {r.doc_id for r in flagged.where("__maybe").collect()}
    assert got >= set(range(0, 3000, 3)) and len(got) < 1100
    assert ngram_join.flag_possible(ids, ngram_join.marks_of(ids.where("false"))).where("__maybe").count() == 0


# -- sharding


def plain_place(key, tree):
    best = None
    for racks in tree.values():
        for held in racks.values():
            for shard, weight in held.items():
                seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
                u = ((xxhash.xxh64_intdigest(f"shard{shard}".encode(), seed) >> 11) + 1) * 2.0**-53
                best = min(best or (math.inf, 0), (-math.log(u) / weight, shard))
    return best[1]


@pytest.mark.parametrize("n", [1, 5, 24, 25])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    ids = [*range(3000), -7, 2**60, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    now, more, grown = shards.even_tree(n), shards.even_tree(n + 1), shards.grown_tree(shards.even_tree(n))
    rows = df.select("doc_id", *[shards.place(F.col("doc_id"), t).alias(c) for t, c in ((now, "now"), (more, "more"), (grown, "grown"))]).collect()
    for r in rows:
        assert r.now == plain_place(r.doc_id, now) and r.more == r.grown and r.more in (r.now, n)
    share = sum(r.more == n for r in rows) / len(rows)
    assert abs(share - 1 / (n + 1)) < 0.05
