import math
import random
import re
from collections import Counter

import numpy as np

from screenrank.llm import lexical_search
from screenrank.llm.lexical_search import mine, ranked_search, terms

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return PATTERN.findall(low)


def brute(docs, items, k):
    counts = [(i, Counter(split(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 100 - 50 + (50 * c.total() * n_docs) // n_terms
            s = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(split(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, k=lexical_search.K):
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item long")
    i = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, doc_id string")
    return sorted((tuple(r) for r in ranked_search(d.repartition(4), i, k).collect()), key=str)


def test_terms_follow_the_pattern():
    for t in ["A b-C_d", "naïve ÜBER ΑΣ x　y", "", None, "\x00a\x7fb@c[d`e{f", "İ ſ K 1２3", "\n\t"]:
        assert [x.decode() for x in terms(t)] == split(t)


def rows(seed, n, size):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(400)]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, size)))) for i in range(n)]


def test_equals_brute_force_over_several_blocks_and_passes(spark, monkeypatch):
    docs, items = rows(1, 150, 40), rows(2, 40, 15)
    want = brute(docs, items, 7)
    assert run(spark, docs, items, 7) == want
    monkeypatch.setattr(lexical_search, "PASS_TERMS", 120)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 50)
    monkeypatch.setattr(lexical_search, "MINED_BUNDLES", 3)
    assert run(spark, docs, items, 7) == want


def test_odd_rows(spark):
    docs = [(5, "same words here"), (3, "same words here"), (None, "same words here"), (3, "same words here"),
            (9, None), (10, ""), (11, "?!"), (12, "word " * 60_000 + "rare"), (13, "ÜBER über Über"), (14, "other text")]
    items = [(1, "Same WORDS"), (1, "words"), (None, "rare word"), (2, None), (3, "..."), (4, "über"), (5, "absent"), (1, "words")]
    got = run(spark, docs, items, 50)
    assert got == brute(docs, items, 50)
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == 4] == [13]


def test_empty_tables(spark):
    some = [(1, "a b")]
    assert run(spark, [], some) == run(spark, some, []) == run(spark, [], []) == run(spark, [(1, None)], some) == []


def test_shared_sums_are_computed_once():
    rng = random.Random(5)
    common = [f"c{i}".encode() for i in range(20)]
    items = [set(rng.sample(common, 12)) | {f"own{i}-{j}".encode() for j in range(5)} for i in range(60)]
    g = mine(items)
    assert sorted(t for b in g.bundles for t in b) == sorted(set().union(*items))
    value = {t: rng.randrange(10 ** 9) for t in set().union(*items)}
    sums = np.zeros((g.rows, 1), dtype=np.int64)
    sums[:len(g.bundles), 0] = [sum(value[t] for t in b) for b in g.bundles]
    assert g.evaluate(sums)[:, 0].tolist() == [sum(value[t] for t in x) for x in items]
    apart = sum(len(x) - 1 for x in items)  # additions without sharing
    assert len(g.left) < 0.5 * apart
    assert all(max(a, b) < len(g.bundles) + i for i, (a, b) in enumerate(zip(g.left, g.right)))


def test_one_item_and_equal_items():
    g = mine([{b"a", b"b"}, {b"a", b"b"}, {b"b"}])
    sums = np.array([[{b"a": 3, b"b": 5}[b[0]]] for b in g.bundles] + [[0]] * len(g.left))
    assert g.evaluate(sums)[:, 0].tolist() == [8, 8, 5]
