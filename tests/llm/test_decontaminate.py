import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from screenrank.llm.decontaminate import (clean_documents, contaminated, hamming_index, neighbours, numbered, simhash,
                                          weighted_jaccard)
from screenrank.llm.words import word_hashes


def grams(text):
    w = word_hashes(text).tolist()
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(docs, items, threshold=0.8):
    """(doc, item) -> (best similarity, first start) over all item-sized windows."""
    out = {}
    for i, t in docs:
        d = grams(t)
        for k, u in items:
            b = Counter(grams(u))
            n = sum(b.values())
            if not n or not d:
                continue
            for s in range(max(1, len(d) - n + 1)):
                w = Counter(d[s:s + n])
                both = sum((w & b).values())
                sim = both / (sum(w.values()) + n - both)
                if sim >= threshold and sim > out.get((i, k), (0, 0))[0]:
                    out[i, k] = (sim, s)
    return out


def data(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(500)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(words(rng.randint(12, 60)))) for k in range(8)]
    items.append((8, "again and " * 20))
    docs = []
    for i in range(60):
        body = words(rng.randint(5, 200))
        if i % 3 == 0:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 0, 1, 3])):  # substitute, insert or drop a word
                at = rng.randrange(len(passage))
                passage[at:at + rng.randint(0, 1)] = words(rng.randint(0, 1))
            at = rng.randrange(len(body))
            body[at:at] = passage
        docs.append((i, " ".join(body).upper() if i % 2 else ", ".join(body)))
    return docs, items


def test_equals_brute_force_over_all_windows(spark):
    docs, items = data(3)
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): (r.similarity, r.start) for r in got.collect()} == want
    assert len(want) > 5 and any(s < 1 for s, _ in want.values())


def test_odd_rows_and_clean_documents(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = [(1, None, 7), (2, "", 7), (3, "too few words", 7), (4, "x " * 50_000 + item, 7), (5, item, 7),
            (5, "other text of more than five words", 7), (None, item, 7), (6, " ".join(item.split()[:10]), 7)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    b = spark.createDataFrame([(10, item, 1), (11, None, 1), (12, "short", 1), (None, item, 1), (10, item, 1)],
                              "item_id long, text string, doc_id long")
    got = [(r.doc_id, r.item_id, r.similarity, r.start) for r in contaminated(d, b).collect()]
    assert sorted(got, key=str) == sorted([(i, k, 1.0, 50_000 if i == 4 else 0) for i in (4, 5, None) for k in (10, None)], key=str)
    kept = clean_documents(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id, r.text[:5] if r.text else "") for r in kept.collect()) == [
        (1, ""), (2, ""), (3, "too f"), (5, "other"), (6, item[:5])]  # each row by its own text
    assert contaminated(d.limit(0), b).count() == 0 and contaminated(d, b.limit(0)).count() == 0


def test_index_holds_every_fingerprint_within_the_radius(spark):
    rng = random.Random(1)
    item = rng.getrandbits(64) - 2 ** 63
    near = []
    for k in range(200):
        flipped = item
        for b in rng.sample(range(64), 22):
            flipped ^= -(1 << 63) if b == 63 else 1 << b
        near.append((k, flipped))
    index = hamming_index(spark.createDataFrame([(1, item)], "item_id long, fp long"), 22, 8)
    probes = spark.createDataFrame(near, "k long, fp long").select("k", F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), F.shiftright("fp", 8 * b).bitwiseAND(255).alias("key"))
        for b in range(8)])).alias("p")).select("k", "p.*")
    assert probes.join(index, ["block", "key"]).select("k").distinct().count() == 200
    assert len(neighbours(8, 2)) == 1 + 8 + 28


def test_simhash_takes_the_majority_of_each_bit(spark):
    rng = random.Random(2)
    rows = [(g, rng.getrandbits(64) - 2 ** 63) for g in range(3) for _ in range(4 + g)]
    got = {r.g: r.fp for r in simhash(spark.createDataFrame(rows, "g long, h long"), "g").collect()}
    for g in range(3):
        hs = [h for k, h in rows if k == g]
        fp = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hs) > len(hs))
        assert got[g] == (fp - 2 ** 64 if fp >= 2 ** 63 else fp)


def test_weighted_jaccard_counts_repeats(spark):
    df = spark.createDataFrame([([1, 1, 2, 3], [(1, 3), (4, 1)], 4)],
                               "w array<long>, g array<struct<h:long,n:long>>, t int")
    assert df.select(weighted_jaccard("w", "g", "t")).first()[0] == 2 / 6


def test_no_python_in_the_plan(spark):
    d = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    plan = contaminated(d, d.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_changes_in_a_refrain_are_found(spark):
    """One word changed in each of four refrains: similarity 0.8, and every such document is found."""
    rng = random.Random(1)
    items, docs = [], []
    for k in range(150):
        refrain = [f"r{rng.random()}".replace(".", "x") for _ in range(20)]
        verses = [[f"v{rng.random()}".replace(".", "x") for _ in range(26)] for _ in range(4)]
        changed = refrain[:10] + [f"c{k}"] + refrain[11:]
        items.append((k, " ".join(w for v in verses for w in refrain + v)))
        docs.append((k, " ".join(w for v in verses for w in changed + v)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(d, i).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k, _ in items}
    # SimHash by counts alone leaves some of them beyond the radius
    prints = [simhash(df.select("k", F.explode(F.transform("sh", lambda x: F.xxhash64(x))).alias("h")), "k")
              for df in (spark.createDataFrame([(k, [" ".join(map(str, g)) for g in grams(t)]) for k, t in rows],
                                               "k long, sh array<string>") for rows in (items, docs))]
    far = prints[0].join(prints[1].withColumnRenamed("fp", "o"), "k").where(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("o"))) > 22)
    assert far.count()


def test_numbered_tells_repeats_apart(spark):
    row = spark.createDataFrame([([5, 3, 5, 5],), ([1, 2],)], "sh array<long>").select(numbered("sh").alias("n")).collect()
    assert len(set(row[0].n)) == 4 and {3, 5} <= set(row[0].n) and row[1].n == [1, 2]


def test_items_under_five_words_match_as_whole_sequences(spark):
    docs = [(1, "Tell me: what is LOVE? What is love?"), (2, "what is a love"), (3, "Love"), (4, "love love"), (5, "a b c d"),
            (None, "what, is love"), (6, "a b c d e"), (7, None), (8, "word " * 30_000 + "what is love")]
    items = [(1, "What is love?"), (2, "love"), (3, "a b c d"), (None, "b c"), (5, "?"), (6, "a b c d"), (7, "zz")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start)
           for r in contaminated(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1): (1.0, 2), (None, 1): (1.0, 0), (8, 1): (1.0, 30_000), (3, 2): (1.0, 0), (5, 3): (1.0, 0),
                   (6, 3): (1.0, 0), (5, 6): (1.0, 0), (6, 6): (1.0, 0), (5, None): (1.0, 1), (6, None): (1.0, 1)}
    assert sorted(r.doc_id for r in clean_documents(d, spark.createDataFrame(items, "item_id long, text string")).collect()) == [2, 4, 7]


def test_items_too_long_to_count_are_an_error(spark):
    d = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    b = spark.range(1).selectExpr("id AS item_id", "repeat('a b ', 1100000) AS text")
    with pytest.raises(ValueError, match="shingles"):
        contaminated(d, b)
