import random

import numpy as np
import pytest

from screenrank.llm import ngram_join
from screenrank.llm.ngram_join import (_keyed, _labelled, deep_enough, linked, match_forest, missed_links,
                                       ngram_links, one_per_class, prefix_depth, trie_nodes)
from screenrank.llm.words import shingles

SCHEMA = "doc_id long, text string, class_id string"


def brute(rows, threshold=0.8):
    """doc_id -> (class, copy_of, links, texts) by comparing all pairs."""
    sets = {i: frozenset(shingles(t).tolist()) for i, t in rows}
    link = {i: {j for j in sets if i != j and sets[i] and sets[j]
                and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9} for i in sets}
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        same = [j for j in sets if sets[j] == sets[i] and sets[i]] or [i]
        out[i] = (min(seen), min(same), len(link[i]), len({sets[j] for j in link[i]} - {sets[i]}))
    return out


def texts(seed, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 120, 400]))]
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((n, rng.choice([" ", "\n", ", "]).join(words)))
            n += 1
    return rows


def as_dict(df):
    return {r.doc_id: (r.class_id, r.copy_of, r.n_links, r.n_texts) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"chunk_texts": 3, "chunk_shingles": 400}])
def test_equals_all_pairs_also_when_components_are_cut_into_chunks(spark, options):
    rows = texts(1)
    df = spark.createDataFrame([(i, t, None) for i, t in rows], SCHEMA)
    assert as_dict(ngram_links(df, **options)) == brute(rows)


def test_defined_results_for_odd_rows(spark):
    long_text = " ".join(f"x{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "?! ..."), (4, "one two"), (5, "One, two!"), (6, long_text),
            (7, long_text + " tail"), (None, "one two"), (8, "zwölf Übel über Äpfel öffnen"),
            (9, "ZWÖLF übel ÜBER äpfel Öffnen"), (4, "one two"), (4, "one two")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in ngram_links(df).collect()), key=str)
    assert got == sorted([(1, 1, 1, 0, 0), (2, 2, 2, 0, 0), (3, 3, 3, 0, 0), (5, 4, 4, 4, 0), (None, 4, 4, 4, 0),
                          (6, 6, 6, 1, 1), (7, 6, 7, 1, 1), (8, 8, 8, 1, 0), (9, 8, 8, 1, 0)] + 3 * [(4, 4, 4, 4, 0)], key=str)
    kept = one_per_class(df)
    assert kept.columns == ["doc_id", "text", "class_id"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "8"]


def test_rows_that_share_an_id_or_have_none_go_by_their_own_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " tail"), (1, c), (None, b), (None, c + " tail"), (None, "only here in this row"),
            (None, "only here in this row"), (None, None), (3, b.upper()), (4, "clean text of five words"), (None, a)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in ngram_links(df).collect()), key=str)
    want = [(1, 1, 1, 2, 1), (1, 1, 1, 2, 0), (2, 1, 2, 2, 1), (1, 1, 1, 1, 1), (None, 1, 1, 2, 0), (None, 1, None, 1, 1),
            (None, None, None, 1, 0), (None, None, None, 1, 0), (None, None, None, 0, 0), (3, 1, 1, 2, 0), (4, 4, 4, 0, 0),
            (None, 1, 1, 2, 1)]
    assert got == sorted(want, key=str)
    kept = sorted(((r.doc_id, r.text) for r in one_per_class(df).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (1, c), (None, "only here in this row"), (None, None),
                           (4, "clean text of five words")], key=str)


def test_empty_table(spark):
    assert ngram_links(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shortest_prefix_follows_from_the_target_recall():
    assert prefix_depth(0.8, 24, 5, 0.9999) == 5
    assert prefix_depth(0.8, 24, 6, 0.99999) == 4
    with pytest.raises(ValueError):
        prefix_depth(0.1, 2, 5, 0.99999)


def test_missed_links_are_those_a_simulation_misses():
    rng = np.random.default_rng(3)
    common = rng.random((40_000, 4, 3)) < 0.85  # 4 trees, 3 values each
    met = common.all(axis=2).any(axis=1).sum()
    least = missed_links({}, 3, 0.8, 4)
    assert missed_links({850: int(met)}, 3, 0.8, 4) - least == pytest.approx(40_000 - met, rel=0.1)
    assert not deep_enough({}, 6, 0.8, 24, 0.99999)  # no links, no evidence
    assert deep_enough({990: 1000}, 6, 0.8, 24, 0.99999)
    assert not deep_enough({990: 1000, 800: 200}, 6, 0.8, 24, 0.99999)


def _forest(spark, rows):
    docs = _keyed(spark.createDataFrame(rows, "doc_id long, text string"), "text")
    ids, reps = _labelled(docs, 24, 6)
    return reps, match_forest(reps, ids, docs, 0.8, 24, 6, 0.99999, 1 << 18, 1024)


def test_prefixes_shorten_only_as_far_as_the_similarities_ask(spark):
    def group(g, n, step):  # texts of 200 words of which each has changed one, ``step`` words from the last
        base = [f"g{g}w{i}" for i in range(200)]
        return [" ".join(base[:k * step] + [f"new{k}"] + base[k * step + 1:]) for k in range(1, n)]

    close = [t for g in range(4) for t in group(g, 12, 1)]
    reps, (found, depth, chunked) = _forest(spark, list(enumerate(close)))
    assert (depth, chunked) == (6, False)
    far = [" ".join(f"f{g}w{i + s}" for i in range(60)) for g in range(60) for s in (0, 6)]  # Jaccard 50 / 62
    _, (found, depth, _) = _forest(spark, list(enumerate(close + far)))
    assert depth < 6
    assert found.agg({"linked_texts": "sum"}).first()[0] == 4 * 11 * 10 + 2 * 60
    nodes = [{(r.rep, r.node) for r in trie_nodes(reps, 24, 6, d).collect()} for d in (6, 4)]
    assert len({n for _, n in nodes[0]}) > len({n for _, n in nodes[1]})  # shorter prefixes, fewer nodes


def test_linked_counts_exactly_across_column_slices():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 9000, 6000).astype(np.uint64)) for _ in range(6)]
    sets.append(sets[0][:-3])
    every = np.arange(len(sets))
    got = linked(sets, every, every, 0.45)
    for i in every:
        for j in every:
            both = len(np.intersect1d(sets[i], sets[j]))
            assert got[i, j] == (both / (len(sets[i]) + len(sets[j]) - both) >= 0.45)


def test_joined_local_labels_need_several_rounds(spark):
    from screenrank.llm.common import components

    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.id: r.label for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert ngram_join.CHUNK_TEXTS > 1


def test_labels_join_what_all_pairs_below_a_node_join():
    rng = np.random.default_rng(5)
    least = ngram_join.least_agreeing(0.8, 144)
    assert 80 < least < 100
    base = rng.integers(0, 60_000, (4, 144))
    labels = base[rng.integers(0, 4, 90)]
    changed = rng.random((90, 144)) < rng.choice([0.02, 0.1, 0.3, 0.45], (90, 1))
    labels[changed] = rng.integers(0, 60_000, changed.sum())
    labels = labels.astype(np.uint16)

    def classes(edges):
        root = list(range(90))
        for a, b in edges:
            root = [root[a] if r == root[b] else r for r in root]
        return sorted(sorted(i for i in range(90) if root[i] == r) for r in set(root))

    alike = labels[:, None] == labels[None]
    node = alike.reshape(90, 90, 24, 6)[..., :4].all(axis=3).any(axis=2)
    want = classes(np.argwhere(node & (alike.sum(axis=2) >= least)).tolist())
    got = ngram_join.close_below_nodes(np.arange(90), labels, 24, 4, least)
    assert classes(got) == want and len(want) > 4


def test_texts_strung_together_by_chance_are_not_dealt_as_one_component(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(f"new{i}x{k}" if rng.random() < 0.08 else f"w{k}" for k in range(120))) for i in range(200)]
    rows += [(200 + i, rows[i][1].replace("w60 ", f"other{i} ")) for i in range(5)]
    df = spark.createDataFrame([(i, t, None) for i, t in rows], SCHEMA)
    _, reps = _labelled(_keyed(df, "text"), 24, 6)
    sizes = ngram_join._candidates(reps, 24, 6, 4, 0.8, 1 << 18, 50).groupBy("comp").count()
    assert max(r["count"] for r in sizes.collect()) < 20  # nodes alone join most of the 205
    want = brute(rows)
    assert as_dict(ngram_links(df, chunk_texts=50)) == want
    monkeypatch.setattr(ngram_join, "LABEL_TEXTS", 10)  # larger components: compared node by node
    assert as_dict(ngram_links(df, chunk_texts=50)) == want
    assert as_dict(ngram_links(df, chunk_texts=3)) == want


def test_what_is_no_longer_read_leaves_the_disk(spark):
    from screenrank.llm.common import components, dropped, saved

    def folders(name):
        fs = spark._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.checkpoint.dir"))
        return [s.getPath().getName() for s in fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(fs)
                if s.getPath().getName().startswith(name)]

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"), "rounds-of-a-chain")
    assert len(folders("rounds-of-a-chain")) == 1
    table = saved(spark.range(3), "to-be-dropped")
    dropped(table)
    assert folders("to-be-dropped") == [] and spark.conf.get(key, None) == before
