import random
import re

import pytest

from screenrank.llm.line_dedup import dedup_lines
from screenrank.llm.passage_dedup import dedup_passages

SCHEMA = "doc_id long, text string, removed string"


def brute(docs, run_words):
    """doc_id -> words deleted: those in a window that stands at an earlier place."""
    first, gone = {}, {}
    for i, t in docs:
        w = re.findall(r"[^ \t\n\x0b\x0c\r]+", t)
        gone[i] = set()
        for s in range(len(w) - run_words + 1):
            at = first.setdefault(tuple(w[s:s + run_words]), (i, s))
            if at[0] != i or s >= at[1] + run_words:
                gone[i].update(range(s, s + run_words))
    return gone


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_equals_all_common_runs_of_words(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") + str(k) for _ in range(rng.randint(4, 40))] for k in range(8)]
    passages.append(["x", "y", "x"] * 12)  # repeats within itself
    docs = []
    for i in range(40):
        words = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            words += p[a:rng.randint(a, len(p))] + [f"own{i}"] * rng.randint(0, 2)
        docs.append((i, "".join(w + rng.choice([" ", " ", "\n", " \n\t"]) for w in words)))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    out = {r.doc_id: r for r in dedup_passages(df, run_words=10, seed_words=4).collect()}
    want = brute(docs, 10)
    assert {i: r.removed for i, r in out.items()} == {i: len(g) for i, g in want.items()} and any(want.values())
    assert {i: r.text.split() for i, r in out.items()} == \
        {i: [w for n, w in enumerate(t.split()) if n not in want[i]] for i, t in docs}


def test_passage_that_begins_and_ends_inside_lines(spark):
    passage = [f"p{k}" for k in range(55)]
    rows = [(1, "Alpha begins here " + " ".join(passage) + " and ends.\nlast"),
            (2, "x\nOther host " + "\n".join(" ".join(passage[k:k + 11]) for k in range(0, 55, 11)) + " closing words\ny"),
            (3, " ".join(passage[:49]) + " only 49 words"),
            (4, "first\n" + " ".join(passage[2:54]) + "\nlast é")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.text, r.removed) for r in dedup_passages(df).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("x\nOther host closing words\ny", 55), 3: (rows[2][1], 0),
                   4: ("first\nlast é", 52)}
    # whole lines alone don't reach it
    assert {r.removed for r in dedup_lines(df).where("doc_id < 4").collect()} == {0}


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, f"{long}\nown\n{long}"), (None, long), (5, "w " * 100_000),
            (5, "w " * 100_000), (6, long), (6, "a " + long)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    out = dedup_passages(df)
    assert out.columns == ["doc_id", "text", "removed"] and out.count() == len(rows)
    got = sorted((r.doc_id or 0, r.removed, r.text is None or len(r.text.split())) for r in out.collect())
    # of one word over and over, all but the first window and those that overlap it repeat
    assert got == [(0, 0, 60), (1, 0, True), (2, 0, 0), (3, 0, 0), (4, 120, 1), (5, 99_950, 50), (5, 99_950, 50),
                   (6, 60, 0), (6, 60, 1)]
    assert dedup_passages(df.limit(0)).count() == 0
