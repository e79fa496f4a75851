import random

import pytest

from screenrank.llm.line_dedup import blocks, dedup_lines, fingerprints, windows

SCHEMA = "doc_id long, text string, removed string"


def brute(docs, run_words):
    """doc_id -> kept text, from all common runs of lines of all places."""
    seqs = {}
    for i, t in docs:
        seqs[i] = [(n, x.strip(" \t\n\x0b\x0c\r")) for n, x in enumerate(t.split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    gone = {i: set() for i, _ in docs}
    for b in seqs:
        for a in seqs:
            if a >= b:
                continue
            sa, sb = seqs[a], seqs[b]
            for q in range(len(sb)):
                for p in range(len(sa)):
                    n = 0
                    while q + n < len(sb) and p + n < len(sa) and sb[q + n][1] == sa[p + n][1]:
                        n += 1
                    if n and sum(len(x.split()) for _, x in sb[q:q + n]) >= run_words:
                        gone[b].update(range(sb[q][0], sb[q + n - 1][0] + 1))
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in docs}


def corpus(seed):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) + f" l{k}" for k in range(40)]
    passages = [[rng.choice(lines) for _ in range(rng.randint(2, 6))] for _ in range(6)]
    docs = []
    for i in range(30):
        body, fresh = [], 0
        for _ in range(rng.randint(1, 6)):
            if rng.random() < 0.5:
                body += rng.choice(passages)
            elif rng.random() < 0.3:
                body.append(rng.choice(["", "  "]))
            else:
                body.append(f"own line {i} {fresh} " + "x " * rng.randint(0, 9))
                fresh += 1
        docs.append((i, "\n".join(body)))
    return docs


def unrepeated(docs):
    """Documents that don't repeat a line within themselves."""
    out = []
    for i, t in docs:
        seen, keep = set(), []
        for x in t.split("\n"):
            if not x.strip() or x.strip() not in seen:
                keep.append(x)
            seen.add(x.strip())
        out.append((i, "\n".join(keep)))
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_equals_all_common_runs(spark, seed):
    docs = unrepeated(corpus(seed))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    got = {r.doc_id: r.text for r in dedup_lines(df, run_words=12).collect()}
    want = brute(docs, 12)
    assert got == want and any(want[i] != t for i, t in docs)


def by_windows(docs, run_words):
    """doc_id -> kept text: every window against the first place of its content."""
    first, spans = {}, {}
    for i, t in docs:
        lines, _, found = windows(t, run_words)
        text = t.split("\n")
        spans[i] = [(tuple(text[n].strip() for n in lines[s:e]), lines[s], lines[e - 1]) for s, e, _ in found]
        for content, a, b in spans[i]:
            first[content] = min(first.get(content, (i, a, b)), (i, a, b))
    out = {}
    for i, t in docs:
        gone = {n for c, a, b in spans[i] if first[c][0] != i or a > first[c][2] for n in range(a, b + 1)}
        out[i] = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
    return out


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_equals_every_window_also_where_documents_repeat_themselves(spark, seed):
    rng = random.Random(seed)
    docs = corpus(seed) + [(100 + i, "\n".join(rng.choice(["tick tock", "tick tock", "one two three", "last"])
                                              for _ in range(40))) for i in range(6)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    assert {r.doc_id: r.text for r in dedup_lines(df, run_words=12).collect()} == by_windows(docs, 12)


def test_fingerprints_are_fewer_than_windows_and_equal_windows_share_them(spark):
    rng = random.Random(9)
    passage = [f"line {k} of a passage" for k in range(60)]
    docs = [(i, "\n".join([f"own {i} {rng.random()}"] * 3 + passage[rng.randint(0, 9):] + [f"end {i}"])) for i in range(8)]
    for _, text in docs:
        found = blocks(text, 50)
        spans = windows(text, 50)[2]
        assert len(found) < len(spans) / 3 and sum(len(b[4]) for b in found) == len(spans)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    marks = fingerprints(df).groupBy("mark").count().collect()
    assert max(r["count"] for r in marks) >= len(docs)


def test_repeats_within_a_document_and_odd_rows(spark):
    long_line = "word " * 60
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, f"{long_line}\nown\n{long_line}"), (5, f"a\n{long_line}"),
            (None, long_line.strip()), (6, "w " * 100_000), (6, "w " * 100_000), (7, "short\nlines"), (8, "short\nlines")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "lines", "removed"]
    got = {(r.doc_id, r.text and r.text[:5], r.lines, r.removed) for r in out.collect()}
    # the row without an id comes first and keeps the line
    assert got == {(1, None, None, 0), (2, "", 1, 0), (3, "\n \n", 3, 0), (4, "own", 3, 2), (5, "a", 2, 1),
                   (None, "word ", 1, 0), (6, "w w w", 1, 0), (7, "short", 2, 0), (8, "short", 2, 0)}
    assert out.count() == len(rows) and dedup_lines(df.limit(0)).count() == 0
