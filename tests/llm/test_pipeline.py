"""The pipeline against its operators applied by hand, and each stage on odd rows."""

import zlib

import numpy as np

import corpus_pipeline
from screenrank.llm import quality
from screenrank.llm.catalogue import tokenizer_path
from screenrank.llm.mixing import mix
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as brute_contaminated
from tests.llm.test_ngram_join import brute as brute_links


def test_run_equals_the_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality.train(docs, labels)
    good = {i for i, r in rows.items() if model.score(np.array([quality.statistics(r.text)]))[0] >= 0.3}
    links = brute_links([(i, rows[i].text) for i in sorted(good)])
    first = {i for i in good if links[i][0] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {i for i, _ in brute_contaminated([(i, rows[i].text) for i in sorted(first)], items)}
    clean = first - leaks
    assert len(rows) > len(good) > len(first) > len(clean) > 0
    copies = {r.doc.doc_id: r.copies for r in mix(docs.where(docs.doc_id.isin(list(clean)))).collect()}

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    want, at = [], 0
    for i in sorted(clean):
        ids = library.encode(rows[i].text, add_special_tokens=False).ids + [2]
        for _ in range(copies[i]):
            want.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
            at += len(ids)
    got = sorted((tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect()), key=lambda r: r[1])
    assert got == want


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", "s", 0, 0.1), (2, "", None, None, None, 0.2), (None, "no id", "en", "s", 5, 0.3),
         (3, "fine words here. " * 20_000, "en", "s", 1, 0.4), (3, "fine words here. " * 20_000, "en", "s", 1, 0.4)],
        "doc_id long, text string, lang string, source string, n_chars long, score double")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.count() >= 0, name
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing",
                                                      "token_files"]
