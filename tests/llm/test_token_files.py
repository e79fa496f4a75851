import zlib

import numpy as np
import pytest

from screenrank.llm.catalogue import op9_token_files, tokenizer_path
from screenrank.llm.token_files import read_token_files, token_index, write_token_files
from screenrank.session import scratch_path
from tests.conftest import SF_SMALL

ODD = ["", None, " \n\t ", "Hello, WORLD!! don't I'LL", "naïve ÜBER straße Ÿ", "a\x1cb \x1c", "é word́ x́y",
       "İstanbul ΑΣ. ΣΑΣ ſ", "日本語 １２３ a1b2", "🙂👍🏽 _a_ __", "a b c\r\nd\x85e", "<| x |> a<b>c", "'s 't ''' ..", "µ ª º ÷×"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def expected(library, rows):
    """Rows (doc_id, text) in file order -> (doc_id, start, n_tokens, crc)."""
    out, at = [], 0
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_whole_table_equals_the_library(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in op9_token_files(spark, SF_SMALL).collect())
    assert got == expected(library, sorted(rows))


def test_odd_texts_repeated_ids_and_pruned_reads(spark, library):
    rows = [(i * 7 % 101, t, 1) for i, t in enumerate(ODD)] + [(500, "long " * 40_000, 1), (None, "no id", 1),
                                                               (3000, "b", 1), (3000, "a", 1), (3000, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    path = scratch_path(spark, "tokens")
    write_token_files(df, path, tokenizer_path())
    in_order = sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    got = [tuple(r) for r in token_index(read_token_files(spark, path)).orderBy("start").collect()]
    assert got == expected(library, in_order)
    one = read_token_files(spark, path, [500])
    assert one.first().ids == library.encode("long " * 40_000, add_special_tokens=False).ids + [2]
    assert "PushedFilters: [In(doc_id, [500])" in one._jdf.queryExecution().toString() or \
        "EqualTo(doc_id,500)" in one._jdf.queryExecution().toString()


def test_empty_table(spark):
    path = scratch_path(spark, "tokens")
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, tokenizer_path())
    assert token_index(read_token_files(spark, path)).count() == 0


def test_files_have_bloom_filters_and_row_indexes(spark):
    from pyarrow import orc

    path = scratch_path(spark, "tokens")
    write_token_files(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), path, tokenizer_path())
    import glob

    files = sorted(glob.glob(f"{path}/*.orc"))
    assert files
    reader = orc.ORCFile(files[0])
    assert reader.row_index_stride == 10_000 and reader.nstripes >= 1
    seen = [orc.ORCFile(f).read(columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    flat = [i for part in seen for i in part]
    assert flat == sorted(flat)  # files in name order are one ascending sequence
