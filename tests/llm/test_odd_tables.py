"""Every query of the subpackage over odd and over empty tables: nulls, ties, repeated rows, long texts, clashing columns."""

import hashlib

import numpy as np
import pytest

from lociq.llm import queries

LONG = "one very long text " * 20_000
TEXTS = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other text"), (2, None), (3, ""), (4, " \n\t"), (None, "x y"), (None, None), (None, "x y"), (5, "é Σ 日本 🙂 <|endoftext|> it's"), (6, "z" * 30_000), (7, LONG), (8, LONG), (9, "password=abcdefghijkl1 pwd: x7#Kq9!zW")]
URLS = [(1, "http://com/en/x"), (1, "http://com/en/x"), (None, None), (2, ""), (3, "s://" + "a." * 300 + "org/es/" + "p/" * 500)]
TURNS = [(1, 0, "system", "s"), (1, 1, "a", "hi"), (1, 1, "a", "hi"), (1, None, None, None), (None, 1, "b", LONG), (2, 3, "system", "alone")]


def write(spark, folder, empty):
    cut = lambda df: df.filter("false") if empty else df
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, b"k") for i, t in TEXTS], "doc_id long, text string, lang string, source string, n_chars long, node string, part int, digest binary")
    labels = spark.createDataFrame([(i, 1, y) for i, y in [(1, 0), (1, 1), (None, 1), (2, None), (3, 0), (4, 0), (5, 0), (6, 0), (7, 0), (8, 0), (9, 0)]], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([(i, u, "h", "clash", "clash") for i, u in URLS], "page_id long, url string, html string, host string, rule string")
    turns = spark.createDataFrame([(*r, "clash", 1) for r in TURNS], "conv_id long, turn long, role string, text string, perspective string, k int")
    for name, df in (("documents", docs), ("labels", labels), ("pages", pages), ("conversations", turns)):
        cut(df).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd"), False)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), True)


EACH = ["op1_toxicity", "op2_chunk_store", "op4_secrets", "op5_near_join", "op6_bpe", "op8_sketch"]


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert queries.queries()[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", EACH)
def test_a_row_for_each_document(spark, odd, name):
    got = queries.queries()[name](spark, odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in TEXTS)


def test_ids_of_odd_texts(spark, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    want = []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in queries.op6_bpe(spark, odd).collect())


def test_other_queries_on_odd_tables(spark, odd):
    assert queries.op7_url_trie(spark, odd).count() == len(URLS)
    assert {(r.conv_id, r.perspective, r.n_turns) for r in queries.op9_perspectives(spark, odd).collect()} == {(1, "a", 4), (1, "unnamed", 4), (None, "b", 1)}
    tokens = queries.op3_best_fit(spark, odd).selectExpr("sum(n_tokens)").first()[0]
    assert tokens == queries.op10_bin_slack(spark, odd).selectExpr("sum(length)").first()[0]
    packed = queries.pipeline(spark, odd)
    assert packed.filter("length * 4 <> length(ids)").count() == 0 and packed.filter("doc_id = 7 or doc_id = 8").select("doc_id").distinct().count() == 1
