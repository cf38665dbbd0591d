"""op13 against its SQL definition in DuckDB, and its odd cases."""

import duckdb
import pandas as pd

from sessionloom.llm import divergence, expected


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return df[cols].astype({"value": "int64", "rank": "int64"}).sort_values(cols).reset_index(drop=True)


def _by_sql(rows: pd.DataFrame) -> pd.DataFrame:
    con = duckdb.connect()
    con.register("documents", rows)
    return _sorted(con.execute(expected.divergence()).df())


def test_tokenizer_lowers_letters_and_blanks_separators():
    got = divergence.document_terms("Hello, WORLD! héllo_wörld 42x ab cd")
    assert got == {b"hello": 1, b"world": 1, "héllo".encode(): 1, "wörld".encode(): 1, b"x": 1, "ab cd".encode(): 1}


def test_equals_sql_on_documents(spark, documents):
    got = _sorted(divergence.source_divergence(documents).toPandas())
    assert len(got) > 0 and set(got["part"]) == {"pair", "term"}
    pd.testing.assert_frame_equal(got, _by_sql(documents.select("doc_id", "lang", "source", "text").toPandas()))


def test_odd_rows(spark, odd, none):
    rows = odd.select("doc_id", "text", "lang", "source").toPandas()
    # enough documents that some terms are kept: the odd rows five times over
    many = spark.createDataFrame(pd.concat([rows] * 5, ignore_index=True), "doc_id long, text string, lang string, source string")
    with_extra = many.join(odd.select("doc_id", "n", "node", "size").dropDuplicates(["doc_id"]), "doc_id", "left")
    got = _sorted(divergence.source_divergence(with_extra).toPandas())
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, _by_sql(many.toPandas()))
    # a group whose documents hold no kept term still ranks its peers; empty tables give nothing
    assert (got.loc[got["part"] == "pair", "source"] == "").any()
    assert divergence.source_divergence(none).count() == 0


def test_language_without_kept_terms_gives_zero_pairs(spark):
    rows = [(1, "rare words only", "xx", "a"), (2, None, "xx", "b"), (3, "", None, None)]
    got = divergence.source_divergence(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert sorted(map(tuple, got.collect())) == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]


def test_terms_leave_the_worker_in_arrow_batches_whatever_the_flush(spark):
    texts = [("a", "s", "One two TWO déjà"), ("a", "s", "two"), ("b", "s", ""), ("a", "t", "two  one"), ("a", "s", "one")]
    docs = spark.createDataFrame(texts, "lang string, source string, text string").coalesce(1)
    want = {("a", "s", "one"): (2, 2), ("a", "s", "two"): (3, 2), ("a", "s", "déjà"): (1, 1), ("a", "t", "two"): (1, 1), ("a", "t", "one"): (1, 1)}
    for flush in (0, 2, 100):
        rows = divergence.term_rows(docs, flush)
        assert "MapInArrow" in rows._jdf.queryExecution().executedPlan().toString()
        got = {}
        for r in rows.collect():
            c, d = got.get((r["lang"], r["source"], r["term"]), (0, 0))
            got[r["lang"], r["source"], r["term"]] = (c + r["c"], d + r["docs"])
        assert got == want
