"""Scalar functions: tokenisers, regex extraction, messages, record parsing."""

import pytest
from pyspark.sql import functions as F

from rivulet.functions import records as RC
from rivulet.functions import text as TX
from rivulet.functions.udtf import split_sentence, split_words_batches, split_words_udtf

SENTENCES = ["the cow jumped over the moon", "", "   ", " lead", "trail  ",
             "a  b", "tab\tand\nnewline  x ", "  two  spaces  "]


@pytest.mark.parametrize("mode", ["java", "python", "ruby"])
def test_split_modes_match_python_reference(spark, mode):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SENTENCES)], "id int, s string")
    got = {r["id"]: r["w"] for r in df.select("id", TX.split_words("s", mode).alias("w")).collect()}
    for i, s in enumerate(SENTENCES):
        assert got[i] == split_sentence(s, mode), (mode, s)


def test_java_split_rules():
    # Leading/inner empties kept, trailing dropped; all-space -> nothing; '' -> ['']
    assert split_sentence(" a  b  ", "java") == ["", "a", "", "b"]
    assert split_sentence("   ", "java") == []
    assert split_sentence("", "java") == [""]
    assert split_sentence("a b ", "python") == ["a", "b", ""]
    assert split_sentence("  a \t b\n", "ruby") == ["a", "b"]


def test_udtf_matches_jvm_split(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SENTENCES)], "id int, s string")
    for mode in ["java", "python", "ruby"]:
        a = sorted(tuple(r) for r in split_words_udtf(df, "s", mode, keep=["id"]).collect())
        b = sorted(tuple(r) for r in df.select("id", F.explode(TX.split_words("s", mode))).collect())
        c = sorted(tuple(r) for r in split_words_batches(df, "s", mode, ["id"], rows=2).collect())
        assert a == b == c, mode


def test_batches_split_like_rows(spark):
    texts = ["", " ", "  x", "x  ", "\n\t", "a \n b", "a\x0bb\x0c", "é  ü ", None, "w " * 100_000, "\u00a0 y"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "id int, s string")
    for mode in ["java", "python", "ruby"]:
        got = sorted(tuple(r) for r in split_words_batches(df, "s", mode, ["id"]).collect())
        assert got == sorted((i, w) for i, s in enumerate(texts) if s is not None
                             for w in split_sentence(s, mode)), mode
    assert split_words_batches(df.limit(0), "s").count() == 0


def test_append_suffix_chained(spark):
    df = spark.createDataFrame([("hi",)], "w string")
    once = df.select(TX.append_suffix("w").alias("w"))
    assert once.select(TX.append_suffix("w")).first()[0] == "hi!!!!!!"


def test_page_title_and_links(spark):
    html = ("<title>Main page</title> see [[Target|label]] and [[||]] then [[|x]] "
            + " ".join(f"[[L{i}]]" for i in range(12)))
    df = spark.createDataFrame([(html,), ("<title>\nsplit</title> no links",)], "h string")
    out = df.select(TX.page_title("h").alias("t"), TX.page_links("h").alias("l")).collect()
    assert out[0]["t"] == "Main page"
    # pipes-only link skipped without using a slot; "|x" gives an empty target
    assert out[0]["l"] == ["Target", "", "L0", "L1", "L2", "L3", "L4", "L5", "L6", "L7"]
    assert out[1]["t"] == "<unknown>"       # '.' does not cross the line break
    assert out[1]["l"] == []


def test_event_message(spark):
    df = spark.createDataFrame([("t", "h"), (None, "h"), ("t", None)], "t string, h string")
    got = [r[0] for r in df.select(TX.event_message("t", "h")).collect()]
    assert got == ["t ---> h", "null ---> h", "t ---> ???"]


def test_regex_number(spark):
    titles = ["flat $ 1200 nice", "$99999999999 huge", "no price", "520 sqft, $ 7", "1000sqft"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [tuple(r) for r in df.select(TX.regex_number("t", TX.PRICE_PATTERN),
                                       TX.regex_number("t", TX.SQFT_PATTERN)).collect()]
    assert got == [(1200, None), (None, None), (None, None), (7, 520), (None, 1000)]


def test_stock_parsing_drops_bad_rows(spark):
    lines = ["NYSE,GCH,2010-01-04,1,2.5,0.5,10.0,3,9",   # ok: 10*3
             "NYSE,BAD,2010-01-04,1,2,1,x,3,9",          # non-numeric
             "NYSE,SHORT,2010",                          # short
             "NASDAQ,HEX,2010-01-04,1,2,1,0x1p3,2,0",    # hex float like Java's parser
             "NYSE,TRAIL,2010-01-04,1,2,1,4,,"]          # empty volume
    df = spark.createDataFrame([(s,) for s in lines], "str string")
    got = sorted(tuple(r) for r in RC.parse_stock_line(df).collect())
    assert got == [("NASDAQ", "HEX", 16.0), ("NYSE", "GCH", 30.0)]
    watched = RC.stock_watch(df, ["NYSE:GCH", "NYSE:SHORT"]).collect()
    assert [tuple(r) for r in watched] == [("NYSE:GCH", "2010-01-04", 2.5, 0.5)]
    assert RC.stock_watch(df, []).count() == 4   # empty list = everything parsable


def test_composite_key(spark):
    df = spark.createDataFrame([(1, "F")], "a long, b string")
    assert df.select(TX.composite_key("a", "b")).first()[0] == "1:F"
