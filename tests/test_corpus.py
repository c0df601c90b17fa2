"""Raw posts to cleaned corpus on a small table with hand-made answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import text as tx
from corpusmill.operators import clean, dedup, profile
from corpusmill.operators.aggregates import union_all
from corpusmill.plans.corpus import build_corpus, clean_posts, keyed_posts
from corpusmill.sources import chunks, delimited
from corpusmill.sources.staging import materialize_or_load

RAW = (
    "row_id long, subreddit string, title string, body string, upvotes long, created_utc double, "
    "num_comments long, label int"
)
ROWS = [
    (0, "happy", "a", "I need help", 5, 1500000000.0, None, 0),
    (1, "depression", "b", "I need help", 0, 1500000060.0, 2, 1),
    (2, "happy", "c", "one two three four five six", 1, 1500000120.0, 3, 0),
    (3, "teenagers", "d", "one two three four five six", 1, 1500000180.0, 3, 0),
    (4, "happy", "e", None, 1, 1500000240.0, 0, 0),
    (5, "happy", "f", "   ", 1, 1500000300.0, 0, 0),
    (None, "happy", "g", "no row id", 1, 1500000360.0, 0, 0),
    (7, "other", "h", "tab\there  two  spaces", None, 1500000420.0, 1, 0),
    (8, "SuicideWatch", None, 'A "quoted" line\nsecond line', 2, None, 1, 1),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, RAW)


def test_filters_and_casts(raw):
    posts = {r["row_id"]: r for r in clean_posts(raw).collect()}
    assert set(posts) == {0, 1, 2, 3, 7, 8}
    assert posts[0]["num_comments"] == 0
    assert posts[8]["created_datetime"] is None
    as_text = clean_posts(raw).select("row_id", F.date_format("created_datetime", "yyyy-MM-dd HH:mm:ss").alias("t"))
    assert {r["row_id"]: r["t"] for r in as_text.collect()}[0] == "2017-07-14 02:40:00"
    assert profile.exists_value(raw, "upvotes", 0).first()["found"] is True
    assert profile.exists_value(raw, "upvotes", 99).first()["found"] is False


def test_duplicates(raw):
    posts = clean_posts(raw)
    flagged = dedup.duplicate_flag(posts).where("is_duplicate").collect()
    assert {r["row_id"] for r in flagged} == {0, 1, 2, 3}
    kinds = {r["row_id"]: (r["kind"], r["word_count"]) for r in dedup.dedup_short_long_split(posts).collect()}
    assert kinds == {0: ("short", 3), 1: ("short", 3), 2: ("long", 6), 3: ("long", 6)}
    assert {r["row_id"] for r in dedup.dedup_keep_first(posts).collect()} == {0, 2, 7, 8}


def test_keyed_posts(raw):
    rows = sorted(keyed_posts(raw).collect(), key=lambda r: r["unique_id"])
    assert [(r["unique_id"], r["row_id"]) for r in rows] == [(0, 0), (1, 1), (2, 7), (3, 8), (4, 2)]
    assert rows[2]["body"] == "tab here two spaces"
    assert rows[3]["body"] == 'A "quoted" line second line'
    again = profile.count_pattern(keyed_posts(raw), "body", {"tabs": r"\t", "runs": f"[{tx.SPACES}]{{2,}}"}).first()
    assert (again["tabs"], again["runs"]) == (0, 0)


def test_equal_rows_collapse(spark, raw):
    doubled = raw.unionByName(raw)
    assert keyed_posts(doubled).count() == keyed_posts(raw).count()


def test_one_text_in_a_third_of_all_rows(spark):
    n = 3000
    body = F.when(F.col("id") % 3 == 0, "the very same long text in many rows").otherwise(
        F.concat(F.lit("text number "), F.col("id").cast("string")))
    posts = spark.range(n).select(F.col("id").alias("row_id"), body.alias("body"))
    kept = dedup.dedup_length_aware(posts)
    ids = kept.agg(F.min("unique_id"), F.max("unique_id"), F.count_distinct("unique_id"), F.count("*")).first()
    assert tuple(ids) == (0, 2000, 2001, 2001)
    survivor = kept.where("body like 'the very%'").collect()
    assert [(r["row_id"], r["unique_id"]) for r in survivor] == [(0, 2000)]


LEXICON = [("cats", "NNS"), ("running", "VBG")]
LEMMAS = [("cats", "n", "cat"), ("running", "v", "run"), ("running", "n", "running")]
STOP = ["the", "and", "of", "were"]


@pytest.fixture(scope="module")
def dictionary(spark):
    return (
        spark.createDataFrame(LEXICON, "token string, tag string"),
        spark.createDataFrame(LEMMAS, "token string, class string, lemma string"),
    )


def test_final_corpus(raw, dictionary):
    corpus = build_corpus(raw, STOP, *dictionary)
    assert corpus.columns == ["row_id", "subreddit", "title", "body", "label", "unique_id", "cleaned_body"]
    assert {r["unique_id"] for r in corpus.collect()} == {0, 1, 4}


def test_clean_corpus(spark, dictionary):
    texts = [
        "Hello, WORLD! foo_bar", "Cats were running.", "The and of", "!!!", "Café naïve 1st", None,
        "I cannot and gonna", "running cats running",
    ]
    want = [
        "hello world foo_bar", "cat run", "The and of", "!!!", "café naïve 1st", None, "i can not gon na",
        "run cat run",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "unique_id long, body string")
    got = {r["unique_id"]: r["cleaned_body"] for r in clean.clean_corpus(df, STOP, *dictionary).collect()}
    assert got == dict(enumerate(want))


def test_lemma_lookup_keeps_empty_and_missing(spark, dictionary):
    df = spark.createDataFrame([(1, ["cats", "zz"]), (2, []), (3, None)], "unique_id long, tokens array<string>")
    got = {r["unique_id"]: r["tokens"] for r in clean.lemma_lookup(df, "tokens", *dictionary).collect()}
    assert got == {1: ["cat", "zz"], 2: [], 3: None}


def test_tag_classes(spark):
    df = spark.createDataFrame([("JJ",), ("VBD",), ("NNS",), ("RB",), ("IN",)], "tag string")
    assert [r[0] for r in df.select(tx.lexical_class("tag")).collect()] == ["a", "v", "n", "r", "n"]


def test_item_set_and_ngrams(spark):
    df = spark.createDataFrame([("cat run like the 1st a1 go piss cat",), ("",)], "t string")
    sets = [r[0] for r in df.select(tx.item_set(tx.split_words("t"), ["the"])).collect()]
    assert sets == [["cat", "like", "piss", "run"], []]
    one = spark.createDataFrame([("i saw the big cat",), ("x",), ("two words",)], "t string")
    grams = [r[0] for r in one.select(tx.ngrams_up_to(tx.term_tokens("t", ["the"]), 3)).collect()]
    assert grams == [["saw", "big", "cat", "saw big", "big cat", "saw big cat"], [], ["two", "words", "two words"]]


def test_unicode_whitespace(spark):
    df = spark.createDataFrame([("a  b\x1f c ",), ("　\x85",)], "t string")
    row, blank = df.select(
        tx.collapse_whitespace("t").alias("c"), tx.word_count("t").alias("n"), tx.is_nonblank("t").alias("b"),
        tx.strip("t").alias("s"),
    ).collect()
    assert (row["c"], row["n"], row["b"], row["s"]) == ("a b c ", 3, True, "a  b\x1f c")
    assert (blank["n"], blank["b"], blank["s"]) == (0, False, "")


def test_numbers(spark):
    df = spark.createDataFrame([("1",), ("x",), ("",), (None,)], "t string")
    assert [r[0] for r in clean.coerce_numeric(df, "t", "int").collect()] == [1, None, None, None]
    good = spark.createDataFrame([(2.0,), (None,)], "x double")
    assert [r[0] for r in clean.cast_nullable_int(good, ["x"]).collect()] == [2, None]
    with pytest.raises(Exception, match="not an integral value"):
        clean.cast_nullable_int(spark.createDataFrame([(2.5,)], "x double"), ["x"]).collect()


@pytest.mark.parametrize("sep,gzip", [(",", False), ("\t", False), ("\t", True)])
def test_delimited_round_trip(spark, raw, tmp_path, sep, gzip):
    path = str(tmp_path / "out")
    rows = raw.where("row_id is not null").select("row_id", "subreddit", "title", "body", "upvotes", "label")
    delimited.write_delimited(rows, path, sep=sep, gzip=gzip)
    back = delimited.read_delimited(spark, path, rows.schema, sep=sep)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_missing_strings(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,t,x\n1,null,NaN\n2,"NA",1.5\n3,ok,2\n4,"",\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    rows = [tuple(r) for r in delimited.read_csv(spark, str(path), schema).orderBy("id").collect()]
    assert rows == [(1, None, None), (2, None, 1.5), (3, "ok", 2.0), (4, None, None)]


@pytest.mark.parametrize("n,parts,sizes", [(10, 4, [3, 3, 3, 1]), (10, 6, [2, 2, 2, 2, 2])])
def test_chunks(spark, n, parts, sizes):
    df = chunks.with_chunk(spark.range(n).withColumnRenamed("id", "unique_id"), parts=parts)
    assert [r["count"] for r in df.groupBy("chunk").count().orderBy("chunk").collect()] == sizes


def test_stage_is_bound_to_its_parameters(spark, tmp_path):
    path = str(tmp_path / "stage")
    first = materialize_or_load(spark, path, lambda: spark.range(3), {"s": 1})
    again = materialize_or_load(spark, path, lambda: spark.range(99), {"s": 1})
    other = materialize_or_load(spark, path, lambda: spark.range(5), {"s": 2})
    assert (first.count(), again.count(), other.count()) == (3, 3, 5)


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, t string")
    rows = union_all(a, spark.createDataFrame([(2,)], "id long")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, None)]
