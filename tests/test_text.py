from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pressgrain.functions import text as T
from pressgrain.functions.columns import counted


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


def many(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_clean_words_keeps_words_of_three_to_thirteen_letters(spark):
    text = "ab abc abcdefghijklm abcdefghijklmn cross-border x2y été naïve snake_case A.B.C.  end"
    assert one(spark, text, T.clean_words) == "abc abcdefghijklm crossborder nave snakecase ABC end"


def test_clean_words_splits_at_unicode_space(spark):
    assert one(spark, "one two three\x1cfour", T.clean_words) == "one two three four"


def test_clean_words_null_stays_null(spark):
    assert one(spark, None, T.clean_words) is None
    assert one(spark, "  \n ", T.clean_words) == ""


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("abcXYZ019 .-_'\t\n é"), max_size=60), min_size=1, max_size=20))
def test_clean_words_properties(spark, values):
    """What is kept are words of three to thirteen letters; cleaning again changes nothing."""
    cleaned = many(spark, values, T.clean_words)
    words = [w for text in cleaned for w in text.split(" ") if text]
    assert all(3 <= len(w) <= 13 and set(w) <= set("abcXYZ") for w in words)
    assert many(spark, cleaned, T.clean_words) == cleaned


PUBLISHERS = {
    "https://www.nytimes.com/x": "Nytimes",
    "http://blog.site.org": "Blog",
    "https://WWW.Example.com/a": "Www",
    "https://the-new-YORK--times.com/p?q=1": "The New York  Times",
    "http://user:pw@host.com:8080/x": "User:pw@host",
    "https://www.a b-c.com/space here": "A b C",
    "no-scheme.com/x": "",
    "//cdn.site.net/x": "Cdn",
    "mailto:a@b.c": "",
    "https://m.paper.co.uk#frag": "M",
    "https:///empty": "",
    "": "",
}


def test_publisher_from_url(spark):
    assert many(spark, list(PUBLISHERS), T.publisher_from_url) == list(PUBLISHERS.values())


def test_publisher_from_title(spark):
    titles = ["A - B", "A | B", "A - B | C", "A | B - C - D", "plain", "a-b|c", None, "a | | b", "a - - - b", "x - "]
    want = ["B", "B", "B | C", "D", "Unknown", "Unknown", None, "| b", "b", ""]
    assert many(spark, titles, T.publisher_from_title) == want


def test_topic_slug_removes_and_anywhere(spark):
    topics = ["immigration AND policy", "refugees", "  two  words ", "BRAND new", "a ANDAND b"]
    want = ["immigration_policy", "refugees", "two_words", "BR_new", "a_b"]
    assert many(spark, topics, T.topic_slug) == want


def test_zero_is_negative(spark):
    df = spark.createDataFrame([(0.5,), (0.0,), (-0.1,)], "s double")
    got = [r[0] for r in df.select(T.sentiment_category(F.col("s"))).collect()]
    assert got == ["positive", "negative", "negative"]


def test_row_digest_tells_null_from_empty_and_columns_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), (None, "a")], "x string, y string")
    ids = [r[0] for r in df.select(T.row_digest(["x", "y"])).collect()]
    assert len(set(ids)) == 4 and all(len(i) == 64 for i in ids)


def test_tokens_on_accented_text(spark):
    text = "L'été naïve Café don't abcdefghijklmnop it is THE end42 fin"
    assert one(spark, text, T.alpha_tokens) == ["don", "the", "fin"]
    assert one(spark, text, T.word_tokens) == ["été", "naïve", "café", "don", "abcdefghijklmnop", "it", "is", "the", "end42", "fin"]


def test_keyword_tokens(spark):
    text = "The Élan of it doesn't beat 42 words, \"words\" really (cross-border) they're it's x2y end."
    got = one(spark, text, lambda c: T.keyword_tokens(c, ["the", "really"]))
    assert got == ["élan", "does", "beat", "words", "words", "they", "end"]


def test_counted_and_bigrams(spark):
    got = one(spark, "b a b c a b", lambda c: counted(F.split(c, " ")))
    assert [(r["token"], r["tf"]) for r in got] == [("a", 2), ("b", 3), ("c", 1)]
    df = spark.createDataFrame([([],)], "t array<string>")
    assert df.select(counted(F.col("t"))).first()[0] == []
    assert one(spark, "a b c", lambda c: T.bigrams(F.split(c, " "))) == ["a b", "b c"]
    assert one(spark, "a", lambda c: T.bigrams(F.split(c, " "))) == []


def test_first_words_and_sentences(spark):
    assert one(spark, "  a  b\nc d ", lambda c: T.first_words(c, 3)) == "a b c"
    assert one(spark, "One. Two!  Three? four", T.sentences) == ["One.", "Two!", "Three?", "four"]
