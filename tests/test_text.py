from pyspark.sql import functions as F

from candlespark.functions.text import clean_text
from candlespark.operators.stats import word_count
from candlespark.operators.textclean import with_clean_text

CASES = {
    "plain text": "plain text",
    "a 🚀  b ✅\n    x": "a b \nx",
    "⏰ wake  up": "wake up",
    "日本語 text 한국": "text ",
    "é ü ß": "é ü ß",
    "line\r\n  next\r\n": "line\r\nnext\r\n",
    "   x": "x",
    " x": " x",
    "a\n \n b": "a\n\nb",
    "tab\t\tkept  here": "tab\t\tkept here",
    "👩‍💻 family": "family",
    "": "",
    "\n\n": "\n\n",
    "  ": "",
    "ⓁⓂ": "Ⓛ",
    "x  y": "x  y",
}


def test_cleaner_on_literals(spark):
    df = spark.createDataFrame([(k,) for k in CASES] + [(None,)], "text string")
    got = with_clean_text(df).withColumn("simple", clean_text(F.col("text"))).collect()
    for row in got:
        assert row.cleaned == row.simple == (None if row.text is None else CASES[row.text]), repr(row.text)


def test_word_count(spark):
    df = spark.createDataFrame([("a  b\n\ta",), ("",), (" x ",), (None,)], "text string")
    assert {r.word: r.word_count for r in word_count(df).collect()} == {"a": 2, "b": 1, "x": 1}
