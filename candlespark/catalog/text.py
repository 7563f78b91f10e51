"""Text cleaning and word counts over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlespark.catalog import bindings as b
from candlespark.catalog.registry import query
from candlespark.functions import text as t
from candlespark.operators import stats
from candlespark.operators.textclean import with_clean_text

_CLEAN = f"""regexp_replace(regexp_replace(regexp_replace(text, '{t.SYMBOL_CLASS}', '', 'g'), '  +', ' ', 'g'),
  '{t.LINE_START_SPACE}', '\\1', 'g')"""


@query("clean_text", f"SELECT doc_id, {_CLEAN} AS cleaned FROM documents")
def clean_text(spark, folder):
    return with_clean_text(b.table(spark, folder, "documents").select("doc_id", "text")).drop("text")


@query("clean_pages", f"SELECT page_id AS doc_id, {_CLEAN.replace('text,', 'html,')} AS cleaned FROM pages")
def clean_pages(spark, folder):
    pages = b.table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), "html")
    return with_clean_text(pages, "html").drop("html")


@query(
    "word_count",
    r"""WITH w AS (SELECT unnest(string_split_regex(text, '[ \t\n\r\f\x0B]+')) AS word FROM documents)
SELECT word, count(*) AS word_count FROM w WHERE word <> '' GROUP BY word""",
)
def word_count(spark, folder):
    return stats.word_count(b.table(spark, folder, "documents"))
