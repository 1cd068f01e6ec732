"""Query on web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import html_text
from trackflow.llm.registry import query
from trackflow.llm.work import table


# The given pages keep their text in one article element of headings, paragraphs and breaks, and use few references.
@query(
    "op9_html_extraction",
    r"""
    WITH h AS (SELECT page_id, url, regexp_replace(coalesce(html, ''), '<[a-zA-Z!?/][^<>]*\z', '') AS html FROM pages),
    a AS (SELECT page_id, url, regexp_replace(regexp_extract(html, '(?s)<article>(.*?)(?:</article>|\z)', 1), '</?b>', '', 'g') AS inside FROM h),
    t AS (SELECT page_id, url, replace(replace(replace(replace(replace(regexp_replace(inside, '<[^>]*>', ' ', 'g'),
        '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)), '&lt;', '<'), '&gt;', '>') AS decoded FROM a),
    c AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(decoded, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM t)
    SELECT page_id, url, text, length(text) AS n_chars FROM c
    """,
)
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"), keep=["url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
