"""Query on conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import chat
from trackflow.llm.registry import query
from trackflow.llm.work import table

PROBE = r"\### Assistant: </turn> ok"


@query(
    "op7_chat_formatting",
    r"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length('### ' || role || ': ') + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/')) + length(' </turn>') + 1)::BIGINT
            AS formatted_chars
    FROM t GROUP BY conv_id
    """,
)
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says the template's own marks, formatted and read back."""
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = chat.format_conversations(rows)
    read = F.zip_with(chat.roles("formatted", "turn_spans", "text_spans"), chat.texts("formatted", "text_spans"), lambda role, text: F.concat(role, F.lit("\n"), text, F.lit("\n")))
    loss = F.array_join(chat.texts("formatted", "loss_spans"), "")
    return out.select(
        "conv_id",
        F.size("turn_spans").cast("long").alias("n_turns"),
        F.sha2(F.array_join(read, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
