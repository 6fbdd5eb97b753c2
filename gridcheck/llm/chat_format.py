"""Chat formatting by perspective rotation, DataFrame operations only.

Every participant of a dialogue gets a rendering in which their turns are the
assistant's, everybody else is a named user, and the target spans, in
characters, cover the assistant's words and the end mark after them. Turns
meet by (conversation, turn number div PART), so the unit of work is bounded
however long a dialogue is; a longer one is rendered part by part, each part
for every participant of the dialogue. The parts of one speaker, joined in
order, are the rendering of the whole dialogue; no turn stands twice.

    <|system|>\\ntext<|end|>\\n
    <|user:NAME|>\\ntext<|end|>\\n
    <|assistant|>\\ntext<|end|>\\n

"<|" inside a text becomes "<||", and names are percent-encoded, so a
rendering can be taken apart again without loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Turn numbers that make a part, and the role that takes no perspective.
PART, SYSTEM = 512, "system"
END = "<|end|>"


def perspectives(turns: DataFrame, part: int = PART) -> DataFrame:
    """Of (conv_id, turn, role, text): conv_id, part, speaker, n_turns,
    n_targets, text, target_spans ("first:end" in characters, in order,
    separated by spaces) and target_chars.

    Defined cases: turns go by number, ties by role and text, nulls first;
    rows equal in all four columns are one turn; a null or empty text is an
    empty turn; a null role speaks as an unnamed user and, like the system,
    takes no perspective; turns of a null number make a part of their own,
    whose number is null and which comes first; rows of a null conv_id are
    one dialogue; a dialogue without participants gives no
    row, and one who is silent in a part has no target spans there; an empty
    table gives an empty result; other columns are ignored.
    """
    number = F.floor(F.col("turn") / part)
    rows = turns.select("conv_id", number.alias("part"), F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")).alias("_t"))
    # Dialogues of several parts, told apart without their texts: each part is to know the speakers of all.
    speaks = F.when(F.col("role") != SYSTEM, F.col("role"))
    dialogues = turns.groupBy("conv_id").agg(F.collect_set(F.struct(number.alias("part"))).alias("_parts"), F.collect_set(speaks).alias("_all"))
    several = dialogues.where(F.size("_parts") > 1).select("conv_id", F.explode("_parts.part").alias("part"), F.lit(None).cast(rows.schema["_t"].dataType).alias("_t"), "_all")
    parts = (
        rows.withColumn("_all", F.lit(None).cast("array<string>"))
        .unionByName(several)
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_set("_t")).alias("_turns"), F.first("_all", ignorenulls=True).alias("_all"))
    )
    own = F.array_distinct(F.transform(F.filter("_turns", lambda t: t["role"] != SYSTEM), lambda t: t["role"]))
    each = parts.select("conv_id", "part", "_turns", F.explode(F.coalesce("_all", own)).alias("speaker"))
    head = lambda t: (
        F.when(t["role"] == SYSTEM, F.lit("<|system|>\n"))
        .when(t["role"] == F.col("speaker"), F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user:"), F.coalesce(F.url_encode(t["role"]), F.lit("")), F.lit("|>\n")))
    )
    body = lambda t: F.concat(F.replace(t["text"], F.lit("<|"), F.lit("<||")), F.lit(END))
    pieces = F.transform("_turns", lambda t: F.struct(head(t).alias("head"), body(t).alias("body"), (F.coalesce(t["role"] == F.col("speaker"), F.lit(False))).alias("mine")))
    each = each.withColumn("_pieces", pieces)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state, p):
        first = state["at"] + F.length(p["head"])
        end = first + F.length(p["body"])
        span = F.array(F.concat_ws(":", first.cast("string"), end.cast("string")))
        return F.struct((end + 1).alias("at"), F.when(p["mine"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return each.select(
        "conv_id",
        "part",
        "speaker",
        F.size("_turns").cast("long").alias("n_turns"),
        F.size(F.filter("_pieces", lambda p: p["mine"])).cast("long").alias("n_targets"),
        F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.array_join(F.aggregate("_pieces", start, step)["spans"], " ").alias("target_spans"),
        F.aggregate("_pieces", F.lit(0).cast("long"), lambda n, p: n + F.when(p["mine"], F.length(p["body"])).otherwise(0)).alias("target_chars"),
    )


SQL = f"""
WITH t AS (
  SELECT DISTINCT conv_id, turn // {PART} AS part, turn, role, coalesce(text, '') AS text FROM conversations
), s AS (
  SELECT a.conv_id, a.part, b.speaker
  FROM (SELECT DISTINCT conv_id, part FROM t) a
  JOIN (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> '{SYSTEM}') b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
), p AS (
  SELECT s.conv_id, s.part, s.speaker, t.turn, t.role, t.text AS raw, coalesce(t.role = s.speaker, false) AS mine,
         CASE WHEN t.role = '{SYSTEM}' THEN '<|system|>' WHEN t.role = s.speaker THEN '<|assistant|>'
              ELSE '<|user:' || coalesce(url_encode(t.role), '') || '|>' END || chr(10) AS head,
         replace(t.text, '<|', '<||') || '{END}' AS body
  FROM s JOIN t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.part IS NOT DISTINCT FROM s.part
), q AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, part, speaker ORDER BY turn NULLS FIRST, role NULLS FIRST, raw
            ROWS UNBOUNDED PRECEDING) - length(body) - 1 AS first
  FROM p
)
SELECT conv_id, CAST(part AS BIGINT) AS part, speaker, count(*) AS n_turns, CAST(sum(CAST(mine AS INTEGER)) AS BIGINT) AS n_targets,
       string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, raw) AS text,
       coalesce(string_agg(CAST(CAST(first AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(first + length(body) AS BIGINT) AS VARCHAR), ' '
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, raw) FILTER (WHERE mine), '') AS target_spans,
       CAST(coalesce(sum(length(body)) FILTER (WHERE mine), 0) AS BIGINT) AS target_chars
FROM q GROUP BY conv_id, part, speaker
"""
