"""Chat formatting of conversation tables with Spark expressions only.

The rows of a conversation are collected as structs, sorted by turn, and merged by array functions:
adjacent rows of one role become one message that keeps its texts apart.  Each step goes over a conversation
once, so a long one takes time in proportion to its length.  The template is

    <|role|>ROLE<|text|>TEXT<|next|>TEXT...<|end|>   for each message

Inside roles and texts a backslash is doubled and `<|` becomes `<\\|`, so no text can hold a control string, and
both come back exactly.  The loss mask is the list of the texts of assistant messages, as (start, end)
in code points of the formatted text.

Defined cases: null text is empty; a null role is an empty one; rows of equal turn are ordered by role, then text;
a null turn comes first; repeated rows are repeated turns; null conv_id is one conversation; other columns
are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>"
ASSISTANT = "assistant"
#: The conversation that the contract adds.
ADDED = "</s>[INST] ok [/INST]"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _messages(conversations: DataFrame) -> DataFrame:
    """conv_id and its messages (role, texts): runs of rows of one role, cut out of the sorted array of rows."""
    row = F.struct(
        "turn",
        escaped(F.coalesce("role", F.lit(""))).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("text"),
    )
    rows = F.col("rows")
    opens = F.filter(
        F.sequence(F.lit(1), F.size(rows)), lambda i: (i == 1) | (F.get(rows, i - 1)["role"] != F.get(rows, i - 2)["role"])
    )
    closes = F.concat(F.slice("opens", 2, F.size("opens")), F.array(F.size(rows) + 1))
    runs = F.arrays_zip(F.col("opens"), closes.alias("closes"))
    merged = F.transform(
        runs,
        lambda r: F.struct(
            F.get(rows, r["opens"] - 1)["role"].alias("role"),
            F.transform(F.slice(rows, r["opens"], r["closes"] - r["opens"]), lambda t: t["text"]).alias("texts"),
        ),
    )
    collected = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return collected.select("conv_id", "rows", opens.alias("opens")).select("conv_id", merged.alias("messages"))


def formatted(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss (start, end).

    The place of a text is the sum of the lengths before it.  Arrays have no running sum, so the texts of the messages
    are spread and summed in a window; conversations stay where they are, there is one shuffle.
    """
    texts = (
        _messages(conversations)
        .select("conv_id", F.posexplode("messages").alias("message", "m"))
        .select("conv_id", "message", "m.role", F.size("m.texts").alias("n"), F.posexplode("m.texts").alias("k", "text"))
    )
    lead = F.when(F.col("k") == 0, F.concat(F.lit(ROLE), "role", F.lit(TEXT))).otherwise(F.lit(NEXT))
    tail = F.when(F.col("k") == F.col("n") - 1, F.lit(END)).otherwise(F.lit(""))
    before = Window.partitionBy("conv_id").orderBy("message", "k").rowsBetween(Window.unboundedPreceding, -1)
    parts = texts.select("*", lead.alias("lead"), tail.alias("tail"))
    length = F.length("lead") + F.length("text") + F.length("tail")
    parts = parts.select("*", (F.coalesce(F.sum(length).over(before), F.lit(0)) + F.length("lead")).cast("int").alias("start"))
    piece = F.struct("start", F.concat("lead", "text", "tail").alias("piece"))
    span = F.struct("start", (F.col("start") + F.length("text")).alias("end"))
    whole = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("role") == ASSISTANT, span))).alias("loss"),
    )
    return whole.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "loss")


def read_back(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""

    def turns(message: Column) -> Column:
        parts = F.split(message, r"<\|text\|>", 2)
        body = F.substr(parts[1], F.lit(1), F.length(parts[1]) - len(END))
        return F.transform(
            F.split(body, r"<\|next\|>", -1),
            lambda t: F.struct(unescaped(parts[0]).alias("role"), unescaped(t).alias("text")),
        )

    messages = F.split(text, r"<\|role\|>", -1)
    return F.flatten(F.transform(F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0))), turns))


def under_loss(text: Column, loss: Column) -> Column:
    """The texts under the loss mask, end to end."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substr(text, s["start"] + 1, s["end"] - s["start"]))), ""
    )


def op6_relational_chat(spark, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", ASSISTANT))))).alias("r"),
    ).select("conv_id", "r.turn", "r.role", F.lit(ADDED).alias("text"))
    rows = formatted(given.unionByName(added))
    turns = read_back(F.col("formatted"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = under_loss(F.col("formatted"), F.col("loss"))
    return rows.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, coalesce(role <> lag(role) OVER w, true) AS opens,
    replace(replace(role, '\', '\\'), '<|', '<\|') AS r, replace(replace(text, '\', '\\'), '<|', '<\|') AS t
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(t) + CASE WHEN opens THEN 8 + length(r) + 8 + 7 ELSE 8 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
