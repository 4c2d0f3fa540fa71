"""Chat formatting by prefix-target expansion, in DataFrame operations only.

A conversation's turns become one text by a template that marks each turn. Every assistant turn is an example of its
own: all that stands before it is context, and only its text is trainable. A conversation that does not end with
an assistant's turn has one more example without a trainable part, so that no turn is lost. Control strings
that texts or roles hold themselves are escaped, reversibly: a backslash is doubled, and one is put behind the
first character of each control string.

Running lengths come from a window over the turns of a conversation; its text is gathered once, and examples are
cut from it row by row, so that their sum (which grows with the square of the turns) is never held, shuffled or
stored unless the caller stores it. A conversation is one row, so its text must fit into one (2 GB).

Defined cases: a null text or role is empty; rows without a conversation id are one conversation with a null id;
turns that have no number come first, equal numbers are ordered by role, then text, so repeated rows are turns of
their own; texts of any length are kept whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TARGET = "assistant"


@dataclass(frozen=True)
class Template:
    """What stands before the role, between role and text and after the text of a turn; `control` is a pattern of all control strings.

    Every control string begins with a character of `first`, holds it nowhere else and no backslash; `close` begins with a control string.
    """

    open: str = "<s>[INST] "
    middle: str = " [/INST]\n"
    close: str = "</s>\n"
    first: str = r"[<\[]"
    control: str = r"<(?=/?s>)|\[(?=/?INST\])"


TEMPLATE = Template()
#: The conversation that the registered query adds: control strings as texts.
EXTRA_ID, EXTRA_TEXT = -7, "</s>[INST] ok [/INST]"


def escaped(text: Column, t: Template = TEMPLATE) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({t.control})", "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(conversations: DataFrame, t: Template = TEMPLATE) -> DataFrame:
    """conv_id, text and targets (first character from 1, length, end) of every conversation."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.select("conv_id", F.col("turn").alias("turn"), filled("role").alias("role"), filled("text").alias("own"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "own")
    turns = turns.withColumn("said", escaped(F.col("own"), t)).withColumn("head", F.concat(F.lit(t.open), escaped(F.col("role"), t), F.lit(t.middle)))
    size = F.length("head") + F.length("said") + F.lit(len(t.close))
    turns = turns.withColumn("k", F.row_number().over(order)).withColumn("upto", F.sum(size.cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    end = F.col("upto") - len(t.close)
    piece = F.struct("k", F.concat("head", "said", F.lit(t.close)).alias("text"), (F.col("role") == TARGET).alias("trained"), F.length("said").alias("length"), end.alias("end"))
    held = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("turns"))
    target = lambda x: F.struct((x["end"] - x["length"] + 1).alias("start"), x["length"].alias("length"), x["end"].alias("end"))
    targets = F.transform(F.filter("turns", lambda x: x["trained"]), target)
    return held.select("conv_id", F.array_join("turns.text", "").alias("text"), targets.alias("targets"), F.element_at("turns", -1)["trained"].alias("ends_trained"))


def examples(conversations: DataFrame, t: Template = TEMPLATE) -> DataFrame:
    """conv_id, example (from 0), is_last, text and its trainable part: loss_start (from 1) and loss_length, 0 long for a tail without target."""
    own = formatted(conversations, t)
    close = F.lit(len(t.close))
    tail = F.struct((F.length("text") + 1).cast("long").alias("start"), F.lit(0).alias("length"), (F.length("text") - close).cast("long").alias("end"))
    targets = F.when(F.col("ends_trained"), F.col("targets")).otherwise(F.concat("targets", F.array(tail)))
    each = own.select("conv_id", "text", F.size(targets).alias("n"), F.posexplode(targets).alias("example", "x"))
    upto = F.substring("text", F.lit(1), (F.col("x.end") + close).cast("int")).alias("text")
    return each.select("conv_id", "example", (F.col("example") == F.col("n") - 1).alias("is_last"), upto, F.col("x.start").cast("int").alias("loss_start"), F.col("x.length").alias("loss_length"))


def read_back(found: DataFrame, t: Template = TEMPLATE) -> DataFrame:
    """conv_id, turns (role, text), trained (the unescaped trainable texts in order), n_examples and formatted_chars (of all examples), from examples."""
    part = found.select(
        "conv_id", "example", F.when(F.col("is_last"), F.col("text")).alias("whole"), F.length("text").cast("long").alias("chars"), "is_last",
        unescaped(F.substring("text", F.col("loss_start"), F.col("loss_length"))).alias("trained"),
    )
    kept = F.array_sort(F.collect_list(F.struct("example", "trained")))
    own = part.groupBy("conv_id").agg(F.max("whole").alias("whole"), kept["trained"].alias("trained"), F.count("*").alias("n_examples"), F.sum("chars").alias("formatted_chars"))
    quoted = lambda s: "".join("\\" + c if not c.isalnum() and c not in " \n" else c for c in s)
    inner = F.substring("whole", F.lit(1), F.length("whole") - len(t.close))
    turns = F.transform(F.split(inner, quoted(t.close), -1), lambda x: F.split(F.substring(x, len(t.open) + 1, 2**31 - 1), quoted(t.middle), 2))
    turns = F.transform(turns, lambda x: F.struct(unescaped(x[0]).alias("role"), unescaped(x[1]).alias("text")))
    return own.select("conv_id", turns.alias("turns"), "trained", "n_examples", "formatted_chars", F.length("whole").alias("conversation_chars"))


def with_extra(conversations: DataFrame) -> DataFrame:
    """The conversations and the one that holds control strings."""
    rows = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit(TARGET).alias("role"))))
    extra = conversations.sparkSession.range(1).select(F.lit(EXTRA_ID).cast("long").alias("conv_id"), rows.alias("x")).select("conv_id", "x.*", F.lit(EXTRA_TEXT).alias("text"))
    return conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text").unionByName(extra)


def chat_formatting(conversations: DataFrame) -> DataFrame:
    """The digests of all conversations, read back from their examples."""
    back = read_back(examples(with_extra(conversations)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"), "formatted_chars", "n_examples", F.col("conversation_chars").cast("long").alias("conversation_chars"),
    )


_ESCAPED = r"regexp_replace(replace({}, '\', '\\'), '(<)(/?s>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g')"

ORACLE_SQL = rf"""
WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES ({EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}'), ({EXTRA_ID}, 1, '{TARGET}', '{EXTRA_TEXT}')) v(conv_id, turn, role, text)
), sized AS (
  SELECT *, row_number() OVER o AS k,
    sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + {len(TEMPLATE.open + TEMPLATE.middle + TEMPLATE.close)}) OVER (o ROWS UNBOUNDED PRECEDING) AS upto,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM all_turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{TARGET}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = '{TARGET}'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = '{TARGET}' OR k = n))::BIGINT AS formatted_chars,
  count(*) FILTER (role = '{TARGET}' OR k = n) AS n_examples, max(upto)::BIGINT AS conversation_chars
FROM sized GROUP BY conv_id
"""
