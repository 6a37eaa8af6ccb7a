"""Chat formatting with typed content parts, and reading the format back.

Built from column functions only. A message holds an ordered list of typed parts; the
visitor ``flatten_parts`` turns each part into text or a placeholder and records what
is attached. Control strings of the template all begin with ``<|``. Inside a text a
backslash becomes two and ``<|`` becomes ``<\\|``, so a text can never hold a control
string and the change is undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnmark.llm.common import table

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Types of parts that are not text, with the tokens one unit stands for in the model's input.
UNIT_TOKENS = {"image": 256, "audio": 50, "document": 512}
ROLES_WITH_LOSS = ("assistant",)
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A list with one text part; the form of a plain message."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def flatten_parts(parts: Column, unit_tokens: dict[str, int] = UNIT_TOKENS) -> tuple[Column, Column, Column]:
    """Visit the parts in order: (body, attachments, expanded tokens of the attachments).

    A text part gives its escaped text. Any other known type gives ``<|type:n|>`` with n the
    part's position among the message's attachments, and one attachment record (n, type,
    ref, tokens) with tokens = units (null: 1, negative: 0) times the type's tokens.
    Unknown or null types are taken as text; null lists and parts give nothing.
    """
    kinds = F.array(*(F.lit(k) for k in unit_tokens))
    per_unit = F.create_map(*(x for k, v in unit_tokens.items() for x in (F.lit(k), F.lit(v).cast("bigint"))))
    clean = F.filter(F.coalesce(parts, F.from_json(F.lit("[]"), f"array<{PART}>")), lambda p: p.isNotNull())
    attached = F.filter(clean, lambda p: F.coalesce(F.array_contains(kinds, p["type"]), F.lit(False)))
    attachments = F.transform(attached, lambda p, i: F.struct(
        i.alias("n"), p["type"].alias("type"), p["ref"].alias("ref"),
        (F.greatest(F.coalesce(p["units"], F.lit(1)), F.lit(0)) * F.element_at(per_unit, p["type"])).alias("tokens")))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    walked = F.aggregate(clean, empty, lambda acc, p: F.when(
        F.coalesce(F.array_contains(kinds, p["type"]), F.lit(False)),
        F.struct(F.concat(acc["out"], F.lit("<|"), p["type"], F.lit(":"), acc["n"].cast("string"), F.lit("|>")).alias("out"),
                 (acc["n"] + 1).alias("n"))).otherwise(
        F.struct(F.concat(acc["out"], escape(F.coalesce(p["text"], F.lit("")))).alias("out"), acc["n"].alias("n"))),
        lambda acc: acc["out"])
    tokens = F.aggregate(attachments, F.lit(0).cast("bigint"), lambda acc, a: acc + a["tokens"])
    return walked, attachments, tokens


def format_chat(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts") -> DataFrame:
    """One row per conversation: ``formatted``, ``attachments``, ``attachment_tokens`` and ``n_turns``.

    Messages stand by ``turn`` (null first), equal turns by role and body. A null role is empty.
    A conversation without rows does not appear; a null id is a conversation of its own.
    Extra columns are ignored. The conversation is the unit of output, so its
    messages meet in one row; conversations are never joined with each other.
    """
    body, attachments, tokens = flatten_parts(F.col(parts))
    said = messages.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), body.alias("body"),
        attachments.alias("attachments"), tokens.alias("tokens")).alias("m"))
    turns = F.col("turns")
    spelled = F.transform(turns, lambda m: F.concat(F.lit(TURN), escape(m["role"]), F.lit(BODY), m["body"], F.lit(END)))
    return (said.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("turns"))
            .select("conv_id", F.size(turns).cast("bigint").alias("n_turns"),
                    F.array_join(spelled, "").alias("formatted"),
                    F.flatten(F.transform(turns, lambda m, i: F.transform(m["attachments"], lambda a: F.struct(
                        i.alias("turn_index"), a["n"].alias("n"), a["type"].alias("type"), a["ref"].alias("ref"),
                        a["tokens"].alias("tokens"))))).alias("attachments"),
                    F.aggregate(turns, F.lit(0).cast("bigint"), lambda acc, m: acc + m["tokens"]).alias("attachment_tokens")))


def read_chat(formatted: Column) -> Column:
    """The list of (role, text) that a formatted conversation holds; placeholders stay as they are."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1_000_000_000)
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, BODY, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, BODY, -1), END, 1)).alias("text")))


def digest_chat(chats: DataFrame) -> DataFrame:
    """Read the formatted text back and take digests of the turns and of the text under the loss mask."""
    back = chats.select("conv_id", "formatted", read_chat(F.col("formatted")).alias("back"),
                        "attachments", "attachment_tokens")
    said = F.array_join(F.transform("back", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    roles = F.array(*(F.lit(r) for r in ROLES_WITH_LOSS))
    loss = F.array_join(F.transform(F.filter("back", lambda m: F.array_contains(roles, m["role"])), lambda m: m["text"]), "")
    return (back.withColumn("said", said).withColumn("loss", loss)
            .select("conv_id", F.size("back").cast("bigint").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
                    F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("bigint").alias("formatted_chars"),
                    F.size("attachments").cast("bigint").alias("n_attachments"), "attachment_tokens"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT cast(-1 AS bigint) AS conv_id, cast(turn AS bigint) AS turn, role, "
                      "'</s>[INST] ok [/INST]' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)")
    rows = rows.unionByName(probe)
    return digest_chat(format_chat(rows.withColumn("parts", text_part(F.col("text")))))


#: Length of the template's marks per turn.
_MARKS = len(TURN) + len(BODY) + len(END)
ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
spelled AS (
  SELECT *, replace(replace(role, '\\', '\\\\'), '<|', '<\\|') AS erole,
         replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS etext FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, etext)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, etext) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(erole) + length(etext) + {_MARKS})::BIGINT AS formatted_chars,
       0::BIGINT AS n_attachments, 0::BIGINT AS attachment_tokens
FROM spelled GROUP BY conv_id
"""
