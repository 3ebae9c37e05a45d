"""Chat formatting of typed content parts, in DataFrame functions only.

A conversation becomes one string: each turn is ``[TURN]role\\nbody</s>``. A body is its parts in order, flattened: text is escaped, and an
image, audio or document part is a placeholder such as ``<|image|>``; its reference, place and expanded token count are recorded. Every
control string begins with ``<`` or ``[``, and neither occurs in an escaped text, so no text can look like control; escapes are two
characters long and begin with a backslash, which is itself escaped, so they are undone exactly. The loss mask holds the span of each
assistant body.

Offsets are running sums over a window; a conversation's string is put together in one row, as its digest needs it whole.

Defined cases: turns are ordered by turn, then role, then content, a null turn last; a null role or text is empty; repeated rows are turns
of their own; null or no content gives an empty body; a part of unknown type is an ``<|attachment|>`` of one token; missing sizes count
as one token; null conv_ids form one conversation; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's control strings and the escapes.
TURN, END = "[TURN]", "</s>"
KINDS = ("image", "audio", "document", "attachment")
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
NEWLINE = ("\n", "\\n")  # in roles only

PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
TOKENS = {"chars": 4, "patch": 28, "per_second": 25, "per_page": 600}


def escape(text: Column, *more: tuple[str, str]) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), (*ESCAPES, *more), text)


def unescape(text: Column, *more: tuple[str, str]) -> Column:
    """The backslash comes last: no other escape ends in one."""
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), (*more, *reversed(ESCAPES)), text)


def _kind(part: Column) -> Column:
    return F.when(part["type"].isin("text", *KINDS), part["type"]).otherwise("attachment")


def _tokens(part: Column, sizes: dict[str, int]) -> Column:
    kind, one = _kind(part), F.lit(1).cast("long")
    patches = F.ceil(part["width"] / sizes["patch"]) * F.ceil(part["height"] / sizes["patch"])
    return F.greatest(one, F.coalesce(
        F.when(kind == "image", patches).when(kind == "audio", F.ceil(part["seconds"] * sizes["per_second"]))
        .when(kind == "document", part["pages"].cast("long") * sizes["per_page"]).otherwise(one), one))


def flatten(content: Column, sizes: dict[str, int]) -> tuple[Column, Column, Column]:
    """Visits the parts in order: (body, attachments, expanded tokens)."""
    parts = F.coalesce(F.filter(content, lambda p: p.isNotNull()), F.from_json(F.lit("[]"), f"array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>"))
    body = F.array_join(F.transform(parts, lambda p: F.when(_kind(p) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), _kind(p), F.lit("|>")))), "")
    seen = F.transform(F.filter(parts, lambda p: _kind(p) != "text"), lambda p, k: F.struct(
        k.alias("place"), _kind(p).alias("type"), p["ref"].alias("ref"), _tokens(p, sizes).alias("tokens")))
    text = F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s + F.when(
        _kind(p) == "text", F.ceil(F.length(F.coalesce(p["text"], F.lit(""))) / sizes["chars"])).otherwise(0))
    return body, seen, text + F.aggregate(seen, F.lit(0).cast("long"), lambda s, a: s + a["tokens"])


def format_messages(messages: DataFrame, sizes: dict[str, int] | None = None) -> DataFrame:
    """messages: conv_id, turn, role, content (array of parts). Returns conv_id, formatted, loss (spans of start and length, code points),
    attachments (turn place, place in it, type, ref, tokens), n_tokens."""
    body, seen, tokens = flatten(F.col("content"), {**TOKENS, **(sizes or {})})
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = messages.select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit((1 << 63) - 1)).alias("turn"), role.alias("role"), body.alias("body"), seen.alias("seen"), tokens.alias("tokens"))
    head = F.concat(F.lit(TURN), escape(F.col("role"), NEWLINE), F.lit("\n"))
    turns = rows.select("*", F.concat(head, "body", F.lit(END)).alias("piece"), F.length(head).cast("long").alias("ahead"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    placed = turns.select(
        "*", F.row_number().over(order).alias("k"),
        (F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece")).alias("from"))
    span = F.when(F.col("role") == "assistant", F.struct((F.col("from") + F.col("ahead")).alias("start"), F.length("body").cast("long").alias("length")))
    found = F.when(F.size("seen") > 0, F.transform("seen", lambda a: F.struct(F.col("k").alias("turn"), a["place"].alias("place"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "piece"))), lambda x: x["piece"]), "").alias("formatted"),
        F.array_sort(F.collect_list(span)).alias("loss"), F.array_sort(F.flatten(F.collect_list(found))).alias("attachments"), F.sum("tokens").alias("n_tokens"))


def text_messages(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as messages of one text part."""
    types = [x.split() for x in PART.split(", ")]
    part = F.struct(*[(F.lit("text") if n == "type" else F.coalesce("text", F.lit("")) if n == "text" else F.lit(None)).cast(t).alias(n) for n, t in types])
    return rows.select("conv_id", "turn", "role", F.array(part).alias("content"))


def _body_parts(body: Column) -> Column:
    """Text and placeholders of a body, in order; other ``<`` do not occur in it."""
    pieces = F.filter(F.split(body, rf"(?=<\|)|(?<=<\|({'|'.join(KINDS)})\|>)"), lambda x: x != "")
    return F.transform(pieces, lambda x: F.when(x.startswith("<|"), F.struct(F.substring_index(F.substring_index(x, "|>", 1), "<|", -1).alias("type"), F.lit(None).cast("string").alias("text")))
                       .otherwise(F.struct(F.lit("text").alias("type"), unescape(x).alias("text"))))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: role, text (the texts of all its parts), parts."""
    pieces = F.slice(F.split(formatted, r"\[TURN\]"), 2, F.lit(1 << 30))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        parts = _body_parts(body)
        return F.struct(unescape(role, NEWLINE).alias("role"), F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), parts.alias("parts"))
    return F.transform(pieces, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, without placeholders."""
    return F.array_join(F.transform(loss, lambda s: F.array_join(F.transform(
        _body_parts(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))), lambda p: p["text"]), "")), "")


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted conversations."""
    turns = read_turns(F.col("formatted"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (formatted.select("conv_id", "formatted", turns.alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("learnt"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                    F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def with_probe(conversations: DataFrame) -> DataFrame:
    """Adds conversation -1, whose texts look like control strings of a template."""
    spark = conversations.sparkSession
    text = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)


def report(conversations: DataFrame) -> DataFrame:
    return digests(format_messages(text_messages(with_probe(conversations))))


REPORT_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(text) + (length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '<', '')))
    + (length(text) - length(replace(text, '[', ''))) as body from rows),
joined as (
  select conv_id, count(*) as n, string_agg(role || chr(10) || text || chr(10), '' order by turn) as told,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn), '') as learnt,
    sum(body + length('[TURN]') + length(role) + 1 + length('</s>')) as chars
  from sized group by conv_id)
select conv_id, cast(n as bigint) as n_turns, sha256(told) as turns_sha256, cast(length(learnt) as bigint) as loss_chars,
  sha256(learnt) as loss_sha256, cast(chars as bigint) as formatted_chars from joined
"""
