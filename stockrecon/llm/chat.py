"""Conversations as one training text each, in DataFrame expressions only.

Template: ``### role: text</turn>`` and a line break per turn; turns of one role in
a row are merged into one, their texts set apart by ``<part/>``. Inside texts a
backslash is doubled and every control string gets a backslash after its first
character, so control strings occur nowhere but where the template put them, and
plain splitting reads the turns back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, ROLE_END, PART, END = "### ", ": ", "<part/>", "</turn>\n"
LEARNED_ROLE = "assistant"
#: Turns whose places are added up together, so that long conversations take linear time.
CHUNK = 256


def escape(text: Column) -> Column:
    for plain, safe in (
        ("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>"), ("<part/>", "<\\part/>"),
    ):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    for plain, safe in (("%", "%25"), (":", "%3A"), ("<", "%3C"), ("#", "%23")):
        role = F.replace(role, F.lit(plain), F.lit(safe))
    return role


def _unescape_role(role: Column) -> Column:
    for plain, safe in (("#", "%23"), ("<", "%3C"), (":", "%3A"), ("%", "%25")):
        role = F.replace(role, F.lit(safe), F.lit(plain))
    return role


def _chunks(items: Column, size: Column) -> Column:
    """Consecutive parts of an array; an empty array has one empty part."""
    last = F.greatest(F.floor((F.size(items) - 1) / size), F.lit(0)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice(items, i * size + 1, size)
    )


def format_chats(
    turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", learned: str = LEARNED_ROLE,
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    Turns stand in the order of ``turn``, equal ones by role and text; repeated
    rows are repeated turns. ``loss_spans`` are start and length, in code points
    of ``formatted``, of every text of the ``learned`` role. Null texts and roles
    count as empty, null ids form one conversation, an empty table gives none. A
    conversation is one row here and in the result, so it has to fit in a row.
    """
    chats = turns.groupBy(F.col(id_col).alias("conv_id")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )

    def marked(x: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1)["role"], F.get("turns", i + 1)["role"]
        return F.struct(
            F.when(~before.eqNullSafe(x["role"]) | (i == 0),
                   F.concat(F.lit(HEAD), _escape_role(x["role"]), F.lit(ROLE_END)))
            .otherwise(PART).alias("lead"),
            escape(x["text"]).alias("body"),
            F.when(after.eqNullSafe(x["role"]), "").otherwise(END).alias("tail"),
            (x["role"] == learned).alias("learned"),
        )

    def span(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["lead"])
        size = F.length(x["body"])
        one = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct(
            (start + size + F.length(x["tail"])).alias("at"),
            F.when(x["learned"], F.concat(state["spans"], one)).otherwise(state["spans"])
            .alias("spans"),
        )

    none = F.expr("cast(array() as array<struct<start:int,length:int>>)")
    zero = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def later(state: Column, part: Column) -> Column:
        one = F.array(F.struct(state["at"].alias("base"), part["spans"].alias("spans")))
        return F.struct(
            (state["at"] + part["at"]).alias("at"), F.concat(state["parts"], one).alias("parts")
        )

    parts = F.transform(_chunks(F.col("m"), F.lit(CHUNK)), lambda c: F.aggregate(c, zero, span))
    no_parts = F.expr(
        "cast(array() as array<struct<base:int,spans:array<struct<start:int,length:int>>>>)"
    )
    placed = F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), no_parts.alias("parts")), later,
        lambda s: s["parts"],
    )
    spans = F.transform(
        placed,
        lambda part: F.transform(
            part["spans"],
            lambda s: F.struct((s["start"] + part["base"]).alias("start"), s["length"]),
        ),
    )
    return chats.select("conv_id", F.transform("turns", marked).alias("m")).select(
        "conv_id",
        F.array_join(
            F.transform("m", lambda x: F.concat(x["lead"], x["body"], x["tail"])), ""
        ).alias("formatted"),
        F.flatten(spans).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation, unmerged and unescaped."""

    def opened(turn: Column) -> Column:
        head = F.substring_index(turn, ROLE_END, 1)
        body = F.substr(turn, F.length(head) + 1 + len(ROLE_END))
        role = _unescape_role(F.substr(head, F.lit(len(HEAD) + 1)))
        return F.transform(
            F.split(body, PART),
            lambda part: F.struct(role.alias("role"), unescape(part).alias("text")),
        )

    whole = F.split(formatted, END)
    return F.flatten(F.transform(F.slice(whole, F.lit(1), F.size(whole) - 1), opened))


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    Spans are cut out of the part of the text that a chunk of them covers, since
    finding a place in a text takes as long as the text before it.
    """

    def text_of(chunk: Column) -> Column:
        first, last = F.get(chunk, F.lit(0)), F.get(chunk, F.size(chunk) - 1)
        start = first["start"]
        part = F.substr(formatted, start + 1, last["start"] + last["length"] - start)
        return F.get(
            F.transform(
                F.array(part),
                lambda p: F.array_join(
                    F.transform(
                        chunk, lambda s: unescape(F.substr(p, s["start"] - start + 1, s["length"]))
                    ),
                    "",
                ),
            ),
            F.lit(0),
        )

    size = F.greatest(F.ceil(F.sqrt(F.size(spans))), F.lit(CHUNK)).cast("int")
    return F.array_join(F.transform(_chunks(spans, size), text_of), "")
