"""Chat formatting by quotation linking, in built-in functions only.

Lines that begin with ``>`` marks are quoted, as deep as they have marks. Every
quoted line is normalised and hashed, and joined to the first message of its
conversation that says the same line unquoted. What the outermost quotes point
at is what a message replies to; without a link it is the turn before. The
conversation is then ordered by replies, and its messages hold no quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktally.llm.common import cut, quoted

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
_CONV, _TURN = "conv", "turn"


def quote_lines(text: Column) -> Column:
    """An array of ``(depth, line)``, in order; depth 0 is unquoted and its line whole."""

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 1)
        depth = F.length(F.regexp_replace(marks, r"[^>]", ""))
        return F.struct(
            depth.alias("depth"),
            F.when(depth == 0, line).otherwise(F.regexp_replace(line, MARKS, "")).alias("line"),
        )

    return F.transform(F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n", -1), parse)


def passage_key(line: Column) -> Column:
    """A hash of a line with case, punctuation and spacing taken away; null if nothing is left."""
    plain = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain != "", F.sha2(plain, 256))


def _roots(messages: DataFrame) -> DataFrame:
    """``conv, turn, root, depth``: the first ancestor and the number of steps to it.

    Pointers double: after round r a message knows its ancestor ``2 ** r`` steps up.
    Only messages that have not met a first one yet go through the next round.
    Parents have smaller turns, so there is no cycle.
    """
    start = messages.select(
        _CONV,
        _TURN,
        F.coalesce("reply_to", _TURN).alias("root"),
        F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        F.col("reply_to").isNull().alias("done"),
    )
    finished, active = start.where("done"), start.where("NOT done")
    while not active.isEmpty():
        above = finished.unionByName(active).select(
            F.col(_CONV),
            F.col(_TURN).alias("root"),
            F.col("root").alias("up"),
            F.col("depth").alias("more"),
            F.col("done").alias("met"),
        )
        moved = cut(
            active.join(above, [_CONV, "root"]).select(
                _CONV, _TURN, F.col("up").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.col("met").alias("done")
            ),
            "quotes-roots",
        )
        finished, active = finished.unionByName(moved.where("done")), moved.where("NOT done")
    return finished.drop("done")


def link_quotes(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, turn, role, reply_to, root, depth, n_quoted, n_linked, content, rendered``.

    One row per message. ``content`` is its text without quoted lines, trimmed;
    ``rendered`` the same as a chat turn. Sorted by ``(conv_id, root, depth, turn)``
    every message comes after the one it replies to: conversations stay rows, so
    that a very long one is no group of its own.

    ``reply_to`` is the turn that most of the outermost quoted lines point at,
    the later one of equals; else the turn just before, if there is one; else
    null. ``n_quoted`` counts quoted lines with a word in them, ``n_linked`` those
    whose original was found. A quote may only point back. Rows without a
    conversation or turn are in no order: they come through with their content
    and no links. Rows that repeat a conversation and turn are one message, the
    one with the least role and text. Null text is empty. Columns beyond these
    are not read; an empty table gives no rows.
    """
    given = messages.select(
        F.col(quoted(conv_col)).alias(_CONV),
        F.col(quoted(turn_col)).cast("long").alias(_TURN),
        F.col(quoted(role_col)).alias("role"),
        F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"),
    )
    parsed = given.withColumn("lines", quote_lines(F.col("text")))
    own = F.filter("lines", lambda x: x["depth"] == 0)
    formatted = parsed.select(
        _CONV,
        _TURN,
        "role",
        F.trim(F.regexp_replace(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), r"^\s+|\s+$", "")).alias("content"),
        F.transform(
            F.filter("lines", lambda x: x["line"].rlike(r"[\p{L}\p{N}]")),
            lambda x: F.struct(x["depth"].alias("depth"), passage_key(x["line"]).alias("key")),
        ).alias("keys"),
    )
    nameless = formatted.where(F.col(_CONV).isNull() | F.col(_TURN).isNull())
    stored = cut(
        formatted.where(F.col(_CONV).isNotNull() & F.col(_TURN).isNotNull())
        .groupBy(_CONV, _TURN)
        .agg(F.min(F.struct("role", "content", "keys")).alias("m"))
        .select(_CONV, _TURN, "m.role", "m.content", "m.keys"),
        "quotes-messages",
    )
    said = stored.select(_CONV, _TURN, F.explode("keys").alias("k")).select(_CONV, _TURN, "k.depth", "k.key")
    originals = said.where("depth = 0").groupBy(_CONV, "key").agg(F.min(_TURN).alias("said_in"))
    # equal quoted lines of a message count together, which also bounds the join by distinct lines
    quotes = said.where("depth > 0").groupBy(_CONV, _TURN, "depth", "key").count()
    linked = quotes.join(originals, [_CONV, "key"], "left").withColumn(
        "said_in", F.when(F.col("said_in") < F.col(_TURN), F.col("said_in"))
    )
    votes = (
        linked.groupBy(_CONV, _TURN, "said_in")
        .agg(
            F.sum("count").alias("all_lines"),
            F.sum(F.when(F.col("depth") == 1, F.col("count")).otherwise(0)).alias("outer_lines"),
        )
        .groupBy(_CONV, _TURN)
        .agg(
            F.sum("all_lines").alias("n_quoted"),
            F.sum(F.when(F.col("said_in").isNotNull(), F.col("all_lines")).otherwise(0)).alias("n_linked"),
            F.max(
                F.when((F.col("outer_lines") > 0) & F.col("said_in").isNotNull(), F.struct("outer_lines", "said_in"))
            ).alias("best"),
        )
    )
    before = stored.select(_CONV, (F.col(_TURN) + 1).alias(_TURN), F.col(_TURN).alias("before"))
    replies = cut(
        stored.drop("keys")
        .join(votes, [_CONV, _TURN], "left")
        .join(before, [_CONV, _TURN], "left")
        .select(
            _CONV,
            _TURN,
            "role",
            "content",
            F.coalesce(F.col("best.said_in"), F.col("before")).alias("reply_to"),
            F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        ),
        "quotes-replies",
    )
    ordered = replies.join(_roots(replies), [_CONV, _TURN])
    rest = nameless.select(
        _CONV,
        _TURN,
        "role",
        "content",
        F.lit(None).cast("long").alias("reply_to"),
        F.size(F.filter("keys", lambda k: k["depth"] > 0)).cast("long").alias("n_quoted"),
        F.lit(0).cast("long").alias("n_linked"),
        F.lit(None).cast("long").alias("root"),
        F.lit(None).cast("long").alias("depth"),
    )
    rendered = F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("content"), F.lit("<|end|>\n")
    )
    return ordered.unionByName(rest).select(
        F.col(_CONV).alias("conv_id"),
        F.col(_TURN).alias("turn"),
        "role",
        "reply_to",
        "root",
        "depth",
        "n_quoted",
        "n_linked",
        "content",
        rendered.alias("rendered"),
    )


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """The conversations as mail-like messages, some of which quote the two before.

    The given table holds no quotes: message ``turn`` quotes the one before where
    ``(conv_id + turn) % 3 = 0``, and that one's own text two turns before, a
    level deeper, where it is also a multiple of two.
    """
    key = ["conv_id", "turn"]
    text = F.coalesce("text", F.lit(""))
    back = [
        conversations.select("conv_id", (F.col("turn") + step).alias("turn"), text.alias(f"back{step}"))
        .groupBy(*key)
        .agg(F.min(f"back{step}").alias(f"back{step}"))
        for step in (1, 2)
    ]
    number = F.col("conv_id") + F.col("turn")
    first = F.regexp_replace("back1", r"(?m)^", "> ")
    second = F.regexp_replace("back2", r"(?m)^", "> > ")
    quote = F.when(
        (number % 3 == 0) & F.col("back1").isNotNull(),
        F.concat(
            F.when((number % 2 == 0) & F.col("back2").isNotNull(), F.concat(second, F.lit("\n"))).otherwise(""),
            first,
            F.lit("\n\n"),
        ),
    ).otherwise("")
    return (
        conversations.join(back[0], key, "left")
        .join(back[1], key, "left")
        .select("conv_id", "turn", "role", F.concat(quote, text).alias("text"))
    )


def op5_quotes(spark, sf_dir: str) -> DataFrame:
    return link_quotes(quoting_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
