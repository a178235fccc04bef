"""Chat formatting with a grammar round trip, with Spark's own functions only.

A conversation is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. A
deterministic parser reads the rendered text back; turns that do not come back as
they were conflict with the grammar, and their content is escaped, until the
recovered turns are identical to the source.

Escaping puts one more backslash between ``<`` and ``|`` (after any there are),
which the parser always takes away; so no escaped text holds a control string,
and a text with such backslashes of its own conflicts and is escaped as well.
In roles, line feeds and backslashes are escaped too, as a role ends at a line feed.

Defined results: null texts and roles are empty; turns are ordered by turn, then
role and text, nulls first, and rows that repeat stay; a null conversation id is a
conversation of its own; other columns are ignored. A conversation is one row
of the result, so one must fit into a row: that is inherent in a digest over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    # A backslash becomes \s and a line feed \n, so no letter behind a backslash is the role's own.
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def render(turns: Column) -> Column:
    """The text of turns, an array of (role, text) whose content is already safe or meant to be tried."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t.role, F.lit("\n"), t.text, F.lit(END + "\n"))), "")


def parse(formatted: Column) -> Column:
    """The turns of a rendered text, unescaped: cut at the end marks, then at the first line feed of each turn.

    A turn that does not begin with the start mark, or holds the beginning of another mark, is read as nulls.
    """
    parts = F.split(formatted, r"<\|im_end\|>\n")
    # What follows the last end mark is no turn unless there is something.
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)

    def turn(part: Column) -> Column:
        body = F.when(F.startswith(part, F.lit(START)), F.substring(part, len(START) + 1, 1 << 30))
        body = F.when(~F.contains(body, F.lit("<|")), body)
        cut = F.instr(body, "\n")
        return F.struct(
            unescape_role(F.substring(body, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(body, cut + 1, F.lit(1 << 30))).alias("text"))
    return F.transform(parts, turn)


def format_chats(rows: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, turns, formatted, recovered, identical``.

    ``turns`` is the source, ``recovered`` what the parser reads from ``formatted``.
    Each turn is tried as it stands first; those that conflict are escaped.
    """
    said = rows.select(F.col(id).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"))
    # Whether a turn conflicts is seen from the turn alone, before rows are gathered.
    said = said.select("conv_id", "t", F.struct("t.role", "t.text").alias("as_is"))
    safe = F.struct(escape_role(F.col("t.role")).alias("role"), escape(F.col("t.text")).alias("text"))
    said = said.select("conv_id", "t", F.when(
        parse(render(F.array("as_is"))) == F.array(F.struct("t.role", "t.text")), F.col("as_is")).otherwise(safe).alias("sent"))
    chats = said.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("t.turn", "t.role", "t.text", "sent"))).alias("all"))
    chats = chats.select(
        "conv_id", F.transform("all", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"),
        render(F.transform("all", lambda t: t.sent)).alias("formatted"))
    chats = chats.withColumn("recovered", parse(F.col("formatted")))
    return chats.withColumn("identical", F.col("recovered") == F.col("turns"))


def digests(chats: DataFrame, *, learnt: str = "assistant") -> DataFrame:
    """Counts and digests of what was read back; a conversation that did not come back whole raises an error.

    The loss mask holds the texts of role ``learnt``, unescaped, without what stands between them.
    """
    whole = F.when(F.col("identical"), F.col("recovered")).otherwise(
        F.raise_error(F.concat(F.lit("conversation does not round trip: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    seen = chats.select("conv_id", "formatted", whole.alias("turns"))
    masked = F.array_join(F.transform(F.filter("turns", lambda t: t.role == learnt), lambda t: t.text), "")
    return seen.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
