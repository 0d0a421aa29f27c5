"""Conversations as training text, checked by parsing the text back.

The grammar of the text::

    conversation := turn*
    turn         := speaker? opener text closer
    speaker      := "<role>" name "</role>"        (roles other than the three with marks)
    opener/closer:  "[INST]" "[/INST]" user, "<s>" "</s>" assistant, "<<SYS>>" "<</SYS>>" others

A text ends at the next control string, so one that says a control string itself would be
read back as something else. Every turn is therefore rendered as it is, parsed, and compared
with its source; only what differs is escaped, and a turn that does not come back identical
then stops the run. Escaping puts a backslash behind the first character of a control
string, also where one stands there already, and takes it away again, so it is reversible
and leaves all other texts as they are. Everything is DataFrame functions, turn by turn;
only the finished text of a conversation is put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartledger.llm.common import free_name, quoted

USER, ASSISTANT, OTHER = ("[INST]", "[/INST]"), ("<s>", "</s>"), ("<<SYS>>", "<</SYS>>")
SPEAKER = ("<role>", "</role>")
#: The role that is meant by a system mark without a speaker.
SYSTEM = "system"

_TAILS = r"(?:/?INST\]|/?s>|</?SYS>>|/?role>)"
_CONTROL = rf"(?:[<\[]{_TAILS})"
_ESCAPABLE, _ESCAPED = rf"([<\[])(\\*+{_TAILS})", rf"([<\[])\\(\\*+{_TAILS})"
#: A turn: speaker, opener, text, and what ends it, which may be the wrong control string.
_TURN = rf"(?s)(?:<role>.*?</role>)?+(?:\[INST\]|<s>|<<SYS>>).*?{_CONTROL}"

TURNS_TYPE = "array<struct<role: string, text: string>>"
SEGMENTS_TYPE = "array<struct<text: string, loss: boolean>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPABLE), F.lit(r"$1\\$2"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2"))


def _marks(role: Column, at: int) -> Column:
    return (
        F.when(role == "user", USER[at]).when(role == "assistant", ASSISTANT[at]).otherwise(OTHER[at])
    )


def _opening(role: Column, name: Column) -> Column:
    """What stands before a text: the speaker where the mark does not tell, and the opener."""
    plain = role.isin("user", "assistant", SYSTEM)
    speaker = F.when(plain, "").otherwise(F.concat(F.lit(SPEAKER[0]), name, F.lit(SPEAKER[1])))
    return F.concat(speaker, _marks(role, 0))


def _between(piece: Column, before: int, after: int) -> Column:
    return F.substr(piece, F.lit(before + 1), F.length(piece) - (before + after))


def _turn(piece: Column) -> Column:
    """(role, text) of a piece that ``_complete`` accepts."""
    name = F.substring_index(piece, SPEAKER[1], 1)
    rest = F.substr(piece, F.length(name) + len(SPEAKER[1]) + 1)
    said = (
        F.when(piece.startswith(SPEAKER[0]), _between(rest, *map(len, OTHER)))
        .when(piece.startswith(USER[0]), _between(piece, *map(len, USER)))
        .when(piece.startswith(ASSISTANT[0]), _between(piece, *map(len, ASSISTANT)))
        .otherwise(_between(piece, *map(len, OTHER)))
    )
    role = (
        F.when(piece.startswith(SPEAKER[0]), unescaped(F.substr(name, F.lit(len(SPEAKER[0]) + 1))))
        .when(piece.startswith(USER[0]), "user").when(piece.startswith(ASSISTANT[0]), "assistant").otherwise(SYSTEM)
    )
    return F.struct(role.alias("role"), unescaped(said).alias("text"))


def _complete(piece: Column) -> Column:
    """Whether a piece ends with the mark of its own kind."""
    of = [piece.startswith(o) & piece.endswith(c) for o, c in (USER, ASSISTANT, OTHER)]
    speaker = piece.startswith(SPEAKER[0]) & F.contains(piece, F.lit(SPEAKER[1] + OTHER[0])) & piece.endswith(OTHER[1])
    return of[0] | of[1] | of[2] | speaker


def parse(df: DataFrame, text: str, turns: str) -> DataFrame:
    """Add ``turns``, the (role, text) that a rendered text holds, null where it breaks the grammar."""
    pieces = free_name(df.columns, "_pieces")
    # A column of its own, as functions over arrays would look for the pieces again and again.
    found = df.withColumn(pieces, F.regexp_extract_all(quoted(text), F.lit(_TURN), F.lit(0)))
    # Nothing may stand between turns.
    whole = (F.array_join(pieces, "") == quoted(text)) & F.forall(pieces, _complete)
    return found.withColumn(turns, F.when(whole, F.transform(pieces, _turn))).drop(pieces)


def segments(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, segments) with one row a conversation; ``segments`` are (text, loss) in order.

    Joined they are the formatted text. ``loss`` marks the assistant's words, as escaped,
    without any mark around them. Rows stand by turn, null turns first; ties by role and
    text as escaped, so repeated rows are repeated turns. Null roles and texts are empty; rows without a
    conversation are one conversation of their own. An empty table gives no rows.
    """
    given = rows.select(
        quoted(conv).alias("conv"), quoted(turn).alias("turn"),
        F.coalesce(quoted(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))

    def rendered(name: Column, said: Column) -> Column:
        return F.concat(_opening(F.col("role"), name), said, _marks(F.col("role"), 1))

    # A turn alone tells: the grammar knows no state but that of the turn it is in.
    plain = parse(given.withColumn("whole", rendered(F.col("role"), F.col("text"))), "whole", "back")
    tried = plain.select("conv", "turn", "role", "text", F.col("back").eqNullSafe(source).alias("plain")).select(
        "conv", "turn", "role", "text", "plain",
        F.when(F.col("plain"), F.col("role")).otherwise(escaped(F.col("role"))).alias("name"),
        F.when(F.col("plain"), F.col("text")).otherwise(escaped(F.col("text"))).alias("said"),
    )
    whole = F.when(~F.col("plain"), rendered(F.col("name"), F.col("said")))
    again = parse(tried.withColumn("whole", whole), "whole", "back")
    same = F.col("plain") | F.col("back").eqNullSafe(source)
    checked = again.select(
        "conv", "turn", "role", "name",
        F.when(same, F.col("said")).otherwise(F.raise_error(F.lit("a turn is not read back as it was"))).alias("said"),
        F.when(~F.col("plain"), F.col("text")).alias("text"),  # where it is not what is said
    )
    # Partial lists are made where the rows lie, so a long conversation is few rows in the shuffle.
    turns = checked.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "said", "name", "text"))).alias("turns")
    )
    parts = F.transform(
        "turns",
        lambda t: F.array(
            F.struct(_opening(t["role"], t["name"]).alias("text"), F.lit(False).alias("loss")),
            F.struct(t["said"].alias("text"), (t["role"] == "assistant").alias("loss")),
            F.struct(_marks(t["role"], 1).alias("text"), F.lit(False).alias("loss")),
        ),
    )
    built = turns.select("conv", "turns", F.flatten(parts).alias("segments"))
    back = parse(built.withColumn("whole", formatted(built)), "whole", "back")
    same = F.col("back").eqNullSafe(F.transform("turns", lambda t: F.struct(t["role"], F.coalesce(t["text"], t["said"]))))
    lost = F.raise_error(F.lit("a conversation is not read back as it was")).cast(SEGMENTS_TYPE)
    return back.select(F.col("conv").alias(conv), F.when(same, F.col("segments")).otherwise(lost).alias("segments"))


def formatted(chats: DataFrame) -> Column:
    """The text of a conversation from its segments."""
    return F.array_join(F.transform("segments", lambda s: s["text"]), "")


def read_back(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, text, turns, loss) of what ``segments`` returned.

    ``turns`` are parsed from the whole text, ``loss`` is what the mask covers, unescaped. A
    text that breaks the grammar stops the run.
    """
    whole = chats.select(
        quoted(conv).alias("conv"), formatted(chats).alias("text"),
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])).alias("loss"),
    )
    broken = F.raise_error(F.lit("a text breaks the grammar")).cast(TURNS_TYPE)
    back = parse(whole, "text", "turns")
    return back.select(F.col("conv").alias(conv), "text", F.coalesce("turns", broken).alias("turns"), "loss")


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES
    (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
marked AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*(?:/?INST\]|/?s>|</?SYS>>|/?role>))', '\1\\\2', 'g') AS said,
    CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 15 END
      + CASE WHEN role IN ('user', 'assistant', 'system') THEN 0 ELSE length('<role>' || role || '</role>') END AS marks
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, said)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, said) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(marks + length(said))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
