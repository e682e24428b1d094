"""Chat formatting by prefix-target expansion, in DataFrame expressions only.

Every assistant turn of a conversation becomes an example of its own: all turns before it are the
context, and only its reply is trainable. A conversation whose last turns follow its last assistant turn
(or that has none) gets one more example without a target, so that the output holds every turn.

Template of a turn: ``<|turn|>`` role, newline, text, ``<|end|>``, newline. Inside roles and texts ``&`` is written
``&amp;`` and then the control strings ``<|``, ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]`` lose their first
character to an entity, which ``unescape`` turns back; a role's line ends become entities too.

Cases: null roles and texts count as empty; turns that tie on their number are ordered by role and text,
a null number comes first; repeated rows are repeated turns; rows with a null conversation form one
conversation; an empty table gives no rows; other columns are not read. Examples of one conversation
repeat its earlier turns, as the method asks, and are streamed one row each. A conversation, and so each of its
examples, is one value of a row, which Spark bounds at 2 GB; a longer one, rows with a null conversation included,
fails its job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
#: Control strings of common chat templates, and what they become.
CONTROL = {"<|": "&lt;|", "<s>": "&lt;s>", "</s>": "&lt;/s>", "[INST]": "&#91;INST]", "[/INST]": "&#91;/INST]"}


def _replace(c: Column, a: str, b: str) -> Column:
    return F.replace(c, F.lit(a), F.lit(b))


def escape(text: Column) -> Column:
    out = _replace(F.coalesce(text, F.lit("")), "&", "&amp;")
    for a, b in CONTROL.items():
        out = _replace(out, a, b)
    return out


def unescape(text: Column) -> Column:
    for a, b in (("&#10;", "\n"), ("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
        text = _replace(text, a, b)
    return text


def expand(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: conv, example (from 0), formatted, loss_start (code points, from 1), loss_length."""
    rows = df.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    shown = turns.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(F.lit(TURN), _replace(escape(t["role"]), "\n", "&#10;"), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("body"),
                (t["role"] == "assistant").alias("target"),
            ),
        ).alias("turns"),
    )
    # numbers of the turns that end an example: the targets, and the last turn
    numbers = F.filter(F.transform("turns", lambda t, i: F.when(t["target"] | (i == F.size("turns") - 1), i)), lambda i: i.isNotNull())
    each = shown.select("conv_id", "turns", F.explode(numbers).alias("example"))
    now = F.element_at("turns", F.col("example") + 1)
    before = F.concat_ws(
        "",
        F.transform(F.slice("turns", F.lit(1), F.col("example")), lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))),
        now["head"],
    )
    return (
        each.select("conv_id", "example", now["body"].alias("body"), now["target"].alias("target"), before.alias("before"))
        .select(
            "conv_id",
            "example",
            F.concat("before", "body", F.lit(END + "\n")).alias("formatted"),
            (F.length("before") + 1).alias("loss_start"),
            F.when(F.col("target"), F.length("body")).otherwise(0).alias("loss_length"),
        )
    )


def masked(formatted: Column, start: Column, length: Column) -> Column:
    """The text under an example's loss mask, as it was before escaping."""
    return unescape(F.substring(formatted, start, length))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted example."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")
    bare = F.transform(pieces, lambda p: F.substring(p, F.lit(len(TURN) + 1), F.length(p)))
    return F.transform(
        bare,
        lambda p: F.struct(
            unescape(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p))).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from its examples: turns, loss text and total length."""
    return (
        examples.groupBy("conv_id")
        .agg(
            F.max_by("formatted", "example").alias("whole"),
            F.sort_array(F.collect_list(F.struct("example", masked(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss")))).alias("losses"),
            F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
        )
        .select("conv_id", read_turns(F.col("whole")).alias("turns"), F.concat_ws("", F.transform("losses", lambda x: x["loss"])).alias("loss"), "formatted_chars")
    )


def digests(back: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
