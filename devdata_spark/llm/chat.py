"""Chat conversations as one training string each, with Spark expressions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template. A turn block is
# <|turn|>ROLE<|says|>TEXT(<|and|>TEXT)*<|done|>, where texts joined by <|and|> are
# adjacent turns of one role.
TURN, SAYS, AND, DONE = "<|turn|>", "<|says|>", "<|and|>", "<|done|>"
# The first character of what a text may not hold as it is: the start of this template's
# control strings, the usual ones of other templates, and the escape sign itself.
CONTROL = r"\\|<(?=\||/?s>)|\[(?=/?INST\])"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """A backslash inside every control string and after every backslash."""
    return F.regexp_replace(text, CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    """The inverse of `escape`."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask.

    Turns are sorted by (turn, role, text), so ties have one order and repeated rows stay.
    Adjacent turns of a role form one block. NULL role and NULL text count as empty; a
    NULL turn sorts first; rows of NULL conversation form one conversation. Other columns
    are ignored, whatever their names. `loss_mask` holds runs over the code points of
    `formatted`, as (length, on); it is on exactly over the assistant's escaped texts.
    A conversation is one string, so its turns meet in one task.
    """
    collected = turns.groupBy(F.col(conv).alias("conv_id")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(turn).alias("turn"),
                    F.coalesce(F.col(role), F.lit("")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0)
        | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    blocks = F.transform(
        "starts",
        lambda first, k: F.struct(
            F.get("turns", first)["role"].alias("role"),
            F.transform(
                F.slice(
                    "turns",
                    first + 1,
                    F.coalesce(F.get("starts", k + 1), F.size("turns")) - first,
                ),
                lambda t: escape(t["text"]),
            ).alias("texts"),
        ),
    )

    def segments(block: Column) -> Column:
        mark = F.concat(F.lit(TURN), escape(block["role"]), F.lit(SAYS))
        return F.concat(
            F.flatten(
                F.transform(
                    block["texts"],
                    lambda t, k: F.array(
                        _segment(F.when(k == 0, mark).otherwise(F.lit(AND)), F.lit(False)),
                        _segment(t, block["role"] == LOSS_ROLE),
                    ),
                )
            ),
            F.array(_segment(F.lit(DONE), F.lit(False))),
        )

    return (
        collected.withColumn("starts", starts)
        .withColumn("blocks", blocks)
        .withColumn("segments", F.flatten(F.transform("blocks", segments)))
        .select(
            "conv_id",
            F.array_join(F.transform("segments", lambda s: s["s"]), "").alias("formatted"),
            F.transform(
                "segments",
                lambda s: F.struct(F.length(s["s"]).alias("length"), s["on"].alias("on")),
            ).alias("loss_mask"),
        )
    )


def _segment(text: Column, on: Column) -> Column:
    return F.struct(text.alias("s"), on.alias("on"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    blocks = F.split(formatted, _quoted(DONE), -1)
    return F.flatten(
        F.transform(
            F.slice(blocks, F.lit(1), F.size(blocks) - 1),
            lambda block: _turns_of(block),
        )
    )


def _turns_of(block: Column) -> Column:
    at = F.instr(block, SAYS)
    role = unescape(F.substring(block, F.lit(len(TURN) + 1), at - len(TURN) - 1))
    body = F.substring(block, at + len(SAYS), F.length(block))
    return F.transform(
        F.split(body, _quoted(AND), -1),
        lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
    )


def _quoted(mark: str) -> str:
    return r"\Q" + mark + r"\E"


def under_mask(formatted: Column, mask: Column) -> Column:
    """The parts of a formatted conversation that the loss counts, unescaped, in order."""
    state = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, run: Column) -> Column:
        part = unescape(F.substring(formatted, acc["at"], run["length"]))
        return F.struct(
            (acc["at"] + run["length"]).alias("at"),
            F.when(run["on"], F.concat(acc["parts"], F.array(part)))
            .otherwise(acc["parts"])
            .alias("parts"),
        )

    return F.aggregate(mask, state, step)["parts"]
