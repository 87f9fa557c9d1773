"""Chat formatting: turn order by a state machine, text segments with loss flags, reading back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from roadtally.llm.columns import let


@dataclass(frozen=True)
class Template:
    """How turns are written and which roles are learned.

    ``moves`` is the state machine: a state and a role give the next state; what is not listed is
    an error. ``opening`` begins both marks, so that a text without it cannot hold a mark.
    """

    opening: str = "<|"
    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_end: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("begin", "system"): "asked to",
            ("begin", "user"): "asked",
            ("asked to", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )


CHATML = Template()


def escape(text: Column, template: Template = CHATML, one_line: bool = False) -> Column:
    """Make marks impossible inside a text. After the first step every backslash is followed by
    an ``s``, so the ``p`` and ``n`` written later are told apart and :func:`unescape` is exact.
    ``one_line`` also hides what ends a role."""
    text = F.replace(text, F.lit("\\"), F.lit("\\s"))
    if one_line:
        text = F.replace(text, F.lit(template.after_role), F.lit("\\n"))
    head, last = template.opening[:-1], template.opening[-1]
    return F.replace(text, F.lit(template.opening), F.lit(f"{head}\\p{last}"))


def unescape(text: Column, template: Template = CHATML) -> Column:
    text = F.replace(text, F.lit("\\p"), F.lit(""))
    text = F.replace(text, F.lit("\\n"), F.lit(template.after_role))
    return F.replace(text, F.lit("\\s"), F.lit("\\"))


def format_chats(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, template: Template = CHATML
) -> DataFrame:
    """One row for each conversation: ``conv_id, n_turns, valid, first_error, segments, formatted``.

    ``segments`` are (text, loss) in order; joined they are ``formatted``. Only the text of a turn
    of a loss role is flagged. A null role or text is empty, a null turn comes first, turns of
    equal number are ordered by role and text, and repeated rows stay. Rows of a null conversation
    form one. A conversation that breaks the turn order is formatted all the same: ``valid`` is
    false and ``first_error`` the place of the first turn that is out of order. A conversation is
    one text, so its turns meet in one row.
    """
    one = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("said"),
    )
    chats = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    moves = F.create_map(
        *[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)]
    )

    def step(state: Column, turn: Column) -> Column:
        following = moves[F.concat(state["at"], F.lit("\n"), turn["role"])]
        wrong = (state["error"] < 0) & following.isNull()
        return F.struct(
            F.coalesce(following, F.lit("wrong")).alias("at"),
            (state["seen"] + 1).alias("seen"),
            F.when(wrong, state["seen"]).otherwise(state["error"]).alias("error"),
        )

    start = F.struct(F.lit("begin").alias("at"), F.lit(0).alias("seen"), F.lit(-1).alias("error"))
    error = F.aggregate("said", start, step, lambda s: s["error"])

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def written(turn: Column) -> Column:
        head = F.concat(F.lit(template.start), escape(turn["role"], template, one_line=True), F.lit(template.after_role))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(turn["text"], template), turn["role"].isin(*template.loss_roles)),
            segment(F.lit(template.end + template.after_end), F.lit(False)),
        )

    out = chats.select(
        "conv_id",
        F.size("said").cast("long").alias("n_turns"),
        error.alias("_error"),
        F.flatten(F.transform("said", written)).alias("segments"),
    )
    return out.select(
        "conv_id",
        "n_turns",
        (F.col("_error") < 0).alias("valid"),
        F.when(F.col("_error") >= 0, F.col("_error")).alias("first_error"),
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) that a formatted text holds."""

    def turn(body: Column) -> Column:
        cut = F.instr(body, template.after_role)
        tail = len(template.end + template.after_end)
        text = F.substring(body, cut + F.lit(len(template.after_role)), F.length(body) - cut - tail - len(template.after_role) + 1)
        return F.struct(
            unescape(F.substring(body, F.lit(1), cut - 1), template).alias("role"),
            unescape(text, template).alias("text"),
        )

    parts = F.split(formatted, r"\Q" + template.start + r"\E")
    return let(parts, lambda p: F.transform(F.slice(p, F.lit(2), F.size(p) - 1), turn))


def loss_text(segments: Column, template: Template = CHATML) -> Column:
    """What is learned: the flagged segments as they were before escaping."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"], template)), "")
