"""Chat formatting: a finite-state machine over roles and text segments with loss flags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """A declarative template: what stands around a turn, which roles are learned, which turn may follow which.

    `moves` maps (state, role) to the next state. A conversation is valid if every role has a move and it
    ends in one of `final`. Control strings must begin with `<|`.
    """

    turn_start: str = "<|im_start|>"
    after_role: str = "\n"
    turn_end: str = "<|im_end|>"
    after_turn: str = "\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("answered",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )


CHAT_ML = ChatTemplate()


def escape(text: Column) -> Column:
    r"""Break control strings: `<`, n backslashes, `|` gets one backslash more. Nothing else changes."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    """The text that `escape` was given: it never writes `<|`, so one backslash comes off again."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    """A role ends at the end of its line, so line ends in it are broken as well, reversibly."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def _final_state(roles: Column, template: ChatTemplate) -> Column:
    """The machine's state after all roles; NULL once a role has no move."""
    pairs = []
    for (state, role), after in template.moves.items():
        pairs += [F.lit(f"{state}\n{role}"), F.lit(after)]
    moves = F.create_map(*pairs)
    return F.aggregate(
        roles,
        F.lit(template.start),
        lambda state, role: F.try_element_at(moves, F.concat(state, F.lit("\n"), role)),
    )


def format_chats(
    conversations: DataFrame,
    template: ChatTemplate = CHAT_ML,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: its turns as text segments, each with a loss flag, and whether its roles are in order.

    Returns `conv_id, segments array<struct<text string, loss boolean>>, formatted string, valid boolean,
    state string`. Only the texts of learned roles carry loss, not the marks around them. `formatted` is
    the segments end to end. `state` is the machine's last state, NULL where a role had no move.

    Rows go by turn, NULL first, then role and text, so that ties have one order; repeated rows stay.
    NULL texts and roles are empty; rows with a NULL conversation form one. Conversations that are out of order
    are formatted all the same, with `valid` false. A conversation is one output value, so its rows meet in one task;
    there is no other grouping.
    """
    t = template
    as_turn = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    turns = conversations.groupBy(F.col(conv_id).alias("conv")).agg(F.sort_array(F.collect_list(as_turn)).alias("turns"))
    no_loss = F.lit(False)

    def segments_of(x: Column) -> Column:
        return F.array(
            F.struct(
                F.concat(F.lit(t.turn_start), _escape_role(x["role"]), F.lit(t.after_role)).alias("text"),
                no_loss.alias("loss"),
            ),
            F.struct(escape(x["text"]).alias("text"), x["role"].isin(*t.learned).alias("loss")),
            F.struct(F.lit(t.turn_end + t.after_turn).alias("text"), no_loss.alias("loss")),
        )

    state = _final_state(F.col("turns.role"), t)
    out = turns.select(
        F.col("conv").alias(conv_id),
        F.flatten(F.transform("turns", segments_of)).alias("segments"),
        state.alias("state"),
    )
    return out.select(
        conv_id,
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        F.coalesce(F.col("state").isin(*t.final), no_loss).alias("valid"),
        "state",
    )


def read_turns(formatted: Column, template: ChatTemplate = CHAT_ML) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    t = template
    # Texts hold no control string, so each mark in the output is the template's own.
    parts = F.split(formatted, _quoted(t.turn_start))
    turns = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))

    def read(x: Column) -> Column:
        head = F.substring_index(x, t.after_role, 1)
        rest = F.substr(x, F.char_length(head) + len(t.after_role) + 1)
        body = F.substring_index(rest, t.turn_end, 1)
        return F.struct(_unescape_role(head).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, read)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in literal)
