"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names, per role, the text before and after a turn and whether the
turn's text carries loss.  ``format_segments`` emits one row per segment; only
the text of a loss role is flagged, never the marks around it.  Strings that
could be read as control marks are escaped inside texts, reversibly, so
``read_segments`` gets every turn back from the formatted text alone.

Turns are formatted in the order (turn, role, text); repeated rows stay and
count as turns.  A null role or text counts as empty; rows with a null
conversation id form one conversation of their own.  An order of roles that
the machine refuses is still formatted and is flagged ``valid = false``.  An
empty table gives no rows; further columns are dropped.

Rows are dealt by conversation, sorted, and streamed: a task holds one turn and
the machine's state at a time, however long the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Marks around a turn, loss roles, and the role machine."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Strings that a text must never hold as they are.
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
                                 "<<SYS>>", "<</SYS>>")
    #: state -> role -> next state; a conversation is valid if it ends in ``final``.
    machine: dict = field(default_factory=lambda: {
        "start": {"system": "asked", "user": "user"},
        "asked": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    final: tuple[str, ...] = ("assistant",)

    def escape(self, text: str) -> str:
        """Double the escape sign and split every control string after its first character."""
        text = text.replace(ESCAPE, ESCAPE * 2)
        for c in self.controls:
            text = text.replace(c, c[0] + ESCAPE + c[1:])
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace("\n", ESCAPE + "\n")


DEFAULT = Template()
SEGMENTS = "conv_id long, seg long, kind string, segment string, loss boolean, valid boolean"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, valid boolean")


def format_segments(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Segments of every conversation of ``turns(conv_id, turn, role, text)``, in order within a partition.

    ``kind`` is ``mark`` or ``text``; a last row of kind ``end`` per conversation
    tells whether the machine accepted the order of its roles.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, n, started = None, "start", 0, False
        out: list[tuple] = []
        for b in batches:
            for conv, null, role, text in zip(b["conv"], b["no_conv"], b["role"], b["text"], strict=True):
                conv = None if null else int(conv)
                if not started or conv != current:
                    if started:
                        out.append((current, n, "end", "", False, state in template.final))
                    current, state, n, started = conv, "start", 0, True
                state = template.machine.get(state, {}).get(role, "refused")
                loss = role in template.loss_roles
                mark = template.before.replace("{role}", template.escape_role(role))
                out += [(conv, n, "mark", mark, False, None), (conv, n + 1, "text", template.escape(text), loss, None),
                        (conv, n + 2, "mark", template.after, False, None)]
                n += 3
            yield pd.DataFrame(out, columns=["conv_id", "seg", "kind", "segment", "loss", "valid"]).astype({"conv_id": "Int64"})
            out = []
        if started:
            out.append((current, n, "end", "", False, state in template.final))
            yield pd.DataFrame(out, columns=["conv_id", "seg", "kind", "segment", "loss", "valid"]).astype({"conv_id": "Int64"})

    rows = turns.select(F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"), F.col("conv_id").isNull().alias("no_conv"),
                        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return (rows.repartition("conv", "no_conv").sortWithinPartitions("no_conv", "conv", "turn", "role", "text")
            .mapInPandas(run, SEGMENTS))


class TurnReader:
    """Reads turns back from a formatted text that arrives piece by piece.

    Holds one turn at most.  A turn begins at the unescaped start mark; its role
    ends at the first newline without an escape sign before it; its text ends at
    the unescaped end mark (inside a text every control string is broken up).
    """

    def __init__(self, template: Template):
        head, tail = template.before.split("{role}")
        self.pattern = re.compile(re.escape(head) + r"((?:\\.|[^\\\n])*)" + re.escape(tail) + r"(.*?)" + re.escape(template.after), re.S)
        self.template, self.buffer = template, ""

    def feed(self, piece: str) -> list[tuple[str, str]]:
        self.buffer += piece
        if not piece.endswith(self.template.after):
            return []
        got, at = [], 0
        while m := self.pattern.match(self.buffer, at):
            got.append((self.template.unescape(m[1]), self.template.unescape(m[2])))
            at = m.end()
        self.buffer = self.buffer[at:]
        return got


def read_segments(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests per conversation, read back from its segments (which must come in ``format_segments``' order)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fresh = lambda: [TurnReader(template), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
        state = fresh()
        for b in batches:
            out = []
            for conv, kind, segment, loss, valid in zip(b["conv_id"], b["kind"], b["segment"], b["loss"], b["valid"], strict=True):
                if kind == "end":
                    reader, n, turns, chars, lost, total = state
                    if reader.buffer:
                        raise ValueError(f"conversation {conv}: a turn of the formatted text does not end")
                    out.append((None if pd.isna(conv) else int(conv), n, turns.hexdigest(), chars, lost.hexdigest(), total, valid))
                    state = fresh()
                    continue
                for role, text in state[0].feed(segment):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if loss:
                    text = template.unescape(segment)
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(segment)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in DIGESTS.split(", ")]).astype({"conv_id": "Int64"})

    return segments.mapInPandas(run, DIGESTS)
