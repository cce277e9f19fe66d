"""Chat formatting by a finite-state machine and a declarative template.

A conversation's turns, in order, become text segments with a loss flag each.
The machine checks the order of roles; turns out of order are formatted all
the same and flagged.  Control strings inside texts are escaped so that the
formatted text can be read back exactly.

Defined results: a null text or role is empty; a null ``conv_id`` is a
conversation of its own; turns with equal numbers are ordered by role, then text; repeated
rows are repeated turns; an empty table gives no segments.  Only the four
named columns are read.  A conversation is one sequential text, so it is
formatted by one task, as a stream: memory holds one turn at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """Marks around a turn, roles that are learned, and the machine's moves."""

    start: str = "<|turn|>"
    body: str = "<|text|>"
    end: str = "<|end|>"
    learned: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; a missing move is a turn out of order
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "ready", "user": "asked"},
        "ready": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    #: control strings of this and of common other templates (fixed values)
    controls: tuple[str, ...] = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
                                 "<|im_start|>", "<|im_end|>", "<|endoftext|>")

    def escape(self, text: str) -> str:
        """Double every backslash; put one after the first sign of each control string."""
        if "\\" in text:
            text = text.replace("\\", "\\\\")
        return re.sub("(?=" + "|".join(map(re.escape, self.controls)) + ").", lambda m: m[0] + "\\", text, flags=re.S)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments ``conv_id, seg, segment, loss, in_order``, in reading order inside each partition.

    Every turn gives three: its head (never learned), its text (learned for
    the template's roles) and its end mark.
    """
    kind = dict(turns.dtypes)["conv_id"]
    src = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    src = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state, seg, first = None, "start", 0, True
        for b in batches:
            out = []
            for c, missing, role, text in zip(b["conv_id"], b["conv_id"].isna(), b["role"], b["text"]):
                c = None if missing else c
                if first or c != conv:
                    conv, state, seg, first = c, "start", 0, False
                following = template.moves.get(state, {}).get(role)
                state = following or "broken"
                ok = following is not None
                out.append((c, seg, template.start + template.escape(role) + template.body, False, ok))
                out.append((c, seg + 1, template.escape(text), role in template.learned, ok))
                out.append((c, seg + 2, template.end, False, ok))
                seg += 3
            frame = pd.DataFrame(out, columns=["conv_id", "seg", "segment", "loss", "in_order"])
            yield frame.astype({"conv_id": "object"} if b["conv_id"].isna().any() else {"conv_id": b["conv_id"].dtype})

    return src.mapInPandas(run, f"conv_id {kind}, seg long, segment string, loss boolean, in_order boolean")


class _Reader:
    """Reads formatted text back, segment by segment, keeping one turn."""

    def __init__(self, template: Template):
        self.t, self.rest, self.turns, self.chars, self.loss_chars, self.ok = template, "", 0, 0, 0, True
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, segment: str, loss: bool, ok: bool) -> None:
        self.chars += len(segment)
        self.ok &= ok
        if loss:
            plain = unescape(segment)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.rest += segment
        if segment != self.t.end:  # an escaped text never holds it
            return
        head, _, body = self.rest[len(self.t.start):-len(self.t.end)].partition(self.t.body)
        self.rest = ""
        self.turns += 1
        self.all.update(f"{unescape(head)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, read from the formatted segments alone."""
    kind = dict(segments.dtypes)["conv_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, reader = None, None

        def row():
            return (conv, reader.turns, reader.all.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars, reader.ok)

        def frame(rows):
            return pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "order_ok"], dtype="object")

        for b in batches:
            out = []
            for c, missing, s, loss, ok in zip(b["conv_id"], b["conv_id"].isna(), b["segment"], b["loss"], b["in_order"]):
                c = None if missing else c
                if reader is None or c != conv:
                    if reader is not None:
                        out.append(row())
                    conv, reader = c, _Reader(template)
                reader.feed(s, bool(loss), bool(ok))
            if out:
                yield frame(out)
        if reader is not None:
            yield frame([row()])

    # the segments of a conversation lie together and in order, as format_turns left them
    return segments.mapInPandas(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, order_ok boolean")


__all__ = ["Template", "unescape", "format_turns", "read_back"]
