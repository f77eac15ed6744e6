"""Chat formatting: a finite-state machine over roles emits text segments with loss flags from a declarative template.

Rows of a conversation are shuffled to one partition and sorted; the formatter and the reader walk over them as a
stream and keep one state, so a conversation of any length needs no memory of its own.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import bound_batches


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles whose text is trained on, and which role may follow which.

    ``follows[state]`` lists the roles allowed after a turn of role ``state``; "" is the beginning. A conversation is
    well formed if every step is allowed and its last role is in ``last``.
    """

    opens: str = "<|im_start|>"
    after_role: str = "\n"
    closes: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    last: tuple[str, ...] = ("assistant",)


def escape(text: str) -> str:
    """A backslash goes before the bar of ``<|``, and before those already there: no control string is left."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _role_in(name: str) -> str:
    return unescape(name).replace("%0A", "\n").replace("%25", "%")


def segments(role: str, text: str, template: Template) -> list[tuple[str, bool]]:
    """A turn as (text, loss) segments; only the text of trained roles has loss."""
    return [(template.opens + _role_out(role) + template.after_role, False), (escape(text), role in template.trained), (template.closes, False)]


def format_turns(rows: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, in order within its partition: ``conv``, ``at`` (0, 1 ...), ``allowed`` and ``segments``.

    Turns are ordered by turn, then role, then text; null turns come first, null roles and texts are empty, rows
    without a conversation id form one conversation. ``allowed`` tells if the machine accepts the step from the
    previous role; turns it does not accept are formatted all the same. Extra columns are not read.
    """
    template = template or Template()
    bound_batches(rows.sparkSession)
    kind = rows.schema[conv].dataType.simpleString()
    ready = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ready = ready.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches):
        state, at, now = "", 0, object()
        for batch in batches:
            out = {"conv": batch.column(0), "at": [], "allowed": [], "segments": []}
            for key, role_, text_ in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if key != now:
                    state, at, now = "", 0, key
                out["at"].append(at)
                out["allowed"].append(role_ in template.follows.get(state, ()))
                out["segments"].append([{"text": t, "loss": loss} for t, loss in segments(role_, text_, template)])
                state, at = role_, at + 1
            yield pa.RecordBatch.from_arrays(
                [out["conv"], pa.array(out["at"], pa.int64()), pa.array(out["allowed"], pa.bool_()),
                 pa.array(out["segments"], pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))],
                names=list(out),
            )

    return ready.mapInArrow(run, f"conv {kind}, at bigint, allowed boolean, segments array<struct<text:string,loss:boolean>>")


class Reader:
    """Reads formatted output back, segment by segment, and digests what it finds; no turn but the current is held."""

    def __init__(self, template: Template):
        self.template = template
        self.turns, self.formatted, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.held: list[str] = []
        self.valid, self.role = True, ""

    def feed(self, text: str, loss: bool) -> None:
        self.formatted += len(text)
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.held.append(text)
        if text.endswith(self.template.closes):
            self._turn("".join(self.held))
            self.held = []

    def _turn(self, whole: str) -> None:
        t = self.template
        if not whole.startswith(t.opens):
            raise ValueError("a turn does not begin with its mark")
        name, _, body = whole[len(t.opens) : len(whole) - len(t.closes)].partition(t.after_role)
        self.role = _role_in(name)
        self.all.update(f"{self.role}\n{unescape(body)}\n".encode())
        self.turns += 1


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation what its formatted output says: ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``,
    ``formatted_chars`` and ``valid`` (every step allowed and a last role that may end). No turns give no rows."""
    template = template or Template()
    kind = formatted.schema["conv"].dataType.simpleString()

    def run(batches):
        reader, now, done = None, None, []

        def close():
            done.append((now, reader.turns, reader.all.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.formatted, reader.valid and reader.role in template.last))

        def flush():
            columns = list(zip(*done, strict=True))
            kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            done.clear()
            return batch

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, at, allowed, parts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at == 0:
                    if reader is not None:
                        close()
                    reader, now = Reader(template), key
                reader.valid &= allowed
                for part in parts:
                    reader.feed(part["text"], part["loss"])
            if done:
                yield flush()
        if reader is not None:
            close()
            yield flush()

    return formatted.mapInArrow(
        run, f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean"
    )
