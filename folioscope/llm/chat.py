"""Chat formatting: a finite-state machine over roles checks turn order, a declarative template emits text segments
with a loss flag each, and control strings inside texts are escaped reversibly.

A conversation may be of any length: rows are dealt by range of (conv_id, turn), so a hot conversation is formatted by
many tasks. Each task emits bounded fragments of formatted text; a fragment carries the state machine's effect for every
entry state, so that fragments compose in order without being formatted again. Only the running digests of `read_back`,
which are sequential by definition, pass over a conversation in one task, as a stream of fragments in bounded memory.

Null text and null role: empty. Null turn: before all others. Equal turns: by role, then text; repeated rows all count.
Null conv_id: a conversation of its own. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """turn = opening + role + header_end + text + closing; roles in `loss_roles` have their text under the loss mask.

    `order` maps a state to the roles it accepts and the state each leads to; any other role is counted as out of order
    and leads to the state `after` gives it.
    """

    opening: str = "### "
    header_end: str = ": "
    closing: str = " </turn>\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    order: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )

    def __post_init__(self) -> None:
        if len(self.escape) != 1 or any(not s or self.escape in s for s in self.controls):
            raise ValueError("the escape is one character, which no control string holds")
        if any(a != b and a in b for a in self.controls for b in self.controls):
            raise ValueError("a control string holds another one")

    @property
    def controls(self) -> tuple[str, ...]:
        return self.opening, self.header_end, self.closing

    @property
    def states(self) -> list[str]:
        return sorted({self.start, *self.order, *(t for o in self.order.values() for t in o.values())})

    def after(self, state: str, role: str) -> tuple[str, bool]:
        """The next state and whether the role may stand there."""
        if (to := self.order.get(state, {}).get(role)) is not None:
            return to, True
        return next((o[role] for o in self.order.values() if role in o), state), False


class Codec:
    """Writes and reads turns in a template's format.

    An escape is put before every place of a role or text where the escape or a control string begins, even one that would be completed
    only by the control string that follows. So the first control string that a reader meets without an escape is the template's own.
    """

    def __init__(self, template: Template) -> None:
        self.t = template
        marks = "|".join(map(re.escape, (template.escape, *template.controls)))
        self.mark = re.compile(f"(?={marks})")
        self.escaped = re.compile(f"{re.escape(template.escape)}(.)", re.DOTALL)
        one = f"(?:{re.escape(template.escape)}.|(?!{marks}).)*+"
        self.turn = re.compile(f"{re.escape(template.opening)}({one}){re.escape(template.header_end)}({one}){re.escape(template.closing)}", re.DOTALL)

    def hide(self, text: str, following: str) -> str:
        out, at = [], 0
        for m in self.mark.finditer(text + following):
            if m.start() >= len(text):
                break
            out += text[at : m.start()], self.t.escape
            at = m.start()
        return "".join(out) + text[at:]

    def show(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[1], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Text segments of a turn with their loss flags."""
        return [(self.t.opening + self.hide(role, self.t.header_end) + self.t.header_end, False), (self.hide(text, self.t.closing), role in self.t.loss_roles), (self.t.closing, False)]

    def read(self, text: str) -> Iterator[tuple[str, str, int, int]]:
        """Role, text and the span of the escaped text of each turn of a formatted text."""
        at = 0
        while at < len(text):
            if not (m := self.turn.match(text, at)):
                raise ValueError(f"no turn at {at}")
            yield self.show(m[1]), self.show(m[2]), m.start(2), m.end(2)
            at = m.end()


#: Characters of formatted text after which a fragment ends; a longer turn makes a fragment of its own.
FRAGMENT_CHARS = 256 << 10
#: Characters of a text by which rows of one turn and role are dealt; texts that agree on them go to one task, which orders them whole.
RANGE_CHARS = 100

FRAGMENTS = "conv_id long, part_turn long, part_role string, part_text string, part_no long, n_turns long, formatted string, loss array<struct<start:int,end:int>>, exits array<int>, out_of_order array<long>"


def format_chats(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """Fragments of formatted conversations, in order by part_no within a conversation.

    formatted: whole turns; loss: spans of it under the loss mask; exits and out_of_order: for each entry state (by its
    place in `Template.states`) the state after the fragment and the number of turns out of order in it.
    """
    template = template or Template()
    arrow = pa.schema([("conv_id", pa.int64()), ("part_turn", pa.int64()), ("part_role", pa.string()), ("part_text", pa.string()), ("part_no", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("exits", pa.list_(pa.int32())), ("out_of_order", pa.list_(pa.int64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, states = Codec(template), template.states
        at = {s: i for i, s in enumerate(states)}
        open_: dict | None = None
        done: list[dict] = []
        number = size = 0

        def close() -> None:
            nonlocal open_
            if open_:
                open_["formatted"] = "".join(open_.pop("pieces"))
                open_["exits"] = [at[s] for s in open_.pop("now")]
                done.append(open_)
                open_ = None

        for batch in source:
            for conv, turn, role, text, order in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                role, text = role or "", text or ""
                if open_ and (open_["conv_id"] != conv or open_["chars"] >= FRAGMENT_CHARS):
                    close()
                if not open_:
                    open_ = {"conv_id": conv, "part_turn": turn, "part_role": role, "part_text": order, "part_no": number, "n_turns": 0, "pieces": [], "loss": [], "chars": 0, "now": list(states), "out_of_order": [0] * len(states)}
                    number += 1
                for piece, loss in codec.segments(role, text):
                    if loss:
                        open_["loss"].append({"start": open_["chars"], "end": open_["chars"] + len(piece)})
                    open_["pieces"].append(piece)
                    open_["chars"] += len(piece)
                open_["n_turns"] += 1
                for i, s in enumerate(open_["now"]):
                    open_["now"][i], fine = template.after(s, role)
                    open_["out_of_order"][i] += not fine
                size += len(text)
            if size >= 4 * FRAGMENT_CHARS:
                if done:
                    yield pa.RecordBatch.from_pylist(done, arrow)
                done, size = [], 0
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, arrow)

    base = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumn("first", F.substring("text", 1, RANGE_CHARS))
    keys = ["conv_id", "turn", "role", "first"]
    n = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = base.repartitionByRange(int(n), *keys).sortWithinPartitions(*keys, "text")
    return dealt.select("conv_id", "turn", "role", "text", "first").mapInArrow(run, FRAGMENTS)


def read_back(fragments: DataFrame, template: Template | None = None) -> DataFrame:
    """Reads formatted fragments back: per conversation the number of turns, digests of all turns and of the text under the loss
    mask (unescaped), lengths in code points, and the number of turns out of order."""
    template = template or Template()
    fields = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_out_of_order", pa.int64())]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, states = Codec(template), template.states
        done: list[dict] = []
        conv, open_ = object(), None

        def close() -> None:
            if open_:
                open_["turns_sha256"] = open_.pop("turns").hexdigest()
                open_["loss_sha256"] = open_.pop("masked").hexdigest()
                open_.pop("state")
                done.append(open_)

        for batch in source:
            for part in batch.to_pylist():
                if part["conv_id"] != conv or open_ is None:
                    close()
                    conv = part["conv_id"]
                    open_ = {"conv_id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "masked": hashlib.sha256(), "formatted_chars": 0, "n_out_of_order": 0, "state": states.index(template.start)}
                masked = {(x["start"], x["end"]) for x in part["loss"]}
                for role, text, start, end in codec.read(part["formatted"]):
                    open_["n_turns"] += 1
                    open_["turns"].update(f"{role}\n{text}\n".encode())
                    if (start, end) in masked:
                        open_["loss_chars"] += len(text)
                        open_["masked"].update(text.encode())
                open_["formatted_chars"] += len(part["formatted"])
                open_["n_out_of_order"] += part["out_of_order"][open_["state"]]
                open_["state"] = part["exits"][open_["state"]]
            if len(done) >= 4096:
                yield pa.RecordBatch.from_pylist(done, pa.schema(fields))
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema(fields))

    order = ["conv_id", "part_turn", "part_role", "part_text", "part_no"]
    return fragments.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_out_of_order long")
