"""Chat formatting of typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them in
order into one text: text parts are escaped, every other part becomes a placeholder numbered
within its turn, with a record of what it refers to and of the tokens it will expand to. A turn
is written as

    <|turn|>role<|says|>content<|end|>

and a conversation is its turns one after the other, so turns are formatted on their own and a
conversation of any length needs no task to hold it. A backslash inside a control string breaks
it up, and backslashes are doubled: removing one level of backslashes gives the text back.

Defined cases: a NULL text is empty, a NULL role is an empty role; turns sort by ``turn`` (NULL
first), then by their formatted text; repeated rows are separate turns; rows with a NULL conv_id
form one conversation; an empty table gives no rows; parts of unknown kind are an error. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, map_batches

TURN, SAYS, END, NEXT = "<|turn|>", "<|says|>", "<|end|>", "<|part|>"
# Control strings of this template (all start with "<|") and of other common ones.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HOLDER = re.compile(r"<\|(image|audio|document):(\d+)\|>")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for."""

    image_patch: int = 28
    audio_per_second: float = 25.0
    document_per_page: int = 600


@dataclass
class Flattener:
    """Visits the parts of one turn in order."""

    expansion: Expansion
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind'] or 'text'}")(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        patch = self.expansion.image_patch
        self._attach(part, -(-(part["width"] or 0) // patch) * -(-(part["height"] or 0) // patch))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, int(-(-(part["seconds"] or 0.0) * self.expansion.audio_per_second // 1)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * self.expansion.document_per_page)

    def _attach(self, part: dict, tokens: int) -> None:
        place = len(self.attachments)
        self.attachments.append({"place": place, "kind": part["kind"], "ref": part["ref"], "tokens": tokens})
        self.pieces.append(f"<|{part['kind']}:{place}|>")

    def content(self) -> str:
        return NEXT.join(self.pieces)


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    rest = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in rest.items()]))


def format_turns(turns: DataFrame, expansion: Expansion = Expansion(), learn: str = "assistant") -> DataFrame:
    """One row per turn of (conv_id, turn, role, parts): its formatted text, loss span and attachments.

    ``loss_from`` and ``loss_to`` are the code points of ``formatted`` that hold the content of a
    turn by ``learn``; both are 0 for other roles. ``expanded_tokens`` sums the attachments.
    """
    out = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("turn", pa.int64()),
            ("formatted", pa.string()),
            ("loss_from", pa.int64()),
            ("loss_to", pa.int64()),
            ("expanded_tokens", pa.int64()),
            (
                "attachments",
                pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])),
            ),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = []
            for conv, turn, role, parts in zip(*(rows.column(n).to_pylist() for n in ("conv_id", "turn", "role", "parts")), strict=True):
                flat = Flattener(expansion)
                for part in parts or ():
                    flat.visit(part)
                head = TURN + escape(role or "") + SAYS
                content = flat.content()
                span = (len(head), len(head) + len(content)) if role == learn else (0, 0)
                tokens = sum(a["tokens"] for a in flat.attachments)
                found.append((conv, turn, head + content + END, *span, tokens, flat.attachments))
            if found:
                yield batch(out, *zip(*found, strict=True))

    chosen = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), "parts")
    return map_batches(
        chosen,
        run,
        "conv_id long, turn long, formatted string, loss_from long, loss_to long, expanded_tokens long, "
        "attachments array<struct<place:int,kind:string,ref:string,tokens:long>>",
    )


def read_turn(formatted: str) -> tuple[str, list[str]]:
    """Role and parts of a formatted turn: texts unescaped, placeholders as they are."""
    if not (formatted.startswith(TURN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, content = formatted[len(TURN) : len(formatted) - len(END)].split(SAYS)
    parts = content.split(NEXT)
    return unescape(role), [p if _HOLDER.fullmatch(p) else unescape(p) for p in parts]


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from formatted turns in order: digests of turns and of the loss text.

    Rows of a conversation are sorted into one task and streamed through; none is kept.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    out = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def closed():
            n, turns, chars, loss, length = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length

        for rows in batches:
            done = []
            for own, text, a, z in zip(*(rows.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_from", "loss_to")), strict=True):
                if state is None or own != conv:
                    if state is not None:
                        done.append(closed())
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, parts = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{''.join(parts)}\n".encode())
                learned = "".join(p if _HOLDER.fullmatch(p) else unescape(p) for p in text[a:z].split(NEXT))
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
            if done:
                yield batch(out, *zip(*done, strict=True))
        if state is not None:
            yield batch(out, *zip(closed(), strict=True))

    ordered = formatted.select("conv_id", "turn", "formatted", "loss_from", "loss_to").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return map_batches(ordered, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
