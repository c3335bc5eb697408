"""Chat formatting: conversations rendered by a compiled template, with the training mask.

Conversations are dealt by ``conv_id`` and sorted by turn inside their
partition; a partition is then read as a stream, one message at a time, and
the output leaves in parts of bounded size. A conversation's parts stay in one
partition because its digests run over the whole text in order.

A null text or role reads as empty, rows of one turn follow their role and
text, null turns come first, rows with a null ``conv_id`` form one
conversation. Repeated rows are messages of their own. Extra columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from apportion.llm.chat_template import compile_template, unescape

#: Turn marks. Texts and roles are escaped, so that no mark can occur in them.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
CHAT_TEMPLATE = (
    "{% for m in messages %}"
    f"{TURN}{{{{ m.role | escape }}}}{TEXT}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    f"{END}"
    "{% endfor %}"
)
#: Code points after which a conversation's output goes on in a new part (parts end with a message).
PART_CHARS = 1 << 18

PARTS = "conv_id long, part int, formatted string, loss_starts array<long>, loss_ends array<long>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Parts:
    """Collects a renderer's pieces into parts with their generated spans."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.pieces: list[str] = []
        self.size, self.starts, self.ends = 0, [], []

    def write(self, text: str, generated: bool) -> None:
        if generated:
            if self.ends and self.ends[-1] == self.size:
                self.ends[-1] += len(text)
            else:
                self.starts.append(self.size)
                self.ends.append(self.size + len(text))
        self.pieces.append(text)
        self.size += len(text)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)


def format_conversations(conversations: DataFrame, template: str = CHAT_TEMPLATE) -> DataFrame:
    """Each conversation's output in parts, with the spans (code points in the part) that the loss covers.

    The template has one loop over ``messages``; a message has ``role`` and ``text``.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()), ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64()))])

    def render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renderer = compile_template(template)

        def parts() -> Iterator[tuple]:
            for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
                sink, done, whole = _Parts(), 0, False

                def messages() -> Iterator[dict]:
                    nonlocal whole
                    for _, role, text in rows:
                        whole = True  # what was written so far ends with a message
                        yield {"role": role or "", "text": text or ""}

                for text, generated in renderer(messages()):
                    if whole and sink.size > PART_CHARS:
                        yield conv_id, done, "".join(sink.pieces), sink.starts, sink.ends
                        sink.clear()
                        done += 1
                    whole = False
                    sink.write(text, generated)
                yield conv_id, done, "".join(sink.pieces), sink.starts, sink.ends

        yield from _batches(parts(), schema, 64)

    rows = conversations.selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "cast(role as string) role", "cast(text as string) text")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(render, PARTS)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    while at < len(formatted):
        mid, end = formatted.index(TEXT, at), formatted.index(END, at)
        if not formatted.startswith(TURN, at) or mid > end:
            raise ValueError(f"no turn at {at}")
        yield unescape(formatted[at + len(TURN) : mid]), unescape(formatted[mid + len(TEXT) : end])
        at = end + len(END)


def conversation_digests(parts: DataFrame) -> DataFrame:
    """Digests read back from formatted parts, which lie in order in their partition (as :func:`format_conversations` leaves them)."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
                turns, loss, n, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for _, _, formatted, starts, ends in rows:
                    n_chars += len(formatted)
                    for role, text in read_turns(formatted):
                        turns.update(f"{role}\n{text}\n".encode())
                        n += 1
                    for a, b in zip(starts, ends):
                        text = unescape(formatted[a:b])
                        loss.update(text.encode())
                        n_loss += len(text)
                yield conv_id, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars

        yield from _batches(digests(), schema, 4096)

    return parts.mapInArrow(read, DIGESTS)


def with_marked_conversation(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts hold control strings of other templates."""
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    extra = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").union(extra)
