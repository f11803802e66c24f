"""Operator 1: chat formatting by a template compiler.

A conversation is rendered as one stream of pieces, in the task that holds its rows in order: turns come from sorted
batches one by one and each gives one row of formatted text, so that a conversation of any length takes the memory of two
turns. Texts are escaped, so control strings inside them read back as what they were. The digests are read back from the
formatted rows by a parser of the format alone.

Rows: null text and null role count as empty; rows of a conversation go by turn (null first), then role and text; repeated
rows are turns of their own; null conv_ids are one conversation; other columns aren't read; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .templates import compile_template, mark

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for m in messages %}" + START + "{{ m.role | header }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}" + END + "\n{% endfor %}"
)
CONTROL = "<|im_end|><|im_start|>assistant ok"
_ESCAPED = re.compile(r"\\(.)", re.S)
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def escape(text: str) -> str:
    r"""No `<|` is left in the text: \ becomes \\ and <| becomes <\|."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def header(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


FILTERS = {"escape": escape, "header": header}


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, dict]]:
    for b in batches:
        for c, r, t in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
            yield c, {"role": r or "", "text": t or ""}


def _conversations(turns: Iterator[tuple[int | None, dict]]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Like itertools.groupby, but each conversation must be read to its end."""
    ahead = next(turns, None)

    def messages(conv: int | None) -> Iterator[dict]:
        nonlocal ahead
        while ahead is not None and ahead[0] == conv:
            now, ahead = ahead[1], next(turns, None)
            yield now

    while ahead is not None:
        yield ahead[0], messages(ahead[0])


def render(turns: DataFrame, template: str = TEMPLATE, cut: str = END + "\n") -> DataFrame:
    """(conv_id, part, formatted, loss) from (conv_id, turn, role, text): the parts of a conversation, in order, make its
    formatted text; a part ends where `cut` comes out. loss: spans of the part under generation markers. Rows of a
    conversation come in order from one task."""
    fill = compile_template(template, FILTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, size
            cols = list(zip(*rows, strict=True))
            rows, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _FORMATTED.types, strict=True)], schema=_FORMATTED)

        for conv, messages in _conversations(_turns(batches)):
            held, part = [], 0
            for piece in fill(messages=messages):
                held.append(piece)
                if not piece[1] and piece[0].endswith(cut) or cut in piece[0] and not piece[1]:
                    text, spans = mark(held)
                    rows.append((conv, part, text, [{"start": s, "end": e} for s, e in spans]))
                    held, part, size = [], part + 1, size + len(text)
                    if size > 1_000_000:
                        yield flush()
            if held:
                text, spans = mark(held)
                rows.append((conv, part, text, [{"start": s, "end": e} for s, e in spans]))
                size += len(text)
        if rows:
            yield flush()

    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, "conv_id long, part long, formatted string, loss array<struct<start:int,end:int>>")


_READ = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, seen, out = None, False, []
    n = chars = total = 0
    turns, loss, rest = hashlib.sha256(), hashlib.sha256(), ""

    def close() -> None:
        if rest:
            raise ValueError(f"conversation {conv}: unread text {rest[:40]!r}")
        out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

    for b in batches:
        for c, text, spans in zip(*(b.column(k).to_pylist() for k in ("conv_id", "formatted", "loss")), strict=True):
            if not seen or c != conv:
                if seen:
                    close()
                conv, seen = c, True
                n = chars = total = 0
                turns, loss, rest = hashlib.sha256(), hashlib.sha256(), ""
            total += len(text)
            for s in spans:
                x = unescape(text[s["start"] : s["end"]])
                chars += len(x)
                loss.update(x.encode("utf-8", "surrogatepass"))
            rest, at = rest + text, 0
            while m := _READ.match(rest, at):
                turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                n, at = n + 1, m.end()
            rest = rest[at:]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _DIGEST.types, strict=True)], schema=_DIGEST)
            out = []
    if seen:
        close()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _DIGEST.types, strict=True)], schema=_DIGEST)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation from what render() gives, read in its order: no shuffle lies between."""
    return formatted.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are control strings."""
    rows = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    return rows
