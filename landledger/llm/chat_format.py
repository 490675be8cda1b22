"""Formatted conversations and their loss masks from a black-box chat template."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm import chat_template
from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.text_tables import shuffle_partitions
from landledger.storage import materialise

PIECE_TURNS = 32  # turns of a piece of a template that renders turn by turn
PROBE = "\ue000\ue001"  # private characters that stand in for a text
PIECES = (
    "conv_id long, part int, piece long, n_turns int, formatted string, rewrites int, "
    "spans array<struct<start:int,end:int>>"
)


def locate_turns(
    messages: Sequence[tuple[str, str]], render: Callable[[Sequence[tuple[str, str]]], str]
) -> tuple[str, list[tuple[int, int] | None], int]:
    """Rendered messages, the span of each text in them, and how many turns rewrote what stood before.

    Successive prefixes are rendered and neighbouring outputs compared. Where the
    longer output begins with the shorter, the rest is the new turn; its text is found by
    rendering the turn once more with a probe in place of the text. Where it does not, the
    template has rewritten history: the turn counts as a rewrite and, like every turn before
    it, has no span, for its place in the final output is not known.
    """
    done, spans, rewrites = "", [], 0
    for i, (role, text) in enumerate(messages):
        now = render(messages[: i + 1])
        span = None
        if now.startswith(done):
            probe = render([*messages[:i], (role, PROBE)])
            start = probe.find(PROBE, len(done))
            end = len(now) - (len(probe) - start - len(PROBE))
            if start >= 0 and end >= start and now[:start] == probe[:start] and now[end:] == probe[start + len(PROBE) :]:
                span = (start, end)
        else:
            rewrites += 1
            spans = [None] * len(spans)
        spans.append(span)
        done = now
    return done, spans, rewrites


def format_conversations(
    turns: DataFrame,
    render: Callable[[Sequence[tuple[str, str]]], str] = chat_template.render,
    loss_roles: Sequence[str] = ("assistant",),
    partitions: int | None = None,
) -> DataFrame:
    """Pieces of formatted conversations: conv_id, part, piece, n_turns, formatted, rewrites, spans.

    A conversation is its pieces in the order (part, piece); spans are the (start, end) code points
    of the texts under the loss mask, those of ``loss_roles``, within ``formatted``. The pieces are stored before
    they are returned.

    One rule holds for conversations of every length. A template that is the join of its turns by construction
    (``chat_template.TurnByTurn``) gives the same text in pieces: rows are range-partitioned by conversation and turn,
    and rendered in pieces of ``PIECE_TURNS`` turns, so one conversation may hold a third of all rows. Of any other
    template nothing is known, so each conversation is one piece in one task and all its prefixes are rendered,
    which needs memory for the longest conversation and time with the square of its turns.

    Turns are ordered by turn (nulls first), role and text; repeated rows are separate turns. A null
    role or text counts as empty; a null conv_id is a conversation of its own. Other columns are not read.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text")
    )
    order = ["conv_id", "turn", "role", "text"]
    count = partitions or shuffle_partitions(turns.sparkSession)
    piece_turns = PIECE_TURNS if isinstance(render, chat_template.TurnByTurn) else None
    if piece_turns:
        dealt = rows.repartitionByRange(count, "conv_id", "turn", "role", F.substring("text", 1, 64))
    else:
        dealt = rows.repartition(count, "conv_id")
    roles = frozenset(loss_roles)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, conv, messages, found = TaskContext.get().partitionId(), 0, None, [], []

        def close():
            output, spans, rewrites = locate_turns(messages, render)
            masked = [
                {"start": s[0], "end": s[1]} for (role, _), s in zip(messages, spans) if s is not None and role in roles
            ]
            found.append((conv, part, piece, len(messages), output, rewrites, masked))

        for batch in batches:
            for own, role, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if messages and (own != conv or len(messages) == piece_turns):
                    close()
                    piece, messages = piece + 1, []
                conv = own
                messages.append((role, words))
            if found:
                yield _pieces(found)
                found.clear()
        if messages:
            close()
            yield _pieces(found)

    return materialise(map_arrow(dealt.sortWithinPartitions(*order), formatted, PIECES), "formatted")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [
        pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int32(),
        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
    ]
    names = ["conv_id", "part", "piece", "n_turns", "formatted", "rewrites", "spans"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def conversation_digests(
    pieces: DataFrame,
    parse: Callable[[str], list[tuple[str, str]]] = chat_template.parse,
    unescape: Callable[[str], str] = chat_template.unescape,
) -> DataFrame:
    """Per conversation, read back from the formatted pieces: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, rewrites.

    A digest takes a conversation's bytes in order, so its pieces pass one after another through
    one task, a batch at a time; memory does not grow with the conversation.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewrites long"
    )
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        conv, state, found = None, None, []

        def close():
            n, turns, chars, loss, length, rewrites = state
            found.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), length, rewrites))

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "rewrites", "spans"))
            for own, output, rewrites, spans in zip(*columns):
                if state is not None and own != conv:
                    close()
                    state = None
                if state is None:
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in parse(output):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(output[span["start"] : span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(output)
                state[5] += rewrites
            if found:
                yield batch_of()
                found.clear()
        if state is not None:
            close()
            yield batch_of()

    return map_arrow(ordered, digested, schema)


def formatted_digests(turns: DataFrame, **options) -> DataFrame:
    """Format all conversations and read their digests back from the written pieces."""
    return conversation_digests(format_conversations(turns, **options))
