"""Chat formatting with a grammar round trip.

Turns are rendered with control strings. A deterministic parser reads the rendering again; turns that it doesn't give back as
they were are escaped, and rendered and parsed anew until all are identical.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.llm.tables import save, small_batches, texts_of

# The template (fixed values): what stands before and after a text, by role; other roles are named in front of it.
FRAMES = {"system": ("<s><<SYS>> ", " <</SYS>></s>\n"), "user": ("<s>[INST] ", " [/INST]</s>\n"), "assistant": ("<s> ", " </s>\n")}
OTHER = ("<s>[ROLE] ", " [/ROLE] ", " </s>\n")
# Control strings, and the same with backslashes after the first character.
FAMILY = re.compile(r"(?:\[(?=\\*/?(?:INST|ROLE)\])|<(?=\\*(?:/?s>|</?SYS>>)))")
ESCAPED = re.compile(r"(\[(?=\\+/?(?:INST|ROLE)\])|<(?=\\+(?:/?s>|</?SYS>>)))\\")

PIECE_CHARS = 1 << 20  # a longer conversation is formatted in pieces that end where a turn ends
FORMATTED = "conv_id long, text string, loss array<struct<start: int, end: int>>, n_turns long, whole boolean"

_CONTROL = r"\[/?(?:INST|ROLE)\]|</?s>|<</?SYS>>"
_TEXT = rf"[^\[<]*(?:(?!{_CONTROL})[\[<][^\[<]*)*"
_TURN = re.compile(
    rf"<s>(?:<<SYS>> (?P<system>{_TEXT}) <</SYS>>|\[INST\] (?P<user>{_TEXT}) \[/INST\]"
    rf"|\[ROLE\] (?P<role>{_TEXT}) \[/ROLE\] (?P<other>{_TEXT}) | (?P<assistant>{_TEXT}) )</s>\n"
)

Turn = tuple[str, str]


def escape(text: str) -> str:
    """One backslash more in every control string, with or without backslashes, so that none is left bare."""
    return FAMILY.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """The text that `escape` was given."""
    return ESCAPED.sub(r"\1", text)


def _render_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before, as and after the text."""
    if role in FRAMES:
        before, after = FRAMES[role]
        return before, text, after
    return OTHER[0] + escape(role) + OTHER[1], text, OTHER[2]


def _turn_at(rendered: str, at: int) -> tuple[Turn, tuple[int, int], int] | None:
    """The turn that starts there, its text's span, and its end."""
    match = _TURN.match(rendered, at)
    if match is None:
        return None
    kind = match.lastgroup
    role = unescape(match["role"]) if kind == "other" else kind
    return (role, unescape(match[kind])), match.span(kind), match.end()


def parse(rendered: str) -> tuple[list[Turn], list[tuple[int, int]]]:
    """(turns, spans of the assistant's texts) of a formatted text; ValueError where it breaks the grammar."""
    turns, loss, at = [], [], 0
    while at < len(rendered):
        found = _turn_at(rendered, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turn, span, at = found
        turns.append(turn)
        if turn[0] == "assistant":
            loss.append(span)
    return turns, loss


def render(turns: Sequence[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, spans of the assistant's texts in it); `parse` gives the same turns and spans back.

    Only turns with conflicting content are escaped.
    """
    texts = [text for _, text in turns]
    conflicting: set[int] = set()
    while True:
        parts, loss, ends, at = [], [], [], 0
        for (role, _), text in zip(turns, texts):
            before, text, after = _render_turn(role, text)
            if role == "assistant":
                loss.append((at + len(before), at + len(before) + len(text)))
            parts += [before, text, after]
            at += len(before) + len(text) + len(after)
            ends.append(at)
        rendered = "".join(parts)
        try:
            if parse(rendered) == (list(turns), loss):
                return rendered, loss
        except ValueError:
            pass  # a turn below is at fault
        now = set()
        for i, (start, end) in enumerate(zip([0, *ends], ends)):
            found = _turn_at(rendered, start)
            if found is None or found[0] != turns[i] or found[2] != end:
                now.add(i)
        if not now - conflicting:
            raise ValueError("escaped turns still conflict")
        for i in now - conflicting:
            texts[i] = escape(texts[i])
        conflicting |= now


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations whose turns arrive in order.

    `whole` marks pieces that are surely a whole conversation: not the first or last of the partition, which may go on in another.
    """
    turns: list[Turn] = []
    chars, conv, number, pieces = 0, None, 0, 0

    def piece(whole: bool) -> pa.RecordBatch:
        text, loss = render(turns)
        spans = [{"start": a, "end": b} for a, b in loss]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([conv], pa.int64()), pa.array([text], pa.string()),
                pa.array([spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array([len(turns)], pa.int64()), pa.array([whole]),
            ],
            names=["conv_id", "text", "loss", "n_turns", "whole"],
        )

    def gathered(own: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if own:
            yield from pa.Table.from_batches(own).combine_chunks().to_batches()

    for batch in batches:
        done: list[pa.RecordBatch] = []
        for own, role, text in zip(batch.column("conv_id").to_pylist(), texts_of(batch.column("role")), texts_of(batch.column("text"))):
            if turns and (own != conv or chars > PIECE_CHARS):
                done.append(piece(own != conv and number > 0 and pieces == 0))
                number, pieces = (number, pieces + 1) if own == conv else (number + 1, 0)
                turns, chars = [], 0
            conv = own
            turns.append((role, text))
            chars += len(role) + len(text)
        yield from gathered(done)
    if turns:
        yield piece(False)


def format_chats(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """(conv_id, text, loss, n_turns, whole, piece): formatted conversations, and where the loss counts in them.

    Rows are dealt by ranges of conversation and turn, so a conversation with a third of all rows is formatted by many tasks.
    A conversation of over PIECE_CHARS characters, or one cut by a range, has several pieces, in the order of `piece`; their
    texts in that order are its formatted text, since each turn starts and ends with control strings. `loss` has the
    spans of the assistant's texts in a piece, in code points.

    Null texts and roles count as ''. Turns of equal number are ordered by role, then by a hash of the text, then by text;
    a null turn comes first. A null conversation id is an id. Repeated rows are turns of their own. An
    empty table gives an empty result, other columns are not read.
    """
    small_batches(conversations.sparkSession)
    own = conversations.select(
        F.col(id_column).cast("long").alias("conv_id"), F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    order = ["conv_id", "turn", "role", "hash"]
    dealt = own.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return dealt.mapInArrow(_format, FORMATTED).withColumn("piece", F.monotonically_increasing_id())


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose pieces arrive in order; of a conversation only running hashes are held."""
    empty = {"conv_id": [], "n_turns": [], "turns_sha256": [], "loss_chars": [], "loss_sha256": [], "formatted_chars": []}
    out = {k: [] for k in empty}
    open_, conv, n_turns, n_loss, n_chars, turn_hash, loss_hash = False, None, 0, 0, 0, None, None

    def close() -> None:
        for name, value in zip(out, (conv, n_turns, turn_hash.hexdigest(), n_loss, loss_hash.hexdigest(), n_chars)):
            out[name].append(value)

    def batch_of() -> pa.RecordBatch:
        kinds = {k: pa.string() if k.endswith("sha256") else pa.int64() for k in out}
        found = pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in out.items()], names=list(out))
        for values in out.values():
            values.clear()
        return found

    for batch in batches:
        for own, text, loss in zip(batch.column("conv_id").to_pylist(), batch.column("text").to_pylist(), batch.column("loss").to_pylist()):
            if open_ and own != conv:
                close()
                open_ = False
            if not open_:
                open_, conv, n_turns, n_loss, n_chars = True, own, 0, 0, 0
                turn_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            turns, _ = parse(text)
            for role, said in turns:
                turn_hash.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            for span in loss:
                said = unescape(text[span["start"] : span["end"]])
                loss_hash.update(said.encode("utf-8", "surrogatepass"))
                n_loss += len(said)
            n_turns += len(turns)
            n_chars += len(text)
        if out["conv_id"]:
            yield batch_of()
    if open_:
        close()
        yield batch_of()


def chat_digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from what `format_chats` wrote.

    Turns come from the parser, the loss text from the spans. Conversations in one piece are read
    where they are; only pieces of the others are shuffled. A digest is a running hash over a conversation's pieces, so one
    task reads a conversation's text, a piece at a time. An empty table gives an empty result.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv_id", "text", "loss"]
    whole = formatted.where("whole").select(*columns).mapInArrow(_digest, schema)
    cut = formatted.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return whole.union(cut.select(*columns).mapInArrow(_digest, schema))


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """Format all conversations, write the texts, and read the digests back from them."""
    return chat_digests(save(format_chats(conversations)))
