"""Conversations rendered by a chat template that is treated as a black box."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.llm.shipping import with_modules

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

#: Turns after which the history of a template with ``append_only`` is shortened, and turns then kept.
HISTORY, KEPT = 64, 16

BEGIN, INSTRUCTION, END_INSTRUCTION, END = "<s>", "[INST]", "[/INST]", "</s>"

_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
_TURN = re.compile(r"(<s>)?(?:\[INST\](.*?)\n(.*?)\[/INST\]|(.*?)</s>)", re.DOTALL)


def escape(text: str) -> str:
    """The text without control strings: each gets a backslash after its first character."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.DOTALL)


def instruction_template(turns: Sequence[Turn]) -> str:
    """``<s>``, then ``[INST]role, newline, text[/INST]`` or, for the assistant, ``text</s>``."""
    parts = [BEGIN]
    for role, text in turns:
        if role == "assistant":
            parts.append(escape(text) + END)
        else:
            parts.append(f"{INSTRUCTION}{_role(role)}\n{escape(text)}{END_INSTRUCTION}")
    return "".join(parts)


#: A template's own word that what a turn adds depends on that turn alone, and stays.
instruction_template.append_only = True


def read_turn(span: str) -> tuple[str, str, int, int]:
    """Role, text, and the escaped text's place in one turn's span of ``instruction_template``."""
    found = _TURN.fullmatch(span)
    if found is None:
        raise ValueError("not a turn of this template")
    if found[4] is not None:
        return "assistant", unescape(found[4]), found.start(4), found.end(4)
    return _role_back(found[2]), unescape(found[3]), found.start(3), found.end(3)


class Prefixes:
    """Renders successive prefixes of one conversation and compares each with the one before."""

    def __init__(self, template: Template, history: int = HISTORY, kept: int = KEPT):
        self._template, self._limit, self._kept = template, history, kept
        self._append_only = getattr(template, "append_only", False)
        self._turns: list[Turn] = []
        self._text = template([])
        self.head = self._text  # what the template writes before any turn

    def push(self, role: str, text: str) -> tuple[str, int]:
        """The turn's span and how many earlier characters the template took back for it."""
        self._turns.append((role, text))
        rendered = self._template(self._turns)
        same = len(self._text)
        if not rendered.startswith(self._text):
            same = len(commonprefix([self._text, rendered]))
        span, taken = rendered[same:], len(self._text) - same
        self._text = rendered
        if self._append_only and len(self._turns) >= self._limit:
            self._shorten()
        return span, taken

    def _shorten(self) -> None:
        """Go on from the last turns if the template renders them there as it did in full."""
        tail = self._turns[-self._kept :]
        half = len(tail) // 2
        short, begin = self._template(tail), self._template(tail[:half])
        full_begin = self._template(self._turns[: len(self._turns) - len(tail) + half])
        if short.startswith(begin) and self._text.startswith(full_begin):
            if short[len(begin) :] == self._text[len(full_begin) :]:
                self._turns, self._text = tail, short
                return
        self._limit *= 2


_SPANS = (
    "conv_id bigint, turn_index bigint, span string, span_start bigint, taken_back bigint, "
    "rewrites_history boolean"
)


def format_conversations(
    turns: DataFrame, template: Template = instruction_template, history: int = HISTORY
) -> DataFrame:
    """One row per turn, in order within its partition: where and as what the template wrote it.

    ``turns`` has ``conv_id, turn, role, text``. A conversation's turns are sorted by turn, then
    role, then text, so repeated turns have one order and stay. Prefixes of growing length are
    rendered; what a prefix adds to the one before is the turn's span, starting at ``span_start``
    of the output (the first span includes what the template writes before any turn).
    ``taken_back`` counts characters of the earlier output that changed or went;
    ``rewrites_history`` is true where there are any. The spans of a conversation without such turns,
    put together, are its output.

    The turns stream through the task, sorted by Spark, which spills. A template is given the whole
    conversation so far, so that it is seen whenever it rewrites; the task holds one conversation. Only
    for a template with a true attribute ``append_only`` a task holds ``history`` turns: beyond that
    the last ones serve as history, if the template writes them alike from there. What such a template
    rewrites among the turns before those goes unseen: it is for templates that keep their promise.

    Null roles and texts are empty, null turns sort first, null ``conv_id`` rows are one
    conversation. Other columns are ignored. An empty table gives no rows.
    """
    names = [part.split()[0] for part in _SPANS.split(", ")]
    kind = pa.schema(
        list(zip(names, [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 2, pa.bool_()], strict=True))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, prefixes, index, at = object(), None, 0, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != current:
                    current, prefixes, index, at = conv, Prefixes(template, history), 0, 0
                    head = prefixes.head
                span, taken = prefixes.push(role, text)
                if index == 0:
                    span = head[: len(head) - taken] + span
                    taken = 0
                at -= taken
                rows.append((conv, index, span, at, taken, taken > 0))
                at += len(span)
                index += 1
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kind.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=kind)

    chosen = turns.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return with_modules(ordered).select("conv_id", "role", "text").mapInArrow(run, _SPANS)


_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, rewrites_history boolean"
)


def digest_conversations(spans: DataFrame) -> DataFrame:
    """One row per conversation, read back from the spans that ``format_conversations`` gives.

    It streams over the spans' own partitions in their order, so it must be applied to that result
    directly. Turns are parsed out of the spans and unescaped; the loss mask covers the assistant's
    texts. The digests are running ones and hold no text.
    """
    import hashlib

    names = [part.split()[0] for part in _DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    kind = pa.schema(list(zip(names, types, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []
        done: list[tuple] = []

        def close() -> None:
            if state:
                conv, n, turns, chars, loss, total, rewrites = state
                done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, rewrites))
                state.clear()

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=kind)

        for batch in batches:
            for conv, index, span, taken in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if index == 0:
                    close()
                    state[:] = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                role, text, _, _ = read_turn(span)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if role == "assistant":
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(span) - taken
                state[6] |= taken > 0
            if done:
                yield flush()
        close()
        if done:
            yield flush()

    return spans.select("conv_id", "turn_index", "span", "taken_back").mapInArrow(run, _DIGEST)
