"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string. Successive prefixes of a conversation
are rendered; what a longer prefix adds to the shorter one's output is the new turn's span. Where the
output of the shorter prefix is not kept, the template rewrites history: spans are then taken from
renderings of the whole conversation, and the conversation is marked. Within a span, the turn's own
text is located by rendering the same prefix with a probe in its place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

_OPEN, _CLOSE, _SEP = "<s>[TURN]", "[/TURN]</s>", "[TEXT]"
#: Escapes of the template: no < or [ is left in a text, so no control string can be.
_ESCAPES = {"\\": "\\b", "<": "\\l", "[": "\\s"}
_ESCAPE = re.compile(r"[\\<\[]")
_UNESCAPE = re.compile(r"\\([bls])")
_PLAIN = {v[1]: k for k, v in _ESCAPES.items()}
_TURN = re.compile(r"<s>\[TURN\]([^\[<]*)\[TEXT\]([^\[<]*)\[/TURN\]</s>")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _PLAIN[m[1]], text)


def marked_turns(turns: list[Turn]) -> str:
    """The built-in template: each turn between control strings, role and text escaped."""
    return "".join(f"{_OPEN}{escape(role)}{_SEP}{escape(text)}{_CLOSE}" for role, text in turns)


def read_back(output: str) -> list[Turn]:
    """The turns of an output of `marked_turns`."""
    turns, at = [], 0
    for m in _TURN.finditer(output):
        if m.start() != at:
            raise ValueError("text between turns")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(output):
        raise ValueError("text after the last turn")
    return turns


#: Replaces a text to find where it stands; of private-use characters that a template has no reason to use or change.
PROBE = "\ue000\ue001\ue000"


def probe_for(turns: list[Turn]) -> str:
    """PROBE, with more of its middle if a role or text has it, so that it can only be found where it was put."""
    probe = PROBE
    while any(probe in x for turn in turns for x in turn):
        probe = probe[:-1] + PROBE[1] + probe[-1]
    return probe


def render(turns: list[Turn], template: Template = marked_turns) -> tuple[str, list[tuple[int, int]], list[tuple[int, int] | None], bool]:
    """(output, spans of the turns, spans of their texts, whether the template rewrites history). A text that the template does not show has no span."""
    probe = probe_for(turns)
    output, ends, rewritten = template([]), [], False
    first = len(output)
    for k in range(1, len(turns) + 1):
        longer = template(turns[:k])
        if not longer.startswith(output):
            rewritten = True
        ends.append(len(longer))
        output = longer
    spans = list(zip([first, *ends[:-1]], ends))
    texts = []
    for k, (role, text) in enumerate(turns):
        if rewritten:
            before, after = turns[:k], turns[k + 1 :]
            probed = template([*before, (role, probe), *after])
            a = probed.find(probe)
            b = len(output) - (len(probed) - a - len(probe))
        else:
            a0, b0 = spans[k]
            probed = template([(role, probe)]) if k == 0 else template([turns[k - 1], (role, probe)])
            lead = len(template([turns[k - 1]])) if k else first
            added = probed[lead:]
            a, b = a0 + added.find(probe), b0 - (len(added) - added.find(probe) - len(probe))
            if added.find(probe) < 0 or a < a0 or b < a:  # the turn looks otherwise without what stands before it
                probed = template([*turns[:k], (role, probe)])
                a, b = probed.find(probe), b0 - (len(probed) - probed.find(probe) - len(probe))
        texts.append((a, b) if probe in probed and 0 <= a <= b else None)
    if rewritten:
        edges = [len(output)]
        for own in reversed(texts):  # a turn whose text is not shown is empty
            edges.insert(0, own[0] if own else edges[0])
        spans = [(edges[k] if k else 0, edges[k + 1]) for k in range(len(turns))]
    return output, spans, texts, rewritten


def format_conversations(
    rows: DataFrame, template: Template = marked_turns, learn_role: str = "assistant",
    id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """rows of turns → id, n_turns, formatted, loss_spans (code points, end exclusive), rewritten, n_hidden.

    One row per conversation. Turns are in order of turn, then role and text (nulls first and as empty strings), so that
    ties have one order; rows without an id form one conversation. Other columns are not read. The loss mask
    covers the texts of `learn_role`; n_hidden counts those that the template does not show, which no span can cover. An empty table gives no rows.

    Rows are shuffled by id once and sorted within partitions; a task streams over its rows and holds one conversation
    at a time, the unit that is rendered. Prefixes make this quadratic in the turns of one conversation, not in the table.
    """
    id_type = rows.schema[id_col].dataType.simpleString()
    need = small_batches(rows).select(F.col(id_col).alias("c"), F.col(turn_col).alias("n"), F.coalesce(F.col(role_col), F.lit("")).alias("r"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    need = need.repartition("c").sortWithinPartitions("c", "n", "r", "t").select("c", "r", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def stream() -> Iterator[tuple]:
            nonlocal kind
            for b in batches:
                kind = b.column(0).type
                yield from zip(*(c.to_pylist() for c in b.columns))

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            spans = pa.array([[{"start": a, "end": b} for a, b in own] for own in cols[3]], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), spans, pa.array(cols[4], pa.bool_()), pa.array(cols[5], pa.int64())], names=[id_col, "n_turns", "formatted", "loss_spans", "rewritten", "n_hidden"])

        out, size = [], 0
        for conv, own in groupby(stream(), key=lambda x: x[0]):
            turns = [(r, t) for _, r, t in own]
            output, _, texts, rewritten = render(turns, template)
            own_texts = [s for s, (role, _) in zip(texts, turns) if role == learn_role]
            out.append((conv, len(turns), output, [s for s in own_texts if s], rewritten, own_texts.count(None)))
            size += len(output)
            if len(out) >= 1000 or size > 4_000_000:
                yield batch()
                size = 0
        if out:
            yield batch()

    return need.mapInArrow(run, f"`{id_col}` {id_type}, n_turns long, formatted string, loss_spans array<struct<start: long, end: long>>, rewritten boolean, n_hidden long")


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Read back what `format_conversations` made with the built-in template: id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    id_type = formatted.schema[id_col].dataType.simpleString()

    def facts(output: str, spans: list[dict]) -> tuple:
        turns = read_back(output)
        whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        loss = "".join(unescape(output[s["start"] : s["end"]]) for s in spans)
        return len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*(facts(o, s) for o, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())))) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols, kinds)], names=[id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(id_col, "formatted", "loss_spans").mapInArrow(run, f"`{id_col}` {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
