"""Chat formatting by schema fingerprints.

The nested field paths of a record (or of a table's schema) are hashed; the
hash selects a declarative :class:`Mapping` that says where turns, roles and
texts lie.  Canonical turns ``(conv_id, turn, role, text)`` are then put into
one template that marks turns and escapes control strings inside texts so that
the formatting can be read back exactly.

Template of a turn: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``.  Escaping puts one
more backslash between ``<`` and ``|`` wherever they stand together or have
only backslashes between; no escaped text holds ``<|``, so marks are never
confused, and taking one backslash away restores the text.

Defined results: a null text or role counts as empty; null turns sort first;
equal turns order by role, then text; repeated rows are repeated turns; rows
with a null conv_id form one conversation; an empty table gives an empty
table; unknown extra fields or columns don't change the fingerprint.  A record
whose layout no mapping knows is returned with null turn, role and text.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS_SCHEMA = "conv_id bigint, turn bigint, role string, text string, layout string, fingerprint string"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``items``: path of the list of messages, with ``role`` and ``text`` fields
    in each; or ``fixed``: (role, paths) pairs, one turn each, whose texts are
    joined by a blank line.  A table of turns names its columns in ``columns``.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    columns: tuple[str, str, str, str] | None = None


MAPPINGS = (
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), columns=("conv_id", "turn", "role", "text")),
    Mapping("messages", ("messages[].role", "messages[].content"), ("system",), items="messages", role="role", text="content", fixed=(("system", ("system",)),)),
    Mapping("from_value", ("conversations[].from", "conversations[].value"), ("system",), items="conversations", role="from", text="value", fixed=(("system", ("system",)),)),
    Mapping("instruction", ("instruction", "output"), ("input", "system"), fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("prompt_completion", ("prompt", "completion"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt_response", ("prompt", "response"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question_answer", ("question", "answer"), ("context",), fixed=(("user", ("context", "question")), ("assistant", ("answer",)))),
)
VOCABULARY = frozenset(p for m in MAPPINGS for p in (*m.required, *m.optional))


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of those paths that any mapping knows, in order, without repeats."""
    return hashlib.sha256("\n".join(sorted(VOCABULARY & set(paths))).encode()).hexdigest()[:16]


REGISTRY = {fingerprint((*m.required, *some)): m for m in MAPPINGS for k in range(len(m.optional) + 1) for some in itertools.combinations(m.optional, k)}


def value_paths(value: object, at: str = "") -> Iterator[str]:
    """Nested field paths of a JSON value; list members share ``[]``."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from value_paths(v, f"{at}.{k}" if at else k)
    elif isinstance(value, list):
        for v in value:
            yield from value_paths(v, f"{at}[]")
    elif value is not None and at:
        yield at


def schema_paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """Nested field paths of a Spark schema."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def record_turns(record: str | None) -> tuple[Mapping | None, str, list[tuple[str, str]]]:
    """The mapping, fingerprint and canonical turns of one JSON record."""
    try:
        value = json.loads(record or "null")
    except ValueError:
        value = None
    mark = fingerprint(value_paths(value)) if isinstance(value, dict) else ""
    m = REGISTRY.get(mark)
    if m is None or m.columns:
        return None, mark, []
    word = lambda x: x if isinstance(x, str) else "" if x is None else json.dumps(x, ensure_ascii=False)
    turns = []
    for role, paths in m.fixed:
        if parts := [word(value[p]) for p in paths if value.get(p) is not None]:
            turns.append((role, "\n\n".join(parts)))
    for item in value.get(m.items) or [] if m.items else []:
        item = item if isinstance(item, dict) else {}
        role = word(item.get(m.role))
        turns.append((ROLES.get(role.lower(), role), word(item.get(m.text))))
    return m, mark, turns


def turns_of_records(records: DataFrame) -> DataFrame:
    """``records(conv_id, record)``, record being JSON of any known layout, to canonical turns."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for conv, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                m, mark, turns = record_turns(record)
                out += [(conv, k, role, text, m.name, mark) for k, (role, text) in enumerate(turns)] if m else [(conv, None, None, None, None, mark)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), *[pa.string()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv_id", "turn", "role", "text", "layout", "fingerprint"])

    return records.selectExpr("cast(conv_id as bigint) conv_id", "cast(record as string) record").mapInArrow(run, TURNS_SCHEMA)


def turns_of_table(rows: DataFrame) -> DataFrame:
    """A table whose schema's fingerprint selects a mapping of turn rows, to canonical turns."""
    mark = fingerprint(schema_paths(rows.schema))
    m = REGISTRY.get(mark)
    if m is None or not m.columns:
        raise ValueError(f"no mapping of turn rows for the columns {rows.columns}")
    conv, turn, role, text = m.columns
    return rows.select(rows[conv].cast("bigint").alias("conv_id"), rows[turn].cast("bigint").alias("turn"), rows[role].cast("string").alias("role"), rows[text].cast("string").alias("text"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def segments(turns: DataFrame) -> DataFrame:
    """Each turn formatted; a conversation's formatting is its segments joined in order.

    ``loss_from`` and ``loss_to`` are the code points of the segment under the
    loss mask (assistant text only), null elsewhere.  No shuffle.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), escaped_role(role), F.lit("\n"))
    body = escaped(text)
    mine = role == "assistant"
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.concat(head, body, F.lit(f"{END}\n")).alias("segment"), F.when(mine, F.length(head)).alias("loss_from"), F.when(mine, F.length(head) + F.length(body)).alias("loss_to"))


def conversations(segs: DataFrame) -> DataFrame:
    """Whole formatted conversations, one row each, for conversations that fit a row."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "segment")))
    return segs.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["segment"]), "").alias("formatted"))


_UNESCAPE = re.compile(r"<(\\*)\\\|")
_ROLE = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Read roles and texts back from formatted turns."""
    for turn in formatted.split(START)[1:]:
        role, _, rest = turn.partition("\n")
        yield _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role)), unescape(rest.rpartition(END)[0])


def digest(segs: DataFrame) -> DataFrame:
    """Per conversation, what its formatting holds when read back.

    Segments stream in order through running hashes, so a conversation of any
    length needs the memory of one Arrow batch; the sort spills.
    """

    def run(batches):
        now: list | None = None
        done: list[tuple] = []

        def close():
            done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        def flush():
            columns = list(zip(*done, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conv, seg, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(seg):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                if lo is not None:
                    under = unescape(seg[lo:hi])
                    now[3] += len(under)
                    now[4].update(under.encode())
                now[5] += len(seg)
            yield flush()
        if now is not None:
            close()
            yield flush()

    # the sort reads turn, role and text; only what the reader needs goes on to Python
    dealt = segs.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "segment", "loss_from", "loss_to")
    return dealt.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
