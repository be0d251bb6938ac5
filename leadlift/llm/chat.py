"""Conversations from many layouts to canonical turns, and to one marked-up text each and back.

**Layouts.** The nested field paths of a table or of a JSON record are hashed into a schema fingerprint, and the
fingerprint selects a declarative mapping (``MAPPINGS``): where the turns are, which fields hold role and text, or
which fields are a prompt and its answer. Unknown fingerprints select nothing and are reported, never guessed.

**Template.** A turn is ``### role``, a line break, the text, ``</turn>`` and a line break. ``###``, ``</turn>`` and
backslashes inside texts and roles are escaped, so a marker in the output is always a marker:

====================  ========
in the text           written
====================  ========
backslash             ``\\b``
``#`` before ``##``   ``\\h``
``<`` of ``</turn>``  ``\\l``
line break in a role  ``\\n``
====================  ========

Every backslash in the output is followed by one of these letters, so replacing them back, ``\\b`` last, restores the
text. The loss mask is the list of code point spans of the assistants' texts in the output.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlift.llm.expressions import let, running
from leadlift.sources.shipping import ship

HEAD, END = "### ", "</turn>\n"
ASSISTANT = "assistant"
# names that other layouts use for the canonical roles
ROLES = {"human": "user", "prompter": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
# roles, in lower case, whose texts are learnt
SPEAKING = [ASSISTANT, *(name for name, role in ROLES.items() if role == ASSISTANT)]
TURN = "struct<turn:bigint,role:string,text:string>"


def fingerprint(paths) -> str:
    """Hash of a set of nested field paths, in any order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of a Spark type's leaves; ``[]`` steps into an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def record_paths(value, at: str = "") -> set[str]:
    """Paths of a JSON value's leaves; an empty list or null counts as a leaf."""
    if isinstance(value, dict) and value:
        # marks of paths inside a key are escaped, so that no key looks like a list or a record
        parts = {k: re.sub(r"[\\.\[\]]", r"\\\g<0>", k) for k in value}
        return set().union(*(record_paths(v, f"{at}.{parts[k]}" if at else parts[k]) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(record_paths(v, f"{at}[]") for v in value))
    return {at}


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns: a list of messages, or fields that are one turn each."""

    paths: tuple[str, ...]
    messages: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()  # (role, field), in the order of turns; empty fields are skipped

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


ROWS_BY_TURN = Mapping(("conv_id", "turn", "role", "text"), role="role", text="text")
MAPPINGS = {
    m.fingerprint: m
    for m in (
        Mapping(("messages[].role", "messages[].content"), "messages", "role", "content"),
        Mapping(("conversations[].from", "conversations[].value"), "conversations", "from", "value"),
        Mapping(("turns[].speaker", "turns[].text"), "turns", "speaker", "text"),
        Mapping(("prompt", "response"), fields=(("user", "prompt"), (ASSISTANT, "response"))),
        Mapping(("prompt", "completion"), fields=(("user", "prompt"), (ASSISTANT, "completion"))),
        Mapping(("question", "answer"), fields=(("user", "question"), (ASSISTANT, "answer"))),
        Mapping(
            ("system", "prompt", "response"),
            fields=(("system", "system"), ("user", "prompt"), (ASSISTANT, "response")),
        ),
        Mapping(
            ("instruction", "input", "output"),
            fields=(("user", "instruction"), ("user", "input"), (ASSISTANT, "output")),
        ),
        Mapping(("instruction", "output"), fields=(("user", "instruction"), (ASSISTANT, "output"))),
    )
}


def canonical(record: str | None) -> tuple[str, list[dict] | None]:
    """(fingerprint, turns) of one JSON record; turns are None where no mapping is known or the JSON is broken."""
    try:
        value = json.loads(record or "")
    except ValueError:
        return "", None
    known = fingerprint(record_paths(value))
    mapping = MAPPINGS.get(known)
    if mapping is None:
        return known, None
    if mapping.messages:
        said = [(m.get(mapping.role), m.get(mapping.text)) for m in value[mapping.messages]]
    else:
        said = [(role, value[field]) for role, field in mapping.fields if value[field]]
    turns = [(str(r or ""), t if isinstance(t, str) else "" if t is None else json.dumps(t)) for r, t in said]
    return known, [{"turn": i, "role": ROLES.get(r, r), "text": t} for i, (r, t) in enumerate(turns)]


def turns_of_records(records: DataFrame) -> DataFrame:
    """conv_id, layout (the schema fingerprint) and turns for every row of ``records(conv_id, record, ..)``.

    ``record`` is JSON. Turns are null where the record is null, broken or of a layout without mapping.
    """
    ship(records.sparkSession)

    def convert(batches):
        for batch in batches:
            found = [canonical(record) for record in batch["record"]]
            yield pd.DataFrame(
                {"conv_id": batch["conv_id"], "layout": [f[0] for f in found], "turns": [f[1] for f in found]}
            )

    return records.select(F.col("conv_id").cast("bigint"), "record").mapInPandas(
        convert, f"conv_id bigint, layout string, turns array<{TURN}>"
    )


def turns_of_rows(rows: DataFrame) -> DataFrame:
    """conv_id, layout and turns from a table with one row per turn; the layout must be ``ROWS_BY_TURN``'s.

    Only those four columns take part in the fingerprint; others are left out. Turns are in the order of their number;
    rows with one number (or none, which come first) are in the order of role, then text, and repeated rows all stay.
    A null text or role counts as empty; roles stay as they are written. A conversation becomes one row, so it has to fit in a task. Rows without
    conv_id belong to no conversation: each is one of its own without id (equal ones together).
    """
    needed = rows.select(*[c for c in rows.columns if c in ROWS_BY_TURN.paths])
    if fingerprint(schema_paths(needed.schema)) != ROWS_BY_TURN.fingerprint:
        raise ValueError(f"no mapping for columns {rows.columns}")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    return (
        needed.groupBy(F.col("conv_id").cast("bigint").alias("conv_id"), alone.alias("_alone"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", F.lit(ROWS_BY_TURN.fingerprint).alias("layout"), "turns")
    )


def escape(text: Column) -> Column:
    """Escapes the control strings; the order matters, the backslash first."""
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.regexp_replace(out, "#(?=##)", F.lit(r"\\h"))
    return F.replace(out, F.lit("</turn>"), F.lit("\\l/turn>"))


def unescape(text: Column) -> Column:
    out = text
    for written, meant in (("\\h", "#"), ("\\l", "<"), ("\\n", "\n"), ("\\b", "\\")):
        out = F.replace(out, F.lit(written), F.lit(meant))
    return out


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, ``formatted`` and ``loss`` (code point spans of assistants' texts, in order) for every row of turns.

    Null turns, or none, give an empty text without spans.
    """

    def written(turns: Column) -> Column:
        return F.transform(
            turns,
            lambda t: F.struct(
                F.lower(t["role"]).isin(*SPEAKING).alias("learn"),
                F.concat(F.lit(HEAD), F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        )

    def sizes(parts: Column) -> Column:
        return F.transform(parts, lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END))

    def spans(parts: Column) -> Column:
        placed = F.zip_with(
            parts,
            running(sizes(parts), F.lit(0), lambda a, b: a + b),
            lambda p, at: F.struct(
                p["learn"].alias("learn"),
                (at + F.length(p["head"])).alias("start"),
                (at + F.length(p["head"]) + F.length(p["body"])).alias("end"),
            ),
        )
        return F.transform(
            F.filter(placed, lambda s: s["learn"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
        )

    turns = F.coalesce("turns", F.array().cast(f"array<{TURN}>"))
    both = let(
        written(turns),
        lambda parts: F.struct(
            F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
            spans(parts).alias("loss"),
        ),
    )
    return conversations.select("conv_id", both.alias("_both")).select("conv_id", "_both.formatted", "_both.loss")


def read_turns(formatted: Column) -> Column:
    """(role, text) of each turn, from the formatted text alone."""
    parts = F.filter(F.split(formatted, END, -1), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: let(
            F.instr(p, F.lit("\n")),
            lambda line: F.struct(
                unescape(F.substring(p, F.lit(len(HEAD) + 1), line - len(HEAD) - 1)).alias("role"),
                unescape(F.substring(p, line + 1, F.length(p))).alias("text"),
            ),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), ""
    )
