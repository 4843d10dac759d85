"""Chat formatting with schema fingerprints.

A layout's nested field paths, sorted and hashed, are its fingerprint; the fingerprint selects a declarative mapping (where turns lie, which fields hold role and text, what their names mean) that yields canonical turns: conv_id, turn, role, text. A table's own columns and JSON records go the same way. A fingerprint that isn't known is taken again without the fields that no mapping knows; if that isn't known either, the mapping whose fields are the most of those there are is taken; a table that fits none is an error that names its paths, and a record that fits none, isn't JSON or holds something else where a text or number belongs becomes one turn of the role 'unmapped' with the record as text. A message given as parts says the texts of its parts, a line each; a record with an empty list of messages is a conversation without turns, and gives no row.

The template writes a turn as ``<|role|>`` line, text, ``<|end|>`` line. Inside texts and roles, the backslash and the signs that begin control strings are escaped (in roles the bar too), so no text can pass for a mark, and the output reads back exactly. The loss mask covers the text of assistant turns. Formatting a turn needs no other turn, so it moves no rows.

Reading back takes a conversation's output as one text, finds its turns by the marks alone, and digests them in order. A digest is sequential, so one task streams a conversation, in pieces and with the memory of a turn; conversations that lack a conv_id are read as one.

Null texts count as empty, null roles as the role ''. Turns with the same number are ordered by role and text, those without a number come first; repeated turns stay. Very long turns are no matter but for the memory of one. Rows of a table that share the control conversation's id would be read with it. An empty table gives an empty result; columns that no mapping names play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE, END = "<|", "|>\n", "\n<|end|>\n"

#: Mappings by layout. ``turns``: the array (or None: the row is a turn); ``fields``: (role path or constant, text path) in order.
MAPPINGS: dict[str, dict] = {
    "turn rows": {"paths": ["conv_id", "role", "text", "turn"], "turns": None, "role": "role", "text": "text", "turn": "turn"},
    "messages": {"paths": ["conv_id", "messages[].content", "messages[].role"], "turns": "messages", "role": "role", "text": "content"},
    "messages of parts": {"paths": ["conv_id", "messages[].content[].text", "messages[].content[].type", "messages[].role"], "turns": "messages", "role": "role", "text": "content"},
    "no messages": {"paths": ["conv_id", "messages[]"], "turns": "messages", "role": "role", "text": "content"},
    "conversations": {"paths": ["conv_id", "conversations[].from", "conversations[].value"], "turns": "conversations", "role": "from", "text": "value"},
    "prompt and completion": {"paths": ["completion", "conv_id", "prompt"], "fields": [("user", ["prompt"]), ("assistant", ["completion"])]},
    "prompt and response": {"paths": ["conv_id", "prompt", "response"], "fields": [("user", ["prompt"]), ("assistant", ["response"])]},
    "instruction": {"paths": ["conv_id", "instruction", "output"], "fields": [("user", ["instruction"]), ("assistant", ["output"])]},
    "instruction with input": {"paths": ["conv_id", "input", "instruction", "output"], "fields": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    "system, prompt and response": {"paths": ["conv_id", "prompt", "response", "system"], "fields": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
}
#: What layouts call the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


def hashed(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


BY_PRINT = {hashed(m["paths"]): name for name, m in MAPPINGS.items()}


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, at + "[]")
    return [at]


def value_paths(value: object, at: str = "") -> set[str]:
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in value_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in value_paths(v, at + "[]")} or {at + "[]"}
    return {at}


KNOWN_PATHS = {p for m in MAPPINGS.values() for p in m["paths"]}


def mapping_for(paths: list[str]) -> Mapping:
    """The mapping whose fingerprint ``paths`` has, as they are or without fields that no mapping knows; else the one whose paths are the most of them."""
    for own in (paths, [p for p in paths if p in KNOWN_PATHS]):
        if hashed(own) in BY_PRINT:
            return MAPPINGS[BY_PRINT[hashed(own)]]
    fits = [m for m in MAPPINGS.values() if {*m["paths"]} <= {*paths}]
    if not fits:
        raise ValueError(f"no mapping for the fields {sorted(paths)}")
    return max(fits, key=lambda m: (len(m["paths"]), m["paths"]))


def canonical_turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of a table whose columns have one of the layouts."""
    m = mapping_for(schema_paths(df.schema))
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    role = lambda c: F.coalesce(known[c], c, F.lit(""))
    text = lambda c: F.coalesce(c, F.lit(""))
    if "fields" in m:
        join = lambda names: F.array_join(F.filter(F.array(*[F.col(n) for n in names]), lambda x: x.isNotNull() & (x != "")), "\n")
        turns = F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), join(names).alias("text")) for i, (r, names) in enumerate(m["fields"])])
        return df.select(F.col("conv_id").cast("long").alias("conv_id"), F.explode(turns).alias("t")).select("conv_id", "t.*")
    if m["turns"]:
        rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.posexplode(m["turns"]).alias("turn", "t"))
        said = F.col("t")[m["text"]]
        if f"{m['turns']}[].{m['text']}[].text" in m["paths"]:
            said = F.array_join(F.transform(said, lambda x: x["text"]), "\n")  # parts without text, like images, are left out
        return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role(F.col("t")[m["role"]]).alias("role"), text(said).alias("text"))
    return df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col(m["turn"]).cast("long").alias("turn"), role(F.col(m["role"])).alias("role"), text(F.col(m["text"])).alias("text"))


def said(value: object) -> str:
    """What a message says: text, or the texts of its parts, a line each."""
    if isinstance(value, list):
        return "\n".join(p if isinstance(p, str) else p["text"] for p in value if not isinstance(p, dict) or isinstance(p.get("text"), str))
    return value or ""


def turns_of(record: dict) -> list[tuple[str, str]]:
    m = mapping_for(sorted(value_paths(record)))
    as_role = lambda r: ROLES.get(r, r or "")
    if "fields" in m:
        return [(r, "\n".join(record[n] for n in names if record.get(n))) for r, names in m["fields"]]
    if m["turns"]:
        return [(as_role(t.get(m["role"])), said(t.get(m["text"]))) for t in record[m["turns"]]]
    return [(as_role(record.get(m["role"])), record.get(m["text"]) or "")]


def _whole(value: object) -> int | None:
    """A number of a record as a 64-bit integer, from text too."""
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, int | str):
        raise TypeError("not a whole number")
    n = int(value)
    if not -(1 << 63) <= n < 1 << 63:
        raise ValueError("not a 64-bit number")
    return n


def read_record(raw: str | None) -> list[tuple[int | None, int | None, str, str]]:
    """conv_id, turn, role, text of a JSON record's turns; one 'unmapped' turn if it can't be read as any layout."""
    try:
        record = json.loads(raw)
        conv, first, turns = _whole(record.get("conv_id")), _whole(record.get("turn")) or 0, turns_of(record)
        for pair in turns:
            for t in pair:
                t.encode()  # text, and text that UTF-8 can hold
        return [(conv, first + i, r, t) for i, (r, t) in enumerate(turns)]
    except (ValueError, TypeError, AttributeError, RecursionError):
        return [(None, 0, "unmapped", raw or "")]


def json_turns(df: DataFrame, column: str) -> DataFrame:
    """The same of JSON records, each of which may have a layout of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        for b in batches:
            out = [t for raw in b.column(0).to_pylist() for t in read_record(raw)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["conv_id", "turn", "role", "text"])

    return df.select(column).mapInArrow(run, "conv_id long, turn long, role string, text string")


#: Signs that begin control strings, and the bar that ends a role, in the order in which they are escaped.
ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b", "|": "\\p"}


def escape(text: str) -> str:
    for sign in "\\<[":
        text = text.replace(sign, ESCAPES[sign])
    return text


def escape_role(role: str) -> str:
    """A role stands before a bar, so its own are escaped too."""
    return escape(role).replace("|", ESCAPES["|"])


_back = {"\\\\": "\\", "\\l": "<", "\\b": "[", "\\p": "|"}


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lbp]", lambda m: _back[m[0]], text)


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, segment, loss (arrays of [start, stop) in the segment, in characters): one row a turn, no exchange. The segments of a conversation in the order of turn, role and text, one after another, are its formatted text."""

    def escaped(c: Column, signs: str) -> Column:
        for sign in signs:
            c = F.replace(c, F.lit(sign), F.lit(ESCAPES[sign]))
        return c

    d = turns.select("conv_id", "turn", "role", "text")
    d = d.withColumns({"head": F.concat(F.lit(OPEN), escaped(F.coalesce("role", F.lit("")), "\\<[|"), F.lit(CLOSE)), "body": escaped(F.coalesce("text", F.lit("")), "\\<[")})
    start, stop = F.length("head").cast("long"), (F.length("head") + F.length("body")).cast("long")
    loss = F.when(F.col("role") == "assistant", F.array(F.array(start, stop))).otherwise(F.array().cast("array<array<long>>"))
    return d.select("conv_id", "turn", "role", "text", F.concat("head", "body", F.lit(END)).alias("segment"), loss.alias("loss"))


TURN = re.compile(r"<\|((?:[^<|\\]|\\.)*)\|>\n((?:[^<\\]|\\.)*)\n<\|end\|>\n", re.DOTALL)


class Reader:
    """Reads one conversation's output, given in pieces of any size, with the parts of it that the mask covers."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.rest, self.n, self.chars, self.loss_chars = conv_id, "", 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, masked: list[list[int]]) -> None:
        for start, stop in masked:
            text = unescape(piece[start:stop])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(piece)
        self.rest += piece
        at = 0
        while m := TURN.match(self.rest, at):
            self.n += 1
            self.turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            at = m.end()
        self.rest = self.rest[at:]

    def done(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv_id}: what follows turn {self.n} is no turn")
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, parsed from the formatted text and its loss mask: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state: Reader | None = None

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], names=names)

        for b in batches:
            out = []
            for c, segment, loss in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if state is None or c != state.conv_id:
                    if state:
                        out.append(state.done())
                    state = Reader(c)
                state.add(segment, loss)
            yield batch(out)
        if state:
            yield batch([state.done()])

    order = ["conv_id", "turn", "role", "text"]
    return formatted.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "segment", "loss").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def control_conversation(spark: SparkSession) -> DataFrame:
    """A conversation whose texts are control strings of other templates, as a JSON record of the layout 'messages'."""
    said = "</s>[INST] ok [/INST]"
    record = {"conv_id": -1, "messages": [{"role": r, "content": said} for r in ("user", "assistant")]}
    return json_turns(spark.createDataFrame([(json.dumps(record),)], "record string"), "record")
