"""Chat formatting: layouts recognised by schema fingerprint.

A layout's fingerprint is the hash of its sorted nested field paths (field
names only, joined by dots; array elements add `[]`, map values `{}`). `MAPPINGS` says for each
known layout, declaratively, which paths hold the turns. `canonical_turns`
takes a typed table (its schema is fingerprinted once) and `canonical_json` a
column of JSON records (each record is fingerprinted), and both give one row
per conversation with `turns`, an array of (role, text). Unknown layouts keep
their row, with null turns and the fingerprint, so that a mapping can be added.

`format_turns` writes the turns into one string. The template marks the start
of each turn, its role and its end by control strings; control strings inside
texts and roles are escaped reversibly: the escape character itself becomes
ESC 0, a control string gets ESC 1 after its first character (and is none any
more), a line break in a role becomes ESC 2. `read_turns` reads the turns and
the text under the loss mask back from the formatted string alone.

Defined cases: null texts and roles are empty; turns are ordered by their
number, null first, then by role and text, so ties and repeated rows have one
order and all are kept; a null conversation id is a conversation; a
conversation is one row of output and held whole, however long; an empty table
gives an empty result; other columns are ignored unless they change the
fingerprint, so callers select the layout's columns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESC = "␛"
START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates
CONTROLS = [START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|system|>",
            "<|user|>", "<|assistant|>", "<|endoftext|>", "<|eot_id|>", "<|start_header_id|>",
            "<|end_header_id|>", "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>"]
_CONTROL = re.compile("|".join(map(re.escape, [ESC, *CONTROLS])))
_ESCAPED = re.compile(ESC + "([012])")
_PLAIN = {"0": ESC, "1": "", "2": "\n"}
TRAINED_ROLE = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: ESC + "0" if m[0] == ESC else f"{m[0][0]}{ESC}1{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


# ---- layouts -------------------------------------------------------------

def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type, leaves only."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields
                for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, at + "[]")
    if isinstance(kind, T.MapType):
        return schema_paths(kind.valueType, at + "{}")
    return [at]


def record_paths(value, at: str = "") -> set[str]:
    """Nested field paths of a parsed JSON value, leaves only."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in record_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in record_paths(v, at + "[]")} or {at + "[]"}
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


# Each mapping: the layout's paths, and where its turns are. "rows": one row
# per turn. "list": an array of turns. "fields": one field per turn, in order;
# fields of one turn are joined by an empty line, empty ones left out.
LAYOUTS = {
    "turn rows": {"paths": ["conv_id", "turn", "role", "text"],
                  "rows": {"id": "conv_id", "order": "turn", "role": "role", "text": "text"}},
    "messages": {"paths": ["messages[].role", "messages[].content"],
                 "list": {"at": "messages", "role": "role", "text": "content"}},
    # this library's own turns: roles stay as they are
    "turns": {"paths": ["turns[].role", "turns[].text"],
              "list": {"at": "turns", "role": "role", "text": "text", "as_is": True}},
    "from and value": {"paths": ["conversations[].from", "conversations[].value"],
                       "list": {"at": "conversations", "role": "from", "text": "value"}},
    "instruction": {"paths": ["instruction", "input", "output"],
                    "fields": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    "short instruction": {"paths": ["instruction", "output"],
                          "fields": [("user", ["instruction"]), ("assistant", ["output"])]},
    "prompt and completion": {"paths": ["prompt", "completion"],
                              "fields": [("user", ["prompt"]), ("assistant", ["completion"])]},
    "prompt and response": {"paths": ["prompt", "response"],
                            "fields": [("user", ["prompt"]), ("assistant", ["response"])]},
    "system prompt": {"paths": ["system", "prompt", "response"],
                      "fields": [("system", ["system"]), ("user", ["prompt"]),
                                 ("assistant", ["response"])]},
    "question": {"paths": ["question", "answer"],
                 "fields": [("user", ["question"]), ("assistant", ["answer"])]},
}
# Role names of other layouts
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = {fingerprint(x["paths"]): (name, x) for name, x in LAYOUTS.items()}

TURNS = "array<struct<role:string,text:string>>"


def _role(col):
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(names[F.lower(col)], col, F.lit(""))


def canonical_turns(df: DataFrame, conv_id: str | None = None) -> DataFrame:
    """(conv_id, layout, turns) from a typed table whose columns, but for
    `conv_id`, are one known layout; the mapping is picked by the schema's
    fingerprint."""
    inner = df.drop(conv_id) if conv_id else df
    key = fingerprint(schema_paths(inner.schema))
    if key not in MAPPINGS:
        raise ValueError(f"no mapping for fingerprint {key}: {sorted(schema_paths(inner.schema))}")
    name, layout = MAPPINGS[key]
    if "rows" in layout:
        at = layout["rows"]
        turn = F.struct(F.col(at["order"]).alias("order"),
                        F.coalesce(at["role"], F.lit("")).alias("role"),
                        F.coalesce(at["text"], F.lit("")).alias("text"))
        rows = df.groupBy(F.col(at["id"]).alias("conv_id")).agg(
            F.array_sort(F.collect_list(turn)).alias("t"))
        turns = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
        return rows.select("conv_id", F.lit(name).alias("layout"), turns.alias("turns"))
    own = F.col(conv_id) if conv_id else F.lit(None).cast("long")
    if "list" in layout:
        at = layout["list"]
        turns = F.transform(at["at"], lambda x: F.struct(
            (F.coalesce(x[at["role"]], F.lit("")) if at.get("as_is") else _role(x[at["role"]])).alias("role"),
            F.coalesce(x[at["text"]], F.lit("")).alias("text")))
    else:
        turns = F.filter(F.array(*[F.struct(
            F.lit(role).alias("role"),
            F.concat_ws("\n\n", *[F.when(F.col(f) != "", F.col(f)) for f in fields]).alias("text"))
            for role, fields in layout["fields"]]),
            lambda x: (x["role"] != "system") | (x["text"] != ""))
    return df.select(own.alias("conv_id"), F.lit(name).alias("layout"), turns.alias("turns"))


def record_turns(record) -> tuple[str, str | None, list[dict] | None]:
    """(fingerprint, layout, turns) of one parsed JSON record."""
    key = fingerprint(record_paths(record))
    name, layout = MAPPINGS.get(key, (None, None))
    if layout is None or "rows" in layout:
        return key, None, None
    say = lambda x: "" if x is None else x if isinstance(x, str) else json.dumps(x)
    if "list" in layout:
        at = layout["list"]
        names = {} if at.get("as_is") else ROLE_NAMES
        turns = [(names.get(say(x.get(at["role"])).lower(), say(x.get(at["role"]))),
                  say(x.get(at["text"]))) for x in record[at["at"]]]
    else:
        turns = [(role, "\n\n".join(filter(None, (say(record[f]) for f in fields))))
                 for role, fields in layout["fields"]]
        turns = [t for t in turns if t[0] != "system" or t[1]]
    return key, name, [{"role": r, "text": t} for r, t in turns]


def canonical_json(df: DataFrame, record: str, keep: list[str]) -> DataFrame:
    """`keep`, fingerprint, layout and turns of a column of JSON records, of
    any mix of layouts. Records that are no JSON have a null fingerprint."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw in b.column(record).to_pylist():
                try:
                    out.append(record_turns(json.loads(raw or "")))
                except ValueError:
                    out.append((None, None, None))
            turns = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keep], pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], turns)],
                [*keep, "fingerprint", "layout", "turns"])

    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return df.select(*keep, record).mapInArrow(
        mapped, f"{fields}, fingerprint string, layout string, turns {TURNS}")


def as_records(rows: DataFrame) -> DataFrame:
    """Turn rows (conv_id, turn, role, text) as JSON records of other layouts,
    one per conversation: (conv_id, record). A user's turn and the assistant's
    answer make a prompt and completion; conversations with roles that other
    layouts would rename are this library's turns; others are from and value
    (an odd number of turns) or messages."""
    turn = F.struct(F.col("turn").alias("order"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    t = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    first, second = F.get("t", F.lit(0)), F.get("t", F.lit(1))
    pair = (F.size("t") == 2) & (first["role"] == "user") & (second["role"] == TRAINED_ROLE)
    foreign = F.exists("t", lambda x: F.lower(x["role"]).isin(*ROLE_NAMES))
    other = {"user": "human", TRAINED_ROLE: "gpt"}
    name = lambda r: F.coalesce(*[F.when(r == k, v) for k, v in other.items()], r)
    said = F.when(pair, F.to_json(F.struct(first["text"].alias("prompt"), second["text"].alias("completion"))))
    said = said.when(foreign, F.to_json(F.struct(F.transform("t", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))))
    said = said.when(F.size("t") % 2 == 1, F.to_json(F.struct(F.transform("t", lambda x: F.struct(
        name(x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations"))))
    return t.select("conv_id", said.otherwise(F.to_json(F.struct(F.transform("t", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))).alias("record"))


# ---- template ------------------------------------------------------------

def write_turns(turns) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string, and the spans of it under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = START + escape(role).replace("\n", ESC + "2") + "\n"
        body = escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, body = part.partition("\n")
        turns.append((unescape(role), unescape(body[:-len(END) - 1])))
    return turns


def format_turns(df: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, formatted and loss_spans (start and end of each trained text in
    `formatted`, in code points) of a table with `turns`."""
    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [write_turns([(t["role"], t["text"]) for t in x or ()])
                    for x in b.column("turns").to_pylist()]
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keep], pa.array([x for x, _ in done], pa.string()),
                 pa.array([[{"start": s, "end": e} for s, e in x] for _, x in done], span)],
                [*keep, "formatted", "loss_spans"])

    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return df.select(*keep, "turns").mapInArrow(
        formatted, f"{fields}, formatted string, loss_spans array<struct<start:long,end:long>>")


def digests(df: DataFrame, keep: list[str]) -> DataFrame:
    """Counts and hashes of what `formatted` and `loss_spans` give back."""
    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column("formatted").to_pylist(),
                                   b.column("loss_spans").to_pylist()):
                turns = read_turns(text)
                said = hashlib.sha256()
                for role, body in turns:
                    said.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                rows.append((len(turns), said.hexdigest(), len(loss),
                             hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(),
                             len(text)))
            cols = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in keep], *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                [*keep, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    return df.mapInArrow(read_back, f"{fields}, n_turns long, turns_sha256 string, "
                                    "loss_chars long, loss_sha256 string, formatted_chars long")
