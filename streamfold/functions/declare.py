"""Column declarations in node text.

A node may say what it holds as text: a ``CREATE TABLE`` statement with its
columns, key, watermark and metadata columns, or a ``SELECT`` whose output
names are the columns.  The text is only divided here, at commas outside
parentheses and quotes; what a column's type means is left to Spark's own
DDL parser, and statements themselves run as Spark SQL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamfold.functions.schema import DECLARED_TYPES, Field

# Clauses of a column list that declare no column.
KEY_CLAUSE = re.compile(r"^(?:CONSTRAINT\s+\S+\s+)?PRIMARY\s+KEY\s*\((.*?)\)", re.I | re.S)
WATERMARK_CLAUSE = re.compile(r"^WATERMARK\s+FOR\s+`?(\w+)`?\s+AS\s+(.*)$", re.I | re.S)
OTHER_CLAUSE = re.compile(r"^(?:CONSTRAINT|UNIQUE|PRIMARY|WATERMARK)\b", re.I)
METADATA_COLUMN = re.compile(r"^`?(\w+)`?\s+(.+?)\s+METADATA(?:\s+FROM\s+'([^']*)')?(?:\s+VIRTUAL)?\s*$", re.I | re.S)
COLUMN = re.compile(r"^`?(\w+)`?\s+([A-Za-z_]\w*)\s*(\([^)]*\))?(.*)$", re.S)
DELAY = re.compile(r"-\s*INTERVAL\s+'([^']+)'\s+(\w+)\s*$", re.I)
# Types that Spark writes without a length or precision.
PLAIN_TYPES = {"VARCHAR": "STRING", "CHAR": "STRING", "TEXT": "STRING", "TIMESTAMP": "TIMESTAMP",
               "TIMESTAMP_LTZ": "TIMESTAMP", "BYTES": "BINARY", "VARBINARY": "BINARY"}
# What a message's metadata is called in the text, and the
# column a decoded row has it in.
METADATA = {"timestamp": "_kafka_ts", "topic": "_topic", "partition": "_partition", "offset": "_offset", "key": "_key"}


@dataclass
class Declaration:
    """What a node's text declares."""

    fields: list[Field] = field(default_factory=list)
    key: list[str] = field(default_factory=list)
    watermark: tuple[str, str] | None = None                    # column, delay
    metadata: dict[str, str] = field(default_factory=dict)      # column -> column of a decoded row


def _marks(text: str):
    """(place, character, depth) of what stands outside quotes."""
    depth, quote = 0, ""
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        else:
            depth -= c == ")"
            yield i, c, depth
            depth += c == "("


def split_top(text: str, at: str = ",") -> list[str]:
    """The parts of ``text`` between ``at`` characters that stand outside
    parentheses and quotes, stripped; empty parts are left out."""
    cuts = [-1, *[i for i, c, depth in _marks(text) if c == at and depth == 0], len(text)]
    return [p for a, b in zip(cuts, cuts[1:]) if (p := text[a + 1:b].strip())]


def column_list(text: str) -> str:
    """What stands in the first parentheses of a statement."""
    start = None
    for i, c, depth in _marks(text):
        if c == "(" and start is None:
            start = i
        elif c == ")" and depth == 0 and start is not None:
            return text[start + 1:i]
    raise ValueError(f"no column list in {text[:60]!r}")


def _without_comments(text: str) -> str:
    return re.sub(r"--[^\n]*", "", text)


def _column(clause: str) -> str:
    """A column clause as Spark's DDL parser takes it."""
    m = COLUMN.match(clause)
    if not m:
        raise ValueError(f"not a column: {clause[:60]!r}")
    name, base, size, rest = m.groups()
    plain = PLAIN_TYPES.get(base.upper())
    return f"`{name}` {plain or base + (size or '')} {rest.strip()}"


def fields_of(ddl: str) -> list[Field]:
    """A Spark DDL column list to fields; types outside the declared set keep
    Spark's name for them."""
    known = {type(v): k for k, v in DECLARED_TYPES.items()}
    return [Field(f.name, known.get(type(f.dataType), f.dataType.simpleString().upper()), f.nullable)
            for f in T.StructType.fromDDL(ddl).fields]


def _interval(text: str) -> str:
    """The delay of ``column - INTERVAL 'n' UNIT``; the column alone has none."""
    m = DELAY.search(text.strip())
    if m:
        return f"{m.group(1)} {m.group(2).lower()}"
    if re.fullmatch(r"`?\w+`?", text.strip()):
        return "0 seconds"
    raise ValueError(f"not a watermark: {text[:60]!r}")


def declaration(text: str) -> Declaration | None:
    """What ``CREATE TABLE`` or ``SELECT`` text declares; None for other text
    and for a SELECT whose columns have no names."""
    body = _without_comments(text or "").strip()
    if re.match(r"CREATE\b", body, re.I):
        return _created(column_list(body))
    if re.match(r"SELECT\b", body, re.I):
        names = selected_names(body)
        return Declaration([Field(n, "STRING") for n in names]) if names else None
    return None


def _created(columns: str) -> Declaration:
    out, plain = Declaration(), []
    for clause in split_top(columns):
        if m := KEY_CLAUSE.match(clause):
            out.key = [c.strip("` ") for c in split_top(m.group(1))]
        elif m := WATERMARK_CLAUSE.match(clause):
            out.watermark = (m.group(1), _interval(m.group(2)))
        elif OTHER_CLAUSE.match(clause):
            continue
        elif m := METADATA_COLUMN.match(clause):
            name, _, what = m.groups()
            source = METADATA.get((what or name).lower(), name if name in METADATA.values() else None)
            if source is None:
                raise ValueError(f"unknown metadata {what or name!r}")
            out.metadata[name] = source
        else:
            plain.append(_column(clause))
    out.fields = fields_of(", ".join(plain)) if plain else []
    return out


def selected_names(text: str) -> list[str]:
    """The output names of a SELECT: its aliases, or the last part of a name.
    Empty if a column has neither (an expression, a star)."""
    body = text[len("SELECT"):]
    end = next((i for i, c, depth in _marks(body)
                if depth == 0 and re.match(r"\sFROM\b", body[i:i + 6], re.I)), len(body))
    names = [re.search(r"(?:^|[\s.])`?([A-Za-z_]\w*)`?$", c) for c in split_top(body[:end])]
    return [m.group(1) for m in names] if all(names) else []


def with_declared(rows: DataFrame, d: Declaration | None) -> DataFrame:
    """Decoded rows with the declared metadata columns and watermark (T1): the
    time column becomes a time stamp with zone, as a watermark needs."""
    if d is None:
        return rows
    for name, source in d.metadata.items():
        if name != source:
            rows = rows.withColumn(name, F.col(source))
    if d.watermark:
        name, delay = d.watermark
        rows = rows.withColumn(name, F.col(name).cast("timestamp")).withWatermark(name, delay)
    return rows
