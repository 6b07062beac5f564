"""Order-guarded statements for keyed stores (K1, K2).

A statement carries the order of what it writes, and the store keeps the newer
value, so a batch that is replayed, or that arrives after a later one,
overwrites nothing newer:

* wide-column store: an insert with a write time, which is the row's order as
  one number; the store keeps the cell of the greater write time;
* document store: an update that sets a field only if its order is above the
  one kept beside it.

The statements are built from the node; no store's library is needed here.
``write_rows`` sends them from the executors, ``FLUSH_ROWS`` at a time (T5), by
a function the caller gives (``session.execute``, ``collection.bulk_write``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfold.functions.schema import as_fields

# Fixed value: rows a consumer writes at once.
FLUSH_ROWS = 500
# Write times: milliseconds, then the offset's low bits as a tie-break.
OFFSET_BITS = 22
ORDER_FIELD = "_order"


def write_time(ts_col: str = "_kafka_ts", offset_col: str = "_offset") -> Column:
    """The order of a message as one long: its broker time in ms, ties of one
    ms by offset.  A NULL time is before all others."""
    ms = F.unix_millis(F.col(ts_col).cast("timestamp"))
    tie = F.coalesce(F.pmod(F.col(offset_col), F.lit(1 << OFFSET_BITS)), F.lit(0))
    return F.coalesce(F.shiftleft(ms, OFFSET_BITS) + tie, F.lit(0)).cast("long")


def table_name(node: dict) -> str:
    props = node.get("properties") or {}
    table = props.get("table") or str(node.get("label", node["id"])).lower().replace(" ", "_").replace("-", "_")
    return f"{props['keyspace']}.{table}" if props.get("keyspace") else table


def insert_statement(node: dict, fields) -> str:
    """The prepared insert of a wide-column node; its last value is the write
    time."""
    names = [f.name for f in as_fields(fields)]
    return (f"INSERT INTO {table_name(node)} ({', '.join(names)}) "
            f"VALUES ({', '.join('?' * len(names))}) USING TIMESTAMP ?")


def insert_values(rows: DataFrame, fields, time: Column | None = None) -> DataFrame:
    """The values of ``insert_statement`` for rows of ``merge.last_rows``."""
    names = [f.name for f in as_fields(fields)]
    return rows.select(*names, (write_time() if time is None else time).alias("write_time"))


def document_update(row: dict, fields, key: list[str]) -> dict:
    """The guarded upsert of one row of ``merge.partial_nonnull``: a filter and
    an update pipeline."""
    names = [f.name for f in as_fields(fields) if f.name not in key]
    at = {k: row[k] for k in key}
    sets: dict = {}
    for c in names:
        order = row[f"_o_{c}"]
        if order is None:                       # no value in this batch
            continue
        mark = [str(v) if hasattr(v, "isoformat") else v for v in order]
        held = {"$ifNull": [f"${ORDER_FIELD}.{c}", []]}
        newer = {"$gte": [mark, held]}
        sets[c] = {"$cond": [newer, {"$literal": row[c]}, f"${c}"]}
        sets[f"{ORDER_FIELD}.{c}"] = {"$cond": [newer, mark, held]}
    return {"filter": {"_id": at}, "update": [{"$set": sets}] if sets else [], "upsert": True}


def in_groups(items: Iterable, size: int = FLUSH_ROWS) -> Iterator[list]:
    """Consecutive lists of ``size`` items, the last one shorter."""
    it = iter(items)
    while chunk := list(islice(it, size)):
        yield chunk


def write_rows(rows: DataFrame, connect: Callable[[], Callable[[list], None]], as_statement=None,
               size: int = FLUSH_ROWS) -> None:
    """Send every row (as a tuple, or as ``as_statement(row)`` makes it) from
    its executor, ``size`` at a time.  ``connect()`` runs once a partition and
    returns the function that sends one list."""
    def send(part):
        execute = connect()
        for chunk in in_groups(part, size):
            execute([as_statement(r.asDict()) if as_statement else tuple(r) for r in chunk])

    rows.foreachPartition(send)


def wide_writer(connect: Callable[[str], Callable[[list], None]], size: int = FLUSH_ROWS):
    """A ``start_spec`` writer for wide-column nodes: ``connect(statement)``
    prepares it on an executor and returns the function that runs it for a
    list of values."""
    from streamfold.plans.spec import node_fields

    def write(rows: DataFrame, batch_id: int, node: dict) -> None:
        fields = node_fields(node)
        statement = insert_statement(node, fields)
        write_rows(insert_values(rows, fields), lambda: connect(statement), size=size)

    return write


def document_writer(connect: Callable[[dict], Callable[[list], None]], size: int = FLUSH_ROWS):
    """A ``start_spec`` writer for document nodes: ``connect(properties)``
    opens the collection on an executor and returns the function that applies
    a list of guarded updates."""
    from streamfold.plans.spec import node_fields, node_key

    def write(rows: DataFrame, batch_id: int, node: dict) -> None:
        fields = node_fields(node)
        key = node_key(node, fields)
        props = dict(node.get("properties") or {})
        write_rows(rows, lambda: connect(props), lambda r: document_update(r, fields, key), size)

    return write
