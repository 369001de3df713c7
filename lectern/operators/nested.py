"""Deeply nested JSON records to related flat tables.

One pass over each record: a depth-first visitor meets every object once, in document order, and emits it as a tagged
row (table tag, own key, parent key, payload). The tagged rows are written partitioned by tag, and each table gets its
schema when it is read back. Parsing and visiting are the only Python work; there is no shuffle before the write.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.plans.lineage import shared_folder

#: Tag of objects that carry the record's id field, and of the outermost object where it has none.
NODE, RECORD = "node", "record"

TAGGED = "record_kind string, record_id bigint, tag string, row_no int, parent_row int, id string, parent_id string, field string, position int, depth int, payload string"


class _Invalid(ValueError):
    pass


def _no_constant(name: str):
    raise _Invalid(name)


_decode = json.JSONDecoder(parse_constant=_no_constant).decode
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?")
_SPACE = re.compile(r"[ \t\n\r]*")


def _decode_deep(text: str):
    """A parser without recursion, for records nested deeper than the library's parser goes."""
    scan = json.decoder.scanstring
    space = _SPACE.match
    pos = space(text, 0).end()
    holders: list = []
    result, done, key = None, False, None
    while True:
        if pos >= len(text):
            raise _Invalid("cut off")
        sign = text[pos]
        if sign in "{[":
            value, opened = ({} if sign == "{" else []), True
            pos += 1
        elif sign == '"':
            value, pos = scan(text, pos + 1, True)
            opened = False
        else:
            opened = False
            for word, constant in (("true", True), ("false", False), ("null", None)):
                if text.startswith(word, pos):
                    value, pos = constant, pos + len(word)
                    break
            else:
                found = _NUMBER.match(text, pos)
                if not found:
                    raise _Invalid(sign)
                value, pos = (float(found[0]) if set(found[0]) & set(".eE") else int(found[0])), found.end()
        if holders:
            holder, name = holders[-1]
            if isinstance(holder, dict):
                holder[name] = value
            else:
                holder.append(value)
        else:
            result = value
        if opened:
            holders.append([value, None])
        while True:  # after a value: close, or go on to the next place for one
            pos = space(text, pos).end()
            if not holders:
                done = True
                break
            holder = holders[-1][0]
            sign = text[pos : pos + 1]
            fresh = opened
            opened = False
            if sign == ("}" if isinstance(holder, dict) else "]"):
                pos += 1
                holders.pop()
                continue
            if not fresh:
                if sign != ",":
                    raise _Invalid(sign)
                pos = space(text, pos + 1).end()
            if isinstance(holder, dict):
                if text[pos : pos + 1] != '"':
                    raise _Invalid("name")
                holders[-1][1], pos = scan(text, pos + 1, True)
                pos = space(text, pos).end()
                if text[pos : pos + 1] != ":":
                    raise _Invalid("colon")
                pos = space(text, pos + 1).end()
            break
        if done:
            if pos != len(text):
                raise _Invalid("rest")
            return result


def parse_record(text: str | None):
    """The JSON value of ``text``, or None where it is null, blank, cut off or otherwise not valid JSON.

    A record encoded once more as a JSON string, however often, counts like the record itself; any depth of nesting is read.
    """
    while isinstance(text, str):
        try:
            text = _decode(text)
        except RecursionError:
            try:
                text = _decode_deep(text)
            except ValueError:
                return None
        except ValueError:
            return None
    return text if isinstance(text, (dict, list)) else None


def visit(value, id_field: str) -> Iterator[tuple]:
    """Depth first, in document order, one tuple for each object:
    (tag, row_no, parent_row, id, parent_id, field, position, depth, object).

    ``parent_id`` is the id of the nearest enclosing object that has one, '' if none does; ``parent_row`` is the row of
    the enclosing object, whatever it is (-1 at the top). Nesting alone counts, not what other fields say.
    """
    row = 0
    stack = [(value, -1, "", "", 0, 0)]
    pop, push = stack.pop, stack.append
    while stack:
        here, parent_row, parent_id, field, position, depth = pop()
        if type(here) is dict:
            own = here.get(id_field)
            if own is not None and type(own) is not str:
                own = json.dumps(own, ensure_ascii=False) if isinstance(own, (dict, list, bool)) else str(own)
            tag = NODE if own is not None else (field or RECORD) if field != NODE else f"{NODE}_without_id"
            yield tag, row, parent_row, own, parent_id, field, position, depth, here
            below = own if own is not None else parent_id
            for name in reversed(here):
                inner = here[name]
                if type(inner) is dict or type(inner) is list:
                    push((inner, row, below, name, 0, depth + 1))
            row += 1
        elif type(here) is list:
            for at in range(len(here) - 1, -1, -1):
                inner = here[at]
                if type(inner) is dict or type(inner) is list:
                    push((inner, parent_row, parent_id, field, at, depth))


def _list_text(values: list) -> str | None:
    """A list as JSON of any depth, null in the place of each object in it; None where it holds objects and no values."""
    parts, stack, held, plain = ["["], [(iter(values), True)], False, False
    while stack:
        inner, first = stack.pop()
        for value in inner:
            if not first:
                parts.append(", ")
            first = False
            if type(value) is list:
                parts.append("[")
                stack += [(inner, False), (iter(value), True)]
                break
            if type(value) is dict:
                held = True
                parts.append("null")
            else:
                plain = True
                parts.append(json.dumps(value, ensure_ascii=False))
        else:
            parts.append("]")
    return None if held and not plain else "".join(parts)


def _payload(here: dict) -> str:
    """The object's own fields: scalars, and lists with the values in them at any depth; nested objects are rows of their own."""
    own, lists = {}, []
    for name, value in here.items():
        if type(value) is list and any(type(x) in (dict, list) for x in value):
            body = _list_text(value)
            if body is not None:
                lists.append(f"{json.dumps(name, ensure_ascii=False)}: {body}")
        elif type(value) is not dict:
            own[name] = value
    whole = json.dumps(own, ensure_ascii=False)
    return whole if not lists else "{" + ", ".join(([whole[1:-1]] if own else []) + lists) + "}"


def _records(df: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    return df.select(F.lit(kind).alias("record_kind"), F.col(key).cast("bigint").alias("record_id"), F.col(text).cast("string").alias("record")).where(F.col("record").isNotNull() & F.col("record_id").isNotNull())


def emit_tagged(df: DataFrame, key: str, text: str, kind: str, id_field: str) -> DataFrame:
    """Every object of every record as a tagged row (``TAGGED``).

    Null keys, null, empty and invalid records have no rows; repeated records repeat their rows (``row_no`` is the same,
    so ``dropDuplicates(['record_kind', 'record_id', 'row_no'])`` makes them count once). Other columns of ``df`` are
    not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_kind", pa.string()), ("record_id", pa.int64()), ("tag", pa.string()), ("row_no", pa.int32()), ("parent_row", pa.int32()), ("id", pa.string()), ("parent_id", pa.string()), ("field", pa.string()), ("position", pa.int32()), ("depth", pa.int32()), ("payload", pa.string())])
        for batch in batches:
            rows = []
            for record_id, record in zip(batch.column(1).to_pylist(), batch.column(2)):
                value = parse_record(record.as_py())
                if value is not None:
                    rows += [(kind, record_id, *met[:8], _payload(met[8])) for met in visit(value, id_field)]
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return _records(df, key, text, kind).mapInArrow(run, TAGGED)


#: The columns of every flat table beside its payload's fields.
KEYS = ("record_kind", "record_id", "row_no", "parent_row", "id", "parent_id", "field", "position", "depth")


def write_tables(tagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Writes the tagged rows partitioned by kind and tag: each flat table is then one folder, read without the others."""
    tagged.write.mode(mode).partitionBy("record_kind", "tag").parquet(path)


def flat_table(tagged: DataFrame, tag: str, schema: T.StructType | str) -> DataFrame:
    """The rows of one tag with their payload in typed columns; a field of another type than its column becomes null."""
    fields = F.from_json("payload", schema)
    return tagged.where(F.col("tag") == tag).select(*KEYS, fields.alias("_f")).select(*KEYS, "_f.*")


#: Schemas of the flat tables that queries read, by tag; tables without one keep their payload as JSON.
SCHEMAS = {
    NODE: "node_type string, label string, title string, text string, confidence string, level string, page_number string",
    "provenance": "document_id string, page string, sheet string, cell_range string",
    "attributes": "semantic_type string, requires_review boolean, retrieval_allowed boolean",
}


def flattened(masters: DataFrame, exports: DataFrame) -> DataFrame:
    """The tagged rows of both kinds of record, written partitioned by kind and tag and read back: a query of one flat table
    reads that table's folder alone. A repeated delivery's rows are still there twice; ``row_no`` tells rows apart."""
    tagged = emit_tagged(masters, "artifact_id", "master_json", "master", "node_id").unionByName(emit_tagged(exports, "extraction_id", "exported", "exported", "self_ref"))
    spark = masters.sparkSession
    path = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    write_tables(tagged, path)
    return spark.read.schema(TAGGED).parquet(path)


def node_links(masters: DataFrame, exports: DataFrame) -> DataFrame:
    """(record_kind, record_id, node_id, parent_id) from the written node table, as a set: a repeated delivery and a node_id met
    twice under one parent count once."""
    nodes = flattened(masters, exports).where(F.col("tag") == NODE)
    return nodes.select("record_kind", "record_id", F.col("id").alias("node_id"), "parent_id").distinct()


def nodes_flat(masters: DataFrame, exports: DataFrame) -> DataFrame:
    """The typed node table of both kinds of record, one row per object with an id, with its link to its parent."""
    flat = flat_table(flattened(masters, exports), NODE, SCHEMAS[NODE])
    return flat.select("record_kind", "record_id", "row_no", "parent_row", F.col("id").alias("node_id"), "parent_id", "field", "position", "depth", F.coalesce("node_type", "label").alias("node_type"), "title", "text", F.expr("try_cast(trim(confidence) as double)").alias("confidence")).dropDuplicates(["record_kind", "record_id", "row_no"])


def table_sizes(masters: DataFrame, exports: DataFrame) -> DataFrame:
    """Rows and records of every flat table: (record_kind, tag, n_rows, n_records), repeated deliveries counted once."""
    once = flattened(masters, exports).select("record_kind", "record_id", "row_no", "tag").dropDuplicates(["record_kind", "record_id", "row_no"])
    by_record = once.groupBy("record_kind", "tag", "record_id").agg(F.count("*").alias("n"))
    return by_record.groupBy("record_kind", "tag").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_records"))
