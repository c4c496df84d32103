"""Flattening nested records into related tables.

JSON text is parsed as a stream of tokens in one pass: no tree of values is built, and depth is bounded by memory only. The
pass notes containers and leaves as (container, ordinal, value) triples; what a container is (a repeated element, a map of
records or a mere wrapping) follows from its members' kinds. Triples are then grouped by their repeated ancestor (the innermost
array or map of objects above a leaf), and each group is pivoted into one table, whose rows keep the link to their parent.
Columns that are nested by type need no parsing: ``typed_tables`` explodes their arrays level by level.
"""

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

TRIPLES = "path string, instance string, parent string, ordinal int, leaf string, value string"
_STRING = r'"((?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*)"'
_KEY = re.compile(rf"[ \t\n\r]*{_STRING}[ \t\n\r]*:")
_VALUE = re.compile(rf"[ \t\n\r]*(?:{_STRING}|([\[{{])|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity))")
_NEXT = re.compile(r"[ \t\n\r]*([,\]}])")
_REST = re.compile(r"[ \t\n\r]*\Z")
#: Different paths and leaves that tables are made of, at most.
MAX_LEAVES = 10_000


class Broken(ValueError):
    """The text is no JSON."""


class Record:
    """The containers and leaves of one JSON text, in document order; container 0 holds the root."""

    def __init__(self, text: str):
        self.up, self.key, self.place, self.is_list, self.plain, self.own = [-1], [None], [1], [True], [False], [False]
        self.leaves: list[tuple[int, str | None, int, str | None]] = []
        self._scan(text, 0, None, 1)

    def _open(self, up: int, key: str | None, place: int, is_list: bool) -> int:
        self.up.append(up), self.key.append(key), self.place.append(place), self.is_list.append(is_list), self.plain.append(False), self.own.append(False)
        return len(self.up) - 1

    def _leaf(self, within: int, key: str | None, place: int, text: str | None) -> None:
        self.plain[within] = True
        if text is not None:
            self.own[within] = True
            self.leaves.append((within, key, place, text))

    def _string(self, within: int, key: str | None, place: int, text: str) -> None:
        """A string that itself holds an encoded array or object, however often encoded, is replaced by it."""
        if text[:1] in ("[", "{", '"') and text[-1:] in ("]", "}", '"'):
            held, leaves = len(self.up), len(self.leaves)
            flags = self.plain[within], self.own[within]
            try:
                self._scan(text, within, key, place)
                if len(self.up) > held:
                    return
            except Broken:
                pass
            for column in (self.up, self.key, self.place, self.is_list, self.plain, self.own):
                del column[held:]
            del self.leaves[leaves:]
            self.plain[within], self.own[within] = flags
        self._leaf(within, key, place, text)

    def _scan(self, text: str, within: int, key: str | None, place: int) -> None:
        """Reads one JSON value as a member of a container. Encoded strings recurse; each encoding at least doubles the quotes, so there are few."""
        at, base, count = 0, within, place
        value, follow, name = _VALUE.match, _NEXT.match, _KEY.match
        counts = []
        while True:
            m = value(text, at)
            if m is None:
                raise Broken
            at = m.end()
            if m[2]:
                counts.append(count)
                within, count = self._open(within, key, count, m[2] == "["), 1
                closed = follow(text, at)
                if closed and closed[1] == ("]" if self.is_list[within] else "}"):
                    at = closed.end()
                    within, count = self.up[within], counts.pop()
                else:
                    if not self.is_list[within]:
                        k = name(text, at)
                        if k is None:
                            raise Broken
                        key, at = _unescaped(k[1]), k.end()
                    else:
                        key = None
                    continue
            elif m[3]:
                self._leaf(within, key, count, None if m[3] == "null" else m[3])
            else:
                self._string(within, key, count, _unescaped(m[1]))
            while counts:
                m = follow(text, at)
                if m is None:
                    raise Broken
                at = m.end()
                if m[1] == ",":
                    break
                if (m[1] == "]") != self.is_list[within]:
                    raise Broken
                within, count = self.up[within], counts.pop()
            if not counts:
                if within != base or not _REST.match(text, at):
                    raise Broken
                return
            count += 1
            if self.is_list[within]:
                key = None
            else:
                k = name(text, at)
                if k is None:
                    raise Broken
                key, at = _unescaped(k[1]), k.end()


def _unescaped(raw: str) -> str:
    return json.loads(f'"{raw}"') if "\\" in raw else raw


def triples(text: str | None, name: str, keep: frozenset[str] | None = None) -> Iterator[tuple]:
    """(path, instance, parent instance, ordinal, leaf, value) of each scalar in a JSON text; nothing if it is none.

    An instance is a repeated element: an object or scalar in an array, an entry of a map of records (its key is given as the
    leaf ``@key``), or the root object. It is named by a number within the record. Each instance begins with a triple of leaf
    ``@`` and its ordinal, from 1; null members keep their position and give none. Objects that hold only containers are mere
    wrappings and no instances; parent is the nearest enclosing instance. An object is a map of records if all its members are
    objects and one of them holds a scalar. Leaves within an instance's own objects have dotted names; members that are
    scalars have the leaf ``@value``. A string that holds an encoded array or object counts as that; of equal keys of one
    object the last scalar counts. keep: the leaf names (for arrays of scalars the array's name) wanted, all if None.
    """
    if not text:
        return
    try:
        record = Record(text)
    except Broken:
        return
    up, key, place, is_list, plain, own = record.up, record.key, record.place, record.is_list, record.plain, record.own
    size = len(up)
    members, objects, rich = [0] * size, [0] * size, [False] * size
    for e in range(size - 1, 0, -1):
        members[up[e]] += 1
        if not is_list[e]:
            objects[up[e]] += 1
            rich[up[e]] = rich[up[e]] or plain[e]
    records = [not is_list[e] and not plain[e] and members[e] == objects[e] > 0 and rich[e] for e in range(size)]
    # container by container: the path of its members, the instance that they belong to and their leaf's name within it
    path, owner, within, base = [name] * size, [-1] * size, [""] * size, [name] * size
    above = [-1] * size
    rows: list[list[tuple]] = [[] for _ in range(size)]
    for e in range(1, size):
        p = up[e]
        listed = is_list[p]
        entry = records[p]
        above[e] = owner[p]
        if is_list[e]:
            if listed:
                path[e], base[e] = path[p], base[p]
            else:
                path[e], base[e] = f"{path[p]}.{key[e]}", key[e]
            owner[e] = owner[p]
        elif (listed or entry) and not records[e]:
            path[e], base[e] = path[p], base[p]
            if plain[e] or entry or not members[e]:
                owner[e] = e
                rows[e].append((place[e], "@", None))
                if entry and (keep is None or "@key" in keep):
                    rows[e].append((place[e], "@key", key[e]))
            else:
                owner[e] = owner[p]
        elif records[e]:
            path[e], base[e] = (path[p], base[p]) if listed else (f"{path[p]}.{key[e]}", key[e])
            owner[e] = owner[p]
        else:
            path[e], base[e], owner[e], within[e] = f"{path[p]}.{key[e]}", key[e], owner[p], f"{within[p]}{key[e]}."
            above[e] = above[p]
    last: dict[tuple[int, str], str] = {}
    for e, k, n, value in record.leaves:
        if is_list[e]:
            if e and (keep is None or base[e] in keep):
                number = f"{name}#{e}.{n}"
                parent = f"{name}#{owner[e]}" if owner[e] >= 0 else ""
                yield path[e], number, parent, n, "@", None
                yield path[e], number, parent, n, "@value", value
        elif keep is None or within[e] + k in keep:
            last[e, k] = value
    for (e, k), value in last.items():
        if owner[e] >= 0:
            rows[owner[e]].append((place[owner[e]], within[e] + k, value))
        else:  # scalars of a root that is a wrapping have no repeated ancestor: they belong to the record
            yield name, "", "", 1, within[e] + k, value
    for e in range(1, size):
        for n, leaf, value in rows[e]:
            yield path[e], f"{name}#{e}", f"{name}#{above[e]}" if above[e] >= 0 else "", n, leaf, value


def parse_triples(df: DataFrame, id_column: str, json_column: str, name: str, keep: list[str] | None = None) -> DataFrame:
    """Triples of each record: (record_id, path, instance, parent, ordinal, leaf, value), parsed in Arrow batches.

    df: one row per record (repeated rows give repeated triples, which the pivot removes). Null, empty or broken JSON gives no triples.
    """
    kept = None if keep is None else frozenset(keep)
    schema = pa.schema([("record_id", pa.string()), ("path", pa.string()), ("instance", pa.string()), ("parent", pa.string()), ("ordinal", pa.int32()), ("leaf", pa.string()), ("value", pa.string())])

    def parse(batches):
        for batch in batches:
            rows = []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for t in triples(text, name, kept):
                    rows.append((rid, *t))
                    if len(rows) >= 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    spec = "record_id string, " + TRIPLES
    return df.select(F.col(id_column).cast("string").alias("record_id"), F.col(json_column).alias("json")).filter("json is not null").mapInArrow(parse, spec)


def pivot_group(of: DataFrame, leaves: dict[str, str], where: Column | None = None) -> DataFrame:
    """One row for each instance: record_id, path, instance, parent, ordinal and the named leaves as columns.

    leaves: column name by leaf. An instance's triples lie in one partition of the parse, so partial aggregation makes
    one row of them before the shuffle.
    """
    picked = of if where is None else of.filter(where)
    wanted = [F.max(F.when(F.col("leaf") == leaf, F.col("value"))).alias(column) for leaf, column in leaves.items()]
    by = ("record_id", "path", "instance", "parent", "ordinal")
    return picked.groupBy(*by).agg(*wanted) if wanted else picked.select(*by).distinct()


def related_tables(of: DataFrame) -> dict[str, DataFrame]:
    """A table for each repeated ancestor, by its path, with a column for every leaf found there; of: triples.

    The paths and leaves are read from the triples first; more than MAX_LEAVES of them are an error, as no table should be made of data.
    """
    found = of.select("path", "leaf").distinct().limit(MAX_LEAVES + 1).collect()
    if len(found) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} different leaves")
    paths: dict[str, dict[str, str]] = {}
    for r in sorted(found):
        leaves = paths.setdefault(r["path"], {})
        if r["leaf"] != "@":
            leaves[r["leaf"]] = r["leaf"].lstrip("@").replace(".", "_")
    return {path: pivot_group(of, leaves, F.col("path") == path) for path, leaves in paths.items()}


def typed_tables(df: DataFrame, id_column: str, column: str) -> dict[str, DataFrame]:
    """A table for each array inside a column that is nested by type, by its path: record_id, places, and the leaves as columns.

    places holds the positions from the outermost array inwards, from 1: all but the last are the parent's. Null elements
    keep their position and give no row; a null or empty array gives none. Leaves of structs inside an element have names
    joined by underscores; an array of scalars has the leaf ``value``. One narrow projection an array level: nothing is shuffled.
    """
    out: dict[str, DataFrame] = {}

    def leaves(kind: DataType, at: Column, prefix: str) -> tuple[list[Column], list[tuple[str, Column, ArrayType]]]:
        plain, arrays = [], []
        for f in kind.fields:
            if isinstance(f.dataType, StructType):
                a, b = leaves(f.dataType, at[f.name], f"{prefix}{f.name}_")
                plain, arrays = plain + a, arrays + b
            elif isinstance(f.dataType, ArrayType):
                arrays.append((f"{prefix}{f.name}", at[f.name], f.dataType))
            else:
                plain.append(at[f.name].alias(prefix + f.name))
        return plain, arrays

    def level(rows: DataFrame, places: Column, values: Column, kind: ArrayType, path: str) -> None:
        rows = rows.select("_r", places.alias("_o"), F.posexplode(values).alias("_p", "_x")).filter("_x is not null").select("_r", F.concat("_o", F.array(F.col("_p") + 1)).alias("_o"), "_x")
        element, x = kind.elementType, F.col("_x")
        if isinstance(element, ArrayType):
            level(rows, F.col("_o"), x, element, path)
            return
        plain, arrays = leaves(element, x, "") if isinstance(element, StructType) else ([x.alias("value")], [])
        out[path] = rows.select(F.col("_r").alias("record_id"), F.col("_o").alias("places"), *plain)
        for name, at, inner in arrays:
            level(rows, F.col("_o"), at, inner, f"{path}.{name}")

    level(df.select(F.col(id_column).cast("string").alias("_r"), F.col(column).alias("_c")), F.array().cast("array<int>"), F.col("_c"), df.schema[column].dataType, column)
    return out
