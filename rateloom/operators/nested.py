"""Problem 6: deeply nested semi-structured records as related flat tables.

Each record's text is read once from front to back, member by member, into path-value-ordinal triples; no tree is
built, and what no one asked for costs no more than its token. A triple has the path with list positions, the path's
pattern without them, the positions, the value and its JSON type, the path of the enclosing object, and that of
the nearest enclosing entity (an object with a given discriminator member). Triples are grouped by a
repeated ancestor and pivoted: one table for each ancestor, one row for each of its occurrences, with the key
of its parent occurrence.

Defined results: a body that is null or no valid JSON gives no triple. A lone object where lists are
usual has no position in its path and is one occurrence, as is an object without any of the asked members. Null and
empty lists give nothing. Numbers keep the text they have in the record. Lone surrogates in text become U+FFFD. Of
members with equal names in one object the last counts. Each record id stands for itself; records without an id keep
null. Nesting is limited by memory only.
"""

from __future__ import annotations

import functools
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize

TRIPLES = "path string, pattern string, ordinals array<int>, name string, value string, json_type string, parent string, entity string, entity_name string"

_TEXT = r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
#: One member or element: the comma before it, its name, then a text, an opening or closing sign, a number or a word.
_MEMBER = re.compile(rf'[ \t\n\r]*+(,)?[ \t\n\r]*+(?:({_TEXT})[ \t\n\r]*+:[ \t\n\r]*+)?(?:({_TEXT})|([\[{{])|([\]}}])|(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?)(?![0-9.eE+-])|(true|false|null))')
_WS = r"[ \t\n\r]*+"
_SCALAR = rf"(?:{_TEXT}|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?(?![0-9.eE+-])|true|false|null)"
#: Levels of nesting that are passed over in one match.
PASSED = 3
_TEXT_AT, _OPEN, _CLOSE, _NUMBER, _WORD = 3, 4, 5, 6, 7
_SURROGATE = re.compile("[\ud800-\udfff]")


def _plain(quoted: str) -> str:
    return quoted[1:-1] if "\\" not in quoted else json.loads(quoted)


def _utf8(v: str | None) -> str | None:
    return v if v is None or v.isascii() else _SURROGATE.sub("\ufffd", v)


@functools.lru_cache(maxsize=16)
def _passing(names: frozenset[str]) -> tuple[re.Pattern, re.Pattern]:
    """Patterns of a run of members of other names, valid JSON whatever is in it: at the beginning of an object, behind a member."""
    other = r'"(?!(?:' + "|".join(re.escape(json.dumps(n)[1:-1]) for n in sorted(names)) + r')")[^"\\\x00-\x1f]*+"'
    value = _SCALAR
    for _ in range(PASSED - 1):
        member = rf"{other}{_WS}:{_WS}{value}"
        boxes = rf"\{{{_WS}(?:{member}{_WS}(?:,{_WS}{member}{_WS})*+)?\}}|\[{_WS}(?:{value}{_WS}(?:,{_WS}{value}{_WS})*+)?\]"
        value = rf"(?:{_SCALAR}|{boxes})"
    member = rf"{other}{_WS}:{_WS}{value}"
    return re.compile(rf"{_WS}{member}(?:{_WS},{_WS}{member})*+"), re.compile(rf"(?:{_WS},{_WS}{member})++")


class _Box:
    """An open object or list: where it hangs, what has been read of it. Paths are made when one is asked for."""

    __slots__ = ("up", "step", "name", "names", "n", "kind", "made")

    def __init__(self, up: _Box | None, step: str | int | None, name: str, is_object: bool):
        self.up, self.step, self.name, self.n, self.kind, self.made = up, step, name, 0, None, None
        self.names: set[str] | None = set() if is_object else None

    def where(self) -> tuple[str, str, list[int]]:
        """(path, pattern, positions)."""
        steps, box = [], self
        while box.made is None and box.up is not None:
            steps.append(box.step)
            box = box.up
        path, pattern, ordinals = box.made or ("", "", [])
        if steps:
            self.made = path, pattern, ordinals = _extend(path, pattern, ordinals, reversed(steps))
        return path, pattern, ordinals

    def object(self) -> _Box | None:
        box = self
        while box is not None and box.names is None:
            box = box.up
        return box

    def entity(self) -> _Box | None:
        box = self
        while box is not None and box.kind is None:
            box = box.up
        return box


def _extend(path: str, pattern: str, ordinals: list[int], steps) -> tuple[str, str, list[int]]:
    a, b, o = [path], [pattern], list(ordinals)
    dot = bool(path)
    for s in steps:
        if isinstance(s, int):
            a.append(f"[{s}]")
            b.append("[]")
            o.append(s)
        else:
            a.append(f".{s}" if dot else s)
            b.append(f".{s}" if dot else s)
        dot = True
    return "".join(a), "".join(b), o


def stream(text: str, names: frozenset[str] | None = None, discriminator: str | None = None, skip_root: str | None = None, containers: bool = False) -> list[tuple]:
    """The triples of a record in document order; ValueError where the text is no JSON.

    names prunes what is emitted to members of these names; runs of other members without any of them are passed over
    in one match of a pattern that accepts nothing but JSON. discriminator names the member that makes an object an entity; a root whose
    discriminator equals skip_root is none. containers adds a triple without value for each object.
    """
    found: list[tuple] = []  # (box, step, name, value, type)
    box: _Box | None = None
    root: _Box | None = None
    pos, read = 0, _MEMBER.match
    if names is not None:
        first, later = _passing(names | {discriminator} if discriminator else names)
    while True:
        if names is not None and box is not None and box.names is not None:
            m = (later if box.n else first).match(text, pos)
            if m is not None and not (box.names and _repeats(box.names, m[0])):
                pos = m.end()
                box.n += 1
        m = read(text, pos)
        if m is None:
            raise ValueError("invalid JSON")
        pos, kind = m.end(), m.lastindex
        key = m[2]
        if kind == _CLOSE:
            if m[1] or key or box is None or (box.names is not None) != (m[5] == "}"):
                raise ValueError("invalid JSON")
            box = box.up
        else:
            if box is None:
                if m[1] or key:
                    raise ValueError("invalid JSON")
                step, name = None, ""
            elif (m[1] is None) != (box.n == 0) or (key is None) != (box.names is None):
                raise ValueError("invalid JSON")
            elif key is None:
                step, name = box.n, box.name
                box.n += 1
            else:
                step = name = _plain(key)
                box.n += 1
                if name in box.names:
                    _forget(found, box, name)
                else:
                    box.names.add(name)
                if name == discriminator:
                    box.kind = _plain(m[3]) if kind == _TEXT_AT else None
            if kind == _OPEN:
                box = _Box(box, step, name, m[4] == "{")
                root = root or box
                if containers and box.names is not None and (names is None or name in names):
                    found.append((box.up, step, name, None, "object"))
                continue
            if names is None or name in names:
                if kind == _TEXT_AT:
                    found.append((box, step, name, _plain(m[3]), "string"))
                elif kind == _NUMBER:
                    found.append((box, step, name, m[6], "number"))
                else:
                    word = m[7]
                    found.append((box, step, name, None if word == "null" else word, "null" if word == "null" else "boolean"))
        if box is None:
            if text[pos:].strip(" \t\n\r"):
                raise ValueError("invalid JSON: more than one value")
            break
    if root is not None and root.kind == skip_root:
        root.kind = None
    out = []
    for box, step, name, value, kind in found:
        if box is None:
            path, pattern, ordinals, parent, entity = "", "", [], None, None
        else:
            path, pattern, ordinals = box.where()
            path, pattern, ordinals = _extend(path, pattern, ordinals, (step,))
            parent, entity = box.object(), box.entity()
        out.append((_utf8(path), _utf8(pattern), ordinals, _utf8(name), _utf8(value), kind, _utf8(parent.where()[0]) if parent else None, _utf8(entity.where()[0]) if entity else None, _utf8(entity.kind) if entity else None))
    return out


def _repeats(names: set[str], run: str) -> bool:
    """Whether a member that was read may come again in a run."""
    return any(f'"{n}"' in run for n in names)


def _forget(found: list[tuple], box: _Box, name: str) -> None:
    """Drop what was read of a member that comes again."""

    def under(at: _Box | None, step) -> bool:
        while at is not None and at is not box:
            at, step = at.up, at.step
        return at is box and step == name

    found[:] = [f for f in found if not under(f[0], f[1])]


def parse(text: str):
    """The value of a JSON text of any depth; ValueError where it is invalid."""

    def refuse(_: str):
        raise ValueError("no JSON number")

    try:
        return json.loads(text, parse_constant=refuse)
    except RecursionError:
        return parse_iteratively(text)


def parse_iteratively(text: str):
    """JSON of any depth; raises ValueError where it is invalid."""
    boxes: list = []
    pos = 0
    while True:
        m = _MEMBER.match(text, pos)
        if m is None:
            raise ValueError("invalid JSON")
        pos, kind = m.end(), m.lastindex
        top = boxes[-1] if boxes else None
        if kind == _CLOSE:
            if m[1] or m[2] or top is None or isinstance(top, dict) != (m[5] == "}"):
                raise ValueError("invalid JSON")
            value = boxes.pop()
        else:
            if (m[1] is None) != (not top) or (m[2] is None) == isinstance(top, dict):
                raise ValueError("invalid JSON")
            value = ({} if m[4] == "{" else []) if kind == _OPEN else json.loads(m[kind])
            if isinstance(top, dict):
                top[_plain(m[2])] = value
            elif top is not None:
                top.append(value)
            if kind == _OPEN:
                boxes.append(value)
        if not boxes:
            if text[pos:].strip(" \t\n\r"):
                raise ValueError("invalid JSON: more than one value")
            return value


def json_triples(df: DataFrame, record: str, body: str, names: tuple[str, ...] | None = None, discriminator: str | None = None, skip_root: str | None = None, carry: tuple[str, ...] = (), containers: bool = False) -> DataFrame:
    """(record, carry..., triples): names limits what leaves the parser to members of these names."""
    keep = frozenset(names) if names else None
    schema = df.select(record, *carry).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    width = 1 + len(carry)

    def parse_batches(batches):
        import pyarrow as pa

        types = [pa.string(), pa.string(), pa.list_(pa.int32()), *[pa.string()] * 6]
        for batch in batches:
            bodies = batch.column(batch.num_columns - 1)
            names_ = [*batch.schema.names[:width], "path", "pattern", "ordinals", "name", "value", "json_type", "parent", "entity", "entity_name"]
            for start in range(0, batch.num_rows, 512):
                at, rows = [], []
                for i in range(start, min(start + 512, batch.num_rows)):
                    text = bodies[i].as_py()
                    if text is None:
                        continue
                    try:
                        triples = stream(text, keep, discriminator, skip_root, containers)
                    except ValueError:
                        continue
                    rows.extend(triples)
                    at.extend([i] * len(triples))
                if not rows:
                    continue
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                kept = pa.table(batch.columns[:width], names=batch.schema.names[:width]).take(pa.array(at))
                chunks = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in kept.columns]
                yield pa.RecordBatch.from_arrays([*chunks, *arrays], names=names_)

    return df.select(record, *carry, body).mapInArrow(parse_batches, f"{columns}, {TRIPLES}")


def _lists_apart(pattern: Column) -> Column:
    """A pattern without its list marks: a lone object stands where a list of them may."""
    return F.replace(pattern, F.lit("[]"), F.lit(""))


def table_of(triples: DataFrame, record: str, ancestor: str, members: list[str], texts: tuple[str, ...] = ()) -> DataFrame:
    """One flat table: a row for each object at the ancestor, whatever it holds, with the given direct members.

    ancestor is a path of member names; each may be an object, a list of them or lists of lists. The triples must have
    been made with containers. Columns: record, row_path (the occurrence), parent_path (the enclosing object, '' for the
    record itself), ordinal (its position in its list, null for a lone object) and a text column for each member;
    members named in texts count only as texts. The groups are occurrences within one record, so none grows with the input.
    """
    at = _lists_apart(F.col("pattern"))
    is_row = (at == ancestor) & (F.col("json_type") == "object")
    prefix = f"{ancestor}." if ancestor else ""
    is_cell = at.isin([prefix + m for m in members]) & ~F.col("path").endswith("]") & (F.col("json_type") != "object")
    is_cell = is_cell & (~F.col("name").isin(list(texts)) | (F.col("json_type") == "string")) if texts else is_cell
    mine = triples.where(is_row | is_cell).withColumn("_row", is_row).withColumn("row_path", F.when(is_row, F.col("path")).otherwise(F.coalesce("parent", F.lit(""))))
    cols = [F.max(F.when(~F.col("_row") & (F.col("name") == m), F.col("value"))).alias(m) for m in members]
    last = F.when(F.col("path").endswith("]"), F.element_at("ordinals", -1))
    rows = mine.groupBy(record, "row_path").agg(F.max(F.when(F.col("_row"), F.coalesce("parent", F.lit("")))).alias("parent_path"), F.max(F.when(F.col("_row"), last)).alias("ordinal"), *cols, F.max("_row").alias("_is"))
    return rows.where("_is").select(record, "row_path", "parent_path", "ordinal", *members)


def entity_table(triples: DataFrame, record: str, members: list[str]) -> DataFrame:
    """(record, row_path, members...): a row for each entity that has any of the direct members as a text."""
    own = (F.col("json_type") == "string") & F.col("name").isin(members) & ~F.col("path").endswith("]") & (F.col("parent") == F.col("entity"))
    cols = [F.max(F.when(F.col("name") == m, F.col("value"))).alias(m) for m in members]
    return triples.where(own).groupBy(record, F.col("entity").alias("row_path")).agg(*cols)


def _owned(children: DataFrame, owners: DataFrame, record: str, owner: str) -> DataFrame:
    """Children with `owner`, a column of their parent's row; '' where there is none. Null record ids are no key."""
    o = owners.select(F.col(record).alias("_record"), F.col("row_path").alias("_row_path"), F.col(owner).alias("_owner"))
    j = children.join(o, F.col(record).eqNullSafe(F.col("_record")) & (F.col("parent_path") == F.col("_row_path")), "left")
    return j.select(*children.columns, F.coalesce("_owner", F.lit("")).alias("owner"))


def references(records: DataFrame, record: str = "record_id", body: str = "body") -> DataFrame:
    """Every text member named `reference` of bundles, tied to the id of the nearest enclosing resource."""
    t = materialize(json_triples(records, record, body, ("reference", "id"), "resourceType", "Bundle"), "triples")
    # a text in a list named reference is an element of the list, not the member itself
    refs = t.where("name = 'reference' and json_type = 'string' and path not like '%]'").select(record, "path", F.col("value").alias("item_value"), F.col("entity").alias("parent_path"))
    return _owned(refs, entity_table(t, record, ["id"]), record, "id").select(record, "owner", "path", "item_value")


def modifier_payers(records: DataFrame, record: str = "record_id", body: str = "body") -> DataFrame:
    """Every non-empty payer_name of the payer entries of modifiers, tied to the modifier's code."""
    at, inner = "modifier_information", "modifier_payer_information"
    t = materialize(json_triples(records, record, body, (at, inner, "payer_name", "code"), containers=True), "triples")
    modifiers = table_of(t, record, at, ["code"])
    payers = table_of(t, record, f"{at}.{inner}", ["payer_name"], ("payer_name",)).where("payer_name <> ''")
    found = _owned(payers, modifiers, record, "code")
    return found.select(record, "owner", F.concat("row_path", F.lit(".payer_name")).alias("path"), F.col("payer_name").alias("item_value"))
