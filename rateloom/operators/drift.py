"""Problem 4: schemas that drift between files, matched by similarity flooding.

The members of every file are profiled (name, JSON type, nested members). For each pair of a
hospital's consecutive files a schema graph is built from either profile: the file has columns, a
column has a type, an object has members. Scores of pairs of nodes start from the likeness of names,
equality of types and the share of equal values on lines of equal key, and are propagated along equal
edges until they converge; a one-to-one choice of gone and new columns gives the correspondences. An
exact check on the values decides. Then all lines are read into one table under the latest names.

Defined results: undated files have no place in the order and are compared with none, but their lines are in the
table; files of one day go by their hash. Lines that are no JSON object have no members. A member that is only null has
no type and is never retyped. A tie of types goes to the alphabetically first.
"""

from __future__ import annotations

import functools
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_date, norm_header
from ..plans.materialize import materialize
from ..plans.skew import salted_join

#: Least share of equal values of a renamed column.
AGREE = 0.5
#: Residual and rounds at which the propagation ends, and the least score of a correspondence relative to its column's best.
EPSILON, ROUNDS, RELATIVE = 1e-3, 50, 0.5
#: Pairs of files that one task matches, and members of files that one task counts before it hands them on.
PAIRS, MOST_SEEN = 100, 500_000
_TYPES = ("array", "boolean", "number", "object", "string")


def json_type(value: Column) -> Column:
    """JSON type of a variant; null for a JSON null and for none."""
    s = F.schema_of_variant(value)
    return (
        F.when(s.isNull() | (s == "VOID"), None).when(s.startswith("ARRAY"), "array").when(s.startswith("OBJECT"), "object").when(s == "BOOLEAN", "boolean").when(s.isin("STRING", "BINARY"), "string").otherwise("number")
    )


def _members(v: Column) -> Column:
    """The members of a variant object as a map; null where it is none."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def value_text(value: Column, kind: Column) -> Column:
    """A text that is equal for equal values of one type: numbers by value, all else as JSON."""
    number = F.try_variant_get(value, "$", "double").cast("string")
    return F.when(kind == "number", F.concat(F.lit("number:"), F.coalesce(number, F.to_json(value)))).when(kind.isNotNull(), F.concat(kind, F.lit(":"), F.to_json(value)))


def file_order(files: DataFrame, rows: DataFrame) -> DataFrame:
    """(source_sha256, hospital_id, seq): the dated files that rows holds, numbered within each hospital."""
    held = rows.select("hospital_id", "source_sha256").distinct().where("hospital_id is not null and source_sha256 is not null")
    dated = files.select("source_sha256", any_date(F.col("last_updated_on")).alias("_d")).groupBy("source_sha256").agg(F.min("_d").alias("_d")).where("_d is not null")
    order = Window.partitionBy("hospital_id").orderBy("_d", "source_sha256")
    return held.join(dated, "source_sha256").select("source_sha256", "hospital_id", F.row_number().over(order).alias("seq"))


_NAME = re.compile(r"(?:`((?:[^`]|``)*+)`|([^`:<>,]+)): ")
_SIGN = re.compile(r"`(?:[^`]|``)*+`|\([^)]*\)|([<>,])")
_BY_SQL = {"STRING": "string", "BINARY": "string", "BOOLEAN": "boolean", "VOID": None}


@functools.lru_cache(maxsize=100_000)
def members_of(schema: str) -> tuple[tuple[str, str | None, str | None], ...]:
    """(name, JSON type, shape) of the members in the schema text of an object; the shape of an object is its own schema."""
    out, pos = [], len("OBJECT<")
    while schema[pos] != ">":
        m = _NAME.match(schema, pos)
        depth, begin = 0, m.end()
        for t in _SIGN.finditer(schema, begin):
            if t[1] == "<":
                depth += 1
            elif t[1] is not None and depth:
                depth -= t[1] == ">"
            elif t[1] is not None:
                break
        kind = schema[begin : t.start()]
        pos = t.start() if t[1] == ">" else t.end() + 1
        word = kind.partition("<")[0]
        json_kind = _BY_SQL[word] if word in _BY_SQL else {"OBJECT": "object", "ARRAY": "array"}.get(word, "number")
        out.append((m[2] if m[1] is None else m[1].replace("``", "`"), json_kind, kind if word == "OBJECT" else None))
    return tuple(out)


def profiles(rows: DataFrame, body: str = "row_json") -> DataFrame:
    """(hospital_id, source_sha256, member, json_type, shape, keys): one row for each member of a file.

    A line is parsed once and gives nothing but the text of its schema. Lines are counted by that text where they are read, a
    text is taken apart once, and what leaves a task is a row for each member of a file: no line is shuffled.
    """
    schema = F.schema_of_variant(F.try_parse_json(body))
    schema = F.regexp_replace(schema, r": (?:BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9]+,[0-9]+\))(?=[,>])", ": NUMBER")
    texts = rows.select("hospital_id", "source_sha256", schema.alias("schema")).where(F.col("schema").startswith("OBJECT<"))

    def run(batches):
        import pyarrow as pa

        seen: Counter = Counter()

        def table():
            cols = zip(*[(h, f, n, *m) for (h, f, m), n in seen.items()])
            types = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["hospital_id", "source_sha256", "n", "key", "json_type", "shape"])

        for b in batches:
            for (h, f, text), n in Counter(zip(*[c.to_pylist() for c in b.columns])).items():
                for m in members_of(text):
                    seen[h, f, m] += n
            if len(seen) > MOST_SEEN:
                yield table()
                seen.clear()
        if seen:
            yield table()

    cells = texts.mapInArrow(run, "hospital_id string, source_sha256 string, n bigint, key string, json_type string, shape string")
    counted = [F.coalesce(F.sum(F.when(F.col("json_type") == t, F.col("n"))), F.lit(0)).alias(t) for t in _TYPES]
    p = cells.groupBy("hospital_id", "source_sha256", norm_header(F.col("key")).alias("member")).agg(*counted, F.max("shape").alias("shape"), F.collect_set("key").alias("keys"))
    most = F.greatest(*_TYPES)
    kind = F.when(most == 0, None)
    for t in _TYPES:
        kind = kind.when(F.col(t) == most, t)
    return p.select("hospital_id", "source_sha256", "member", kind.alias("json_type"), "shape", "keys")


def _grams(s: str) -> set[str]:
    s = f"^{s}$"
    return {s[i : i + 2] for i in range(len(s) - 1)}


def name_likeness(a: str, b: str) -> float:
    x, y = _grams(a), _grams(b)
    return 2 * len(x & y) / (len(x) + len(y))


def flood(old: list[tuple], new: list[tuple], evidence: dict) -> list[tuple[str, str, float]]:
    """Correspondences of the gone with the new columns of two schemas.

    old and new: (name, type, shape). evidence: share of equal values by (old name, new name). Node
    pairs are (file, file), (column, column), (type, type) and (nested member, nested member); the
    pairwise connectivity graph joins them along equal edge labels. The weight of an edge out of a
    node pair is 1 over the number of its edges of that label. Columns of equal name are matched with each
    other and anchor the propagation.
    """
    import numpy as np

    na, nb = len(old), len(new)
    kinds = {k: i for i, k in enumerate((*_TYPES, None))}
    ta, tb = np.zeros((na, len(kinds))), np.zeros((nb, len(kinds)))
    for i, c in enumerate(old):
        ta[i, kinds[c[1]]] = 1
    for j, c in enumerate(new):
        tb[j, kinds[c[1]]] = 1
    nested = lambda c: frozenset(re.findall(r"([^<>,:]+):", c[2] or ""))
    fa, fb = [nested(c) for c in old], [nested(c) for c in new]
    ma, mb = sorted(set().union(*fa)), sorted(set().union(*fb))
    a_has = np.array([[m in f for m in ma] for f in fa], float).reshape(na, len(ma))
    b_has = np.array([[m in f for m in mb] for f in fb], float).reshape(nb, len(mb))
    start = np.array([[1.0 if a[0] == b[0] else 0.5 * name_likeness(a[0], b[0]) for b in new] for a in old])
    for i, a in enumerate(old):
        for j, b in enumerate(new):
            start[i, j] = max(start[i, j], evidence.get((a[0], b[0]), 0.0))
    start_t = np.eye(len(kinds))
    start_m = np.array([[name_likeness(x.strip(), y.strip()) for y in mb] for x in ma]).reshape(len(ma), len(mb))
    s, t, m, r = start.copy(), start_t.copy(), start_m.copy(), 1.0
    per_type = np.maximum(ta.sum(0)[:, None] * tb.sum(0)[None, :], 1)
    per_member = np.maximum(a_has.sum(0)[:, None] * b_has.sum(0)[None, :], 1) if m.size else None
    out_m = np.maximum(a_has.sum(1)[:, None] * b_has.sum(1)[None, :], 1)
    for _ in range(ROUNDS):
        cs, ct, cm, cr = start + s, start_t + t, start_m + m, 1.0 + r
        ns = cs + cr / (na * nb) + ta @ (ct / per_type) @ tb.T
        nt = ct + ta.T @ cs @ tb
        nr = cr + cs.sum()
        nm = cm
        if m.size:
            ns = ns + a_has @ (cm / per_member) @ b_has.T
            nm = cm + a_has.T @ (cs / out_m) @ b_has
        # a score for each kind of node pair keeps columns comparable with columns
        ns, nt, nr = ns / ns.max(), nt / nt.max(), 1.0 if nr else 0.0
        nm = nm / nm.max() if m.size and nm.max() > 0 else nm
        change = float(np.linalg.norm(ns - s))
        s, t, m, r = ns, nt, nm, nr
        if change < EPSILON:
            break
    common = {c[0] for c in old} & {c[0] for c in new}
    left = [i for i, c in enumerate(old) if c[0] not in common]
    right = [j for j, c in enumerate(new) if c[0] not in common]
    ranked = sorted(((s[i, j], old[i][0], new[j][0], i, j) for i in left for j in right), key=lambda x: (-x[0], x[1], x[2]))
    best_a = {i: max(s[i, j] for j in right) for i in left} if right else {}
    used_a, used_b, out = set(), set(), []
    for score, a, b, i, j in ranked:
        if i in used_a or j in used_b or score < RELATIVE * best_a[i]:
            continue
        used_a.add(i)
        used_b.add(j)
        out.append((a, b, float(score)))
    return out


def schema_changes(rows: DataFrame, files: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """(hospital_id, source_sha256, seq, kind, column_name, new_name, score, share): every change of the later file.

    rows: hospital_id, source_sha256, line_key, row_json. prof: profiles(rows), where it is at hand. Lines are read twice: once
    for the profiles, which are small (columns of files), and once, of files with columns that came or went, for the values
    of those alone. Only equal values on equal lines meet in a join, so nothing is paired within a file or hospital.
    """
    order = file_order(files, rows)
    carry = ["hospital_id", "source_sha256"]
    prof = materialize((profiles(rows) if prof is None else prof).join(order, carry), "profiles")
    a = prof.select("hospital_id", (F.col("seq") + 1).alias("seq"), "member", F.col("json_type").alias("t1"), F.col("keys").alias("_keys1"), F.lit(True).alias("in1"))
    b = prof.select("hospital_id", "seq", "member", F.col("json_type").alias("t2"), F.col("keys").alias("_keys2"), F.lit(True).alias("in2"))
    pairs = order.where("seq > 1").select("hospital_id", "seq", "source_sha256")
    diff = a.join(b, ["hospital_id", "seq", "member"], "full").where("in1 is null or in2 is null or t1 <> t2").join(pairs, ["hospital_id", "seq"])
    diff = materialize(diff.select("hospital_id", "seq", "source_sha256", "member", F.when(F.col("in2").isNull(), "removed").when(F.col("in1").isNull(), "added").otherwise("retyped").alias("kind"), F.coalesce("_keys2", "_keys1").alias("keys")), "schema-diff")
    both = diff.where("kind <> 'retyped'").groupBy("hospital_id", "seq").agg(F.count_if(F.col("kind") == "removed").alias("_r"), F.count_if(F.col("kind") == "added").alias("_a")).where("_r > 0 and _a > 0").select("hospital_id", "seq")
    moved = diff.where("kind <> 'retyped'").join(both, ["hospital_id", "seq"], "left_semi")
    # each column that went or came, by the file that holds it, under the names it has there
    side = moved.select("hospital_id", F.col("seq").alias("pair"), F.when(F.col("kind") == "removed", F.col("seq") - 1).otherwise(F.col("seq")).alias("seq"), "member", "kind", F.explode("keys").alias("key"))
    by_file = side.join(order, ["hospital_id", "seq"]).groupBy("source_sha256").agg(F.collect_list(F.struct("pair", "kind", "member", "key")).alias("_moved"))
    lines = rows.where("hospital_id is not null and line_key is not null").select("hospital_id", "source_sha256", "line_key", "row_json")
    lines = salted_join(lines, by_file, ["source_sha256"], F.col("line_key")).select("hospital_id", "line_key", _members(F.try_parse_json("row_json")).alias("_m"), "_moved").where("_m is not null")
    cells = lines.select("hospital_id", "line_key", F.explode(F.transform("_moved", lambda x: F.struct(x.alias("at"), F.try_element_at("_m", x["key"]).alias("v")))).alias("_c"))
    cells = cells.select("hospital_id", "line_key", "_c.at.*", F.col("_c.v").alias("_v"), json_type(F.col("_c.v")).alias("_k")).where("_k is not null")
    cells = cells.groupBy("hospital_id", F.col("pair").alias("seq"), "kind", "line_key", "member").agg(F.max(value_text(F.col("_v"), F.col("_k"))).alias("value"))
    cells = materialize(cells, "moved-cells")
    gone = cells.where("kind = 'removed'").select("hospital_id", "seq", "line_key", F.col("member").alias("old_name"), "value")
    came = cells.where("kind = 'added'").select("hospital_id", "seq", "line_key", F.col("member").alias("new_name"), "value")
    equal = gone.join(came, ["hospital_id", "seq", "line_key", "value"]).groupBy("hospital_id", "seq", "old_name", "new_name").agg(F.count(F.lit(1)).alias("equal"))
    shared = gone.drop("value").join(equal.drop("equal"), ["hospital_id", "seq", "old_name"]).join(came.drop("value"), ["hospital_id", "seq", "line_key", "new_name"]).groupBy("hospital_id", "seq", "old_name", "new_name").agg(F.count(F.lit(1)).alias("both"))
    evidence = materialize(equal.join(shared, ["hospital_id", "seq", "old_name", "new_name"]).select("hospital_id", "seq", "old_name", "new_name", (F.col("equal") / F.col("both")).alias("share")), "evidence")
    found = _correspondences(prof, both, evidence)
    renamed = found.join(evidence, ["hospital_id", "seq", "old_name", "new_name"]).where(F.col("share") >= AGREE)
    renamed = materialize(renamed, "renamed")
    out = renamed.join(pairs, ["hospital_id", "seq"]).select("hospital_id", "source_sha256", "seq", F.lit("renamed").alias("kind"), F.col("old_name").alias("column_name"), "new_name", "score", "share")
    known = renamed.select("hospital_id", "seq", F.col("old_name").alias("member"), F.lit("removed").alias("kind")).unionByName(renamed.select("hospital_id", "seq", F.col("new_name").alias("member"), F.lit("added").alias("kind")))
    rest = diff.join(known, ["hospital_id", "seq", "member", "kind"], "left_anti")
    none = F.lit(None).cast("double")
    return out.unionByName(rest.select("hospital_id", "source_sha256", "seq", "kind", F.col("member").alias("column_name"), F.lit("").alias("new_name"), none.alias("score"), none.alias("share")))


def _correspondences(prof: DataFrame, both: DataFrame, evidence: DataFrame) -> DataFrame:
    """Similarity flooding for each pair of files; a group is the columns of two files, whatever their rows."""
    col = F.struct("member", "json_type", "shape")
    sides = prof.select("hospital_id", "seq", F.lit(1).alias("side"), col.alias("c")).unionByName(prof.select("hospital_id", (F.col("seq") + 1).alias("seq"), F.lit(0).alias("side"), col.alias("c"))).join(both, ["hospital_id", "seq"], "left_semi")
    schemas = sides.groupBy("hospital_id", "seq").agg(F.array_sort(F.collect_list(F.when(F.col("side") == 0, F.col("c")))).alias("old"), F.array_sort(F.collect_list(F.when(F.col("side") == 1, F.col("c")))).alias("new"))
    shares = evidence.groupBy("hospital_id", "seq").agg(F.collect_list(F.struct("old_name", "new_name", "share")).alias("ev"))
    graph = schemas.join(shares, ["hospital_id", "seq"], "left")
    # few bytes but much work for each pair: spread by number, not by size
    graph = graph.repartition(min(both.count() // PAIRS + 1, 20_000))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                ev = {(e["old_name"], e["new_name"]): e["share"] for e in (r.ev if r.ev is not None else ())}
                tup = lambda cs: [(c["member"], c["json_type"], c["shape"]) for c in cs]
                out += [(r.hospital_id, r.seq, a, b, s) for a, b, s in flood(tup(r.old), tup(r.new), ev)]
            yield pd.DataFrame(out, columns=["hospital_id", "seq", "old_name", "new_name", "score"])

    return graph.mapInPandas(run, "hospital_id string, seq int, old_name string, new_name string, score double")


def consistent_table(rows: DataFrame, files: DataFrame, changes: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """(hospital_id, source_sha256, line_no, line_key, column_name, column_type, value, number, flag): all lines in one table.

    Every member goes under the name it has in the hospital's latest file and is cast to the type it
    has there; renames are followed through all later files. A value stands in number or flag in a column of numbers or
    booleans, else, and where it cannot be cast, in value as text. A file without a place
    in the order (undated, unlisted or without hospital) stands alone: its lines are kept under their own names,
    cast to the types of that file. A line that is no JSON object has no members.

    Names and types are settled by file, from the profiles; they reach the lines with one join by file, hot files
    salted, and no cell is shuffled.
    """
    key = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c)), F.lit("n"))
    keyed = lambda df: df.withColumns({"_h": key("hospital_id"), "_s": key("source_sha256")})
    order = file_order(files, rows)
    ren = changes.where("kind = 'renamed'").groupBy("hospital_id").agg(F.array_sort(F.collect_list(F.struct("seq", F.col("column_name").alias("a"), F.col("new_name").alias("b")))).alias("_renames"))
    placed = order.join(ren, "hospital_id", "left").select("source_sha256", "hospital_id", "seq", "_renames")
    p = (profiles(rows) if prof is None else prof).select("hospital_id", "source_sha256", "member", "json_type").join(placed, ["source_sha256", "hospital_id"], "left")
    name = F.aggregate(F.filter("_renames", lambda r: r["seq"] > F.col("seq")), F.col("member"), lambda acc, r: F.when(acc == r["a"], r["b"]).otherwise(acc))
    p = keyed(p).withColumn("column_name", F.when(F.col("_renames").isNull(), F.col("member")).otherwise(name)).withColumn("_alone", F.when(F.col("seq").isNull(), F.col("_s")).otherwise(""))
    p = materialize(p.select("_h", "_s", "_alone", "seq", "member", "column_name", "json_type"), "file-columns")
    kinds = p.where("json_type is not null").groupBy("_h", "_alone", "column_name").agg(F.max_by("json_type", F.struct(F.coalesce("seq", F.lit(0)), "json_type")).alias("column_type"))
    named = p.join(kinds, ["_h", "_alone", "column_name"], "left").groupBy("_h", "_s").agg(F.map_from_entries(F.collect_list(F.struct("member", F.struct("column_name", "column_type")))).alias("_names"))
    lines = keyed(rows.select("hospital_id", "source_sha256", "line_no", "line_key", "row_json"))
    lines = salted_join(lines, named, ["_h", "_s"], F.col("line_no")).withColumn("_v", F.try_parse_json("row_json")).where(F.schema_of_variant("_v").startswith("OBJECT"))
    own = ["hospital_id", "source_sha256", "line_no", "line_key"]
    cells = lines.select(*own, "_names", F.explode(_members(F.col("_v"))).alias("_key", "_value"))
    cells = cells.select(*own, F.try_element_at("_names", norm_header(F.col("_key"))).alias("_to"), "_value", json_type(F.col("_value")).alias("_kind"))
    cells = cells.select(*own, "_to.*", "_value", "_kind", value_text(F.col("_value"), F.col("_kind")).alias("_text"))
    text = F.when(F.col("_kind") == "string", F.try_variant_get("_value", "$", "string")).otherwise(F.regexp_replace("_text", "^[a-z]+:", ""))
    cells = cells.select(*own, "column_name", "column_type", text.alias("_text"))
    cells = cells.withColumns({"number": F.when(F.col("column_type") == "number", F.col("_text").try_cast("double")), "flag": F.when(F.col("column_type") == "boolean", F.col("_text").try_cast("boolean"))})
    return cells.select(*own, "column_name", "column_type", F.when(F.col("number").isNull() & F.col("flag").isNull(), F.col("_text")).alias("value"), "number", "flag")
