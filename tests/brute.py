"""Row-at-a-time versions of the problem queries, written from their statements, for comparison on small tables."""

from __future__ import annotations

import datetime as dt
import json
import math
import re
from collections import Counter, defaultdict


def clean(v):
    v = (v or "").strip()
    return v or None


def us(v):
    v = clean(v)
    if not v:
        return None
    m, d, y = map(int, v.split("/"))
    return dt.date(y, m, d)


def split_record(raw):
    """(well quoted, cells) by a character machine."""
    cells, i, n = [], 0, len(raw)
    while True:
        if i < n and raw[i] == '"':
            j, out = i + 1, []
            while True:
                if j >= n:
                    return False, None
                if raw[j] == '"':
                    if j + 1 < n and raw[j + 1] == '"':
                        out.append('"')
                        j += 2
                        continue
                    break
                out.append(raw[j])
                j += 1
            if j + 1 < n and raw[j + 1] != ",":
                return False, None
            cells.append("".join(out))
            i = j + 1
        else:
            j = raw.find(",", i)
            j = n if j < 0 else j
            cell = raw[i:j]
            if '"' in cell:
                return False, None
            cells.append(cell)
            i = j
        if i >= n:
            return True, cells
        i += 1
        if i == n:
            cells.append("")
            return True, cells


NUM = {"drug_unit_of_measurement", "standard_charge|gross", "standard_charge|discounted_cash", "standard_charge|negotiated_dollar", "standard_charge|negotiated_percentage", "standard_charge|min", "standard_charge|max", "median_amount", "10th_percentile", "90th_percentile"}
ENUM = {"setting": {"inpatient", "outpatient", "both"}, "billing_class": {"facility", "professional", "both"}, "standard_charge|methodology": {"case rate", "fee schedule", "percent of total billed charges", "per diem", "other"}}


def head(c):
    return re.sub(r"\s*\|\s*", "|", c.strip("﻿ \t\r\n").lower())


def valid(name, v):
    v = v.strip().lower()
    if not v:
        return True
    if name in NUM:
        return bool(re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?", v))
    if name in ENUM:
        return v in ENUM[name]
    if name == "count":
        return v in ("0", "1 through 10") or (v.isdigit() and int(v) >= 11)
    return True


def p1(records):
    names = {r["source_sha256"]: [head(c) for c in split_record(r["raw_record"])[1]] for r in records if r["record_no"] == 3}
    out = set()
    for r in records:
        if r["record_no"] is None or r["record_no"] < 4:
            continue
        ok, cells = split_record(r["raw_record"] or "")
        if ok and not any(c.strip() for c in cells):
            continue
        cols = names.get(r["source_sha256"])
        reason = None if ok else "broken_quoting"
        if ok and (cols is None or len(cells) != len(cols)):
            reason = "column_count"
        elif ok and not all(valid(n, c) for n, c in zip(cols, cells)):
            reason = "invalid_value"
        if reason:
            out.add((r["source_sha256"], r["record_no"], reason))
    return out


FIELDS = ["entity_type", "org_name", "last_name", "first_name", "credential", "practice_address_1", "practice_city", "practice_state", "practice_postal", "enumeration_date", "deactivation_date", "reactivation_date", "primary_taxonomy", "taxonomy_codes"]


def snapshots(rows, log):
    done = {r["source_file"]: r["coverage_end"] for r in log if r["outcome"] == "applied"}
    files = sorted({r["source_file"] for r in rows if r["source_file"] in done}, key=lambda f: done[f])
    best = defaultdict(dict)
    for r in rows:
        f = r["source_file"]
        if f not in done or not clean(r["npi"]):
            continue
        day = us(r["last_update_date"]) or dt.date.min
        val = tuple(us(r[c]) if c.endswith("_date") else tuple(x for x in map(clean, r[c] if r[c] is not None else []) if x) if c == "taxonomy_codes" else clean(r[c]) for c in FIELDS)
        k = clean(r["npi"])
        if k not in best[f] or day > best[f][k][0]:
            best[f][k] = (day, val)
    return files, done, best


def p2(rows, log):
    files, _, best = snapshots(rows, log)
    out = set()
    for a, b in zip(files, files[1:]):
        for k in best[a].keys() | best[b].keys():
            if k not in best[a]:
                out.add((b, k, "added"))
            elif k not in best[b]:
                out.add((b, k, "removed"))
            elif best[a][k][1] != best[b][k][1]:
                out.add((b, k, "changed"))
    return out


def p3(rows, log):
    files, done, best = snapshots(rows, log)
    keys = {k for f in files for k in best[f]}
    out = set()
    for k in keys:
        versions, held, latest = [], None, None
        for f in files:
            end = done[f].isoformat()
            if k not in best[f]:
                if versions and held != "absent":
                    versions.append((end, "absent_from_full"))
                    held = "absent"
                continue
            day, val = best[f][k]
            # a row without a date is older than none
            if day != dt.date.min:
                if latest is not None and day < latest:
                    continue
                latest = day
            if held == "absent" or held is None or held != val:
                gone, back = val[10], val[11]
                versions.append((end, "deactivated" if gone and not (back and back >= gone) else "active"))
                held = val
        for i, (start, status) in enumerate(versions):
            out.add((k, i + 1, start, versions[i + 1][0] if i + 1 < len(versions) else "", status))
    return out


def jtype(v):
    return {str: "string", int: "number", float: "number", bool: "boolean", list: "array", dict: "object"}[type(v)]


def p4(rows, files):
    day = {}
    for r in files:
        v = clean(r["last_updated_on"])
        if v:
            day[r["source_sha256"]] = dt.date.fromisoformat(v) if "-" in v else us(v)
    by = defaultdict(dict)
    for r in rows:
        if r["source_sha256"] in day:
            by[r["hospital_id"], r["source_sha256"]][r["line_key"]] = {head(k): v for k, v in json.loads(r["row_json"]).items()}
    hospitals = defaultdict(list)
    for h, s in by:
        hospitals[h].append((day[s], s))
    out = set()

    def profile(lines):
        t = {c: Counter(jtype(x[c]) for x in lines.values() if x.get(c) is not None) for c in {c for x in lines.values() for c in x}}
        return {c: (min(n, key=lambda k: (-n[k], k)) if n else None) for c, n in t.items()}

    for h, fs in hospitals.items():
        fs.sort()
        for (_, a), (_, b) in zip(fs, fs[1:]):
            la, lb = by[h, a], by[h, b]
            pa, pb = profile(la), profile(lb)
            gone, new = pa.keys() - pb.keys(), pb.keys() - pa.keys()
            for c in pa.keys() & pb.keys():
                if pa[c] and pb[c] and pa[c] != pb[c]:
                    out.add((b, "retyped", c, ""))
            for g in sorted(gone):
                for n in sorted(new):
                    both = [(la[k][g], lb[k][n]) for k in la.keys() & lb.keys() if la[k].get(g) is not None and lb[k].get(n) is not None]
                    if both and 2 * sum(jtype(x) == jtype(y) and x == y for x, y in both) >= len(both):
                        out.add((b, "renamed", g, n))
                        gone, new = gone - {g}, new - {n}
            out |= {(b, "removed", c, "") for c in gone} | {(b, "added", c, "") for c in new}
    return out


def groups5(rows):
    seen, out = set(), defaultdict(list)
    for r in rows:
        v, p = r["negotiated_rate"], clean(r["payer_name"])
        if r["charge_id"] in seen or v is None or math.isnan(v) or v <= 0 or v == 999999999 or p is None or r["hospital_id"] is None:
            continue
        seen.add(r["charge_id"])
        out[r["hospital_id"], p.lower()].append(v)
    return out


def p5(rows):
    import numpy as np

    return {k for k, v in groups5(rows).items() if len(v) >= 30 and np.percentile(v, 90) >= 10 * np.percentile(v, 50)}


def p6(rows):
    out = []

    def bundle(rid, o, path, owner, root):
        if isinstance(o, dict):
            if isinstance(o.get("resourceType"), str) and not (o is root and o["resourceType"] == "Bundle"):
                owner = o.get("id") or ""
            for k, v in o.items():
                p = f"{path}.{k}" if path else k
                if k == "reference" and isinstance(v, str):
                    out.append((rid, owner, p, v))
                bundle(rid, v, p, owner, root)
        elif isinstance(o, list):
            for i, v in enumerate(o):
                bundle(rid, v, f"{path}[{i}]", owner, root)

    def each(v, path):
        if isinstance(v, list):
            return [(x, f"{path}[{i}]") for i, x in enumerate(v)]
        return [(v, path)]

    for r in rows:
        try:
            o = json.loads(r["body"])
        except (ValueError, TypeError):
            continue
        if r["record_kind"] == "fhir_bundle":
            bundle(r["record_id"], o, "", "", o)
        elif isinstance(o, dict):
            for m, pm in each(o.get("modifier_information"), "modifier_information"):
                if isinstance(m, dict):
                    for x, px in each(m.get("modifier_payer_information"), f"{pm}.modifier_payer_information"):
                        if isinstance(x, dict) and isinstance(x.get("payer_name"), str) and x["payer_name"]:
                            out.append((r["record_id"], m.get("code") or "", f"{px}.payer_name", x["payer_name"]))
    return Counter(out)


ATTRS = ["org_name", "practice_address_1", "practice_city", "practice_state", "practice_postal", "primary_taxonomy"]


def p7(history, changes, log):
    done = {r["source_file"]: r["coverage_end"] for r in log if r["outcome"] == "applied"}
    state = {r["npi"]: ["live" if r["status"] == "active" else "known", r["last_update_date"], 0, 0] for r in history if r["is_current"]}
    seen, out = set(), {}
    rows = sorted((r for r in changes if r["source_file"] in done), key=lambda r: (r["last_update_date"], done[r["source_file"]], r["line_no"], r["change_id"]))
    for r in rows:
        k, kind = r["npi"].strip(), r["change_type"].strip().lower()
        same = (k, kind, r["last_update_date"], *(clean(r[a]) for a in ATTRS))
        s = state.get(k)
        if (s and s[1] and r["last_update_date"] < s[1]) or same in seen:
            seen.add(same)
            continue
        seen.add(same)
        city = clean(r["practice_city"])
        live = s[0] if s else None
        if kind == "insert":
            new, sets = "live", True
        elif kind == "update" and live == "live":
            new, sets = "live", city is not None
        elif kind == "deactivate" and live == "live":
            new, sets = "known", False
        elif kind == "reactivate" and live == "known":
            new, sets = "live", city is not None
        else:
            continue
        s = state.setdefault(k, [None, None, 0, 0])
        s[0], s[2] = new, r["change_id"]
        if sets:
            s[3] = r["change_id"]
        out[k] = s
    return {(k, "active" if s[0] == "live" else "deactivated", s[2], s[3]) for k, s in out.items()}
