"""python -m rateloom.cli COMMAND: stage, sync, bundles, gates, export, verify, publish, query. Exit 0 well, 1 failed, 2 misused."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path


def _spark():
    from .session import build_session

    return build_session()


def stage(a) -> int:
    from .operators.staging import stage_file
    from .sources.landing import land

    print(json.dumps(stage_file(_spark(), land(a.owner, Path(a.file), Path(a.root)), a.format, f"{a.root}/staging")))
    return 0


def sync(a) -> int:
    from .operators import scd2

    spark = _spark()
    Path(a.state).mkdir(parents=True, exist_ok=True)
    found = sorted(Path(a.archives).glob("*.zip"))
    kind = lambda p: "weekly" if "Weekly" in p.name else "full"
    paths = {p.name: str(p) for p in found}
    done = scd2.sync(scd2.HistoryStore(spark, f"file://{Path(a.state).resolve()}"), [(p.name, kind(p)) for p in found], lambda n, k: scd2.stage_archive(spark, paths[n], k), a.reapply)
    print(json.dumps(done))
    return 0


def bundles(a) -> int:
    from .operators import clinical
    from .plans.materialize import materialize
    from .sources.bundles import read_bundles

    spark = _spark()
    entries = materialize(read_bundles(spark, f"{a.folder}/*.json"), "entries")
    for name, df in clinical.stage(entries).items():
        df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    return 0


def gates(a) -> int:
    from . import gates as g
    from .operators.staging import read_staged

    spark = _spark()
    t = {n: read_staged(spark, f"{a.root}/staging", n) for n in ("charges", "codes", "drift", "file")}
    try:
        g.run_gates({"charge_id": g.grain(t["charges"], ["charge_id"]), "codes": g.grain(t["codes"], ["item_id", "code_seq"]), "rows_kept": g.rows_kept(t["file"], t["charges"]), "quarantine": g.quarantine_share(t["file"]), "required": g.required_present(t["drift"]), "template": g.accepted(t["file"], "template_version", ["3.0.0"])})
    except g.GateError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


def export(a) -> int:
    from . import release
    from .marts import prices
    from .operators.staging import read_staged

    spark = _spark()
    s = {n: read_staged(spark, f"{a.root}/staging", n) for n in ("charges", "codes", "drift", "file")}
    tables = {"fct_standard_charges": prices.standard_charges(s["charges"], s["file"]), "dim_charge_codes": s["codes"], "files": s["file"], "rpt_source_conformance": prices.conformance(s["drift"], s["file"])}
    inputs = {"files": [list(r) for r in s["file"].select("hospital_id", "source_sha256").orderBy("hospital_id").collect()]}
    print(release.export(spark, tables, Path(a.out), inputs)["fingerprint"])
    return 0


def verify(a) -> int:
    from .release import verify as check

    wrong = check(_spark(), Path(a.out))
    print("\n".join(wrong) or "PASS")
    return int(bool(wrong))


def publish(a) -> int:
    from .publish import publish as swap

    spark = _spark()
    names = json.loads((Path(a.out) / "manifest.json").read_text())["tables"]
    wrong = swap(spark, {n: spark.read.parquet(f"file://{Path(a.out).resolve() / n}") for n in names}, Path(a.target).resolve())
    print(json.dumps(wrong))
    return int(any(wrong.values()))


def query(a) -> int:
    from .queries import deliveries, pipelines, problems, relational

    known = {**problems.QUERIES, **relational.QUERIES, **pipelines.QUERIES, **deliveries.QUERIES}
    if a.name not in known:
        print(f"unknown query; there are {', '.join(known)}", file=sys.stderr)
        return 2
    known[a.name](_spark(), a.data).write.mode("overwrite").parquet(a.out)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rateloom")
    sub = p.add_subparsers(dest="command", required=True)

    def command(f, *options, **defaults):
        c = sub.add_parser(f.__name__)
        for o in options:
            c.add_argument(o)
        for o, d in defaults.items():
            c.add_argument(f"--{o}", **({"action": "store_true"} if d is False else {"default": d}))
        c.set_defaults(run=f)

    command(stage, "owner", "file", format="csv_tall", root="data")
    command(sync, "archives", "state", reapply=False)
    command(bundles, "folder", "out")
    command(gates, root="data")
    command(export, "out", root="data")
    command(verify, "out")
    command(publish, "out", "target")
    command(query, "name", "data", "out")
    try:
        a = p.parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    return a.run(a)


if __name__ == "__main__":
    sys.exit(main())
