"""Clinical bundles: files or texts to one row for each entry.

A bundle is known by the SHA-256 of its bytes, so the order of files does not matter. Envelope problems
become rows of their own: not_a_bundle, entry_without_resource, missing_id; a text that is no JSON is
not_a_bundle. Resources leave as JSON text, which the operators parse as variants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "bundle_sha256 string, bundle_type string, entry int, full_url string, resource_type string, resource_id string, resource string, problem string"


def read_bundles(spark: SparkSession, glob: str) -> DataFrame:
    """Entries of all bundle files of a glob; no row where there is none."""
    try:
        files = spark.read.format("binaryFile").load(glob)
    except Exception as e:  # a glob without files is an empty source
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], SCHEMA)
    return bundle_entries(files.select(F.sha2("content", 256).alias("bundle_sha256"), F.decode("content", "UTF-8").alias("body")))


def bundle_entries(bodies: DataFrame) -> DataFrame:
    """bodies: (bundle_sha256, body). One row for each entry, numbered from 0, and one for each bundle (entry -1)."""

    def run(batches):
        import json

        import pyarrow as pa

        from ..operators.nested import parse

        text = lambda v: v if isinstance(v, str) else None if v is None else json.dumps(v)
        names = ["bundle_sha256", "bundle_type", "entry", "full_url", "resource_type", "resource_id", "resource", "problem"]
        for b in batches:
            for sha, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                try:
                    doc = parse((body or "").lstrip("﻿"))
                except ValueError:
                    doc = None
                if not isinstance(doc, dict) or doc.get("resourceType") != "Bundle":
                    rows.append((sha, None, -1, None, text(doc.get("resourceType")) if isinstance(doc, dict) else None, None, None, "not_a_bundle"))
                else:
                    entries = doc.get("entry") or []
                    entries = entries if isinstance(entries, list) else [entries]
                    rows.append((sha, text(doc.get("type")), -1, None, "Bundle", None, None, None))
                    for n, e in enumerate(entries):
                        res = e.get("resource") if isinstance(e, dict) else None
                        if not isinstance(res, dict) or not isinstance(res.get("resourceType"), str):
                            rows.append((sha, None, n, None, "?", None, None, "entry_without_resource"))
                        else:
                            rid = text(res.get("id")) or None
                            rows.append((sha, None, n, text(e.get("fullUrl")), res["resourceType"], rid, json.dumps(res, ensure_ascii=True), None if rid else "missing_id"))
                cols = list(zip(*rows))
                types = [pa.string(), pa.string(), pa.int32(), *[pa.string()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return bodies.mapInArrow(run, SCHEMA)
