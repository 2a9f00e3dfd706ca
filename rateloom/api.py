"""Read functions over a release: what a service in front of it would answer. All inputs are bound parameters."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.relational import page


class NotFound(LookupError):
    pass


class Invalid(ValueError):
    pass


class Release:
    def __init__(self, spark: SparkSession, path: str | Path):
        self.spark, self.path = spark, Path(path)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"file://{self.path / name}")

    def health(self) -> dict:
        m = json.loads((self.path / "manifest.json").read_text())
        return {"status": "ok", "fingerprint": m["fingerprint"], "tables": m["tables"]}

    def hospitals(self) -> DataFrame:
        return self._table("files").orderBy("hospital_id")

    def conformance(self, hospital_id: str | None = None) -> DataFrame:
        t = self._table("rpt_source_conformance")
        t = t if hospital_id is None else t.where(F.col("hospital_id") == F.lit(hospital_id))
        return t.orderBy("hospital_id", F.desc("n"), "kind", "column")

    def detail(self, table: str, hospital_id: str) -> DataFrame:
        """The rows of one hospital; NotFound where it has none."""
        t = self._table(table).where(F.col("hospital_id") == F.lit(hospital_id))
        if t.isEmpty():
            raise NotFound(hospital_id)
        return t

    def prices(self, code: str, hospital_id: str | None = None, rate_basis: str | None = None) -> DataFrame:
        t = self._table("agg_code_prices")
        self._known(t, "rate_basis", rate_basis)
        t.createOrReplaceTempView("_rl_prices")
        has = "rate_basis" in t.columns
        sql = "select * from _rl_prices where code = :code and (:hospital is null or hospital_id = :hospital)" + (" and (:basis is null or rate_basis = :basis)" if has else "")
        return self.spark.sql(sql, args={"code": code.strip().upper(), "hospital": hospital_id, **({"basis": rate_basis} if has else {})}).orderBy("hospital_id", "setting", *(["rate_basis"] if has else []))

    def charges(self, code: str, hospital_id: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
        """Charges of items with the code: the semi-join comes before the page is cut."""
        if not 1 <= limit <= 1000 or offset < 0:
            raise Invalid("limit is 1 to 1000, offset at least 0")
        items = self._table("dim_charge_codes").where(F.col("code") == F.lit(code.strip().upper())).select("item_id")
        t = self._table("fct_standard_charges").join(items, "item_id", "left_semi")
        t = t if hospital_id is None else t.where(F.col("hospital_id") == F.lit(hospital_id))
        return page(t, [F.asc("hospital_id"), F.asc("charge_id")], limit, offset)

    @staticmethod
    def _known(t: DataFrame, column: str, value: str | None) -> None:
        if value is not None and (column not in t.columns or t.where(F.col(column) == F.lit(value)).isEmpty()):
            raise Invalid(f"unknown {column}: {value}")
