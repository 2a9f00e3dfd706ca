"""Queries for the relational operators: projections, joins, aggregates, windows, sorts, set operations, functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import jaro_winkler
from ..marts import prices
from ..operators import relational as R
from .registry import Registry, Tables

_r = Registry()
query = _r.query
QUERIES, ORACLES = _r.queries, _r.oracles

# ---------------------------------------------------------------- projections and predicates


@query("select n_nationkey, n_name from nation")
def project_except(t: Tables) -> DataFrame:
    return t.nation.drop("n_regionkey")


@query("""select charge_id, loaded_at, case when gross_charge is null then 'none' when discounted_cash = gross_charge then 'equal' when discounted_cash < gross_charge then case when discounted_cash < gross_charge / 2 then 'deep' else 'some' end else 'above' end as discount from fct_standard_charges""")
def nested_case(t: Tables) -> DataFrame:
    gross, cash = F.col("gross_charge"), F.col("discounted_cash")
    inner = F.when(cash < gross / 2, "deep").otherwise("some")
    return t.fct_standard_charges.select("charge_id", "loaded_at", F.when(gross.isNull(), "none").when(cash == gross, "equal").when(cash < gross, inner).otherwise("above").alias("discount"))


@query("select npi, version, (status = 'active' and coalesce(deactivation_date > valid_from, false)) as ends, coalesce(practice_state = 'ZA', false) as za from provider_history")
def three_valued(t: Tables) -> DataFrame:
    return t.provider_history.select("npi", "version", ((F.col("status") == "active") & F.coalesce(F.col("deactivation_date") > F.col("valid_from"), F.lit(False))).alias("ends"), F.coalesce(F.col("practice_state") == "ZA", F.lit(False)).alias("za"))


@query(r"select p_partkey, p_name from part where p_brand in ('Brand#12', 'Brand#23') or p_type not ilike '%steel%' or (p_size not in (1, 2, 3) and p_name like '%!_%' escape '!')")
def pattern_filters(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_brand").isin("Brand#12", "Brand#23") | ~F.col("p_type").ilike("%steel%") | (~F.col("p_size").isin(1, 2, 3) & F.expr("p_name like '%!_%' escape '!'"))).select("p_partkey", "p_name")


@query("select item_id, code_seq, code from dim_charge_codes where declared_type is distinct from 'CPT' and (type_conflict is null) <> (code_family is null)")
def distinct_from(t: Tables) -> DataFrame:
    return t.dim_charge_codes.where(~F.col("declared_type").eqNullSafe("CPT") & (F.col("type_conflict").isNull() != F.col("code_family").isNull())).select("item_id", "code_seq", "code")


@query("select source_sha256, source_filename, try_cast(last_updated_on as date) as day, coalesce(try_cast(try_strptime(last_updated_on, '%m/%d/%Y') as date), try_cast(last_updated_on as date)) as any_day from stg_hpt__files")
def try_cast_dates(t: Tables) -> DataFrame:
    return t.stg_hpt__files.select("source_sha256", "source_filename", F.try_to_date("last_updated_on", "yyyy-MM-dd").alias("day"), T.any_date(F.col("last_updated_on")).alias("any_day"))


@query("select c_custkey, (select count(*) from orders o where o.o_custkey = c.c_custkey) as orders, c_acctbal > (select avg(c_acctbal) from customer) as above from customer c")
def scalar_subqueries(t: Tables) -> DataFrame:
    t.customer.createOrReplaceTempView("_rl_customer")
    t.orders.createOrReplaceTempView("_rl_orders")
    return t.spark.sql("select c_custkey, (select count(*) from _rl_orders o where o.o_custkey = c.c_custkey) as orders, c_acctbal > (select avg(c_acctbal) from _rl_customer) as above from _rl_customer c")


@query("with a as (select o_custkey, count(*) as n, max(o_totalprice) as top from orders group by 1), b as (select *, n * 2 as twice from a where n > 3), c as (select * from b where twice > 10) select o_custkey, n, top, twice from c")
def cte_chain(t: Tables) -> DataFrame:
    a = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    b = a.where("n > 3").withColumn("twice", F.col("n") * 2)
    return b.where("twice > 10")


@query("select o_orderkey, o_orderpriority from orders where (null is null or o_orderstatus = null) and ('1-URGENT' is null or o_orderpriority = '1-URGENT')")
def optional_parameters(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("_rl_orders")
    sql = "select o_orderkey, o_orderpriority from _rl_orders where (:status is null or o_orderstatus = :status) and (:priority is null or o_orderpriority = :priority)"
    return t.spark.sql(sql, args={"status": None, "priority": "1-URGENT"})


# ---------------------------------------------------------------- joins


@query("select c.charge_id, c.loaded_at, f.hospital_name, f.last_updated_on from fct_standard_charges c join (select distinct hospital_id, source_sha256, hospital_name, last_updated_on from stg_hpt__files) f using (hospital_id, source_sha256)")
def join_files(t: Tables) -> DataFrame:
    files = t.stg_hpt__files.select("hospital_id", "source_sha256", "hospital_name", "last_updated_on").distinct()
    return t.fct_standard_charges.select("charge_id", "loaded_at", "hospital_id", "source_sha256").join(files, ["hospital_id", "source_sha256"]).select("charge_id", "loaded_at", "hospital_name", "last_updated_on")


@query("select c.charge_id, c.loaded_at, k.code, k.code_family from fct_standard_charges c join (select distinct item_id, code, code_family from dim_charge_codes where code is not null) k using (item_id)")
def join_fan_out(t: Tables) -> DataFrame:
    codes = t.dim_charge_codes.where("code is not null").select("item_id", "code", "code_family").distinct()
    return t.fct_standard_charges.select("charge_id", "loaded_at", "item_id").join(codes, "item_id").drop("item_id")


@query("select s_suppkey, n_name, r_name from supplier left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey and r_name <> 'ASIA'")
def left_joins(t: Tables) -> DataFrame:
    region = t.region.where("r_name <> 'ASIA'")
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("s_suppkey", "n_name", "r_name")


@query("""with h as (select o_orderkey, round(o_totalprice, 2) as v from orders), l as (select l_orderkey, round(sum(l_extendedprice), 2) as v from lineitem group by 1)
select coalesce(o_orderkey, l_orderkey) as orderkey, h.v as v_a, l.v as v_b, case when l_orderkey is null then 'left_only' when o_orderkey is null then 'right_only' else 'differs' end as problem from h full join l on o_orderkey = l_orderkey where l_orderkey is null or o_orderkey is null or abs(h.v - l.v) > 0.005""")
def header_vs_lines(t: Tables) -> DataFrame:
    """All orders against all lines."""
    head = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.round("o_totalprice", 2).alias("v"))
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    return R.reconcile(head, lines, ["orderkey"], ["v"])


@query("select h.npi, h.version, f.seq from provider_history h left join file_log f on h.source_file = 'registry_weekly_' || strftime(f.coverage_start, '%Y%m%d') || '-' || strftime(f.coverage_end, '%Y%m%d') || '.zip'")
def join_computed_key(t: Tables) -> DataFrame:
    """The history against the whole file_log; a version meets each log entry of its file."""
    day = lambda c: F.date_format(c, "yyyyMMdd")
    log = t.file_log.select("seq", F.concat(F.lit("registry_weekly_"), day("coverage_start"), F.lit("-"), day("coverage_end"), F.lit(".zip")).alias("_file"))
    return t.provider_history.join(log, F.col("source_file") == F.col("_file"), "left").select("npi", "version", "seq")


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 100000)")
def semi_join(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey)")
def anti_join(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("select item_id, code_seq from dim_charge_codes where code_family not in (select code_family from dim_charge_codes where declared_type = 'CPT' and code_family is not null)")
def null_aware_anti_join(t: Tables) -> DataFrame:
    t.dim_charge_codes.createOrReplaceTempView("_rl_codes")
    return t.spark.sql("select item_id, code_seq from _rl_codes where code_family not in (select code_family from _rl_codes where declared_type = 'CPT' and code_family is not null)")


@query("select p.p_partkey from part p left join (select distinct l_partkey from lineitem where l_quantity > 45) l on p.p_partkey = l.l_partkey where l.l_partkey is null")
def anti_left_null(t: Tables) -> DataFrame:
    return t.part.join(t.lineitem.where("l_quantity > 45"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey")


@query("""select c.change_id, c.npi, h.version, h.status from nppes_changes c left join provider_history h on c.npi = h.npi and c.last_update_date >= coalesce(h.valid_from, date '0001-01-01') and c.last_update_date < coalesce(h.valid_to, date '9999-12-31')""")
def as_of_join(t: Tables) -> DataFrame:
    facts = t.nppes_changes.select("change_id", "npi", "last_update_date")
    return R.as_of(facts, t.provider_history, "npi", "last_update_date", carry=["version", "status"]).drop("last_update_date")


_SHIFTED = "(select npi, version, valid_from, case when version % 2 = 1 and valid_to is not null then valid_to + 3 else valid_to end as valid_to from provider_history)"


@query(f"select a.npi, a.version as a, b.version as b from {_SHIFTED} a join {_SHIFTED} b on a.npi = b.npi and a.version < b.version and a.valid_from < coalesce(b.valid_to, date '9999-12-31') and b.valid_from < coalesce(a.valid_to, date '9999-12-31')")
def interval_overlap(t: Tables) -> DataFrame:
    shifted = t.provider_history.withColumn("valid_to", F.when((F.col("version") % 2 == 1) & F.col("valid_to").isNotNull(), F.date_add("valid_to", 3)).otherwise(F.col("valid_to")))
    return R.overlap_pairs(shifted, "npi", "version")


@query(f"select distinct b.npi, b.version from {_SHIFTED} a join {_SHIFTED} b on a.npi = b.npi and a.version < b.version and b.valid_from < coalesce(a.valid_to, date '9999-12-31') and b.valid_from < coalesce(b.valid_to, date '9999-12-31') and a.valid_from < coalesce(a.valid_to, date '9999-12-31')")
def interval_overlap_linear(t: Tables) -> DataFrame:
    shifted = t.provider_history.withColumn("valid_to", F.when((F.col("version") % 2 == 1) & F.col("valid_to").isNotNull(), F.date_add("valid_to", 3)).otherwise(F.col("valid_to")))
    return R.overlapping(shifted, "npi", "version")


@query("select distinct h.npi, k.code from (select npi, unnest(taxonomy_codes) as code from provider_history) h join (select distinct primary_taxonomy as code from nppes_changes where primary_taxonomy is not null) k on h.code = k.code")
def array_membership(t: Tables) -> DataFrame:
    keys = t.nppes_changes.select(F.col("primary_taxonomy").alias("code")).where("code is not null").distinct()
    return R.membership(t.provider_history.select("npi", "taxonomy_codes"), "taxonomy_codes", keys, "code").select("npi", "code").distinct()


@query("select source_sha256, source_url, unnest(hospital_addresses) as address from stg_hpt__files")
def lateral_unnest(t: Tables) -> DataFrame:
    return t.stg_hpt__files.select("source_sha256", "source_url", F.explode("hospital_addresses").alias("address"))


@query("select n.n_name, s.n as suppliers, round(count(*) / s.n, 6) as share from nation n join supplier on s_nationkey = n_nationkey cross join (select count(*) as n from supplier) s group by n.n_name, s.n")
def cross_one_row(t: Tables) -> DataFrame:
    one = t.supplier.agg(F.count(F.lit(1)).alias("suppliers"))
    g = t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("_n"))
    return g.crossJoin(F.broadcast(one)).select("n_name", "suppliers", F.round(F.col("_n") / F.col("suppliers"), 6).alias("share"))


@query("select f.source_file, f.seq, m.latest from file_log f join (select kind, max(coverage_end) as latest from file_log where outcome = 'applied' group by kind) m on f.kind = m.kind and f.coverage_end = m.latest")
def join_grouped(t: Tables) -> DataFrame:
    latest = t.file_log.where("outcome = 'applied'").groupBy("kind").agg(F.max("coverage_end").alias("latest"))
    return t.file_log.join(latest, ["kind"]).where("coverage_end = latest").select("source_file", "seq", "latest")


@query("select a.code, count(*) as n from (select upper(trim(code)) as code from dim_charge_codes) a join (select distinct upper(code) as code from dim_charge_codes where declared_type = 'HCPCS' and code = lower(code)) b on a.code = b.code group by a.code")
def join_expression(t: Tables) -> DataFrame:
    low = t.dim_charge_codes.where("declared_type = 'HCPCS' and code = lower(code)").select(F.upper("code").alias("_c")).distinct()
    return t.dim_charge_codes.join(low, F.upper(F.trim("code")) == F.col("_c")).groupBy(F.col("_c").alias("code")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- aggregates


@query("""with k as (select distinct item_id, code, coalesce(code_family, declared_type) as code_family from dim_charge_codes where code is not null)
select c.hospital_id, k.code_family, k.code, coalesce(c.setting, 'unspecified') as setting, count(*) as charge_rows, count(distinct lower(trim(c.payer_name)) || '|' || c.plan_name) as payer_plans, min(c.negotiated_rate) as rate_min, round(quantile_cont(c.negotiated_rate, 0.25), 4) as rate_p25, round(median(c.negotiated_rate), 4) as rate_median, round(quantile_cont(c.negotiated_rate, 0.75), 4) as rate_p75, max(c.negotiated_rate) as rate_max, round(median(c.gross_charge), 4) as gross_median, round(median(c.discounted_cash), 4) as cash_median, min(c.description) as example_description
from fct_standard_charges c join k using (item_id) where c.negotiated_rate > 0 and c.negotiated_rate < 999999999 group by all""")
def price_summary(t: Tables) -> DataFrame:
    charges = t.fct_standard_charges.where("negotiated_rate > 0 and negotiated_rate < 999999999").withColumn("payer_name", F.lower(F.trim("payer_name")))
    s = prices.price_summary(charges, t.dim_charge_codes)
    return s.withColumns({c: F.round(c, 4) for c in ("rate_p25", "rate_median", "rate_p75", "gross_median", "cash_median")})


@query("select hospital_id, count(distinct (item_id, code)) as pairs from dim_charge_codes group by 1")
def count_distinct_pair(t: Tables) -> DataFrame:
    return t.dim_charge_codes.groupBy("hospital_id").agg(F.countDistinct(F.struct("item_id", "code")).alias("pairs"))


@query("select o_custkey, count(*) filter (where o_orderstatus = 'F') as done, count(o_orderpriority) filter (where o_totalprice > 50000) as big, max(o_totalprice) filter (where o_orderstatus = 'O') as top_open, bool_or(o_orderpriority = '1-URGENT') as urgent from orders group by 1")
def filtered_aggregates(t: Tables) -> DataFrame:
    done, is_open = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    return t.orders.groupBy("o_custkey").agg(F.count_if(done).alias("done"), F.count(F.when(F.col("o_totalprice") > 50000, F.col("o_orderpriority"))).alias("big"), F.max(F.when(is_open, F.col("o_totalprice"))).alias("top_open"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query("select l_returnflag, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents, count(*) as n from lineitem group by 1")
def cents_checksum(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(R.cents(F.col("l_extendedprice")).alias("cents"), F.count(F.lit(1)).alias("n"))


@query("select hospital_id, round(avg(case when discounted_cash = gross_charge then 1.0::double else 0.0::double end), 8) as share from fct_standard_charges where gross_charge > 0 and discounted_cash is not null group by 1")
def average_share(t: Tables) -> DataFrame:
    return t.fct_standard_charges.where("gross_charge > 0 and discounted_cash is not null").groupBy("hospital_id").agg(F.round(F.avg(F.when(F.col("discounted_cash") == F.col("gross_charge"), F.lit(1.0)).otherwise(F.lit(0.0))), 8).alias("share"))


@query("select hospital_id, array_to_string(list_sort(list(distinct methodology) filter (where methodology is not null)), '|') as methods from fct_standard_charges group by 1")
def distinct_list(t: Tables) -> DataFrame:
    return t.fct_standard_charges.groupBy("hospital_id").agg(F.array_join(F.array_sort(F.collect_set("methodology")), "|").alias("methods"))


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def grain_violations(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("select max(seq) as last, count(distinct seq) as n from file_log having max(seq) = count(distinct seq)")
def global_having(t: Tables) -> DataFrame:
    return t.file_log.agg(F.max("seq").alias("last"), F.countDistinct("seq").alias("n")).where("last = n")


@query("select distinct p_brand, p_type, p_size from part order by p_size desc, p_brand, p_type limit 20")
def distinct_top(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type", "p_size").distinct().orderBy(F.desc("p_size"), "p_brand", "p_type").limit(20)


def _places(c: Column, places: int) -> Column:
    """Rounded by the same arithmetic as the SQL, half-way values included."""
    return F.floor(c * 10.0**places + 0.5) / 10.0**places


@query("""with p as (select hospital_id, item_id, lower(trim(payer_name)) as payer, median(negotiated_rate) as m from fct_standard_charges where negotiated_rate > 0 and not isnan(negotiated_rate) and payer_name is not null group by all)
select hospital_id, item_id, floor(median(m) * 10000.0::double + 0.5::double) / 10000.0::double as median_of_medians, count(*) as payers, floor((max(m) / min(m)) * 1000000.0::double + 0.5::double) / 1000000.0::double as spread from p group by 1, 2""")
def median_of_medians(t: Tables) -> DataFrame:
    p = t.fct_standard_charges.where("negotiated_rate > 0 and not isnan(negotiated_rate) and payer_name is not null").groupBy("hospital_id", "item_id", F.lower(F.trim("payer_name")).alias("payer")).agg(F.median("negotiated_rate").alias("m"))
    return p.groupBy("hospital_id", "item_id").agg(_places(F.median("m"), 4).alias("median_of_medians"), F.count(F.lit(1)).alias("payers"), _places(F.max("m") / F.min("m"), 6).alias("spread"))


@query("select p_brand, max(p_retailprice) filter (where p_size < 20) as small, max(p_retailprice) filter (where p_size >= 20) as large from part group by 1")
def pivot_by_filter(t: Tables) -> DataFrame:
    sized = t.part.withColumn("size", F.when(F.col("p_size") < 20, "small").otherwise("large"))
    return sized.groupBy("p_brand").pivot("size", ["small", "large"]).agg(F.max("p_retailprice"))


@query("""with g as (select o_orderstatus, count(*) as n, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents from orders group by 1)
select o_orderstatus, n, cents from g union all select 'ALL', cast(sum(n) as bigint), cast(sum(cents) as bigint) from g""")
def total_row(t: Tables) -> DataFrame:
    return R.with_total(t.orders, "o_orderstatus", [F.count(F.lit(1)).alias("n"), R.cents(F.col("o_totalprice")).alias("cents")])


@query("select cast((l_quantity >= 5)::int + (l_quantity >= 10)::int + (l_quantity >= 20)::int + (l_quantity >= 30)::int + (l_quantity >= 40)::int as int) as bin, count(*) as n from lineitem group by 1")
def histogram_bins(t: Tables) -> DataFrame:
    return R.histogram(t.lineitem, "l_quantity", [5, 10, 20, 30, 40])


@query("select hospital_id, round(count(*) filter (where type_conflict is not null) / nullif(count(*) filter (where declared_type = 'HCPCS'), 0), 6) as rate from dim_charge_codes group by 1")
def safe_ratio(t: Tables) -> DataFrame:
    return t.dim_charge_codes.groupBy("hospital_id").agg(R.ratio(F.count_if(F.col("type_conflict").isNotNull()), F.count_if(F.col("declared_type") == "HCPCS"), 6).alias("rate"))


@query("""with v as (select item_id, unnest([{'code': code, 'pos': code_seq}]) as u, type_conflict, declared_type, hospital_id from dim_charge_codes where type_conflict is not null)
select type_conflict as kind, coalesce(declared_type, '') as column_name, count(*) as n, arg_min(item_id, item_id || '#' || u.pos) as first_locator, arg_min(left(u.code, 200), item_id || '#' || u.pos) as sample_value from v group by 1, 2""")
def drift_aggregate(t: Tables) -> DataFrame:
    v = t.dim_charge_codes.where("type_conflict is not null").select(F.col("type_conflict").alias("kind"), F.coalesce("declared_type", F.lit("")).alias("column_name"), "item_id", "code", F.concat("item_id", F.lit("#"), F.col("code_seq").cast("string")).alias("_at"))
    return R.first_seen(v, ["kind", "column_name"], F.col("_at"), "item_id", "code")


# ---------------------------------------------------------------- windows


@query("select npi, source_file, version from provider_history qualify row_number() over (partition by npi order by valid_from desc nulls last, row_hash, version) = 1")
def latest_version(t: Tables) -> DataFrame:
    return R.first_by(t.provider_history, ["npi"], [F.desc_nulls_last("valid_from"), F.asc("row_hash"), F.asc("version")]).select("npi", "source_file", "version")


@query("""with f as (select * from file_log where outcome <> 'rejected_schema' qualify row_number() over (partition by source_file order by seq) = 1)
select cast(row_number() over (order by seq) as integer) as seq, source_file, kind, outcome from f""")
def file_log_dense(t: Tables) -> DataFrame:
    return prices.file_log(t.file_log.where("outcome <> 'rejected_schema'")).select("seq", "source_file", "kind", "outcome")


@query("select p_brand, p_partkey, p_retailprice from part qualify row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) <= 3")
def top3_per_group(t: Tables) -> DataFrame:
    return R.top_k(t.part, ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 3).select("p_brand", "p_partkey", "p_retailprice")


@query("select o_custkey, o_orderkey, cast(rank() over (partition by o_custkey order by o_totalprice desc) as integer) as place, count(*) over (partition by o_custkey) as orders from orders")
def rank_and_count(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey")
    return t.orders.select("o_custkey", "o_orderkey", F.rank().over(w.orderBy(F.desc("o_totalprice"))).alias("place"), F.count(F.lit(1)).over(w).alias("orders"))


@query("select npi, version, valid_to, lead(valid_from) over (partition by npi order by version) as next_from from provider_history")
def lead_next(t: Tables) -> DataFrame:
    return t.provider_history.select("npi", "version", "valid_to", F.lead("valid_from").over(Window.partitionBy("npi").orderBy("version")).alias("next_from"))


@query("""with c as (select user_id, ts, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as prev from events), v as (select * from c where prev is distinct from event_type)
select user_id, event_type, cast(row_number() over w as integer) as version, ts as valid_from, lead(ts) over w as valid_to from v window w as (partition by user_id order by ts, event_id)""")
def scd2_versions(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    v = t.events.withColumn("_prev", F.lag("event_type").over(w)).where(~F.col("_prev").eqNullSafe(F.col("event_type")))
    return v.select("user_id", "event_type", F.row_number().over(w).alias("version"), F.col("ts").alias("valid_from"), F.lead("ts").over(w).alias("valid_to"))


# ---------------------------------------------------------------- sorts and set operations


@query("select o_orderpriority, n from (select o_orderpriority, count(*) as n from orders group by 1) order by o_orderpriority = '5-LOW', n desc, o_orderpriority limit 4")
def sort_by_expression(t: Tables) -> DataFrame:
    g = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("o_orderpriority") == "5-LOW", F.desc("n"), "o_orderpriority").limit(4)


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50 offset 100")
def paging(t: Tables) -> DataFrame:
    return R.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 50, 100)


@query("select charge_id, round(negotiated_rate / gross_charge, 6) as ratio from (select distinct charge_id, negotiated_rate, gross_charge from fct_standard_charges where gross_charge > 0 and negotiated_rate > 0) order by negotiated_rate / gross_charge, charge_id limit 25")
def top_by_ratio(t: Tables) -> DataFrame:
    d = t.fct_standard_charges.where("gross_charge > 0 and negotiated_rate > 0").select("charge_id", "negotiated_rate", "gross_charge").distinct()
    return d.orderBy(F.col("negotiated_rate") / F.col("gross_charge"), "charge_id").limit(25).select("charge_id", F.round(F.col("negotiated_rate") / F.col("gross_charge"), 6).alias("ratio"))


@query("""select 'no_code' as problem, item_id as locator from dim_charge_codes where code is null union all select 'no_type', item_id from dim_charge_codes where declared_type is null union all select 'conflict', item_id from dim_charge_codes where type_conflict is not null""")
def union_problems(t: Tables) -> DataFrame:
    c = t.dim_charge_codes
    part = lambda name, cond: c.where(cond).select(F.lit(name).alias("problem"), F.col("item_id").alias("locator"))
    return part("no_code", "code is null").unionByName(part("no_type", "declared_type is null")).unionByName(part("conflict", "type_conflict is not null"))


# ---------------------------------------------------------------- functions


_NAME = "array_to_string(list_filter(string_split(regexp_replace(replace(upper(s), '&', ' AND '), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda w: w not in ('', 'THE', 'OF', 'AND', 'INC', 'LLC')), ' ')"


@query(f"select npi, version, {_NAME} as name from (select npi, version, org_name as s from provider_history)")
def normal_names(t: Tables) -> DataFrame:
    return t.provider_history.select("npi", "version", T.norm_name(F.col("org_name")).alias("name"))


_TOK = "list_filter(string_split(trim(regexp_replace(upper(a), '[^A-Z0-9]+', ' ', 'g')), ' '), lambda x: x <> '')"


@query(f"""with f as (select distinct source_sha256, unnest(hospital_addresses) as a from stg_hpt__files), k as (select source_sha256, a, {_TOK} as tok, regexp_extract(a, '([0-9]{{5}})(-[0-9]{{4}})?\\s*$', 1) as zip5 from f)
select source_sha256, a as address, zip5, array_to_string(tok, ' ') as tokens, case when regexp_full_match(tok[1], '[0-9]+') then tok[1] || ' ' || coalesce(list_filter(tok[2:], lambda x: x not in ('N', 'S', 'E', 'W', 'NORTH', 'SOUTH', 'EAST', 'WEST'))[1], '') || ' ' || zip5 end as addr_key from k""")
def address_keys(t: Tables) -> DataFrame:
    f = t.stg_hpt__files.select("source_sha256", F.explode("hospital_addresses").alias("address")).distinct()
    zip5 = T.zip5_of(F.col("address"))
    return f.select("source_sha256", "address", zip5.alias("zip5"), F.array_join(T.addr_tokens(F.col("address")), " ").alias("tokens"), T.addr_key(F.col("address"), zip5).alias("addr_key"))


@query("""with n as (select distinct unnest(type_2_npis) as npi from stg_hpt__files), d as (select npi, unnest(string_split('80840' || npi, '')) as c, unnest(range(15, 0, -1)) as place from n where regexp_full_match(npi, '[0-9]{10}')),
s as (select npi, sum(case when place % 2 = 1 then c::int else (2 * c::int) // 10 + (2 * c::int) % 10 end) % 10 = 0 as good from d group by npi)
select n.npi, regexp_full_match(n.npi, '[0-9]{10}') as format_ok, coalesce(s.good, false) as check_ok from n left join s on s.npi = n.npi where n.npi is not null""")
def identifier_checks(t: Tables) -> DataFrame:
    n = t.stg_hpt__files.select(F.explode("type_2_npis").alias("npi")).where("npi is not null").distinct()
    return n.select("npi", T.npi_format_ok(F.col("npi")).alias("format_ok"), T.npi_luhn_ok(F.col("npi")).alias("check_ok"))


@query("select npi, version, md5(concat_ws('|', coalesce(org_name, ''), coalesce(practice_city, ''), coalesce(cast(enumeration_date as varchar), ''), coalesce(cast(deactivation_date as varchar), ''), '[' || array_to_string(taxonomy_codes, ', ') || ']')) as hash, sha256(npi) as key_hash from provider_history")
def row_hash(t: Tables) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    codes = F.concat(F.lit("["), F.array_join("taxonomy_codes", ", "), F.lit("]"))
    return t.provider_history.select("npi", "version", F.md5(F.concat_ws("|", text("org_name"), text("practice_city"), text("enumeration_date"), text("deactivation_date"), codes)).alias("hash"), F.sha2("npi", 256).alias("key_hash"))


@query("select npi, version, greatest(last_update_date, deactivation_date, reactivation_date) as effective_date, least(last_update_date, enumeration_date) as first_date, reverse(left(npi, 4)) || substr(npi, 5, 2) as code from provider_history")
def scalar_functions(t: Tables) -> DataFrame:
    return t.provider_history.select("npi", "version", F.greatest("last_update_date", "deactivation_date", "reactivation_date").alias("effective_date"), F.least("last_update_date", "enumeration_date").alias("first_date"), F.concat(F.reverse(F.left("npi", F.lit(4))), F.substring("npi", 5, 2)).alias("code"))


@query("""with a as (select npi, list(version order by version) as v, list(coalesce(practice_state, '?') order by version) as s from provider_history group by npi)
select npi, cast(list_max(v) as integer) as top, cast(list_sum(list_transform(v, lambda x: x * x)) as bigint) as squares, array_to_string(list_sort(list_distinct(s)), ',') as states, array_to_string(list_filter(v[2:], lambda x: x % 2 = 0), ',') as even_rest, coalesce(list_contains(s, 'ZA'), false) as has_za, array_to_string(list_concat(v, [0]), ',') as padded, s[1] as first_state from a""")
def array_functions(t: Tables) -> DataFrame:
    a = t.provider_history.groupBy("npi").agg(F.array_sort(F.collect_list(F.struct("version", F.coalesce("practice_state", F.lit("?")).alias("s")))).alias("vs"))
    a = a.select("npi", F.col("vs.version").alias("v"), F.col("vs.s").alias("s"))
    text = lambda x: F.transform(x, lambda y: y.cast("string"))
    return a.select(
        "npi", F.array_max("v").alias("top"), F.aggregate("v", F.lit(0).cast("long"), lambda x, y: x + y * y).alias("squares"), F.array_join(F.array_sort(F.array_distinct("s")), ",").alias("states"), F.array_join(text(F.filter(F.slice("v", F.lit(2), F.size("v")), lambda x: x % 2 == 0)), ",").alias("even_rest"),
        F.coalesce(F.array_contains("s", "ZA"), F.lit(False)).alias("has_za"), F.array_join(text(F.concat("v", F.array(F.lit(0)))), ",").alias("padded"), F.get("s", F.lit(0)).alias("first_state"),
    )


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k, json_extract_string(props, '$.none') as none from events")
def json_extract(t: Tables) -> DataFrame:
    v = F.try_parse_json("props")
    return t.events.select("event_id", F.try_variant_get(v, "$.k", "long").alias("k"), F.try_variant_get(v, "$.none", "string").alias("none"))


@query("""select priority, valid, count(*) as n from (select case when lower(trim(o_orderpriority)) in ('1-urgent', '2-high') then lower(trim(o_orderpriority)) end as priority, coalesce(o_orderpriority is null or trim(o_orderpriority) = '' or lower(trim(o_orderpriority)) in ('1-urgent', '2-high'), true) as valid from orders) group by 1, 2""")
def enum_values(t: Tables) -> DataFrame:
    e = T.norm_enum(F.col("o_orderpriority"), ["1-urgent", "2-high"])
    return t.orders.select(e.alias("e")).groupBy(F.col("e.value").alias("priority"), F.col("e.valid").alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""select distinct s as raw, case when regexp_full_match(trim(s), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') then cast(trim(s) as double) end as value from (select unnest(type_2_npis) as s from stg_hpt__files union all select template_version from stg_hpt__files union all select license_number from stg_hpt__files) where s is not null""")
def number_values(t: Tables) -> DataFrame:
    from ..functions.numbers import parse_number

    f = t.stg_hpt__files
    s = f.select(F.explode("type_2_npis").alias("raw")).unionAll(f.select("template_version")).unionAll(f.select("license_number")).where("raw is not null").distinct()
    return s.select("raw", parse_number(F.col("raw"))["value"].alias("value"))


@query("""select a.npi, a.version, round(jaro_winkler_similarity(a.org_name, b.org_name), 9) as likeness from provider_history a join provider_history b on a.npi = b.npi and a.version + 1 = b.version where a.org_name is not null and b.org_name is not null""")
def name_similarity(t: Tables) -> DataFrame:
    h = t.provider_history.where("org_name is not null").select("npi", "version", "org_name")
    nxt = h.select("npi", (F.col("version") - 1).alias("version"), F.col("org_name").alias("_next"))
    j = h.join(nxt, ["npi", "version"])
    return j.select("npi", "version", F.round(jaro_winkler(F.col("org_name"), F.col("_next")), 9).alias("likeness"))


# the same queries under the names by which their tests know them
for _name in ("header_vs_lines", "join_computed_key"):
    QUERIES[f"{_name}_all"], ORACLES[f"{_name}_all"] = QUERIES[_name], ORACLES[_name]
