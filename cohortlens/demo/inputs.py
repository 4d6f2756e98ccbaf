"""Raw sources in the published layout, derived from the driver's tables.

Customers play the registered entities, order lines their prescriptions and orders their services.
Every raw column is text, as in the source files, and the awkward cases of real files are present:
null tokens, padding, fractional counts, suppressed values, blank names, entities that are missing
from the registry, without a taxonomy code, or with a code the seed does not know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import OutlierConfig
from cohortlens.functions import null_if_tokens
from cohortlens.plans.build import Build
from cohortlens.session import Workspace
from cohortlens.sources.readers import prefilter_registry
from cohortlens.sources.schemas import REGISTRY_HEADERS, TAXONOMY_SEED

# The seed. One of the five codes below is left out on purpose.
SEED_ROWS = (
    ("207R00000X", "Allopathic", "Internal Medicine", "General", "Internal Medicine Physician"),
    ("208000000X", "Allopathic", "Pediatrics", None, "Pediatrics Physician"),
    ("363L00000X", "Advanced Practice", "Nurse Practitioner", None, "Nurse Practitioner"),
    ("174400000X", "Other Service", "Specialist", None, "Specialist"),
)

# When the files count as loaded, and the time of the reports.
LOADED_AT = "2024-01-31 00:00:00"
NOW = "2024-01-31 12:00:00"

# The mappings below are plain SQL, so that the twin queries can start from the same raw rows.

# customer, nation, region -> registry
REGISTRY = {
    "npi": "cast(c_custkey as string)",
    "entity_type_code": "case when c_acctbal >= 9500 then '2' else '1' end",
    "provider_last_name": "case when c_acctbal between 5000 and 5200 then '  ' else c_name end",
    "provider_first_name": "case when r_name <> 'ASIA' then n_name end",
    "provider_middle_name": "''",
    "provider_credentials": "case when c_acctbal > 4000 then 'M.D.' else 'NULL' end",
    "practice_city": "' ' || n_name || ' '",
    "practice_state": "case when c_acctbal between 2000 and 2300 then '' else lower(left(r_name, 2)) || ' ' end",
    "practice_zip": "lpad(cast(c_custkey as string), 9, '0')",
    "provider_sex_code": "case when c_mktsegment = 'BUILDING' then 'F' else 'M' end",
    "primary_taxonomy_code": """
        case when c_acctbal between 300 and 400 then ''
             when c_mktsegment = 'AUTOMOBILE' then '207R00000X'
             when c_mktsegment = 'BUILDING' then '208000000X'
             when c_mktsegment = 'FURNITURE' then '363L00000X'
             when c_mktsegment = 'HOUSEHOLD' then '174400000X'
             when c_mktsegment = 'MACHINERY' then '122300000X' end""",
    "enumeration_date": "'05/23/2006'",
    "last_update_date": "'01/15/2024'",
    "deactivation_date": "case when c_acctbal < 0 then '03/15/2019' when c_acctbal < 3000 then '' end",
}

# lineitem, orders, part -> prescriptions
PART_D = {
    "prscrbr_npi": "cast(o_custkey as string)",
    "prscrbr_last_org_name": "cast(null as string)",
    "prscrbr_first_name": "cast(null as string)",
    "prscrbr_city": "case when o_orderstatus = 'F' then 'PORT CITY' else ' hill town ' end",
    "prscrbr_state_abrvtn": "case o_orderstatus when 'F' then 'AF' when 'O' then 'EU' else '' end",
    "prscrbr_state_fips": "o_orderstatus",
    "prscrbr_type": "case o_orderstatus when 'F' then 'General Practice' when 'O' then 'Dentist' else ' ' end",
    "prscrbr_type_src": "'S'",
    "brnd_name": "case when p_size = 1 then '  ' else p_name end",
    "gnrc_name": "case when p_size = 50 then '*' when p_size <= 25 then upper(p_name) else p_type end",
    "tot_clms": "cast(l_quantity as string)",
    "tot_30day_fills": "cast(l_quantity * cast(1.5 as double) as string)",
    "tot_day_suply": "cast(cast(l_quantity as bigint) * 30 as string)",
    "tot_drug_cst": "cast(cast(l_extendedprice as decimal(18,2)) as string)",
    "tot_benes": "case when l_quantity < 11 then '*' else cast(cast(l_quantity as bigint) as string) end",
    "ge65_sprsn_flag": "case when l_returnflag = 'R' then '*' else '#' end",
    "ge65_tot_clms": "case when l_returnflag = 'R' then cast(cast(l_quantity as bigint) as string) else 'NULL' end",
    "ge65_tot_30day_fills": "case when l_returnflag = 'R' then cast(l_quantity as string) else 'n/a' end",
    "ge65_tot_drug_cst": """
        case when l_returnflag = 'R' then cast(cast(l_extendedprice as decimal(18,2)) as string) end""",
    "ge65_tot_day_suply": "case when l_returnflag = 'R' then cast(cast(l_quantity as bigint) * 30 as string) end",
    "ge65_bene_sprsn_flag": "case when l_returnflag = 'R' then '' else '*' end",
    "ge65_tot_benes": """
        case when l_returnflag = 'R' and l_quantity >= 11 then cast(cast(l_quantity as bigint) as string) end""",
}

# orders -> services
PART_B = {
    "rndrng_npi": "cast(o_custkey as string)",
    "rndrng_prvdr_last_org_name": "cast(null as string)",
    "rndrng_prvdr_first_name": "cast(null as string)",
    "rndrng_prvdr_mi": "cast(null as string)",
    "rndrng_prvdr_crdntls": "'MD '",
    "rndrng_prvdr_ent_cd": "case when o_orderstatus = 'P' then 'O' else 'I' end",
    "rndrng_prvdr_city": "'LAKE SIDE'",
    "rndrng_prvdr_state_abrvtn": "case when o_orderstatus = 'F' then 'AS' else 'ME' end",
    "rndrng_prvdr_state_fips": "o_orderstatus",
    "rndrng_prvdr_zip5": "lpad(cast(o_custkey as string), 5, '0')",
    "rndrng_prvdr_ruca": "'1'",
    "rndrng_prvdr_ruca_desc": "'Metropolitan, core'",
    "rndrng_prvdr_cntry": "'US'",
    "rndrng_prvdr_type": "'Type ' || o_orderstatus",
    "rndrng_prvdr_mdcr_prtcptg_ind": "'Y'",
    "hcpcs_cd": "o_orderpriority",
    "hcpcs_desc": "lower(o_orderpriority)",
    "hcpcs_drug_ind": "'N'",
    "place_of_srvc": "o_orderstatus",
    "tot_benes": "case when o_orderpriority = '5-LOW' then '*' else cast(month(o_orderdate) as string) end",
    "tot_srvcs": "cast(month(o_orderdate) as string) || '.5'",
    "tot_bene_day_srvcs": "cast(dayofmonth(o_orderdate) as string)",
    "avg_sbmtd_chrg": "cast(cast(o_totalprice as decimal(18,2)) * 1.0 as string)",
    "avg_mdcr_alowd_amt": "cast(cast(o_totalprice as decimal(18,2)) * 0.8 as string)",
    "avg_mdcr_pymt_amt": "cast(cast(o_totalprice as decimal(18,2)) * 0.6 as string)",
    "avg_mdcr_stdzd_amt": "cast(cast(o_totalprice as decimal(18,2)) * 0.5 as string)",
}

# events -> metered usage and finished jobs
METER = {
    "start_time": "ts",
    "warehouse_name": "event_type",
    "credits_used": "value",
    "credits_used_cloud_services": "value / cast(8 as double)",
}
JOB_LOG = {
    "query_id": "event_id",
    "user_name": "cast(user_id as string)",
    "warehouse_name": "case when user_id < 100 then 'MAIN_WH' else 'OTHER_WH' end",
    "warehouse_size": "'X-Small'",
    "query_type": """
        case when event_type in ('purchase', 'signup') then 'INSERT'
             when event_type = 'error' then 'SHOW' else 'SELECT' end""",
    "total_elapsed_time": "cast(round(value * 1000) as bigint)",
    "bytes_scanned": "cast(regexp_extract(props, '([0-9]+)', 1) as bigint) * 100000000",
    "rows_produced": "cast(regexp_extract(props, '([0-9]+)', 1) as bigint)",
    "start_time": "ts",
    "query_text": "'select * from ' || repeat(props, 20)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} as `{name}`" for name, sql in mapping.items()])


def _loaded(df: DataFrame) -> DataFrame:
    """As after loading: null tokens gone, text trimmed, load time added."""
    return null_if_tokens(df).withColumn("_loaded_at", F.lit(LOADED_AT).cast("timestamp_ntz"))


def taxonomy_seed(spark: SparkSession) -> DataFrame:
    """The seed as a local relation, whose size the planner knows."""
    rows = ", ".join(
        "(" + ", ".join("cast(null as string)" if v is None else f"'{v}'" for v in row) + ")" for row in SEED_ROWS
    )
    return spark.sql(f"select * from values {rows} as seed({', '.join(TAXONOMY_SEED.names)})")


def registry_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry before its prefilter, under the long published headers."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    customers = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return _mapped(customers, {REGISTRY_HEADERS[short]: sql for short, sql in REGISTRY.items()})


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(prefilter_registry(registry_file(spark, sf_dir)))


def part_d_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prescriptions: order lines with the ordering customer and the part as the drug."""
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    rows = (
        lines
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    return _mapped(rows, PART_D)


def raw_part_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(part_d_file(spark, sf_dir))


def part_b_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services: orders, with a fractional service count and average amounts as text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    return _mapped(orders, PART_B)


def raw_part_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(part_b_file(spark, sf_dir))


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metered usage; the event type is the warehouse."""
    return _mapped(table(spark, sf_dir, "events"), METER)


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as finished jobs; the payload's number gives the bytes read."""
    return _mapped(table(spark, sf_dir, "events"), JOB_LOG)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalog datasets, each with three nested distributions, two of them CSV files."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority || ' ' as title",
        "date_format(o_orderdate, 'yyyy-MM') as modified",
        """array(
            named_struct('title', 'Orders : ' || date_format(o_orderdate, 'yyyy-MM') || '-01',
                         'downloadURL', 'https://files.example/' || o_orderkey || '.csv',
                         'accessURL', cast(null as string),
                         'mediaType', 'text/csv', 'description', o_orderstatus),
            named_struct('title', 'Orders : 2099-12',
                         'downloadURL', 'https://files.example/' || o_orderkey || '.zip',
                         'accessURL', cast(null as string),
                         'mediaType', 'application/zip', 'description', o_orderstatus),
            named_struct('title', 'Orders, undated',
                         'downloadURL', '',
                         'accessURL', 'https://files.example/' || o_orderkey || '-all.csv',
                         'mediaType', 'text/csv', 'description', o_orderstatus)
        ) as distribution""",
    )


def activity_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered entities with an event total that only few of them have: a thinly covered metric."""
    registry = raw_registry(spark, sf_dir).selectExpr(
        "npi", "primary_taxonomy_code as taxonomy_code", "upper(practice_state) as state"
    )
    activity = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("npi"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("activity"))
    )
    return registry.join(activity, "npi", "left")


# Tables that the model is built from.
MODEL_TABLES = ("customer", "nation", "region", "orders", "part", "lineitem")


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of all files of the model's tables, so that changed inputs are built anew."""
    found = []
    for name in MODEL_TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


_builds: dict[tuple, Build] = {}


def build(spark: SparkSession, sf_dir: str) -> Build:
    """The model on one set of inputs; its tables are written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    if key not in _builds:
        _builds[key] = new_build(spark, sf_dir)
    return _builds[key]


def new_build(spark: SparkSession, sf_dir: str, config: OutlierConfig = OutlierConfig()) -> Build:
    return Build(
        Workspace(spark),
        raw_part_d(spark, sf_dir),
        raw_part_b(spark, sf_dir),
        raw_registry(spark, sf_dir),
        taxonomy_seed(spark),
        config,
    )
