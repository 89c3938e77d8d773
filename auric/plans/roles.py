"""Role adapters: the shared test tables seen as CRM-shaped silver tables.

The gold and silver functions take CRM-shaped frames (text business columns,
``Id`` keys). The test data is a TPC-H-like star, so each CRM table is a
projection (plus, for sites, one join) of a test table:

=======================  ==============================================
CRM table                derived from
=======================  ==============================================
certificate_c            orders (one certificate per order)
account                  lineitem joined to supplier (certificate sites)
                         union all customer (member accounts)
country_data             nation
recordtype               nation (category per nation key)
regions (seed)           nation joined to region
non_certificate_holder   orders (contract end date)
bronze change log        events (pk user_id, cursor ts, IsDeleted text)
live ids                 customer keys with a non-negative balance
=======================  ==============================================

Every adapter is one SQL template with ``{table}`` placeholders. Spark runs it
with ``spark.sql(template, table=DataFrame)``; the DuckDB oracle runs the same
text with the placeholders replaced by view names, so both sides read
identical inputs. Dates are shifted into the present century so that the
validity and cut-off filters select a real share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auric import specs

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# Validity date and snapshot stamp used by the registered queries.
AS_OF = "2027-01-01"
SNAPSHOT_DATE = "2026-12-01"

_SHIFT = "INTERVAL '8766' DAY"   # 1995-01-01 -> 2019-01-01

ROLE_SQL: dict[str, str] = {
    "certificate_c": f"""
SELECT
  cast(o_orderkey AS string) AS Id,
  'CERT-' || cast(o_orderkey AS string) AS Name,
  CASE WHEN o_custkey % 10 = 0 THEN 'ASI'
       WHEN o_custkey % 10 = 1 THEN NULL
       WHEN o_custkey % 10 = 2 THEN 'FSC'
       ELSE 'CB-' || cast(o_custkey % 7 AS string) END AS CB__c,
  CASE o_orderstatus
       WHEN 'F' THEN CASE o_orderkey % 4 WHEN 0 THEN 'Issued' WHEN 1 THEN 'Reissued'
                                         WHEN 2 THEN 'Reinstated' ELSE 'Extended' END
       WHEN 'O' THEN CASE WHEN o_orderkey % 9 = 0 THEN 'Expired' ELSE 'Suspended' END
       WHEN 'P' THEN 'Terminated' END AS Cert_Status__c,
  'T' || cast(o_orderkey % 3 AS string) AS Certificate_Type__c,
  CASE WHEN o_orderkey % 5 = 4 THEN NULL
       ELSE 'R' || cast(o_orderkey % 5 AS string) END AS Reason_for_Termination__c,
  cast(cast(o_orderdate + {_SHIFT} + INTERVAL '1' DAY * (o_orderkey % 400) AS date)
       AS string) AS Date_From__c,
  CASE WHEN o_orderkey % 50 = 0 THEN 'n/a'
       WHEN o_orderkey % 50 = 25 THEN NULL
       ELSE cast(cast(o_orderdate + INTERVAL '10592' DAY AS date) AS string) END AS Date_To__c,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
       ELSE cast(cast(o_orderdate + {_SHIFT} AS date) AS string) END AS First_Issue_Date__c,
  CASE WHEN o_orderkey % 11 = 0 THEN '12abc'
       WHEN o_orderkey % 11 = 1 THEN NULL
       ELSE cast(cast(floor(o_totalprice / 100) AS bigint) AS string)
            || CASE WHEN o_orderkey % 2 = 0 THEN '.5' ELSE '' END END AS Forest_Area_Total__c,
  cast(cast(floor(o_totalprice / 1000) AS bigint) AS string) AS Boreal_Forests__c,
  cast(o_orderkey % 13 AS string) || '.25' AS Community_Forestry__c,
  CASE WHEN o_orderkey % 6 = 0 THEN '1,234.5'
       ELSE cast(cast(floor(o_totalprice / 500) AS bigint) AS string) END AS Plantations__c,
  cast(cast(floor(o_totalprice / 250) AS bigint) AS string) AS Temperate_Forests__c,
  CASE WHEN o_custkey % 3 = 0 THEN NULL
       ELSE cast(o_custkey % 100 AS string) || '.75' END AS Tropical_Forests__c,
  cast(o_orderkey % 17 AS string) AS Management_for_NTFP_and_Services__c,
  cast(o_orderkey % 9 AS string)
       || CASE WHEN o_orderkey % 4 = 1 THEN '.5' ELSE '' END AS Number_of_Sites__c,
  CASE o_custkey % 5 WHEN 0 THEN 'Boreal' WHEN 1 THEN 'Temperate' WHEN 2 THEN 'Tropical'
       WHEN 3 THEN NULL ELSE 'Plantation' END AS Forest_Type__c,
  'RT' || cast(o_orderkey % 26 AS string) AS RecordTypeId
FROM {{orders}}""",
    "account": f"""
SELECT
  cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-'
    || cast(l_partkey AS string) || '-' || cast(l_suppkey AS string) || '-'
    || cast(cast(l_shipdate AS date) AS string) AS Id,
  'Company ' || cast(l_suppkey AS string) AS Name,
  CASE l_returnflag
    WHEN 'A' THEN CASE l_linenumber % 5
        WHEN 0 THEN 'COC - Single Certificate - Legal Entity'
        WHEN 1 THEN 'COC - Multisite Manager - Legal Entity'
        WHEN 2 THEN 'COC - Group Manager - Legal Entity'
        WHEN 3 THEN 'FM - Group Manager'
        ELSE 'FM - Single Certificate' END
    WHEN 'N' THEN CASE l_linenumber % 6
        WHEN 0 THEN 'COC - Site - Legal Entity'
        WHEN 1 THEN 'COC - Site'
        WHEN 2 THEN 'COC - Group Member – Legal Entity'
        WHEN 3 THEN 'FM - Group Member'
        WHEN 4 THEN 'Project Certificate'
        ELSE 'COC - Site Legal Entity' END
    ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'COC - Group Member - Legal Entity'
              ELSE 'Supplier' END
  END AS Type,
  cast(NULL AS string) AS Website,
  cast(l_orderkey AS string) AS Certificate_Relation__c,
  CASE WHEN l_linenumber = 7 THEN 'N-unknown'
       ELSE 'N' || cast(s_nationkey AS string) END AS Country__c,
  'RT-SITE' AS RecordTypeId,
  cast(NULL AS string) AS Sub_Chamber__c,
  cast(NULL AS string) AS Member_Type__c,
  cast(NULL AS string) AS Chamber__c
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
UNION ALL
SELECT
  'C' || cast(c_custkey AS string) AS Id,
  c_name AS Name,
  cast(NULL AS string) AS Type,
  'www.' || lower(c_name) || '.org' AS Website,
  cast(NULL AS string) AS Certificate_Relation__c,
  'N' || cast(c_nationkey AS string) AS Country__c,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '{specs.MEMBER_RECORD_TYPE}'
       ELSE 'RT-' || c_mktsegment END AS RecordTypeId,
  CASE WHEN c_custkey % 2 = 0 THEN 'North' ELSE 'South' END AS Sub_Chamber__c,
  CASE c_custkey % 3 WHEN 0 THEN 'Organizational' WHEN 1 THEN 'Individual'
       ELSE NULL END AS Member_Type__c,
  CASE c_nationkey % 3 WHEN 0 THEN 'Economic' WHEN 1 THEN 'Environmental'
       ELSE 'Social' END AS Chamber__c
FROM {{customer}}""",
    "country_data": """
SELECT
  'N' || cast(n_nationkey AS string) AS Id,
  n_name AS Name,
  CASE WHEN n_nationkey = 13 THEN 'x' ELSE 'X' END
    || lpad(cast(n_nationkey AS string), 2, '0') AS Country_code__c
FROM {nation}""",
    "recordtype": """
SELECT
  'RT' || cast(n_nationkey AS string) AS Id,
  CASE n_nationkey % 6 WHEN 0 THEN 'FM' WHEN 1 THEN 'FM/COC' WHEN 2 THEN 'CFM'
       WHEN 3 THEN 'COC' WHEN 4 THEN 'CW/FM' ELSE 'Membership' END AS Name
FROM {nation}""",
    "regions": """
SELECT
  'X' || lpad(cast(n_nationkey AS string), 2, '0') AS ISO3,
  CASE WHEN n_nationkey = 7 THEN '-' ELSE r_name END AS Region,
  CASE WHEN r_name = 'AMERICA' THEN 'Americas' ELSE r_name END AS Functional_region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "non_certificate_holder": """
SELECT
  'NCH-' || cast(o_orderkey AS string) AS Id,
  CASE WHEN o_orderkey % 40 = 0 THEN 'tbd'
       ELSE cast(cast(o_orderdate + INTERVAL '9862' DAY AS date) AS string)
  END AS Contract_end_date__c
FROM {orders}""",
    "bronze_events": """
SELECT
  event_id, ts, user_id, event_type, value, props,
  CASE event_type
       WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'True' END
       WHEN 'purchase' THEN 'false'
       WHEN 'view' THEN NULL
       WHEN 'signup' THEN '0'
       ELSE 'junk' END AS IsDeleted,
  'load-' || cast(cast(ts AS date) AS string) AS _dlt_load_id,
  'row-' || cast(event_id AS string) AS _dlt_id
FROM {events}""",
    "live_ids": """
SELECT c_custkey AS user_id FROM {customer} WHERE c_acctbal >= 0""",
    # Date text in the shapes a CRM export carries, some of which are not
    # dates at all; one row per order.
    "date_texts": """
SELECT
  o_orderkey AS id,
  CASE o_orderkey % 27
    WHEN 0 THEN cast(cast(o_orderdate AS date) AS string)
    WHEN 8 THEN replace(cast(cast(o_orderdate AS date) AS string), '-', '/') || ' 10:00:00'
    WHEN 9 THEN replace(cast(cast(o_orderdate AS date) AS string), '-', ' ')
    WHEN 10 THEN replace(cast(cast(o_orderdate AS date) AS string), '-', chr(92))
    WHEN 11 THEN cast(cast(o_orderdate AS date) AS string) || ' 10:00:00 Europe/Berlin'
    WHEN 12 THEN cast(cast(o_orderdate AS date) AS string) || ' 10:00:00 UTC'
    WHEN 13 THEN cast(cast(o_orderdate AS date) AS string) || ' 25:00:00'
    WHEN 14 THEN cast(cast(o_orderdate AS date) AS string) || ' 24:00:00'
    WHEN 15 THEN ' Epoch'
    WHEN 16 THEN cast(cast(o_orderdate AS date) AS string) || ' 10:60:00'
    WHEN 17 THEN cast(cast(o_orderdate AS date) AS string) || ' 23:30:00-02:00'
    WHEN 18 THEN cast(year(o_orderdate) AS string) || '-01/15'
    WHEN 19 THEN '  ' || cast(cast(o_orderdate AS date) AS string) || '  '
    WHEN 20 THEN cast(cast(o_orderdate AS date) AS string) || 'T08:30'
    WHEN 21 THEN cast(cast(o_orderdate AS date) AS string) || 'T08:30:00z'
    WHEN 22 THEN cast(cast(o_orderdate AS date) AS string) || ' 1:2:3.1234567'
    WHEN 23 THEN cast(cast(o_orderdate AS date) AS string) || 'T10'
    WHEN 24 THEN cast(year(o_orderdate) AS string) || '-1-5'
    WHEN 25 THEN cast(cast(o_orderdate AS date) AS string) || ' 24:00:01'
    WHEN 26 THEN cast(cast(o_orderdate AS date) AS string) || 'x'
    WHEN 1 THEN cast(year(o_orderdate) AS string) || '/'
                || lpad(cast(month(o_orderdate) AS string), 2, '0') || '/'
                || lpad(cast(day(o_orderdate) AS string), 2, '0')
    WHEN 2 THEN cast(cast(o_orderdate AS date) AS string) || 'T08:30:00Z'
    WHEN 3 THEN lpad(cast(day(o_orderdate) AS string), 2, '0') || '/'
                || lpad(cast(month(o_orderdate) AS string), 2, '0') || '/'
                || cast(year(o_orderdate) AS string)
    WHEN 4 THEN cast(year(o_orderdate) AS string)
    WHEN 5 THEN cast(year(o_orderdate) AS string) || '-'
                || lpad(cast(month(o_orderdate) AS string), 2, '0')
    WHEN 6 THEN cast(year(o_orderdate) AS string) || '-02-30'
    ELSE '' END AS txt
FROM {orders}""",
    # Number text in the shapes a CRM export carries; one row per event.
    "number_texts": """
SELECT
  event_id AS id,
  CASE event_id % 8
    WHEN 0 THEN cast(value AS string)
    WHEN 1 THEN cast(value AS string) || 'd'
    WHEN 2 THEN ' ' || cast(value AS string) || ' '
    WHEN 3 THEN cast(cast(floor(value) AS bigint) AS string) || 'e2'
    WHEN 4 THEN '1,' || cast(cast(floor(value) AS bigint) AS string)
    WHEN 5 THEN regexp_extract(props, '([0-9]+)', 1)
    WHEN 6 THEN cast(cast(floor(value) AS bigint) AS string) || 'abc'
    ELSE props END AS txt
FROM {events}""",
}

_ROLE_INPUTS = {
    "certificate_c": ("orders",),
    "account": ("lineitem", "supplier", "customer"),
    "country_data": ("nation",),
    "recordtype": ("nation",),
    "regions": ("nation", "region"),
    "non_certificate_holder": ("orders",),
    "bronze_events": ("events",),
    "live_ids": ("customer",),
    "date_texts": ("orders",),
    "number_texts": ("events",),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One CRM-shaped frame derived from the test tables."""
    return roles(spark, sf_dir, name)[name]


def roles(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Several of them; a table that more than one needs is opened once."""
    inputs = {t: read_table(spark, sf_dir, t)
              for t in dict.fromkeys(t for n in names for t in _ROLE_INPUTS[n])}
    return {n: spark.sql(ROLE_SQL[n], **{t: inputs[t] for t in _ROLE_INPUTS[n]}) for n in names}


def role_cte(*names: str) -> str:
    """``WITH`` clause defining the named roles over the plain test views, for
    the DuckDB oracle."""
    parts = []
    for n in names:
        body = ROLE_SQL[n].format(**{t: t for t in _ROLE_INPUTS[n]})
        parts.append(f"{n} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"
