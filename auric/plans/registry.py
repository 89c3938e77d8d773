"""Registered queries: one Spark callable per operator key, each paired with
an independent DuckDB SQL statement computing the same result.

Every query reads the shared test tables (or frames Spark derives from them)
in full. Inputs are shaped by ``auric.plans.roles``; the oracle SQL uses the
same role definitions as CTEs over plain views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from auric import specs
from auric.operators import dedupe
from auric.plans import gold
from auric.jobs import materialize
from auric.plans.roles import AS_OF, SNAPSHOT_DATE, role, role_cte, roles

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# --------------------------------------------------------------------------
# Silver
# --------------------------------------------------------------------------

EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
_RANKED_EVENTS = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS _rn
  FROM {src})"""
_LIVE = "NOT coalesce(try_cast(IsDeleted AS boolean), false)"


def _events(spark, sf):
    return role(spark, sf, "bronze_events")


@register("latest_by_key", role_cte("bronze_events") + ", " + _RANKED_EVENTS.format(
    src="bronze_events") + """
SELECT * EXCLUDE (_rn) FROM ranked WHERE _rn = 1""")
def q_latest_by_key(spark, sf):
    return dedupe.latest_by_key(_events(spark, sf), "user_id", "ts", ["event_id"])


@register("soft_delete_filter", role_cte("bronze_events") + f"""
SELECT * FROM bronze_events WHERE {_LIVE}""")
def q_soft_delete_filter(spark, sf):
    return dedupe.soft_delete_filter(_events(spark, sf))


@register("hard_delete_semi_join", role_cte("bronze_events", "live_ids") + """
SELECT * FROM bronze_events WHERE user_id IN (SELECT user_id FROM live_ids)""")
def q_hard_delete_semi_join(spark, sf):
    r = roles(spark, sf, "bronze_events", "live_ids")
    return dedupe.hard_delete_semi_join(r["bronze_events"], r["live_ids"], "user_id")


_SILVER_FULL_SQL = role_cte("bronze_events", "live_ids") + ", " + _RANKED_EVENTS.format(
    src=f"(SELECT * FROM bronze_events WHERE {_LIVE})") + """
SELECT user_id, event_type, value, ts AS last_seen FROM (
  SELECT user_id, event_type, value, ts FROM ranked
  WHERE _rn = 1 AND user_id IN (SELECT user_id FROM live_ids))"""


def _silver(spark, sf, **kw):
    r = roles(spark, sf, "bronze_events", "live_ids")
    return dedupe.silver_dedupe(r["bronze_events"], pk="user_id", cursor="ts",
                                tie_breakers=["event_id"],
                                live_ids=kw.pop("live_ids", r["live_ids"]), **kw)


@register("silver_full", _SILVER_FULL_SQL)
def q_silver_full(spark, sf):
    out = _silver(spark, sf, columns=["user_id", "event_type", "value", "ts"])
    return out.withColumnRenamed("ts", "last_seen")


@register("silver_project", role_cte("bronze_events", "live_ids") + ", "
          + _RANKED_EVENTS.format(src=f"(SELECT * FROM bronze_events WHERE {_LIVE})") + """
SELECT user_id AS USER_ID, event_type AS Event_Type, props AS Props FROM ranked
WHERE _rn = 1 AND user_id IN (SELECT user_id FROM live_ids)""")
def q_silver_project(spark, sf):
    # configured spellings differ in case from the stored names
    return _silver(spark, sf, columns=["USER_ID", "Event_Type", "Props"])


@register("silver_keep_all", role_cte("bronze_events", "live_ids") + ", "
          + _RANKED_EVENTS.format(src=f"(SELECT * FROM bronze_events WHERE {_LIVE})") + """
SELECT * EXCLUDE (_rn, _dlt_load_id, _dlt_id) FROM ranked
WHERE _rn = 1 AND user_id IN (SELECT user_id FROM live_ids)""")
def q_silver_keep_all(spark, sf):
    return _silver(spark, sf)


@register("silver_no_flag_column", role_cte("bronze_events", "live_ids") + ", "
          + _RANKED_EVENTS.format(src="(SELECT * EXCLUDE (IsDeleted) FROM bronze_events)") + """
SELECT * EXCLUDE (_rn, _dlt_load_id, _dlt_id) FROM ranked
WHERE _rn = 1 AND user_id IN (SELECT user_id FROM live_ids)""")
def q_silver_no_flag_column(spark, sf):
    r = roles(spark, sf, "bronze_events", "live_ids")
    # the entity is declared with soft deletes, but its bronze has no flag column
    return dedupe.silver_dedupe(r["bronze_events"].drop("IsDeleted"), pk="user_id",
                                cursor="ts", tie_breakers=["event_id"],
                                has_soft_delete=True, live_ids=r["live_ids"])


@register("silver_no_live_ids", role_cte("bronze_events") + ", "
          + _RANKED_EVENTS.format(src=f"(SELECT * FROM bronze_events WHERE {_LIVE})") + """
SELECT * EXCLUDE (_rn, _dlt_load_id, _dlt_id) FROM ranked WHERE _rn = 1""")
def q_silver_no_live_ids(spark, sf):
    return _silver(spark, sf, live_ids=None)


@register("silver_delete_after", role_cte("bronze_events", "live_ids") + ", "
          + _RANKED_EVENTS.format(src="bronze_events") + f"""
SELECT * EXCLUDE (_rn, _dlt_load_id, _dlt_id) FROM ranked
WHERE _rn = 1 AND {_LIVE} AND user_id IN (SELECT user_id FROM live_ids)""")
def q_silver_delete_after(spark, sf):
    return _silver(spark, sf, delete_filter="after")


# --------------------------------------------------------------------------
# Gold
# --------------------------------------------------------------------------

_GOLD_ROLES = ("certificate_c", "account", "country_data", "recordtype")
_ASOF = f"DATE '{AS_OF}'"
_SNAP = f"DATE '{SNAPSHOT_DATE}'"
_CERT_COLUMNS = ["Cert_Status__c", "CB__c", "Certificate_Type__c", "Reason_for_Termination__c",
                 "Date_From__c", "Date_To__c", "First_Issue_Date__c"]


def _cert_select(cert: str, kind: str) -> str:
    """Certificate columns as the gold tables see them, numbers read from text."""
    return ", ".join([f"{cert}.Id AS cert_rel", f"{kind}.Name AS ctype",
                      *(f"{cert}.{c}" for c in _CERT_COLUMNS),
                      *(f"try_cast({cert}.{src} AS double) AS {dst}"
                        for dst, src in gold._MEASURES)])


def _counted(cert: str, kind: str, statuses=specs.ALL_STATUSES,
             categories=specs.CATEGORIES) -> str:
    """Which certificates count: category and status listed, body known and allowed."""
    return (f"{kind}.Name IN ({sql_list(categories)}) "
            f"AND {cert}.Cert_Status__c IN ({sql_list(statuses)}) "
            f"AND {cert}.CB__c NOT IN ({sql_list(specs.EXCLUDED_CBS)})")


# holding: one row for each holder account of a certificate that counts;
# holder: the account that stands for a certificate
_HOLDINGS_SQL = f""", holding AS (
  SELECT {_cert_select("certificate_c", "recordtype")},
         account.Name AS company, account.Type AS acct_type, country_data.Name AS country
  FROM certificate_c
  JOIN recordtype ON certificate_c.RecordTypeId = recordtype.Id
  JOIN account ON account.Certificate_Relation__c = certificate_c.Id
  JOIN country_data ON account.Country__c = country_data.Id
  WHERE account.Type IN ({sql_list(specs.ACCOUNT_TYPES)})
    AND {_counted("certificate_c", "recordtype")}
), holder AS (
  SELECT DISTINCT ON (cert_rel) * FROM holding
  ORDER BY cert_rel,
           CASE WHEN acct_type IN ({sql_list(specs.CERT_HOLDER_TYPES)}) THEN 0 ELSE 1 END,
           company NULLS LAST, acct_type NULLS LAST, country NULLS LAST
)"""
_GOLD_CTE = role_cte(*_GOLD_ROLES) + _HOLDINGS_SQL
_VALID = f"try_cast(Date_To__c AS date) >= {_ASOF}"
_IN_FORCE = f"Cert_Status__c NOT IN ({sql_list(specs.INACTIVE_STATUSES)}) AND {_VALID}"


def _g1(spark, sf):
    r = roles(spark, sf, *_GOLD_ROLES)
    return gold.certificate_account_country(r["account"], r["country_data"],
                                            r["certificate_c"], r["recordtype"])


def _g2(spark, sf):
    r = roles(spark, sf, *_GOLD_ROLES)
    return gold.certificate_holder(r["account"], r["country_data"], r["certificate_c"],
                                   r["recordtype"])


@register("account_country_join", role_cte("account", "country_data") + f"""
SELECT account.Certificate_Relation__c AS cert_rel, account.Name AS company,
       account.Type AS acct_type, country_data.Name AS country
FROM account JOIN country_data ON account.Country__c = country_data.Id
WHERE account.Type IN ({sql_list(specs.ACCOUNT_TYPES)})""")
def q_account_country_join(spark, sf):
    r = roles(spark, sf, "account", "country_data")
    return gold.account_country(r["account"], r["country_data"])


@register("certificate_recordtype_join", role_cte("certificate_c", "recordtype") + f"""
SELECT {_cert_select("certificate_c", "recordtype")}
FROM certificate_c JOIN recordtype ON certificate_c.RecordTypeId = recordtype.Id
WHERE {_counted("certificate_c", "recordtype")}""")
def q_certificate_recordtype_join(spark, sf):
    r = roles(spark, sf, "certificate_c", "recordtype")
    return gold.certificate_recordtype(r["certificate_c"], r["recordtype"])


@register("int_certificate_account_country", _GOLD_CTE + "\nSELECT * FROM holding")
def q_g1(spark, sf):
    return _g1(spark, sf)


@register("holder_preference_dedup", _GOLD_CTE + "\nSELECT * FROM holder")
def q_g2(spark, sf):
    # ranked on a stored G1 (as the gold job does), so a hot certificate is cut to
    # one row per map task before the shuffle
    return gold.holder_preference_dedup(materialize(_g1(spark, sf), "g1"))


@register("certificate_holder", _GOLD_CTE + "\nSELECT * FROM holder")
def q_certificate_holder(spark, sf):
    return _g2(spark, sf)


_BASELINE_NAMES = {"ntfp_services": "management_for_ntfp_and_services"}


@register("baseline_certification", _GOLD_CTE + f"""
SELECT country, ctype, {_SNAP} AS snapshot_date, count(*) AS certificates,
       {", ".join(f"sum({m}) AS {_BASELINE_NAMES.get(m, m)}" for m, _ in gold._MEASURES)}
FROM holder WHERE {_IN_FORCE} AND country IS NOT NULL AND ctype IS NOT NULL
GROUP BY country, ctype""")
def q_baseline_certification(spark, sf):
    return gold.baseline_certification(_g2(spark, sf), AS_OF, SNAPSHOT_DATE)


@register("coc_per_country", _GOLD_CTE + f"""
SELECT {_SNAP} AS snapshot_date, country, count(*) AS certificates
FROM holder WHERE {_IN_FORCE} AND ctype = 'COC' AND country IS NOT NULL
GROUP BY country""")
def q_coc_per_country(spark, sf):
    return gold.coc_per_country(_g2(spark, sf), AS_OF, SNAPSHOT_DATE)


@register("fm_per_country", _GOLD_CTE + f"""
SELECT {_SNAP} AS snapshot_date, country, sum(DISTINCT forest_area_total) AS forest_area,
       count(forest_area_total) AS certificates
FROM holder
WHERE {_IN_FORCE} AND ctype IN ({sql_list(specs.FM_COUNTRY_CATEGORIES)})
GROUP BY country HAVING country IS NOT NULL AND count(forest_area_total) > 0""")
def q_fm_per_country(spark, sf):
    return gold.fm_per_country(_g2(spark, sf), AS_OF, SNAPSHOT_DATE)


@register("sites_with_identity", _GOLD_CTE + f"""
SELECT Certificate_Type__c, ctype, country, {_SNAP} AS snapshot_date,
       count(*) AS "number of sites with identity"
FROM holding
WHERE country IS NOT NULL AND ctype IS NOT NULL AND Certificate_Type__c IS NOT NULL
  AND Cert_Status__c <> 'Terminated' AND {_VALID}
GROUP BY ALL""")
def q_sites_with_identity(spark, sf):
    return gold.sites_with_identity(_g1(spark, sf), AS_OF, SNAPSHOT_DATE)


@register("issued_vs_terminations", _GOLD_CTE + f"""
, event AS (
  SELECT ended.kind, country, ctype, Certificate_Type__c,
         try_cast(CASE ended.kind WHEN 'terminated' THEN Date_From__c
                  ELSE First_Issue_Date__c END AS date) AS event_date,
         CASE ended.kind WHEN 'terminated' THEN Reason_for_Termination__c
              ELSE Cert_Status__c END AS status
  FROM holding, LATERAL (SELECT CASE Cert_Status__c WHEN 'Terminated' THEN 'terminated'
                                ELSE 'new' END AS kind) AS ended
  WHERE Cert_Status__c IS NOT NULL
)
SELECT *, count(*) AS certificates, {_SNAP} AS snapshot_date FROM event
WHERE event_date > DATE '{specs.ISSUE_CUTOFF}' AND country IS NOT NULL AND ctype IS NOT NULL
  AND status IS NOT NULL AND Certificate_Type__c IS NOT NULL
GROUP BY ALL""")
def q_issued_vs_terminations(spark, sf):
    return gold.issued_vs_terminations(_g1(spark, sf), SNAPSHOT_DATE)


def _daily(columns: str, categories) -> str:
    """Certificates in force today by the daily reports' own status list."""
    return f"""
  SELECT recordtype.Name AS category, {columns}
  FROM certificate_c JOIN recordtype ON certificate_c.RecordTypeId = recordtype.Id
  WHERE {_counted("certificate_c", "recordtype", specs.ACTIVE_STATUSES, categories)}
    AND {_VALID}"""


@register("daily_certificate_numbers", role_cte("certificate_c", "recordtype") + f"""
SELECT {_SNAP} AS snapshot_date, category AS "Certificate Category",
       count(*) AS "Number Of Certificates",
       sum(sites)::bigint AS "Number Of Companies"
FROM ({_daily("try_cast(Number_of_Sites__c AS double) AS sites", specs.CATEGORIES)})
GROUP BY category""")
def q_daily_certificate_numbers(spark, sf):
    r = roles(spark, sf, "certificate_c", "recordtype")
    return gold.daily_certificate_numbers(r["certificate_c"], r["recordtype"], AS_OF,
                                          SNAPSHOT_DATE)


@register("daily_forest_areas", role_cte("certificate_c", "recordtype") + f"""
SELECT {_SNAP} AS snapshot_date,
       if(grouping(kind) = 1, 'Total', kind) AS "Forest Type",
       sum(n)::bigint AS "Number Of Certificates", sum(area)::bigint AS "Certified Forest Area"
FROM (
  SELECT kind, count(*) AS n, sum(area)::bigint AS area
  FROM ({_daily("Forest_Type__c AS kind, try_cast(Forest_Area_Total__c AS double) AS area",
                specs.FOREST_CATEGORIES)})
  GROUP BY kind)
GROUP BY GROUPING SETS ((kind), ())""")
def q_daily_forest_areas(spark, sf):
    r = roles(spark, sf, "certificate_c", "recordtype")
    return gold.daily_forest_areas(r["certificate_c"], r["recordtype"], AS_OF,
                                   SNAPSHOT_DATE)


@register("daily_headline", role_cte("non_certificate_holder", "account") + f"""
SELECT {_SNAP} AS snapshot_date, licence.n AS "Promotional license", member.n AS "Members",
       member.lands AS "Member Countries"
FROM (SELECT count(*) FILTER (try_cast(Contract_end_date__c AS date) > {_ASOF}) AS n
      FROM non_certificate_holder) AS licence,
     (SELECT count(*) AS n, count(DISTINCT Country__c) AS lands FROM account
      WHERE RecordTypeId = '{specs.MEMBER_RECORD_TYPE}') AS member""")
def q_daily_headline(spark, sf):
    r = roles(spark, sf, "non_certificate_holder", "account")
    return gold.daily_headline(r["non_certificate_holder"], r["account"], AS_OF,
                               SNAPSHOT_DATE)


@register("members", role_cte("account", "country_data", "regions") + f"""
SELECT regions.Functional_region AS region_fun, regions.Region, country_data.Name AS Country,
       account.Name AS Member, account.Website, account.Chamber__c AS Chamber,
       account.Sub_Chamber__c AS Sub_Chamber, account.Member_Type__c AS Member_Type,
       {_SNAP} AS snapshot_date
FROM account
JOIN country_data ON account.Country__c = country_data.Id
JOIN regions ON country_data.Country_code__c = regions.ISO3
WHERE account.RecordTypeId = '{specs.MEMBER_RECORD_TYPE}'""")
def q_members(spark, sf):
    r = roles(spark, sf, "account", "country_data", "regions")
    return gold.members(r["account"], r["country_data"], r["regions"], SNAPSHOT_DATE)
