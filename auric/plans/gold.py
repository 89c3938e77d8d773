"""Gold metrics as pure DataFrame functions over CRM-shaped silver frames.

Inputs are silver tables (text columns). ``as_of`` is the validity date the
filters compare with (default: today in the session time zone);
``snapshot_date`` is the date stamped on every output row. They are separate
on purpose: a back-dated snapshot does not silently move the validity date.

Plan notes for large inputs:

* ``certificate_account_country`` joins the filtered certificate and account
  frames on the certificate relation. Both grow with the data, so this is a
  shuffled join; AQE splits a certificate that owns a large share of accounts
  (skew join) and picks broadcast when one side turns out small at run time.
  The dimension joins (record types, countries) are left to the planner, which
  broadcasts them when their estimated size is under the broadcast threshold
  and falls back to a shuffled join otherwise.
* ``holder_preference_dedup`` (the direct form: window after the join)
  reuses the join's partitioning and adds no exchange, but sorts a hot
  certificate in one task. ``certificate_holder`` (used by the gold job)
  picks the preferred account per certificate before the join, with a
  partial group limit ahead of the shuffle, and joins 1:1.
* ``issued_vs_terminations`` tags rows of its two disjoint kinds in one pass
  and aggregates once.
* Every aggregate is a hash aggregate with a map-side partial step, so a hot
  group key reaches the final step as one partial row per map task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric import specs
from auric.functions.casts import bigint_half_even, exact_sum, safe_date, safe_double
from auric.operators.dedupe import q

DateLike = _dt.date | str | None


def _date_lit(d: DateLike) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def snapshot_stamp(df: DataFrame, snapshot_date: DateLike = None) -> DataFrame:
    """Append the constant ``snapshot_date`` column (default: today)."""
    return df.withColumn("snapshot_date", _date_lit(snapshot_date).cast("date"))


def currently_valid(col_name: str, as_of: DateLike = None) -> Column:
    """``try_cast(col as date) >= as_of``: valid through the as-of day."""
    return safe_date(q(col_name)) >= _date_lit(as_of)


def certificate_filter(certificate: DataFrame, statuses=specs.ALL_STATUSES) -> DataFrame:
    """Status in the list and certification body not excluded (NULL bodies drop)."""
    return certificate.where(q("Cert_Status__c").isin(*statuses)
                             & ~q("CB__c").isin(*specs.EXCLUDED_CBS))


def _categorised(certificate: DataFrame, recordtype: DataFrame,
                 categories) -> DataFrame:
    rt = recordtype.select(q("Id").alias("_rt_id"), q("Name").alias("ctype"))
    return (certificate.join(rt, q("RecordTypeId") == F.col("_rt_id"), "inner")
            .where(F.col("ctype").isin(*categories))
            .drop("_rt_id"))


def account_country(account: DataFrame, country_data: DataFrame) -> DataFrame:
    """Accounts of the certificate-holding types with their country name."""
    cd = country_data.select(q("Id").alias("_cd_id"), q("Name").alias("country"))
    return (account.where(q("Type").isin(*specs.ACCOUNT_TYPES))
            .select(q("Certificate_Relation__c").alias("cert_rel"),
                    q("Name").alias("company"),
                    q("Type").alias("acct_type"),
                    q("Country__c").alias("_country_id"))
            .join(cd, F.col("_country_id") == F.col("_cd_id"), "inner")
            .select("cert_rel", "company", "acct_type", "country"))


_MEASURES = (
    ("forest_area_total", "Forest_Area_Total__c"),
    ("boreal_forests", "Boreal_Forests__c"),
    ("community_forestry", "Community_Forestry__c"),
    ("plantations", "Plantations__c"),
    ("temperate_forests", "Temperate_Forests__c"),
    ("tropical_forests", "Tropical_Forests__c"),
    ("ntfp_services", "Management_for_NTFP_and_Services__c"),
)

G1_COLUMNS = ("cert_rel", "ctype", "Cert_Status__c", "CB__c", "Certificate_Type__c",
              "Reason_for_Termination__c", "Date_From__c", "Date_To__c",
              "First_Issue_Date__c", *[m for m, _ in _MEASURES],
              "company", "acct_type", "country")


def certificate_recordtype(certificate: DataFrame, recordtype: DataFrame) -> DataFrame:
    """Certificates in the five categories, all six statuses, allowed bodies,
    with the category name and the forest measures read as doubles."""
    cert = _categorised(certificate_filter(certificate), recordtype, specs.CATEGORIES)
    return cert.select(
        q("Id").alias("cert_rel"), "ctype",
        *[q(c) for c in ("Cert_Status__c", "CB__c", "Certificate_Type__c",
                         "Reason_for_Termination__c", "Date_From__c", "Date_To__c",
                         "First_Issue_Date__c")],
        *[safe_double(q(src)).alias(dst) for dst, src in _MEASURES])


def certificate_account_country(account: DataFrame, country_data: DataFrame,
                                certificate: DataFrame, recordtype: DataFrame) -> DataFrame:
    """One row per (certificate, holder account): G1."""
    cert = certificate_recordtype(certificate, recordtype)
    acct = account_country(account, country_data)
    return cert.join(acct, "cert_rel", "inner").select(*G1_COLUMNS)


def _holder_order() -> list[Column]:
    pref = F.when(F.col("acct_type").isin(*specs.CERT_HOLDER_TYPES), 0).otherwise(1)
    return [pref.asc(), F.col("company").asc_nulls_last(),
            F.col("acct_type").asc_nulls_last(), F.col("country").asc_nulls_last()]


def _first_per_cert(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("cert_rel").orderBy(*_holder_order())
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


def holder_preference_dedup(g1: DataFrame) -> DataFrame:
    """One row per certificate, preferring a certificate-holder account type;
    ties broken by company, account type and country (ascending) so the
    result does not depend on partitioning."""
    return _first_per_cert(g1)


def certificate_holder(account: DataFrame, country_data: DataFrame,
                       certificate: DataFrame, recordtype: DataFrame) -> DataFrame:
    """G2 computed without materialising G1: the preferred account of each
    certificate is chosen first, then joined to its certificate.

    Equal to ``holder_preference_dedup(certificate_account_country(...))``
    when certificate ids are unique (silver guarantees it): every G1 row of a
    certificate carries the same certificate columns, so the choice depends
    on the account columns only. Choosing before the join puts a partial
    group limit in front of the shuffle, so a certificate with a very large
    number of accounts sends one row per map task, and the join becomes 1:1.
    """
    cert = certificate_recordtype(certificate, recordtype)
    best = _first_per_cert(account_country(account, country_data))
    return cert.join(best, "cert_rel", "inner").select(*G1_COLUMNS)


def _valid_active(g2: DataFrame, as_of: DateLike) -> DataFrame:
    return g2.where(currently_valid("Date_To__c", as_of)
                    & ~q("Cert_Status__c").isin(*specs.INACTIVE_STATUSES))


def baseline_certification(g2: DataFrame, as_of: DateLike = None,
                           snapshot_date: DateLike = None) -> DataFrame:
    base = _valid_active(g2, as_of).where(F.col("ctype").isNotNull()
                                          & F.col("country").isNotNull())
    out = base.groupBy("ctype", "country").agg(
        F.count(F.lit(1)).alias("certificates"),
        exact_sum("boreal_forests").alias("boreal_forests"),
        exact_sum("community_forestry").alias("community_forestry"),
        exact_sum("forest_area_total").alias("forest_area_total"),
        exact_sum("ntfp_services").alias("management_for_ntfp_and_services"),
        exact_sum("plantations").alias("plantations"),
        exact_sum("temperate_forests").alias("temperate_forests"),
        exact_sum("tropical_forests").alias("tropical_forests"))
    return snapshot_stamp(out, snapshot_date)


def coc_per_country(g2: DataFrame, as_of: DateLike = None,
                    snapshot_date: DateLike = None) -> DataFrame:
    base = _valid_active(g2, as_of).where((F.col("ctype") == "COC")
                                          & F.col("country").isNotNull())
    out = base.groupBy("country").agg(F.count(F.lit(1)).alias("certificates"))
    return snapshot_stamp(out, snapshot_date)


def fm_per_country(g2: DataFrame, as_of: DateLike = None,
                   snapshot_date: DateLike = None) -> DataFrame:
    """Forest certificates and area per country: the area of each distinct
    value is counted once per country, the certificates all count."""
    base = (_valid_active(g2, as_of)
            .where(F.col("ctype").isin(*specs.FM_COUNTRY_CATEGORIES)
                   & F.col("country").isNotNull()
                   & F.col("forest_area_total").isNotNull())
            .select("country", F.col("forest_area_total").alias("area")))
    step1 = base.groupBy("country", "area").agg(F.count(F.lit(1)).alias("cnt"))
    out = step1.groupBy("country").agg(exact_sum("area").alias("forest_area"),
                                       F.sum("cnt").alias("certificates"))
    return snapshot_stamp(out, snapshot_date)


def sites_with_identity(g1: DataFrame, as_of: DateLike = None,
                        snapshot_date: DateLike = None) -> DataFrame:
    """Sites per (country, category, certificate type); built before the
    holder dedup; only Terminated is excluded."""
    base = g1.where((q("Cert_Status__c") != "Terminated")
                    & currently_valid("Date_To__c", as_of)
                    & F.col("country").isNotNull() & F.col("ctype").isNotNull()
                    & q("Certificate_Type__c").isNotNull())
    out = base.groupBy("country", "ctype", "Certificate_Type__c").agg(
        F.count(F.lit(1)).alias("number of sites with identity"))
    return snapshot_stamp(out, snapshot_date)


def issued_vs_terminations(g1: DataFrame, snapshot_date: DateLike = None,
                           cutoff: DateLike = specs.ISSUE_CUTOFF) -> DataFrame:
    """New issues and terminations after the cut-off, one table with a
    ``kind`` tag; ``status`` holds the status for new issues and the
    termination reason for terminations.

    The two kinds are disjoint (Terminated or not), so one pass over G1 tags
    each row with its kind, its event date and its status column, and one
    aggregate groups them: G1 is scanned once, not once per kind.
    """
    cut = _date_lit(cutoff)
    first_issue = safe_date(q("First_Issue_Date__c"))
    date_from = safe_date(q("Date_From__c"))
    terminated = q("Cert_Status__c") == "Terminated"
    common = (F.col("country").isNotNull() & F.col("ctype").isNotNull()
              & q("Certificate_Type__c").isNotNull())
    is_new = ((first_issue > cut) & ~terminated & q("First_Issue_Date__c").isNotNull()
              & q("Cert_Status__c").isNotNull())
    is_term = ((date_from > cut) & terminated & q("Date_From__c").isNotNull()
               & q("Reason_for_Termination__c").isNotNull())
    kind = F.when(common & is_new, F.lit("new")).when(common & is_term, F.lit("terminated"))
    tagged = (g1.select(kind.alias("kind"), "country", "ctype", "Certificate_Type__c",
                        F.when(terminated, date_from).otherwise(first_issue).alias("event_date"),
                        F.when(terminated, q("Reason_for_Termination__c"))
                         .otherwise(q("Cert_Status__c")).alias("status"))
              .where(F.col("kind").isNotNull()))
    out = (tagged.groupBy("kind", "country", "event_date", "ctype", "status",
                          "Certificate_Type__c")
           .agg(F.count(F.lit(1)).alias("certificates"))
           .select("kind", "certificates", "country", "event_date", "ctype", "status",
                   "Certificate_Type__c"))
    return snapshot_stamp(out, snapshot_date)


def _daily_cert(certificate: DataFrame, recordtype: DataFrame, categories,
                as_of: DateLike) -> DataFrame:
    cert = certificate_filter(certificate, specs.ACTIVE_STATUSES).where(
        currently_valid("Date_To__c", as_of))
    return _categorised(cert, recordtype, categories)


def daily_certificate_numbers(certificate: DataFrame, recordtype: DataFrame,
                              as_of: DateLike = None,
                              snapshot_date: DateLike = None) -> DataFrame:
    cert = _daily_cert(certificate, recordtype, specs.CATEGORIES, as_of)
    out = cert.groupBy(F.col("ctype").alias("Certificate Category")).agg(
        F.count(F.lit(1)).alias("Number Of Certificates"),
        bigint_half_even(exact_sum(safe_double(q("Number_of_Sites__c")))).alias(
            "Number Of Companies"))
    return snapshot_stamp(out, snapshot_date)


def daily_forest_areas(certificate: DataFrame, recordtype: DataFrame,
                       as_of: DateLike = None,
                       snapshot_date: DateLike = None) -> DataFrame:
    """Certificates and area per forest type (NULL type is its own group),
    plus a 'Total' row re-aggregated from the per-type rows. On empty input
    the Total row is ('Total', NULL, NULL)."""
    cert = _daily_cert(certificate, recordtype, specs.FOREST_CATEGORIES, as_of)
    per_type = cert.groupBy(q("Forest_Type__c").alias("Forest Type")).agg(
        F.count(F.lit(1)).alias("Number Of Certificates"),
        bigint_half_even(exact_sum(safe_double(q("Forest_Area_Total__c")))).alias(
            "Certified Forest Area"))
    total = per_type.agg(
        F.lit(specs.TOTAL_LABEL).alias("Forest Type"),
        F.sum("Number Of Certificates").alias("Number Of Certificates"),
        F.sum("Certified Forest Area").alias("Certified Forest Area"))
    return snapshot_stamp(per_type.unionByName(total), snapshot_date)


def daily_headline(non_certificate_holder: DataFrame, account: DataFrame,
                   as_of: DateLike = None, snapshot_date: DateLike = None,
                   member_record_type: str = specs.MEMBER_RECORD_TYPE) -> DataFrame:
    """One row: promotional licenses with a contract ending after ``as_of``
    (strict), member accounts, distinct member countries."""
    promo = (non_certificate_holder
             .where(safe_date(q("Contract_end_date__c")) > _date_lit(as_of))
             .agg(F.count(F.lit(1)).alias("n")))
    out = (account.where(q("RecordTypeId") == member_record_type)
           .agg(F.count(F.lit(1)).alias("Members"),
                F.count_distinct(q("Country__c")).alias("Member Countries"))
           .select(promo.scalar().alias("Promotional license"),
                   "Members", "Member Countries"))
    return snapshot_stamp(out, snapshot_date)


def members(account: DataFrame, country_data: DataFrame, regions: DataFrame,
            snapshot_date: DateLike = None,
            member_record_type: str = specs.MEMBER_RECORD_TYPE) -> DataFrame:
    """Member accounts with country and region; unmatched countries or ISO3
    codes drop out (inner joins, exact-case codes)."""
    m = (account.where(q("RecordTypeId") == member_record_type)
         .select(q("Sub_Chamber__c").alias("Sub_Chamber"),
                 q("Member_Type__c").alias("Member_Type"),
                 q("Website").alias("Website"), q("Name").alias("Member"),
                 q("Chamber__c").alias("Chamber"), q("Country__c").alias("_country_id")))
    cd = country_data.select(q("Id").alias("_cd_id"), q("Name").alias("Country"),
                             q("Country_code__c").alias("_iso3"))
    r = regions.select(q("ISO3").alias("_r_iso3"), q("Region").alias("Region"),
                       q("Functional_region").alias("region_fun"))
    out = (m.join(cd, F.col("_country_id") == F.col("_cd_id"), "inner")
            .join(r, F.col("_iso3") == F.col("_r_iso3"), "inner")
            .select("Sub_Chamber", "Member_Type", "Country", "Website", "Member",
                    "Chamber", "Region", "region_fun"))
    return snapshot_stamp(out, snapshot_date)
