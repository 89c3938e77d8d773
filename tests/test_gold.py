"""Gold metrics on hand-made CRM-shaped frames (edge rows of FIXTURES.md §4)."""

import datetime as dt

import pytest

from auric.plans import gold
from auric.specs import MEMBER_RECORD_TYPE

AS_OF = "2025-06-30"
SNAP = "2025-07-01"
CERT_COLS = ("Id string, Cert_Status__c string, CB__c string, RecordTypeId string, "
             "Date_To__c string, Date_From__c string, First_Issue_Date__c string, "
             "Certificate_Type__c string, Reason_for_Termination__c string, "
             "Forest_Area_Total__c string, Forest_Type__c string, Number_of_Sites__c string, "
             "Boreal_Forests__c string, Community_Forestry__c string, Plantations__c string, "
             "Temperate_Forests__c string, Tropical_Forests__c string, "
             "Management_for_NTFP_and_Services__c string")


def cert(id_, status="Issued", cb="CB1", rt="rt_fm", to="2025-06-30", frm="2020-01-01",
         first="2020-01-01", ctype_="T1", reason=None, area="10", ftype="Boreal", sites="1"):
    return (id_, status, cb, rt, to, frm, first, ctype_, reason, area, ftype, sites,
            "1", "2", None, "3", "4", "5")


@pytest.fixture()
def frames(spark):
    certs = [
        cert("c1"),                                     # valid on the as-of day
        cert("c2", to="2025-06-29"),                    # one day before: dropped
        cert("c3", cb=None),                            # NULL CB: dropped by NOT IN
        cert("c4", cb="ASI"),
        cert("c5", status="Suspended"),
        cert("c6", status="Terminated", frm="2019-01-01", reason="R1"),  # cut-off strict
        cert("c7", status="Terminated", frm="2019-01-02", reason="R1"),
        cert("c8", rt="rt_coc", area="10", first="2019-01-01"),
        cert("c9", rt="rt_coc", area="12abc", sites="2.5"),
        cert("c10", rt="rt_other"),
        cert("c11", ftype=None, area="0.5", sites="0.5"),
        cert("c12", to="junk"),
        cert("c13", area="10"),                         # equal area in one country
    ]
    certificate = spark.createDataFrame(certs, CERT_COLS)
    recordtype = spark.createDataFrame([("rt_fm", "FM"), ("rt_coc", "COC"),
                                        ("rt_other", "Other")], "Id string, Name string")
    en = "COC - Group Member – Legal Entity"
    accounts = [
        # Id, Name, Type, Cert_rel, Country, RecordTypeId, Website, Sub, Mtype, Chamber
        ("a1", "Zeta", "COC - Site", "c1", "n1", None, None, None, None, None),
        ("a2", "Alpha", "FM - Single Certificate", "c1", "n2", None, None, None, None, None),
        ("a3", "Beta", en, "c8", "n1", None, None, None, None, None),
        ("a4", "Gamma", en.replace("–", "-"), "c9", "n1", None, None, None, None, None),
        ("a5", "Delta", "COC - Site", "c9", "n1", None, None, None, None, None),
        ("a6", "Eps", "FM - Group Manager", "c6", "n1", None, None, None, None, None),
        ("a7", "Eta", "FM - Group Manager", "c7", "n1", None, None, None, None, None),
        ("a8", "Theta", "COC - Site", "c11", "n9", None, None, None, None, None),
        ("a9", "Iota", "COC - Site", "c13", "n1", None, None, None, None, None),
        ("a10", "Kappa", "COC - Site", "c5", "n1", None, None, None, None, None),
        ("m1", "Member1", None, None, "n1", MEMBER_RECORD_TYPE, "w1", "N", "Org", "Eco"),
        ("m2", "Member2", None, None, "n1", MEMBER_RECORD_TYPE, "w2", "S", "Ind", "Env"),
        ("m3", "Member3", None, None, "n2", MEMBER_RECORD_TYPE, "w3", "S", "Ind", "Soc"),
        ("m4", "Member4", None, None, "n3", MEMBER_RECORD_TYPE, "w4", "S", "Ind", "Soc"),
    ]
    account = spark.createDataFrame(
        accounts, "Id string, Name string, Type string, Certificate_Relation__c string, "
                  "Country__c string, RecordTypeId string, Website string, "
                  "Sub_Chamber__c string, Member_Type__c string, Chamber__c string")
    country = spark.createDataFrame([("n1", "Norway", "NOR"), ("n2", "Peru", "per"),
                                     ("n3", "Chad", "TCD")],
                                    "Id string, Name string, Country_code__c string")
    regions = spark.createDataFrame([("NOR", "Europe", "Europe"), ("PER", "Americas", "LatAm"),
                                     ("TCD", "-", "-")],
                                    "ISO3 string, Region string, Functional_region string")
    nch = spark.createDataFrame([("p1", "2025-06-30"), ("p2", "2025-07-01"), ("p3", None),
                                 ("p4", "bad")], "Id string, Contract_end_date__c string")
    return dict(certificate=certificate, recordtype=recordtype, account=account,
                country=country, regions=regions, nch=nch)


def g1(f):
    return gold.certificate_account_country(f["account"], f["country"], f["certificate"],
                                            f["recordtype"])


def test_g1_filters_and_en_dash(frames):
    out = g1(frames)
    pairs = sorted((r.cert_rel, r.company) for r in out.collect())
    # hyphen variant of the en-dash type (a4) drops; unmatched country n9 drops
    assert ("c9", "Gamma") not in pairs and ("c9", "Delta") in pairs
    assert ("c8", "Beta") in pairs
    assert not any(c in ("c3", "c4", "c10", "c11") for c, _ in pairs)
    assert len(out.columns) == 19


def test_holder_preference(frames):
    out = gold.holder_preference_dedup(g1(frames))
    by_cert = {r.cert_rel: r.company for r in out.collect()}
    assert by_cert["c1"] == "Alpha"          # holder type wins over 'COC - Site'
    assert out.count() == out.select("cert_rel").distinct().count()


def test_coc_and_baseline(frames):
    g2 = gold.holder_preference_dedup(g1(frames))
    coc = gold.coc_per_country(g2, "2019-01-01", SNAP).collect()
    assert [(r.country, r.certificates) for r in coc] == [("Norway", 2)]
    assert coc[0].snapshot_date == dt.date(2025, 7, 1)
    base = {(r.ctype, r.country): r for r in gold.baseline_certification(g2, AS_OF, SNAP)
            .collect()}
    # c1 (valid on as-of day) and c13; c2 expired; c5 suspended
    assert base[("FM", "Peru")].certificates == 1
    assert base[("FM", "Norway")].certificates == 1
    assert base[("FM", "Norway")].plantations is None     # all-NULL sum stays NULL


def test_fm_per_country_distinct_area(spark, frames):
    g2 = gold.holder_preference_dedup(g1(frames))
    out = {r.country: r for r in gold.fm_per_country(g2, "2019-01-01", SNAP).collect()}
    # Norway: c13 area 10, c8 area 10 (COC not in FM list), c6/c7 terminated -> filtered
    assert out["Norway"].certificates == 1 and out["Norway"].forest_area == 10.0
    assert out["Peru"].forest_area == 10.0


def test_issued_vs_terminations_cutoff(frames):
    out = gold.issued_vs_terminations(g1(frames), SNAP).collect()
    terms = [r for r in out if r.kind == "terminated"]
    assert [(r.event_date, r.status) for r in terms] == [(dt.date(2019, 1, 2), "R1")]
    assert all(r.event_date > dt.date(2019, 1, 1) for r in out)


def test_daily_numbers_half_even(frames):
    out = {r["Certificate Category"]: r for r in gold.daily_certificate_numbers(
        frames["certificate"], frames["recordtype"], "2019-01-01", SNAP).collect()}
    # COC: c8 (1) + c9 (2.5) = 3.5 -> 4 ; FM sites are whole numbers plus c11's 0.5
    assert out["COC"]["Number Of Companies"] == 4
    assert out["COC"]["Number Of Certificates"] == 2


def test_daily_forest_areas_total(spark, frames):
    out = gold.daily_forest_areas(frames["certificate"], frames["recordtype"], AS_OF, SNAP)
    got = {r["Forest Type"]: (r["Number Of Certificates"], r["Certified Forest Area"])
           for r in out.collect()}
    parts = [v for k, v in got.items() if k != "Total"]
    assert got["Total"] == (sum(p[0] for p in parts), sum(p[1] for p in parts))
    assert None in got                       # NULL forest type is its own group
    empty = gold.daily_forest_areas(frames["certificate"].limit(0), frames["recordtype"],
                                    AS_OF, SNAP).collect()
    assert [(r["Forest Type"], r["Number Of Certificates"]) for r in empty] == [("Total", None)]


def test_headline_and_members(frames):
    h = gold.daily_headline(frames["nch"], frames["account"], AS_OF, SNAP).first()
    assert (h["Promotional license"], h["Members"], h["Member Countries"]) == (1, 4, 3)
    m = gold.members(frames["account"], frames["country"], frames["regions"], SNAP)
    got = sorted((r.Member, r.Region) for r in m.collect())
    # m3's ISO3 is lower case: no match; m4's region is '-'
    assert got == [("Member1", "Europe"), ("Member2", "Europe"), ("Member4", "-")]
    assert m.columns == ["Sub_Chamber", "Member_Type", "Country", "Website", "Member",
                         "Chamber", "Region", "region_fun", "snapshot_date"]


def test_forest_type_named_total(spark, frames):
    """A forest type literally called 'Total' stays its own row next to the
    computed Total (union all, as in the original model)."""
    certs = frames["certificate"].union(spark.createDataFrame([cert("t1", ftype="Total")],
                                                              CERT_COLS))
    out = gold.daily_forest_areas(certs, frames["recordtype"], AS_OF, SNAP).collect()
    totals = [r for r in out if r["Forest Type"] == "Total"]
    assert len(totals) == 2
