"""Entity specs, naming, column listings, seeds."""

import pytest

from auric import specs
from auric.sources.catalog import describe_columns, has_column
from auric.sources.landed import load_seed


def test_configured_columns():
    by = {x.table: x for x in specs.entity_specs()}
    cols = by["certificate_c__c"].columns
    assert cols[0] == "Id" and "RecordTypeId" in cols and len(cols) == len(set(cols))
    assert cols.index("Name") < cols.index("RecordTypeId")   # listed before extras
    assert by["accounts"].columns is None                     # keep-all table
    assert by["recordtype"].columns == ("Id", "Name")


def test_entity_specs_and_names():
    s = specs.entity_specs()
    assert len(s) == 16
    by = {x.model: x for x in s}
    assert by["certificate_c"].table == "certificate_c__c"
    assert by["accounts"].pk == "accountid" and not by["accounts"].has_soft_delete
    assert by["accounts"].lag_seconds == 0 and by["account"].lag_seconds == 120
    assert by["account"].live_ids_table == "account__live_ids"
    assert specs.EntitySpec("species__c", "Id", "x").model == "species"
    assert "–" in specs.ACCOUNT_TYPES[4]                     # en-dash kept


def test_select_specs():
    s = specs.entity_specs()
    assert specs.select_specs(s) == s
    assert [x.table for x in specs.select_specs(s, ["SPECIES", "account"])] == \
        ["account", "species__c"]
    with pytest.raises(ValueError):
        specs.select_specs(s, ["nonesuch"])


def test_describe_and_has_column(spark):
    df = spark.createDataFrame([(1, "a")], "Id int, IsDeleted string")
    rows = describe_columns(spark, df).collect()
    assert [(r.column_name, r.data_type, r.ordinal_position) for r in rows] == \
        [("Id", "int", 1), ("IsDeleted", "string", 2)]
    assert has_column(df, "isdeleted") and not has_column(df, "other")


def test_load_seed(spark, tmp_root):
    path = f"{tmp_root}/seed"
    spark.createDataFrame([("NOR", "Europe", "Europe"), ("ATA", "-", "-")],
                          specs.REGIONS_SEED_SCHEMA).write.option("header", True).csv(path)
    seed = load_seed(spark, path, specs.REGIONS_SEED_SCHEMA)
    assert seed.columns == ["ISO3", "Region", "Functional_region"]
    assert sorted(r.ISO3 for r in seed.collect()) == ["ATA", "NOR"]


def test_described_types_decide_what_is_queryable(spark):
    from auric.sources.landed import select_queryable_columns
    df = spark.createDataFrame([("a", "b", "c", [1])], "Id string, Where__c string, "
                               "Body string, many array<int>")
    assert select_queryable_columns(df).columns == ["Id", "Where__c", "Body"]
    kinds = {"id": "id", "where__c": "location", "BODY": "base64"}
    assert select_queryable_columns(df, described=kinds).columns == ["Id"]
