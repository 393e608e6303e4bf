from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchledger.sources import landing
from touchledger.sources.feeds import LOADED_AT, RAW_FEEDS, dim_channel, feed_schema


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "hubspot_deal_stage_history.csv").write_text(
        'deal_id,dealstage,changed_at\n1,closedwon,2025-03-17T10:00:00Z\n2,"",\n3,"say ""hi"", ok", x \n')
    parts = tmp_path / "ga4_form_fills.csv"
    parts.mkdir()
    for i in range(3):
        (parts / f"part-{i}.csv").write_text(f"session_id,client_id,email,form_name,submitted_at\ns{i},c,e@x.io,f,\n")
    return str(tmp_path)


def test_every_export_becomes_a_text_table(spark, folder):
    stamp = datetime(2025, 1, 2, 3, 4, 5)
    landed = landing.land_raw(spark, folder, stamp)
    assert sorted(landed) == ["ga4_form_fills", "hubspot_deal_stage_history"]
    history = landed["hubspot_deal_stage_history"]
    assert dict(history.dtypes) == {"deal_id": "string", "dealstage": "string", "changed_at": "string",
                                    LOADED_AT: "timestamp"}
    got = sorted(tuple(r) for r in history.collect())
    # a quoted empty cell is an empty text, an unquoted one is no value
    assert got == [("1", "closedwon", "2025-03-17T10:00:00Z", stamp), ("2", "", None, stamp),
                   ("3", 'say "hi", ok', " x ", stamp)]


def test_manifest_counts_each_table_and_all(spark, folder):
    rows = {r["table"]: r["rows"] for r in landing.load_manifest(landing.land_raw(spark, folder)).collect()}
    assert rows == {"ga4_form_fills": 3, "hubspot_deal_stage_history": 3, "all": 6}


@pytest.mark.parametrize("line", ["4,5", "6,7,8,9"])
@pytest.mark.parametrize("multi_line", [True, False])
def test_a_short_or_long_row_stops_the_load(spark, tmp_path, line, multi_line):
    (tmp_path / "t.csv").write_text(f"x,y,z\n1,2,3\n{line}\n")
    landed = landing.land_raw(spark, str(tmp_path), multi_line=multi_line)["t"]
    with pytest.raises(Exception, match="MALFORMED"):
        landed.collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_part_with_another_header_stops_the_load(spark, tmp_path, multi_line):
    parts = tmp_path / "t.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("x,y,z\n1,2,3\n")
    (parts / "part-1.csv").write_text("y,x,z\n4,5,6\n")
    landed = landing.land_raw(spark, str(tmp_path), multi_line=multi_line)["t"]
    with pytest.raises(Exception, match="CSV header does not conform"):
        landed.collect()


def test_line_breaks_in_quoted_cells(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"two\nlines"\n')
    landed = landing.land_raw(spark, str(tmp_path))
    assert [tuple(r)[:2] for r in landed["t"].collect()] == [("1", "two\nlines")]


def test_parquet_lands_as_text(spark, tmp_path):
    spark.range(3).selectExpr("id", "id > 1 as flag").write.parquet(str(tmp_path / "t.parquet"))
    landed = landing.land_raw(spark, str(tmp_path), fmt="parquet", tables=["t"])["t"]
    assert [t for _, t in landed.dtypes] == ["string", "string", "timestamp"]
    assert sorted(tuple(r)[:2] for r in landed.collect()) == [("0", "false"), ("1", "false"), ("2", "true")]
    with pytest.raises(ValueError):
        landing.land_raw(spark, str(tmp_path), fmt="parquet")


def test_drift_compares_ordered_headers(spark, folder):
    landed = landing.land_raw(spark, folder)
    expected = {"hubspot_deal_stage_history": ["dealstage", "deal_id", "changed_at"],
                "ga4_form_fills": RAW_FEEDS["ga4_form_fills"]}
    action = {r["table"]: r["action"] for r in landing.schema_drift(spark, expected, landed).collect()}
    assert action == {"hubspot_deal_stage_history": "rebuild", "ga4_form_fills": "replace"}
    fresh = landing.schema_drift(spark, {}, landed).collect()
    assert {r["action"] for r in fresh} == {"create"} and {r["expected"] for r in fresh} == {None}


def test_second_load_replaces_the_first_and_reports_changed_headers(spark, folder, tmp_path):
    root = str(tmp_path / "store")
    actions = [{r["action"] for r in landing.refresh_raw(spark, landing.land_raw(spark, folder), root).collect()}
               for _ in range(2)]
    assert actions == [{"create"}, {"replace"}]
    assert landing.raw_table(spark, root, "ga4_form_fills").count() == 3
    broken = {"ga4_form_fills": landing.land_raw(spark, folder)["ga4_form_fills"].withColumn(
        "form_name", F.raise_error(F.lit("broken export")))}
    with pytest.raises(Exception, match="broken export"):
        landing.refresh_raw(spark, broken, root)
    assert landing.raw_table(spark, root, "ga4_form_fills").count() == 3
    changed = {"ga4_form_fills": landing.land_raw(spark, folder)["ga4_form_fills"].drop("form_name")}
    assert [r["action"] for r in landing.refresh_raw(spark, changed, root).collect()] == ["rebuild"]
    assert "form_name" not in landing.raw_table(spark, root, "ga4_form_fills").columns


def test_feed_schemas_and_channel_dimension(spark):
    assert len(RAW_FEEDS) == 15
    assert feed_schema("channel_incrementality").names[0] == "channel"
    assert all(f.dataType.simpleString() == "string" for f in feed_schema("hubspot_deals"))
    dim = dim_channel(spark)
    groups = {r["channel"]: (r["channel_group"], r["is_direct"]) for r in dim.collect()}
    assert len(groups) == 13 and groups["direct"] == ("direct", True) and groups["voice_agent"][0] == "gtm_system"
    assert landing.empty_feed(spark, RAW_FEEDS["adroll_daily"]).count() == 0
