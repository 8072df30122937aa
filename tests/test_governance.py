"""Selection, gate, decisions, outputs, sheets and streaming on small tables."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tidecast.operators import gate, governance, outputs, scoring, selection
from tidecast.plans.config import dim_technique
from tidecast.sources import registry, sheets
from tidecast.streaming import ingest


def test_greedy_keeps_the_strongest_of_alike(spark):
    ranked = spark.createDataFrame([("s", "a", 0.9), ("s", "b", 0.8), ("s", "c", 0.7), ("s", "d", None)], "series_id string, name string, strength double")
    pairs = spark.createDataFrame([("s", "a", "b", -0.95), ("s", "a", "c", 0.1), ("s", "b", "c", 0.99), ("s", "a", "d", None)], "series_id string, a string, b string, corr double")
    got = {r["name"]: r.kept for r in selection.greedy_redundancy(ranked, pairs).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": True}


def test_exchange_rate_net(spark):
    final = spark.createDataFrame([("s", "USD rate", "selected"), ("t", "coal", "selected")], "series_id string, name string, origin string")
    candidates = spark.createDataFrame([("s", "coal", 0.4), ("s", "gas", 0.6), ("s", "USD rate", 0.9), ("t", "gas", 0.5)], "series_id string, name string, strength double")
    assert {(r.series_id, r["name"], r.origin) for r in selection.exchange_rate_net(final, candidates).collect()} == {("s", "USD rate", "selected"), ("t", "coal", "selected"), ("s", "gas", "safety_net")}


def test_permutation_p_value(spark):
    real = spark.createDataFrame([("s", "var", 5.0)], "series_id string, technique string, mape double")
    shuffled = spark.createDataFrame([("s", "var", i, 6.0 if i else 5.0) for i in range(30)], "series_id string, technique string, seed int, mape double")
    got = gate.permutation(real, shuffled).first()
    assert got.p_value == pytest.approx(2 / 31) and not got.permutation_passed
    assert gate.permutation(real, shuffled.where("seed > 0")).first().p_value == pytest.approx(1 / 30)


def _ranks(spark):
    rows = [("s", "arima", "short", 90.0, True, 1), ("s", "ets", "short", 80.0, True, 2), ("t", "arima", "short", 10.0, False, 1)]
    df = spark.createDataFrame(rows, "series_id string, technique string, horizon string, composite double, eligible boolean, rank int")
    more = {c: F.lit(91.0) for c in ("accuracy", "direction", "dynamism", "recency")} | {c: F.lit(0.0) for c in ("flat_penalty", "outlier_penalty", "bias_penalty", "mean_mpe")}
    return df.withColumns(more | {"display_name": F.upper("technique"), "tier": F.lit("HIGH"), "disqualified": ~F.col("eligible")})


def test_decisions(spark):
    best = scoring.recommend(_ranks(spark))
    reason = {r.series_id: r.key_reason for r in best.collect()}
    assert reason["s"].startswith("Highest composite score (90.0, HIGH) among 2 eligible techniques. Driven by strong MAPE accuracy (91.0%)") and reason["s"].endswith("Runner-up (ETS, 80.0) trails by 10.0 points.")
    assert reason["t"] == scoring.NO_TECHNIQUE
    ask = spark.createDataFrame([("s", "short", "ana", dt.datetime(2024, 1, 2))], "series_id string, horizon string, analyst string, ts timestamp")
    log = governance.confirm(governance.empty_log(spark), best, ask)
    change = spark.createDataFrame([("s", "short", "ets", "bo", "view", dt.datetime(2024, 2, 3))], "series_id string, horizon string, technique string, analyst string, justification string, ts timestamp")
    log = governance.override(log, dim_technique(spark), change)
    now = {r.series_id: (r.action, r.technique, r.status) for r in governance.current_decisions(log, best).collect()}
    assert now["s"] == ("Overridden", "ets", "Overridden by bo on 03-Feb-2024") and now["t"][0] == "Pending" and now["t"][1] is None
    for bad in (ask.withColumn("analyst", F.lit(" ")), ask.withColumn("series_id", F.lit("t"))):
        with pytest.raises(Exception, match="confirmation needs"):
            governance.confirm(governance.empty_log(spark), best, bad).collect()
    with pytest.raises(Exception, match="override needs"):
        governance.override(log, dim_technique(spark), change.withColumn("technique", F.lit("magic"))).collect()


def test_selection_history_replaces_a_cycle(spark):
    regions = spark.createDataFrame([("s", "EU")], "series_id string, region string")
    made = spark.createDataFrame([("s", "short", "arima", "Confirmed", "ana")], "series_id string, horizon string, technique string, action string, analyst string")
    h = governance.record_selection(governance.empty_history(spark), made, regions, "2024-01", "2024-01-31")
    h = governance.record_selection(h, made.withColumn("technique", F.lit("ets")), regions, "2024-01", "2024-02-01")
    assert [(r.forecast_cycle, r.technique, r.region) for r in h.collect()] == [("2024-01", "ets", "EU")]
    assert governance.default_technique(h).first().technique == "ets"


def test_outputs(spark, tmp_path):
    df = spark.createDataFrame([("s", "short", 1.26), ("t", "short", 2.0)], "series_id string, horizon string, v double")
    path = outputs.write_stage(df, str(tmp_path), "summary", "review")
    outputs.write_stage(df.where("series_id = 's'").withColumn("v", F.lit(9.0)), str(tmp_path), "summary", "review")
    assert {(r.series_id, r.v) for r in spark.read.parquet(path).collect()} == {("s", 9.0), ("t", 2.0)}
    outputs.write_output(df, df, str(tmp_path), "final", "r1")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        outputs.write_output(df, df, str(tmp_path), "final", "r1")
    assert outputs.display_rounded(df).first().v == 1.3
    with pytest.raises(ValueError):
        outputs.write_stage(df, str(tmp_path), "x", "draft")


def workbook(rows) -> bytes:
    def cell(r, c, v):
        ref = f"{'ABCDEFG'[c]}{r}"
        if isinstance(v, dt.date):
            return f'<c r="{ref}" s="1"><v>{(v - dt.date(1899, 12, 30)).days}</v></c>'
        if isinstance(v, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        return "" if v is None else f'<c r="{ref}"><v>{v}</v></c>'

    body = "".join(f'<row r="{i}">{"".join(cell(i, c, v) for c, v in enumerate(r))}</row>' for i, r in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    parts = {
        "xl/workbook.xml": f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Data" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def test_sheets(spark, tmp_path):
    rows = [["Price sheet", None], ["Date", "Price", "Gas"], [dt.date(2020, 1, 1), "1,200.5", 3], ["Feb-20", 1300, None], ["2020-03-01", "n/a", 5]]
    (tmp_path / "acid.xlsx").write_bytes(workbook(rows))
    (tmp_path / "~$acid.xlsx").write_bytes(b"")
    cells = sheets.read_xlsx(spark, f"{tmp_path}/*.xlsx")
    assert sheets.header_rows(cells).first().header_rows == 2
    prices, drivers = sheets.price_and_drivers(cells)
    assert [(r.series_id, str(r.ds), r.price) for r in prices.orderBy("ds").collect()] == [("acid", "2020-01-01", 1200.5), ("acid", "2020-02-01", 1300.0), ("acid", "2020-03-01", None)]
    assert [r.raw for r in drivers.orderBy("ds").collect()] == [3.0, 5.0]


def test_vintage_sheet(spark, tmp_path):
    rows = [["note"], ["Month", dt.date(2024, 1, 1), dt.date(2024, 2, 1)], [dt.date(2023, 12, 1), 9, 9], [dt.date(2024, 1, 1), 10, 11], [dt.date(2024, 2, 1), 12, 13]]
    (tmp_path / "acid.xlsx").write_bytes(workbook(rows))
    got = sheets.vintage_cells(sheets.read_xlsx(spark, f"{tmp_path}/acid.xlsx"))
    assert {(str(r.vintage), str(r.target), r.value) for r in got.collect()} >= {("2024-01-01", "2024-02-01", 12.0), ("2024-02-01", "2023-12-01", 9.0)}


def test_registry(spark):
    good = {"id": "a", "display_name": "A", "frequency": "monthly", "start_period": "2020-01", "drivers_status": "candidates"}
    assert registry.dim_series(spark, [good]).count() == 1
    with pytest.raises(ValueError, match="frequency"):
        registry.dim_series(spark, [good | {"frequency": "daily"}])
    catalog = {"series_id": "a", "must_include_drivers": "ALL", "candidate_drivers": [{"column": 3, "label": "Gas", "unit": "EUR"}, {"column": 4, "label": "Gas ", "unit": "USD"}, {"column": 5, "label": "Gas", "unit": "USD"}]}
    assert sorted(r["name"] for r in registry.dim_driver(spark, [catalog]).collect()) == ["Gas", "Gas_USD", "Gas_col5"]


def test_stream_upserts(spark, tmp_path):
    schema = "series_id string, ds date, price double, sent_at timestamp"
    for i, rows in enumerate([[("s", dt.date(2024, 1, 1), 1.0, dt.datetime(2024, 1, 2)), ("t", dt.date(2024, 1, 1), 5.0, dt.datetime(2024, 1, 2))], [("s", dt.date(2024, 1, 1), 2.0, dt.datetime(2024, 1, 3)), ("s", dt.date(2024, 2, 1), 3.0, dt.datetime(2024, 2, 2))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.ingest(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/table", f"{tmp_path}/check").awaitTermination()
        del i
    got = {(r.series_id, str(r.ds), r.price) for r in spark.read.parquet(f"{tmp_path}/table").collect()}
    assert got == {("s", "2024-01-01", 2.0), ("s", "2024-02-01", 3.0), ("t", "2024-01-01", 5.0)}
