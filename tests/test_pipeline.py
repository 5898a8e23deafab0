from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import INVENTORY, ORDERS_20251025, ORDERS_20251026, PRODUCTS, write_files
from ordermill.plans import pipeline
from ordermill.sinks import files


def _files(root):
    out = []
    for dirpath, _, names in os.walk(root):
        out += [os.path.join(dirpath, n) for n in names if not n.startswith((".", "_"))]
    return sorted(out)


def test_write_parquet_partition_replaces_only_its_day(spark, tmp_path):
    out = str(tmp_path / "processed")
    day1 = spark.createDataFrame([(1, "x", "2025-10-25")], "a long, b string, date string")
    day2 = spark.createDataFrame([(2, "y", "2025-10-26")], "a long, b string, date string")
    files.write_parquet_partition(day1, out)
    files.write_parquet_partition(day2, out)
    files.write_parquet_partition(day1.withColumn("a", F.lit(9).cast("long")), out)
    back = spark.read.parquet(out).selectExpr("a", "b", "CAST(date AS STRING) AS date")
    got = sorted(tuple(r) for r in back.collect())
    assert got == [(2, "y", "2025-10-26"), (9, "x", "2025-10-25")]
    assert os.path.isdir(f"{out}/date=2025-10-25")


def test_summary_and_bad_rows_writers(spark, tmp_path):
    summary = spark.createDataFrame([("2025-10-25", 2, 100.0)], "date string, rows long, revenue double")
    s = files.write_summaries(summary, str(tmp_path / "summaries"))
    assert os.path.isdir(f"{s}/date=2025-10-25")
    bad = spark.createDataFrame([(1, "x")], "col long, _error string")
    b = files.write_bad_rows(bad, str(tmp_path / "bad_rows"), "orders", "2025-10-25")
    assert b and os.path.isdir(f"{b}/date=2025-10-25")
    assert files.write_bad_rows(bad.where("col > 5"), str(tmp_path / "none"), "orders") is None
    assert files.write_bad_rows(None, str(tmp_path / "none"), "orders") is None
    assert not (tmp_path / "none").exists()


def test_summary_without_date_goes_to_run(spark, tmp_path):
    summary = spark.createDataFrame([(None, 1)], "date string, rows long")
    files.write_summaries(summary, str(tmp_path / "s"))
    assert (tmp_path / "s" / "date=run").is_dir()


def test_dry_run_writes_nothing(spark, data_dir, tmp_path):
    out = tmp_path / "output"
    s = pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, data_dir), str(out), dry_run=True)
    assert s["date"] == "20251025" and s["rows"] == 3 and s["revenue"] == pytest.approx(248.48)
    assert s["parquet_path"] is None
    assert not out.exists()


def test_write_run(spark, data_dir, tmp_path):
    out = tmp_path / "output"
    s = pipeline.run_for_date(spark, "20251026", pipeline.csv_inputs(spark, data_dir), str(out))
    assert (s["rows"], s["revenue"], s["bad_rows"]) == (2, 139.96, 0)
    assert s["parquet_path"].endswith("processed/date=2025-10-26") and os.path.isdir(s["parquet_path"])
    summaries = [p for p in _files(out / "summaries") if p.endswith(".json")]
    assert summaries and "date=2025-10-26" in summaries[0]
    content = json.loads(open(summaries[0]).read().splitlines()[0])
    assert content == {"run_date": "20251026", "rows": 2, "revenue": 139.96}
    processed = spark.read.parquet(str(out / "processed"))
    assert processed.count() == 2
    assert set(processed.columns) >= {"order_total", "product_name", "category", "product_price",
                                      "order_date_iso", "date"}
    assert not (out / "bad_rows" / "dataset=orders").exists()


def test_rerun_is_idempotent(spark, data_dir, tmp_path):
    out = str(tmp_path / "output")
    inputs = pipeline.csv_inputs(spark, data_dir)
    pipeline.run_for_date(spark, "20251025", inputs, out)
    pipeline.run_for_date(spark, "20251026", inputs, out)
    first = sorted(tuple(r) for r in spark.read.parquet(f"{out}/processed").collect())
    pipeline.run_for_date(spark, "20251025", inputs, out)
    again = sorted(tuple(r) for r in spark.read.parquet(f"{out}/processed").collect())
    assert first == again and len(first) == 5


def test_bad_rows_and_mixed_dates(spark, tmp_path):
    text = ORDERS_20251025 + (
        "50010,2025-10-24,1001,1,1.00,1,completed\n"     # other day: rejected, its partition untouched
        "50011,not a date,1001,1,1.00,1,completed\n"     # parse reject
        "50012,10/25/2025,1001,abc,1.00,,\n"              # recovered date, bad qty
        "50013,2025-10-25,1001,1,N/A,1,completed\n")      # pandas null token → required price missing
    data = write_files(tmp_path / "d", {"order_20251025.csv": text, "products.csv": PRODUCTS})
    out = tmp_path / "o"
    s = pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, data), str(out))
    assert (s["rows"], s["bad_rows"]) == (3, 4)
    bad = spark.read.option("header", True).csv(str(out / "bad_rows" / "dataset=orders"))
    errs = {r["order_id"]: (r["_parse_error"], r["_error"]) for r in bad.collect()}
    assert errs["50010"] == (None, "order_date: outside run date 2025-10-25")
    assert errs["50011"] == ("Flexible parsing also failed", None)
    assert errs["50012"] == (None, "qty: value is not a valid integer")
    assert errs["50013"] == (None, "unit_price: field required")
    assert [p.name for p in (out / "processed").iterdir() if p.name.startswith("date=")] == ["date=2025-10-25"]


def test_no_valid_rows(spark, tmp_path):
    text = "order_id,order_date,product_id,qty,unit_price,user_id,order_status\n1,2025-10-27,1001,-1,1,1,x\n"
    data = write_files(tmp_path / "d", {"order_20251027.csv": text, "products.csv": PRODUCTS})
    out = tmp_path / "o"
    s = pipeline.run_for_date(spark, "20251027", pipeline.csv_inputs(spark, data), str(out))
    assert (s["rows"], s["revenue"], s["bad_rows"], s["parquet_path"]) == (0, 0.0, 1, None)
    assert not (out / "processed").exists() and not (out / "summaries").exists()
    assert (out / "bad_rows" / "dataset=orders").exists()


def test_missing_order_file_raises(spark, data_dir):
    with pytest.raises(FileNotFoundError):
        pipeline.run_for_date(spark, "20251101", pipeline.csv_inputs(spark, data_dir), dry_run=True)


def test_order_file_name_is_case_insensitive(spark, tmp_path):
    data = write_files(tmp_path / "d", {"ORDERS-20251025.csv": ORDERS_20251025, "products.csv": PRODUCTS,
                                        "notes_20251025.csv": "order_id\n1\n"})
    s = pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, data), dry_run=True)
    assert s["rows"] == 3 and s["bad_rows"] == 0


def test_backfill_range(spark, data_dir, tmp_path):
    inputs = pipeline.csv_inputs(spark, data_dir)
    out = str(tmp_path / "o")
    rep = pipeline.backfill(spark, "20251024", "2025-10-26", inputs, out)
    rows = {r["date"]: (r["rows"], r["revenue"], r["bad_rows"], r["status"]) for r in rep.collect()}
    assert rows == {"2025-10-24": (None, None, None, "missing"),
                    "2025-10-25": (3, 248.48, 0, "ok"),
                    "2025-10-26": (2, 139.96, 0, "ok")}
    # one job over the range = the per-day runs
    per_day = sorted(tuple(r) for r in spark.read.parquet(f"{out}/processed").drop("_date_recovered").collect())
    out2 = str(tmp_path / "o2")
    for d in ("20251025", "20251026"):
        pipeline.run_for_date(spark, d, inputs, out2)
    assert per_day == sorted(tuple(r) for r in spark.read.parquet(f"{out2}/processed")
                             .drop("_date_recovered").collect())


def test_backfill_dry_run_without_any_file(spark, tmp_path):
    data = write_files(tmp_path / "d", {"products.csv": PRODUCTS, "inventory.csv": INVENTORY})
    rep = pipeline.backfill(spark, "20251001", "20251002", pipeline.csv_inputs(spark, data), dry_run=True)
    assert [r["status"] for r in rep.orderBy("date").collect()] == ["missing", "missing"]


def test_single_pass_bad_rows_equal_two_channel_union(spark, data_dir, tmp_path):
    from ordermill.operators import validate as V
    from ordermill.schemas import ORDERS
    text = ORDERS_20251026 + "7,bad,1001,1,1,1,x\n8,2025-10-26,1001,-4,1,1,x\n"
    data = write_files(tmp_path / "d", {"order_20251026.csv": text})
    raw = pipeline.csv_inputs(spark, data).orders(None)
    single = pipeline.bad_orders(pipeline.tag_orders(raw)).select("order_id", V.PARSE_ERROR, V.ERROR)
    pg, pb = V.parse_date_column(raw, "order_date")
    _, vb = V.validate_dataframe(pg.drop(V.RECOVERED), ORDERS)
    union = V.union_bad(pb, vb).select("order_id", V.PARSE_ERROR, V.ERROR)
    assert sorted(map(tuple, single.collect())) == sorted(map(tuple, union.collect()))


def test_duplicate_product_stops_the_run(spark, data_dir, tmp_path):
    from conftest import PRODUCTS as P
    data = write_files(tmp_path / "d", {"order_20251025.csv": ORDERS_20251025,
                                        "products.csv": P + '1001,"Tee again",Apparel,1.00\n'})
    out = tmp_path / "o"
    with pytest.raises(ValueError, match="duplicate"):
        pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, data), str(out))
    assert not (out / "processed").exists()
    with pytest.raises(ValueError, match="duplicate"):
        pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, data), dry_run=True)


def test_backfill_records_failing_days_and_goes_on(spark, data_dir, tmp_path):
    """One day of three cannot be read: the others are processed, in both modes."""
    inputs = pipeline.csv_inputs(spark, data_dir)

    def orders(days):
        raw = inputs.orders(days)
        boom = F.when(F.col("_file_day") == "20251026", F.raise_error(F.lit("cannot read this file")).cast("string"))
        return raw.withColumn("qty", F.coalesce(boom, F.col("qty")))

    broken = pipeline.Inputs(orders, inputs.products)
    want = {"2025-10-24": ("missing", None), "2025-10-25": ("ok", 3), "2025-10-26": ("error", None)}
    out = str(tmp_path / "o")
    for dry in (True, False):
        rep = pipeline.backfill(spark, "20251024", "20251026", broken, None if dry else out, dry_run=dry).collect()
        assert {r["date"]: (r["status"], r["rows"]) for r in rep} == want
        assert "cannot read this file" in next(r["error"] for r in rep if r["status"] == "error")
    assert {str(r["date"]) for r in spark.read.parquet(f"{out}/processed").collect()} == {"2025-10-25"}


def test_backfill_reports_products_that_cannot_be_joined(spark, data_dir, tmp_path):
    inputs = pipeline.csv_inputs(spark, data_dir)
    twice = pipeline.Inputs(inputs.orders, lambda: inputs.products().unionByName(inputs.products()))
    none = pipeline.csv_inputs(spark, write_files(tmp_path / "d", {"order_20251025.csv": ORDERS_20251025}))
    for products, text in ((twice, "many-to-one"), (none, "no products file")):
        for dry in (True, False):
            rep = pipeline.backfill(spark, "20251024", "20251025", products, str(tmp_path / "o"), dry_run=dry).collect()
            assert [(r["status"]) for r in sorted(rep)] == ["missing", "error"]
            assert text in next(r["error"] for r in rep if r["status"] == "error")
    assert not (tmp_path / "o" / "processed").exists()


def test_rerun_of_a_corrected_day_leaves_nothing_stale(spark, tmp_path):
    head = "order_id,order_date,product_id,qty,unit_price,user_id,order_status\n"
    good, bad = "1,2025-10-25,1001,1,1.00,1,completed\n", "2,2025-10-25,1001,-1,1.00,1,completed\n"
    out = tmp_path / "o"
    for text, kept in ((good + bad, (True, True)), (good, (True, False)), (bad, (False, True)), (good, (True, False))):
        data = write_files(tmp_path / "d", {"order_20251025.csv": head + text, "products.csv": PRODUCTS})
        for run in (lambda: pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, data), str(out)),
                    lambda: pipeline.backfill(spark, "20251025", "20251026", pipeline.csv_inputs(spark, data), str(out))):
            run()
            assert (out / "processed" / "date=2025-10-25").exists() == kept[0]
            assert (out / "summaries" / "date=2025-10-25").exists() == kept[0]
            assert (out / "bad_rows" / "dataset=orders" / "date=2025-10-25").exists() == kept[1]


def test_dry_run_equals_write_run_on_malformed_lines(spark, tmp_path):
    text = ("order_status,order_id,order_date,product_id,qty,unit_price,user_id,extra\n"
            "completed,1,2025-10-25,1001,1,10.00,7,a\n"
            "completed,2,2025-10-25,1001,1\n"
            "completed,3,2025-10-25,1001,1,10.00,7,a,b,c\n"
            '"com""pleted, x",4,2025-10-25,1002,1,10.00,7,"q, r"\n')
    data = write_files(tmp_path / "d", {"order_20251025.csv": text, "products.csv": PRODUCTS})
    inputs = pipeline.csv_inputs(spark, data)
    runs = [pipeline.run_for_date(spark, "20251025", inputs, dry_run=True),
            pipeline.run_for_date(spark, "20251025", inputs, str(tmp_path / "o"))]
    for days in (True, False):
        rep = pipeline.backfill(spark, "20251025", "20251026", inputs, str(tmp_path / "b"), dry_run=days).collect()
        runs.append(next(r.asDict() for r in rep if r["rows"] is not None))
    assert {(r["rows"], r["revenue"], r["bad_rows"]) for r in runs} == {(2, 20.0, 2)}


def test_backfill_windows_give_the_same_outputs(spark, data_dir, tmp_path):
    inputs = pipeline.csv_inputs(spark, data_dir)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    rep_a = pipeline.backfill(spark, "20251024", "20251027", inputs, a, window_days=31)
    rep_b = pipeline.backfill(spark, "20251024", "20251027", inputs, b, window_days=1)
    assert sorted(map(tuple, rep_a.collect())) == sorted(map(tuple, rep_b.collect()))
    read = lambda p: sorted(map(tuple, spark.read.parquet(f"{p}/processed").collect()))
    assert read(a) == read(b)


def test_command_line(spark, data_dir, tmp_path, capsys):
    from ordermill.__main__ import main
    main(["--start-date", "2025-10-25", "--data-dir", data_dir, "--dry-run"])
    one = json.loads(capsys.readouterr().out.strip())
    assert (one["date"], one["rows"], one["revenue"]) == ("20251025", 3, 248.48)
    main(["--start-date", "20251025", "--end-date", "20251026", "--data-dir", data_dir,
          "--output-dir", str(tmp_path / "o")])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [(x["date"], x["rows"], x["status"]) for x in lines] == [("2025-10-25", 3, "ok"), ("2025-10-26", 2, "ok")]


def test_command_line_reports_a_failing_day(spark, data_dir, capsys):
    from ordermill.__main__ import main
    main(["--start-date", "20251101", "--data-dir", data_dir, "--dry-run"])
    assert "No order file for 20251101" in json.loads(capsys.readouterr().out.strip())["error"]


def test_writing_runs_need_an_output_folder(spark, data_dir):
    inputs = pipeline.csv_inputs(spark, data_dir)
    with pytest.raises(ValueError, match="output_dir"):
        pipeline.run_for_date(spark, "20251025", inputs)
    with pytest.raises(ValueError, match="output_dir"):
        pipeline.backfill(spark, "20251025", "20251026", inputs)


def test_day_range():
    assert pipeline.day_range("2025-10-30", "20251102") == ["20251030", "20251031", "20251101", "20251102"]
    assert pipeline.day_range("20251025") == ["20251025"]
    with pytest.raises(ValueError):
        pipeline.day_range("20251026", "20251025")


def test_backfill_day_with_only_bad_rows(spark, data_dir, tmp_path):
    bad_day = "order_id,order_date,product_id,qty,unit_price,user_id,order_status\n9,2025-10-27,1001,-3,1,1,x\n"
    import shutil
    data = str(tmp_path / "d")
    shutil.copytree(data_dir, data)
    write_files(tmp_path / "d", {"order_20251027.csv": bad_day})
    rep = pipeline.backfill(spark, "20251026", "20251028", pipeline.csv_inputs(spark, data), dry_run=True)
    got = {r["date"]: (r["rows"], r["bad_rows"], r["status"]) for r in rep.collect()}
    assert got == {"2025-10-26": (2, 0, "ok"), "2025-10-27": (0, 1, "no_valid_rows"),
                   "2025-10-28": (None, None, "missing")}


def test_show_table_prints_rows(spark, capsys):
    df = spark.createDataFrame([("2025-10-25", 248.48)], "date string, revenue double")
    files.show_table(df, 5)
    out = capsys.readouterr().out
    assert "2025-10-25" in out and "248.48" in out
