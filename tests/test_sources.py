from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import write_files
from ordermill.operators import validate as V
from ordermill.plans import pipeline
from ordermill.schemas import PRODUCTS
from ordermill.sources import csv_files


def test_products_scan_is_all_string(spark, data_dir):
    df = csv_files.read_products(spark, data_dir)
    assert all(t == "string" for c, t in df.dtypes)
    assert df.count() == 4
    assert df.where("product_name = 'Noise-Cancelling Headphones'").count() == 1


def test_missing_products_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_files.read_products(spark, str(tmp_path))


def test_inventory_dates_parsed(spark, data_dir):
    good, bad = csv_files.read_inventory(spark, data_dir)
    assert good.count() == 4 and bad.count() == 0
    assert dict(good.dtypes)["last_restock_date"] == "timestamp_ntz"


def test_null_tokens(spark, tmp_path):
    text = "product_id,product_name,category,price\n1,a,NA,1\n2,b,null,2\n3,c,None,3\n4,d,,4\n5,e,Home,5\n"
    data = write_files(tmp_path / "d", {"products.csv": text})
    df = csv_files.read_products(spark, data)
    assert df.where("category IS NULL").count() == 4
    kept = csv_files.read_products(spark, data, tokens=())
    assert kept.where("category IS NULL").count() == 1


def test_malformed_lines_go_to_bad_rows(spark, tmp_path):
    text = "product_id,product_name,category,price\n1,a,x,1\n2,b\n3,c,x,3,extra\n"
    data = write_files(tmp_path / "d", {"products.csv": text})
    good, bad = V.validate_dataframe(csv_files.read_products(spark, data).cache(), PRODUCTS)
    assert [r["product_id"] for r in good.collect()] == [1]
    errs = {r["product_id"]: r["_error"] for r in bad.collect()}
    assert errs["2"].startswith("row: malformed CSV line")
    assert errs["3"].startswith("row: malformed CSV line")


def test_multi_day_scan_tags_file_day(spark, data_dir):
    df = csv_files.read_orders(spark, data_dir, ["20251025", "2025-10-26"])
    days = sorted({(r["_file_day"], r["_source_file"]) for r in df.collect()})
    assert days == [("20251025", "order_20251025.csv"), ("20251026", "order_20251026.csv")]
    assert csv_files.read_orders(spark, data_dir).count() == 5


def test_columns_are_bound_by_name_per_file(spark, tmp_path):
    head = "order_id,order_date,product_id,qty,unit_price,user_id,order_status"
    data = write_files(tmp_path / "d", {
        "order_20251025.csv": f"{head}\n1,2025-10-25,1001,2,1.50,7,completed\n",
        "order_20251026.csv": "qty,order_id,order_date,note,product_id,unit_price,order_status,user_id\n"
                              "3,2,2025-10-26,hi,1002,2.00,returned,8\n4,3,2025-10-26\n",
        "order_20251027.csv": "\ufefforder_id,order_date,product_id,unit_price\n4,2025-10-27,1001,1.00\n"})
    rows = {r["order_id"]: r for r in csv_files.read_orders(spark, data).collect()}
    assert (rows["1"]["qty"], rows["1"]["user_id"], rows["1"]["_corrupt_record"]) == ("2", "7", None)
    assert (rows["2"]["qty"], rows["2"]["product_id"], rows["2"]["order_status"]) == ("3", "1002", "returned")
    assert rows["3"]["_corrupt_record"] is not None and rows["4"]["qty"] is None and rows["4"]["_corrupt_record"] is None
    assert {r["_file_day"] for r in rows.values()} == {"20251025", "20251026", "20251027"}


def test_quoting(spark, tmp_path):
    text = ('product_id,product_name,category,price\n1,"19"" Monitor, black",IT,1\n2,"a ""b"" c",x,2\n'
            '3,"C:\\temp\\",x,3\n4,plain,x,4\n')
    data = write_files(tmp_path / "d", {"products.csv": text})
    good, bad = V.validate_dataframe(csv_files.read_products(spark, data), PRODUCTS)
    assert {r["product_id"]: r["product_name"] for r in good.collect()} == {
        1: '19" Monitor, black', 2: 'a "b" c', 3: "C:\\temp\\", 4: "plain"}
    assert bad.count() == 0
    lines = write_files(tmp_path / "e", {"products.csv": 'product_id,product_name,category,price\n1,"two\nlines",x,1\n'})
    whole = csv_files.read_table_csv(spark, f"{lines}/products.csv", PRODUCTS, multi_line=True)
    assert [r["product_name"] for r in whole.collect()] == ["two\nlines"]


def test_file_day_is_the_asked_day_or_the_first_date(spark, tmp_path):
    from conftest import ORDERS_20251025
    from ordermill.plans import pipeline

    data = write_files(tmp_path / "d", {"store00012345_order_20251025.csv": ORDERS_20251025,
                                        "products.csv": "product_id,product_name,category,price\n"})
    assert {r["_file_day"] for r in csv_files.read_orders(spark, data).collect()} == {"20251025"}
    assert {r["_file_day"] for r in csv_files.read_orders(spark, data, ["20251025"]).collect()} == {"20251025"}
    rep = pipeline.backfill(spark, "20251025", "20251025", pipeline.csv_inputs(spark, data), dry_run=True)
    assert [(r["rows"], r["status"]) for r in rep.collect()] == [(3, "ok")]


def test_folder_per_day_layout(spark, data_dir, tmp_path):
    from ordermill.plans import pipeline
    # daily "files" written by Spark: order_<day>.csv/ folders of part files
    orders = csv_files.read_orders(spark, data_dir).drop("_file_day", "_corrupt_record")
    out = str(tmp_path / "drop")
    (orders.withColumnRenamed("_source_file", "file").write.partitionBy("file")
     .option("header", True).csv(out))
    df = csv_files.read_orders(spark, out, ["20251026"], layout="folders")
    assert [r["_file_day"] for r in df.collect()] == ["20251026", "20251026"]
    write_files(tmp_path / "drop", {"products.csv": open(f"{data_dir}/products.csv").read()})
    s = pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, out, "folders"), dry_run=True)
    assert (s["rows"], s["revenue"]) == (3, 248.48)


HEAD = "product_id,product_name,category,price\n"


def _products(spark, tmp_path, name, texts, **kw):
    folder = write_files(tmp_path / name, texts)
    rows = csv_files.read_table_csv(spark, f"{folder}/*.csv", PRODUCTS, **kw).collect()
    return sorted((r["product_id"], r["product_name"], r["price"], r["_corrupt_record"] is not None) for r in rows)


def test_each_file_is_read_in_the_way_its_quotes_ask_for(spark, tmp_path):
    texts = {
        "plain.csv": HEAD + '1,"a ""b"", c",x,1\n2,19" monitor,x,2\n',
        "lines [1].csv": HEAD + '3,"two\nlines",x,3\n4,plain,x,4\n5,"\n""q""\n",x,5\n6,"a\n","b\n",6\n7,"end",x,"7\n"\n',
        "other {a}.csv": 'price,product_id,product_name,category\n8,8,"x\n\ny",z\n',
        "broken.csv": HEAD + '9,n,x,9\n10,n,x,"10\n11,n,x,11\n12,n,x,"12\n13,n,x,13\n'}
    want = [("1", 'a "b", c', "1", False), ("10", "n", "10", True), ("11", "n", "11", False), ("12", "n", "12", True), ("13", "n", "13", False),
            ("2", '19" monitor', "2", False), ("3", "two\nlines", "3", False), ("4", "plain", "4", False), ("5", '\n"q"\n', "5", False),
            ("6", "a\n", "6", False), ("7", "end", "7\n", False), ("8", "x\n\ny", "8", False), ("9", "n", "9", False)]
    assert _products(spark, tmp_path, "a", texts) == want
    survey = {r.file.rsplit("/", 1)[1]: (r.open > 0, r.balanced) for r in csv_files.survey(spark, str(tmp_path / "a")).collect()}
    assert survey == {"plain.csv": (False, False), "lines%20%5B1%5D.csv": (True, True), "other%20%7Ba%7D.csv": (True, True), "broken.csv": (True, False)}
    # by a join instead of path by path
    was, csv_files.MAX_PATHS = csv_files.MAX_PATHS, 0
    try:
        assert _products(spark, tmp_path, "a", texts) == want
    finally:
        csv_files.MAX_PATHS = was


def test_no_file_is_read_whole_unless_asked_for(spark, tmp_path):
    texts = {"a.csv": HEAD + '1,a,x,1\n2,n,"late,\ncomment",2\n3,b,x,3\n'}
    cut = _products(spark, tmp_path, "a", texts, multi_line=False)
    assert sorted((i, bad) for i, _, _, bad in cut) == [("1", False), ("2", True), ("3", False), ('comment"', True)]
    assert [(i, bad) for i, _, _, bad in _products(spark, tmp_path, "a", texts)] == [("1", False), ("2", False), ("3", False)]


def test_records_that_swallow_others_are_malformed(spark, tmp_path):
    """Two quotes that are never closed look like one that spans the rows between."""
    texts = {"a.csv": HEAD + '1,a,x,1\n2,b,"open,2\n3,c,x,3\n4,d,",4\n5,e,x,5\n'}
    for multi_line in ("auto", True):
        rows = _products(spark, tmp_path, "a", texts, multi_line=multi_line)
        assert [r[0] for r in rows if not r[3]] == ["1", "5"] and [r[0] for r in rows if r[3]] == ["2"]


def test_a_quoted_line_break_cuts_no_good_row(spark, tmp_path):
    from ordermill.plans import pipeline

    head = "order_id,order_date,product_id,qty,unit_price,user_id,order_status"
    data = write_files(tmp_path / "d", {
        "order_20251025.csv": f'{head}\n1,2025-10-25,1001,2,1.50,7,completed\n2,2025-10-25,1001,1,5.0,9,"late,\ncomment"\n',
        "order_20251026.csv": f"{head}\n3,2025-10-26,1001,1,2.00,7,completed\n\n4,2025-10-26,1001\n",
        "order_20251027.csv": f'{head}\n5,2025-10-27,1001,1,5.0,9,"late,\n6,2025-10-27,1001,1,3.0,9,done\n',
        "order_20251028.csv": "qty,order_id,order_date,product_id,unit_price\n3,7,2025-10-28,1002,2.00\n",
        "order_20251029.csv": f"{head}\n8,2025-10-29,1001,1,4.00,7,completed\n{head}\n",
        "products.csv": HEAD + '1001,"Tee\nof cotton",x,1\n'})
    inputs = pipeline.csv_inputs(spark, data)
    want = [("2025-10-25", 2, 8.0, 0), ("2025-10-26", 1, 2.0, 1), ("2025-10-27", 1, 3.0, 1), ("2025-10-28", 1, 6.0, 0), ("2025-10-29", 1, 4.0, 1)]
    dry = pipeline.backfill(spark, "20251025", "20251029", inputs, dry_run=True)
    assert [(r["date"], r["rows"], r["revenue"], r["bad_rows"]) for r in dry.collect()] == want
    out = str(tmp_path / "out")
    written = pipeline.backfill(spark, "20251025", "20251029", inputs, out)
    assert [(r["date"], r["rows"], r["revenue"], r["bad_rows"]) for r in written.collect()] == want
    rows = {r["order_id"]: (r["order_status"], r["product_name"]) for r in spark.read.parquet(f"{out}/processed").collect()}
    assert rows[2] == ("late,\ncomment", "Tee\nof cotton") and set(rows) == {1, 2, 3, 6, 7, 8}
    one = pipeline.run_for_date(spark, "20251025", inputs, str(tmp_path / "one"))
    assert (one["rows"], one["revenue"], one["bad_rows"]) == (2, 8.0, 0)
    plain = pipeline.run_for_date(spark, "20251025", pipeline.csv_inputs(spark, data, multi_line=False), dry_run=True)
    assert (plain["rows"], plain["bad_rows"]) == (1, 2)  # cut, but no part of it passes as a good row


def test_line_parsing_is_one_expression(spark, data_dir):
    """The parser is not run again for every column that is read."""
    plan = csv_files.scan_orders(spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1


SINGLE_READ = """
import json, os, sys
sys.path.insert(0, {root!r})
from ordermill.session import build_session
from ordermill.plans import pipeline
spark = build_session("local[4]", 4, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + {log!r},
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": {scratch!r},
    "spark.sql.files.maxPartitionBytes": "200k", "spark.sql.files.openCostInBytes": "1k"}})
for dry in (True, False):
    spark.sparkContext.setLocalProperty("spark.job.description", str(dry))
    spark.sparkContext.setJobGroup(str(dry), str(dry))
    pipeline.backfill(spark, "20250101", "20250110", pipeline.csv_inputs(spark, {data!r}), {out!r}, dry_run=dry).collect()
spark.stop()
"""


def test_uniform_input_is_read_once(spark, tmp_path):
    """Lines that the jobs read, from the event log of a dry and of a writing run."""
    import json
    import os
    import subprocess
    import sys

    head = "order_id,order_date,product_id,qty,unit_price,user_id,order_status"
    line = "{i},2025-01-{d:02d},1001,2,1.50,7,completed"
    n = 20_000
    data = write_files(tmp_path / "d", {"products.csv": HEAD + "1001,Tee,x,1\n"} | {
        f"order_202501{d:02d}.csv": "\n".join([head, *(line.format(i=i, d=d) for i in range(n))]) + "\n" for d in range(1, 11)})
    log, root = tmp_path / "log", os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    log.mkdir()
    code = SINGLE_READ.format(root=root, log=str(log), data=data, out=str(tmp_path / "out"), scratch=str(tmp_path / "scratch"))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    read, group = {}, {}
    for file in log.iterdir():
        for text in file.open():
            e = json.loads(text)
            if e["Event"] == "SparkListenerJobStart":
                group |= {s: e["Properties"].get("spark.jobGroup.id") for s in e["Stage IDs"]}
            elif e["Event"] == "SparkListenerTaskEnd":
                rows = e["Task Metrics"]["Input Metrics"]["Records Read"]
                size = e["Task Metrics"]["Input Metrics"]["Bytes Read"]
                if size > 50_000:  # a split of an order file, and not a cached block or a small table
                    read[group[e["Stage ID"]]] = read.get(group[e["Stage ID"]], 0) + rows
    total = 10 * (n + 1)
    assert set(read) == {"True", "False"}
    # the look at the first header costs at most one split more
    assert all(total <= rows <= total + 12_000 for rows in read.values()), (read, total)


def test_the_day_of_a_name_among_many_days(spark):
    days = pipeline.day_range("20200101", "20251231")
    names = ["order_20251025.csv", "order_99999999_20251026.csv", "order_120251027.csv", "order_2025102820251029.csv", "order_2025-10-25.csv", "order.csv"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    asked = ["20251025", "20251026", "20251027", "20251029"]
    for some in (days, asked):
        old = [next((n[i:i + 8] for i in range(len(n)) if n[i:i + 8] in some), "") for n in names]
        column = csv_files.file_day(F.col("name"), some)
        assert [r[0] for r in df.select(column).collect()] == old
        assert "|".join(some) not in df.select(column)._jdf.queryExecution().optimizedPlan().toString()


def test_a_written_order_file_begins_with_its_header(spark, tmp_path):
    from ordermill import registry

    cells = [("1", "2025-10-25", "1", "2", "1.5", None, "completed"), ("2", "x, \"y\"", "1", "", "1.5", "7", "a\nb")]
    raw = spark.createDataFrame([(*c, "20251025") for c in cells] + [(*cells[0], "20251026")], ", ".join(
        f"{n} string" for n in (*registry.ORDERS.names, "_file_day"))).repartition("_file_day")
    registry._write_order_files(spark, raw, str(tmp_path))
    for day, n in (("20251025", 2), ("20251026", 1)):
        text = (tmp_path / "data" / f"order_{day}.csv").read_text()
        assert text.startswith("order_id,order_date,product_id,qty,unit_price,user_id,order_status\n") and text.count("order_id") == 1
        assert csv_files.read_orders(spark, str(tmp_path / "data"), [day]).count() == n
