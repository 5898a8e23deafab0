"""Days that change: manifest, late rows, table-level rules, stored sums, stored order."""

from __future__ import annotations

import os
import random
import time
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import write_files
from ordermill.operators import joins
from ordermill.operators import validate as V
from ordermill.operators.table_rules import KeyExists, UniqueKey, apply_rules
from ordermill.operators.transforms import enrich_with_products
from ordermill.plans import late, manifest, partials, pipeline, profile, reports
from ordermill.schemas import ORDERS, PRODUCTS
from ordermill.sinks import files

HEAD = "order_id,order_date,product_id,qty,unit_price,user_id,order_status\n"
PRODUCT_LINES = "product_id,product_name,category,price\n1001,Tee,Apparel,1\n1002,Mug,Home,2\n"


def line(i, day, product=1001, qty=1, price="2.00", status="completed"):
    return f"{i},{day},{product},{qty},{price},7,{status}\n"


def held(spark, out):
    rows = spark.read.parquet(f"{out}/processed").select(F.col("date").cast("string").alias("date"), "order_id", "product_id", "qty").collect()
    return sorted(tuple(r) for r in rows)


def report(df):
    return {r["date"]: (r["status"], r["rows"], r["revenue"], r["bad_rows"]) for r in df.collect()}


def part_files(out, day):
    return sorted(f for f in os.listdir(f"{out}/processed/date={day}") if f.endswith(".parquet"))


# --- manifest

def test_only_days_whose_files_changed_run_again(spark, tmp_path):
    data = write_files(tmp_path / "d", {"products.csv": PRODUCT_LINES} | {
        f"order_2025102{d}.csv": HEAD + line(d, f"2025-10-2{d}") for d in range(5, 9)})
    out = str(tmp_path / "out")
    run = lambda: report(pipeline.backfill(spark, "20251025", "20251029", pipeline.csv_inputs(spark, data), out, incremental=True))
    first = run()
    assert {d: s[0] for d, s in first.items()} == dict.fromkeys((f"2025-10-2{d}" for d in range(5, 9)), "ok") | {"2025-10-29": "missing"}
    before = {d: part_files(out, f"2025-10-2{d}") for d in range(5, 9)}
    assert {s[0] for s in run().values()} == {"unchanged", "missing"} and {d: part_files(out, f"2025-10-2{d}") for d in before} == before
    # one file more for a day, one with other lines, one gone, one new day
    write_files(tmp_path / "d", {"late_order_20251025.csv": HEAD + line(50, "2025-10-25"), "order_20251026.csv": HEAD + line(6, "2025-10-26", qty=3),
                                 "order_20251029.csv": HEAD + line(9, "2025-10-29", qty=-1)})
    (tmp_path / "d" / "order_20251027.csv").unlink()
    second = run()
    assert second == {"2025-10-25": ("ok", 2, 4.0, 0), "2025-10-26": ("ok", 1, 6.0, 0), "2025-10-27": ("missing", None, None, None),
                      "2025-10-28": ("unchanged", 1, 2.0, 0), "2025-10-29": ("no_valid_rows", 0, 0.0, 1)}
    assert part_files(out, "2025-10-28") == before[8] and part_files(out, "2025-10-26") != before[6]
    assert not os.path.exists(f"{out}/processed/date=2025-10-27") and not os.path.exists(f"{out}/summaries/date=2025-10-27")
    assert [r[1] for r in held(spark, out)] == [5, 50, 6, 8]
    assert {s[0] for d, s in run().items() if d != "2025-10-27"} == {"unchanged"}
    # other products concern every day
    time.sleep(1.1)
    write_files(tmp_path / "d", {"products.csv": PRODUCT_LINES + "1003,Cap,Apparel,3\n"})
    assert {s[0] for d, s in run().items()} == {"ok", "no_valid_rows", "missing"}


def test_a_day_that_fails_is_run_again(spark, tmp_path):
    data = write_files(tmp_path / "d", {"products.csv": PRODUCT_LINES, "order_20251025.csv": HEAD + line(1, "2025-10-25"),
                                        "order_20251026.csv": HEAD + line(2, "2025-10-26")})
    out, inputs = str(tmp_path / "out"), pipeline.csv_inputs(spark, str(tmp_path / "d"))
    scan = inputs.scan

    def broken(days):
        if "20251026" in days:
            raise ValueError("disk on fire")
        return scan(days)

    inputs.scan = broken
    first = report(pipeline.backfill(spark, "20251025", "20251026", inputs, out, incremental=True))
    assert first["2025-10-26"][0] == "error" and first["2025-10-25"][0] == "ok"
    again = report(pipeline.backfill(spark, "20251025", "20251026", pipeline.csv_inputs(spark, data), out, incremental=True))
    assert again["2025-10-26"][0] == "ok" and again["2025-10-25"][0] == "unchanged"
    with pytest.raises(ValueError):
        pipeline.backfill(spark, "20251025", "20251026", inputs, out, incremental=True, dry_run=True)
    assert manifest.stored(spark, out).count() == 2


# --- late rows

def late_data(tmp_path, more=()):
    return write_files(tmp_path / "d", {
        "products.csv": PRODUCT_LINES,
        "order_20251025.csv": HEAD + line(1, "2025-10-25") + line(2, "2025-10-25") + line(2, "2025-10-25", qty=9) + line(2, "2025-10-25", product=1002),
        # a late order, a correction of an order line of two rows, a late row that is not valid
        "order_20251026.csv": HEAD + line(3, "2025-10-26") + line(4, "2025-10-25") + line(2, "2025-10-25", qty=5) + line(5, "2025-10-25", qty=-1)} | dict(more))


WITH_LATE = [("2025-10-25", 1, 1001, 1), ("2025-10-25", 2, 1001, 5), ("2025-10-25", 2, 1002, 1), ("2025-10-25", 4, 1001, 1), ("2025-10-26", 3, 1001, 1)]


def test_late_rows_are_merged_into_their_day(spark, tmp_path):
    data, out = late_data(tmp_path), str(tmp_path / "out")
    inputs = pipeline.csv_inputs(spark, data)
    run = lambda a, b: report(pipeline.backfill(spark, a, b, inputs, out, merge_late=True))
    assert run("20251025", "20251026") == {"2025-10-25": ("ok", 4, 16.0, 0), "2025-10-26": ("ok", 1, 2.0, 1)}
    assert held(spark, out) == WITH_LATE
    for days in (("20251026", "20251026"), ("20251025", "20251025"), ("20251025", "20251026")):  # in any order, any number of times
        run(*days)
        assert held(spark, out) == WITH_LATE
    summary = spark.read.schema("rows bigint, revenue double, date string").json(f"{out}/summaries").orderBy("date").collect()
    assert [tuple(r) for r in summary] == [(4, 16.0, "2025-10-25"), (1, 2.0, "2025-10-26")]
    # a later file wins; a corrected file takes its late rows back
    late_data(tmp_path, [("order_20251027.csv", HEAD + line(2, "2025-10-25", qty=7) + line(8, "2025-10-24"))])
    run("20251027", "20251027")
    assert held(spark, out) == sorted([("2025-10-24", 8, 1001, 1), *(r if r[1:3] != (2, 1001) else (*r[:3], 7) for r in WITH_LATE)])
    late_data(tmp_path, [("order_20251027.csv", HEAD + line(6, "2025-10-27"))])
    run("20251027", "20251027")
    assert held(spark, out) == sorted([*WITH_LATE, ("2025-10-27", 6, 1001, 1)]) and not os.path.exists(f"{out}/processed/date=2025-10-24")
    one = pipeline.run_for_date(spark, "20251026", inputs, out, merge_late=True)
    assert (one["rows"], one["bad_rows"]) == (1, 1) and held(spark, out) == sorted([*WITH_LATE, ("2025-10-27", 6, 1001, 1)])


def test_late_rows_equal_one_run_over_all_rows(spark, tmp_path):
    """Rows dealt over files at random give what files by day give."""
    r = random.Random(5)
    rows = [(i, f"2025-10-2{r.randrange(4, 8)}", r.choice((1001, 1002)), r.randrange(1, 9)) for i in range(300)]
    def folder(name, day_of):
        texts = {f"order_202510{d}.csv": HEAD for d in range(24, 28)}
        for i, day, product, qty in rows:
            texts[f"order_202510{day_of(day)}.csv"] += line(i, day, product, qty)
        return write_files(tmp_path / name, texts | {"products.csv": PRODUCT_LINES})
    results = []
    for name, day_of in (("own", lambda day: day[-2:]), ("mixed", lambda day: r.randrange(24, 28))):
        out = str(tmp_path / f"out-{name}")
        got = report(pipeline.backfill(spark, "20251024", "20251027", pipeline.csv_inputs(spark, folder(name, day_of)), out, merge_late=True, window_days=2))
        results.append((held(spark, out), got))
    assert results[0] == results[1] and len(results[0][0]) == 300


@pytest.mark.parametrize("step", ["write_partitioned", "touch", "write_summaries"])
def test_a_merge_that_breaks_off_can_be_repeated(spark, tmp_path, monkeypatch, step):
    data, out = late_data(tmp_path), str(tmp_path / "out")
    inputs = pipeline.csv_inputs(spark, data)
    real, merging = getattr(files, step), []

    def fails(*args, **kw):
        if merging:
            merging.pop()
            raise OSError("gone")
        return real(*args, **kw)

    merge = late.merge

    def watched(*args):
        merging.append(1)
        return merge(*args)

    monkeypatch.setattr(files, step, fails)
    monkeypatch.setattr(late, "merge", watched)
    with pytest.raises(OSError):
        pipeline.backfill(spark, "20251025", "20251026", inputs, out, merge_late=True)
    monkeypatch.setattr(late, "merge", merge)
    pipeline.backfill(spark, "20251026", "20251026", inputs, out, merge_late=True)
    assert held(spark, out) == WITH_LATE


def test_without_merging_late_rows_are_rejected(spark, tmp_path):
    out = str(tmp_path / "out")
    got = report(pipeline.backfill(spark, "20251025", "20251026", pipeline.csv_inputs(spark, late_data(tmp_path)), out))
    assert got == {"2025-10-25": ("ok", 4, 24.0, 0), "2025-10-26": ("ok", 1, 2.0, 3)} and not os.path.exists(f"{out}/late")


# --- table-level rules

def test_rules_on_a_whole_table(spark):
    rows = [("1", "a", "x", "1"), ("1.0", "b", "x", "2"), ("2", "c", "y", "3"), ("3", "d", "x", "-1"), ("3", "e", "x", "4"), (None, "f", "x", "5"),
            ("4", "g", None, "6"), ("4", "g", None, "6"), ("5", "h", "x", "8"), ("5", "i", "x", "7"), ("5", "j", "x", "7")]
    tagged = V.tag(spark.createDataFrame(rows, "product_id string, product_name string, category string, price string"), PRODUCTS)
    of = lambda df: {(r.product_id, r.product_name): r._error for r in df.collect()}
    none = of(apply_rules(tagged, [UniqueKey(("product_id",))], PRODUCTS))
    assert none["1", "a"] == none["1.0", "b"] == "product_id: key is on 2 rows" and none["4", "g"] == "product_id: key is on 2 rows"
    assert none["2", "c"] == "" and none["3", "e"] == "" and none["3", "d"].startswith("price:") and none[None, "f"] == "product_id: field required"
    first = of(apply_rules(tagged, [UniqueKey(("product_id",), keep=("price", "product_name"))], PRODUCTS))
    assert (first["1", "a"], first["1.0", "b"]) == ("", "product_id: key is on 2 rows") and first["5", "i"] == "" and first["5", "j"] != ""
    assert first["4", "g"] != ""  # two rows are alike, so neither is the first
    tied = of(apply_rules(tagged, [UniqueKey(("product_id",), keep=("price",))], PRODUCTS))
    assert {tied["5", n] for n in "hij"} == {"product_id: key is on 3 rows"}
    there = spark.createDataFrame([("x",), ("x",), (None,)], "name string")
    both = of(apply_rules(tagged, [KeyExists(("category",), there, ("name",), "category"), UniqueKey(("product_id",))], PRODUCTS))
    assert both["2", "c"] == "category: no such category" and both["4", "g"] == "product_id: key is on 2 rows" and both["5", "h"] != ""
    assert apply_rules(tagged.limit(0), [UniqueKey(("product_id",))], PRODUCTS).collect() == []
    assert apply_rules(tagged, [], PRODUCTS).columns == apply_rules(tagged, [UniqueKey(("product_id",))], PRODUCTS).columns == tagged.columns


def test_runs_reject_rows_that_break_a_table_rule(spark, tmp_path):
    data = write_files(tmp_path / "d", {"products.csv": PRODUCT_LINES, "order_20251025.csv": HEAD + line(1, "2025-10-25") + line(1, "2025-10-25") + line(
        2, "2025-10-25", product=1003) + line(3, "2025-10-25")})
    inputs = pipeline.csv_inputs(spark, data)
    good, _ = pipeline.valid_products(inputs.products())
    rules = [UniqueKey(("order_id", "product_id")), KeyExists(("product_id",), good, ("product_id",), "product")]
    dry = pipeline.run_for_date(spark, "20251025", inputs, dry_run=True, rules=rules)
    out = str(tmp_path / "out")
    wet = pipeline.run_for_date(spark, "20251025", inputs, out, rules=rules)
    assert (dry["rows"], dry["revenue"], dry["bad_rows"]) == (wet["rows"], wet["revenue"], wet["bad_rows"]) == (1, 2.0, 3)
    bad = spark.read.option("header", True).csv(f"{out}/bad_rows/dataset=orders").collect()
    assert Counter(r["_error"] for r in bad) == {"order_id, product_id: key is on 2 rows": 2, "product_id: no such product": 1}
    assert report(pipeline.backfill(spark, "20251025", "20251025", inputs, dry_run=True, rules=rules)) == {"2025-10-25": ("ok", 1, 2.0, 3)}
    assert held(spark, out) == [("2025-10-25", 3, 1001, 1)]


# --- order of dates

def test_date_order_is_inferred_per_file(spark):
    rows = [("eu", "03/04/2025", "2025-04-03"), ("eu", "25/10/2025", "2025-10-25"), ("eu", "1-2-2025", "2025-02-01"), ("eu", "3.4.2025", "2025-04-03"),
            ("eu", "2025-05-06", "2025-05-06"), ("eu", "05/06/2025 10:11", "2025-06-05"), ("eu", "03/04/25", "2025-04-03"), ("eu", None, None),
            ("us", "03/04/2025", "2025-03-04"), ("us", "10/25/2025", "2025-10-25"), ("us", "3.4.2025", "2025-03-04"), ("us", "x", None),
            ("both", "25/10/2025", "2025-10-25"), ("both", "10/25/2025", "2025-10-25"), ("both", "03/04/2025", "2025-03-04"),
            ("none", "03/04/2025", "2025-03-04"), ("none", "3.4.2025", "2025-04-03"), (None, "13/01/2025", "2025-01-13"), (None, "1/2/2025", "2025-02-01")]
    df = spark.createDataFrame(rows, "_source_file string, text string, want string")
    good, bad = V.parse_date_column(V.infer_date_order(df, "text"), "text")
    got = {(r._source_file, r.want): r.text.strftime("%Y-%m-%d") for r in good.collect()}
    assert all(k[1] == v for k, v in got.items()) and good.count() == 17 and {r.want for r in bad.collect()} == {None}
    assert V.parse_date_column(V.infer_date_order(df.limit(0), "text"), "text")[0].collect() == []


def test_more_date_texts(spark):
    from ordermill.functions.dates import parse_date

    texts = {"Oct 25 2025": "2025-10-25 00:00:00", "10/25/25": "2025-10-25 00:00:00", "Sat Oct 25 2025": "2025-10-25 00:00:00",
             "20251025T101010": "2025-10-25 10:10:10", "Saturday, October 25, 2025": "2025-10-25 00:00:00", "25/10/99": "1999-10-25 00:00:00",
             "12/31/68": "2068-12-31 00:00:00", "Tues. Mar 4 2025": "2025-03-04 00:00:00", "Sat": None, "Monday": None, "13/13/25": None, "Oct 25 25": None}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_date(F.col("t")).cast("string").alias("d")).collect()
    assert {r.t: r.d for r in rows} == texts


# --- hot products

def test_hot_products_are_found_by_counting(spark):
    n = 60_000
    orders = spark.range(n).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 7 == 1, F.lit(99_999)).when(
            F.col("id") % 50 == 2, F.lit(None)).otherwise(F.col("id") % 5000).cast("bigint").alias("product_id"), F.lit(1).alias("qty"), F.lit(2.0).alias("unit_price"))
    products = spark.range(5000).select(F.col("id").alias("product_id"), F.concat(F.lit("p"), F.col("id")).alias("product_name"),
                                        F.when(F.col("id") != 7, F.lit("c")).alias("category"), F.lit(1.0).alias("price"))
    assert {r[0] for r in joins.heavy_hitters(orders, "product_id", 16).collect()} == {7, 99_999}
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for how in ("left", "inner", "right", "outer"):
            plain = enrich_with_products(orders, products, how, broadcast=False)
            split = enrich_with_products(orders, products, how, split_hot=True).select(*plain.columns)
            assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        even, uneven = sizes(enrich_with_products(orders, products, split_hot=True)), sizes(enrich_with_products(orders, products, broadcast=False))
        assert max(even) < 2 * n / 16 and max(uneven) > n / 3 and sum(even) == sum(uneven) == n
        twice = products.unionByName(products.where("product_id = 7"))
        with pytest.raises(Exception, match="many-to-one"):
            enrich_with_products(orders, twice, split_hot=True).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# --- stored sums

def test_reports_from_stored_sums_follow_a_changed_day(spark, tmp_path):
    def day_file(d, more=0):
        return HEAD + "".join(line(10 * d + i, f"2025-10-2{d}", 1001 + i % 3, i + more, "1.25", ("completed", "returned", "cancelled", "")[i % 4]) for i in range(9))

    data = write_files(tmp_path / "d", {"products.csv": PRODUCT_LINES} | {f"order_2025102{d}.csv": day_file(d) for d in range(5, 8)})
    out = str(tmp_path / "out")
    def run(by=0, **kw):
        write_files(tmp_path / "d", {"order_20251026.csv": day_file(6, by)})
        pipeline.backfill(spark, "20251025", "20251027", pipeline.csv_inputs(spark, data), out, **kw).collect()

    run(keep_partials=True, incremental=True)
    stamp = os.listdir(f"{out}/partials/date=2025-10-25")
    time.sleep(1.1)
    run(by=5, incremental=True)  # kept from now on without being asked for
    time.sleep(1.1)
    run(by=7, incremental=True)
    products, _ = pipeline.valid_products(pipeline.csv_inputs(spark, data).products())
    lines, sums = spark.read.parquet(f"{out}/processed"), partials.read(spark, out)
    rows = lambda df: [tuple(r) for r in df.collect()]
    assert rows(partials.daily_revenue(sums, products)) == rows(reports.daily_revenue(lines, products))
    assert rows(partials.product_performance(sums, products)) == rows(reports.product_performance(lines, products))
    assert sum(r.units for r in sums.collect()) == sum(r.qty for r in lines.collect()) == 3 * 36 + 9 * 7
    assert [r.total_revenue for r in partials.daily_totals(sums).orderBy("order_date_only").collect()] == [
        r.total_revenue for r in reports.daily_revenue(lines, products).collect()]
    from ordermill.operators import aggregate
    assert rows(partials.daily_category_revenue(sums, products)) == rows(aggregate.daily_category_revenue(lines))
    assert os.listdir(f"{out}/partials/date=2025-10-25") == stamp  # that day has not changed
    late_out = str(tmp_path / "late-out")
    inputs = pipeline.csv_inputs(spark, late_data(tmp_path / "l"))
    pipeline.backfill(spark, "20251025", "20251026", inputs, late_out, merge_late=True, keep_partials=True)
    merged = partials.read(spark, late_out).groupBy("date").agg(F.sum("units").alias("u")).orderBy("date").collect()
    assert [tuple(r) for r in merged] == [("2025-10-25", 8), ("2025-10-26", 1)]


# --- stored order, preview

def test_stored_order_holds_across_files(spark, tmp_path):
    df = spark.range(5000).select((F.xxhash64("id") % 900).alias("k"), F.col("id").alias("i"), F.when(F.col("id") % 11 > 0, F.col("id") % 7).alias("n"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = files.write_sorted(df, str(tmp_path / "s"), F.desc("n"), "k", "i")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) > 3
    rows = sorted((r.position, -1 if r.n is None else r.n, r.k, r.i) for r in files.read_sorted(spark, out).collect())
    assert [r[0] for r in rows] == list(range(1, 5001))
    keys = [(-n, k, i) for _, n, k, i in rows]
    assert keys == sorted(keys)
    assert files.read_sorted(spark, files.write_sorted(df.limit(0), str(tmp_path / "e"), "k")).collect() == []


def test_preview_is_the_same_on_every_run(spark):
    df = spark.range(50).select((F.col("id") * 7 % 50).alias("a"), F.lit(None).cast("string").alias("b"))
    rows = profile.preview_datasets({"x": df, "y": df.limit(2)}, 3).collect()
    assert [(r.row, r.column, r.value) for r in rows if r.dataset == "x"] == [(1, "a", "0"), (1, "b", None), (2, "a", "1"), (2, "b", None), (3, "a", "2"), (3, "b", None)]
    assert sum(r.dataset == "y" for r in rows) == 4


def test_a_merge_deals_rows_once_and_counts_the_latest_file(spark, tmp_path):
    out = str(tmp_path / "out")
    base = "order_id bigint, product_id bigint, qty int, order_total decimal(38,2), date string"
    own = [(i, 1, 1, 1, "2025-01-01") for i in range(200)] + [(1, 1, 5, 5, "2025-01-01"), (9, 9, 1, 1, "2025-01-02")]
    files.write_partitioned(spark.createDataFrame([(*r[:3], Decimal(r[3]), r[4]) for r in own], base), f"{out}/processed", "date")
    brought = [(1, 1, 7, 7, "2025-01-01", "2025-02-01"), (1, 1, 8, 8, "2025-01-01", "2025-03-01"), (1, 1, 9, 9, "2025-01-01", "2025-03-01"),
               (500, 1, 2, 2, "2025-01-01", "2025-02-01"), (3, 3, 4, 4, "2025-01-03", "2025-02-01")]
    frame = spark.createDataFrame([(*r[:3], Decimal(r[3]), *r[4:]) for r in brought], base + ", source_day string")
    days = sorted(late.file_rows(frame, ["2025-02-01", "2025-03-01"], out) | {"2025-01-02"})
    plan = late._merged_rows(spark.createDataFrame([], base), frame)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Anti" not in plan and "Semi" not in plan
    for _ in range(2):
        got = {r.date: (r.rows, r.revenue, r.late_rows) for r in late.merge(spark, out, days)}
        assert got == {"2025-01-01": (202, 218.0, 3), "2025-01-02": (1, 1.0, 0), "2025-01-03": (1, 4.0, 1)}
    late.file_rows(frame.where("false"), ["2025-02-01"], out)
    got = {r.date: (r.rows, r.revenue, r.late_rows) for r in late.merge(spark, out, days)}
    assert got == {"2025-01-01": (201, 216.0, 2), "2025-01-02": (1, 1.0, 0)} and not os.path.exists(f"{out}/processed/date=2025-01-03")


def test_partials_are_dealt_by_day_in_one_shuffle(spark):
    rows = [(f"2025-01-0{1 + i % 3}", i % 7, ("completed", None)[i % 2], i % 5, Decimal(i)) for i in range(300)]
    lines = spark.createDataFrame(rows, "date string, product_id bigint, order_status string, qty bigint, unit_price decimal(28,6)")
    one, dealt = partials.of_lines(lines), partials.of_lines(lines, days=3)
    key = lambda df: sorted(map(str, df.collect()))
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert key(one) == key(dealt) and dealt.columns == one.columns
