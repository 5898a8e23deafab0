"""Property tests: the columnar rules agree with a plain-Python statement
of the rules on generated text, and no row is lost between the channels."""

from __future__ import annotations

import re
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordermill.operators import validate as V
from ordermill.schemas import ORDERS

CELL = st.text(alphabet="0123456789.-+ e", max_size=6) | st.sampled_from(["2.0", "-1", "abc", "1e30", "NaN"])


def expect_int(s: str | None) -> str | None:
    if s is None:
        return "qty: field required"
    if not re.fullmatch(r"\s*[+-]?\d+(\.0*)?\s*", s):
        return "qty: value is not a valid integer"
    v = int(re.match(r"\s*([+-]?\d+)", s).group(1))
    if not -2**31 <= v < 2**31:
        return "qty: value is not a valid integer"
    return "qty: value must be >= 0" if v < 0 else None


def expect_price(s: str | None) -> str | None:
    if s is None:
        return "unit_price: field required"
    try:
        d = float(s)
        ok = d == d and abs(d) != float("inf") and abs(Decimal(s.strip())) < Decimal(10) ** 12
    except (ValueError, InvalidOperation):
        ok = False
    if not ok:
        return "unit_price: value is not a valid number"
    return "unit_price: value must be >= 0" if d < 0 else None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(st.none() | CELL, st.none() | CELL), min_size=1, max_size=40))
def test_rules_match_python_statement(spark, rows):
    data = [(str(i), "2025-01-01", "1", q, p, None, None) for i, (q, p) in enumerate(rows)]
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in ORDERS.names))
    tagged = V.tag(df, ORDERS)
    got = {int(r["order_id"]): r[V.ERROR] for r in tagged.select("order_id", V.ERROR).collect()}
    for i, (q, p) in enumerate(rows):
        want = "; ".join(m for m in (expect_int(q), expect_price(p)) if m)
        assert got[i] == want, (q, p)
    good, bad = V.good_rows(tagged, ORDERS), V.bad_rows(tagged)
    assert good.count() + bad.count() == len(rows)
    assert good.where("qty IS NULL OR unit_price IS NULL").count() == 0
