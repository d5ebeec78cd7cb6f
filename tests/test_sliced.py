"""Running columns of companies that are cut into slices, against the plain windows."""

from __future__ import annotations

import random
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortry.operators import running, sliced
from tests.test_scale import plan

MED, SUM, MAX = {"m1": "a", "m2": "b"}, {"s1": "a", "s2": "b"}, {"x1": "a", "x2": "b"}
KIND = "company bigint, ym int, xin string, a bigint, b double"


def panel(spark, seed=1):
    r = random.Random(seed)
    rows = []
    for company, n in ((1, 900), (2, 333), (3, 20), (None, 50)):
        for k in range(n):
            a = r.choice([0, 0, 0, 5, r.randrange(1000), None])
            b = None if company == 2 and k < 200 else float(k if company == 1 else r.randrange(10**6))
            rows.append((company, k // 3, f"x{k % 3}", a, b))
    r.shuffle(rows)
    return spark.createDataFrame(rows, KIND)


def got(df):
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r[:3])
    return sorted(map(tuple, df.select("company", "ym", "xin", "a", "b", *MED, *SUM, *MAX).collect()), key=key)


@pytest.mark.parametrize("bound", [40, 150])
def test_slices_equal_the_plain_windows(spark, bound):
    rows, order = panel(spark), ("ym", "xin")
    plain = running.accumulated(rows, order, MED, SUM, MAX, None)
    cut = running.accumulated(rows, order, MED, SUM, MAX, bound)
    assert cut.dtypes == plain.dtypes and got(cut) == got(plain)


def test_no_slice_and_no_window_holds_more_than_the_bound(spark):
    rows = panel(spark).where("company = 1")
    cut = sliced.slices(rows, ("ym", "xin"), 50)
    sizes = cut.groupBy("company", "_slice").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 50 and sizes[1] >= 18
    text = plan(sliced.scanned(cut, SUM, MAX))
    assert text.count("Window [") == 2  # offsets by company, rows by company and slice
    assert "windowspecdefinition(company" in text and "_slice" in text.split("Window [sum(")[-1]


def test_panel_accumulation_takes_slices_where_ids_are_many(spark):
    ids = spark.createDataFrame([(1, f"x{k}") for k in range(50)] + [(2, "y")], "company_id bigint, xin_value string")
    assert running.may_be_hot(ids, 20_000) and not running.may_be_hot(ids, 40_000)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 6).map(float)), max_size=30), st.integers(0, 30))
def test_medians_of_a_slice(values, cut):
    before, after = [v for v in values[:cut] if v is not None], values[cut:]
    earlier = {v: before.count(v) for v in before}
    now, want = list(before), []
    for v in after:
        now += [v] if v is not None else []
        want.append(statistics.median(now) if now else None)
    inf = float("inf")
    assert sliced.slice_medians(after, earlier, -inf, inf, 0, len(before)) == want
