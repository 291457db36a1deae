"""Property tests for the keyed upsert (seeded random rows, SURVEY §5)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast import schemas
from shelfcast.sources import store

BASE = dt.date(2001, 10, 1)
row = st.tuples(st.sampled_from([f"k{i}" for i in range(8)]), st.integers(0, 20), st.integers(0, 9))


def frame(spark, rows):
    data = [(k, "o", "#", "v", "s", "t", q, BASE + dt.timedelta(days=d), None, "ven", None) for k, q, d in rows]
    return spark.createDataFrame(data, schemas.SALES_HISTORY)


def bag(df):
    return sorted((r.sale_id, r.quantity_sold, r.sale_date) for r in df.collect())


def unique_by_key(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(row, max_size=12), st.lists(row, min_size=1, max_size=8))
def test_upsert_properties(spark, target_rows, source_rows):
    target = frame(spark, unique_by_key(target_rows))
    source = frame(spark, unique_by_key(source_rows))
    once = store.upsert_sales(target, source)
    twice = store.upsert_sales(once, source)
    assert bag(once) == bag(twice)                                           # idempotent

    src = {k: (q, BASE + dt.timedelta(days=d)) for k, q, d in unique_by_key(source_rows)}
    lo, hi = min(v[1] for v in src.values()), max(v[1] for v in src.values())
    out = bag(once)
    outside = [(k, q, BASE + dt.timedelta(days=d)) for k, q, d in unique_by_key(target_rows)
               if not lo <= BASE + dt.timedelta(days=d) <= hi]
    for r in outside:                                                        # rows outside the range untouched
        assert r in out
    for k, (q, _) in src.items():                                            # every staged row is present
        assert any(o[0] == k and o[1] == q for o in out)
    if not outside:                                                          # all stored dates in range: keys unique
        assert len({o[0] for o in out}) == len(out)
