from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import AS_OF, rows_by

from basketwork.operators import analytics, joins, monitoring, validation


def day(n: int) -> dt.datetime:
    return dt.datetime.combine(AS_OF, dt.time()) - dt.timedelta(days=n)


def people(*ids, **values):
    return [{"customer_id": i, "email": f"{i}@x.io", "country": "it", **values} for i in ids]


@pytest.fixture(scope="module")
def shop(warehouse):
    """Random sales with one customer, product and campaign holding a third of the rows."""
    rng = random.Random(7)
    customers = [
        {"customer_id": f"c{i}", "email": f"c{i}@x.io", "age": i % 90, "country": f"n{i % 4}",
         "registration_date": dt.date(2024, 1 + i % 6, 3)}
        for i in range(30)
    ]
    products = [
        {"product_id": f"p{i}", "category": f"k{i % 3}", "brand": f"b{i % 4}", "price": 5.0 + i, "stock_quantity": i}
        for i in range(20)
    ]
    campaigns = [
        {"campaign_id": f"m{i}", "name": f"m{i // 2}", "channel": f"h{i % 2}", "budget": 10.0, "actual_spend": float(i)}
        for i in range(6)
    ]
    sales = []
    for i in range(400):
        hot = i % 3 == 0
        sales.append(
            {
                "customer_id": "c0" if hot else f"c{rng.randrange(25)}",
                "product_id": "p0" if hot else f"p{rng.randrange(15)}",
                "campaign_id": "" if hot else rng.choice([None, "lost", *(f"m{j}" for j in range(5))]),
                "quantity": rng.randrange(1, 9), "unit_price": rng.randrange(100, 9999) / 100,
                "amount": rng.randrange(100, 99999) / 100, "transaction_date": day(rng.randrange(0, 150)),
            }
        )
    return warehouse(customers, products, campaigns, sales)


@pytest.fixture(scope="module")
def flat(shop):
    """All sales with their dimension columns, as plain dicts."""
    c, p, m = (rows_by(df, key) for df, key in ((shop.customers, "customer_id"), (shop.products, "product_id"), (shop.campaigns, "campaign_id")))
    out = []
    for s in shop.sales.collect():
        out.append({**s.asDict(), "c": c[s.customer_id], "p": p[s.product_id], "m": m.get(s.campaign_id)})
    return out


def group(rows, key):
    out = {}
    for row in rows:
        out.setdefault(key(row), []).append(row)
    return out


def test_segments(warehouse):
    big = {"amount": 3000.0}
    sales = []
    for who, days, n, amount in (
        ("champion", 10, 5, 500.0), ("loyal", 50, 3, 400.0), ("potential", 20, 2, 10.0), ("new", 20, 1, 10.0),
        ("risk", 100, 1, 1000.0), ("lost", 200, 1, 10.0), ("other", 100, 1, 10.0),
    ):
        sales += [{"customer_id": who, "amount": amount, "transaction_date": day(days)} for _ in range(n)]
    ids = ["champion", "loyal", "potential", "new", "risk", "lost", "other"]
    w = warehouse(people(*ids), [{"product_id": "p"}], [], sales)
    out = analytics.customer_segmentation(w, AS_OF).collect()
    assert {r.customer_segment for r in out} == {
        "Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "At Risk", "Cannot Lose Them", "Others",
    }
    assert {r.age_group for r in out} == {"35-44"} and big


def test_age_bands(warehouse):
    ages = {"a": 24, "b": 25, "c": 44, "d": 54, "e": 55}
    customers = [{"customer_id": k, "age": v} for k, v in ages.items()]
    w = warehouse(customers, [{"product_id": "p"}], [], [{"customer_id": k} for k in ages])
    out = analytics.customer_segmentation(w, AS_OF).collect()
    assert sorted(r.age_group for r in out) == ["18-24", "25-34", "35-44", "45-54", "55+"]


def test_lifetime_value_needs_revenue(warehouse):
    sales = [{"customer_id": "a", "amount": 1000.0}, {"customer_id": "b", "amount": 600.0, "transaction_date": day(0)},
             {"customer_id": "b", "amount": 600.0, "transaction_date": day(3)}]
    w = warehouse(people("a", "b"), [{"product_id": "p"}], [], sales)
    (row,) = analytics.customer_lifetime_value(w, AS_OF).collect()
    assert (row.customer_id, row.total_transactions, row.days_since_last_purchase) == ("b", 2, 0)
    assert row.clv_score == 2400.0 and row.avg_transaction_value == 600.0


def test_geography(shop, flat):
    out = rows_by(analytics.geographic_performance(shop, AS_OF), "country")
    for country, rows in group(flat, lambda r: r["c"].country).items():
        recent = {r["customer_id"] for r in rows if (AS_OF - r["transaction_date"]).days <= 90}
        assert out[country].total_transactions == len(rows)
        assert out[country].total_customers == len({r["customer_id"] for r in rows})
        assert out[country].active_customers_90d == len(recent)
        assert out[country].total_revenue == pytest.approx(float(sum(r["amount"] for r in rows)))


def test_campaigns_equal_in_all_columns_merge(warehouse):
    campaigns = [{"campaign_id": i, "name": "same", "budget": 5.0, "actual_spend": 4.0} for i in "12"]
    sales = [{"campaign_id": "1", "amount": 6.0}, {"campaign_id": "2", "amount": 6.0}, {"campaign_id": "", "amount": 1.0},
             {"campaign_id": None, "amount": 1.0}]
    w = warehouse(people("c"), [{"product_id": "p"}], campaigns, sales)
    out = rows_by(analytics.campaign_roi(w), "campaign_name")
    assert out["same"].transactions == 2 and out["same"].roi_percentage == 200.0
    assert out["same"].performance_rating == "Excellent" and out["same"].cost_per_acquisition == 4.0
    direct = out["No Campaign Attribution"]
    assert direct.transactions == 2 and direct.roi_percentage is None and direct.performance_rating == "Direct Sales"
    # an unknown return sorts as 999
    assert [r.campaign_name for r in analytics.campaign_roi(w).collect()] == ["No Campaign Attribution", "same"]


def test_channels(shop, flat):
    out = rows_by(analytics.channel_performance(shop), "channel")
    total = sum(r["amount"] for r in flat)
    for channel, rows in group(flat, lambda r: r["m"].channel if r["m"] else "DIRECT").items():
        spend = sum(r["m"].actual_spend if r["m"] else 0 for r in rows)
        assert out[channel].total_spend == pytest.approx(float(spend))
        assert out[channel].unique_customers == len({r["customer_id"] for r in rows})
        assert out[channel].revenue_share_pct == pytest.approx(float(sum(r["amount"] for r in rows) / total * 100), abs=0.006)


def test_a_channel_that_spent_nothing(warehouse):
    w = warehouse(people("c"), [{"product_id": "p"}], [{"campaign_id": "1", "actual_spend": 0.0}], [{"campaign_id": "1"}])
    (row,) = analytics.channel_performance(w).collect()
    assert row.revenue_per_dollar_spent is None and row.total_spend == 0


def test_product_ranks(shop, flat):
    groups = {k: v for k, v in group(flat, lambda r: (r["p"].category, r["p"].brand)).items() if len(v) >= 10}
    revenue = {k: sum(r["amount"] for r in v) for k, v in groups.items()}
    units = {k: sum(r["quantity"] for r in v) for k, v in groups.items()}
    for top in (3, 25):
        out = {(r.category, r.brand): r for r in analytics.product_performance(shop, top=top).collect()}
        assert len(out) == min(top, len(groups))
        for key, row in out.items():
            assert row.revenue_rank == 1 + sum(v > revenue[key] for v in revenue.values())
            assert row.volume_rank == 1 + sum(v > units[key] for v in units.values())
            assert row.unique_buyers == len({r["customer_id"] for r in groups[key]})
            prices = [float(r["p"].price) for r in groups[key]]
            assert row.catalog_price == pytest.approx(sum(prices) / len(prices))


def test_inventory_classes(warehouse):
    rows = {"never": None, "dead": (91, 50), "slow": (80, 50), "regular": (60, 5), "fast": (30, 10), "few": (30, 4)}
    products = [{"product_id": k, "stock_quantity": s} for k, s in zip(rows, (0, 5, 20, 21, 1, 6))]
    sales = [{"product_id": k, "quantity": v[1], "transaction_date": day(v[0])} for k, v in rows.items() if v]
    w = warehouse(people("c"), products, [], sales)
    out = analytics.inventory_analysis(w, AS_OF).collect()
    assert {r.product_id: r.inventory_category for r in out} == {
        "never": "No Sales", "dead": "Dead Stock", "slow": "Slow Moving", "regular": "Regular Moving",
        "fast": "Fast Moving", "few": "Slow Moving",
    }
    assert {r.product_id: r.stock_status for r in out} == {
        "never": "Out of Stock", "dead": "Low Stock", "slow": "Normal Stock", "regular": "Overstocked",
        "fast": "Low Stock", "few": "Normal Stock",
    }
    assert [r.inventory_category for r in out][0] == "Fast Moving" and out[-1].product_id == "never"


def test_seasons(warehouse):
    one = warehouse(people("c"), [{"product_id": "p"}], [], [{"amount": 10.0}])
    (row,) = analytics.seasonal_analysis(one).collect()
    assert row.mom_revenue_growth_pct == 0 and row.growth_category == "Significant Decline"
    months = [(1, 100.0), (2, 120.0), (5, 126.0), (6, 119.7)]
    sales = [{"amount": a, "transaction_date": dt.datetime(2024, m, 2)} for m, a in months]
    out = analytics.seasonal_analysis(warehouse(people("c"), [{"product_id": "p"}], [], sales)).collect()
    assert [r.mom_revenue_growth_pct for r in out] == [0.0, 20.0, 5.0, -5.0]
    assert [r.growth_category for r in out] == ["Significant Decline", "High Growth", "Moderate Growth", "Stable"]
    assert [r.revenue_3month_avg for r in out] == [100.0, 110.0, 115.33, 121.9]


def test_cohorts(warehouse):
    customers = [{"customer_id": i, "registration_date": dt.date(2024, 3, 9)} for i in "abc"]
    sales = [
        {"customer_id": "a", "transaction_date": dt.datetime(2024, 2, 1)},
        {"customer_id": "a", "transaction_date": dt.datetime(2024, 3, 1)},
        {"customer_id": "b", "transaction_date": dt.datetime(2024, 3, 1)},
        {"customer_id": "b", "transaction_date": dt.datetime(2024, 11, 1)},
    ]
    w = warehouse(customers, [{"product_id": "p"}], [], sales)
    out = {r.period_number: r for r in analytics.cohort_analysis(w).collect()}
    assert set(out) == {-1, 0} and out[0].cohort_size == 3 and out[0].retention_rate == 66.67


def test_executive_summary(shop, flat):
    row = analytics.executive_summary(shop, AS_OF).first()
    recent = [r for r in flat if (AS_OF - r["transaction_date"]).days <= 30]
    assert row.total_transactions == len(flat) and row.transactions_last_30d == len(recent)
    assert row.active_campaigns == len({r["campaign_id"] for r in flat if r["m"]})
    assert row.products_sold == len({r["product_id"] for r in flat})


def test_empty_warehouse(warehouse):
    w = warehouse([{"customer_id": None}], [{"product_id": None}], [{"campaign_id": None}], [])
    row = analytics.executive_summary(w, AS_OF).first()
    assert row.total_transactions == 0 and row.avg_transaction_value_30d is None
    assert analytics.product_performance(w).count() == 0
    assert analytics.channel_performance(w).count() == 0
    assert validation.summary(w).first().customer_count == 0


def test_attribution(shop, flat):
    key = lambda r: (r["c"].country, r["p"].category, r["m"].channel if r["m"] else "DIRECT")
    groups = {k: v for k, v in group(flat, key).items() if len(v) >= 5}
    out = {(r.country, r.category, r.channel): r for r in analytics.attribution_matrix(shop, top=None).collect()}
    assert set(out) == set(groups)
    for k, rows in groups.items():
        assert out[k].transactions == len(rows)
        assert out[k].unique_customers == len({r["customer_id"] for r in rows})
        assert out[k].marketing_spend == pytest.approx(float(sum(r["m"].actual_spend if r["m"] else 0 for r in rows)))


def test_reports_agree_when_nothing_may_be_broadcast(spark, shop, monkeypatch):
    """The skew-safe shuffle plans give the same reports as broadcast plans."""
    reports = [
        analytics.campaign_roi, analytics.channel_performance, analytics.product_performance,
        analytics.attribution_matrix, lambda w: analytics.executive_summary(w, AS_OF),
        monitoring.outside_campaign_window,
    ]
    usual = [sorted(map(str, report(shop).collect())) for report in reports]
    # salt every key above a hundredth of the rows
    monkeypatch.setattr(joins.attach, "__defaults__", (None, 0.01, 1))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [sorted(map(str, report(shop).collect())) for report in reports] == usual
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_concurrent_campaigns(warehouse):
    campaigns = [
        {"campaign_id": "1", "start_date": day(20), "end_date": day(10)},
        {"campaign_id": "2", "start_date": day(10), "end_date": day(5)},
    ]
    out = rows_by(monitoring.concurrent_campaigns(warehouse([{"customer_id": "c"}], [{"product_id": "p"}], campaigns)), "day")
    assert [out[day(n).date()].active_campaigns for n in (20, 10, 9, 4)] == [1, 2, 1, 0]
    assert out[day(4).date()].status == "LOW"
