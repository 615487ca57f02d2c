from __future__ import annotations

import datetime as dt

from conftest import AS_OF, rows_by

from basketwork.operators import star


def test_customer_names_and_defaults(feed):
    out = rows_by(
        star.dim_customers(
            feed(
                "customers",
                {"customer_id": "1", "first_name": " jean-paul", "last_name": "o'brien\t", "city": "new york", "country": " it "},
                {"customer_id": "2", "registration_date": None, "age": None},
                {"customer_id": None},
            )
        ),
        "customer_id",
    )
    assert set(out) == {"1", "2"}
    assert (out["1"].first_name, out["1"].last_name, out["1"].city, out["1"].country) == (
        "Jean-Paul", "O'brien", "New York", "IT",
    )
    assert (out["2"].first_name, out["2"].last_name, out["2"].address, out["2"].country) == (
        "Unknown", "Unknown", "Not Provided", "UNKNOWN",
    )
    assert out["2"].age == 30 and out["2"].registration_date == dt.date(1900, 1, 1)
    assert len(out["1"]) == 14


def test_email_is_tested_as_delivered(feed):
    out = rows_by(
        star.dim_customers(
            feed(
                "customers",
                {"customer_id": "1", "email": " User@X.io "},
                {"customer_id": "2", "email": "User@X.io"},
                {"customer_id": "3", "email": "user@x.io\n"},
                {"customer_id": "4", "email": None},
                {"customer_id": "5", "email": "user@x"},
            )
        ),
        "customer_id",
    )
    assert set(out) == {"2"} and out["2"].email == "user@x.io" and out["2"].email_valid


def test_ages_and_phones(feed):
    ages = {"1": -1, "2": 121, "3": None, "4": 0, "5": 120}
    phones = {"1": "+39 (02) 55.x12", "2": "12345", "3": None, "4": " 123456789 ", "5": "1234567890"}
    out = rows_by(
        star.dim_customers(feed("customers", *[{"customer_id": k, "age": ages[k], "phone": phones[k]} for k in ages])),
        "customer_id",
    )
    assert [out[k].age for k in "12345"] == [30, 30, 30, 0, 120]
    assert [out[k].phone for k in "12345"] == ["+39 (02) 5512", "12345", "Not Provided", "123456789", "1234567890"]
    assert [out[k].phone_valid for k in "12345"] == [True, False, False, False, True]


def test_customer_dedupe_ranks_before_the_email_test(feed):
    old, new = dt.date(2020, 1, 1), dt.date(2024, 1, 1)
    out = rows_by(
        star.dim_customers(
            feed(
                "customers",
                {"customer_id": "1", "email": None, "registration_date": new},
                {"customer_id": "1", "email": "b@c.io", "registration_date": old},
                {"customer_id": "2", "email": "broken", "registration_date": new},
                {"customer_id": "2", "email": "b@c.io", "registration_date": old},
                {"customer_id": "3", "email": "a@c.io", "phone": None, "registration_date": new},
                {"customer_id": "3", "email": "b@c.io", "registration_date": old},
                {"customer_id": "4", "email": "old@c.io", "registration_date": None},
                {"customer_id": "4", "email": "new@c.io", "registration_date": old},
            )
        ),
        "customer_id",
    )
    assert {k: v.email for k, v in out.items()} == {"1": "b@c.io", "3": "b@c.io", "4": "new@c.io"}


def test_product_prices(feed):
    cases = {"USD": 10.0, "GBP": 10.0, "EUR": 10.005, None: 10.0}
    rows = [{"product_id": str(c), "currency": c, "price": p} for c, p in cases.items()]
    rows += [{"product_id": "zero", "price": 0.0}, {"product_id": "null", "price": None}]
    out = rows_by(star.dim_products(feed("products", *rows)), "product_id")
    assert float(out["USD"].price) == 8.5 and float(out["GBP"].price) == 11.5
    assert float(out["EUR"].price) == 10.005 and float(out["None"].price) == 10.0
    assert float(out["zero"].price) == 0 and float(out["null"].price) == 0
    assert not out["zero"].price_valid and not out["null"].price_valid and out["USD"].price_valid
    assert {r.currency for r in out.values()} == {"EUR"}


def test_product_rates_are_a_parameter(feed):
    out = star.dim_products(feed("products", {"product_id": "1", "currency": "CHF"}), rates={"CHF": "0.5"}).first()
    assert float(out.price) == 5.0


def test_product_clamps_and_flags(feed):
    out = rows_by(
        star.dim_products(
            feed(
                "products",
                {"product_id": "1", "rating": 5.01, "stock_quantity": -3, "weight_kg": 0.0, "reviews_count": None},
                {"product_id": "2", "rating": -1.0, "name": "  ", "category": None, "availability": None},
                {"product_id": "3", "rating": None, "weight_kg": 1.23456, "brand": "acme-tools", "name": None},
                {"product_id": "4", "rating": 4.456},
            )
        ),
        "product_id",
    )
    assert [out[k].rating for k in "1234"] == [0.0, 0.0, 0.0, 4.46]
    assert out["1"].stock_quantity == 0 and out["1"].weight_kg is None and out["1"].reviews_count == 0
    assert not out["2"].name_valid and not out["2"].category_valid and out["2"].category == "UNCATEGORIZED"
    assert out["2"].availability is False and out["2"].name == ""
    assert out["3"].weight_kg == 1.235 and out["3"].brand == "Acme-Tools" and out["3"].name == "Unknown Product"
    assert out["4"].subcategory == "GENERAL" and out["4"].description == "No description available"


def test_product_dedupe(feed):
    out = rows_by(
        star.dim_products(
            feed(
                "products",
                {"product_id": "1", "name": None},
                {"product_id": "1", "name": "named", "price": None},
                {"product_id": "1", "name": "priced", "price": 1.0, "availability": None},
                {"product_id": "1", "name": "stocked", "price": 1.0, "availability": True},
            )
        ),
        "product_id",
    )
    assert out["1"].name == "stocked"


def test_campaign_dates_and_duration(feed):
    start = dt.datetime(2024, 6, 10)
    rows = {
        "reversed": {"start_date": start, "end_date": dt.datetime(2024, 6, 1)},
        "open": {"start_date": start, "end_date": None},
        "endless": {"start_date": start, "end_date": dt.datetime(2099, 12, 31)},
        "undated": {"start_date": None, "end_date": start},
    }
    out = rows_by(
        star.dim_campaigns(feed("marketing_campaigns", *[{"campaign_id": k, **v} for k, v in rows.items()]), AS_OF),
        "campaign_id",
    )
    assert out["reversed"].end_date == dt.date(2024, 6, 10) and out["reversed"].campaign_duration_days == -9
    assert out["open"].end_date == dt.date(2099, 12, 31) and out["open"].campaign_duration_days is None
    assert out["endless"].campaign_duration_days == 20
    assert out["undated"].start_date == dt.date(1900, 1, 1) and out["undated"].end_date == dt.date(2024, 6, 10)
    assert out["undated"].campaign_duration_days is None


def test_campaign_flags_and_ratios(feed):
    rows = [
        {"campaign_id": "1", "status": None, "budget": 10.0, "actual_spend": 11.0, "clicks": 3, "conversions": 1},
        {"campaign_id": "2", "status": "active", "budget": 0.0, "actual_spend": 5.0, "clicks": 0, "conversions": 2},
        {"campaign_id": "3", "status": "ACTIVE", "budget": -5.0, "actual_spend": None, "conversion_rate": 1.1},
        {"campaign_id": "4", "conversion_rate": 0.12345, "impressions": -1, "name": " ", "channel": None},
    ]
    out = rows_by(star.dim_campaigns(feed("marketing_campaigns", *rows), AS_OF), "campaign_id")
    assert [out[k].status_valid for k in "123"] == [True, False, True]
    assert [out[k].status for k in "123"] == ["DRAFT", "ACTIVE", "ACTIVE"]
    assert out["1"].over_budget and out["1"].spend_percentage == 110.0
    assert out["1"].calculated_conversion_rate == 33.3333
    assert not out["2"].over_budget and out["2"].spend_percentage is None
    assert out["2"].calculated_conversion_rate is None
    assert float(out["3"].budget) == 0 and float(out["3"].actual_spend) == 0 and out["3"].conversion_rate is None
    assert out["4"].conversion_rate == 0.1235 and out["4"].impressions == 0
    assert not out["4"].name_valid and not out["4"].channel_valid and out["4"].channel == "UNKNOWN"


def test_campaign_dedupe(feed):
    new, old = dt.datetime(2024, 1, 1), dt.datetime(2020, 1, 1)
    rows = [
        {"campaign_id": "1", "status": "PAUSED", "start_date": new, "name": "late"},
        {"campaign_id": "1", "status": "COMPLETED", "start_date": old, "name": "done"},
        {"campaign_id": "2", "status": "ACTIVE", "start_date": old, "name": "old"},
        {"campaign_id": "2", "status": "ACTIVE", "start_date": new, "name": "new"},
    ]
    out = rows_by(star.dim_campaigns(feed("marketing_campaigns", *rows), AS_OF), "campaign_id")
    assert out["1"].name == "done" and out["2"].name == "new"


def _fact(feed, *sales, **options):
    c = star.dim_customers(feed("customers", {"customer_id": "c"}))
    p = star.dim_products(feed("products", {"product_id": "p"}))
    return rows_by(star.fact_sales(feed("sales_transactions", *sales), c, p, **options), "transaction_id")


def test_fact_campaigns(feed):
    sales = [{"transaction_id": str(i), "campaign_id": c} for i, c in enumerate([None, "", "C1"])]
    assert [r.campaign_id for _, r in sorted(_fact(feed, *sales).items())] == ["NO_CAMPAIGN", "", "C1"]
    out = _fact(feed, *sales, empty_campaign_as_null=True)
    assert [r.campaign_id for _, r in sorted(out.items())] == ["NO_CAMPAIGN", "NO_CAMPAIGN", "C1"]


def test_fact_measures_and_filters(feed):
    out = _fact(
        feed,
        {"transaction_id": "1", "quantity": 0, "unit_price": -1.0},
        {"transaction_id": "2", "amount": None},
        {"transaction_id": "3", "customer_id": "nobody"},
        {"transaction_id": "4", "product_id": "nothing"},
        {"transaction_id": "5", "campaign_id": "unknown"},
        {"transaction_id": "6", "status": "cancelled"},
        {"transaction_id": "7", "status": "refunded"},
        {"transaction_id": "8", "status": None, "payment_method": None, "transaction_date": None},
        {"transaction_id": None},
    )
    assert set(out) == {"1", "5", "8"}
    assert out["1"].quantity == 1 and float(out["1"].unit_price) == 0 and out["1"].discount_percentage is None
    assert out["8"].status == "PENDING" and out["8"].payment_method == "UNKNOWN"
    assert out["8"].transaction_date == dt.date(1900, 1, 1)
    assert len(out["1"]) == 22


def test_fact_amount_check(feed):
    base = {"quantity": 3, "unit_price": 10.0, "discount_amount": 2.0, "tax_amount": 1.5}
    out = _fact(
        feed,
        {"transaction_id": "1", **base, "amount": 29.51},
        {"transaction_id": "2", **base, "amount": 29.52},
        {"transaction_id": "3", **base, "amount": 29.5, "payment_method": "iou"},
    )
    assert [out[k].amount_calculation_valid for k in "123"] == [True, False, True]
    assert float(out["1"].calculated_gross_amount) == 30 and float(out["1"].calculated_total_amount) == 29.5
    assert out["3"].discount_percentage == 6.67 and out["3"].tax_rate == 5.36
    assert out["1"].payment_method_valid and not out["3"].payment_method_valid


def test_fact_dedupe(feed):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    out = _fact(
        feed,
        {"transaction_id": "1", "status": "completed", "transaction_date": old, "amount": 1.0},
        {"transaction_id": "1", "status": "pending", "transaction_date": new, "amount": 2.0},
        {"transaction_id": "2", "status": "COMPLETED", "transaction_date": old, "amount": 1.0},
        {"transaction_id": "2", "status": "PENDING", "transaction_date": new, "amount": 2.0},
        # the best row is chosen first: its cancelled status then drops the sale
        {"transaction_id": "3", "status": "cancelled", "transaction_date": new},
        {"transaction_id": "3", "status": "completed", "transaction_date": old},
    )
    assert {k: float(v.amount) for k, v in out.items()} == {"1": 2.0, "2": 1.0}


def test_fk_flags(feed):
    c = star.dim_customers(feed("customers", {"customer_id": "c"}))
    p = star.dim_products(feed("products", {"product_id": "p"}))
    m = star.dim_campaigns(feed("marketing_campaigns", {"campaign_id": "m"}), AS_OF)
    sales = feed(
        "sales_transactions",
        {"transaction_id": "1", "campaign_id": None},
        {"transaction_id": "2", "campaign_id": "", "customer_id": None},
        {"transaction_id": "3", "campaign_id": "m", "product_id": "x"},
        {"transaction_id": "4", "campaign_id": "x"},
    )
    out = rows_by(star.fk_flags(sales, c, p, m), "transaction_id")
    shown = {k: (v.customer_exists, v.product_exists, v.campaign_exists) for k, v in out.items()}
    assert shown == {
        "1": (True, True, True), "2": (False, True, True), "3": (True, False, True), "4": (True, True, False),
    }


def test_reruns_keep_the_same_tied_row(feed):
    rows = [{"product_id": "1", "description": str(i), "currency": None} for i in range(20)]
    first = star.dim_products(feed("products", *rows)).first().description
    second = star.dim_products(feed("products", *reversed(rows)).repartition(4)).first().description
    assert first == second == "0"
