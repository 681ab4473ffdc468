import pytest

from tallyhouse.functions import rules
from tallyhouse.operators import cleaning, quality


@pytest.fixture
def text(source):
    rows = [
        {}, {}, {"order_item_id": "2", "quantity": "-1", "email": "bad", "price": "x"},
        {"order_item_id": "", "order_date": "soon", "city": "NULL", "total_amount": "0"},
        {"order_item_id": "", "signup_date": "2023-01-01", "email": ""},
    ]
    return source(*rows).transform(cleaning.normalise_nulls, rules.CSV_NULL_TOKENS)


def test_profile(text):
    assert tuple(quality.overview(text).first()) == (5, 14)
    nulls = {r["column_name"]: (r["null_count"], float(r["null_pct"])) for r in quality.null_profile(text).collect()}
    assert nulls == {"order_item_id": (2, 40.0), "city": (1, 20.0), "email": (1, 20.0)}
    assert quality.duplicate_profile(text).first().asDict() == {
        "full_row_duplicates": 1, "order_item_id_duplicates": 2, "distinct_orders": 1, "distinct_customers": 1, "distinct_products": 1,
    }
    numbers = {r["column_name"]: r for r in quality.numeric_profile(text).collect()}
    assert (numbers["quantity"]["negatives"], numbers["total_amount"]["zeros"], numbers["price"]["nulls"]) == (1, 1, 1)
    dates = quality.date_profile(text).first()
    assert (dates["bad_order_dates"], dates["bad_signup_dates"], dates["order_before_signup"]) == (1, 0, 1)
    shares = {(r["column_name"], r["value"]): float(r["share_pct"]) for r in quality.categorical_profile(text).collect()}
    assert shares == {("category", "Electronics"): 100.0, ("city", "Cairo"): 80.0}
    assert tuple(quality.email_profile(text).first()) == (2, 3)


def test_score(text, source):
    # 1 + 2 duplicates, 1 bad date, 2 bad addresses, 3 columns with nulls
    row = quality.quality_score(text).first()
    assert (row["total_issues"], row["score"], row["grade"]) == (9, 95.5, "A")
    many = source(*[{"order_item_id": str(i), "email": "bad"} for i in range(70)])
    assert quality.quality_score(many).first()["grade"] == "C"


def test_describe_all(spark):
    """Every column as pandas describes it, with ties, nulls, one value, none, and an empty frame."""
    import pandas as pd

    from tallyhouse.operators.describe import describe_all

    rows = [(i, i % 4 * 1.5 if i % 5 else None, f"t{i % 3}" if i % 2 else None, None, "same", 7) for i in range(23)]
    df = spark.createDataFrame(rows, "id long, amount double, label string, nothing string, one string, constant int")
    got = {r["column_name"]: r for r in describe_all(df.repartition(3)).collect()}
    frame = pd.DataFrame(rows, columns=df.columns)
    for c in ("id", "amount", "constant"):
        want, r = frame[c].dropna().astype(float).describe(), got[c]
        for name, field in (("count", "value_count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "q25"), ("50%", "q50"), ("75%", "q75"), ("max", "max")):
            assert abs(r[field] - want[name]) < 1e-9, (c, name)
        assert r["unique_values"] is r["top"] is None
    pick = lambda c: tuple(got[c][f] for f in ("value_count", "unique_values", "top", "freq", "mean"))
    assert pick("label") == (11, 3, "t0", 4, None) or pick("label") == (11, 3, "t1", 4, None)
    assert pick("one") == (23, 1, "same", 23, None) and pick("nothing") == (0, None, None, None, None)
    assert {r["value_count"] for r in describe_all(df.limit(0)).collect()} == {0}
