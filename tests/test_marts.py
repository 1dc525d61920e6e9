from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from quitanda.functions.money import currency_mean, currency_sum
from quitanda.operators.fact import fact_rows
from quitanda.operators.lookups import BROADCAST_BYTES
from quitanda.plans import marts
from quitanda.plans.populate import load_dimensions
from tests.helpers import STAGED, staged_rows

MONEY = 100


@pytest.fixture
def loaded(spark, warehouse):
    def load(*changes):
        batch = staged_rows(spark, *changes)
        load_dimensions(warehouse, batch)
        return fact_rows(batch, warehouse.dimensions()), warehouse.dimensions()

    return load


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_seller_without_any_price_ranks_first(loaded):
    star = loaded({"seller_name": "ana"}, {"seller_name": "zoe", "price_cents": None})
    assert rows(marts.top_sellers(*star)) == [("zoe", 1, None), ("ana", 1, 11.0)]


def test_equal_totals_are_ordered_by_name(loaded):
    star = loaded(*[{"seller_name": f"s{i:02d}"} for i in random.Random(3).sample(range(20), 20)])
    assert [r[0] for r in rows(marts.top_sellers(*star))] == [f"s{i:02d}" for i in range(10)]
    assert [r[0] for r in rows(marts.top_sellers(*star, k=3))] == ["s00", "s01", "s02"]


def test_no_instalments_and_zero_instalments_are_one_group(loaded):
    star = loaded({"installments_quantity": None}, {"installments_quantity": 0}, {})
    assert rows(marts.payment_distribution(*star)) == [
        ("boleto", 0, 2, 22.0, 11.0),
        ("boleto", 1, 1, 11.0, 11.0),
    ]


def test_weekend(loaded):
    star = loaded(*[{"purchase_date": date(2024, 5, d)} for d in (3, 4, 5)])
    assert rows(marts.weekend_vs_weekday(*star)) == [
        ("Dia Útil", 1, 11.0, 11.0),
        ("Fim de Semana", 2, 22.0, 11.0),
    ]


def test_sale_without_price_counts_but_adds_nothing(loaded):
    star = loaded({}, {"price_cents": None}, {"shipping_cost_cents": None})
    assert rows(marts.sales_by_category(*star)) == [("eletronicos", 3, 20.0, 21.0, 10.5)]


def test_unknown_members_are_left_out(loaded):
    star = loaded({}, {"category_name": "outros"}, {"seller_name": "vendedor desconhecido"})
    assert [r[1] for r in rows(marts.sales_by_category(*star))] == [2]
    assert [r[1] for r in rows(marts.top_sellers(*star))] == [2]
    assert [r[2] for r in rows(marts.top_products(*star))] == [2]
    assert [r[4] for r in rows(marts.seller_monthly(*star))] == [2]
    assert [r[2] for r in rows(marts.rating_by_category(*star))] == [2]


def test_no_sales_no_rows(loaded):
    star = loaded({"purchase_date": None})
    for mart in marts.MARTS.values():
        assert rows(mart(*star)) == []


def random_sales(n):
    dice = random.Random(7)
    names = ["ana", "bia", "caio", "vendedor desconhecido"]
    for _ in range(n):
        yield {
            "product_name": dice.choice(["tv", "mesa", "nome indisponível"]),
            "category_name": dice.choice(["casa", "som", "outros"]),
            "price_cents": dice.choice([None, *range(100, 100000, 777)]),
            "shipping_cost_cents": dice.choice([None, *range(0, 9000, 311)]),
            "purchase_date": date(2023, 11, 1) + timedelta(dice.randrange(200)),
            "seller_name": names[min(dice.randrange(6), 3)],
            "purchase_location_code": dice.choice(["sp", "rj", "n/a"]),
            "purchase_rating": dice.choice([None, 1, 2, 5]),
            "payment_type": dice.choice(["pix", "boleto", "não especificado"]),
            "installments_quantity": dice.choice([None, 0, 1, 6]),
        }


def by_group(sales, key):
    groups = defaultdict(list)
    for sale in sales:
        if (group := key(sale)) is not None:
            groups[group].append(sale)
    return groups


def total(sale):
    if sale["price_cents"] is None:
        return None
    return sale["price_cents"] + (sale["shipping_cost_cents"] or 0)


def money(values):
    known = [v for v in values if v is not None]
    return sum(known) / MONEY if known else None


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) / MONEY if known else None


MONTHS = "January February March April May June July August September October November December"


@pytest.mark.parametrize("byte_limit", [0, BROADCAST_BYTES])
def test_marts_equal_brute_force(loaded, monkeypatch, byte_limit):
    """Every mart, with the calendar broadcast or joined after the first sum."""
    monkeypatch.setattr(marts, "fits_broadcast", lambda frame: byte_limit > 0)
    sales = [STAGED | change for change in random_sales(600)]
    star = loaded(*sales)
    result = {name: rows(mart(*star)) for name, mart in marts.MARTS.items()}

    def category(sale):
        if "nome indisponível" in sale.values() or sale["category_name"] == "outros":
            return None
        return sale["category_name"]

    def unless(marker, value):
        return None if value == marker else value

    def seller(sale):
        return unless("vendedor desconhecido", sale["seller_name"])

    def place(sale):
        return unless("n/a", sale["purchase_location_code"])

    def month(sale):
        day = sale["purchase_date"]
        return day.year, day.month, MONTHS.split()[day.month - 1].ljust(9)

    def sums(group):
        return len(group), money(map(total, group))

    def falling(table, column):
        return sorted(table, key=lambda r: (r[column] is not None, -(r[column] or 0), r[0]))

    groups = by_group(sales, category).items()
    expected = [
        (k, len(g), money(s["price_cents"] for s in g), money(map(total, g)), mean(map(total, g)))
        for k, g in groups
    ]
    assert result["mart_01_sales_by_category"] == falling(expected, 3)

    groups = by_group(sales, month).items()
    assert result["mart_02_monthly_sales"] == sorted((*k, *sums(g)) for k, g in groups)

    expected = [(k, *sums(g)) for k, g in by_group(sales, seller).items()]
    assert result["mart_03_top_sellers"] == falling(expected, 2)[:10]

    expected = []
    for k, g in by_group(sales, place).items():
        ratings = [s["purchase_rating"] for s in g if s["purchase_rating"] is not None]
        expected.append((k, *sums(g), sum(ratings) / len(ratings)))
    assert result["mart_04_sales_by_location"] == falling(expected, 2)

    def payment(sale):
        kind = unless("não especificado", sale["payment_type"])
        return None if kind is None else (kind, sale["installments_quantity"] or 0)

    expected = [(*k, *sums(g), mean(map(total, g))) for k, g in by_group(sales, payment).items()]
    assert result["mart_05_payments"] == sorted(expected)

    def quarter(sale):
        return sale["purchase_date"].year, (sale["purchase_date"].month + 2) // 3

    groups = by_group(sales, quarter).items()
    assert result["mart_06_quarterly_sales"] == sorted((*k, *sums(g)) for k, g in groups)

    def rated(sale):
        rating = sale["purchase_rating"]
        return None if category(sale) is None or rating is None else (category(sale), rating)

    expected = sorted((*k, len(g)) for k, g in by_group(sales, rated).items())
    assert result["mart_07_rating_by_category"] == expected

    expected = []
    for k, g in by_group(sales, place).items():
        freight = [s["shipping_cost_cents"] for s in g if s["shipping_cost_cents"] is not None]
        lowest, highest = min(freight) / MONEY, max(freight) / MONEY
        expected.append((k, mean(freight), lowest, highest, money(freight)))
    assert result["mart_08_freight_by_location"] == falling(expected, 1)

    def kind(sale):
        return "Fim de Semana" if sale["purchase_date"].weekday() >= 5 else "Dia Útil"

    expected = [(k, *sums(g), mean(map(total, g))) for k, g in by_group(sales, kind).items()]
    assert result["mart_09_weekend_vs_weekday"] == sorted(expected)

    def product(sale):
        return None if category(sale) is None else (sale["product_name"], category(sale))

    expected = [(*k, *sums(g)) for k, g in by_group(sales, product).items()]
    assert result["mart_10_top_products"] == falling(expected, 3)[:5]

    def seller_month(sale):
        return None if seller(sale) is None else (*month(sale), seller(sale))

    groups = by_group(sales, seller_month).items()
    assert result["mart_11_seller_monthly"] == sorted((*k, *sums(g)) for k, g in groups)


def test_sums_agree_across_marts(loaded):
    star = loaded(*random_sales(300))
    totals = {
        name: sum(r[column] for r in rows(marts.MARTS[name](*star)))
        for name, column in (
            ("mart_02_monthly_sales", 4),
            ("mart_06_quarterly_sales", 3),
            ("mart_09_weekend_vs_weekday", 2),
        )
    }
    assert len({round(value, 2) for value in totals.values()}) == 1
    unknown = star[0].where("sk_produto = -1").count()
    counted = sum(r[1] for r in rows(marts.sales_by_category(*star)))
    assert counted + unknown == star[0].count() == 300


def test_large_sums_do_not_overflow(spark):
    sums = spark.createDataFrame([(9 * 10**18, 1)] * 2, "total bigint, totals bigint")
    row = sums.agg(currency_sum("total"), currency_mean("total", "totals")).first()
    assert tuple(row) == (1.8e17, 9e16)


BY_CATEGORY = ("mart_01_sales_by_category", "mart_07_rating_by_category")


def test_fact_is_summed_before_the_join(loaded):
    fact, dims = loaded({})
    for name, mart in marts.MARTS.items():
        if name in (*BY_CATEGORY, "mart_11_seller_monthly"):
            continue
        plan = mart(fact, dims)._jdf.queryExecution().optimizedPlan().toString()
        join = plan.index("Join Inner")
        assert "Aggregate [sk_" in plan[join:], name


@pytest.mark.parametrize("name", BY_CATEGORY)
def test_categories_are_shuffled_and_not_products(loaded, monkeypatch, name):
    fact, dims = loaded({}, {"purchase_rating": 1}, {"product_name": "b", "category_name": "c2"})

    def plan_and_rows():
        report = marts.MARTS[name](fact, dims)
        return report._jdf.queryExecution().optimizedPlan().toString(), rows(report)

    joined_first, small = plan_and_rows()
    assert "Aggregate [sk_" not in joined_first
    monkeypatch.setattr(marts, "fits_broadcast", lambda frame: False)
    summed_first, large = plan_and_rows()
    assert "Aggregate [sk_produto" in summed_first
    assert small == large
