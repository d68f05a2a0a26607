from factories import bronze

from tillstream.operators import amounts
from tillstream.operators.validation import check_values, layer_counts
from tillstream.schemas import CLICKS, INVENTORY, ORDERS


def priced(spark, price, quantity, **stored):
    return bronze(spark, "orders", {"product": ("S", "L", "H", price), "quantity": quantity, **stored})


def test_price_is_rounded_with_the_quantity_only(spark):
    row = amounts.derive_order_amounts(priced(spark, 0.335, 2)).first()
    assert (row.subtotal, row.total_amount) == (0.67, 0.67)
    right = priced(spark, 0.335, 2, subtotal=0.67, discount_amount=0.0, total_amount=0.67)
    assert amounts.check_amounts(right).count() == 0
    wrong = priced(spark, 0.335, 2, subtotal=0.68, discount_amount=0.0, total_amount=0.68)
    assert amounts.check_amounts(wrong).first().subtotal_ok is False


def test_alert_follows_the_threshold_of_the_update(spark):
    rows = bronze(
        spark,
        "inventory",
        {"stock_level": 60, "reorder_threshold": 100, "low_stock_alert": True},
        {"stock_level": 60, "reorder_threshold": 100, "low_stock_alert": False},
        {"stock_level": 49, "reorder_threshold": None, "low_stock_alert": True},
        {"stock_level": 50, "reorder_threshold": None, "low_stock_alert": True},
        {"stock_level": 30, "reorder_threshold": 20, "low_stock_alert": None},
    )
    wrong = sorted(r.event_id for r in amounts.check_low_stock(rows).collect())
    assert wrong == ["EVT-001", "EVT-003", "EVT-004"]
    assert amounts.check_low_stock(amounts.derive_low_stock(rows)).count() == 0


def test_values_outside_their_sets(spark):
    orders = bronze(
        spark,
        "orders",
        {"status": " COMPLETED ", "currency": "usd", "payment_method": "PayPal "},
        {"status": "refunded", "region": "europe"},
        {"payment_method": None, "region": None},
        {"currency": "EUR"},
    )
    found = {r.event_id: r.wrong_values for r in check_values(orders, ORDERS).collect()}
    assert found == {"EVT-001": ["region", "status"], "EVT-003": ["currency"]}
    clicks = bronze(spark, "clicks", {"page": "HOMEPAGE"}, {"page": "checkout"})
    assert [r.event_id for r in check_values(clicks, CLICKS).collect()] == ["EVT-001"]
    stock = bronze(spark, "inventory", {"action": "Return"}, {"action": ""})
    assert [r.event_id for r in check_values(stock, INVENTORY).collect()] == ["EVT-001"]


def test_layers_are_counted_in_one_pass(spark):
    rows = bronze(spark, "orders", {}, {}, {"event_id": "EVT-000"}, {"order_id": None}, {"event_id": None})
    counts = layer_counts(rows, ORDERS)
    assert tuple(counts.first()) == (5, 3, 2, 2)
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
