import re

from bindings.registry import comparable
from bindings.tables import SOLD
from loyaltide.operators import orders, skew


def aggregates(t, hot=None):
    return {
        "payments": orders.payments_per_order(t.payments, hot), "items": orders.items_per_order(t.items, hot),
        "reviews": orders.best_review(t.reviews, hot),
        "categories": orders.items_by_category(t.items, t.products, t.category, hot)}


def test_rows_of_an_order_are_brought_together_before_they_are_combined(tables, plan):
    """Combining before the shuffle held about a group a row in the memory of map tasks, and spilled."""
    found = {name: plan(df).split("== Physical Plan ==")[-1].count("Exchange hashpartitioning(order_id") for name, df in aggregates(tables, []).items()}
    assert found == {"payments": 1, "items": 2, "reviews": 1, "categories": 1}
    for df in aggregates(tables, []).values():
        text = plan(df).split("== Physical Plan ==")[-1]
        assert text.count("REPARTITION_BY_COL") == text.count("Exchange hashpartitioning(order_id")


def test_hot_orders_are_found_and_combined_alike(spark, tables, rows, monkeypatch):
    plain = {name: rows(df) for name, df in aggregates(tables, []).items()}
    first = tables.items.orderBy("order_id").first()["order_id"]
    heavy = tables.items.select("order_id").union(spark.range(200).selectExpr(f"{first}L"))
    monkeypatch.setattr(orders, "HOT_SHARE", 0.02)
    assert orders.hot_orders(heavy) == []
    monkeypatch.setattr(orders, "HOT_ROWS", 100)
    assert orders.hot_orders(heavy) == [first]
    assert orders.hot_orders(heavy.selectExpr(f"nullif(order_id, {first}) AS order_id")) == [None]
    assert {name: rows(df) for name, df in aggregates(tables, [first]).items()} == plain
    wide = orders.order_wide(
        tables.orders, tables.customers, tables.items, tables.payments, tables.reviews, tables.products, tables.category, SOLD)
    monkeypatch.setattr(orders, "hot_orders", lambda *_: [first])
    with_hot = orders.order_wide(
        tables.orders, tables.customers, tables.items, tables.payments, tables.reviews, tables.products, tables.category, SOLD)
    assert rows(with_hot) == rows(wide)


def test_rows_without_an_order_form_one_group(spark, rows):
    items = spark.createDataFrame(
        [(None, 1, 5, 7, 1.0, 0.5), (None, 2, 6, 7, 2.0, 0.5), (3, 1, None, 8, 4.0, 0.0)],
        "order_id int, order_item_id int, product_id int, seller_id int, price double, freight_value double")
    wanted = sorted([(None, 2, 3.0, 1.0, 1.5, 2, 1), (3, 1, 4.0, 0.0, 4.0, 0, 1)], key=repr)
    for hot in ([], [None], [3], [3, None]):
        assert rows(orders.items_per_order(items, hot)) == wanted


def test_tasks_by_order_follow_the_rows(tables, plan, rows, monkeypatch):
    """With the session's partitions alone tasks of a larger input got more rows than fit their memory, and spilled."""
    plain = {name: rows(comparable(df, 6)) for name, df in aggregates(tables, []).items()}
    monkeypatch.setattr(skew, "TASK_ROWS", orders.most_rows(tables.items) // 20)
    dealt = aggregates(tables, [])
    for df in dealt.values():
        text = plan(df).split("== Physical Plan ==")[-1]
        assert re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, (\d+)\), (\w+)", text) == \
            [("20", "REPARTITION_BY_NUM")] * text.count("Exchange hashpartitioning(order_id")
    assert {name: rows(comparable(df, 6)) for name, df in dealt.items()} == plain
    wide = plan(tables.build_wide()).split("== Physical Plan ==")[-1]
    # The aggregates by order meet the orders, and all of them the latest delivery, in equal partitions.
    assert set(re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, (\d+)\)", wide)) == {"20"}
