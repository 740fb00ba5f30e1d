"""Hand-made report tables for the tests."""

import datetime as dt
from decimal import Decimal

from ordertally import schema as S


def D(s):
    return dt.date.fromisoformat(s)


def M(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


ORDER_DEFAULTS = dict(
    wp_id=None, customer_id=1, store_id=81, delivery_date=D("2025-01-02"), created_date=D("2025-01-01"),
    delivery_window=1, status=0, clearing_status="OK", dhl_package_number="DHL", is_deleted=False,
    sum=M(10), discount_sum=M(0), discount_promotions=M(0), coupons=None, first_name="A", last_name="B",
    phone="050", city="TLV", packing_worker_id=1, dispatcher_worker_id=2,
)
LINE_DEFAULTS = dict(
    product_id=1, quantity_needed=2, quantity=2, quantity_delivered=2, quantity_replaceable=0, unit_price=M(5)
)
PRODUCT_DEFAULTS = dict(
    name="apple", name_heb="H apple", name_weight="apple 1", price=M(5), low_cost_price=M(4),
    category_id=1, packing_action=1, product_list="fruit",
)


def rows(schema, defaults, items):
    out = []
    for item in items:
        rec = {**defaults, **item}
        out.append(tuple(rec.get(f.name) for f in schema.fields))
    return out


def make_tables(spark, orders=(), lines=(), products=None, categories=None, store=None, workers=None,
                cities=None, city_groups=None):
    """Hand-made report tables; unspecified dimensions get small defaults."""
    products = products if products is not None else [{"id": 1}, {"id": 2, "name": "pear", "packing_action": 2}]
    categories = categories if categories is not None else [(1, "fruit")]
    store = store if store is not None else [(81, "north"), (82, "south"), (84, "east"), (85, "west")]
    workers = workers if workers is not None else [(1, "W1", "X1"), (2, "W2", "X2")]
    cities = cities if cities is not None else [("TLV", 1), ("HFA", 2)]
    city_groups = city_groups if city_groups is not None else [(1, "center"), (2, "")]
    data = {
        "orders": rows(S.ORDERS, ORDER_DEFAULTS, orders),
        "order_product": rows(S.ORDER_PRODUCT, LINE_DEFAULTS, lines),
        "products": rows(S.PRODUCTS, PRODUCT_DEFAULTS, products),
        "categories": list(categories),
        "store": list(store),
        "workers": list(workers),
        "cities": list(cities),
        "city_groups": list(city_groups),
    }
    return {k: spark.createDataFrame(v, S.SCHEMAS[k]) for k, v in data.items()}
