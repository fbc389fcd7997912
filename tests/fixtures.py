"""Bronze rows for tests: plain makers and a seeded generator with every kind of defect."""

import random

from strata.sources.schemas import ORDER_ITEMS_BRONZE, ORDERS_BRONZE

DAY = "2017-06-{:02d} {:02d}:15:00"


def orders(spark, rows):
    """rows: (order_id, customer_id, status, purchase, approved, carrier, customer, estimated)."""
    return spark.createDataFrame(rows, ORDERS_BRONZE)


def order(order_id, status="delivered", purchase="2017-06-01 12:00:00", customer="buyer"):
    return (order_id, customer, status, purchase, None, None, None, None)


def items(spark, rows):
    return spark.createDataFrame(rows, ORDER_ITEMS_BRONZE)


def item(order_id="A", item_id="1", product_id="lamp", seller="shop",
         shipping="2017-06-03 12:00:00", price="8.40", freight="1.10"):
    return (order_id, item_id, product_id, seller, shipping, price, freight)


def random_items(seed, n=200):
    """Item rows in which keys repeat, prices vary, and some values are NULL, negative, unreadable or out of period."""
    rng = random.Random(seed)
    pick = lambda good, odd: rng.choice(odd) if rng.random() < 0.15 else good
    return [item(
        pick(f"K{rng.randrange(40)}", [None, "stray"]), pick(str(rng.randint(1, 4)), [None, "two"]),
        pick(f"P{rng.randrange(6)}", [None]), f"S{rng.randrange(3)}",
        pick(DAY.format(rng.randint(1, 28), rng.randrange(24)), [None, "soon", "2031-01-01 00:00:00", "1999-12-31 23:59:59"]),
        pick(f"{rng.randint(0, 3)}.50", [None, "free", "-2.25", "0.00"]), f"{rng.randint(0, 2)}.00") for _ in range(n)]


def random_orders(seed, n=60):
    rng = random.Random(seed)
    return [order(rng.choice([f"K{rng.randrange(50)}", f"K{rng.randrange(50)}", None]),
                  rng.choice(["delivered", "open", None]),
                  rng.choice([DAY.format(rng.randint(1, 28), 9), "never", None])) for _ in range(n)]
