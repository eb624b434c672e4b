"""Ordered updates against a plain replay: replayed at once, by rounds with the progress rule, by rounds to the end."""

import random
from decimal import Decimal

import pytest

from ledgerloom.operators import folds

# Folded at once, by rounds until a group fits, by rounds to the end.
FORMS = [(1000, 100), (20, 4), (0, 7)]


def make_requests(seed, count, stores, products, biggest):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(stores), rng.randrange(products), rng.randint(1, biggest)) for i in range(count)]
    # A third of all requests hit one shelf.
    rows += [(count + i, 0, 0, rng.randint(1, biggest)) for i in range(count // 2)]
    rng.shuffle(rows)
    return rows


def replay_reserve(rows, stock):
    left, out = dict(stock), {}
    for request, store, product, qty in sorted(rows):
        have = left.get((store, product), 0)
        ok = have >= qty
        if ok:
            left[store, product] = have - qty
        out[request] = ("ACCEPTED" if ok else "REFUSED", left.get((store, product), 0))
    return out


@pytest.mark.parametrize("lines_at_once,run_length", FORMS)
def test_reserve_stock(spark, lines_at_once, run_length):
    rows = make_requests(1, 240, 3, 5, 9)
    stock = {(s, p): 40 for s in range(3) for p in range(5) if (s, p) != (2, 4)}
    requests = spark.createDataFrame(rows, "request_id int, store_id int, product_id int, qty int")
    inventory = spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], "store_id int, product_id int, stock int")
    got = folds.reserve_stock(requests, inventory, ["request_id"], lines_at_once, run_length).collect()
    assert {r.request_id: (r.outcome, r.stock_after) for r in got} == replay_reserve(rows, stock)
    assert all(r.stock_after >= 0 for r in got)
    assert len(got) == len(rows)


def test_reserve_with_small_requests_after_refused_ones(spark):
    # Each refusal leaves room that only a later, smaller request fits.
    rows = [(i, 0, 0, q) for i, q in enumerate([1, 100, 1, 99, 1, 98, 50, 60, 40, 7, 3, 1])]
    requests = spark.createDataFrame(rows, "request_id int, store_id int, product_id int, qty int")
    inventory = spark.createDataFrame([(0, 0, 100)], "store_id int, product_id int, stock int")
    got = folds.reserve_stock(requests, inventory, ["request_id"], 0, 3).collect()
    assert {r.request_id: (r.outcome, r.stock_after) for r in got} == replay_reserve(rows, {(0, 0): 100})


def replay_orders(orders, items, stock):
    left, out, baskets = dict(stock), {}, {}
    for order, product, qty in items:
        basket = baskets.setdefault(order, {})
        basket[product] = basket.get(product, 0) + qty
    for order, store, _ in sorted(orders, key=lambda o: o[2]):
        if order not in baskets:
            continue
        ok = all(left.get((store, p), 0) >= q for p, q in baskets[order].items())
        if ok:
            for p, q in baskets[order].items():
                left[store, p] -= q
        out[order] = "ACCEPTED" if ok else "REFUSED"
    assert all(n >= 0 for n in left.values())
    return out


@pytest.mark.parametrize("lines_at_once,run_length", FORMS)
@pytest.mark.parametrize("seed", [2, 3])
def test_place_orders(spark, lines_at_once, run_length, seed):
    rng = random.Random(seed)
    orders = [(i, rng.choice([0, 0, 1, 2]), (1000 - i) * 10**9) for i in range(80)]
    items = [(rng.randrange(85), rng.randrange(6), rng.randint(1, 8)) for _ in range(260)]
    known = {o[0] for o in orders}
    stock = {(s, p): 45 for s in range(3) for p in range(6) if p != 5 or s}
    got = folds.place_orders(
        spark.createDataFrame(orders, "order_id int, store_id int, seq long"),
        spark.createDataFrame(items, "order_id int, product_id int, qty int"),
        spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], "store_id int, product_id int, stock int"),
        lines_at_once,
        run_length,
    ).collect()
    assert {r.order_id: r.outcome for r in got} == replay_orders(orders, [i for i in items if i[0] in known], stock)
    assert len(got) == len({r.order_id for r in got})
    assert {r.outcome for r in got} == {"ACCEPTED", "REFUSED"}


@pytest.mark.parametrize("lines_at_once,run_length", FORMS)
def test_adjust_credit(spark, lines_at_once, run_length):
    rng = random.Random(4)
    accounts = [(c, Decimal("100.00"), 1 + c) for c in range(4)]
    rows, request = [], 0
    for _ in range(150):
        customer = rng.choice([0, 0, 0, 1, 2, 3, 9])
        rows.append((request, customer, rng.randint(0, 12), Decimal(rng.randint(-50, 50))))
        request += 1
    # One customer with a long unbroken chain.
    for version in range(4, 40):
        rows.append((request, 3, version, Decimal(1)))
        request += 1
    rng.shuffle(rows)
    rows = [(i, c, v, a) for i, (_, c, v, a) in enumerate(rows)]

    state = {c: [credit, version] for c, credit, version in accounts}
    expected = {}
    for request, customer, version, amount in rows:
        account = state.get(customer)
        if account and account[1] == version:
            account[0] += amount
            account[1] += 1
            expected[request] = ("APPLIED", account[0], account[1])
        else:
            expected[request] = ("CONFLICT", None, None)

    got = folds.adjust_credit(
        spark.createDataFrame(rows, "request_id int, customer_id int, expected_version int, amount decimal(10,2)"),
        spark.createDataFrame(accounts, "customer_id int, available_credit decimal(10,2), version int"),
        ["request_id"],
        lines_at_once,
        run_length,
    ).collect()
    assert {r.request_id: (r.outcome, r.credit_after, r.version_after) for r in got} == expected


def test_long_version_chain(spark):
    rows = [(i, 1, i + 1, Decimal(1)) for i in range(70)]
    got = folds.adjust_credit(
        spark.createDataFrame(rows, "request_id int, customer_id int, expected_version int, amount decimal(10,2)"),
        spark.createDataFrame([(1, Decimal(0), 1)], "customer_id int, available_credit decimal(10,2), version int"),
        ["request_id"],
        20,
        8,
    ).collect()
    assert sorted(r.version_after for r in got) == list(range(2, 72))
    assert max(r.credit_after for r in got) == 70


@pytest.mark.parametrize("lines_at_once", [1000, 0])
def test_requests_without_a_key_are_refused(spark, lines_at_once):
    requests = spark.createDataFrame([(1, None, 5, 1), (2, 1, 5, 1)], "request_id int, store_id int, product_id int, qty int")
    shelf = spark.createDataFrame([(1, 5, 9)], "store_id int, product_id int, stock int")
    got = folds.reserve_stock(requests, shelf, ["request_id"], lines_at_once, 5).collect()
    assert {(r.request_id, r.outcome, r.stock_after) for r in got} == {(1, "REFUSED", 0), (2, "ACCEPTED", 8)}
    asked = spark.createDataFrame([(1, None, 1, Decimal(1)), (2, 7, 1, Decimal(1))], "request_id int, customer_id int, expected_version int, amount decimal(9,2)")
    accounts = spark.createDataFrame([(7, Decimal(5), 1)], "customer_id int, available_credit decimal(9,2), version int")
    got = folds.adjust_credit(asked, accounts, ["request_id"], lines_at_once, 5).collect()
    assert {(r.request_id, r.outcome, r.credit_after) for r in got} == {(1, "CONFLICT", None), (2, "APPLIED", Decimal(6))}


def test_number_arrivals_follows_order(spark):
    rows = [(i * 7919 % 1000,) for i in range(1000)]
    numbered = folds.number_arrivals(spark.createDataFrame(rows, "k int").repartition(6), ["k"]).collect()
    assert [r.k for r in sorted(numbered, key=lambda r: r.seq)] == list(range(1000))


@pytest.mark.parametrize("lines_at_once,run_length", FORMS)
def test_nulls_and_returns_have_one_outcome(spark, lines_at_once, run_length):
    shelf = spark.createDataFrame([(1, 5, 5), (1, 6, 9)], "store_id int, product_id int, stock int")
    rows = [(1, 1, 5, 5), (2, 1, 5, -3), (3, 1, 5, 5), (4, 1, 5, None), (5, 1, 5, 3), (6, 1, 6, None)]
    requests = spark.createDataFrame(rows, "request_id int, store_id int, product_id int, qty int")
    got = {r.request_id: (r.outcome, r.stock_after) for r in folds.reserve_stock(requests, shelf, ["request_id"], lines_at_once, run_length).collect()}
    assert got == {
        1: ("ACCEPTED", 0), 2: ("ACCEPTED", 3), 3: ("REFUSED", 3), 4: ("REFUSED", 3), 5: ("ACCEPTED", 0), 6: ("REFUSED", 9),
    }
    orders = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, None, 4), (5, 1, 5), (6, 1, 6)], "order_id int, store_id int, seq long")
    items = [(1, None, 1), (1, 5, 1), (2, None, 1), (3, 5, None), (3, 6, 1), (4, 5, 1), (5, 5, 5), (6, 5, 1)]
    placed = folds.place_orders(orders, spark.createDataFrame(items, "order_id int, product_id int, qty int"), shelf, lines_at_once, run_length)
    assert {r.order_id: r.outcome for r in placed.collect()} == {
        1: "REFUSED", 2: "REFUSED", 3: "REFUSED", 4: "REFUSED", 5: "ACCEPTED", 6: "REFUSED",
    }


@pytest.mark.parametrize("lines_at_once,run_length", [(1000, 100), (0, 2)])
def test_a_null_amount_blanks_the_balance(spark, lines_at_once, run_length):
    rows = [(1, 7, 1, Decimal(1)), (2, 7, 2, None), (3, 7, 3, Decimal(1)), (4, 7, None, Decimal(1)), (5, 7, 9, Decimal(1))]
    asked = spark.createDataFrame(rows, "request_id int, customer_id int, expected_version int, amount decimal(9,2)")
    accounts = spark.createDataFrame([(7, Decimal(5), 1)], "customer_id int, available_credit decimal(9,2), version int")
    got = {r.request_id: (r.outcome, r.credit_after, r.version_after) for r in folds.adjust_credit(asked, accounts, ["request_id"], lines_at_once, run_length).collect()}
    assert got == {
        1: ("APPLIED", Decimal(6), 2), 2: ("APPLIED", None, 3), 3: ("APPLIED", None, 4), 4: ("CONFLICT", None, None), 5: ("CONFLICT", None, None),
    }


def replay_with_nulls(rows, stock):
    left, out = dict(stock), {}
    for request, store, product, qty in sorted(rows, key=lambda r: r[0]):
        have = left.get((store, product), 0) if store is not None and product is not None else 0
        ok = qty is not None and store is not None and product is not None and have >= qty
        if ok:
            left[store, product] = have - qty
        out[request] = ("ACCEPTED" if ok else "REFUSED", left.get((store, product), 0) if ok or (store is not None and product is not None) else 0)
    return out


@pytest.mark.parametrize("lines_at_once,run_length", FORMS)
def test_random_requests_with_nulls_and_returns(spark, lines_at_once, run_length):
    rng = random.Random(11)
    pick = lambda *values: rng.choice(values)
    rows = [(i, pick(0, 0, 0, 1, None), pick(0, 0, 1, None), pick(1, 2, 5, 9, -4, 0, None)) for i in range(300)]
    stock = {(0, 0): 30, (0, 1): 0, (1, 0): 12}
    requests = spark.createDataFrame(rows, "request_id int, store_id int, product_id int, qty int")
    inventory = spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], "store_id int, product_id int, stock int")
    got = folds.reserve_stock(requests, inventory, ["request_id"], lines_at_once, run_length).collect()
    assert {r.request_id: (r.outcome, r.stock_after) for r in got} == replay_with_nulls(rows, stock)
    assert len(got) == len(rows)


def test_a_chain_of_baskets_ends_in_few_rounds(spark, caplog):
    # Each order shares a product with the next, so rounds alone settle one or two of them at a time.
    orders = [(i, 0, i) for i in range(200)]
    items = [(i, p, 1) for i in range(200) for p in (i, i + 1)]
    stock = [(0, p, 1) for p in range(201)]
    with caplog.at_level("INFO", logger=folds.log.name):
        got = folds.place_orders(
            spark.createDataFrame(orders, "order_id int, store_id int, seq long"),
            spark.createDataFrame(items, "order_id int, product_id int, qty int"),
            spark.createDataFrame(stock, "store_id int, product_id int, stock int"),
            50,
        ).collect()
    assert {r.order_id: r.outcome for r in got} == {i: "REFUSED" if i % 2 else "ACCEPTED" for i in range(200)}
    assert len(caplog.records) <= 3


def test_dense_numbers_follow_order(spark):
    rows = [(i * 7919 % 1000,) for i in range(1000)]
    numbered = folds.number_densely(spark.createDataFrame(rows, "k int").repartition(6), ["k"]).collect()
    assert sorted((r.seq, r.k) for r in numbered) == [(i, i) for i in range(1000)]


@pytest.mark.parametrize("lines_at_once", [159, 160])
def test_both_sides_of_the_line_count(spark, lines_at_once, caplog):
    """The hot shelf has 160 requests: folded at once, or by rounds first."""
    rows = make_requests(6, 200, 2, 3, 5)
    rows = [r for r in rows if r[1:3] != (0, 0)] + [r for r in rows if r[1:3] == (0, 0)][:160]
    stock = {(s, p): 60 for s in range(2) for p in range(3)}
    requests = spark.createDataFrame(rows, "request_id int, store_id int, product_id int, qty int")
    inventory = spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], "store_id int, product_id int, stock int")
    hot = sum(r[1:3] == (0, 0) for r in rows)
    with caplog.at_level("INFO", logger=folds.log.name):
        got = folds.reserve_stock(requests, inventory, ["request_id"], hot - 160 + lines_at_once, 50).collect()
    assert {r.request_id: (r.outcome, r.stock_after) for r in got} == replay_reserve(rows, stock)
    assert bool(caplog.records) == (lines_at_once < 160)


def test_a_hot_store_is_settled_by_many_tasks_first(spark, caplog):
    """Two stores, one with nine tenths of all lines: it goes by rounds, the other is folded."""
    rng = random.Random(12)
    orders = [(i, 0 if i % 10 else 1, i) for i in range(300)]
    items = [(i, rng.randrange(8), rng.randint(1, 4)) for i in range(300) for _ in range(2)]
    stock = {(s, p): 90 for s in (0, 1) for p in range(8)}
    with caplog.at_level("INFO", logger=folds.log.name):
        got = folds.place_orders(
            spark.createDataFrame(orders, "order_id int, store_id int, seq long"),
            spark.createDataFrame(items, "order_id int, product_id int, qty int"),
            spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], "store_id int, product_id int, stock int"),
            100,
            40,
        ).collect()
    assert {r.order_id: r.outcome for r in got} == replay_orders(orders, items, stock)
    assert caplog.records


def test_orders_after_the_shelves_are_empty_need_no_rounds(spark, caplog):
    """A store of 600 lines, 100 at once: its first lines empty the shelves, and the rest is refused without rounds."""
    rng = random.Random(13)
    orders = [(i, 0, i) for i in range(300)]
    items = [(i, p, rng.randint(1, 4)) for i in range(300) for p in rng.sample(range(4), 2)]
    stock = {(0, p): 20 for p in range(4)}
    with caplog.at_level("INFO", logger=folds.log.name):
        got = folds.place_orders(
            spark.createDataFrame(orders, "order_id int, store_id int, seq long"),
            spark.createDataFrame(items, "order_id int, product_id int, qty int"),
            spark.createDataFrame([(s, p, n) for (s, p), n in stock.items()], "store_id int, product_id int, stock int"),
            100,
            40,
        ).collect()
    assert {r.order_id: r.outcome for r in got} == replay_orders(orders, items, stock)
    assert not caplog.records
