"""Ordered, stateful updates: stock reservation, whole-order checkout, versioned credit.

The outcome of a request depends on the accepted requests before it, on the same
shelf, in the same store, or of the same account. Groups of up to
``LINES_AT_ONCE`` lines are settled by an ordered fold: one shuffle brings a
group and its opening levels together, Spark sorts it, and an Arrow batch at a
time goes through with only the levels in hand.

A larger group would keep one task busy for long, so it goes another way:

* Lines on a shelf whose stock covers everything asked of it can refuse nobody;
  one aggregate finds them and they leave the problem.
* Orders with a line on a contended shelf are settled by rounds of distributed
  running sums (``_settle``), and a group that has come down to
  ``LINES_AT_ONCE`` lines is then folded like the others.
* Versions follow the chain of successors by doubling steps
  (``_settle_versions``), and balances are running sums along the chain.

Both ways follow one contract, so which of them settles a request shows in no
row. The contract is that of a guarded update. A comparison with null holds for
nobody: a request with a null key or quantity, and an order with any such line,
is refused and takes nothing. A negative quantity is a return: it fits whenever
the level is not below it, and raises the level. A null amount is applied where
the version matches and leaves the balance null from then on.
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.session import cut_lineage

# Workers get the step functions themselves, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lines of one group that a task folds one after the other, a few seconds of work.
LINES_AT_ONCE = 500_000
# Running sums are taken per key and run of this many arrival numbers.
RUN_LENGTH = 100_000

ACCEPTED = "ACCEPTED"
REFUSED = "REFUSED"
APPLIED = "APPLIED"
CONFLICT = "CONFLICT"

CREDIT_TYPE = "decimal(18,2)"


log = logging.getLogger(__name__)


def number_arrivals(rows: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """Number rows in ``order`` without one task seeing them all.

    A distributed sort range-partitions the rows; the generated ids then follow
    partition and position. They are stored at once, since a later replay of the
    sort could number ties and partitions differently.
    """
    return cut_lineage(rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id()))


def number_densely(rows: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """Number rows 0, 1, 2, ... in ``order``: a generated id tells partition and position, and partitions are counted."""
    staged = number_arrivals(rows, order, "_id").withColumn("_part", F.shiftrightunsigned("_id", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    counted = staged.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counted.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return staged.join(offsets, "_part").select(*rows.columns, (F.col("_offset") + position).alias(name))


def _split_null_keys(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a full key, and rows no key can match; the latter need no shuffle."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return rows.filter(~missing), rows.filter(missing)


def _replay(rows: DataFrame, keys: list[str], order: list, step: Callable[[pa.RecordBatch, dict], dict], added: str) -> DataFrame:
    """Run ``step`` over each key's rows in order and append the columns it returns.

    One shuffle on the keys; Spark sorts (and spills) the partitions, and Python
    sees Arrow batches with only the state of the key at hand.
    """
    arranged = rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order)
    fields = T.StructType.fromDDL(added)
    schema = T.StructType(arranged.schema.fields + fields.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(fields)
        state: dict[str, Any] = {}
        for batch in batches:
            returned = step(batch, state)
            for field in kinds:
                batch = batch.append_column(field.name, pa.array(returned[field.name], type=field.type))
            yield batch

    return arranged.mapInArrow(run, schema)


# Marks the rows that open a group with its level; they come before its requests and leave after the fold.
_OPENS = "_opens"


def _fold(requests: DataFrame, opening: DataFrame, keys: list[str], order: list[str], step: Callable[[pa.RecordBatch, dict], dict], added: str) -> DataFrame:
    """The requests of every key after its opening rows, through ``step``; opening columns not in ``requests`` are theirs alone."""
    both = requests.withColumn(_OPENS, F.lit(False)).unionByName(opening.withColumn(_OPENS, F.lit(True)), allowMissingColumns=True)
    done = _replay(both, keys, [F.desc(_OPENS), *order], step, added)
    return done.filter(~F.col(_OPENS)).drop(_OPENS, *[c for c in opening.columns if c not in requests.columns])


def _large(lines: DataFrame, group: list[str], lines_at_once: int) -> DataFrame | None:
    """Keys of the groups with more lines than a task folds, stored; none if there are none."""
    counted = lines.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") > lines_at_once).select(*group)
    keys = cut_lineage(counted)
    return None if keys.isEmpty() else keys


def _lists(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(name).to_pylist() for name in names))


# --- stock -----------------------------------------------------------------


def reserve_stock(requests: DataFrame, inventory: DataFrame, order: list[str], lines_at_once: int = LINES_AT_ONCE, run_length: int = RUN_LENGTH) -> DataFrame:
    """Every request with its outcome and the stock left after it.

    Requests hold store_id, product_id and qty; ``order`` is their arrival order
    and must identify a request. A request is accepted only if the stock of its
    store and product covers it at that moment; an unknown product has none.
    """
    keys, columns = ["store_id", "product_id"], requests.columns
    keyed, keyless = _split_null_keys(requests, keys)
    opening = _levels(inventory).withColumnRenamed("stock", "_level")
    large = _large(keyed, keys, lines_at_once)
    small = keyed if large is None else keyed.join(large, keys, "left_anti")
    outcome = _fold(small, opening, keys, order, _shelf_step, "accepted boolean, stock_after bigint").select(*columns, "accepted", "stock_after")
    if large is not None:
        hot = _reserve_by_rounds(keyed.join(large, keys, "left_semi"), inventory, order, lines_at_once, run_length)
        outcome = outcome.unionByName(hot)
    nothing = keyless.withColumn("accepted", F.lit(False)).withColumn("stock_after", F.lit(0).cast("bigint"))
    return outcome.unionByName(nothing).select(*columns, _verdict("accepted").alias("outcome"), "stock_after")


def _shelf_step(batch: pa.RecordBatch, state: dict) -> dict:
    """Guarded decrements of one shelf after the other."""
    verdicts, left = [], []
    shelf, stock = state.get("shelf"), state.get("stock", 0)
    for store, product, qty, opens, level in _lists(batch, "store_id", "product_id", "qty", _OPENS, "_level"):
        if (store, product) != shelf:
            shelf, stock = (store, product), 0
        if opens:
            stock = level or 0
        fits = not opens and qty is not None and stock >= qty
        if fits:
            stock -= qty
        verdicts.append(fits)
        left.append(stock)
    state.update(shelf=shelf, stock=stock)
    return {"accepted": verdicts, "stock_after": left}


def _reserve_by_rounds(keyed: DataFrame, inventory: DataFrame, order: list[str], lines_at_once: int, run_length: int) -> DataFrame:
    """The same for shelves with too many requests for one task, with columns accepted and stock_after."""
    keys = ["store_id", "product_id"]
    lines = number_arrivals(_with_stock(keyed, _levels(inventory)), order)
    asked = lines.filter(F.col("qty").isNotNull()).select(F.col("seq").alias("order_id"), "seq", *keys, F.col("qty").cast("bigint").alias("qty"), "stock")
    settled = _settle(asked, keys, lines_at_once, run_length).select(F.col("order_id").alias("seq"), F.col("accepted").alias("_settled"))
    flagged = lines.join(settled, "seq", "left").withColumn("accepted", F.col("qty").isNotNull() & F.coalesce("_settled", F.lit(True)))
    taken = flagged.withColumn("_used", F.when(F.col("accepted"), F.col("qty").cast("bigint")).otherwise(F.lit(0)))
    summed = _running_sum(taken, keys, "seq", ["_used"], run_length)
    left = (F.col("stock") - F.col("_used_before") - F.col("_used")).alias("stock_after")
    return summed.select(*keyed.columns, "accepted", left)


def _levels(inventory: DataFrame) -> DataFrame:
    return inventory.select("store_id", "product_id", F.col("stock").cast("bigint").alias("stock"))


def _with_stock(lines: DataFrame, stock: DataFrame) -> DataFrame:
    return lines.join(stock, ["store_id", "product_id"], "left").withColumn("stock", F.coalesce("stock", F.lit(0)))


def _verdict(flag: str) -> Column:
    return F.when(F.col(flag), F.lit(ACCEPTED)).otherwise(F.lit(REFUSED))


def _running_sum(rows: DataFrame, keys: list[str], seq: str, values: list[str], run_length: int) -> DataFrame:
    """Sum of each value over the earlier rows of the key, as ``<value>_before``.

    Rows are summed inside runs of ``run_length`` arrival numbers, then run
    totals are summed per key: no window holds more than a run or the list of
    runs of one key.
    """
    run = F.floor(F.col(seq) / run_length).alias("_run")
    staged = rows.withColumn("_run", run)
    inside = Window.partitionBy(*keys, "_run").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    totals = staged.groupBy(*keys, "_run").agg(*[F.sum(v).alias(f"_{v}_total") for v in values])
    offsets = totals.select(
        *keys, "_run", *[F.coalesce(F.sum(f"_{v}_total").over(earlier), F.lit(0)).alias(f"_{v}_offset") for v in values]
    )
    local = staged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_{v}_local") for v in values])
    joined = local.join(offsets, [*keys, "_run"])
    return joined.select(
        *rows.columns, *[(F.col(f"_{v}_local") + F.col(f"_{v}_offset")).alias(f"{v}_before") for v in values]
    )


def _contended(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines on shelves that cannot cover everything asked of them."""
    demand = lines.groupBy(*keys).agg(F.sum(F.greatest("qty", F.lit(0))).alias("_asked"), F.min("stock").alias("_stock"))
    return lines.join(demand.filter(F.col("_asked") > F.col("_stock")).select(*keys), keys, "left_semi")


def _settle(lines: DataFrame, group: list[str], lines_at_once: int, run_length: int) -> DataFrame:
    """(order_id, accepted) of the orders that a contended shelf has a say in; all others are accepted.

    ``lines`` has order_id, seq (arrival of the order), store_id, product_id, qty
    and the initial stock, none of them null; one line per order and product. In
    each round

    * an order is accepted if every line fits even when of the open earlier
      orders all takings and no returns are counted, and
    * refused if some line does not fit even when of those all returns and no
      takings are counted.

    The earliest open order always meets one of the two. Groups that have come
    down to ``lines_at_once`` lines that matter are replayed, each inside itself;
    the others go on by rounds, as long as a round settles that many lines too:
    a task replays them in less time than a round takes. Replaying holds only the
    levels of a group, whatever its number of lines.
    """
    keys = ["store_id", "product_id"]
    columns = ["order_id", "seq", *keys, "qty", "stock"]
    work = cut_lineage(_contended(lines.select(*columns), keys).withColumn("accepted", F.lit(False)))
    done, rounds, before = work.select("order_id", "accepted").limit(0), 0, sys.maxsize
    while open_lines := work.filter(~F.col("accepted")).count():
        large = _large(work, group, lines_at_once) if before - open_lines >= lines_at_once else None
        fitting = work if large is None else work.join(large, group, "left_anti")
        done = done.unionByName(_replay_orders(fitting, group))
        if large is None:
            break
        judged = cut_lineage(_round(cut_lineage(work.join(large, group, "left_semi")), keys, run_length))
        done = done.unionByName(judged.filter("accepted or refused").select("order_id", "accepted").distinct())
        standing = judged.filter(~F.col("refused")).drop("refused")
        # Once the last open order of a shelf is settled, its accepted orders matter to nobody.
        open_keys = standing.filter(~F.col("accepted")).select(*keys).distinct()
        work, rounds, before = cut_lineage(standing.join(open_keys, keys, "left_semi")), rounds + 1, open_lines
        log.info("round %d: %d lines were open", rounds, open_lines)
    # An accepted order stays listed while it is in the working set.
    return done.distinct()


def _round(work: DataFrame, keys: list[str], run_length: int) -> DataFrame:
    """``work`` with more orders accepted, and ``refused`` ones marked."""
    open_or_taken = lambda bound: F.when(F.col("accepted"), F.col("qty")).otherwise(bound("qty", F.lit(0).cast("bigint")))
    upper = _running_sum(work.withColumn("_most", open_or_taken(F.greatest)), keys, "seq", ["_most"], run_length)
    fits = upper.groupBy("order_id").agg(F.min(F.col("stock") - F.col("_most_before") >= F.col("qty")).alias("_fits"))
    raised = work.join(fits, "order_id").withColumn("accepted", F.col("accepted") | F.col("_fits")).drop("_fits")
    lower = _running_sum(raised.withColumn("_least", open_or_taken(F.least)), keys, "seq", ["_least"], run_length)
    short = ~F.col("accepted") & (F.col("stock") - F.col("_least_before") < F.col("qty"))
    return raised.join(lower.groupBy("order_id").agg(F.max(short).alias("refused")), "order_id")


def _replay_orders(lines: DataFrame, group: list[str]) -> DataFrame:
    """Settle orders one after the other inside each group; ``accepted`` ones are taken as given."""
    basket = Window.partitionBy(*group, "order_id").orderBy(F.desc("product_id"))
    counted = lines.withColumn("lines_left", F.row_number().over(basket))
    replayed = _replay(counted, group, ["seq", F.desc("lines_left")], _order_step, "taken boolean")
    return replayed.filter("taken is not null").select("order_id", F.col("taken").alias("accepted"))


def _order_step(batch: pa.RecordBatch, state: dict) -> dict:
    """All-or-nothing reservation per order; its lines arrive one after the other.

    ``lines_left`` counts down to 1, so the last line of an order is known
    without looking ahead, even across batches. The verdict stands on that line.
    """
    verdicts = []
    for store, product, qty, stock, given, left in _lists(
        batch, "store_id", "product_id", "qty", "stock", "accepted", "lines_left"
    ):
        if state.get("store") != store:
            state.update(store=store, shelf={}, basket=[])
        shelf, basket = state["shelf"], state["basket"]
        shelf.setdefault(product, stock)
        basket.append((product, qty))
        verdict = None
        if left == 1:
            verdict = given or all(shelf[p] >= q for p, q in basket)
            if verdict:
                for p, q in basket:
                    shelf[p] -= q
            state["basket"] = []
        verdicts.append(verdict)
    return {"taken": verdicts}


def place_orders(orders: DataFrame, items: DataFrame, inventory: DataFrame, lines_at_once: int = LINES_AT_ONCE, run_length: int = RUN_LENGTH) -> DataFrame:
    """Outcome of every order that has lines: accepted whole or refused whole, in order of ``seq``.

    Orders hold order_id, store_id and seq (a unique arrival number); items
    hold order_id, product_id and qty. Returns aside, stock never goes below zero.
    """
    void = F.max(F.col("product_id").isNull() | F.col("qty").isNull()).alias("_void")
    # Lines are dealt out by order once, which serves both sums and the join.
    wanted = items.repartition("order_id").groupBy("order_id", "product_id").agg(F.sum(F.col("qty").cast("bigint")).alias("qty"), void)
    basket = F.collect_list(F.struct("product_id", "qty")).alias("basket")
    baskets = wanted.groupBy("order_id").agg(basket, F.max("_void").alias("_void"), F.count("*").alias("_lines"))
    whole = cut_lineage(orders.select("order_id", "store_id", "seq").join(baskets, "order_id").withColumn("_void", F.col("_void") | F.col("store_id").isNull()))
    refused, sound = whole.filter("_void"), whole.filter(~F.col("_void")).drop("_void")
    sizes = sound.groupBy("store_id").agg(F.sum("_lines").alias("_n")).filter(F.col("_n") > lines_at_once).select("store_id")
    large = cut_lineage(sizes)
    hot = not large.isEmpty()
    small = sound.join(large, "store_id", "left_anti") if hot else sound
    opening = _levels(inventory).withColumnRenamed("stock", "_level").filter("store_id IS NOT NULL")
    outcome = _fold(small.drop("_lines"), opening, ["store_id"], ["seq"], _basket_step, "accepted boolean").select("order_id", "store_id", "accepted")
    if hot:
        outcome = outcome.unionByName(_place_by_rounds(sound.join(large, "store_id", "left_semi"), inventory, lines_at_once, run_length))
    outcome = outcome.unionByName(refused.select("order_id", "store_id", F.lit(False).alias("accepted")))
    return outcome.select("order_id", "store_id", _verdict("accepted").alias("outcome"))


def _basket_step(batch: pa.RecordBatch, state: dict) -> dict:
    """All-or-nothing reservation of one order after the other, store by store."""
    verdicts = []
    store, shelf = state.get("store"), state.get("shelf", {})
    for at, opens, product, level, basket in _lists(batch, "store_id", _OPENS, "product_id", "_level", "basket"):
        if at != store:
            store, shelf = at, {}
        if opens:
            shelf[product] = level or 0
            verdicts.append(False)
            continue
        fits = all(shelf.get(line["product_id"], 0) >= line["qty"] for line in basket)
        if fits:
            for line in basket:
                shelf[line["product_id"]] = shelf.get(line["product_id"], 0) - line["qty"]
        verdicts.append(fits)
    state.update(store=store, shelf=shelf)
    return {"accepted": verdicts}


def _place_by_rounds(whole: DataFrame, inventory: DataFrame, lines_at_once: int, run_length: int) -> DataFrame:
    """(order_id, store_id, accepted) for the orders of stores with too many lines for one task."""
    # Arrival numbers may have gaps of any size; running sums want them close together.
    arrived = number_arrivals(whole.select("order_id", "store_id", F.col("seq").alias("_seq"), "basket"), ["_seq"])
    begun, rest, levels = _place_first(arrived, _levels(inventory), lines_at_once, run_length)
    settled = _settle(_with_stock(_lines_of(rest), levels), ["store_id"], lines_at_once, run_length)
    judged = rest.select("order_id", "store_id").join(settled, "order_id", "left")
    return begun.unionByName(judged.withColumn("accepted", F.coalesce("accepted", F.lit(True))))


def _lines_of(arrived: DataFrame) -> DataFrame:
    return arrived.select("order_id", "seq", "store_id", F.explode("basket").alias("_line")).select("order_id", "seq", "store_id", "_line.*")


def _place_first(arrived: DataFrame, levels: DataFrame, lines_at_once: int, run_length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Outcomes (order_id, store_id, accepted) found without rounds, the orders without one, stored, and the levels these find.

    A task folds the first ``lines_at_once`` lines of each store. Of the later
    orders those are refused that ask for more than is left then and all later
    returns bring: no order before them can change that. Once the shelves are
    empty that is nearly every order, and rounds have little to move.
    """
    keys = ["store_id", "product_id"]
    summed = _running_sum(arrived.select("store_id", "seq", F.size("basket").alias("_lines")), ["store_id"], "seq", ["_lines"], run_length)
    ends = cut_lineage(summed.filter(F.col("_lines_before") + F.col("_lines") <= lines_at_once).groupBy("store_id").agg(F.max("seq").alias("_end")))
    dealt = arrived.join(F.broadcast(ends), "store_id", "left")
    first = F.coalesce(F.col("seq") <= F.col("_end"), F.lit(False))
    head, tail = dealt.filter(first).drop("_end"), dealt.filter(~first).drop("_end")
    opening = levels.withColumnRenamed("stock", "_level").join(F.broadcast(ends.select("store_id")), "store_id", "left_semi")
    folded = cut_lineage(_fold(head, opening, ["store_id"], ["seq"], _basket_step, "accepted boolean").select("order_id", "seq", "store_id", "basket", "accepted"))
    taken = _lines_of(folded.filter("accepted")).groupBy(*keys).agg(F.sum("qty").alias("_taken"))
    stores = arrived.select("store_id").distinct()
    left = levels.join(F.broadcast(stores), "store_id", "left_semi").join(taken, keys, "left")
    left = cut_lineage(left.select(*keys, (F.coalesce("stock", F.lit(0)) - F.coalesce("_taken", F.lit(0))).alias("stock")))
    returned = _lines_of(tail).filter("qty < 0").groupBy(*keys).agg(F.sum(-F.col("qty")).alias("_returned"))
    most = left.join(returned, keys, "full_outer").groupBy(*keys).agg(F.max(F.coalesce("stock", F.lit(0)) + F.coalesce("_returned", F.lit(0))).alias("_most"))
    asked = _lines_of(tail).join(most, keys, "left").filter(F.col("qty") > F.coalesce("_most", F.lit(0)))
    hopeless = cut_lineage(asked.select("seq").distinct())
    rest = cut_lineage(tail.join(hopeless, "seq", "left_anti"))
    refused = tail.join(hopeless, "seq", "left_semi").select("order_id", "store_id", F.lit(False).alias("accepted"))
    return folded.select("order_id", "store_id", "accepted").unionByName(refused), rest, left


# --- versioned credit ------------------------------------------------------


def adjust_credit(requests: DataFrame, accounts: DataFrame, order: list[str], lines_at_once: int = LINES_AT_ONCE, run_length: int = RUN_LENGTH) -> DataFrame:
    """Every credit request with its outcome and, when applied, the account after it.

    Requests hold customer_id, expected_version and amount; accounts hold
    customer_id, available_credit and version. A request for an unknown account
    conflicts, as an update that matches no row does.
    """
    key = ["customer_id"]
    start = accounts.select(
        *key, F.col("available_credit").cast(CREDIT_TYPE).alias("available_credit"), F.col("version").cast("bigint").alias("version")
    )
    typed = requests.withColumn("amount", F.col("amount").cast(CREDIT_TYPE))
    keyed, keyless = _split_null_keys(typed, key)
    large = _large(keyed, key, lines_at_once)
    small = keyed if large is None else keyed.join(large, key, "left_anti")
    opening = start.filter("customer_id IS NOT NULL").select(*key, F.col("available_credit").alias("_credit"), F.col("version").alias("_version"))
    outcome = _fold(small, opening, key, order, _account_step, f"outcome string, credit_after {CREDIT_TYPE}, version_after bigint")
    if large is not None:
        outcome = outcome.unionByName(_adjust_by_doubling(keyed.join(large, key, "left_semi"), start, order, run_length))
    nothing = [F.lit(CONFLICT).alias("outcome"), F.lit(None).cast(CREDIT_TYPE).alias("credit_after"), F.lit(None).cast("bigint").alias("version_after")]
    return outcome.unionByName(keyless.select("*", *nothing)).select(*requests.columns, "outcome", "credit_after", "version_after")


def _account_step(batch: pa.RecordBatch, state: dict) -> dict:
    """Versioned changes of one account after the other."""
    outcomes, credits, versions = [], [], []
    account, credit, version = state.get("account"), state.get("credit"), state.get("version")
    for customer, expected, amount, opens, held, held_version in _lists(
        batch, "customer_id", "expected_version", "amount", _OPENS, "_credit", "_version"
    ):
        if customer != account:
            account, credit, version = customer, None, None
        if opens:
            credit, version = held, held_version
        applies = not opens and version is not None and expected == version
        if applies:
            credit, version = None if credit is None or amount is None else credit + amount, version + 1
        outcomes.append(APPLIED if applies else CONFLICT)
        credits.append(credit if applies else None)
        versions.append(version if applies else None)
    state.update(account=account, credit=credit, version=version)
    return {"outcome": outcomes, "credit_after": credits, "version_after": versions}


def _adjust_by_doubling(typed: DataFrame, start: DataFrame, order: list[str], run_length: int) -> DataFrame:
    """The same for accounts with too many requests for one task."""
    key = ["customer_id"]
    busy = number_arrivals(typed.withColumn("_expected", F.col("expected_version").cast("bigint")), order)
    # A request below the starting version, or for no account, can never apply.
    able = busy.join(start, key).filter(F.col("_expected") >= F.col("version"))
    able = cut_lineage(able.select("seq", *key, F.col("_expected").alias("expected_version"), "version", "available_credit", "amount"))
    applied = _settle_versions(able.select("seq", *key, "expected_version", "version"), run_length)
    # Applied requests expect consecutive versions, so the balance is a running
    # sum in version order over applied requests only.
    winners = able.join(applied, "seq").withColumn("_blank", F.col("amount").isNull().cast("int")).withColumn("amount", F.coalesce("amount", F.lit(0).cast(CREDIT_TYPE)))
    summed = _running_sum(winners, key, "expected_version", ["amount", "_blank"], run_length)
    known = F.col("_blank_before") + F.col("_blank") == 0
    moved = summed.select(
        "seq",
        F.when(known, (F.col("available_credit") + F.col("amount_before") + F.col("amount")).cast(CREDIT_TYPE)).alias("credit_after"),
        (F.col("expected_version") + 1).alias("version_after"),
    )
    verdict = F.when(F.col("version_after").isNotNull(), F.lit(APPLIED)).otherwise(F.lit(CONFLICT))
    return busy.join(moved, "seq", "left").select(*typed.columns, verdict.alias("outcome"), "credit_after", "version_after")


def _settle_versions(rows: DataFrame, run_length: int) -> DataFrame:
    """Sequence numbers of the requests that apply.

    The request that applies after one expecting version v is the first later
    request of the account expecting v + 1. That makes a successor link per
    request; the applied ones are the chain from the first request expecting the
    starting version. Links are doubled each round, so a chain of n is covered
    in log2(n) rounds.
    """
    rows = cut_lineage(rows.withColumn("_run", F.floor(F.col("seq") / run_length)))
    # Requests (as targets) and their predecessors (as probes) meet on the target's version.
    targets = rows.select("customer_id", F.col("expected_version").alias("_v"), "_run", "seq", F.lit(True).alias("_is_target"))
    probes = rows.select("customer_id", (F.col("expected_version") + 1).alias("_v"), "_run", "seq", F.lit(False).alias("_is_target"))
    target_seq = F.when(F.col("_is_target"), F.col("seq"))
    later_in_run = (
        Window.partitionBy("customer_id", "_v", "_run").orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
    )
    near = targets.unionByName(probes).withColumn("_near", F.min(target_seq).over(later_in_run)).filter(~F.col("_is_target"))
    firsts = targets.groupBy("customer_id", "_v", "_run").agg(F.min("seq").alias("_first"))
    probe_runs = probes.select("customer_id", "_v", "_run").distinct()
    later_runs = Window.partitionBy("customer_id", "_v").orderBy("_run").rowsBetween(1, Window.unboundedFollowing)
    far = (
        firsts.join(probe_runs, ["customer_id", "_v", "_run"], "full_outer")
        .withColumn("_far", F.min("_first").over(later_runs))
        .select("customer_id", "_v", "_run", "_far")
    )
    links = (
        near.join(far, ["customer_id", "_v", "_run"], "left")
        .select("seq", F.coalesce("_near", "_far").alias("next"))
        .filter("next is not null")
    )
    links = cut_lineage(links)
    reached = cut_lineage(
        rows.filter(F.col("expected_version") == F.col("version")).groupBy("customer_id").agg(F.min("seq").alias("seq")).select("seq")
    )
    while True:
        # reached holds the first 2^k requests of each chain, links jump 2^k ahead.
        added = cut_lineage(reached.join(links, "seq").select(F.col("next").alias("seq")))
        if added.isEmpty():
            return reached
        reached = cut_lineage(reached.unionByName(added))
        hop = links.select(F.col("seq").alias("next"), F.col("next").alias("_after"))
        links = cut_lineage(links.join(hop, "next").select("seq", F.col("_after").alias("next")))
