"""Stock and credit kept up to date from a feed of requests.

Every shelf and every account has one value of keyed state in the state store.
The opening table is the state's initial content, read by the first micro-batch
only; from then on a micro-batch reads the requests it brings and the state of
the keys they name, and nothing that earlier batches wrote. State and output are
committed with the checkpoint, so a batch that is tried again starts from the
state before it.

The contract is that of ``operators.folds``. Within a micro-batch the requests
of a key are taken in ``order``; batches have to come in arrival order, as a log
delivers them. A key's requests of one batch are held by one task, so the rate
limit of the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds
what a hot key brings at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators import folds

# Workers get the processors themselves, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHELF = ["store_id", "product_id"]
ACCOUNT = ["customer_id"]


class _Ledger(StatefulProcessor):
    """Takes the requests of a key one after the other; ``step`` says what each does to the level."""

    state = ""

    def __init__(self, order: list[str], columns: list[str]):
        self._order, self._columns = order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._level = handle.getValueState("level", self.state)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self._level.update(self.opening(initialState))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        # One call to the store: a key without a level gets none.
        held = self._level.get()
        held = None if held is None else tuple(held)
        level = held
        for row in sorted(rows, key=lambda r: [(r[name] is not None, r[name]) for name in self._order]):
            level, answer = self.step(level, row)
            yield Row(*self._columns)(*(row[name] for name in self._columns[: -len(answer)]), *answer)
        if level is not None and level != held:
            self._level.update(level)

    def close(self) -> None:
        pass


class _Shelf(_Ledger):
    state = "stock bigint"

    def opening(self, row: Row) -> tuple:
        return (row.stock,)

    def step(self, level: tuple | None, row: Row) -> tuple[tuple | None, tuple]:
        stock = level[0] if level else 0
        fits = row.qty is not None and stock >= row.qty
        left = stock - row.qty if fits else stock
        # An unknown shelf has nothing, and comes into being with the first return to it.
        return (left,) if level or left else None, (folds.ACCEPTED if fits else folds.REFUSED, left)


class _Account(_Ledger):
    state = f"available_credit {folds.CREDIT_TYPE}, version bigint"

    def opening(self, row: Row) -> tuple:
        return row.available_credit, row.version

    def step(self, level: tuple | None, row: Row) -> tuple[tuple | None, tuple]:
        if level is None or level[1] is None or row.expected_version != level[1]:
            return level, (folds.CONFLICT, None, None)
        credit = None if level[0] is None or row.amount is None else level[0] + row.amount
        after = (credit, level[1] + 1)
        return after, (folds.APPLIED, *after)


def _followed(stream: DataFrame, opening: DataFrame, keys: list[str], processor: _Ledger, schema: T.StructType) -> DataFrame:
    present = " AND ".join(f"{key} IS NOT NULL" for key in keys)
    start = opening.filter(present).groupBy(*keys)
    return stream.filter(present).groupBy(*keys).transformWithState(processor, schema, "Append", "none", start)


def _with(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(*field) for field in fields])


def reservations(stream: DataFrame, inventory: DataFrame, order: list[str]) -> DataFrame:
    """Stream of stock requests with their outcome; ``inventory`` holds store_id, product_id and opening stock.

    A request with a null key is refused where it stands and needs no state.
    """
    opening = inventory.select(*SHELF, F.col("stock").cast("bigint").alias("stock"))
    schema = _with(stream.schema, ("outcome", T.StringType()), ("stock_after", T.LongType()))
    settled = _followed(stream, opening, SHELF, _Shelf(order, schema.names), schema)
    keyless = stream.filter(" OR ".join(f"{key} IS NULL" for key in SHELF))
    refused = keyless.select("*", F.lit(folds.REFUSED).alias("outcome"), F.lit(0).cast("bigint").alias("stock_after"))
    return settled.unionByName(refused)


def credit_changes(stream: DataFrame, accounts: DataFrame, order: list[str]) -> DataFrame:
    """Stream of versioned credit requests with their outcome; ``accounts`` holds the opening credit and version."""
    opening = accounts.select(
        *ACCOUNT, F.col("available_credit").cast(folds.CREDIT_TYPE).alias("available_credit"), F.col("version").cast("bigint").alias("version")
    )
    typed = stream.withColumn("amount", F.col("amount").cast(folds.CREDIT_TYPE))
    credit = T.StructType.fromDDL(f"c {folds.CREDIT_TYPE}")["c"].dataType
    schema = _with(typed.schema, ("outcome", T.StringType()), ("credit_after", credit), ("version_after", T.LongType()))
    settled = _followed(typed, opening, ACCOUNT, _Account(order, schema.names), schema)
    keyless = typed.filter(f"{ACCOUNT[0]} IS NULL")
    conflicts = keyless.select(
        "*", F.lit(folds.CONFLICT).alias("outcome"), F.lit(None).cast(credit).alias("credit_after"), F.lit(None).cast("bigint").alias("version_after")
    )
    return settled.unionByName(conflicts)
