"""Card-number classification, tokens, vault and restricted views."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels, token prefix and retention period.
FULL_PAN_LENGTH = 16
TOKEN_PREFIX = "tok_"
RETENTION_MONTHS = 18
SUPPORT_COLUMNS = ("customer_id", "full_name", "email", "phone", "created_at")

PAN = "card_last_sixteen"


def classify_pans(customers: DataFrame) -> DataFrame:
    pan = F.col(PAN)
    full = F.length(pan) == FULL_PAN_LENGTH

    def by_format(absent: str, complete: str, other: str) -> Column:
        return F.when(pan.isNull(), F.lit(absent)).when(full, F.lit(complete)).otherwise(F.lit(other))

    return customers.select(
        "customer_id",
        pan.isNotNull().alias("pan_present"),
        F.length(pan).alias("pan_length"),
        F.lit(False).alias("retention_required"),
        by_format("NO_PAN", "FULL_PAN_FOUND", "UNKNOWN_FORMAT").alias("classification_status"),
        by_format("NO_ACTION", "TOKENIZE_OR_PURGE", "MANUAL_REVIEW").alias("action_required"),
    )


def tokenize_pans(customers: DataFrame, secret: str | None = None) -> DataFrame:
    """Token and last four digits of every stored card number, whatever its length.

    With ``secret`` the token is HMAC-SHA-256 over number and customer. Without
    it the token is the plain md5 of the literal job, which anyone can reverse by
    trying all numbers: use that for checks only. The key's pads become part of
    the plan, so set ``spark.sql.redaction.string.regex`` where plans are logged.
    """
    basis = F.concat(F.col(PAN), F.col("customer_id").cast("string"))
    digest = F.md5(basis) if secret is None else _hmac(secret.encode(), basis)
    return customers.filter(F.col(PAN).isNotNull()).select(
        "customer_id", F.concat(F.lit(TOKEN_PREFIX), digest).alias("pan_token"), F.right(PAN, F.lit(4)).alias("pan_last_four")
    )


def _hmac(key: bytes, text: Column) -> Column:
    """HMAC with SHA-256, as hex; ``key`` is hashed when it is longer than a block."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text.cast("binary")), 256))), 256)


def purge_pans(customers: DataFrame) -> DataFrame:
    """Customers without card numbers; run it once tokens or vault rows are stored."""
    return customers.withColumn(PAN, F.lit(None).cast("string"))


def vault_pans(customers: DataFrame, orders: DataFrame, as_of: date, key: Column) -> DataFrame:
    """Encrypted card numbers, active when the customer ordered within the retention period.

    ``key`` is a 16, 24 or 32 byte binary column. Orders are filtered and reduced
    to one row per customer before the join.
    """
    since = F.add_months(F.lit(as_of).cast("date"), -RETENTION_MONTHS)
    recent = orders.filter(F.col("order_date") >= since).select("customer_id").distinct().withColumn("_recent", F.lit(True))
    held = customers.filter(F.col(PAN).isNotNull()).select("customer_id", PAN)
    state = F.when(F.col("_recent"), F.lit("active")).otherwise(F.lit("expired"))
    return held.join(recent, "customer_id", "left").select(
        "customer_id",
        F.aes_encrypt(F.col(PAN), key).alias("pan_ciphertext"),
        state.alias("retention_state"),
        F.lit(as_of).cast("date").alias("captured_at"),
    )


def upsert(target: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Target rows without a change, plus all changes."""
    return target.join(changes.select(*key), key, "left_anti").unionByName(changes)


def remediation_report(classified: DataFrame, tokens: DataFrame) -> DataFrame:
    return classified.join(tokens, "customer_id", "left").select(
        "customer_id", "pan_present", "pan_length", "classification_status", "action_required", "pan_token", "pan_last_four"
    )


def support_view(customers: DataFrame) -> DataFrame:
    """Only the columns support staff may see."""
    return customers.select(*SUPPORT_COLUMNS)
