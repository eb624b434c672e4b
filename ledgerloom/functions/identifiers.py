"""Identifiers that a repeated run, or another engine, makes again from the same names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_uuid(namespace: uuid.UUID, name: Column) -> Column:
    """The version 5 identifier (SHA-1) of a name in a namespace, as text; null for a null name.

    Unlike a random identifier it is the same whenever a lost task is run again.
    """
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("string").cast("binary")))
    # The version takes the first four bits of the seventh byte, the variant the first two of the ninth.
    ninth = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))
    groups = [
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(ninth)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    ]
    return F.when(digest.isNotNull(), F.concat_ws("-", *groups))
