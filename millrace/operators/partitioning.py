"""Record placement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import md5_prefix, murmur2, positive31
from millrace.operators.blocks import BLOCK_ROWS, block_of

# Fixed value: keys with this prefix have partition 0 to themselves.
VIP_PREFIX = "vip-"

_HASHES = {"md5": md5_prefix, "murmur2": lambda key: positive31(murmur2(key))}


def vip_partition(df: DataFrame, key, n, prefix=VIP_PREFIX, hash="md5", name="partition"):
    """Add the partition of each record: 0 for VIP keys, the others spread over the rest.

    A key always gets the same partition. A null key hashes as the empty text.
    ``hash="murmur2"`` places keys as log producers do. The column is computed in place;
    a topic sink uses it as it is, so no shuffle is needed for placement.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    if n <= 1:
        return df.withColumn(name, F.lit(0))
    hashed = (_HASHES[hash](text) % (n - 1) + 1).cast("int")
    return df.withColumn(name, F.when(text.startswith(prefix), F.lit(0)).otherwise(hashed))


def by_key(df: DataFrame, key, n=None, *, offset=None, rows=BLOCK_ROWS) -> DataFrame:
    """Bring a key's rows together, in ``n`` partitions or as many as the session has.

    With ``offset`` a key comes together per block of the log, which keeps a key with a
    large share of the rows from filling one task.
    """
    columns = [F.col(key)] + ([] if offset is None else [block_of(offset, rows)])
    return df.repartition(*([n] if n else []), *columns)
