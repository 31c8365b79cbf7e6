"""Insert-if-absent (``ON CONFLICT (key) DO NOTHING``) without a table format.

Existing rows win and are never updated; new rows whose key is absent
are added once. Keys are compared NULL-safely, so a member with NULL
fields is not duplicated by a re-run (it would be with a plain UNIQUE
constraint, where NULLs are distinct).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_if_absent(existing: DataFrame | None, new: DataFrame, key: Sequence[str],
                     order_by: Sequence[str] | None = None) -> DataFrame:
    """existing ∪ (rows of ``new`` whose key is not in ``existing``).

    Within ``new``, rows sharing a key collapse to one: the first by
    ``order_by``, then by all other columns, NULLs first, so the winner
    never depends on task order. It is a partial aggregate, so a key
    repeated on a third of the batch is reduced in every task before the
    shuffle. The first load (``existing`` None) collapses the same way.
    """
    key = list(key)
    rest = [c for c in new.columns if c not in key]
    if rest:
        first = [*(order_by or []), *[c for c in rest if c not in (order_by or [])]]
        batch = new.groupBy(*key).agg(F.min(F.struct(*first)).alias("_first")).select(
            *[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in new.columns])
    else:
        batch = new.dropDuplicates(key)
    if existing is None:
        return batch
    cond = reduce(lambda a, b: a & b, [batch[k].eqNullSafe(existing[k]) for k in key])
    return existing.unionByName(batch.join(existing, cond, "left_anti"))
