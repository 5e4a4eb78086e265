"""Left join of rows to a one-row-per-key lookup, with hot keys split.

The per-card statistics are an aggregate whose output is already
partitioned by card, so the join back to the rows is planned without a new
exchange on that side.  That plan shape is not one AQE's skew-join rule
rewrites: every row of a card that holds a third of the data would meet in a
single task.  The lookup itself knows how many rows each key has, so hot
keys are found without sampling:

* ``hot`` = keys with more than ``hot_rows`` rows, each with
  ``ceil(rows / hot_rows)`` salts.  ``hot_rows`` is raised to N / ``MAX_HOT_KEYS``
  when the row total N (the sum of the lookup's counts) asks for it; since the
  counts add up to N, ``hot`` never has more than ``MAX_HOT_KEYS`` rows, and
  that bound is what allows to broadcast it.
* a row of a hot key gets salt ``pmod(xxhash64(row id), salts)``; a row
  whose key cannot match (NULL, or a known sentinel) gets the hash of its id
  as its salt, so such rows spread over all tasks however many they are; any
  other row gets salt 0.  The salt is a pure function of the
  row, so a retried task sends every row to the same place.
* the lookup row of a hot key is repeated once per salt (``explode`` of
  ``sequence``), other lookup rows once with salt 0.

The join on (key, salt) then gives each task at most about ``hot_rows`` rows
of any one key, and the result equals the plain left join: every salt of a
key carries the same lookup values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 1_000_000
#: The most keys that are split (and broadcast): 100,000 rows of two numbers.
MAX_HOT_KEYS = 100_000
_SALTS, _SALT = "__salts", "__salt"


def hot_keys(lookup: DataFrame, key: str, count_col: str, hot_rows: int) -> DataFrame:
    """(key, number of salts) for keys with more than ``hot_rows`` rows, or
    more than the ``MAX_HOT_KEYS``-th part of all rows if that is greater."""
    total = lookup.agg(F.sum(count_col)).first()[0] or 0
    limit = F.lit(max(float(hot_rows), total / MAX_HOT_KEYS))
    return (lookup.where(F.col(count_col) > limit)
            .select(key, F.ceil(F.col(count_col) / limit).cast("int").alias(_SALTS)))


def salted_left_join(rows: DataFrame, lookup: DataFrame, key: str, count_col: str,
                     row_id: str, hot_rows: int = DEFAULT_HOT_ROWS,
                     never_match: list | tuple = ()) -> DataFrame:
    """``rows LEFT JOIN lookup USING (key)`` with hot keys spread over salts.

    ``count_col`` is the lookup's per-key row count, ``row_id`` a column
    that tells rows apart (the transaction id).  Rows whose key is NULL or
    one of ``never_match`` (values known to be absent from the lookup, such
    as a sentinel) cannot find a partner, so any salt is right for them: each
    takes the hash of its id.
    """
    hot = F.broadcast(hot_keys(lookup, key, count_col, hot_rows))
    h = F.xxhash64(F.col(row_id))
    unmatched = F.col(key).isNull()
    if never_match:
        unmatched = unmatched | F.col(key).isin(*never_match)
    salted_rows = (rows.join(hot, on=key, how="left")
                   .withColumn(_SALT, F.when(unmatched, h)
                               .when(F.col(_SALTS).isNull(), F.lit(0).cast("long"))
                               .otherwise(F.pmod(h, F.col(_SALTS))))
                   .drop(_SALTS))
    salted_lookup = (lookup.join(hot, on=key, how="left")
                     .withColumn(_SALT, F.explode(F.sequence(
                         F.lit(0).cast("long"), F.coalesce(F.col(_SALTS), F.lit(1)).cast("long") - F.lit(1))))
                     .drop(_SALTS))
    return salted_rows.join(salted_lookup, on=[key, _SALT], how="left").drop(_SALT)
