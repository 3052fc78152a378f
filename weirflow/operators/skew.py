"""Left joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# The frequent-item sketch takes no smaller share than this.
LEAST_SHARE = 1e-4
#: One in so many rows is looked at to find frequent keys, chosen by a hash of the row.
SAMPLE = 4


def shuffle_partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(
    rows: DataFrame, key_sets: Sequence[Sequence[str]], share: float | None = None
) -> list[DataFrame]:
    """For each set of key columns, the keys that hold about ``share`` of ``rows`` or more; a
    few others may be named, and there are never more than ``len(key_sets) / share``. By
    default a key is hot if it has more than one shuffle partition's share of the rows. Which
    keys are named affects the speed of joins, not their result.

    One pass for all sets, and no shuffle of the rows. The sample is chosen by the whole row,
    so a shuffle that made ``rows`` has the same columns here as where the rows are used
    and is run once for both.
    """
    share = max(share or 1 / shuffle_partitions(rows), LEAST_SHARE * len(key_sets))
    named = [
        f"IF({' AND '.join(f'{k} IS NOT NULL' for k in keys)}, "
        f"concat('{i}', to_json(struct({', '.join(keys)}))), NULL)"
        for i, keys in enumerate(key_sets)
    ]
    packed = (
        rows.filter(f"pmod(xxhash64({', '.join(rows.columns)}), {SAMPLE}) = 0")
        .selectExpr(f"explode(array({', '.join(named)})) AS named")
    )
    items = packed.freqItems(["named"], share / len(key_sets)).selectExpr(
        "explode(named_freqItems) AS named"
    )
    found = []
    for i, keys in enumerate(key_sets):
        schema = ", ".join(f"{k} STRING" for k in keys)
        found.append(items.filter(f"named LIKE '{i}%'").selectExpr(
            f"inline(array(from_json(substr(named, 2), '{schema}')))"
        ))
    return found


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    hot: DataFrame,
) -> DataFrame:
    """Left join with ``right``, which has one row per key.

    The right rows of the keys in ``hot`` (see :func:`hot_keys`), no more than there are such keys,
    are found in the shuffle of ``right`` and broadcast to the left rows that have them. All others are joined on the key; rows of hot
    keys and rows without a key get a key of their own there, which matches nothing and spreads
    them over all tasks. ``right`` keeps the partitioning by key that it comes with, and is never
    broadcast as a whole. The result does not depend on which keys are taken as hot.
    """
    values = [c for c in right.columns if c not in keys]
    # hot is looked at in one place only: run again it may name other keys, which are then neither
    # here nor there
    few = hot.select(*(F.col(k).alias(f"__{k}") for k in keys)).hint("shuffle_hash")
    named = few.join(right, [F.col(f"__{k}") == F.col(k) for k in keys], "left").select(
        *(f"__{k}" for k in keys), *(F.col(c).alias(f"__few_{c}") for c in values), F.lit(True).alias("__hot")
    )
    no_key = " OR ".join(f"{k} IS NULL" for k in keys)
    marked = left.join(
        F.broadcast(named), [F.col(k) == F.col(f"__{k}") for k in keys], "left"
    ).withColumn("__alone", F.expr(f"coalesce(__hot, {no_key})"))
    first, *others = keys
    marked = marked.withColumn("__on", F.expr(f"IF(__alone, concat('\\0', xxhash64({spread_by})), {first})"))
    plain = right.select(
        *(F.col(k).alias(f"__right_{k}") for k in keys), *(F.col(c).alias(f"__plain_{c}") for c in values)
    )
    on = [F.col("__on") == F.col(f"__right_{first}"), *(F.col(k) == F.col(f"__right_{k}") for k in others)]
    # by the size of the files it comes from, right may seem small enough to broadcast with millions of
    # rows, and such a choice is not taken back when its shuffle has been measured
    return marked.join(plain.hint("merge"), on, "left").select(
        *left.columns,
        *(F.expr(f"CASE WHEN __hot THEN __few_{c} WHEN NOT __alone THEN __plain_{c} END").alias(c) for c in values),
    )
