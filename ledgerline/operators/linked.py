"""Lookups along a link from one row to another row of the same table.

What is looked up by row id grows with the rows, so it is merged and never collected by the driver for a
broadcast, however small it is when compressed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .cuts import cut


def flag_later_in_group(
    rows: DataFrame,
    *,
    group: str,
    order: list[str],
    row_id: str,
    where: Column,
    flag: str,
    among: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: 1 on every row of ``where`` but the first of its group, else 0; rows without a group key are a
    group. Groups are those of ``among``, which must hold the columns named here of all rows of ``where``, but may
    hold no others.

    The first row is found by an aggregate, which combines before its shuffle, and is
    handed back by row id. A group of any size, or the group of rows without a group
    key, so never meets in one task, as it would in a window by group. Only where copies share the
    first place of their group, or it has no id, are rows numbered: those at that place alone.
    """
    columns = [group, *order, row_id]
    members = (rows if among is None else among).where(where)
    places = members.groupBy(*columns).agg(F.count("*").alias("copies"))
    at = F.struct(*order, row_id, "copies")
    first = cut(places.groupBy(group).agg(F.min(at).alias("first")).select(group, "first.*"), "first")
    shared = (F.col("copies") > 1) | F.col(row_id).isNull()
    alone = first.where(~shared).groupBy(row_id).agg(F.lit(True).alias("_is_first"))

    def flagged(some: DataFrame) -> DataFrame:
        later = where & F.col("_is_first").isNull()
        found = some.join(alone.hint("merge"), row_id, "left").withColumn(flag, F.when(later, 1).otherwise(0))
        return found.drop("_is_first")

    crowded = first.where(shared)
    if crowded.isEmpty():
        return flagged(rows)
    crowded = crowded.select(*(F.col(c).alias(f"_{c}") for c in columns))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns), where)
    # the number of the task that reads a copy parts the copies of a place before they are counted
    standing = rows.join(crowded, same, "left_semi").withColumn("_task", F.spark_partition_id())
    standing = cut(standing, "first-copies")
    lowest = standing.groupBy(*(F.col(c).alias(f"_{c}") for c in columns)).agg(F.min("_task").alias("_lowest"))
    number = F.row_number().over(Window.partitionBy(*columns, "_task").orderBy(F.lit(0)))
    chosen = (F.col("_task") == F.col("_lowest")) & (F.col("_number") == 1)
    numbered = standing.withColumn("_number", number).join(lowest, same).withColumn(
        flag, F.when(chosen, 0).otherwise(1)
    )
    others = flagged(rows.join(crowded, same, "left_anti"))
    return others.unionByName(numbered.select(others.columns))


def linked_rows(rows: DataFrame, attributes: DataFrame, *, row_id: str, link: str) -> DataFrame:
    """The rows that some row links to, with ``attributes`` (one row per ``row_id``) kept."""
    wanted = rows.where(F.col(link).isNotNull()).select(F.col(link).alias(row_id)).distinct()
    return wanted.hint("merge").join(attributes, row_id)


def attach_linked(
    rows: DataFrame,
    linked: DataFrame,
    *,
    row_id: str,
    link: str,
    names: dict[str, str],
    links: DataFrame | None = None,
) -> DataFrame:
    """Add columns of the linked row, NULL where there is no link or no such row.

    ``names`` maps columns of ``linked`` to the added ones. Only the ids of rows with a
    link meet the linked rows by link; a hot link there is for AQE to split, for which
    ``linked`` should be a cut table. The result comes back by row id, the key the other
    lookups of a transaction use, so rows without a link are not sent to one task and
    no further shuffle of ``rows`` is needed. ``links`` are the ids and links of ``rows``, if a slim
    table has them.
    """
    columns = [F.col(f"to.{name}").alias(alias) for name, alias in names.items()]
    answers = (
        (rows if links is None else links)
        .where(F.col(link).isNotNull())
        .select(row_id, link)
        .distinct()
        .alias("from")
        .join(linked.hint("merge").alias("to"), F.col(f"from.{link}") == F.col(f"to.{row_id}"), "left")
        .select(
            F.col(f"from.{row_id}").alias("_id"), F.col(f"from.{link}").alias("_link"), *columns
        )
    )
    # one id with several links is an error in the data, yet each row gets the answer to its own
    # link, and a row without a link none; not as an equality, which would be a key to shuffle by
    own = (F.col(row_id) == F.col("_id")) & F.coalesce(F.col(link) == F.col("_link"), F.lit(False))
    return rows.join(answers.hint("merge"), own, "left").drop("_id", "_link")
