"""Row-level changes between two snapshots of a table, and applying them to a copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.sources.stored import offset_of, read_table, read_version, replace_table, store_once, version_of


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Inserted, updated and deleted rows. A deleted row carries its old values.

    Values are compared null-safe, column by column, so no hash can hide a change.
    """
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("_old"))
    new = after.select(*keys, F.struct(*values).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return (
        old.join(new, keys, "full_outer")
        .withColumn("_change", change)
        .filter(F.col("_change").isNotNull())
        .withColumn("_row", F.coalesce("_new", "_old"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in values], "_change")
    )


def apply_changes(copy: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The copy after the changes: untouched rows plus inserted and updated ones."""
    untouched = copy.join(changes.select(*keys), keys, "left_anti")
    return untouched.unionByName(changes.filter(F.col("_change") != "delete").select(*copy.columns))


def changes_between(spark: SparkSession, path: str, keys: list[str], since: int, until: int) -> DataFrame:
    """Net changes of a replaceable table between two of its versions; 0 is the table before its first one.

    A row that changed several times in between comes once, one that came and went not at all.
    """
    after = read_version(spark, path, until)
    before = read_version(spark, path, since) if since else after.limit(0)
    return change_feed(before, after, keys)


def sync(spark: SparkSession, path: str, copy: str, keys: list[str]) -> DataFrame:
    """Bring a consumer's copy to the newest version of a table by the net changes since its offset.

    The offset is committed with the copy, so a sync that is lost in between is simply run again. The table must keep the
    version that the copy stands at.
    """
    newest, offset = version_of(spark, path), offset_of(spark, copy)
    if offset == newest:
        return read_table(spark, copy)
    if not offset:
        # Every row is an insert into nothing.
        return replace_table(read_version(spark, path, newest), copy, source=newest)
    feed = store_once(changes_between(spark, path, keys, offset, newest), "feed")
    return replace_table(apply_changes(read_table(spark, copy), feed, keys), copy, source=newest)


def open_backlog(orders: DataFrame, receipts: DataFrame, as_of: str) -> DataFrame:
    """Orders placed by a date and not received by it, with whether the promise had passed."""
    day = F.lit(as_of).cast("date")
    waiting = receipts.filter(F.col("data_recebida").isNull() | (F.col("data_recebida") > day))
    return (
        orders.filter(F.col("data_pedido") <= day)
        .select("id_pedido", "razao_social", "valor_total")
        .join(waiting.select("id_pedido", "data_prometida"), "id_pedido")
        .withColumn("vencido", F.col("data_prometida") < day)
    )
