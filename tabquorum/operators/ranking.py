"""Order-dependent results over whole tables without putting the table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize, release

_PART_SHIFT = 33  # monotonically_increasing_id: partition number above, row number below


def global_row_number(df: DataFrame, order: list, out: str) -> tuple[DataFrame, str]:
    """0-based position of each row in a total order; returns the table and its path.

    Rows are range-partitioned and sorted, so a partition's rows follow all rows of the
    partitions before it. The numbered partitions are written once; adding to each the
    number of rows before it joins only one row per partition.
    """
    in_order = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id()))
    stored, path = materialize(in_order, "order")
    part = F.shiftright("_at", _PART_SHIFT)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per written partition, so a single ordered window is bounded.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    numbered = (stored.withColumn("_part", part)
                .join(F.broadcast(offsets), "_part")
                .withColumn(out, F.col("_off") + F.col("_at").bitwiseAND((1 << _PART_SHIFT) - 1))
                .drop("_part", "_off", "_at"))
    return numbered, path


UNSEEN = ("error", "skip", "keep")


def fit_index(df: DataFrame, column: str) -> DataFrame:
    """The values of a column with their positions by frequency, as a table (value, position, n).

    Position 0.0 is the most frequent value; equal counts are in text order; nulls are no value. The
    positions come from a distributed sort of one row per value, so any number of values is indexed.
    The table stays in the shared folder: fit it on one frame, apply it to others.
    """
    text = F.col(f"`{column}`").cast("string")
    counts = df.where(text.isNotNull()).groupBy(text.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    numbered, path = global_row_number(counts, [F.desc("n"), F.asc("value")], "position")
    index, _ = materialize(numbered.select("value", F.col("position").cast("double").alias("position"), "n"), "index")
    release(df.sparkSession, path)
    return index


def _looked_up(df: DataFrame, index: DataFrame, key: str, found: str, wanted: Column, out: str, hot: Column) -> DataFrame:
    """``df`` with ``out``: column ``found`` of the index row whose ``key`` equals ``wanted``, or null.

    The rows of the index that ``hot`` selects, a fixed number, are broadcast; the others, none of
    which is frequent, are joined through a shuffle in which settled rows are dealt evenly.
    """
    own = {c: f"_own{i}" for i, c in enumerate(df.columns)}
    rows = df.select(wanted.alias("_wanted"), *[F.col(f"`{c}`").alias(a) for c, a in own.items()])
    common = index.where(hot).select(F.col(key).alias("_wanted"), F.col(found).alias("_common"))
    rest = index.where(~hot).select(F.col(key).alias("_rest"), F.xxhash64(key).alias("_slot"), F.col(found).alias("_found"))
    settled = F.col("_common").isNotNull() | F.col("_wanted").isNull()
    rows = (rows.join(F.broadcast(common), "_wanted", "left")
                .withColumn("_rest", F.when(~settled, F.col("_wanted")))
                .withColumn("_slot", F.when(settled, F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64("_wanted"))))
    # the slot is a key of its own on both sides: a constant would be taken out of the join
    return rows.join(rest, ["_rest", "_slot"], "left").select(
        *[F.col(a).alias(c) for c, a in own.items()], F.coalesce("_common", "_found").alias(out))


def apply_index(df: DataFrame, index: DataFrame, column: str, out: str, unseen: str = "error", hot_labels: int = 1_000) -> DataFrame:
    """``df`` with the position of each value in a fitted index.

    A value the index does not have raises an error when rows are read (``error``), drops its row
    (``skip``) or gets the number of values in the index (``keep``). Nulls stay null. The column
    carries no class metadata, whatever the number of values.
    """
    if unseen not in UNSEEN:
        raise ValueError(f"unseen must be one of {UNSEEN}, not {unseen}")
    text = F.col(f"`{column}`").cast("string")
    rows = _looked_up(df, index, "value", "position", text, out, F.col("position") < hot_labels)
    new = F.col(f"`{out}`").isNull() & text.isNotNull()
    if unseen == "skip":
        return rows.where(~new)
    other = (F.raise_error(F.concat(F.lit(f"value of {column} not in the index: "), text)).cast("double") if unseen == "error"
             else F.lit(float(index.count())))
    return rows.withColumn(out, F.when(new, other).otherwise(F.col(f"`{out}`")))


def decode_index(df: DataFrame, index: DataFrame, column: str, out: str, hot_labels: int = 1_000) -> DataFrame:
    """``df`` with the value that stands at the position in ``column``; null where none does."""
    return _looked_up(df, index, "position", "value", F.col(f"`{column}`").cast("double"), out, F.col("position") < hot_labels)


def frequency_index(df: DataFrame, column: str, out: str, hot_labels: int = 1_000) -> DataFrame:
    """0.0 for the most frequent value of ``df`` itself, 1.0 for the next; equal counts in text order.

    Nulls stay null; see ``fit_index`` and ``apply_index``.
    """
    return apply_index(df, fit_index(df, column), column, out, "keep", hot_labels)
