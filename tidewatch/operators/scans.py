"""Order-aware scans that keep one hot key from becoming one task.

A plain window over ``partition by key`` puts a key's whole history in one task. Here the
order column is cut into chunks, so the heavy shuffle is on (key, chunk); what crosses a
chunk border is one value per (key, chunk), computed by an ordinary aggregate with map-side
combine. Results are exact.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

CHUNK_ROWS = 1_000_000
#: A time slot of a key with more rows is cut into pieces of about so many, along borders of this part of a slot.
PIECE_ROWS, FINE = 100_000, 4096


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session in one process may go without the setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return named or tempfile.mkdtemp(prefix="tidewatch-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder the cluster names."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, for what reads it several times and costs more to make than to read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed one time per row, whatever later filters say about them.

    Catalyst substitutes a projected expression into every predicate pushed below it. For a wide
    verdict built over a parsed payload that would parse and check each row again inside the
    filter, so the columns come out of a one-row generator, which predicates stay above.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def prior_max(
    df: DataFrame, keys: list[str], order: str, value: Column, out: str,
    chunk_rows: int = CHUNK_ROWS, descending: bool = False, initial: DataFrame | None = None,
) -> DataFrame:
    """Adds ``out``: the largest non-null ``value`` of the key strictly before (after, if descending) the row.

    ``order`` is a unique whole number within the key, such as an arrival sequence. ``initial``
    (keys and ``mark``) is what earlier rows, seen before, amount to. ``df`` is read twice: see :func:`kept`.
    """
    side = -F.col(order) if descending else F.col(order)
    marked = df.withColumn("_side", side).withColumn("_chunk", F.floor(F.col("_side") / chunk_rows)).withColumn("_v", value)
    per_chunk = marked.groupBy(*keys, "_chunk").agg(F.max("_v").alias("_m"))
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carry = per_chunk.select(*keys, "_chunk", F.max("_m").over(before).alias("_carry")).where("_carry is not null")
    within = W.partitionBy(*keys, "_chunk").orderBy("_side").rowsBetween(W.unboundedPreceding, -1)
    joined = marked.join(carry, [*keys, "_chunk"], "left")
    prior = [F.col("_carry"), F.max("_v").over(within)]
    if initial is not None:
        joined = joined.join(initial.select(*keys, F.col("mark").alias("_initial")), keys, "left")
        prior.append(F.col("_initial"))
    return joined.withColumn(out, F.greatest(*prior)).drop("_side", "_chunk", "_v", "_carry", "_initial")


def in_pieces(lines: DataFrame, on: list[str], slot: int, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Adds ``_slot``, the time slot of ``_t``, and ``_piece``: of a key's slot with more than ``piece_rows`` rows, which
    of its parts of about equal size the row is in. Both grow with ``_t``.

    The cut points come from counts: rows are counted by (key, slot, fine part of the slot), and a piece ends with the part
    that fills it. A piece has at most ``piece_rows`` rows besides those of one fine part, so only rows of one key
    within 1/4096 of a slot can't be told apart. ``lines`` is read twice.
    """
    fine = max(1, slot // FINE)
    lines = lines.withColumn("_slot", F.floor(F.col("_t") / slot)).withColumn("_fine", F.floor(F.col("_t") / fine))
    part = [*on, "_slot"]
    counted = lines.groupBy(*part, "_fine").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*part).orderBy("_fine").rowsBetween(W.unboundedPreceding, -1)
    cut = (
        counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_all", F.sum("_n").over(W.partitionBy(*part)))
        .where(F.col("_all") > piece_rows)
        .select(*part, "_fine", F.floor(F.col("_before") / piece_rows).alias("_piece"))
    )
    # A table between, so that a join too large to broadcast has two plain shuffles, which can be split.
    tagged = lines.join(kept(cut), [*part, "_fine"], "left")
    return tagged.withColumn("_piece", F.coalesce("_piece", F.lit(0))).drop("_fine")


def asof(
    left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str,
    payload: Column, out: str, slot: int, forward: bool = False, tie: Column | None = None, piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Adds ``out`` to ``left``: ``payload`` of the nearest ``right`` row at or before ``left_time``
    (at or after it when ``forward``), null when there is none or a key or time is null.

    Times are whole numbers. ``slot`` is the width of the time slots the shuffle is cut into, and a slot with many rows of
    a key is cut further (:func:`in_pieces`): a key's rows are spread over as many tasks as it has pieces. ``tie`` orders right
    rows of equal time: the greatest wins backward, the least wins forward. Both sides are computed once.
    """
    lt, rt = F.col(left_time), F.col(right_time)
    tie = F.lit(0) if tie is None else tie
    keep = [F.col(c) for c in left.columns]

    facts = right.select(*on, rt.alias("_t"), tie.alias("_tie"), payload.alias("_p"), F.lit(True).alias("_fact")).dropna(subset=[*on, "_t"])
    asks = left.select(*on, lt.alias("_t"), F.lit(False).alias("_fact"), F.struct(*keep).alias("_row"))
    both = kept(facts.unionByName(asks, allowMissingColumns=True))
    known = F.lit(True)
    for c in (*on, "_t"):
        known = known & F.col(c).isNotNull()
    # Questions without a key or time have no answer and take no part in the shuffle.
    unanswerable = both.where(~known).select("_row.*", F.col("_p").alias(out))
    lines = in_pieces(both.where(known), on, slot, piece_rows)
    place = [*on, "_slot", "_piece"]

    # What a piece inherits: the nearest fact of an earlier (later) one.
    rank = F.struct("_t", "_tie")
    pick = F.min_by if forward else F.max_by
    edge = lines.where("_fact").groupBy(*place).agg(pick(F.struct("_t", "_tie", "_p"), rank).alias("_edge"))
    wanted = lines.where("NOT _fact").select(*place).distinct()
    pieces = edge.join(wanted.withColumn("_asked", F.lit(True)), place, "full")
    order = [F.col(c).desc() if forward else F.col(c) for c in ("_slot", "_piece")]
    beyond = W.partitionBy(*on).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inherited = (
        pieces.withColumn("_edge", F.last("_edge", ignorenulls=True).over(beyond))
        .where("_asked and _edge is not null")
        .select(*place, F.lit(None).cast("bigint").alias("_t"), F.col("_edge._tie").alias("_tie"), F.col("_edge._p").alias("_p"), F.lit(True).alias("_fact"))
    )

    # Inherited rows sort first (null time), facts before questions of the same instant.
    step = (
        [F.col("_t").desc_nulls_first(), F.col("_fact").desc(), F.col("_tie").desc()]
        if forward
        else [F.col("_t").asc_nulls_first(), F.col("_fact").desc(), F.col("_tie")]
    )
    scan = W.partitionBy(*place).orderBy(*step).rowsBetween(W.unboundedPreceding, 0)
    answer = F.last(F.when(F.col("_fact"), F.struct("_p")), ignorenulls=True).over(scan)
    answered = lines.unionByName(inherited, allowMissingColumns=True).withColumn("_answer", answer).where("not _fact")
    return answered.select("_row.*", F.col("_answer._p").alias(out)).unionByName(unanswerable)
