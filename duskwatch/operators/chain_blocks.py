"""Attack sequences of crowded addresses, as a segmented scan.

Same rule and numbering as :mod:`duskwatch.operators.chains`, for addresses with more
events in a time slice than one task should sort.  Their events are cut into blocks: time
slices, and where a slice holds more than ``crowded`` events its seconds, milliseconds and
instants; a single instant is cut at ids drawn by their hash.  What a block must know of
those before it is one small row each time: the latest scan and block, the last candidate,
and where the open run began; of those after it, the next chain end.  These rows are
scanned per address and joined back, so no task sorts more than about a block of events,
however many share an address or an instant.  Copies of one record (equal time, id and
role) cannot be parted; without ``copies`` they are reduced to one, which no chain notices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SECOND, MILLISECOND = 1_000_000, 1000


def blocks(events: DataFrame, width: int, crowded: int, copies: bool = True) -> DataFrame:
    """Events with their block, ``slice`` = (first instant, first id), in the order of events."""
    t = F.col("t")
    home = F.floor(t / width) * width
    n = F.count("*").alias("n")
    events = (events if copies else events.dropDuplicates()).withColumn("sec", F.floor(t / SECOND))

    def total(*of):
        return F.sum("n").over(Window.partitionBy("ip", *of))

    seconds = (events.groupBy("ip", "sec").agg(n)
               .withColumn("all", total(F.floor(F.col("sec") * SECOND / width)))
               .where(F.col("all") > crowded).select("ip", "sec", F.col("n").alias("in_second")))
    drawn = F.collect_set(F.when(F.pmod(F.xxhash64("id"), F.lit(crowded)) == 0, F.col("id")))
    instants = (events.join(seconds.where(F.col("in_second") > crowded), ["ip", "sec"])
                .groupBy("ip", "t").agg(n, drawn.alias("cuts"))
                .withColumn("all", total(F.floor(t / MILLISECOND))).where(F.col("all") > crowded)
                .select("ip", "t", F.lit(True).alias("alone"),
                        F.when(F.col("n") > crowded, F.col("cuts")).alias("cuts")))
    at = (F.when(F.col("in_second").isNull(), home)
          .when(F.col("in_second") <= crowded, F.col("sec") * SECOND)
          .when(F.col("alone").isNull(), F.floor(t / MILLISECOND) * MILLISECOND).otherwise(t))
    cut = F.array_max(F.filter("cuts", lambda c: c <= F.col("id")))
    return (events.join(seconds, ["ip", "sec"], "left").join(instants, ["ip", "t"], "left")
            .select("ip", "t", "id", "role",
                    F.struct(at.alias("at"), F.coalesce(cut, F.lit("")).alias("cut")).alias("slice"))
            .repartition("ip", "slice"))


def _by_slice():
    return Window.partitionBy("ip", "slice").orderBy("t", "id")


def _so_far():
    return _by_slice().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier():
    """Over one row per block: the blocks before it."""
    return Window.partitionBy("ip").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)


def candidates(events: DataFrame, lookback: int) -> DataFrame:
    """Allowed events that saw a scan and a block; ``m`` is the older of the two."""
    pos = F.struct("t", "id")

    def latest(role):
        return F.max(F.when(F.col("role") == role, pos))

    handed = (events.groupBy("ip", "slice").agg(latest("scan").alias("s"), latest("block").alias("b"))
              .select("ip", "slice", F.max("s").over(_earlier()).alias("scan_before"),
                      F.max("b").over(_earlier()).alias("block_before")))
    seen = (events.join(handed, ["ip", "slice"])
            .withColumn("scan", F.coalesce(latest("scan").over(_so_far()), "scan_before"))
            .withColumn("block", F.coalesce(latest("block").over(_so_far()), "block_before"))
            .where((F.col("role") == "success") & F.col("scan").isNotNull()
                   & F.col("block").isNotNull()))
    return (seen.withColumn("m", F.least("scan", "block"))
            .where(F.col("m.t") >= F.col("t") - lookback))


def completions(events: DataFrame, lookback: int) -> DataFrame:
    """Candidates that complete a chain: the first, third, ... of each run.

    Candidates are numbered by their ``m``, k = 1, 2, ... in a block.  A block's first may
    repeat the last ``m`` of the blocks before it; then its second is the first new one.
    Whether that opens a run is settled on the rows per block, all else inside the block.
    """
    pos, m, k = F.struct("t", "id"), F.col("m"), F.col("k")
    last_m = F.lag("m").over(_by_slice())
    new_before = F.last(F.when(F.col("new"), pos), ignorenulls=True).over(
        _by_slice().rowsBetween(Window.unboundedPreceding, -1))
    # The repartition is a point where both readers share one shuffle.
    numbered = (candidates(events, lookback).select("ip", "slice", "t", "id", "m")
                .repartition("ip", "slice")
                .withColumn("new", last_m.isNull() | (last_m != m))
                .withColumn("starts_run", F.col("new") & (m > new_before))
                .withColumn("k", F.count_if("new").over(_so_far())).where("new")
                .withColumn("run_k", F.max(F.when(F.col("starts_run"), k)).over(_so_far())))
    before = F.col("before")        # the last new candidate of the blocks before
    blocks = (numbered.groupBy("ip", "slice")
              .agg(F.max("k").alias("n"), F.max("run_k").alias("last_run"),
                   F.min(F.when(k == 1, m)).alias("m1"), F.min(F.when(k == 2, m)).alias("m2"),
                   F.max("m").alias("last_m"), F.max(pos).alias("last"))
              .withColumn("last_m", F.max("last_m").over(_earlier()))
              .withColumn("repeats", F.coalesce(F.col("last_m") == F.col("m1"), F.lit(False)))
              .withColumn("before", F.max(F.when((F.col("n") > 1) | ~F.col("repeats"), F.col("last")))
                          .over(_earlier()))
              .withColumn("shift", F.col("repeats").cast("long"))
              .withColumn("so_far", F.coalesce(F.sum(F.col("n") - F.col("shift")).over(_earlier()),
                                               F.lit(0)))
              .withColumn("offset", F.col("so_far") - F.col("shift"))
              .withColumn("opened", F.when(
                  before.isNull() | (F.when(F.col("repeats"), F.col("m2")).otherwise(F.col("m1")) > before),
                  F.col("so_far") + 1))
              .withColumn("open_run", F.max(F.coalesce(F.col("offset") + F.col("last_run"), "opened"))
                          .over(_earlier()))
              .select("ip", "slice", "repeats", "offset", "opened", "open_run"))
    run_start = F.coalesce(F.col("offset") + F.col("run_k"), "opened", "open_run")
    return (numbered.join(blocks, ["ip", "slice"])
            .where(~(F.col("repeats") & (k == 1)) & ((F.col("offset") + k - run_start) % 2 == 0))
            .select("ip", "slice", "t", "id"))


def chains(events: DataFrame, lookback: int) -> DataFrame:
    """ip, end, scan and block of each chain; the latter three are (t, id)."""
    t, pos = F.col("t"), F.struct("t", "id")
    marks = (events.where(F.col("role") != "success")
             .unionByName(completions(events, lookback).withColumn("role", F.lit("end")))
             .repartition("ip", "slice"))
    end = F.when(F.col("role") == "end", pos)
    # Walking backwards, the chain end met last is the one that consumes a step.
    later = Window.partitionBy("ip").orderBy("slice").rowsBetween(1, Window.unboundedFollowing)
    handed = (marks.groupBy("ip", "slice").agg(F.min(end).alias("e"))
              .select("ip", "slice", F.min("e").over(later).alias("end_after")))
    backwards = (Window.partitionBy("ip", "slice").orderBy(t.desc(), F.col("id").desc())
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def oldest(role):
        return F.min(F.when(F.col("role") == role, pos))

    return (marks.join(handed, ["ip", "slice"])
            .withColumn("end", F.coalesce(F.last(end, ignorenulls=True).over(backwards), "end_after"))
            .where(t >= F.col("end.t") - lookback)
            .groupBy("ip", "end").agg(oldest("scan").alias("scan"), oldest("block").alias("block")))
