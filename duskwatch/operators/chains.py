"""Attack-sequence detector: scan and block, then success, from one address.

Walking one address's events in time order, a buffer keeps the scans and blocks
of the last ``within``; an allowed event that finds at least one of each is a
chain, and empties the buffer.  A fold over all events of an address would put
a hot address into one task, so the same result is computed in parallel.

For an allowed event ``a`` let ``m(a)`` be the older of the latest scan and the
latest block before it.  ``a`` completes a chain exactly when ``m(a)`` is inside
the look-back and lies after the previous chain's end.  Of events with the same
``m`` only the first can complete one.  Among those candidates, in order, ``m``
grows, and the candidate after next always has its ``m`` behind the present
one: whichever of scan and block was the older was renewed in between, twice.
So in a run of candidates that each overlap their predecessor, exactly the
first, third, fifth, ... complete a chain; a candidate that does not overlap its
predecessor starts a new run.

Events are cut into time slices per address.  Each slice also sees the last two
look-backs before it, which is enough to find its candidates; only the parity of
an open run is handed from slice to slice, as one small row per slice.  Addresses with
more than ``crowded`` events in a slice go by :mod:`duskwatch.operators.chain_blocks`,
which gives the same chains.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from duskwatch.functions.text import message
from duskwatch.functions.timing import micros, minutes_of
from duskwatch.operators import chain_blocks
from duskwatch.operators.velocity import none_text

WITHIN = "10 minutes"
SLICES_PER_LOOKBACK = 4
# Events of one address in one slice beyond which the slice is cut further.
CROWDED = 200_000
# Crowded addresses up to which their list is broadcast.
LISTED = 100_000

SCAN_TYPES = ("PORT_SCAN", "SSH_ATTEMPT")
BLOCKS = ("BLOCK", "DROP")

# Wording of a finding.
PATTERN = "port_scan → blocked_attempt → success"
DESCRIPTION = ("ATTACK CHAIN DETECTED: %s performed port scan, was blocked, then achieved "
               "successful connection. Possible reconnaissance leading to compromise.")


def chain_role() -> Column:
    """Part an event plays in a chain; NULL for none."""
    return (F.when(F.upper("event_type").isin(*SCAN_TYPES), "scan")
            .when(F.col("action").isin(*BLOCKS), "block")
            .when(F.col("action") == "ALLOW", "success"))


def _steps(silver: DataFrame) -> DataFrame:
    """Narrow role events."""
    return (silver.select(none_text(F.col("source_ip")).alias("ip"),
                          F.unix_micros("event_time").alias("t"), "id",
                          chain_role().alias("role"))
            .where(F.col("role").isNotNull()))


def _slices(events: DataFrame, lookback: int, width: int) -> DataFrame:
    """Each event in its own slice and in those it is context for."""
    t = F.col("t")
    return (events.withColumn("home", F.floor(t / width))
            .withColumn("slice", F.explode(F.sequence(
                F.col("home"), F.floor((t + 2 * lookback) / width)))))


def _by_crowding(events: DataFrame, width: int, crowded: int):
    """Events of addresses without and with a crowded slice; either may be None.

    The crowded addresses are counted first; at most one per ``crowded`` events exists.
    """
    busy = (events.groupBy("ip", F.floor(F.col("t") / width)).agg(F.count("*").alias("n"))
            .where(F.col("n") > crowded).select("ip").distinct())
    many = busy.count()
    if not many:
        return events, None
    if many > LISTED:
        return None, events
    return tuple(events.join(F.broadcast(busy), "ip", how) for how in ("left_anti", "left_semi"))


def _either(of_plain, of_crowded, events: DataFrame, width: int, crowded: int) -> DataFrame:
    plain, full = _by_crowding(events, width, crowded)
    found = [f(rows) for f, rows in ((of_plain, plain), (of_crowded, full)) if rows is not None]
    return reduce(DataFrame.unionByName, found)


def _slice_width(within: str, slice_every: str | None) -> int:
    lookback = micros(within)
    return max(micros(slice_every) if slice_every else SLICES_PER_LOOKBACK * lookback,
               2 * lookback)


def _by_slice():
    return Window.partitionBy("ip", "slice").orderBy("t", "id")


def _so_far():
    return _by_slice().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _candidates(events: DataFrame, lookback: int) -> DataFrame:
    """Allowed events that saw a scan and a block; ``m`` is the older of the two."""
    pos = F.struct("t", "id")

    def latest(role):
        return F.max(F.when(F.col("role") == role, pos)).over(_so_far())

    seen = (events.withColumn("scan", latest("scan")).withColumn("block", latest("block"))
            .where((F.col("role") == "success") & F.col("scan").isNotNull()
                   & F.col("block").isNotNull()))
    return (seen.withColumn("m", F.least("scan", "block"))
            .where(F.col("m.t") >= F.col("t") - lookback))


def attack_chain_candidates(silver: DataFrame, within: str = WITHIN,
                            slice_every: str | None = None, crowded: int = CROWDED) -> DataFrame:
    """Every allowed event with a scan and a block in its look-back (no reset)."""
    lookback, width = micros(within), _slice_width(within, slice_every)

    def plain(events):
        found = _candidates(_slices(events, lookback, width), lookback)
        return found.where(F.col("slice") == F.col("home")).select("ip", "t", "id", "scan", "block")

    def cut(events):
        found = chain_blocks.candidates(chain_blocks.blocks(events, width, crowded), lookback)
        return found.select("ip", "t", "id", "scan", "block")

    return _either(plain, cut, _steps(silver), width, crowded).select(
        F.col("ip").alias("source_ip"), F.col("id").alias("success_id"),
        F.timestamp_micros("t").alias("event_time"),
        F.timestamp_micros("scan.t").alias("latest_scan"),
        F.timestamp_micros("block.t").alias("latest_block"))


def _completions(events: DataFrame, lookback: int) -> DataFrame:
    """Candidates that complete a chain: the even members of each run."""
    pos = F.struct("t", "id")
    last_m = F.lag("m").over(_by_slice())
    last_pos = F.lag(pos).over(_by_slice())
    firsts = (_candidates(events, lookback)
              .withColumn("last_m", last_m)
              .where(F.col("last_m").isNull() | (F.col("last_m") != F.col("m")))
              .withColumn("last_pos", last_pos)
              .withColumn("starts_run",
                          F.col("last_pos").isNull() | (F.col("m") > F.col("last_pos")))
              .where(F.col("slice") == F.col("home"))
              .select("ip", "slice", "t", "id", "starts_run"))
    numbered = (firsts.withColumn("k", F.row_number().over(_by_slice()))
                .withColumn("run_k", F.max(F.when(F.col("starts_run"), F.col("k"))).over(_so_far())))
    # One row per slice carries the numbering on from earlier slices.
    before = (Window.partitionBy("ip").orderBy("slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = (numbered.groupBy("ip", "slice")
               .agg(F.count("*").alias("n"), F.max("run_k").alias("last_run_k"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .withColumn("open_run", F.max(F.col("offset") + F.col("last_run_k")).over(before))
               .select("ip", "slice", "offset", "open_run"))
    placed = numbered.join(carried, ["ip", "slice"])
    number = F.col("offset") + F.col("k")
    run_start = F.coalesce(F.col("offset") + F.col("run_k"), F.col("open_run"))
    return placed.where((number - run_start) % 2 == 0).select("ip", "t", "id")


def _chains(steps: DataFrame, lookback: int, width: int) -> DataFrame:
    """ip, end, scan and block of each chain."""
    events = _slices(steps, lookback, width)
    ends = _completions(events, lookback)
    t = F.col("t")
    marks = (ends.withColumn("home", F.floor(t / width))
             .withColumn("slice", F.explode(F.sequence(
                 F.col("home"), F.floor((t + lookback) / width))))
             .withColumn("role", F.lit("end")))
    steps = events.where(F.col("role") != "success").select(*marks.columns)
    # Walking backwards, the chain end met last is the one that consumes a step.
    backwards = (Window.partitionBy("ip", "slice").orderBy(t.desc(), F.col("id").desc())
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pos = F.struct("t", "id")
    ending = F.last(F.when(F.col("role") == "end", F.struct("t", "id", "home")), ignorenulls=True)

    def oldest(role):
        return F.min(F.when(F.col("role") == role, pos))

    return (steps.unionByName(marks)
              .withColumn("end", ending.over(backwards))
              .where((F.col("end.home") == F.col("slice")) & (t >= F.col("end.t") - lookback))
              .groupBy("ip", "end").agg(oldest("scan").alias("scan"), oldest("block").alias("block")))


def attack_chains(silver: DataFrame, within: str = WITHIN, slice_every: str | None = None,
                  crowded: int = CROWDED) -> DataFrame:
    """Chains as (address, oldest scan, oldest block, success) with ids and times."""
    lookback, width = micros(within), _slice_width(within, slice_every)

    def plain(events):
        return _chains(events, lookback, width).withColumn("end", F.struct("end.t", "end.id"))

    def cut(events):
        return chain_blocks.chains(chain_blocks.blocks(events, width, crowded, copies=False), lookback)

    chains = _either(plain, cut, _steps(silver), width, crowded)
    return chains.select(
        F.col("ip").alias("source_ip"), F.col("scan.id").alias("scan_id"),
        F.timestamp_micros("scan.t").alias("scan_time"), F.col("block.id").alias("block_id"),
        F.timestamp_micros("block.t").alias("block_time"), F.col("end.id").alias("success_id"),
        F.timestamp_micros("end.t").alias("event_time"))


def chain_findings(chains: DataFrame, silver: DataFrame, within: str = WITHIN) -> DataFrame:
    """Aggregation records of the sequence detector, with the three full events."""
    names = {"port_scan": "scan_id", "blocked_attempt": "block_id", "success": "success_id"}
    wanted = chains.select(
        F.col("scan_id").alias("chain_id"), F.col("source_ip").alias("ip"), "event_time",
        F.explode(F.array(*[F.struct(F.lit(part).alias("part"), F.col(key).alias("event_id"))
                            for part, key in names.items()])).alias("w"))
    records = silver.select(F.col("id").alias("event_id"),
                            F.struct(*silver.columns).alias("record"))

    def part(name):
        # Copies of one record share its id and content: any of them will do.
        return F.first(F.when(F.col("part") == name, F.col("record")), ignorenulls=True)

    full = (wanted.select("chain_id", "ip", "event_time", "w.*").join(records, "event_id")
            .groupBy("chain_id", "ip", "event_time")
            .agg(F.struct(*[part(n).alias(n) for n in names]).alias("chain")))
    return full.select(
        F.concat(F.lit("cep_"), F.col("chain_id")).alias("id"),
        F.lit("cep_chain").alias("aggregation_type"),
        F.col("chain.success.source_ip").alias("source_ip"),
        F.lit("CORRELATED_ATTACK_CHAIN").alias("event_type"), F.lit("CRITICAL").alias("severity"),
        "event_time", F.lit(minutes_of(within)).alias("window_minutes"),
        F.lit(PATTERN).alias("pattern"), message(DESCRIPTION, F.col("ip")).alias("description"),
        "chain", F.lit(True).alias("aggregated"), F.lit(True).alias("correlated"))
