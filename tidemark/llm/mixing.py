"""Operator 6: mixing sources to target weights under a time-varying curriculum.

1. ``targets``: each source's words for the whole run, by weight, none above a
   multiple of its own size; the excess is shared anew by weight (water-filling).
2. ``plan``: a source's documents, in a hashed order, are its stream of words;
   the stream is read once, twice or in part until its target is met, the last
   document in part.  Offsets in the stream are prefix sums over buckets of the
   hashed order, so a hot source is summed by many tasks.
3. Each source has a weight schedule over the run's time (0 to 1), piecewise
   linear.  Its integral is the source's cumulative demand; inverting that at a
   document's offset gives the position at which training wants it, and
   ``readings`` and ``in_training_order`` sort by ranges of position.

Size: number of ``[^\\x20\\x09-\\x0D]+`` in the text (NULL: 0).  Documents without words take
nothing.  A NULL source is a source of its own, ordered last; sources weigh
3, 1, 2, repeating.  Repeated rows (doc_id, text and source alike) share what
falls on them evenly; equal texts of other documents are other documents.  Very long texts
count like others: the last document of a target, however long, is taken in part.  Other
columns are ignored by the plan and passed on as they are by ``in_training_order``; an empty
table gives an empty plan.  The order comes from hashes of content, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, broadcast_if_small, partitions, scratch_root, written

WEIGHTS = (3, 1, 2)
#: Knots of the weight schedules, as shares of the run's time, and each weight class's course over them.
KNOTS = (0.0, 0.5, 1.0)
SCHEDULES = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (1.0, 1.0, 1.0))
BUCKET_ROWS = 5_000
#: Ranges of the hash between which the words before a document are interpolated.
KNOTS_A_SOURCE = 1024


def words(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words(F.col("text")).alias("size"),
        F.xxhash64(F.col("doc_id").cast("string"), "text", "source").alias("h"),
    )


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """source, source_size, weight, turn, target; one row a source."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(turn, F.lit(len(weights))) + 1).cast("int"))
    s = total.select("source", "source_size", turn.alias("turn"), w.cast("double").alias("weight"))
    s = s.withColumn("cap", F.col("source_size") * F.lit(cap))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), "turn")
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "budget": F.sum("source_size").over(every) * F.lit(share),
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(fullest.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    # sources reach their caps in the order of cap / weight; the first that does not sets the level for it and all behind
    level = (F.col("budget") - F.col("capped")) / F.col("open")
    s = s.withColumn("level", F.max(F.when(level <= F.col("cap") / F.col("weight"), level)).over(every))
    reached = F.col("level").isNull() | (F.col("cap") <= F.col("weight") * F.col("level"))
    return s.select("source", "source_size", "weight", "turn", F.when(reached, F.col("cap")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def position(share, turn):
    """The time at which a source of this turn has had this share of its demand: the inverse of its schedule's integral."""
    out = None
    for i, course in enumerate(SCHEDULES):
        steps = [(b - a) * (u + v) / 2 for a, b, u, v in zip(KNOTS, KNOTS[1:], course, course[1:])]
        whole, upto, here = sum(steps), 0.0, None
        for a, b, u, v, step in zip(KNOTS, KNOTS[1:], course, course[1:], steps):
            d = F.greatest(share * whole - F.lit(upto), F.lit(0.0))  # demand within this stretch
            slope = (v - u) / (b - a)  # u t + slope t^2 / 2 = d, in the form that also holds for no slope
            t = F.lit(a) + 2 * d / (F.lit(u) + F.sqrt(F.greatest(F.lit(u * u) + 2 * F.lit(slope) * d, F.lit(0.0))))
            t = F.least(t, F.lit(b))
            here = t if here is None else F.when(share * whole <= upto, here).otherwise(t)
            upto += step
        out = F.when(F.pmod(turn, F.lit(len(SCHEDULES))) == i, here) if out is None else out.when(F.pmod(turn, F.lit(len(SCHEDULES))) == i, here)
    return out


def plan(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """The rows' keys and sizes; and for each distinct key: target, taken, position of its first word."""
    spark = docs.sparkSession
    root = scratch_root(spark)
    rows = written(_key(docs), "sizes", root)
    n = rows.count()
    buckets = max(partitions(spark), -(-n // BUCKET_ROWS))
    # buckets are equal ranges of the hash, so their order is the order of the hash
    bucket = F.floor(F.shiftrightunsigned("h", 2).cast("double") * F.lit(buckets / 2.0**62)).cast("int").alias("bucket")
    units = rows.groupBy("source", "doc_id", "h", "size").agg(F.count("*").alias("rows"))
    units = units.select("*", bucket, (F.col("size") * F.col("rows")).alias("words"), F.shiftrightunsigned("h", 2).alias("o"))
    sums = rows.groupBy("source", bucket).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    goal = written(targets(rows, share, cap, weights), "targets", root)
    per_bucket = bases.join(goal, bases.source.eqNullSafe(goal.source)).select(bases.source.alias("s"), F.col("bucket").alias("b"), "base", "source_size", "target", "turn")
    inside = Window.partitionBy("source", "bucket").orderBy("o", "h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = units.withColumn("upto", F.sum("words").over(inside))
    placed = placed.join(per_bucket, placed.source.eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    start = F.col("base") + F.col("upto") - F.col("words")
    goal_words = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(goal_words / F.col("source_size"))).otherwise(F.lit(0))
    rest = goal_words - full * F.col("source_size")
    part = F.least(F.greatest(rest - start, F.lit(0)), F.col("words"))
    taken = full * F.col("words") + part
    at = F.when(F.col("target") > 0, position(F.least(start / F.col("target"), F.lit(1.0)), F.col("turn")))
    units = placed.select("source", "doc_id", "h", "size", "source_size", "target", F.floor(taken / F.col("rows")).cast("long").alias("taken"), at.alias("position"), "turn", start.alias("start"), "rows")
    return rows, units


def _ordered(units: DataFrame) -> DataFrame:
    """The units, with a row for each reading, in training order, written; those without a reading (nth, words, at and place NULL) come last."""
    spark, size, nth = units.sparkSession, F.col("size"), F.col("nth")
    times = F.floor((F.col("taken") + size - 1) / size)
    read = units.select("*", F.explode_outer(F.when(F.col("taken") > 0, F.sequence(F.lit(0).cast("long"), times - 1))).alias("nth"))
    offset = F.col("start") + nth * F.col("source_size")
    at = position(F.least(offset / F.col("target"), F.lit(1.0)), F.col("turn"))
    read = read.select(
        "source", "doc_id", "h", "size", "source_size", "target", "position", "nth",
        F.when(nth.isNotNull(), F.least(size, F.col("taken") - nth * size)).alias("words"), F.when(nth.isNotNull(), at).alias("at"))
    order = [F.col("at").asc_nulls_last(), "h", "doc_id", "nth"]
    read = read.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    line = F.monotonically_increasing_id()  # task and line of the sorted rows
    read = written(read.select("*", F.shiftrightunsigned(line, 33).alias("part"), line.bitwiseAND((1 << 33) - 1).alias("line")), "readings")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    parts = read.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return read.join(F.broadcast(parts), "part").withColumn("place", F.when(nth.isNotNull(), F.col("base") + F.col("line"))).drop("part", "line", "base")


def readings(units: DataFrame) -> DataFrame:
    """The plan carried out: one row for each reading of a document, in training order.

    nth (from 0), words (fewer than ``size`` where a target ends), at: its position, the schedule
    inverted at the offset of this reading in the source's stream (each reading of the whole source
    lies a source's length behind the one before), and place: its number in the order, gapless from 0.
    Repeated rows are read together."""
    return _ordered(units).filter("nth is not null").select("source", "doc_id", "h", "nth", "words", "at", "place")


def mix(docs: DataFrame, **how) -> DataFrame:
    """Every row of ``docs``: doc_id, source, size, source_size, target, and what its readings in the mix add up to.

    taken: their words; readings: how many; last_position, first_place and last_place: where training reads
    it (NULL if it does not).  position: where the stream first comes to the document, read or not."""
    rows, units = plan(docs, **how)
    key = ["source", "doc_id", "h", "size"]
    units = _ordered(units).groupBy(*[F.col(c).alias(f"_{c}") for c in key], "source_size", "target", "position").agg(
        F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"), F.count("nth").alias("readings"), F.max("at").alias("last_position"),
        F.min("place").alias("first_place"), F.max("place").alias("last_place"))
    same = [rows[c].eqNullSafe(F.col(f"_{c}")) if c in ("source", "doc_id") else rows[c] == F.col(f"_{c}") for c in key]
    return rows.join(units, same).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "position", "readings", "last_position", "first_place", "last_place")


def _courses(units: DataFrame) -> DataFrame:
    """What a row's hash needs to know: for each source and knot of the hash's range, of which there are KNOTS_A_SOURCE.

    The words before the knot's range and before its last document, the places of its first and
    last, and for the source its targets, its whole readings and ``cut``, the last place in the
    hashed order that is read once more.
    """
    size, goal = F.col("size"), F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    times = F.floor((2 * F.col("taken") + size) / (2 * size))  # rounded readings
    place = F.struct(F.shiftrightunsigned("h", 2).alias("o"), "h")
    o = F.shiftrightunsigned("h", 2)
    worded = units.filter("size > 0").withColumns({"o": o, "knot": _knot(o), "whole": whole, "cut": F.when(times > whole, place), "words": size * F.col("rows")})
    sums = worded.groupBy("source", "source_size", "target", "turn", "whole", "knot").agg(
        F.sum("words").alias("here"), F.max_by("words", "o").alias("last"), F.min("o").alias("lo"), F.max("o").alias("hi"), F.max("cut").alias("cut"))
    source = Window.partitionBy("source")
    before = source.orderBy("knot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"before": F.coalesce(F.sum("here").over(before), F.lit(0)), "cut": F.max("cut").over(source)})
    return sums.withColumn("inside", F.col("here") - F.col("last")).drop("here", "last")


def _knot(o):
    return F.floor(o.cast("double") * F.lit(KNOTS_A_SOURCE / 2.0**62)).cast("int")


def in_training_order(docs: DataFrame, place: str | None = None, **how) -> DataFrame:
    """The documents as training reads them: one row for each reading, range-sorted by position.

    A reading that the plan takes in part is kept whole if at least half of it
    is taken.  The second reading of a document comes a source's length later
    in the stream, so later in the run.  ``place`` names a further column with the position.

    How often a row is read follows from its hash: all up to its source's ``cut`` once more than
    the rest.  Its position is the plan's, with the words before it interpolated between knots.  So
    texts are shuffled once, into the order.  Written, the files hold the order; see ``as_written``.
    """
    spark = docs.sparkSession
    _, units = plan(docs, **how)
    courses = written(_courses(units), "courses")
    c = broadcast_if_small(courses.withColumnsRenamed({"source": "s", "knot": "k"}))  # KNOTS_A_SOURCE rows a source
    h = F.xxhash64(F.col("doc_id").cast("string"), "text", "source")
    keyed = as_row(docs, h.alias("h"), F.shiftrightunsigned(h, 2).alias("o"), F.col("source").cast("string").alias("source"), F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    keyed = keyed.filter("worded").withColumn("knot", _knot(F.col("o")))
    read = keyed.join(c, keyed["source"].eqNullSafe(c["s"]) & (keyed["knot"] == c["k"]))
    times = F.col("whole") + F.coalesce(F.struct("o", "h") <= F.col("cut"), F.lit(False)).cast("int")
    read = read.withColumn("times", times.cast("int")).filter("times > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("nth"))
    along = (F.col("o") - F.col("lo")).cast("double") / F.greatest(F.col("hi") - F.col("lo"), F.lit(1))
    start = F.col("before") + F.col("inside") * along
    at = position(F.least((start + F.col("nth") * F.col("source_size")) / F.col("target"), F.lit(1.0)), F.col("turn"))
    read = read.select("row", at.alias("at"), "h").repartitionByRange(partitions(spark), "at", "h").sortWithinPartitions("at", "h")
    return read.select("row.*", *([F.col("at").alias(place)] if place else []))


WRITTEN_PLACE = ["name_length", "name", "line"]


def as_written(docs: DataFrame) -> DataFrame:
    """doc_id and text with their places (WRITTEN_PLACE) in the Parquet files that ``docs`` reads, in the order of writing.

    Spark numbers the files of a table by partition, so a table written from
    ``in_training_order`` holds the training order.  What isn't read from files is written first.
    """
    from pyspark.errors import AnalysisException

    def places(table):
        m = table.metadataColumn("_metadata")
        return table.select("doc_id", "text", F.length(m["file_name"]).alias("name_length"), m["file_name"].alias("name"), m["row_index"].alias("line"))

    try:
        return places(docs)
    except AnalysisException:
        return places(written(docs, "readings"))
