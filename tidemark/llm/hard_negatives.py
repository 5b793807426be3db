"""Operator 13: hard negatives by exact integer products of tiles, and mergeable heaps.

1. Rows become tiles of about ``TILE`` rows: a matrix of int64 components, with
   ids and labels.  A label with at least ``TILE`` rows has tiles of its own
   (rows are dealt over them by a hash, so a hot label is many tiles); smaller
   labels share bins.  Anchors, a stated share of the rows, have tiles of their own.
2. ``strassen`` multiplies an anchor tile with a candidate tile: odd sides are
   padded with zeros, quarters are combined by seven recursive products and
   exact int64 additions.
3. First pass: anchor tiles meet the candidate tiles of their own class only, and
   each anchor keeps a heap of its best rows of the same label.  Heaps of equal
   anchors merge in the task, and tasks' heaps by a ranking that Spark also
   applies before the shuffle.
4. Second pass: anchor tiles, with their positives' scores, meet the candidate
   tiles of other labels.  Each (anchor, positive) keeps a heap of the best rows
   inside the positive's window of scores.

A pair of tiles is multiplied in one pass, never in both (bins of small labels
excepted).  Pairs are dealt over a grid of cells of at most ``CELL`` by ``CELL``
tiles, so a task holds two tiles and one row of heaps whatever the table's size.

Rows with a NULL label, a NULL vector or a NULL or non-finite component take no
part.  Components become floor(256 x) in int64, held to plus or minus 2**62; sums
beyond int64 wrap.  A vector shorter than another counts as zeros from its end on,
an empty one as zeros throughout.  Ties of score: smaller id first, NULL ids last,
then an arbitrary but fixed order of rows.  Repeated rows are rows of their own:
a copy of an anchor may be its positive, and an anchor that is there twice is
mined twice.  A NULL id is never an anchor.  Other columns are ignored, whatever
their names; texts play no part; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import broadcast_if_small, partitions, scratch_root, written

TILE, CELL = 1024, 32
#: Candidate tiles whose anchors share an anchor tile.
SPREAD = 16
#: Sides up to which a product is not split further, and heaps held by a task.
LEAF, HELD = 32, 64

NO_ID = (1 << 63) - 1  # stands for a NULL id in tiles: after all others


def strassen(a, b):
    """The product of two int64 matrices."""
    import numpy as np

    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    y, x, z = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:y, :x], a[:y, x:], a[y:, :x], a[y:, x:]
    b11, b12, b21, b22 = b[:x, :z], b[:x, z:], b[x:, :z], b[x:, z:]
    p1, p2, p3 = strassen(a11 + a22, b11 + b22), strassen(a21 + a22, b11), strassen(a11, b12 - b22)
    p4, p5 = strassen(a22, b21 - b11), strassen(a11 + a12, b22)
    p6, p7 = strassen(a21 - a11, b11 + b12), strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * y, 2 * z), dtype=np.int64)
    out[:y, :z], out[:y, z:] = p1 + p4 - p5 + p7, p3 + p5
    out[y:, :z], out[y:, z:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """For each of some rows and windows the best ``size`` (score, id, uid): higher score, then smaller id, then uid."""

    def __init__(self, score, ids, uid, valid):
        self.parts = [valid, score, ids, uid]

    @classmethod
    def best(cls, scores, inside, ids, uid, size: int):
        """From a row's scores of a tile, whose columns are in the order of (id, uid); ``inside``: the columns that count."""
        import numpy as np

        left, low = np.where(inside, scores, np.iinfo(np.int64).min), np.arange(len(scores))
        left_in, parts = inside.copy(), []
        for _ in range(min(size, scores.shape[1])):
            at = left.argmax(axis=1)  # the first of equals
            if (left[low, at] == np.iinfo(np.int64).min).any():  # nothing left, or a score that looks like it
                at = np.where(left_in[low, at], at, left_in.argmax(axis=1))
            parts.append((left_in[low, at], scores[low, at], ids[at], uid[at]))
            left[low, at], left_in[low, at] = np.iinfo(np.int64).min, False
            if not left_in.any():
                break
        valid, *rest = (np.stack(p, axis=1) for p in zip(*parts))
        return cls(*rest, valid)

    def merge(self, other: "Heaps", size: int) -> "Heaps":
        import numpy as np

        valid, score, ids, uid = (np.concatenate(p, axis=1) for p in zip(self.parts, other.parts))
        order = np.lexsort((uid, ids, ~score, ~valid), axis=1)[:, :size]  # ~score falls as the score rises, without overflow
        return Heaps(*(np.take_along_axis(p, order, axis=1) for p in (score, ids, uid, valid)))


def _tile_schema(extra: str = "") -> str:
    return "single boolean, class long, t long, rows int, width int, ids binary, uids binary, labels binary, matrix binary" + extra


def _tiles(rows: DataFrame, t: Column) -> DataFrame:
    """One row a (single, class, t): its rows in the order of (id, uid)."""

    def build(table):
        import numpy as np
        import pyarrow as pa

        ids = table.column("vec_id").fill_null(NO_ID).to_numpy().astype(np.int64)
        uid, label = (table.column(c).to_numpy().astype(np.int64) for c in ("uid", "label"))
        vector = table.column("vector").combine_chunks()
        ends = vector.offsets.to_numpy().astype(np.int64)
        flat = vector.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(ends)
        with np.errstate(over="ignore"):
            whole = np.clip(np.floor(flat[ends[0] : ends[-1]] * 256.0), -(2.0**62), 2.0**62).astype(np.int64)
        matrix = np.zeros((len(ids), max(1, int(sizes.max(initial=0)))), dtype=np.int64)
        at = np.repeat(np.arange(len(ids)), sizes)
        matrix[at, np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = whole
        order = np.lexsort((uid, ids))
        one = [table.column(c)[0].as_py() for c in ("single", "class", "t")]
        blobs = [x[order].tobytes() for x in (ids, uid, label, matrix)]
        names = ["single", "class", "t", "rows", "width", "ids", "uids", "labels", "matrix"]
        types = [pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array([v], k) for v, k in zip([*one, len(ids), matrix.shape[1], *blobs], types)], names=names)

    return rows.withColumn("t", t).groupBy("single", "class", "t").applyInArrow(build, _tile_schema())


def _as_arrays(row: dict, side: str):
    """ids, uids, labels, matrix of one tile of a pair."""
    import numpy as np

    ids, uid, label, m = (np.frombuffer(row[f"{side}_{c}"], np.int64) for c in ("ids", "uids", "labels", "matrix"))
    return ids, uid, label, m.reshape(len(ids), row[f"{side}_width"])


def _product(a, c):
    """Scores of tiles whose widths may differ."""
    k = min(a.shape[1], c.shape[1])
    return strassen(a[:, :k], c[:, :k].T)


HEAP = "uid long, anchor_id long, window int, score long, id long, other long"


def _fold(pairs: DataFrame, size: int, windows) -> DataFrame:
    """Heaps of all pairs of tiles; ``windows`` gives (window, rows, scores, mask) of one pair."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held: dict[tuple, tuple] = {}

        def rows():
            cols = [[] for _ in range(6)]
            for (*_, w), (uid, ids, heap) in held.items():
                valid, *parts = heap.parts
                r, s = np.nonzero(valid)
                for c, x in zip(cols, (uid[r], ids[r], np.full(len(r), w), *(p[r, s] for p in parts))):
                    c.append(x)
            held.clear()
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = [f.split()[0] for f in HEAP.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(cols, kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):  # a row is a pair of whole tiles
                row = batch.slice(i, 1).to_pylist()[0]
                a, c = _as_arrays(row, "a"), _as_arrays(row, "c")
                scores = _product(a[3], c[3])
                for w, who, inside in windows(row, a, c, scores):
                    if not inside.any():
                        continue
                    key = (row["a_single"], row["a_class"], row["a_t"], w)
                    heap = Heaps.best(scores[who], inside, c[0], c[1], size)
                    # rows of a window are all its anchors, so heaps of one key have the same rows
                    if key in held:
                        heap = held[key][2].merge(heap, size)
                    held[key] = (a[1][who], a[0][who], heap)
                if len(held) > HELD:
                    yield rows()
        if held:
            yield rows()

    return pairs.mapInArrow(run, HEAP)


def _ranked(heaps: DataFrame, size: int) -> DataFrame:
    """The best ``size`` of each (anchor, window); the ranking is also applied before the shuffle."""
    best = Window.partitionBy("uid", "window").orderBy(F.col("score").desc(), "id", "other")
    return heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)


def _sides(anchors: DataFrame, tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    named = lambda df, s: df.select(*[F.col(c).alias(c if c in ("g", "h") else f"{s}_{c}") for c in df.columns])
    return named(anchors, "a"), named(tiles, "c")


def mine(table: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """``table`` (vec_id, embedding, label): the best negatives of each anchor and positive.

    A negative's score lies between ``low`` percent of the positive's and the positive's own.
    ``anchor`` says of a row, by its vec_id, whether it is an anchor.  Columns: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = table.sparkSession
    root, parts = scratch_root(spark), partitions(spark)
    vector = F.col("embedding").cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(F.forall("vector", fine), F.lit(False)))
    rows = written(rows.withColumn("uid", F.monotonically_increasing_id()), "rows", root)  # uids are fixed from here on

    sizes = written(rows.groupBy("label").agg(F.count("*").alias("n")), "labels", root)
    small = sizes.filter(F.col("n") < TILE).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bins = max(1, -(-small // TILE))
    single = F.col("n") >= TILE
    dealt = rows.join(broadcast_if_small(sizes), "label").select(
        "vec_id", "label", "vector", "anchor", "uid", single.alias("single"),
        F.when(single, F.col("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(bins))).alias("class"),
        F.when(single, F.ceil(F.col("n") / TILE)).otherwise(F.lit(1)).cast("long").alias("n_tiles"),
    )
    own = F.pmod(F.xxhash64("uid"), F.col("n_tiles"))
    tiles = written(_tiles(dealt, own), "tiles", root)
    counts = tiles.groupBy("single", "class").agg((F.max("t") + 1).alias("n_tiles"))
    shared = F.floor(own / SPREAD)
    anchor_tiles = written(_tiles(dealt.filter("anchor"), shared), "anchors", root)

    # first pass: tiles of one class; a class's cells are CELL by CELL tiles
    counts = written(counts, "counts", root)
    a = anchor_tiles.join(broadcast_if_small(counts), ["single", "class"])
    a = a.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tiles") - 1) / CELL))).alias("h"), F.floor(F.col("t") / CELL).alias("g")).drop("n_tiles")
    c = tiles.join(broadcast_if_small(counts), ["single", "class"])
    last = F.floor(F.floor((F.col("n_tiles") - 1) / SPREAD) / CELL)
    c = c.select("*", F.explode(F.sequence(F.lit(0), last)).alias("g"), F.floor(F.col("t") / CELL).alias("h")).drop("n_tiles")
    left, right = _sides(a, c)
    pairs = left.join(right, (F.col("a_single") == F.col("c_single")) & (F.col("a_class") == F.col("c_class")) & (left.g == right.g) & (left.h == right.h)).drop("g", "h")

    def same_label(row, a, c, scores):
        yield 0, slice(None), (a[2][:, None] == c[2][None, :]) & (a[1][:, None] != c[1][None, :])

    best = _ranked(_fold(pairs, positives, same_label), positives).drop("window")
    best = written(best.withColumnRenamed("rank", "window"), "positives", root)

    # second pass: every anchor tile, with its positives' scores, and all tiles of other classes (or of the same bin)
    goals = best.groupBy("uid").agg(F.collect_list(F.struct("window", "score")).alias("goals"))  # at most ``positives``
    where = dealt.filter("anchor").select("uid", "single", "class", shared.alias("t")).join(goals, "uid")
    per_tile = where.groupBy("single", "class", "t").agg(F.collect_list(F.struct("uid", "goals")).alias("goals"))  # one tile's anchors
    n_tiles, n_anchors = tiles.count(), anchor_tiles.count()
    across, down = max(-(-n_tiles // CELL), min(n_tiles, parts), 1), max(-(-n_anchors // CELL), 1)
    cell = lambda n: F.pmod(F.xxhash64("single", "class", "t"), F.lit(n))
    a = anchor_tiles.join(per_tile, ["single", "class", "t"]).select("*", cell(down).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("h"))
    c = tiles.select("*", cell(across).alias("h"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("g"))
    left, right = _sides(a, c)
    apart = ~(F.col("a_single") & F.col("c_single") & (F.col("a_class") == F.col("c_class")))
    pairs = left.join(right, (left.g == right.g.cast("long")) & (left.h.cast("long") == right.h) & apart).drop("g", "h")

    def in_window(row, a, c, scores):
        import numpy as np

        other = a[2][:, None] != c[2][None, :]
        at = {u: i for i, u in enumerate(a[1].tolist())}
        by: dict[int, list] = {}
        for entry in sorted(row["a_goals"], key=lambda e: e["uid"]):
            for goal in entry["goals"]:
                by.setdefault(goal["window"], []).append((at[entry["uid"]], goal["score"]))
        for w, found in by.items():
            who = np.array([i for i, _ in found])
            top = np.array([p for _, p in found], dtype=np.int64)[:, None]
            least = top // 100 * low - (-low * (top % 100)) // 100  # low percent, rounded up, without overflow
            s = scores[who]
            yield w, who, other[who] & (s >= least) & (s <= top)

    found = written(_ranked(_fold(pairs, negatives, in_window), negatives), "negatives", root)
    p = best.select("uid", "window", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.drop("anchor_id").join(p, ["uid", "window"])
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(
        "anchor_id", real("positive_id").alias("positive_id"), F.col("rank").cast(T.IntegerType()).alias("rank"),
        real("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
