"""Operator 9: Order MinHash fingerprints.

A text's k-mers are numbered by occurrence, so a repeated k-mer counts as often
as it appears.  For each of SKETCHES hash functions the TUPLE pairs (k-mer,
occurrence) of least hash are taken, put back into the order they have in the
text, and the tuple of k-mers is hashed to one entry of the fingerprint.  Two texts'
likeness is the share of entries they have in common; it falls with their edit
distance, as moved passages change the order.  A likeness p has a standard error
of sqrt(p (1 - p) / SKETCHES): 0.03 where p is near 1/9, as for a text half replaced.

A hash is the product, in 32 bits, of the pair's mixed value and the function's
odd multiplier; the multipliers are unlike numbers from a fixed seed, so the functions
are as good as independent (``tests/llm`` measures the spread).  Of equal hashes the
first in the text is the lesser.  A text and its edited form share their beginning, so the
beginning's least pairs are found once for both.

A text shorter than K code points is one k-mer as a whole; with fewer than TUPLE k-mers all
are taken.  NULL and empty texts have the fingerprint of no k-mer.  Equal texts
have equal fingerprints, so ties and repeated rows are alike.  Very long texts are hashed in
stretches of bounded size.  ``with_next`` pairs each document with the next by
doc_id (NULL first, equal doc_ids by their texts' beginnings; the first follows the last; a sole document follows itself).
Other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, small_batches

K, TUPLE, SKETCHES = 5, 2, 128
#: Elements of the matrix of hashes held at a time, which fit a core's cache; longer texts are taken in stretches.
CELLS = 1 << 19
MIX = 0x9E3779B97F4A7C15
SEED = 1


def multipliers() -> list[int]:
    """SKETCHES odd numbers of 64 bits: a counter from SEED on, each well mixed."""
    m64, out = (1 << 64) - 1, []
    for i in range(SKETCHES):
        z = (SEED + i + 1) * MIX & m64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ z >> shift) * factor & m64
        out.append((z ^ z >> 31) | 1)
    return out


def pairs(text: str):
    """The k-mers' hashes, and the 32-bit values of the pairs (k-mer, occurrence), in the order of the text."""
    import numpy as np

    mix = np.uint64(MIX)
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    k = min(K, len(x))
    n = len(x) - k + 1
    gram = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        gram = (gram ^ x[i : i + n]) * mix
        gram ^= gram >> np.uint64(29)
    # occurrence numbers: equal k-mers side by side, in the order of the text
    by = np.argsort(gram, kind="stable")
    first = np.concatenate([[True], np.diff(gram[by]) != 0])
    at = np.arange(n)
    nth = np.empty(n, dtype=np.uint64)
    nth[by] = at - np.maximum.accumulate(np.where(first, at, 0))
    pair = (gram + nth * np.uint64(0xC2B2AE3D27D4EB4F)) * mix
    return gram, ((pair ^ pair >> np.uint64(31)) >> np.uint64(32)).astype(np.uint32)


def _least(pair, lo: int, hi: int, before=None):
    """Hashes and places of the TUPLE pairs of least hash of [lo, hi), for each hash function; ``before``: those of [0, lo)."""
    import numpy as np

    odd = _multipliers()[0]
    rows = np.arange(len(odd))
    least, where = before or (np.empty((len(odd), 0), dtype=np.uint32), np.empty((len(odd), 0), dtype=np.int64))
    step = max(TUPLE, CELLS // len(odd))
    for start in range(lo, hi, step):
        x = pair[None, start : min(start + step, hi)] * odd[:, None]
        taken = np.zeros((len(odd), 0), dtype=np.int64)
        for i in range(min(TUPLE, x.shape[1])):
            j = x.argmin(axis=1)
            if i and (again := (taken == j[:, None]).any(axis=1)).any():  # all that is left has the greatest hash
                for r in np.flatnonzero(again).tolist():
                    j[r] = np.flatnonzero(~np.isin(np.arange(x.shape[1]), taken[r]))[0]
            least, where, taken = np.column_stack([least, x[rows, j]]), np.column_stack([where, j + start]), np.column_stack([taken, j])
            x[rows, j] = np.uint32(0xFFFFFFFF)
        if least.shape[1] > TUPLE:
            best = np.argsort(least, axis=1, kind="stable")[:, :TUPLE]
            least, where = np.take_along_axis(least, best, 1), np.take_along_axis(where, best, 1)
    return least, where


_MADE: list = []


def _multipliers():
    """The multipliers in 32 and in 64 bits, made once a worker."""
    import numpy as np

    if not _MADE:
        wide = np.array(multipliers(), dtype=np.uint64)
        _MADE.append(((wide >> np.uint64(32)).astype(np.uint32) | np.uint32(1), wide))
    return _MADE[0]


def _entries(gram, where):
    """The fingerprint: tuples of k-mers in the order of the text, hashed."""
    import numpy as np

    out = _multipliers()[1].copy()
    for g in gram[np.sort(where, axis=1)].T:
        out = (out ^ g) * np.uint64(MIX)
        out ^= out >> np.uint64(32)
    return (out >> np.uint64(32)).astype(np.uint32)


class Print:
    """A text's fingerprint ``entries``, found in two parts: the beginning that an edit keeps, and the rest."""

    def __init__(self, text: str | None):
        import numpy as np

        self.text = text or ""
        self.cut = 0
        if not self.text:
            self.entries = np.zeros(SKETCHES, dtype=np.uint32)
            return
        gram, pair = pairs(self.text)
        self.cut = max(0, kept(self.text) - K + 1)  # k-mers inside the beginning; their occurrence numbers stay too
        self.begin = _least(pair, 0, self.cut)
        self.entries = _entries(gram, _least(pair, self.cut, len(pair), self.begin)[1])

    def of_edited(self, text: str):
        """The entries of a text with the same beginning."""
        if not self.cut:
            return fingerprint(text)
        gram, pair = pairs(text)
        return _entries(gram, _least(pair, self.cut, len(pair), self.begin)[1])


def fingerprint(text: str | None):
    """SKETCHES 32-bit entries."""
    return Print(text).entries


def likeness(a, b) -> float:
    return float((a == b).mean())


def text_of(entries) -> str:
    return entries.astype(">u4").tobytes().hex()


def kept(text: str) -> int:
    return len(text) - len(text) // 2


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by the first as many code points of the next."""
    return text[: kept(text)] + following[: len(text) // 2]


def _lead(text):
    """The first seven bytes of a text as a number, in the order of texts."""
    start = F.rpad(F.hex(F.substring(F.encode(F.coalesce(text, F.lit("")), "utf-8"), 1, 7)), 14, "0")
    return F.conv(start, 16, 10).cast("long")


def _ranges(d: DataFrame, n: int) -> tuple[list[int], dict[int, list[int]]]:
    """Quantiles of doc_id, where ranges begin; and for a range that is one hot doc_id the quantiles of its texts' leads.

    Range 0 holds the NULL doc_ids, range i those from the i-th cut on (the first from the least doc_id on)."""
    total, missing = d.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    at = [i / n for i in range(1, n)]
    found = (d.agg(F.percentile_approx("doc_id", at, 100 * n)).first()[0] or []) if at else []  # fewer than n numbers
    shares = {c: found.count(c) for c in set(found) if found.count(c) > 1}
    top = (1 << 63) - 1
    cuts = sorted({-(1 << 63), *found, *(c + 1 for c in shares if c < top)})
    if total and missing * n > total:
        shares[None] = missing * n // total
    if not shares:
        return cuts, {}
    hot = d.filter(F.col("doc_id").isin([c for c in shares if c is not None]) | (F.col("doc_id").isNull() & F.lit(None in shares)))
    leads = hot.groupBy("doc_id").agg(F.percentile_approx(_lead(F.col("text")), at, 100 * n).alias("q")).collect()  # fewer than n doc_ids
    inside = {}
    for r in leads:
        k, doc = shares[r["doc_id"]], r["doc_id"]
        inside[0 if doc is None else cuts.index(doc) + 1] = sorted({r["q"][i * len(r["q"]) // k] for i in range(1, k)})
    return cuts, inside


def _below(values: list[int], c):
    """How many of these numbers are at most ``c``, which is computed once."""
    known = F.array(*[F.lit(v).cast("long") for v in values])
    return F.transform(F.array(c), lambda x: F.size(F.filter(known, lambda e: e <= x)))[0]


def with_next(docs: DataFrame, use, schema: str) -> DataFrame:
    """Deal documents into ranges of (doc_id, text) and give ``use`` each document with the one that follows.

    ``use(doc_id, text, next_text)`` yields rows.  Ranges are cut at quantiles of
    doc_id, and inside a hot doc_id at quantiles of its texts' first bytes; the first
    document of a range also goes, as a guest, to the range before.  Equal doc_ids are
    ordered by the first 64 characters of their texts, then as ``docs`` gives them, which
    must be a fixed order, as of a scan or a written table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cuts, inside = _ranges(d, partitions(spark))
    given = F.col("doc_id").isNotNull()
    part = F.when(given, _below(cuts, F.col("doc_id"))).otherwise(F.lit(0))
    parts = len(cuts) + 1
    if inside:
        bases = [r + sum(len(q) for h, q in inside.items() if h < r) for r in range(parts)]
        within = F.lit(0)
        for r, q in inside.items():
            within = F.when(part == r, _below(q, _lead(F.col("text")))).otherwise(within) if q else within
        part = F.array(*map(F.lit, bases))[part] + within
        parts += sum(map(len, inside.values()))
    d = d.withColumns({"part": part, "m": F.monotonically_increasing_id()})
    start = F.substring("text", 1, 64)
    first = F.min(F.struct(given.alias("given"), "doc_id", F.col("text").isNotNull().alias("has"), start.alias("start"), "m"))
    starts = [tuple(r) for r in d.groupBy("part").agg(first.alias("f")).select("part", "f.m").orderBy("part").collect()]  # one row a range
    if not starts:
        return spark.createDataFrame([], schema)
    before = F.create_map(*[F.lit(x) for i, (_, m) in enumerate(starts) for x in (m, starts[i - 1][0])])
    host = F.array(F.struct(F.col("part").alias("to"), F.lit(False).alias("guest")), F.struct(F.try_element_at(before, F.col("m")).alias("to"), F.lit(True).alias("guest")))
    sent = d.select("doc_id", "text", "m", F.explode(host).alias("h")).select("doc_id", "text", "m", "h.to", "h.guest").filter("to is not null")
    sent = sent.repartitionById(parts, F.col("to")).sortWithinPartitions("guest", "doc_id", start, "m")

    def run(batches):
        held, rows, over = None, [], False
        for batch in batches:
            for doc, text, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "guest"))):
                if over:
                    break
                if held is not None:
                    rows.extend(use(held[0], held[1], text or ""))
                held, over = (doc, text or ""), guest
                if len(rows) >= 500:
                    yield arrow(rows)
                    rows = []
        if rows:
            yield arrow(rows)

    fields = T._parse_datatype_string(schema)

    def arrow(rows):
        import pyarrow as pa

        kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
        return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], kinds[t]) for f, t in names], names=[f for f, _ in names])

    names = [(f.name, f.dataType.simpleString()) for f in fields]
    return sent.mapInArrow(run, schema)


FINGERPRINTS = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and their likenesses."""
    return with_next(docs, _Rows(), FINGERPRINTS)


class _Rows:
    """Rows of ``fingerprints``; the next document's fingerprint is kept for when its turn comes."""

    def __init__(self):
        self.last = None

    def of(self, text: str) -> Print:
        if self.last is None or self.last.text != text:
            self.last = Print(text)
        return self.last

    def __call__(self, doc, text, following):
        own = self.of(text)
        other = edited(text, following)
        changed = own.of_edited(other)
        after = self.of(following)
        yield {
            "doc_id": doc, "n_chars": len(text), "edited_text": other, "fingerprint": text_of(own.entries), "edited_fingerprint": text_of(changed),
            "near_edited": likeness(own.entries, changed), "near_next": likeness(own.entries, after.entries),
        }
