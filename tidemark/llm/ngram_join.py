"""Operator 4: n-gram Jaccard join with prefix filters under several global orders.

A document's set holds its distinct word shingles (64-bit hashes).  If two sets
of sizes n have Jaccard similarity t or more, then under any order of all
shingles their first n - ceil(t n) + 1 have one in common.

1. Document frequencies of all shingles: tasks send sorted, gap-coded shingle
   slots, each once with its count, to their owners, which add them up.  Shingles in FREQUENT documents or
   more form a table of frequency classes, of at most TABLE entries (with more,
   the lowest classes are left out; that costs time, not results).
2. Every order sorts by class first, so rare shingles lead and shared passages
   come last, and then by another hash.  A document's prefix under the first
   order makes candidates, those under the others filter them.  The first
   shingle that a pair shares lies no deeper in either set than leaves room for
   the overlap it needs; a shared shingle that lies deeper makes no candidate.
3. Rare prefix shingles go to owners in packed messages; a run of equal ones is
   short, and all its pairs of compatible lengths are candidates.  Documents
   with frequent prefix shingles first meet one hub a shingle (chosen by a hash
   of shingle and document): links found there join documents into components,
   and only pairs in different components that share a shingle are left as
   candidates for the second round.  So a large group is never paired up.
4. Candidates' prefixes under the further orders are streamed past their hub's;
   a pair must share a prefix shingle under each.
5. What is left is verified on whole sets, streamed in the same way.

The component of a document is the least doc_id that links reach.  Equal sets
are one node from the start.  A row without doc_id has no component; rows that
share a doc_id are one node, linked where any of them is.  NULL, empty and
blank texts have an empty set and no link; a text with fewer words than a
shingle is one shingle.  Very long texts are sets like others, made in one task each.  Other
columns are ignored by ``near_duplicates`` and passed on as they are by
``drop_near_duplicates``; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, broadcast_if_small, partitions, scratch_root, small_batches, written
from tidemark.llm.components import components

FREQUENT, TABLE = 16, 2_000_000
ORDERS = 3
#: Shingles or prefix entries a task gathers before it sends them, and the longest run that is paired as it stands.
ROUND, RUN = 2_000_000, 64
#: Shingles an owner counts; members of a hub that one group of the verification has.
OWNED, MEMBERS = 4_000_000, 1_000
#: Bytes of a word with its space, by which shingles are reckoned before they are made.
WORD_BYTES = 6

_MIX = 0x9E3779B97F4A7C15
_SEEDS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def shingles(text: str | None, n: int):
    """Sorted distinct 64-bit hashes of a whole text's shingles of n words."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z, and the six ASCII white spaces
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(n, len(w))
    m = len(w) - k + 1
    h = np.full(m, k, dtype=np.uint64)
    for i in range(k):
        h = (h ^ w[i : i + m]) * np.uint64(_MIX)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def least_overlap(n, percent: int):
    """The fewest shingles that a set of n shares with one that is similar enough."""
    return -(-percent * n // 100)


class Orders:
    """Global orders of shingles: by frequency class, then by another hash each."""

    def __init__(self, slots, classes, bits: int):
        self.slots, self.classes, self.bits = slots, classes, bits

    def classes_of(self, h):
        import numpy as np

        if not len(self.slots):
            return np.zeros(len(h), dtype=np.uint64)
        slot = h >> np.uint64(64 - self.bits)
        at = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
        return np.where(self.slots[at] == slot, self.classes[at], 0).astype(np.uint64)

    def prefix(self, h, classes, k: int, percent: int):
        """Places in ``h`` of the prefix under order k, in that order."""
        import numpy as np

        size = len(h) - least_overlap(len(h), percent) + 1
        x = h * np.uint64(_SEEDS[k])
        x ^= x >> np.uint64(32)
        key = (classes << np.uint64(58)) | ((x * np.uint64(_MIX)) >> np.uint64(6))
        some = np.argpartition(key, size - 1)[:size] if size < len(h) else np.arange(len(h))
        return some[np.argsort(key[some], kind="stable")]


def _frequent(docs: DataFrame, n: int, root: str) -> tuple:
    """Slots and classes (2 for FREQUENT documents, one more for each doubling) of frequent shingles; bits of a slot."""
    import numpy as np

    spark = docs.sparkSession
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    words = rows + size // WORD_BYTES  # more than there are shingles, as a rule
    bits = min(48, max(32, math.ceil(math.log2(words + 1)) + 3))
    owners = max(partitions(spark), words // OWNED)
    bounds = [(i << bits) // owners for i in range(owners + 1)]

    def send(batches):
        import pyarrow as pa

        held, size = [], 0

        def flush():
            slots, counts = np.unique(np.concatenate(held), return_counts=True)  # a hot shingle is one entry
            ends = np.searchsorted(slots, np.array(bounds, dtype=np.uint64))
            who = np.flatnonzero(np.diff(ends)).tolist()
            coded, often = [], []
            for o in who:
                gaps = np.diff(slots[ends[o] : ends[o + 1]], prepend=np.uint64(bounds[o]))
                coded.append(gaps.astype("<u2" if gaps.max() < 1 << 16 else "<u8").tobytes())
                mine = counts[ends[o] : ends[o + 1]]
                more = np.flatnonzero(mine > 1)
                often.append(np.stack([more, mine[more]], axis=1).astype("<u4").tobytes())
            sizes = [int(ends[o + 1] - ends[o]) for o in who]
            return pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), pa.array(sizes, pa.int32()), pa.array(coded, pa.binary()), pa.array(often, pa.binary())], names=["owner", "n", "gaps", "often"])

        for batch in batches:
            for t in batch.column("text").to_pylist():
                held.append(shingles(t, n) >> np.uint64(64 - bits))
                size += len(held[-1])
                if size >= ROUND:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def count(key, table):
        import pyarrow as pa

        low = np.uint64(bounds[key[0].as_py()])
        got, times = [], []
        for m, gaps, often in zip(*(table.column(c).to_pylist() for c in ("n", "gaps", "often"))):
            got.append(np.cumsum(np.frombuffer(gaps, dtype=f"<u{len(gaps) // m}").astype(np.uint64)) + low)
            times.append(np.ones(m, dtype=np.uint32))
            more = np.frombuffer(often, dtype="<u4").reshape(-1, 2)
            times[-1][more[:, 0]] = more[:, 1]
        slots, times = np.concatenate(got), np.concatenate(times)
        by = np.argsort(slots, kind="stable")
        slots, times = slots[by], times[by]
        first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        slots, counts = slots[first], np.add.reduceat(times.astype(np.int64), first)
        often = counts >= FREQUENT
        classes = (np.log2(counts[often] / FREQUENT) + 2).astype(np.uint8)
        by = np.bincount(classes, minlength=64)
        return pa.table({"slots": [slots[often].astype("<u8").tobytes()], "classes": [classes.tobytes()], "by_class": pa.array([by.tolist()], pa.list_(pa.int64()))})

    sent = docs.select("text").mapInArrow(send, "owner int, n int, gaps binary, often binary")
    table = written(sent.groupBy("owner").applyInArrow(count, "slots binary, classes binary, by_class array<long>"), "frequent", root)
    by_class = np.zeros(64, dtype=np.int64)
    for r in table.select("by_class").collect():  # 64 numbers an owner
        by_class += np.array(r[0][:64])
    above = np.cumsum(by_class[::-1])[::-1]
    lowest = int(np.argmax(above <= TABLE))

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            slots, classes = [], []
            for s, c in zip(batch.column("slots").to_pylist(), batch.column("classes").to_pylist()):
                s, c = np.frombuffer(s, dtype="<u8"), np.frombuffer(c, dtype=np.uint8)
                slots.append(s[c >= lowest].tobytes())
                classes.append(c[c >= lowest].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.binary()), pa.array(classes, pa.binary())], names=["slots", "classes"])

    got = table.select("slots", "classes").mapInArrow(cut, "slots binary, classes binary").collect()  # TABLE entries at most
    slots = np.frombuffer(b"".join(r["slots"] for r in got), dtype="<u8")
    classes = np.frombuffer(b"".join(r["classes"] for r in got), dtype=np.uint8)
    by = np.argsort(slots, kind="stable")
    return slots[by], classes[by], bits


def _prefixes(docs: DataFrame, n: int, percent: int, orders) -> DataFrame:
    """doc_id, size, two halves of the set's hash; and of the first row with a set in its task, the first prefix.

    The prefix comes as two lists, the rare shingles and the frequent ones behind them.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        o, seen = orders.value, set()
        types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                h = shingles(text, n)
                sig = xxh3_128_digest(h.tobytes())
                row = [doc, len(h), *(int(x) for x in np.frombuffer(sig, dtype="<i8")), None, None]
                if len(h) and doc is not None and sig not in seen:
                    seen.add(sig)
                    c = o.classes_of(h)
                    first = o.prefix(h, c, 0, percent)
                    rare = c[first] == 0
                    row[4], row[5] = h[first[rare]].view(np.int64), h[first[~rare]].view(np.int64)
                rows.append(row)
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "n", "s1", "s2", "rare", "often"])

    schema = "doc_id long, n long, s1 long, s2 long, rare array<long>, often array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _rare_candidates(prefixes: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs that share a rare prefix shingle; or a with its depth and a shingle that too many share to pair."""
    spark = prefixes.sparkSession
    q = max(partitions(spark) - 1, 1).bit_length()

    def send(batches):
        import numpy as np
        import pyarrow as pa

        held, size = [], 0

        def flush():
            h, doc, m, at = (np.concatenate([x[i] for x in held]) for i in range(4))
            by = np.argsort(h)
            h, doc, m, at = h[by], doc[by], m[by], at[by]
            owner = (h >> np.uint64(64 - q)).astype(np.int64)
            ends = np.searchsorted(owner, np.arange((1 << q) + 1))
            rest = (h << np.uint64(q)) >> np.uint64(32)
            who = np.flatnonzero(np.diff(ends)).tolist()
            cut = lambda x, t: pa.array([x[ends[o] : ends[o + 1]].astype(t).tobytes() for o in who], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), cut(rest, "<u4"), cut(doc, "<i8"), cut(m, "<u4"), cut(at, "<u4")], names=["owner", "h", "doc", "n", "at"])

        for batch in batches:
            lists = batch.column("rare")
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            if not lengths.sum():
                continue
            docs, ns = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), lengths).astype(np.int64) for c in ("doc_id", "n"))
            at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            held.append((lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), docs, ns, at))
            size += int(lengths.sum())
            if size >= ROUND:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def pair(key, table):
        import numpy as np
        import pyarrow as pa

        h, doc, m, at = (np.concatenate([np.frombuffer(x, dtype=t) for x in table.column(c).to_pylist()]).astype(np.int64) for c, t in (("h", "<u4"), ("doc", "<i8"), ("n", "<u4"), ("at", "<u4")))
        by = np.lexsort((doc, h))
        h, doc, m, at = h[by], doc[by], m[by], at[by]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        long = np.diff(start, append=len(h))
        many = np.repeat(long > RUN, long)
        few = ~many & np.repeat(long > 1, long)
        hf, df, mf, af = h[few], doc[few], m[few], at[few]
        ids, code = np.unique(df, return_inverse=True)  # a pair is one number; pairs that share many shingles are made often
        out, made = [np.zeros(0, dtype=np.int64)], 0
        for d in range(1, int(min(RUN, long.max(initial=1)))):
            same = hf[d:] == hf[:-d]
            if not same.any():
                break
            needed = -(-percent * (mf[:-d] + mf[d:]) // (100 + percent))
            ok = same & (df[:-d] != df[d:]) & (af[:-d] <= mf[:-d] - needed) & (af[d:] <= mf[d:] - needed)
            out.append(code[:-d][ok] * len(ids) + code[d:][ok])
            made += len(out[-1])
            if made > ROUND:
                out = [np.unique(np.concatenate(out))]
                made = 0
        pairs = np.unique(np.concatenate(out))
        left, right = ids[pairs // max(1, len(ids))], ids[pairs % max(1, len(ids))]
        none = lambda k: pa.nulls(k, pa.int64())
        k = int(many.sum())
        return pa.table({
            "a": pa.array(np.concatenate([left, doc[many]])),
            "b": pa.concat_arrays([pa.array(right), none(k)]),
            "token": pa.concat_arrays([none(len(pairs)), pa.array((np.int64(key[0].as_py()) << np.int64(32)) | h[many])]),
            "at": pa.concat_arrays([none(len(pairs)), pa.array(at[many])]),
            "n": pa.concat_arrays([none(len(pairs)), pa.array(m[many])]),
        })

    sent = prefixes.select("doc_id", "n", "rare").mapInArrow(send, "owner int, h binary, doc binary, n binary, at binary")
    return sent.groupBy("owner").applyInArrow(pair, "a long, b long, token long, at long, n long")


def _has_room(percent: int):
    """Whether a shingle that lies at (ata, atb) may be the first that similar sets of sizes (na, nb) share."""
    needed = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    return (F.col("ata") <= F.col("na") - needed) & (F.col("atb") <= F.col("nb") - needed)


def _checked(pairs: DataFrame, docs: DataFrame, make, alike, root: str, name: str) -> DataFrame:
    """The pairs (a, b), a written table, for which ``alike(make(text of a), make(text of b))`` holds.

    Only what ``make`` gives (bytes) of the documents in pairs is shuffled, and
    a hub's members stream past it, in groups of about MEMBERS.
    """
    spark = docs.sparkSession
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("groups"))
    pairs = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("g"))
    wanted = pairs.select("a", "g", F.col("b").alias("doc"), F.lit(True).alias("member"))
    wanted = written(wanted.union(pairs.select("a", "g", F.col("a").alias("doc"), F.lit(False)).distinct()), f"{name}-wanted", root)
    ids = written(wanted.select(F.col("doc").alias("doc_id")).distinct(), f"{name}-ids", root)

    def made(batches):
        import pyarrow as pa

        for batch in batches:
            found = [make(t) if t else b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc", "h"])

    def check(batches):
        import pyarrow as pa

        hub, own = None, []
        for batch in batches:
            out = []
            for a, g, doc, member, h in zip(*(batch.column(c).to_pylist() for c in ("a", "g", "doc", "member", "h"))):
                if hub != (a, g):
                    hub, own = (a, g), []
                if not member:
                    own.append(h)
                elif any(alike(x, h) for x in own):
                    out.append((a, doc))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(broadcast_if_small(ids), "doc_id", "left_semi")
    have = given.mapInArrow(made, "doc long, h binary").filter("octet_length(h) > 0")
    stream = wanted.join(have, "doc").select("a", "g", "doc", "member", "h")
    stream = stream.repartition(partitions(spark), "a", "g").sortWithinPartitions("a", "g", "member")
    return written(stream.mapInArrow(check, "a long, b long").distinct(), f"{name}-kept", root)


def _verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int, orders, root: str, name: str) -> DataFrame:
    """Of the candidates (a, b), those that pass the further orders' filters and whose whole sets are similar enough."""
    import numpy as np

    def shared(x, y):
        both = np.concatenate([x, y])
        both.sort()
        return int((both[1:] == both[:-1]).sum())

    def prefixes(text):  # of 32 bits each: equal ones may be unequal shingles, never the other way round
        h = shingles(text, n)
        c = orders.value.classes_of(h)
        return b"".join(h[orders.value.prefix(h, c, k, percent)].astype("<u4").tobytes() for k in range(1, ORDERS)) if len(h) else b""

    def filtered(x, y):
        x, y = (np.frombuffer(b, dtype="<u4").reshape(ORDERS - 1, -1) for b in (x, y))
        return all(shared(np.unique(p), np.unique(q)) for p, q in zip(x, y))

    def similar(x, y):
        x, y = (np.frombuffer(b, dtype="<u8") for b in (x, y))
        m = shared(x, y)
        return m * 100 >= percent * (len(x) + len(y) - m)

    left = _checked(pairs, docs, prefixes, filtered, root, f"{name}-filter")
    return _checked(left, docs, lambda text: shingles(text, n).tobytes(), similar, root, f"{name}-verify")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    root = scratch_root(spark)
    orders = spark.sparkContext.broadcast(Orders(*_frequent(docs, n, root)))  # TABLE entries of 9 bytes at most
    prefixes = written(_prefixes(docs, n, percent, orders), "prefixes", root)
    nodes = prefixes.filter("n > 0 and doc_id is not null").select("doc_id", "n", "s1", "s2")
    twins = nodes.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    alike = nodes.join(twins, ["n", "s1", "s2"]).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    alike = written(alike.distinct(), "alike", root)
    # of a set that several tasks met, one row goes on
    met = prefixes.filter("rare is not null").select("doc_id", "n", "s1", "s2")
    one = met.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("one"), F.count("*").alias("m")).filter("m > 1")
    spare = written(met.join(one, ["n", "s1", "s2"]).filter("doc_id <> one").select("doc_id", "n", "s1", "s2").distinct(), "spare", root)
    carriers = prefixes.filter("rare is not null").join(broadcast_if_small(spare), ["doc_id", "n", "s1", "s2"], "left_anti")

    rare = written(_rare_candidates(carriers, percent), "rare", root)
    crowd = rare.filter("token is not null").select("token", F.col("a").alias("doc"), "n", "at")
    often = carriers.select("doc_id", "n", F.size("rare").alias("before"), F.posexplode("often").alias("i", "token"))
    often = often.select("token", F.col("doc_id").alias("doc"), "n", (F.col("before") + F.col("i")).cast("long").alias("at")).union(crowd)
    often = written(often, "often", root)
    # the hub of a shingle is a document that has it early, so one with few shingles of its own
    hubs = often.groupBy("token").agg(F.min(F.struct("at", F.xxhash64("token", "doc").alias("h"), "doc", "n")).alias("hub"), F.count("*").alias("m"))
    hubs = hubs.filter("m > 1").select("token", F.col("hub.doc").alias("hub"), F.col("hub.n").alias("nb"), F.col("hub.at").alias("atb"))
    stars = often.withColumnsRenamed({"n": "na", "at": "ata"}).join(hubs, "token").filter("doc <> hub").filter(_has_room(percent))
    stars = stars.select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
    tried = rare.filter("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(stars).distinct()
    tried = written(tried, "tried", root)
    links = _verified(tried, docs, n, percent, orders, root, "first")
    joined = written(components(links.union(alike)), "joined", root)

    # second round: pairs that share a frequent shingle and are not joined yet
    names = joined.select(F.col("node").alias("doc"), "component")
    labelled = written(often.join(names, "doc", "left").select("token", "doc", "n", "at", F.coalesce("component", "doc").alias("label")), "labelled", root)
    mixed = labelled.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("token")
    open_ = written(labelled.join(mixed, "token", "left_semi"), "open", root)
    x, y = (open_.select("token", F.col("doc").alias(d), F.col("n").alias(f"n{d}"), F.col("at").alias(f"at{d}"), F.col("label").alias(f"l{d}")) for d in "ab")
    there = (x.token == y.token) & (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & _has_room(percent)
    rest = x.join(y, there).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    rest = written(rest, "rest", root)
    more = rest if rest.isEmpty() else _verified(rest, docs, n, percent, orders, root, "second")
    whole = joined if more.isEmpty() else written(components(more.union(joined.select(F.col("node").alias("a"), F.col("component").alias("b")))), "whole", root)
    out = prefixes.select("doc_id", F.col("n").alias("n_shingles")).join(whole, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the least doc_id."""
    found = near_duplicates(docs, n, percent).filter("component_id <> doc_id").select(F.col("doc_id").alias("lost")).distinct()
    found = broadcast_if_small(written(found, "dropped"))
    keyed = as_row(docs, F.col("doc_id").cast("long").alias("doc"))
    return keyed.join(found, F.col("doc") == F.col("lost"), "left_anti").select("row.*")
