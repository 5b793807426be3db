"""Operator 3: exact duplicates by a Golomb-coded fingerprint exchange.

1. Each input partition (sender) writes its rows' fingerprints, hashes of the
   normalised texts cut to a universe of about 2^16 values a row.
2. It sends the distinct ones to their owners (equal ranges of the universe),
   sorted and Golomb-coded, with a bitmap of those it has more than once.
3. An owner merges what it received and answers each message with a bitmap of
   the fingerprints that are duplicates; the senders decode them.
4. Only rows with such a fingerprint are shuffled with their texts, and
   compared byte by byte: equal texts are counted by the text itself, and a
   SHA-256 that stood for two texts would end the run with an error.

A hot text counts once in each message, is combined before each shuffle, and
its rows meet their group's few numbers in a join that Spark can split.

Normalised: every character of ``[\\x20\\x09-\\x0D]`` deleted.  Of equal texts the row with the most
code points in the original text stays, then the smallest doc_id (NULL last).
NULL text counts as empty, so NULL, empty and blank texts are one group.
Repeated rows are each in the result, and one of them is kept.  Very long texts are shuffled
whole if they are suspects, and otherwise hashed.  Other columns are ignored by
``exact_duplicates`` and passed on as they are by ``drop_exact_duplicates``; an empty table
gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import golomb
from tidemark.llm.common import as_row, broadcast_if_small, partitions, scratch_root, small_batches, written

#: Bits of the universe beyond the logarithm of the number of rows: so a row is a false suspect once in 2^16.
SPARE_BITS = 16
#: Fingerprints of a sender in one message round, and rows an owner answers for.
ROUND, OWNED = 1_000_000, 2_000_000


def normalised(text):
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Narrow rows: row, doc_id, n_cp, sha (32 bytes), fp (64 bits), sender."""
    text = normalised(F.col("text"))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_cp"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.xxhash64(text).alias("fp"),
        F.spark_partition_id().alias("sender"),
    )


def _bounds(owners: int, bits: int) -> list[int]:
    return [(i << bits) // owners for i in range(owners + 1)]


def duplicate_fingerprints(prints: DataFrame, root: str) -> DataFrame:
    """(sender, fp) of the fingerprints, within the universe, that more than one row has."""
    spark = prints.sparkSession
    rows = prints.count()
    bits = min(62, max(1, math.ceil(math.log2(rows + 1))) + SPARE_BITS)
    owners = max(partitions(spark), -(-rows // OWNED))
    bounds = _bounds(owners, bits)
    narrow = prints.select("sender", F.shiftrightunsigned("fp", 64 - bits).alias("fp"))

    def send(batches):
        import numpy as np
        import pyarrow as pa

        def messages(sender, got):
            values, counts = np.unique(np.concatenate(got), return_counts=True)
            ends = np.searchsorted(values, bounds)
            for owner in np.flatnonzero(np.diff(ends)).tolist():
                some = slice(ends[owner], ends[owner + 1])
                yield sender, owner, golomb.encode(values[some], bounds[owner]), np.packbits(counts[some] > 1).tobytes()

        held: dict[int, list] = {}
        n, out, seq = 0, [], 0

        def flush():
            nonlocal seq
            rows = [m for s, got in held.items() for m in messages(s, got)]
            held.clear()
            seq += 1
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array([seq] * len(rows), pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                names=["sender", "seq", "owner", "coded", "repeats"],
            )

        for batch in batches:
            senders, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sender", "fp"))
            for s in np.unique(senders).tolist():
                held.setdefault(s, []).append(fps[senders == s])
            n += len(fps)
            if n >= ROUND:
                yield flush()
                n = 0
        if n:
            yield flush()

    def answer(key, table):
        import numpy as np
        import pyarrow as pa

        low = bounds[key[0].as_py()]
        got = [golomb.decode(x, low) for x in table.column("coded").to_pylist()]
        values, counts = np.unique(np.concatenate(got), return_counts=True)
        bitmaps = []
        for mine, repeats in zip(got, table.column("repeats").to_pylist()):
            here = np.unpackbits(np.frombuffer(repeats, dtype=np.uint8))[: len(mine)].astype(bool)
            bitmaps.append(np.packbits(here | (counts[np.searchsorted(values, mine)] > 1)).tobytes())
        return pa.table({"sender": table.column("sender"), "seq": table.column("seq"), "owner": table.column("owner"), "duplicates": pa.array(bitmaps, pa.binary())})

    def receive(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            senders, fps = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
            for sender, owner, coded, bitmap in zip(*(batch.column(c).to_pylist() for c in ("sender", "owner", "coded", "duplicates"))):
                mine = golomb.decode(coded, bounds[owner])
                mine = mine[np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8))[: len(mine)].astype(bool)]
                senders.append(np.full(len(mine), sender, dtype=np.int32))
                fps.append(mine)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(senders)), pa.array(np.concatenate(fps))], names=["sender", "fp"])

    small_batches(spark)
    # Sender and round name a message; both come from tables that stay as written, so a lost task sends the same again.
    sent = written(narrow.mapInArrow(send, "sender int, seq int, owner int, coded binary, repeats binary").withColumn("task", F.spark_partition_id()), "sent", root)
    asked = sent.withColumn("seq", F.col("task").cast("long") * 100_000 + F.col("seq")).drop("task")
    replies = asked.groupBy("owner").applyInArrow(answer, "sender int, seq long, owner int, duplicates binary")
    back = asked.join(replies, ["sender", "seq", "owner"]).select("sender", "owner", "coded", "duplicates")
    return back.mapInArrow(receive, "sender int, fp long").withColumn("bits", F.lit(bits))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``: row, doc_id, sha, keep_id, group_size, kept."""
    root = scratch_root(docs.sparkSession)
    prints = written(fingerprints(docs), "prints", root)
    found = written(duplicate_fingerprints(prints, root), "duplicates", root)
    bits = found.select("bits").first()
    short = F.shiftrightunsigned("fp", 64 - (bits[0] if bits else 1))
    # byte verification: the suspects' texts, each combined before it is shuffled
    text = normalised(F.col("text"))
    wanted = broadcast_if_small(written(found.select(F.col("fp").alias("short")).distinct(), "wanted", root))
    suspects = docs.select(text.alias("norm")).withColumn("fp", F.xxhash64("norm")).withColumn("short", short)
    texts = suspects.join(wanted, "short", "left_semi").groupBy("norm").agg(F.count("*").alias("n"))
    checked = texts.filter("n > 1").groupBy(F.unhex(F.sha2("norm", 256)).alias("sha")).agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    checked = checked.select("sha", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts with one SHA-256"))).otherwise(F.col("n")).alias("group_size"))
    # who stays, from the suspects' narrow rows
    marked = prints.withColumn("short", short).join(found.select("sender", F.col("fp").alias("short")), ["sender", "short"], "left_semi")
    order = F.struct((-F.col("n_cp")).alias("fewer"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    first = marked.groupBy("sha").agg(F.min(order).alias("b")).select("sha", F.col("b.row").alias("keep_row"), F.col("b.doc_id").alias("keep_id"))
    groups = written(checked.join(first, "sha"), "groups", root)
    return prints.join(groups, "sha", "left").select(
        "row", "doc_id", "sha",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat both the doc_id and the text of the row that stays are
    taken as one: the longest original text, then the first by all columns.
    """
    root = scratch_root(docs.sparkSession)
    told = written(exact_duplicates(docs).select("doc_id", "sha", "group_size", "kept"), "told", root)
    mine = told.filter("group_size > 1").groupBy("doc_id", "sha").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    mine = written(mine.select(F.col("doc_id").alias("id"), F.col("sha").alias("text_sha"), "n", "kept"), "mine", root)
    text = F.col("text")
    keyed = as_row(docs, F.col("doc_id").cast("long").alias("doc"), F.unhex(F.sha2(normalised(text), 256)).alias("sha"), F.coalesce(F.char_length(text), F.lit(0)).alias("chars"))
    same = F.col("doc").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("text_sha"))
    lost = broadcast_if_small(written(mine.filter("not kept or n > 1").select("id", "text_sha"), "lost", root))
    stay = keyed.join(lost, same, "left_anti").select("row.*")
    twins = mine.filter("kept and n > 1").select("id", "text_sha")
    if twins.isEmpty():
        return stay
    whole = F.struct((-F.col("chars")).alias("fewer"), "row")
    one = keyed.join(twins, same).groupBy("id", "text_sha").agg(F.min(whole).alias("first")).select("first.row.*")
    return stay.unionByName(one)
