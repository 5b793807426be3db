"""Operator 2: token ids as flat binary files with 64-bit offsets.

``write_tokens`` deals the documents by ranges of doc_id; each task encodes its
range in order and writes three flat files into the shared folder:

* ``<part>-<attempt>.ids``: the ids, unsigned little-endian, 16 bits where the
  vocabulary fits, else 32;
* ``.off``: n + 1 unsigned 64-bit offsets, counted in ids from the file's start;
* ``.doc``: n signed 64-bit doc_ids (the smallest integer stands for NULL).

A manifest table names the files of the attempts that succeeded.  Each file's
base, the ids in all files before it, is a prefix sum over the manifest's totals
(one row a file), so no task waits for another and nothing is counted twice.
``read_tokens`` maps the files into memory and returns documents again.

NULL text counts as empty (its only id is the end id); a NULL doc_id sorts
first; rows with equal doc_id are ordered by text; other columns are ignored;
an empty table gives an empty manifest.  Very long texts are encoded in blocks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, small_batches, written
from tidemark.llm.tokens import default_path, encoder

NO_ID = -(1 << 63)
MANIFEST = "part int, file string, width int, n_docs long, n_ids long"


def open_folder(uri: str):
    """The pyarrow file system of a shared folder's address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0, added: bool = False) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``folder``; returns the manifest with bases."""
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or default_path()

    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(path, added)
        width = 2 if max(enc.vocabulary, end_id + 1) <= 1 << 16 else 4
        store, top = open_folder(folder)
        name = f"{part:06d}-{uuid.uuid4().hex[:8]}"
        n_docs = n_ids = 0
        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(top, recursive=True)
                out = [store.open_output_stream(f"{top}/{name}.{x}") for x in ("ids", "off", "doc")]
                out[1].write(np.zeros(1, dtype="<u8").tobytes())
            ends = []
            for ids in enc.encode(batch.column("text").to_pylist()):
                out[0].write(np.append(ids, end_id).astype(f"<u{width}").tobytes())
                n_ids += len(ids) + 1
                ends.append(n_ids)
            out[1].write(np.array(ends, dtype="<u8").tobytes())
            doc = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID)
            out[2].write(doc.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs += batch.num_rows
        if out:
            for x in out:
                x.close()
            rows = {"part": [part], "file": [name], "width": [width], "n_docs": [n_docs], "n_ids": [n_ids]}
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(partitions(spark), "doc_id", F.substring("text", 1, 64))  # the beginning splits a hot doc_id
        .sortWithinPartitions("doc_id", "text")
    )
    manifest = written(dealt.mapInArrow(write, MANIFEST), "manifest", folder)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents out of the files: doc_id, start (ids of all documents before it), ids (32-bit little-endian)."""

    def read(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        store, top = open_folder(folder)

        def mapped(name: str, dtype: str):
            if isinstance(store, fs.LocalFileSystem):
                return np.memmap(f"{top}/{name}", dtype=dtype, mode="r")
            with store.open_input_file(f"{top}/{name}") as f:
                return np.frombuffer(f.read_buffer(), dtype=dtype)

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for row in batch.to_pylist():
                ids = mapped(row["file"] + ".ids", f"<u{row['width']}")
                offsets, docs = mapped(row["file"] + ".off", "<u8"), mapped(row["file"] + ".doc", "<i8")
                at, n = 0, row["n_docs"]
                while at < n:  # about a million ids at a time
                    to = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + 1_000_000, side="right")) - 1)
                    ends = offsets[at : to + 1].astype(np.int64)
                    some = ids[ends[0] : ends[-1]].astype("<u4").tobytes()
                    bytes_at = (ends - ends[0]) * 4
                    who = pa.array(np.asarray(docs[at:to]), mask=np.asarray(docs[at:to] == NO_ID))
                    data = pa.Array.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(bytes_at.tobytes()), pa.py_buffer(some)])
                    yield pa.RecordBatch.from_arrays([who, pa.array(ends[:-1] + row["base"]), data.cast(pa.binary())], schema=schema)
                    at = to

    return manifest.repartitionById(partitions(spark), "part").mapInArrow(read, "doc_id long, start long, ids binary")
