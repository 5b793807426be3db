"""Operator 8: sum-of-squares online packing of documents into token windows.

Documents are dealt by ranges of doc_id and arrive in that order.  A document's
full windows go out as they are.  Its rest, ``s`` tokens, is placed online: a
level array counts the open windows by fill level, and the rest goes to the
level h (0: a new window) that leaves the least sum of squared counts over the
partially filled levels; ties take the fullest window.  At the end of a task
the windows still open are closed: their pieces are strung together and cut at
every window's end, and what is left is cut into sequences whose lengths are
powers of two, which need no padding.

With ``order``, one or more columns, documents are dealt by ranges of them and arrive in their
order instead, and sequences are numbered as they are filled, those of an earlier
range first.  Equal values are ordered by doc_id and text.

NULL and empty texts are one end id; a NULL doc_id sorts first; equal doc_ids
are ordered by text, dealt by ranges of their texts' beginnings, and packed each by itself
(ties and repeated rows too); other columns are ignored; an empty table gives no piece.
A very long text leaves its task as full windows while it is cut.  Memory in a task is its open
windows, at most OPEN a level: with more, the level's windows are strung together as at
the end, into full ones and a rest that is placed anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, small_batches
from tidemark.llm.tokens import default_path, encoder

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
OUT_ROWS = 1000
#: Open windows of one level.
OPEN = 16


class Levels:
    """Open windows by fill level."""

    def __init__(self, window: int):
        import numpy as np

        self.window, self.np = window, np
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.crowded = 0  # a level with more than OPEN windows

    def level_for(self, size: int) -> int:
        """The level whose use leaves the least sum of squares over levels 1 to window - 1."""
        np, n = self.np, self.counts
        room = self.window - size
        gain = 2 * n[size:] + 1  # the level reached has one window more
        gain[room] = 0  # a full window is no level
        loss = 2 * n[: room + 1] - 1  # the level left has one window less
        loss[0] = 0  # a new window leaves none
        cost = np.where(n[: room + 1] > 0, gain - loss, np.iinfo(np.int64).max)
        cost[0] = gain[0]
        return room - int(np.argmin(cost[::-1]))

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece into a window; returns the window if that fills it."""
        return self._put([piece], size)

    def _put(self, pieces: list[tuple], size: int) -> list | None:
        h = self.level_for(size)
        window = self.open[h].pop() if h else []
        if h:
            self.counts[h] -= 1
        window += pieces
        level = h + size
        if level == self.window:
            return window
        self.open[level].append(window)
        self.counts[level] += 1
        if len(self.open[level]) > OPEN:
            self.crowded = level
        return None

    def thin(self):
        """The full windows that a level with more than OPEN windows makes."""
        while self.crowded:
            level, self.crowded = self.crowded, 0
            crowd, self.open[level], self.counts[level] = self.open[level], [], 0
            for made, size in self.strung(crowd, False):
                if size == self.window:
                    yield made
                elif done := self._put(made, size):
                    yield done

    def strung(self, windows: list, halve: bool):
        """The windows' pieces, cut anew into full windows and a rest, which with ``halve`` is cut into powers of two."""
        pieces = [p for w in windows for p in w]
        left = sum(len(p[2]) for p in pieces)
        room, size, now = 0, 0, []
        for doc, start, ids, total in pieces:
            at = 0
            while at < len(ids):
                if not room:
                    room = size = self.window if left >= self.window else 1 << (left.bit_length() - 1) if halve else left
                take = min(room, len(ids) - at)
                now.append((doc, start + at, ids[at : at + take], total))
                at, room, left = at + take, room - take, left - take
                if not room:
                    yield now, size
                    now = []

    def close(self):
        """The open windows' pieces, cut anew into full windows, then into powers of two."""
        yield from (made for made, _ in self.strung([w for level in reversed(self.open) for w in level], True))


def pack(docs: DataFrame, window: int = 1024, tokenizer: str | None = None, end_id: int = 0, added: bool = False, order: str | list[str] | None = None) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): where each lies in its document and in its sequence, and its ids."""
    spark = docs.sparkSession
    small_batches(spark)
    path, parts = tokenizer or default_path(), partitions(spark)
    order = [order] if isinstance(order, str) else order or []
    ranged = bool(order)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc, levels = encoder(path, added), Levels(window)
        schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")])
        rows, made = [], 0

        def emit(pieces):
            nonlocal made
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), total, (part << 40) + made if ranged else made * parts + part, offset, ids.tobytes()))
                offset += len(ids)
            made += 1

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
            rows.clear()
            return out

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text").to_pylist())):
                ids = np.append(ids, end_id).astype("<u4")
                full = len(ids) // window * window
                for at in range(0, full, window):
                    emit([(doc, at, ids[at : at + window], len(ids))])
                if full < len(ids) and (done := levels.place((doc, full, ids[full:].copy(), len(ids)), len(ids) - full)):
                    emit(done)
                for done in levels.thin():
                    emit(done)
                if len(rows) >= OUT_ROWS:
                    yield flush()
        for done in levels.close():
            emit(done)
            if len(rows) >= OUT_ROWS:
                yield flush()
        if rows:
            yield flush()

    named = {f"order{i}": c for i, c in enumerate(order)}
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`").alias(n) for n, c in named.items()])
    dealt = given.repartitionByRange(parts, *named, "doc_id", F.substring("text", 1, 64)).sortWithinPartitions(*named, "doc_id", "text")
    return dealt.select("doc_id", "text").mapInArrow(run, PIECES)
