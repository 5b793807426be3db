"""Operator 1: edit-aware token counts.

``build`` keeps a segment tree per document: its leaves are runs of pre-tokens
of about LEAF bytes, its nodes the sums of code points and tokens below them
(heap order, two arrays).  ``apply_edits`` finds the leaves an edit touches by
descending the tree, encodes only these and one leaf of context on each side,
puts the new sums into the same leaves and updates their paths to the root.  A
region that has grown too large for its leaves is spread over more; the other
leaves keep their sums and are not encoded again.

Leaves begin where a pre-token is sure to begin (``tokens.cuts``), judged by
the three bytes before and two behind; the leaf of context keeps these
untouched, so the sums always equal those of encoding the whole edited text.  Where
added tokens are read, the context is as many leaves as an added token may reach over.

Edits are splices (start, length, replacement) in code points of the text as it
was, and are applied from the end.  Positions beyond the text are clipped; a
NULL replacement is empty; of edits that overlap, the one that begins later
(then the first by length, then by replacement) holds and the other is counted in ``n_rejected``;
repeated rows count once.  NULL text counts as empty; a very long text is cut into blocks
at safe points, and its edits still touch a few leaves; a NULL doc_id takes no edits; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.llm.tokens import BLOCK, default_path, encoder

#: Bytes of a leaf, and by how much a leaf may grow before its region is spread anew.
LEAF, GROWTH = 256, 4
TREE = "doc_id long, text string, tree_chars array<int>, tree_tokens array<int>"
COUNTS = (
    "doc_id long, n_chars long, n_tokens long, n_leaves long, n_edits long, n_rejected long,"
    " edited_chars long, edited_tokens long, reencoded_chars long, edited_text string"
)


def leaves(enc, text: str, size: int = LEAF) -> list[tuple[int, int]]:
    """(code points, tokens) of each leaf of a text."""
    return next(leaves_of(enc, [text], [size]))


def leaves_of(enc, texts: list[str], sizes: list[int]):
    """The leaves of many texts, of ``sizes`` bytes each; about BLOCK bytes are encoded at a time."""
    import numpy as np

    raws = [t.encode() for t in texts]
    at = 0
    while at < len(raws):
        upto, weight = at, 0
        while upto < len(raws) and (upto == at or weight + len(raws[upto]) <= BLOCK):
            weight += len(raws[upto])
            upto += 1
        _, _, pieces, (widths, counts) = enc.block(raws[at:upto])
        last = np.cumsum(pieces)
        for raw, size, lo, hi in zip(raws[at:upto], sizes[at:upto], (last - pieces).tolist(), last.tolist()):
            if not raw:
                yield []
                continue
            width = widths[lo:hi]
            starts = np.cumsum(width) - width
            stretch = starts // size
            first = np.flatnonzero(np.concatenate([[True], stretch[1:] > stretch[:-1]]))  # the first piece in each stretch of ``size`` bytes
            chars = np.add.reduceat((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80, starts[first], dtype=np.int64)
            yield list(zip(chars.tolist(), np.add.reduceat(counts[lo:hi], first).tolist()))
        at = upto


class Tree:
    """Sums of code points and tokens over leaves, in heap order."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens

    @classmethod
    def of(cls, rows: list[tuple[int, int]]) -> "Tree":
        cap = 1 << max(0, len(rows) - 1).bit_length()
        t = cls([0] * (2 * cap), [0] * (2 * cap))
        for i, (c, n) in enumerate(rows):
            t.chars[cap + i], t.tokens[cap + i] = c, n
        for i in range(cap - 1, 0, -1):
            t._sum(i)
        return t

    @property
    def cap(self) -> int:
        return len(self.chars) // 2

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> int:
        """The leaf that holds code point ``at``."""
        i = 1
        while i < self.cap:
            i *= 2
            if at >= self.chars[i]:
                at -= self.chars[i]
                i += 1
        return i - self.cap

    def before(self, leaf: int) -> int:
        """Code points in all leaves before this one."""
        i, out = leaf + self.cap, 0
        while i > 1:
            if i % 2:
                out += self.chars[i - 1]
            i //= 2
        return out

    def near(self, leaf: int, step: int) -> int:
        """The next leaf with text on one side, or the last place there is."""
        i = leaf + step
        while 0 <= i < self.cap and not self.chars[self.cap + i]:
            i += step
        return min(max(i, 0), self.cap - 1)

    def put(self, first: int, rows: list[tuple[int, int]]) -> None:
        """New sums for the leaves from ``first`` on, then for all nodes above them."""
        lo, hi = self.cap + first, self.cap + first + len(rows) - 1
        for i, (c, n) in zip(range(lo, hi + 1), rows):
            self.chars[i], self.tokens[i] = c, n
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            for i in range(lo, hi + 1):
                self._sum(i)

    def rows(self) -> list[tuple[int, int]]:
        return [(c, n) for c, n in zip(self.chars[self.cap :], self.tokens[self.cap :]) if c]

    def region(self, text: str, start: int, length: int, new: str, context: int = 0) -> tuple[str, int, int, str, int]:
        """For a splice: the text after it, first and last leaf, the region to be encoded and its leaves' size."""
        total = self.chars[1]
        after = text[:start] + new + text[start + length :]
        if not total:
            return after, 0, 0, after, LEAF
        first = self.near(self.find(min(start, total - 1)), -1)
        last = self.near(self.find(min(max(start, start + length - 1), total - 1)), 1)
        if start:
            first = min(first, self.near(self.find(start - 1), -1))
        while first > 0 and start - self.before(first) < context:
            first = self.near(first, -1)
        while last < self.cap - 1 and self.before(last) + self.chars[self.cap + last] - start - length < context:
            last = self.near(last, 1)
        lo, hi = self.before(first), self.before(last) + self.chars[self.cap + last]
        region = after[lo : hi + len(new) - length]
        return after, first, last, region, max(LEAF, len(region.encode()) // (last - first + 1) + 1)

    def settle(self, enc, first: int, last: int, region: str, rows: list[tuple[int, int]]) -> "Tree":
        """The tree with the region's new leaves in the places from ``first`` to ``last``."""
        if not self.chars[1]:
            return Tree.of(rows)
        places = last - first + 1
        if len(rows) > places or len(region) > GROWTH * LEAF * places:
            kept = list(zip(self.chars[self.cap :], self.tokens[self.cap :]))
            rows = kept[:first] + leaves(enc, region) + kept[last + 1 :]
            return Tree.of([x for x in rows if x[0]])
        self.put(first, rows + [(0, 0)] * (places - len(rows)))
        return self

    def edit(self, enc, text: str, start: int, length: int, new: str) -> tuple["Tree", str, int]:
        """The tree and text after a splice, and the code points that were encoded for it."""
        after, first, last, region, size = self.region(text, start, length, new, enc.context)
        return self.settle(enc, first, last, region, leaves(enc, region, size)), after, len(region)


def build(docs: DataFrame, tokenizer: str | None = None, added: bool = False) -> DataFrame:
    """The tree of each document: doc_id, text, tree_chars, tree_tokens."""
    small_batches(docs.sparkSession)
    path = tokenizer or default_path()

    def run(batches):
        import pyarrow as pa

        enc = encoder(path, added)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            trees = [Tree.of(rows) for rows in leaves_of(enc, texts, [LEAF] * len(texts))]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string()), pa.array([t.chars for t in trees], ints), pa.array([t.tokens for t in trees], ints)],
                names=["doc_id", "text", "tree_chars", "tree_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TREE)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees with their edits (doc_id, start, length, replacement) as one list each.

    Edits that begin at one place are reduced to one before they are gathered,
    so a list is no longer than its document's text.
    """
    e = edits.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.greatest(F.col("start"), F.lit(0)).cast("int").alias("start"),
        F.greatest(F.coalesce("length", F.lit(0)), F.lit(0)).cast("int").alias("length"),
        F.coalesce("replacement", F.lit("")).alias("replacement"),
    ).filter("doc_id is not null and start is not null")
    first = e.groupBy("doc_id", "start").agg(
        F.min(F.struct("length", "replacement")).alias("e"), (F.count_distinct("length", "replacement") - 1).alias("rejected")
    )
    lists = first.groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "e.length", "e.replacement")).alias("edits"), F.sum("rejected").alias("rejected")
    )
    return trees.join(lists, "doc_id", "left")


def apply_edits(trees: DataFrame, tokenizer: str | None = None, added: bool = False) -> DataFrame:
    """Counts before and after the edits of trees that have a list column ``edits`` (see ``with_edits``)."""
    small_batches(trees.sparkSession)
    path = tokenizer or default_path()

    def run(batches):
        import pyarrow as pa

        enc = encoder(path, added)
        names = [x.strip().split()[0] for x in COUNTS.split(",")]
        for batch in batches:
            docs = []
            for doc, text, chars, tokens, edits, rejected in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "tree_chars", "tree_tokens", "edits", "rejected"))):
                tree, splices, rejected, upto = Tree(chars, tokens), [], rejected or 0, len(text)
                before = (tree.chars[1], tree.tokens[1], len(tree.rows()))
                for e in sorted(edits or [], key=lambda e: -e["start"]):
                    if e["start"] + e["length"] > upto and splices:
                        rejected += 1
                        continue
                    start = min(e["start"], upto)
                    splices.append((start, min(e["length"], upto - start), e["replacement"] or ""))
                    upto = start
                docs.append([doc, before, splices, rejected, tree, text, 0])
            for turn in range(max((len(d[2]) for d in docs), default=0)):  # one splice of each document at a time, encoded together
                now = [d for d in docs if len(d[2]) > turn]
                plans = [d[4].region(d[5], *d[2][turn], enc.context) for d in now]
                for d, (after, first, last, region, _), rows in zip(now, plans, leaves_of(enc, [x[3] for x in plans], [x[4] for x in plans])):
                    d[4], d[5], d[6] = d[4].settle(enc, first, last, region, rows), after, d[6] + len(region)
            out = [(doc, *before, len(splices), rejected, tree.chars[1], tree.tokens[1], encoded, text) for doc, before, splices, rejected, tree, text, encoded in docs]
            types = [pa.int64()] * 9 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 10, types)], names=names)

    have = trees if "rejected" in trees.columns else trees.withColumn("rejected", F.lit(0).cast("long"))
    return have.select("doc_id", "text", "tree_chars", "tree_tokens", "edits", "rejected").mapInArrow(run, COUNTS)


def sample_edits(n_chars, text):
    """Three splices of a document, from its own text: a deletion, a replacement and an insertion, one in each third."""
    third = F.floor(n_chars / 3).cast("int")
    span = F.least(third, F.lit(16))
    spot = lambda k: (third * k + F.pmod(F.crc32(F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), F.greatest(third - span, F.lit(1)))).cast("int")
    edit = lambda start, length, new: F.struct(start.alias("start"), length.cast("int").alias("length"), new.alias("replacement"))
    return F.array(
        edit(spot(0), span, F.lit("")),
        edit(spot(1), span, F.substring(text, 1, 24)),
        edit(spot(2), F.lit(0), F.substring(text, 7, 40)),
    )
