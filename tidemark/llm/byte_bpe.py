"""Operator 12: byte-level BPE by DuckDB recursive queries, one connection in each partition.

Encoding.  The split pattern cuts a text into words.  Words not met before
become token-position rows (word, pos, id), one a byte, that also name the rows
before and after.  ``CONTRACT`` joins the pairs of neighbours with the merge table (every
split of every vocabulary entry into two entries, with the rank of the whole) and
contracts each word's leftmost pair of least rank; the query recurs on its own result
until no word has a pair left.  A word's answer is remembered in a table of bounded size.

Decoding.  Token rows (block, pos, id) join the vocabulary and an ordered
aggregation puts their bytes together.

The ids are the tiktoken library's: a word that is an entry of the vocabulary is
that entry, and letters and numbers are those of the library's own Unicode
tables, which may be older than those of the ``regex`` module (``splitter``).

Work on long words: a word of more than ``LONG`` bytes may hold its least pair
many times.  ``CONTRACT_LONG`` contracts them together if the new token is in no
entry of lesser rank (then each of them would be next in turn anyway).  The
state is handed to a new query after as many steps as keep the rows of one
query under ``ROWS``, so memory is bounded for words of any length.

NULL and empty texts have no ids and decode to no bytes.  Very long texts are
cut into blocks of words, encoded and decoded block by block.  Rows are
independent, so ties and repeated rows change nothing: every row gives one row.
Other columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

#: Characters of text, and tokens, handled at a time.
BLOCK, TOKENS = 2_000_000, 1 << 18
#: Words remembered by a worker (some 250 bytes each), and rows that one recursive query may make.
KNOWN, ROWS = 500_000, 4_000_000
#: Bytes from which on a word's equal pairs are contracted together.
LONG = 128

CONTRACT = """
with recursive t as (
  select word, pos, id, after, after_id, before, false as done, 0 as step from given
  union all
  (with least as (
     select word, min(new::bigint << 32 | pos) as best from t join merges on pair = (id::bigint << 32 | after_id)
     where not done and step < $steps group by word),
   hits as (  -- the pair's first row, its new id, and the row that goes
     select word, (best & 4294967295)::integer as hit, (best >> 32)::integer as new, t.pos as gone, t.after as next, t.after_id as next_id
     from least join t using (word) where t.before = (best & 4294967295) and not done)
   select word, pos, case when pos = hit then new else id end,
     case when pos = hit then next else after end,
     case when pos = hit then next_id when after = hit then new else after_id end,
     case when before = gone then hit else before end, hit is null, step + 1
   from t left join hits using (word)
   where not done and step < $steps and (hit is null or pos <> gone))
)
select word, pos, id, after, after_id, before, done from t where done or step = $steps order by word, pos
"""

CONTRACT_LONG = """
with recursive t as (
  select word, pos, id, false as done, 0 as step from given
  union all
  (with p as (
     select word, pos, id, step, lead(id) over w as nxt, lag(pos) over w as prev, row_number() over w as place
     from t where not done and step < $steps window w as (partition by word order by pos)),
   pairs as (select word, pos, place, new, alone, min(new::bigint << 32 | pos) over (partition by word) as best from p join merges on pair = (id::bigint << 32 | nxt)),
   turns as (
     select word, pos, new, place - row_number() over (partition by word order by place) as run
     from pairs where new = best >> 32 and (not alone or pos = best & 4294967295)),
   hits as (select word, pos, new from turns qualify row_number() over (partition by word, run order by pos) % 2 = 1)
   select p.word, p.pos, coalesce(h.new, p.id), l.word is null, step + 1
   from p left join hits h on h.word = p.word and h.pos = p.pos
          left join hits g on g.word = p.word and g.pos = p.prev
          left join (select distinct word from hits) l on l.word = p.word
   where g.word is null)
)
select word, pos, id, done from t where done or step = $steps order by word, pos
"""

DECODE = "select block, unhex(string_agg(hex, '' order by pos)) as bytes, count(*) as n from tokens join vocabulary using (id) group by block"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def ranges(points: list[int]) -> str:
    """A character class's inside for these code points."""
    out, points = [], sorted(points)
    for c in points:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def splitter(pattern: str):
    """A function from text to words: the pattern with the tiktoken library's own letters, numbers and white space.

    Each class is asked of the library once, for all code points together.  Texts without a
    character on which it and the ``regex`` module differ, nearly all, take the pattern as it is.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    plain, exact, odd = regex.compile(pattern), pattern, set()
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        asked = tiktoken.Encoding(name, pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs = set(asked.decode_bytes(asked.encode_ordinary(every)).decode())
        ours = set(regex.findall(name, every))
        if theirs != ours:
            odd |= theirs ^ ours
            inside = f"{name}{ranges([ord(c) for c in theirs - ours])}"
            less = ranges([ord(c) for c in ours - theirs])
            new = f"[{inside}--[{less}]]" if less else f"[{inside}]"
            exact = exact.replace(name, new)
    if not odd:
        return plain
    strange, careful = regex.compile(f"[{ranges([ord(c) for c in odd])}]"), regex.compile(exact, flags=regex.V1)
    latin = min(odd) > "\xff"

    class Splitter:
        def pick(self, text):
            if text.isascii():
                return plain
            try:
                text.encode("latin-1")  # a quick way to see that no character is beyond
                return plain if latin else careful
            except UnicodeEncodeError:
                return careful if strange.search(text) else plain

        def findall(self, text):
            return self.pick(text).findall(text)

        def finditer(self, text):
            return self.pick(text).finditer(text)

    return Splitter()


class Codec:
    """One partition's DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import numpy as np
        import pyarrow as pa

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.np, self.pa = np, pa
        self.words = splitter(pattern)
        splits = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        least = {}
        for a, b, r in splits:
            least[a], least[b] = min(least.get(a, r), r), min(least.get(b, r), r)
        merges = pa.table({
            "pair": pa.array([a << 32 | b for a, b, _ in splits], pa.int64()),
            "new": pa.array([r for *_, r in splits], pa.int32()),
            "alone": [least.get(r, r + 1) <= r for *_, r in splits],  # its contraction may make a pair of lesser rank
        })
        self.db = duckdb.connect(config={"threads": 1, "enable_external_access": False})
        self.put("merges", merges)
        self.put("vocabulary", pa.table({"id": pa.array(list(ranks.values()), pa.int64()), "hex": [t.hex() for t in ranks]}))
        self.ranks, self.known = ranks, {}
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")

    def put(self, name: str, table) -> None:
        self.db.register("_given", table)
        self.db.execute(f"create or replace table {name} as from _given")
        self.db.unregister("_given")

    def rows(self, words: list[bytes]):
        """Token-position rows, one a byte; -1 stands for no neighbour."""
        np, pa = self.np, self.pa
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ids = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)
        pos = np.arange(len(ids)) - np.repeat(ends - sizes, sizes)
        after, after_id = pos + 1, np.append(ids[1:], -1)
        after[ends - 1] = after_id[ends - 1] = -1
        columns = {"word": word, "pos": pos, "id": ids, "after": after, "after_id": after_id, "before": pos - 1}
        return pa.table({n: pa.array(c, pa.int32()) for n, c in columns.items()})

    def contract(self, words: list[bytes], long: bool) -> list[bytes]:
        """The ids of each of these words by the merge table alone, as little-endian unsigned 32-bit integers."""
        np, pa = self.np, self.pa
        state, done = self.rows(words), []
        while state.num_rows:
            self.put("given", state)
            steps = max(1, ROWS // state.num_rows)
            out = self.db.sql((CONTRACT_LONG if long else CONTRACT).replace("$steps", str(steps))).to_arrow_table()
            done.append(out.filter(out["done"]))
            state = out.filter(pa.compute.invert(out["done"])).drop_columns(["done"])
        word, pos, ids = (np.concatenate([t[c].to_numpy() for t in done]) for c in ("word", "pos", "id"))
        if len(done) > 1:
            order = np.lexsort((pos, word))
            word, ids = word[order], ids[order]
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        flat = ids.astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, words: set[str]) -> None:
        """Answers for words not met before."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new, short, room = [], [], ROWS
        for w in words - self.known.keys():
            b = w.encode()
            if (r := self.ranks.get(b)) is not None:
                self.known[w] = r.to_bytes(4, "little")
            elif len(b) > LONG:
                new.append(([w], [b], True))
            else:
                short.append((w, b))
                room -= len(b) * len(b) // 2
                if room < 0:
                    new.append((*map(list, zip(*short)), False))
                    short, room = [], ROWS
        if short:
            new.append((*map(list, zip(*short)), False))
        for w, b, long in new:
            self.known.update(zip(w, self.contract(b, long)))

    def blocks(self, text: str):
        """The words of a text, a bounded number of characters at a time."""
        if len(text) <= BLOCK:
            yield self.words.findall(text)
            return
        found = (m.group() for m in self.words.finditer(text))
        while block := list(islice(found, BLOCK // 8)):
            yield block

    def encode(self, texts: list[str | None]):
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        group, chars = [], 0

        def answers():
            split = [self.words.findall(t) for t in group]
            self.learn(set(chain.from_iterable(split)))
            return [b"".join(map(self.known.__getitem__, w)) for w in split]

        for t in texts:
            t = t or ""
            if len(t) > BLOCK:
                yield from answers()
                group, chars, parts = [], 0, []
                for words in self.blocks(t):
                    self.learn(set(words))
                    parts.append(b"".join(map(self.known.__getitem__, words)))
                yield b"".join(parts)
                continue
            group.append(t)
            chars += len(t)
            if chars > BLOCK:
                yield from answers()
                group, chars = [], 0
        yield from answers()

    def decode(self, tokens: list[bytes]):
        """The bytes of each text's ids; an id outside the vocabulary is an error."""
        np = self.np
        out: list[list[bytes]] = [[] for _ in tokens]
        held, count = [], 0

        def joined():
            ids = np.frombuffer(b"".join(b for _, b in held), "<u4").astype(np.int64)
            block = np.repeat(np.arange(len(held)), [len(b) // 4 for _, b in held])
            self.put("tokens", self.pa.table({"block": block, "pos": np.arange(len(ids)), "id": ids}))
            for b, text, n in sorted(self.db.execute(DECODE).fetchall()):
                if 4 * n != len(held[b][1]):
                    raise ValueError("an id is not in the vocabulary")
                out[held[b][0]].append(text)
                done[b] = True
            if not all(done[: len(held)]):
                raise ValueError("an id is not in the vocabulary")

        for d, b in enumerate(tokens):
            for at in range(0, len(b), 4 * TOKENS):
                held.append((d, b[at : at + 4 * TOKENS]))
                count += len(held[-1][1])
                if count >= 4 * TOKENS:
                    done = [False] * len(held)
                    joined()
                    held, count = [], 0
        if held:
            done = [False] * len(held)
            joined()
        return [b"".join(parts) for parts in out]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def decimal_sha256(ids: bytes) -> str:
    """The hash of the decimal ids joined by commas, block by block."""
    import hashlib

    import numpy as np

    sha = hashlib.sha256()
    for at in range(0, len(ids), 4 * TOKENS):
        sha.update(("," if at else "").encode() + ",".join(map(str, np.frombuffer(ids[at : at + 4 * TOKENS], "<u4").tolist())).encode())
    return sha.hexdigest()


CODED = "doc_id long, ids binary, ids_sha256 string, bytes binary"


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, back: bool = False) -> DataFrame:
    """doc_id, the ids of every whole text as little-endian unsigned 32-bit integers, and the hash of their decimals.

    With ``back`` the ids are decoded in the same task: ``bytes`` is what they stand for.
    """
    small_batches(docs.sparkSession)
    path, pattern = path or default_path(), pattern or default_pattern()
    names = [f.split()[0] for f in CODED.split(", ")][: 4 if back else 3]

    def run(batches):
        import pyarrow as pa

        own = codec(path, pattern)
        for batch in batches:
            ids = list(own.encode(batch.column("text").to_pylist()))
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(decimal_sha256, ids), pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(own.decode(ids), pa.binary())] if back else []), names)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, CODED if back else CODED.rsplit(", ", 1)[0])


def decode(tokens: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ``bytes``, what the ``ids`` of ``tokens`` stand for; NULL ids are none."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches):
        import pyarrow as pa

        own = codec(path, pattern)
        for batch in batches:
            found = own.decode([b or b"" for b in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")
