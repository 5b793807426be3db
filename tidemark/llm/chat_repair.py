"""Operator 11: repair of conversations by weighted CYK interval parsing.

A conversation is its rows by turn.  Edits: Keep a row (0), Rerole it to user or
assistant (1), Delete it (2; the only edit of blank and duplicate rows), Insert an
empty row (5); a truncated row that stays adds 5.  The repaired roles' initials
must read ``(s?(ua)+)?``.  The cheapest edits win, and of equally cheap ones the
audit, their initials in order, that is least in ASCII.

Grammar, in Chomsky normal form, over what a span of rows may become:
``E`` nothing; ``xy`` (x, y of u, a) an alternation from x to y; ``s``; ``sy`` an s and
an alternation from u to y.  Every rule joins two neighbours: ``E X -> X``, ``X E -> X``,
``xy zw -> xw`` and ``sy zw -> sw`` where z is not y, ``s uw -> sw``.  Accepted: E, ua, sa.

Cells.  A span's cell holds, for each symbol, the least (cost, audit).  An inserted
row is a terminal of an empty span; the insertion closure adds it on either side
of a cell until nothing improves.  Least audits suffice: two audits of one span, symbol
and cost are never one the other's beginning (what the longer had more would be
insertions, which cost), so what follows cannot change their order.

Spans.  Up to ``CHART`` rows a full chart is filled, bottom-up by span length, over all
splits.  The grammar has a symbol for every piece of an alternation, so a derivation can be
bracketed anyhow, and longer spans need one split: they are combined bottom-up by
doubling lengths, in a segment, then across segments, ``FAN`` at a time, in Spark.

Rows are dealt by ranges of (conversation, turn, role, text hash), so a conversation
with a third of all rows is spread over many tasks.  One that lies inside a range is
solved where it is read; one that crosses a border or passes ``ROWS`` rows or ``CHARS``
characters becomes segments: repeats across segments are found by hashes of (role, text),
segments are parsed each by itself, their cells are combined, and the audit is
dealt back to them.  The SHA-256 of such a conversation reads its pieces in order
as a stream, since a hash cannot be split.

NULL role and text are one space, so such a text is blank and such a role is
always reroled or deleted.  NULL turns come first; a NULL conv_id is a conversation.
Rows of one turn are ordered by role, then by the text's 64-bit hash; the rest are
alike.  Repeated rows are duplicates.  Empty texts are blank; very long texts are a
segment of their own.  Other columns are ignored, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import partitions, scratch_root, small_batches, written

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CHART = 8
#: Rows and characters of a segment; segments combined by one task.
ROWS, CHARS, FAN = 4096, 4_000_000, 64

BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
ALTERNATIONS = ("uu", "ua", "au", "aa")
ACCEPTED = ("E", "ua", "sa")


def _rules() -> dict[str, list[tuple[str, str]]]:
    """For each symbol its right neighbours and what the two make."""
    symbols = ("E", *ALTERNATIONS, "s", "su", "sa")
    out = {x: [("E", x)] for x in symbols}
    out["E"] = [(x, x) for x in symbols]
    for x in (*ALTERNATIONS, "su", "sa"):
        out[x] += [(y, x[0] + y[1]) for y in ALTERNATIONS if y[0] != x[1]]
    out["s"] += [(y, "s" + y[1]) for y in ALTERNATIONS if y[0] == "u"]
    return out


RULES = _rules()
INSERTED = {"uu": (INSERT, "I"), "aa": (INSERT, "I")}
NOTHING = {"E": (0, "")}


def better(cell: dict, other: dict) -> bool:
    """Put the lesser entries of ``other`` into ``cell``; whether there were any."""
    changed = False
    for symbol, entry in other.items():
        if symbol not in cell or entry < cell[symbol]:
            cell[symbol], changed = entry, True
    return changed


def join(left: dict, right: dict) -> dict:
    """The cell of two neighbouring spans by one split."""
    out: dict = {}
    for x, (cost, audit) in left.items():
        for y, made in RULES[x]:
            if y in right:
                c = cost + right[y][0]
                if made not in out or c <= out[made][0]:
                    entry = (c, audit + right[y][1])
                    if made not in out or entry < out[made]:
                        out[made] = entry
    return out


def closed(cell: dict) -> dict:
    """The insertion closure."""
    while better(cell, join(cell, INSERTED)) | better(cell, join(INSERTED, cell)):
        pass
    return cell


@lru_cache(maxsize=None)
def leaf(code: str) -> dict:
    """One row's cell.  Codes: D only deleted; s, u, a, o (other) by initial, in capitals if truncated."""
    cell = {"E": (DELETE, "D")}
    if code != "D":
        more, initial = TRUNCATED * code.isupper(), code.lower()
        better(cell, {"uu": (REROLE + more, "R"), "aa": (REROLE + more, "R")})
        if initial != "o":
            better(cell, {"s" if initial == "s" else initial * 2: (more, "K")})
    return closed(cell)


@lru_cache(maxsize=1 << 15)
def chart(codes: str) -> dict:
    """The cell of a few rows, from all spans and all splits."""
    n = len(codes)
    cells = {(i, i + 1): leaf(c) for i, c in enumerate(codes)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: dict = {}
            for k in range(i + 1, i + length):
                better(cell, join(cells[i, k], cells[k, i + length]))
            cells[i, i + length] = closed(cell)
    return cells[0, n]


def doubled(cells: list[dict]) -> dict:
    """The cell of neighbouring spans, bottom-up by doubling lengths."""
    while len(cells) > 1:
        pairs = [closed(join(a, b)) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(cells) // 2 * 2 :]
    return cells[0] if cells else dict(NOTHING)


def parse(codes: str) -> dict:
    return doubled([chart(codes[i : i + CHART]) for i in range(0, len(codes), CHART)])


def cheapest(cell: dict) -> tuple[int, str, bool]:
    """Cost, audit, and whether the repaired conversation begins with s."""
    cost, audit, symbol = min((*cell[x], x) for x in ACCEPTED if x in cell)
    return cost, audit, symbol == "sa"


def codes_of(rows: list[tuple], repeated=frozenset()) -> tuple[str, dict]:
    """The rows' codes, and the counts that neighbouring segments add up.  ``repeated``: keys met in earlier segments."""
    seen, codes = set(repeated), []
    blank = duplicate = truncated = illegal = turns = 0
    first = last = before = None
    for turn, role, text in rows:
        initial, text_end = role[:1], text.rstrip(BLANKS)[-1:]
        if before is not None:
            illegal += before + initial not in LEGAL
        before = initial
        if turn is not None:
            turns += turn != last
            first, last = turn if first is None else first, turn
        code = initial if initial in ("s", "u", "a") else "o"
        if not text_end:
            blank, code = blank + 1, "D"
        elif (key := key_of(role, text)) in seen:
            duplicate, code = duplicate + 1, "D"
        else:
            seen.add(key)
            if text_end not in ".!?":
                truncated, code = truncated + 1, code.upper()
        codes.append(code)
    counts = {"blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "n": len(rows), "turns": turns,
              "first_turn": first, "last_turn": last, "first_initial": rows[0][1][:1] if rows else None, "last_initial": before}
    return "".join(codes), counts


def key_of(role: str, text: str) -> bytes:
    import hashlib

    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def added(a: dict, b: dict) -> dict:
    """The counts of two neighbouring segments together."""
    if not a["n"] or not b["n"]:
        return dict(b if b["n"] else a)
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "n", "turns")}
    out["illegal"] += a["last_initial"] + b["first_initial"] not in LEGAL
    out["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    out["first_turn"] = b["first_turn"] if a["first_turn"] is None else a["first_turn"]
    out["last_turn"] = a["last_turn"] if b["last_turn"] is None else b["last_turn"]
    return out | {"first_initial": a["first_initial"], "last_initial": b["last_initial"]}


def gaps(counts: dict) -> int:
    return 0 if counts["last_turn"] is None else counts["last_turn"] - counts["first_turn"] + 1 - counts["turns"]


def lines(rows: list[tuple], audit: str, emitted: int, with_s: bool) -> list[str]:
    """The repaired ``role:text`` of these rows; ``emitted``: repaired rows before them."""
    out, at = [], iter(rows)
    for edit in audit:
        row = ("", "") if edit == "I" else next(at)[1:]
        if edit == "D":
            continue
        role = row[0] if edit == "K" else ("user", "assistant")[(emitted - with_s) % 2]
        out.append(f"{role}:{row[1]}")
        emitted += 1
    return out


def dealt_back(audit: str, sizes: list[int]) -> list[str]:
    """The audit's piece of each segment; insertions at a border go to the later one, at the end to the last."""
    out, at = [], 0
    for i, n in enumerate(sizes):
        end = at
        while n:
            n -= audit[end] != "I"
            end += 1
        out.append(audit[at:] if i == len(sizes) - 1 else audit[at:end])
        at = end
    return out


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
READ = f"conv_id long, whole boolean, at long, {COUNTS}, body string, turns array<long>, roles array<string>, texts array<string>"
STATE = "blank long, duplicate long, truncated long, illegal long, n long, turns long, first_turn long, last_turn long, first_initial string, last_initial string"


def _arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _read(turns: DataFrame) -> DataFrame:
    """Sorted rows to whole conversations, solved, and segments of the rest."""
    schema = _arrow(READ)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, out, made = TaskContext.get().partitionId(), [], 0
        now, rows, chars, inside = None, [], 0, False  # inside: the conversation began in this partition, and is whole so far
        none = dict.fromkeys(n for n in schema.names)

        def segment():
            nonlocal made, rows, chars
            out.append(none | {"conv_id": now[0], "whole": False, "at": part << 32 | made, "turns": [r[0] for r in rows], "roles": [r[1] for r in rows], "texts": [r[2] for r in rows]})
            made, rows, chars = made + 1, [], 0

        def solved():
            codes, counts = codes_of(rows)
            cost, audit, with_s = cheapest(parse(codes))
            body = "\n".join(lines(rows, audit, 0, with_s))
            out.append(none | {"conv_id": now[0], "whole": True, "gaps": gaps(counts), "cost": cost, "audit": audit, "body": body} | {k: counts[k] for k in ("blank", "duplicate", "truncated", "illegal")})

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies"))
            for conv, turn, role, text, copies in zip(*columns):
                if now is None or conv != now[0]:
                    if now is not None:
                        solved() if inside else segment()
                        inside = True
                    now, rows, chars = (conv,), [], 0
                for _ in range(copies):
                    rows.append((turn, role, text))
                    chars += len(text)
                    if len(rows) >= ROWS or chars >= CHARS:
                        segment()
                        inside = False
            if len(out) >= 1000 or sum(len(r["texts"] or ()) for r in out) > ROWS:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if now is not None:
            segment()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return turns.mapInArrow(run, READ)


def _rows(row: dict) -> list[tuple]:
    return list(zip(row["turns"], row["roles"], row["texts"]))


def _mapped(df: DataFrame, each, schema: str) -> DataFrame:
    """``each`` gives the output rows of one input row."""
    arrow = _arrow(schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):  # a row is a segment
                if out := list(each(batch.slice(i, 1).to_pylist()[0])):
                    yield pa.RecordBatch.from_pylist(out, arrow)

    return df.mapInArrow(run, schema)


CELLS = f"conv_id long, at long, {STATE}, cells array<struct<symbol: string, cost: long, audit: string>>, parts array<struct<at: long, n: long>>"


def _packed(conv, at, counts: dict, cell: dict, parts: list) -> dict:
    return {"conv_id": conv, "at": at} | counts | {"cells": [{"symbol": s, "cost": c, "audit": a} for s, (c, a) in cell.items()], "parts": parts}


def _segments(read: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Conversations in segments: their summaries, and their repaired pieces."""
    segments = read.filter(~F.col("whole")).select("conv_id", "at", "turns", "roles", "texts")

    def keys(row):
        for key in {key_of(role, text) for _, role, text in _rows(row) if text.strip(BLANKS)}:
            yield {"conv_id": row["conv_id"], "at": row["at"], "key": key}

    met = _mapped(segments, keys, "conv_id long, at long, key binary")  # one row a segment and text, however often it is there
    earlier = met.withColumn("first", F.min("at").over(Window.partitionBy("conv_id", "key"))).filter(F.col("at") > F.col("first"))
    earlier = earlier.groupBy(F.col("conv_id").alias("c"), F.col("at").alias("t")).agg(F.collect_list("key").alias("earlier"))  # at most a segment's rows
    same = lambda a, b: a["conv_id"].eqNullSafe(b["c"]) & (a["at"] == b["t"])

    def cells(row):
        codes, counts = codes_of(_rows(row), row["earlier"] or ())
        yield _packed(row["conv_id"], row["at"], counts, parse(codes), [{"at": row["at"], "n": counts["n"]}])

    parsed = _mapped(segments.join(earlier, same(segments, earlier), "left").drop("c", "t"), cells, CELLS)
    order = F.row_number().over(Window.partitionBy("conv_id").orderBy("at")) - 1
    parsed = written(parsed.withColumn("place", order.cast("long")), "cells", root)
    most = parsed.agg(F.max("place")).first()[0] or 0
    arrow = _arrow(CELLS + ", place long")

    def combined(table):
        import pyarrow as pa

        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        counts = rows[0]
        for r in rows[1:]:
            counts = added(counts, r)
        counts = {k: counts[k] for k in (c.split()[0] for c in STATE.split(", "))}
        cell = doubled([{c["symbol"]: (c["cost"], c["audit"]) for c in r["cells"]} for r in rows])
        one = _packed(rows[0]["conv_id"], rows[0]["at"], counts, cell, [p for r in rows for p in r["parts"]])
        return pa.Table.from_pylist([one | {"place": rows[0]["place"] // FAN}], arrow)

    while most:
        parsed = parsed.groupBy("conv_id", F.floor(F.col("place") / FAN).alias("up")).applyInArrow(combined, CELLS + ", place long")
        most //= FAN
    ends = f"conv_id long, {COUNTS}, deal array<struct<at: long, audit: string, emitted: long, with_s: boolean>>"

    def finished(row):
        cost, audit, with_s = cheapest({c["symbol"]: (c["cost"], c["audit"]) for c in row["cells"]})
        deal, emitted = [], 0
        for p, piece in zip(row["parts"], dealt_back(audit, [p["n"] for p in row["parts"]])):
            deal.append({"at": p["at"], "audit": piece, "emitted": emitted, "with_s": with_s})
            emitted += len(piece) - piece.count("D")
        yield {"conv_id": row["conv_id"], "gaps": gaps(row), "cost": cost, "audit": audit, "deal": deal} | {k: row[k] for k in ("blank", "duplicate", "truncated", "illegal")}

    done = written(_mapped(parsed.drop("place"), finished, ends), "finished", root)
    deal = done.select(F.col("conv_id").alias("c"), F.explode("deal").alias("d")).select("c", F.col("d.at").alias("t"), "d.audit", "d.emitted", "d.with_s")

    def bodies(row):
        if found := lines(_rows(row), row["audit"], row["emitted"], row["with_s"]):
            yield {"conv_id": row["conv_id"], "at": row["at"], "body": "\n".join(found)}

    pieces = _mapped(segments.join(deal, same(segments, deal)).drop("c", "t"), bodies, "conv_id long, at long, body string")
    return done.drop("deal"), pieces


def sha256_of_pieces(pieces: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its pieces, in order and joined by newlines, read as a stream."""
    schema = "conv_id long, repaired_sha256 string"

    def run(batches):
        import hashlib

        import pyarrow as pa

        now, sha, out = None, None, []
        for batch in batches:
            for conv, body in zip(batch.column("conv_id").to_pylist(), batch.column("body").to_pylist()):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append((now[0], sha.hexdigest()))
                    now, sha = (conv,), hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(body.encode())
        if now is not None:
            out.append((now[0], sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([s for _, s in out], pa.string())], ["conv_id", "repaired_sha256"])

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(run, schema)


SUMMARY = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _solved(turns: DataFrame, copies: Column | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Whole conversations (summary and body); and the summaries and pieces of those in segments."""
    spark = turns.sparkSession
    small_batches(spark)
    root = scratch_root(spark)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    given = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"),
        (F.lit(1) if copies is None else copies).cast("int").alias("copies"), F.monotonically_increasing_id().alias("m"),
    )
    keys = ["conv_id", "turn", "role", F.xxhash64("text"), "m"]
    dealt = given.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).drop("m")
    read = written(_read(dealt), "read", root)
    return read.filter("whole"), *_segments(read, root)


def repair(turns: DataFrame, copies: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The conversations of ``turns`` (conv_id, turn, role, text): summaries and repaired texts.

    ``copies`` says how often a row is there (default: once); with 0 it only names
    its conversation, which may then be one without rows.  The summaries have one row
    a conversation: its counts, cost and audit.  The repaired texts have pieces (conv_id, at,
    body) of lines ``role:text``, to be read in the order of ``at``; a conversation without
    repaired rows has an empty piece or none.
    """
    whole, parts, pieces = _solved(turns, copies)
    texts = whole.select("conv_id", F.lit(0).cast("long").alias("at"), "body")
    return whole.select(*SUMMARY).unionByName(parts.select(*SUMMARY)), texts.unionByName(pieces)


def repaired_hashes(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """The summaries with ``repaired_sha256``; only conversations in segments are shuffled for it."""
    whole, parts, pieces = _solved(turns, copies)
    sums = sha256_of_pieces(pieces).withColumnRenamed("conv_id", "c")
    parts = parts.join(sums, parts["conv_id"].eqNullSafe(sums["c"]), "left")
    sha = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return whole.select(*SUMMARY, F.sha2("body", 256).alias("repaired_sha256")).unionByName(parts.select(*SUMMARY, sha))


def damage(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """The test's damage by crc32(``conv_id:turn``) % 20, and the column that says how often a row is there."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turns = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"))
    turns = turns.withColumn("_fault", F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20)
    text = F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col("role"))
    return turns.withColumns({"text": text, "role": role}), F.when(F.col("_fault") == 0, 0).when(F.col("_fault") == 3, 2).otherwise(1)
