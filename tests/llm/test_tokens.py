"""Operators 1, 2 and 8 against the tokenizers library on whole texts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, queries, token_binary, token_counts, tokens
from tidemark.llm.common import scratch_root

LIBRARY = Tokenizer.from_file(tokens.default_path())
LIBRARY.encode_special_tokens = True


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


ALPHABET = st.sampled_from(list("aBz é×÷'.,*%09\n\t ") + ["'s", "  ", " ", " ", "\u0085", "\x1c", "ß", "中", "😀", "　", "\0", " the", "ing", "\r\n", "ª", "<|endoftext|>"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=40).map("".join), max_size=6))
def test_cached_encoding_equals_whole_texts(texts):
    got = [x.tolist() for x in tokens.encoder(tokens.default_path()).encode(texts)]
    assert got == [whole(t) for t in texts]


def test_very_long_text_is_cut_safely(monkeypatch, fixture_rows):
    monkeypatch.setattr(tokens, "BLOCK", 5_000)
    text = next(r[1] for r in fixture_rows if r[0] == 103)
    assert next(tokens.encoder(tokens.default_path()).encode([text])).tolist() == whole(text)


def test_binary_files_round_trip(spark, docs, fixture_rows):
    folder = scratch_root(spark)
    manifest = token_binary.write_tokens(docs, folder)
    got = token_binary.read_tokens(spark, folder, manifest).collect()
    want = sorted(((r[0], r[1]) for r in fixture_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert len(got) == len(want)
    start = 0
    for g, (doc, text) in zip(sorted(got, key=lambda r: r["start"]), want):
        ids = whole(text) + [0]
        assert (g["doc_id"], g["start"], np.frombuffer(g["ids"], "<u4").tolist()) == (doc, start, ids)
        start += len(ids)


def test_binary_of_nothing(spark, no_docs):
    folder = scratch_root(spark)
    assert token_binary.read_tokens(spark, folder, token_binary.write_tokens(no_docs, folder)).count() == 0


def test_binary_query(spark, sf):
    got = {r["doc_id"]: r for r in queries.op2_token_binary(spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = whole(r["text"]) + [0]
        g = got.pop(r["doc_id"])
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert not got


def check_packing(pieces, docs, window=1024):
    """``pieces``: rows with ids; ``docs``: list of (doc_id, ids)."""
    sequences = {}
    parts = {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        parts.setdefault(p["doc_id"], []).append((p["start"], ids, p["doc_tokens"]))
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    want = {}
    for doc, ids in docs:
        want.setdefault(doc, []).extend(ids)
    for doc, ids in want.items():
        assert sum(len(x) for _, x, _ in parts[doc]) == len(ids)
    for doc, ids in docs:
        if sum(d == doc for d, _ in docs) == 1:
            assert [i for _, x, _ in sorted(parts[doc]) for i in x] == ids
            assert {t for _, _, t in parts[doc]} == {len(ids)}
    assert set(parts) == set(want)
    return padding


def test_packing(docs, no_docs, fixture_rows):
    got = packing.pack(docs).collect()
    assert check_packing(got, [(r[0], whole(r[1]) + [0]) for r in fixture_rows]) == 0
    assert packing.pack(no_docs).count() == 0


def test_packing_query(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    got = packing.pack(table).collect()
    assert check_packing(got, [(r["doc_id"], whole(r["text"]) + [0]) for r in table.collect()]) == 0
    for r in queries.op8_packing(spark, sf).collect()[:50]:
        p = next(p for p in got if (p["doc_id"], p["start"]) == (r["doc_id"], r["start"]))
        assert r["ids_crc32"] == zlib.crc32(p["ids"]) and r["doc_tokens"] == p["doc_tokens"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=60))
def test_levels_take_the_least_sum_of_squares(sizes):
    levels, counts = packing.Levels(16), [0] * 17
    for i, s in enumerate(sizes):
        def after(h):
            c = list(counts)
            if h:
                c[h] -= 1
            c[h + s] += 1
            return sum(x * x for x in c[1:16])
        options = [h for h in range(0, 17 - s) if h == 0 or counts[h]]
        h = levels.level_for(s)
        assert h in options and after(h) == min(map(after, options))
        levels.place((i, 0, [0] * s, s), s)
        if h:
            counts[h] -= 1
        if h + s < 16:
            counts[h + s] += 1
        assert levels.counts[1:16].tolist() == counts[1:16]


def test_open_windows_are_bounded():
    levels, out = packing.Levels(1024), []
    for i in range(20_000):
        out += [w] if (w := levels.place((i, 0, np.full(600, i, dtype="<u4"), 600), 600)) else []
        out += levels.thin()
        assert max(map(len, levels.open)) <= packing.OPEN + 1
    assert sum(map(len, levels.open)) <= 64 * packing.OPEN and all(sum(len(p[2]) for p in w) == 1024 for w in out)
    out += levels.close()
    got = [p for w in out for p in w]
    at = {(p[0], p[1]): p[2] for p in got}
    assert len(at) == len(got) and sum(len(p[2]) for p in got) == 20_000 * 600
    for i in range(20_000):
        start = 0
        while start < 600:
            assert (at[i, start] == i).all()
            start += len(at[i, start])


def test_a_hot_doc_id_is_dealt_over_tasks(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"text {i}") for i in range(300)] + [(7, f"{i * 37 % 600:03d} hot text") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pieces = packing.pack(table).withColumn("task", F.spark_partition_id())
    assert check_packing(pieces.collect(), [(d, whole(t) + [0]) for d, t in rows]) == 0
    assert max(r["count"] for r in pieces.filter("start = 0").groupBy("task").count().collect()) <= 400
    folder = scratch_root(spark)
    assert max(r["n_docs"] for r in token_binary.write_tokens(table, folder).collect()) <= 400


SPLICES = st.lists(st.tuples(st.integers(0, 900), st.integers(0, 60), st.lists(ALPHABET, max_size=12).map("".join)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=400).map("".join), SPLICES)
def test_tree_equals_encoding_the_edited_text(text, splices):
    enc = tokens.encoder(tokens.default_path())
    tree = token_counts.Tree.of(token_counts.leaves(enc, text, 16))
    for start, length, new in splices:
        start = min(start, len(text))
        length = min(length, len(text) - start)
        want = text[:start] + new + text[start + length :]
        tree, text, _ = tree.edit(enc, text, start, length, new)
        assert text == want and tree.chars[1] == len(text) and tree.tokens[1] == len(whole(text))


def test_edits_of_a_table(spark, docs, no_docs, fixture_rows):
    edits = spark.createDataFrame(
        [(0, 5, 3, "new words"), (0, 5, 3, "new words"), (0, 4, 9, "x"), (103, 70_000, 10, None), (103, 0, 0, "Start "), (101, 0, 5, "abc"), (None, 1, 1, "z"), (104, 99, 1, "!")],
        "doc_id long, start int, length int, replacement string",
    )
    trees = token_counts.build(docs)
    got = token_counts.apply_edits(token_counts.with_edits(trees, edits)).collect()
    assert len(got) == len(fixture_rows)
    for r in got:
        assert r["edited_tokens"] == len(whole(r["edited_text"])) and r["edited_chars"] == len(r["edited_text"])
    by = {r["doc_id"]: r for r in got}
    assert (by[0]["n_edits"], by[0]["n_rejected"]) == (1, 1)
    assert by[103]["edited_text"].startswith("Start ") and by[103]["reencoded_chars"] < 4_000
    assert by[101]["edited_text"] == "abc" and by[104]["edited_text"] == "word!"
    assert token_counts.apply_edits(token_counts.with_edits(token_counts.build(no_docs), edits)).count() == 0


def test_counts_query(spark, sf):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op1_token_counts(spark, sf).collect()
    assert len(rows) == len(table)
    for r in rows:
        assert r["n_tokens"] == len(whole(table[r["doc_id"]])) and r["n_edits"] == 3


@pytest.mark.parametrize("size", [0, 1, 7])
def test_small_texts_have_trees(size):
    enc = tokens.encoder(tokens.default_path())
    t = token_counts.Tree.of(token_counts.leaves(enc, "a" * size))
    assert t.chars[1] == size and t.tokens[1] == len(whole("a" * size))


PLAIN = Tokenizer.from_file(tokens.default_path())  # as the file has it
WITH_ADDED = st.one_of(ALPHABET, st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<|", " "]))


def as_given(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(WITH_ADDED, max_size=40).map("".join), max_size=6))
def test_added_tokens_are_read_as_the_library_reads_them(texts):
    got = [x.tolist() for x in tokens.encoder(tokens.default_path(), True).encode(texts)]
    assert got == [as_given(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(WITH_ADDED, max_size=200).map("".join), st.lists(st.tuples(st.integers(0, 400), st.integers(0, 30), st.lists(WITH_ADDED, max_size=6).map("".join)), max_size=6))
def test_edits_make_and_break_added_tokens(text, splices):
    enc = tokens.encoder(tokens.default_path(), True)
    tree = token_counts.Tree.of(token_counts.leaves(enc, text, 16))
    for start, length, new in splices:
        start = min(start, len(text))
        tree, text, _ = tree.edit(enc, text, start, min(length, len(text) - start), new)
        assert tree.chars[1] == len(text) and tree.tokens[1] == len(as_given(text))


def test_queries_read_added_tokens(spark, tmp_path):
    texts = {1: "a<|endoftext|>b", 2: "plain", 3: " x  <|endoftext|> y"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert as_given(texts[1]) == [64, 50256, 65]
    want = {d: as_given(t) for d, t in texts.items()}
    binary = {r["doc_id"]: r for r in queries.op2_token_binary(spark, str(tmp_path)).collect()}
    assert {d: (r["n_tokens"], r["ids_crc32"]) for d, r in binary.items()} == {d: (len(x) + 1, crc(x + [0])) for d, x in want.items()}
    assert binary[2]["start"] == len(want[1]) + 1
    assert {r["doc_id"]: r["n_tokens"] for r in queries.op1_token_counts(spark, str(tmp_path)).collect()} == {d: len(x) for d, x in want.items()}
    assert {r["doc_id"]: r["doc_tokens"] for r in queries.op8_packing(spark, str(tmp_path)).collect()} == {d: len(x) + 1 for d, x in want.items()}
