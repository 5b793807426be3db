"""Operators 11, 12 and 13 against plain versions of the same contracts."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_bpe, chat_repair, hard_negatives, queries

# 11: conversation repair

CODES = "DsuaoSUAO"


def every_repair(code):
    """All edits of a few rows with up to four insertions: the least (cost, audit)."""
    best = None
    places = len(code) + 1
    for inserts in itertools.product(range(5), repeat=places):
        if sum(inserts) > 4:
            continue
        for edits in itertools.product("KRD", repeat=len(code)):
            if any(c == "D" and e != "D" or c in "oO" and e == "K" for c, e in zip(code, edits)):
                continue
            audit, roles, cost = "I" * inserts[0], ["?"] * inserts[0], 5 * sum(inserts)
            for c, e, n in zip(code, edits, inserts[1:]):
                audit += e + "I" * n
                cost += {"K": 0, "R": 1, "D": 2}[e] + 5 * (e != "D" and c.isupper())
                roles += ([] if e == "D" else [c.lower()] if e == "K" else ["?"]) + ["?"] * n
            if best is not None and (cost, audit) >= best:
                continue
            if any(all(x in ("?", y) for x, y in zip(roles, want)) for want in wanted(len(roles)) if "s" not in want or roles[0] == "s"):
                best = cost, audit
    return best


def wanted(n):
    """The accepted strings of n roles."""
    return [""] if n == 0 else ["ua" * (n // 2)] if n % 2 == 0 else ["s" + "ua" * (n // 2)] if n > 1 else []


def left_to_right(code):
    """The same by a walk over the rows; a state is the role before."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(states):
        for _ in range(3):
            for p, (c, a) in list(states.items()):
                for q in follow[p]:
                    if q != "s" and (q not in states or (c + 5, a + "I") < states[q]):
                        states[q] = c + 5, a + "I"
        return states

    states = inserted({"": (0, "")})
    for x in code:
        new = {}
        for p, (c, a) in states.items():
            moves = [(p, 2, "D")]
            if x != "D":
                for q in follow[p]:
                    more = 5 * x.isupper()
                    moves += [(q, more, "K")] if q == x.lower() else []
                    moves += [(q, 1 + more, "R")] if q != "s" else []
            for q, d, e in moves:
                if q not in new or (c + d, a + e) < new[q]:
                    new[q] = c + d, a + e
        states = inserted(new)
    return min(states[p] for p in ("", "a") if p in states)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=CODES, max_size=3))
def test_cheapest_edits_of_all(code):
    assert chat_repair.cheapest(chat_repair.parse(code))[:2] == every_repair(code)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=CODES, max_size=60))
def test_parsing_equals_a_walk(code):
    assert chat_repair.cheapest(chat_repair.parse(code))[:2] == left_to_right(code)


def test_all_splits_equal_one_split(monkeypatch):
    r = random.Random(5)
    for _ in range(40):
        code = "".join(r.choice(CODES) for _ in range(r.randint(1, 14)))
        whole = chat_repair.chart(code)
        for at in range(1, len(code)):
            assert chat_repair.closed(chat_repair.join(chat_repair.chart(code[:at]), chat_repair.chart(code[at:]))) == whole


def plain_conversations(rows):
    """Damage and repair of plain rows, as the contract words them."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        by[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = []
    for conv, found in by.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        codes, seen, n = "", set(), Counter()
        for turn, role, text in found:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            if not marks:
                n["blank"] += 1
                codes += "D"
            elif (role, text) in seen:
                n["duplicate"] += 1
                codes += "D"
            else:
                code = role[:1] if role[:1] in tuple("sua") else "o"
                if marks[-1] not in ".!?":
                    n["truncated"] += 1
                    code = code.upper()
                codes += code
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [t for t, *_ in found if t is not None]
        cost, audit = left_to_right(codes)
        repaired, at = [], iter(found)
        for e in audit:
            _, role, text = (None, "", "") if e == "I" else next(at)
            if e == "D":
                continue
            if e != "K":
                role = "assistant" if repaired and repaired[-1][0] == "u" else "user"
            repaired.append(f"{role}:{text}")
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return Counter(out)


def conversations():
    r = random.Random(11)
    out = []
    for conv in range(60):
        for turn in range(r.randint(1, 30)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User"]) if r.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = r.choice(["Yes.", "No", "", " \t", f"Turn {turn}.", f"Cut {turn}", "é!", "a\nb?", "x" * 5000 + "."])
            out.append((conv, turn, role, text))
    out += [(None, t, "user", f"{t}.") for t in range(5)] + [(100, None, None, None), (100, None, "user", "a."), (100, 3, "assistant", "b."), (101, None, "system", "s.")]
    out += [(102, 7, "user", "same.")] * 40  # one turn, repeated rows
    hot = 200
    out += [(hot, t, ("user", "assistant", "user", "system")[r.randrange(4)], r.choice(["again and again.", f"{t % 50}.", f"{t}", f"{t}!", ""])) for t in range(1500)]
    # conversations of which every row is dropped
    out += [(c, 0, "user", "gone.") for c in range(1000, 1200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    return out


@pytest.mark.parametrize("rows", [4096, 16])
def test_conversations(spark, monkeypatch, rows):
    monkeypatch.setattr(chat_repair, "ROWS", rows)
    monkeypatch.setattr(chat_repair, "FAN", 5)
    given = conversations()
    extra = [(*r, "mine", 1) for r in given]
    table = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, at string, copies int").repartition(5)
    damaged, copies = chat_repair.damage(table)
    names = [*chat_repair.SUMMARY, "repaired_sha256"]
    got = Counter(tuple(r) for r in chat_repair.repaired_hashes(damaged, copies).select(*names).collect())
    assert got == plain_conversations(given)
    summaries, texts = chat_repair.repair(damaged, copies)
    assert Counter(tuple(r) for r in summaries.select(*chat_repair.SUMMARY).collect()) == Counter(k[:-1] for k in got)
    pieces = defaultdict(list)
    for r in sorted(texts.collect(), key=lambda r: r["at"]):
        pieces[r["conv_id"]].append(r["body"])
    assert all(hashlib.sha256("\n".join(pieces[k[0]]).encode()).hexdigest() == k[-1] for k in got)
    assert chat_repair.repaired_hashes(*chat_repair.damage(table.limit(0))).count() == 0


def test_conversations_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_chat_repair(spark, sf).select(*chat_repair.SUMMARY, "repaired_sha256").collect()
    assert Counter(map(tuple, got)) == plain_conversations(rows)


# 12: byte-level BPE


@pytest.fixture(scope="module")
def library():
    import tiktoken

    own = byte_bpe.codec(byte_bpe.default_path(), byte_bpe.default_pattern())
    return own, tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=own.ranks, special_tokens={})


WORDS = st.sampled_from(["a", "é", "甲", "😀", " ", "  ", "\n", "'s", "'", "1", "½", "the", "ion", "　", "՘", "\U0003134a", "\U00011de0", "_", "ab" * 70, "<|endoftext|>"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.lists(WORDS, max_size=30).map("".join), st.text(max_size=40)), max_size=4))
def test_bpe_equals_the_library(library, texts):
    own, enc = library
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    ids = list(own.encode(texts))
    assert lists(ids) == [enc.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]


def test_bpe_of_long_words_and_in_small_steps(library, monkeypatch):
    own, enc = library
    r = random.Random(2)
    texts = ["a" * 30_000, "".join(r.choice("acgt") for _ in range(1500)), " " * 3000 + "x", "ab" * 400, "".join(r.choice("甲乙丙丁的是") for _ in range(800))]
    assert lists(own.encode(texts)) == [enc.encode_ordinary(t) for t in texts]
    for name, value in (("ROWS", 300), ("BLOCK", 200), ("TOKENS", 7), ("KNOWN", 3)):
        monkeypatch.setattr(byte_bpe, name, value)
    texts = ["several ordinary words, " * 30, "x", "", None, "antidisestablishmentarianism " * 9, "b" * 150]
    own.known.clear()
    ids = list(own.encode(texts))
    assert lists(ids) == [enc.encode_ordinary(t or "") for t in texts]
    assert own.decode(ids) == [(t or "").encode() for t in texts]


def lists(coded):
    return [np.frombuffer(b, "<u4").tolist() for b in coded]


def plain_bpe(rows, enc):
    out = Counter()
    for doc, text in rows:
        ids = enc.encode_ordinary(text or "")
        out[doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    return out


def test_bpe_queries(spark, docs, no_docs, fixture_rows, sf, library, monkeypatch):
    _, enc = library
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert Counter(map(tuple, queries.op12_byte_bpe(spark, sf).collect())) == plain_bpe(rows, enc)
    monkeypatch.setattr(queries, "documents", lambda spark, sf_dir: docs)
    assert Counter(map(tuple, queries.op12_byte_bpe(spark, sf).collect())) == plain_bpe([r[:2] for r in fixture_rows], enc)
    assert byte_bpe.encode(docs).join(byte_bpe.decode(byte_bpe.encode(docs)), "doc_id").count() > 0
    assert byte_bpe.decode(byte_bpe.encode(no_docs)).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, b"\xff\xff\xff\x00")], "doc_id long, ids binary")).collect()


# 13: hard negatives


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 90), st.integers(1, 90), st.integers(0, 90), st.integers(0, 2**32))
def test_strassen(m, k, n, seed):
    r = np.random.default_rng(seed)
    a, b = r.integers(-(2**62), 2**62, (m, k)), r.integers(-(2**62), 2**62, (k, n))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(hard_negatives, "LEAF", 4)
        assert (hard_negatives.strassen(a, b) == a @ b).all()  # both wrap alike


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=6), st.integers(1, 3), st.data())
def test_heaps(rows, size, data):
    scores = np.array(rows, dtype=np.int64)
    scores[scores == -3] = np.iinfo(np.int64).min
    inside = np.array(data.draw(st.lists(st.lists(st.booleans(), min_size=4, max_size=4), min_size=len(rows), max_size=len(rows))))
    ids = np.array([5, 5, 7, hard_negatives.NO_ID])
    uid = np.arange(4)
    heap = hard_negatives.Heaps.best(scores[:, :2], inside[:, :2], ids[:2], uid[:2], size)
    heap = heap.merge(hard_negatives.Heaps.best(scores[:, 2:], inside[:, 2:], ids[2:], uid[2:], size), size)
    for i, row in enumerate(scores.tolist()):
        want = sorted((-s, int(d), int(u)) for s, d, u, on in zip(row, ids, uid, inside[i]) if on)[:size]
        valid, s, d, u = (p[i] for p in heap.parts)
        assert [(-int(x), int(y), int(z)) for on, x, y, z in zip(valid, s, d, u) if on] == want


def plain_negatives(rows, positives=5, negatives=5):
    rows = [(i, [int(np.floor(256.0 * x)) for x in v], l) for i, v, l in rows if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = lambda r: (r[0], r[1] is None, r[1] or 0)
    out = Counter()
    for n, (i, v, l) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), j, k) for m, (j, w, k) in enumerate(rows) if m != n), key=order)
        for p, j, _ in [s for s in scored if s[2] == l][:positives]:
            window = [s for s in scored if s[2] != l and 80 * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out.update((i, j, r + 1, s[1], -p, -s[0]) for r, s in enumerate(window))
    return out


def vectors():
    r = np.random.default_rng(4)
    out = []
    for i in range(600):
        label = int(r.choice([1, 2, 3, 4, 5, 6, -7, 99], p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.05, 0.03, 0.02]))
        out.append((i, [round(float(x), 2) for x in r.normal(0.2, 1, 5)], label))
    out += out[100:103] + [out[200]] * 3 + [(300, out[200][1], 2)]  # copies, also of anchors
    out += [(1000 + i, [0.5] * 5, 2 + i % 2) for i in range(60)]  # ties
    out += [(2000, None, 1), (2100, [1.0, None, 0.0, 0.0, 0.0], 1), (2200, [float("nan")] * 5, 1), (2300, [float("inf")] * 5, 1), (2400, [1.0] * 5, None), (None, [1.0] * 5, 1), (None, [1.0] * 5, 2)]
    out += [(2500, [], 1), (2600, [1.0, 2.0], 2), (2700, [1.0] * 9, 1), (-100, [-1.0] * 5, 3), (2800, [0.0] * 5, 4)]
    return out


@pytest.mark.parametrize("tile", [1024, 32])
def test_hard_negatives(spark, monkeypatch, tile):
    from pyspark.sql import functions as F

    for name, value in (("TILE", tile), ("CELL", 2), ("SPREAD", 3), ("LEAF", 2), ("HELD", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors()
    table = spark.createDataFrame([(*r, "mine", 3) for r in rows], "vec_id long, embedding array<float>, label int, uid string, score int").repartition(4)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    got = hard_negatives.mine(table, F.col("vec_id") % 100 == 0).collect()
    assert Counter(map(tuple, got)) == plain_negatives(rows)
    assert hard_negatives.mine(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_hard_negatives_query(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = [(i, v, l if l is None or i is None or i % 7 else (l + 1) % 10) for i, v, l in rows]
    assert Counter(map(tuple, queries.op13_hard_negatives(spark, sf).collect())) == plain_negatives(rows)
