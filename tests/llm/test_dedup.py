"""Operators 3 and 4 against brute force."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import exact_dedup, golomb, ngram_join, queries


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(1000, 1 << 50), max_size=200))
def test_golomb_round_trip(values):
    x = np.array(sorted(values), dtype=np.int64)
    assert golomb.decode(golomb.encode(x, 1000), 1000).tolist() == x.tolist()


def test_golomb_is_compact():
    x = np.unique(np.random.default_rng(0).integers(0, 1 << 30, 10_000))
    assert len(golomb.encode(x, 0)) < 10_000 * 19.5 / 8


def squeeze(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def brute_exact(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(squeeze(text), []).append((doc, text))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        for doc, _ in members:
            out.append((doc, keep[0], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return out, len(groups)


def test_exact(docs, no_docs, fixture_rows):
    got = exact_dedup.exact_duplicates(docs).collect()
    want, n = brute_exact([r[:2] for r in fixture_rows])
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["sha"].hex()) for r in got) == Counter(want)
    assert sum(r["kept"] for r in got) == n and len({r["sha"] for r in got if r["kept"]}) == n
    assert exact_dedup.exact_duplicates(no_docs).count() == 0


def test_exact_drop(docs, no_docs, fixture_rows):
    stay = exact_dedup.drop_exact_duplicates(docs)
    assert stay.columns == docs.columns
    rows = stay.collect()
    want, n = brute_exact([r[:2] for r in fixture_rows])
    assert len(rows) == n and Counter(r["doc_id"] for r in rows) == Counter({(w[1], w[3]): w[1] for w in want}.values())
    assert exact_dedup.drop_exact_duplicates(no_docs).count() == 0


def brute_sets(rows, n):
    out = []
    for doc, text in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
        out.append((doc, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    return out


def brute_components(rows, n, percent):
    sets = brute_sets(rows, n)
    up = {d: d for d, _ in sets if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, s), (b, t) in itertools.combinations([x for x in sets if x[0] is not None and x[1]], 2):
        m = len(s & t)
        if 100 * m >= percent * (len(s) + len(t) - m):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return Counter((d, len(s), None if d is None else find(d)) for d, s in sets)


def found(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_near(docs, no_docs, fixture_rows):
    for n, percent in ((4, 85), (5, 80)):
        assert found(ngram_join.near_duplicates(docs, n, percent)) == brute_components([r[:2] for r in fixture_rows], n, percent)
    assert ngram_join.near_duplicates(no_docs).count() == 0


def chained(r, n):
    """A chain of small edits, so that many members link only through others; and a passage that unrelated texts share."""
    base = [f"w{r.integers(0, 50)}" for _ in range(60)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(n):
        base = list(base)
        for _ in range(2):
            base[r.integers(0, 60)] = f"e{r.integers(0, 60)}"
        rows.append((3 * i + 1, " ".join(base)))
        rows.append((3 * i + 2, " ".join(passage + [f"u{i}x{j}" for j in range(r.integers(0, 12))])))
    return rows


def test_near_on_large_groups(spark, monkeypatch):
    """Few shingles are rare here, and runs are too long to pair, so every path is taken."""
    rows = chained(np.random.default_rng(3), 150)
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_components(rows, 4, 85)
    assert found(ngram_join.near_duplicates(df, 4, 85)) == want
    monkeypatch.setattr(ngram_join, "RUN", 3)
    monkeypatch.setattr(ngram_join, "TABLE", 0)
    assert found(ngram_join.near_duplicates(df, 4, 85)) == want


def test_near_of_a_doc_id_on_two_texts(spark):
    """5 carries B in its task and gives up A, which the other task holds too."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    tasks = [[(5, a), (5, b), (9, b)], [(3, a), (7, b + " end")]]
    df = [spark.createDataFrame(t, "doc_id long, text string").coalesce(1) for t in tasks]
    want = brute_components(sum(tasks, []), 4, 85)
    assert {c for _, _, c in want} == {3}
    assert found(ngram_join.near_duplicates(df[0].union(df[1]), 4, 85)) == want


def test_near_drop(docs, fixture_rows):
    stay = ngram_join.drop_near_duplicates(docs)
    want = brute_components([r[:2] for r in fixture_rows], 5, 80)
    assert stay.columns == docs.columns
    assert Counter(r["doc_id"] for r in stay.collect()) == Counter(d for (d, _, c), k in want.items() for _ in range(k) if d == c)


def test_queries(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in queries.op3_exact_dedup(spark, sf).collect())
    assert got == Counter(brute_exact(rows)[0])
    assert found(queries.op4_ngram_join(spark, sf)) == brute_components(rows, 4, 85)


def test_a_hot_shingle_is_one_entry_a_message(spark, monkeypatch):
    """Document frequencies over many messages, of a passage that a third of the documents share, against a plain count."""
    import random
    from collections import Counter

    monkeypatch.setattr(ngram_join, "ROUND", 500)
    r = random.Random(9)
    words = lambda n: " ".join(r.choice("abcdefghij") + str(r.randrange(300)) for _ in range(n))
    shared = words(20)
    texts = [f"{words(20)} {shared if i % 3 == 0 else words(20)} {words(5)}" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    slots, classes, bits = ngram_join._frequent(docs, 3, ngram_join.scratch_root(spark))
    count = Counter(int(h) >> (64 - bits) for t in texts for h in ngram_join.shingles(t, 3))
    want = {s: int(np.log2(n / ngram_join.FREQUENT) + 2) for s, n in count.items() if n >= ngram_join.FREQUENT}
    assert dict(zip(slots.tolist(), classes.tolist())) == want and max(want.values()) == 5
