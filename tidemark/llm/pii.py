"""Operator 10: personal data by rules and a semi-Markov conditional random field.

Rules find the base spans (email, ip, card, phone).  The random field then
scores whole candidate segments of the text around digits and at signs, by
features of the segment as a whole (digits, separators, check digit, octets,
domain, what it touches), and dynamic programming over segments of bounded
length picks boundaries and kinds jointly.  Its spans are added where they
overlap no base span and beat the reading without them by MARGIN.

The field is trained by conditional likelihood on zones of a hashed sample of
documents (at most ZONES zones of at most ZONE_CHARS code points), labelled with the
base spans; numbers that only look like data are its negatives.  So that it doesn't
just learn the rules again, what they rest on is held back in variants of the zones
(``variants``): phones without their plus sign or with other separators, cards with
a mistyped digit, octets with another separator, addresses without a dotted domain; and
dates, versions, counts and file numbers made of the same digits, which are no data.

NULL and empty texts have no span; a text, however long, is scanned whole, in time
linear in its length; of equally good readings the one with fewer segments is taken;
other columns are ignored; repeated rows are each in the result, alike;
an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"
#: Code points kept on each side of a digit or at sign; tokens a segment may have; bound of the training sample.
AROUND, LONGEST, ZONES, ZONE_CHARS, STEPS = 24, 16, 300, 400, 40
#: Log-odds a span of the field needs over the best reading without it; chosen on zones outside the sample.
MARGIN = 2.0

_TRIGGER = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never begins inside a run of digits: an earlier start in the run would match as well.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_OCTETS = re.compile(r"[0-9]{1,3}([.-])[0-9]{1,3}\1[0-9]{1,3}\1[0-9]{1,3}")
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-.][01][0-9][-.][0-3][0-9]|[0-3][0-9][-.][01][0-9][-.](?:19|20)[0-9]{2}")
_NUMBER = re.compile(r"[0-9]+\.[0-9]+")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The rules' spans, by start, then kind."""
    if not _TRIGGER.search(text):
        return []
    out = []
    at, free = text.find("@"), 0
    while at >= 0:  # from each at sign outwards, as a search from the left would be quadratic in long words
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group()) if m.end() - m.start() <= 40 else ""
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and at signs that may hold data: an at sign, or seven digits."""
    out, lo, hi, n, mark = [], -1, -1, 0, False
    for m in _TRIGGER.finditer(text):
        if lo >= 0 and m.start() - hi > AROUND:
            if mark or n >= 7:
                out.append((max(0, lo - AROUND), min(len(text), hi + AROUND)))
            lo, n, mark = -1, 0, False
        if lo < 0:
            lo = m.start()
        hi = m.end()
        n, mark = n + 1, mark or m.group() == "@"
    if lo >= 0 and (mark or n >= 7):
        out.append((max(0, lo - AROUND), min(len(text), hi + AROUND)))
    return out


def features(before: str, s: str, after: str) -> list[int]:
    """Numbers of the whole-span features that hold."""
    digits, parts = _digits(s), s.split(".")
    letters = sum(c.isalpha() for c in s)
    local, at, domain = s.partition("@")
    octets = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    runs = [len(x) for x in re.findall("[0-9]+", s)]
    n = len(digits)
    held = [
        True, bool(at), s.count("@") > 1, bool(at) and bool(_DOMAIN.fullmatch(domain)), bool(at) and bool(local) and all(c in _LOCAL for c in local),
        n == 0, 1 <= n < 7, 7 <= n < 9, 9 <= n < 12, 12 <= n < 16, 16 <= n < 20, n >= 20, letters > 0, 12 <= n <= 19 and luhn(digits), octets,
        s[0] == "+", "(" in s, s.count("(") != s.count(")"), "-" in s, " " in s, "  " in s, s.isdigit(), s.count(".") == 1, s.count(".") == 2, s.count(".") == 3, s.count(".") > 3,
        max(runs, default=0) > 4, len(runs) == 1, len(runs) in (3, 4), len(runs) > 5,
        before.isalnum() or before in ("@", "+", "_"), after.isalnum() or after in ("@", "_"), after == "." , before in (".", "-", "("), after in ("-", ")"),
        len(runs) >= 3 and runs[:-1] == [4] * (len(runs) - 1), runs[-2:] == [3, 4], runs[-1:] == [4], bool(_OCTETS.fullmatch(s)) and all(int(x) <= 255 for x in re.findall("[0-9]+", s)),
        bool(_DATE.match(s)), digits[:2] == "00", digits[:1] == "0", len(set(s) & set(" .-")) > 1, bool(_NUMBER.fullmatch(s)), max(runs, default=0) > 6, before in ("#", "/", "$", "=", ":", "v", "€") or after in ("/", "%", ":", ","),
        s[-1].isdigit(), s[-1].isalpha(), s[0].isdigit(), s[0].isalpha(), bool(at) and len(domain.rpartition(".")[2]) >= 2 and domain.rpartition(".")[2].isalpha(),
    ]
    return [i for i, x in enumerate(held) if x]


N_FEATURES = 51


def segments(text: str, lo: int, hi: int):
    """Tokens' ends in a zone, and its candidate segments (first token, token after the last, features)."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, lo, hi)]
    found = []
    for i, (a, _) in enumerate(tokens):
        c = text[a]
        if not (c.isalnum() and c.isascii() or c in "+("):
            continue
        n, mark = 0, False
        for j in range(i, min(len(tokens), i + LONGEST)):
            x, y = tokens[j]
            t = text[x]
            if t == "\n" or not (t.isascii() and t.isalnum() or t in "@._%+-() "):
                break
            if t == "@":
                mark = True
            if t.isdigit():
                n += y - x
            if not (t.isalnum() or t == ")") or not (mark or n >= 7):
                continue
            s = text[a:y]
            if mark and " " in s or not mark and any(ch.isalpha() for ch in s):
                break
            found.append((i, j + 1, features(text[a - 1 : a], s, text[y : y + 1])))
    return tokens, found


def _log_sum(values):
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def train(examples) -> list[list[float]]:
    """Weights by kind and feature.  ``examples``: (number of tokens, segments, kind of each or None)."""
    import numpy as np

    w, seen = np.zeros((len(KINDS), N_FEATURES)), np.full((len(KINDS), N_FEATURES), 1e-6)
    w[:, 0] = -1.0
    for _ in range(STEPS):
        gradient = -0.01 * w
        for n, found, gold in examples:
            score = np.array([[w[k, f].sum() for k in range(len(KINDS))] for _, _, f in found])
            by_end, by_start = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
            for s, (i, j, _) in enumerate(found):
                by_end[j].append(s)
                by_start[i].append(s)
            total = np.logaddexp.reduce(score, axis=1) if len(found) else []
            forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):  # one token outside, or a segment that ends here
                forward[j] = _log_sum([forward[j - 1], *(forward[found[s][0]] + total[s] for s in by_end[j])])
            for i in range(n - 1, -1, -1):
                backward[i] = _log_sum([backward[i + 1], *(backward[found[s][1]] + total[s] for s in by_start[i])])
            for s, (i, j, f) in enumerate(found):
                expected = np.exp(forward[i] + score[s] + backward[j] - forward[n])
                if gold[s] is not None:
                    expected[gold[s]] -= 1.0
                gradient[:, f] -= expected[:, None]
        seen += gradient**2
        w += 0.8 * gradient / np.sqrt(seen)
    return w.tolist()


def variants(kind: str, s: str) -> list[tuple[str | None, str]]:
    """Forms of a base span that the rules miss, each with its kind; with None, texts of the same digits that are no data."""
    d = _digits(s)
    if kind == "phone":
        runs = re.findall("[0-9]+", s)
        rest, cc = (runs[1:], runs[0]) if len(runs) > 2 and len(runs[0]) <= 3 else ([d[-10:-7], d[-7:-4], d[-4:]], d[:-10] or "1")
        return [
            ("phone", s[1:]), ("phone", "00" + s[1:]), ("phone", "-".join(rest)), ("phone", ".".join([cc, *rest])), ("phone", f"({rest[0]}) " + "-".join(rest[1:])), ("phone", " ".join(["0" + rest[0], *rest[1:]])),
            (None, f"20{d[:2]}-0{int(d[2]) % 9 + 1}-1{d[3]} {d[4:6]}"), (None, f"{d[:3]}.{d[3:9]}"), (None, d), (None, f"{d[:5]}-{d[5:10]}-{d[10:]}x"),
        ]
    if kind == "card":
        wrong = d[:-1] + str((int(d[-1]) + 3) % 10)
        four = lambda x: [x[i : i + 4] for i in range(0, len(x), 4)]
        return [
            ("card", " ".join(four(wrong))), ("card", "-".join(four(wrong))), ("card", ".".join(four(d))), ("card", " ".join(four(d[:5] + d[6:7] + d[5:6] + d[7:]))),
            (None, wrong), (None, f"{d[:6]}.{d[6:]}"), (None, f"20{d[:2]}-12-0{int(d[2]) % 9 + 1} {d[3:5]}"), (None, f"978-{d[0]}-{d[1:3]}-{d[3:9]}-{d[9]}"),
        ]
    if kind == "ip":
        octets = s.split(".")
        large = f"{octets[0]}.{octets[1]}.{octets[2]}.{300 + int(octets[3]) % 600}"
        return [("ip", "-".join(octets)), (None, large), (None, ".".join([*octets, "7"])), (None, f"{octets[0]}.{octets[1]}-{octets[2]}{octets[3]}")]
    local, _, domain = s.partition("@")
    host = domain.split(".")[0]
    return [("email", f"{local}@{host}"), (None, f"@{host}"), (None, f"{local} @ {host}")]


def examples_of(zone: str) -> list[tuple[int, list, list]]:
    """A zone's training examples: as it is, and for each variant of each of its base spans one with that put in."""
    base, out = base_spans(zone), []

    def add(text, gold):
        tokens, found = segments(text, 0, len(text))
        if found:
            out.append((len(tokens), found, [gold.get((tokens[i][0], tokens[j - 1][1])) for i, j, _ in found]))

    add(zone, {(a, b): KINDS.index(k) for k, a, b in base})
    for kind, a, b in base:
        if any((x, y) != (a, b) and x < b and a < y for _, x, y in base):
            continue  # spans of two kinds overlap here
        for new, put in variants(kind, zone[a:b]):
            moved = len(put) - (b - a)
            gold = {(x + moved * (x >= b), y + moved * (x >= b)): KINDS.index(k) for k, x, y in base if (x, y) != (a, b)}
            if new:
                gold[a, a + len(put)] = KINDS.index(new)
            add(zone[:a] + put + zone[b:], gold)
    return out


def decode(text: str, weights) -> list[tuple[str, int, int, float]]:
    """The most likely segments of every zone, with their margins over the reading without them."""
    out = []
    for lo, hi in zones(text):
        tokens, found = segments(text, lo, hi)
        if not found:
            continue
        by_end: dict[int, list] = {}
        for i, j, f in found:
            score, kind = max((sum(w[x] for x in f), k) for k, w in zip(KINDS, weights))
            by_end.setdefault(j, []).append((score, i, kind))
        best, back = [0.0], [None]
        for j in range(1, len(tokens) + 1):
            top, how = best[j - 1], None
            for score, i, kind in by_end.get(j, ()):
                if best[i] + score > top:
                    top, how = best[i] + score, (score, i, kind)
            best.append(top)
            back.append(how)
        j = len(tokens)
        while j:
            if how := back[j]:
                out.append((how[2], tokens[how[1]][0], tokens[j - 1][1], how[0]))
                j = how[1]
            else:
                j -= 1
    return out


def fit(docs: DataFrame) -> list[list[float]]:
    """Train on at most ZONES zones of documents chosen by a hash of doc_id."""
    spark = docs.sparkSession
    small_batches(spark)
    some = docs.select("doc_id", "text").filter(F.col("text").rlike("@|[0-9].{0,6}[0-9]"))
    n = some.count()
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 1).cast("double") / F.lit(2.0**63)

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [
                (x, text[lo:hi])
                for x, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist())
                for lo, hi in zones(text)[:ZONES]
                if hi - lo <= ZONE_CHARS
            ]
            yield pa.RecordBatch.from_pydict({"h": pa.array([r[0] for r in rows], pa.float64()), "zone": pa.array([r[1] for r in rows], pa.string())})

    near = some.select(h.alias("h"), "text").filter(F.col("h") * max(n, 1) < 4 * ZONES)
    got = near.mapInArrow(cut, "h double, zone string").orderBy("h", "zone").limit(ZONES).collect()
    return train([e for r in got for e in examples_of(r["zone"])])


def find_spans(docs: DataFrame, weights: list[list[float]] | None = None) -> DataFrame:
    """doc_id and spans (kind, start, end, base, score) of every row, by start, then kind."""
    small_batches(docs.sparkSession)
    weights = weights if weights is not None else fit(docs)

    def spans(text):
        base = base_spans(text)
        if not _TRIGGER.search(text):
            return []
        out = [{"kind": k, "start": a, "end": b, "base": True, "score": None} for k, a, b in base]
        ends = sorted((a, b) for _, a, b in base)
        import bisect

        reach, top = [], 0  # how far the spans up to each go
        for _, b in ends:
            top = max(top, b)
            reach.append(top)
        for kind, a, b, score in decode(text, weights):
            i = bisect.bisect_left(ends, (b, -1))
            if score >= MARGIN and not (i and reach[i - 1] > a):
                out.append({"kind": kind, "start": a, "end": b, "base": False, "score": score})
        return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"]), s["end"]))

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))
        for batch in batches:
            found = [spans(t) if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SPANS)
