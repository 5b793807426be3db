"""Operator 7: language identification by nearest centroid.

A text's vector: counts of its lower-cased character n-grams (1 to 3 letters,
words padded with a space), hashed into DIMS buckets, dampened by a logarithm, times the buckets'
inverse document frequency, normalised.  Document frequencies come from every
document that may be learned from.  Each language's centroids are clusters
(spherical k-means) of a sample of its documents, one task a language; a text
gets the language of the centroid with the largest cosine.  A text is rejected
if its cosine is below that centroid's limit, which lies REJECT of the language's
spreads below the mean cosine of the cluster's own documents, and at most at their
FEWEST quantile (those of the language's, for a cluster of fewer than FEW).  A sample document's cosine is taken to the centroid without it, as
that of a text outside the sample is.

The sample has at most SAMPLE documents a language, chosen by a hash of doc_id.

NULL text and text without a letter are ``und`` with score 0 and rejected.  Rows
without lang or doc_id are predicted but not learned from; repeated rows count each time;
equal texts get equal answers, and of equal cosines the first centroid, by language, is taken.
Very long texts are counted in stretches.  Other columns are passed on as they are by
``accepted``; an empty table gives an empty table, and where there is nothing to learn
from, everything is ``und``.  More than LANGUAGES different values of lang are an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, small_batches

DIMS = 4096
#: Bound of the sample a language's centroids are fitted on.
SAMPLE = 600
#: Bound of the languages, each of which has CLUSTERS centroids of DIMS numbers in the model.
LANGUAGES = 4096
CLUSTERS, ROUNDS = 4, 8
#: Chosen on learnable rows outside the sample, and on those of a language that was left out of fitting.
REJECT, FEWEST, FEW = 4.0, 0.005, 10
#: Code points of a text handled at a time; counts of longer texts are added up.
STRETCH = 1_000_000


def counts(text: str):
    """Counts of a whole text's hashed n-grams."""
    import numpy as np

    out = np.zeros(DIMS, dtype=np.float32)
    for at in range(0, len(text), STRETCH):
        # two code points of overlap: n-grams that begin in the last stretch and end in this one
        some = text[max(0, at - 2) : at + STRETCH].lower()
        x = np.frombuffer(some.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters(x)
        x = np.where(letter, x, np.uint32(32))
        x = x[letter | np.concatenate([[True], letter[:-1]])]  # runs of other characters become one space
        a = x.astype(np.uint64)
        grams = []
        for n in (1, 2, 3):
            if len(a) < n:
                break
            h = a[: len(a) - n + 1].copy()
            for i in range(1, n):
                h = h * np.uint64(0x100000001B3) + a[i : len(a) - n + 1 + i]
            h = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            grams.append((h >> np.uint64(64 - 12)).astype(np.int64))
        if grams:
            out += np.bincount(np.concatenate(grams), minlength=DIMS).astype(np.float32)
    return out


def _letters(x):
    """Whether each code point is a letter."""
    import numpy as np

    global _TABLE
    if _TABLE is None:
        _TABLE = np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(0x3000)])
    out = _TABLE[np.minimum(x, 0x2FFF)]
    far = np.flatnonzero(x >= 0x3000)
    if len(far):
        out[far] = [chr(i).isalpha() for i in x[far].tolist()]
    return out


_TABLE = None


def vectors(texts, idf):
    """Normalised TF-IDF rows; a zero row for NULL and for texts without a letter."""
    import numpy as np

    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    for i, t in enumerate(texts):
        if t and any(map(str.isalpha, t)):
            v = np.log1p(counts(t)) * idf
            out[i] = v / max(float(np.sqrt(v @ v)), 1e-12)
    return out


def document_frequencies(docs: DataFrame) -> tuple[list[int], int]:
    """Documents that have each bucket, and all documents; each task sends one row of sums."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        df, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for t in batch.column("text").to_pylist():
                if t:
                    df += counts(t) > 0
                    n += 1
        yield pa.RecordBatch.from_pydict({"bucket": np.append(np.arange(DIMS), -1), "n": np.append(df, n)})

    sums = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = {r["bucket"]: r["n"] for r in sums.collect()}  # DIMS + 1 rows
    return [got.get(i, 0) for i in range(DIMS)], got.get(-1, 0)


def fit(learn: DataFrame) -> dict:
    """Centroids of ``learn`` (doc_id, text, lang)."""
    import numpy as np

    spark = learn.sparkSession
    df, n = document_frequencies(learn)
    idf = (np.log((1 + n) / (1 + np.array(df))) + 1).astype(np.float32)
    sizes = learn.groupBy("lang").count()
    if sizes.count() > LANGUAGES:
        raise ValueError(f"lang has more than {LANGUAGES} values; the model would not fit a driver")
    # the smallest hashes: a threshold that SAMPLE documents a language pass on average, then the bound itself
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 1).cast("double") / F.lit(2.0**63)
    # one row a language is broadcast (the model, which is collected, has more), so texts outside the sample are never shuffled
    some = learn.join(F.broadcast(sizes), "lang").filter(h * F.col("count") < SAMPLE).select("lang", "text", h.alias("h"))

    def cluster(key, table):
        import pyarrow as pa

        rows = sorted(zip(table.column("h").to_pylist(), table.column("text").to_pylist()))[:SAMPLE]
        x = vectors([t for _, t in rows], idf)
        x = x[(x != 0).any(axis=1)]
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "low": pa.array([], pa.float64()), "centroid": pa.array([], pa.binary())})
        c = x[:1]
        while len(c) < min(CLUSTERS, len(x)):  # the farthest document begins the next cluster
            c = np.vstack([c, x[np.argmin((x @ c.T).max(axis=1))]])
        for _ in range(ROUNDS):
            own = (x @ c.T).argmax(axis=1)
            c = np.vstack([x[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        cos = x @ c.T
        own = cos.argmax(axis=1)
        others = np.vstack([x[own == k].sum(axis=0) for k in range(len(c))])[own] - x
        norms = np.linalg.norm(others, axis=1)
        alone = np.bincount(own, minlength=len(c))[own] < 2
        cos[np.arange(len(x)), own] = np.where(alone, 0, (x * others).sum(axis=1) / np.maximum(norms, 1e-12))
        best = cos.max(axis=1)
        spread = max(float(best.std()), 0.01)
        mine = [best[own == k] if (own == k).sum() >= FEW else best for k in range(len(c))]
        low = [min(float(b.mean()) - REJECT * spread, float(np.quantile(b, FEWEST))) for b in mine]
        return pa.table({"lang": [key[0].as_py()] * len(c), "low": low, "centroid": [r.astype("<f4").tobytes() for r in c]})

    small_batches(spark)
    got = some.groupBy("lang").applyInArrow(cluster, "lang string, low double, centroid binary").collect()  # CLUSTERS rows a language
    got = sorted(got, key=lambda r: (r["lang"], r["centroid"]))
    c = np.vstack([np.frombuffer(r["centroid"], dtype="<f4") for r in got]) if got else np.zeros((0, DIMS), dtype=np.float32)
    return {"idf": idf, "centroids": c, "langs": [r["lang"] for r in got], "low": np.array([r["low"] for r in got])}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred, score and rejected, which take the place of columns of these names."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # langs x CLUSTERS x DIMS numbers, whatever the number of documents

    def run(batches):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            x = vectors(batch.column(batch.num_columns - 1).to_pylist(), m["idf"])
            known = (x != 0).any(axis=1)
            if len(m["langs"]):
                cos = x @ m["centroids"].T
                best = cos.argmax(axis=1)
                score = np.where(known, np.clip(cos[np.arange(len(x)), best].astype(np.float64), 0, 1), 0.0)
                lang = [m["langs"][b] if k else "und" for b, k in zip(best, known)]
                rejected = ~known | (score < m["low"][best])
            else:
                score, lang, rejected = np.zeros(len(x)), ["und"] * len(x), np.ones(len(x), dtype=bool)
            keep = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "rejected")])
    name = max(("text", *docs.columns), key=len) + "_"  # longer than any other, so not taken
    given = docs.select(*[F.col(f"`{c}`") for c in kept.columns], F.col("text").cast("string").alias(name))
    from pyspark.sql import types as T

    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return given.mapInArrow(run, schema)


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def learnable(docs: DataFrame) -> DataFrame:
    """The rows whose text and lang may be learned from."""
    return docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the learnable rows, predict every row; see ``predict``."""
    return predict(docs, fit(learnable(docs)))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns as they are."""
    found = predict(as_row(docs, F.col("text").cast("string").alias("text")), fit(learnable(docs)))
    return found.filter("not rejected").select("row.*")
