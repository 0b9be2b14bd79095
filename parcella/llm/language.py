"""Language of a text: sparse multinomial logistic regression on character n-grams.

Features are the 1- to 3-grams of the lower-cased letters of the whole text, hashed into
2^14 buckets and weighted by TF-IDF. Document frequencies are counted over all labelled
documents of the training part, one small vector for each task. The weights are fitted by
follow-the-regularised-leader (proximal, per coordinate) with an elastic net on a bounded
sample: at most ``per_lang`` documents of each language, smallest hash first. A fifth of
the sample is held back to calibrate the temperature of the softmax.

Prediction needs only the text. Defined cases: a null text, one without letters, or a
model without labels gives ``und`` with score 0; of equally likely languages the first by
name is taken; texts are read whole, and a task holds no more than one at a time beside its
batch; repeated rows stay; an empty table gives an empty result; other columns, whatever
their names, never enter a prediction.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcella.sources.staging import staged

BITS = 14
#: Labelled documents of a language that the fit may see.
PER_LANG = 300
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"

# Odd multipliers of the n-gram hash.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def buckets(text: str) -> np.ndarray:
    """Bucket of every 1-, 2- and 3-gram of a text; empty if it has no letter."""
    letters = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
    if not any(c.isalpha() for c in letters):  # ends at the first letter
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = np.uint32(32 - BITS)
    grams, sums = [], np.zeros(len(codes), np.uint32)
    for k, m in enumerate(MULTIPLIERS):
        size = len(codes) - k
        sums = sums[:size] * np.uint32(31) + codes[k:] * np.uint32(m)
        mixed = sums ^ (sums >> np.uint32(15))
        grams.append((mixed * np.uint32(0x2C1B3C6D)) >> shift)
    return np.concatenate(grams)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets in use, their counts)."""
    counts = np.bincount(buckets(text), minlength=1 << BITS)
    used = np.flatnonzero(counts)
    return used, counts[used]


def weighted(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of unit length."""
    x = (1 + np.log(counts)) * idf[used]
    return x / np.sqrt((x * x).sum()) if len(x) else x


def document_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Documents that hold each bucket; the last place holds the number of documents.

    Each task sends one row for each bucket it has seen, so at most 2^14 sums come back.
    """

    def run(batches):
        import pyarrow as pa

        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for value in batch.column(0):
                used, _ = counted(value.as_py())
                total[used] += 1
                total[-1] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"]
        )

    out = np.zeros((1 << BITS) + 1, np.int64)
    sums = docs.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket")
    for row in sums.agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def sample_features(docs: DataFrame, text: str, lang: str, per_lang: int) -> list[tuple]:
    """(language, buckets, counts) of the sampled documents, in the order of their hash."""
    order = F.xxhash64(F.col(text))
    hashes = staged(docs.select(F.col(lang).alias("lang"), order.alias("h")).distinct(), "hashes")
    # cut at the bin of hashes that holds the last of the sample, so few rows meet to be ranked
    bins = hashes.groupBy("lang", F.shiftright("h", 48).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("bin")) - F.col("n")
    last = (
        bins.select("lang", "bin", before.alias("before"))
        .where(F.col("before") < per_lang)
        .groupBy("lang")
        .agg(F.max("bin").alias("last"))
    )
    ranked = (
        hashes.join(F.broadcast(last), "lang")  # one row a language
        .where(F.shiftright("h", 48) <= F.col("last"))
        .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
        .where(F.col("k") <= per_lang)
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            langs, hashes, used, counts = [], [], [], []
            for one, h, value in zip(*(c.to_pylist() for c in batch.columns)):
                u, n = counted(value)
                langs.append(one)
                hashes.append(h)
                used.append(u.astype(np.int16).tobytes())
                counts.append(n.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()), pa.array(hashes, pa.int64()),
                    pa.array(used, pa.binary()), pa.array(counts, pa.binary()),
                ],
                names=["lang", "h", "used", "counts"],
            )

    chosen = (
        docs.select(F.col(lang).alias("lang"), order.alias("h"), F.col(text).alias("text"))
        .join(F.broadcast(ranked.select("lang", "h")), ["lang", "h"], "left_semi")  # the sample
        .dropDuplicates(["lang", "h"])
    )
    rows = chosen.mapInArrow(run, "lang string, h long, used binary, counts binary").collect()
    return [
        (r["lang"], np.frombuffer(r["used"], np.int16).astype(np.int64), np.frombuffer(r["counts"], np.int32))
        for r in sorted(rows, key=lambda r: (r["h"], r["lang"]))
    ]


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", per_lang: int = PER_LANG
) -> dict:
    """Model of the labelled documents: languages, idf, weights, bias, temperature."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = document_frequencies(labelled, text)
    idf = np.log((1 + found[-1]) / (1 + found[:-1])) + 1
    examples = [x for x in sample_features(labelled, text, lang, per_lang) if len(x[1])]
    langs = sorted({x[0] for x in examples})
    data = [(langs.index(k), u, weighted(u, n, idf)) for k, u, n in examples]
    held = data[::5] if len(data) >= 10 * max(1, len(langs)) else data
    weights, bias = ftrl([x for i, x in enumerate(data) if i % 5] or data, len(langs))
    return {
        "langs": langs,
        "idf": idf,
        "weights": weights,
        "bias": bias,
        "temperature": temperature(held, weights, bias),
    }


def ftrl(data, n_langs: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights by FTRL-proximal with L1 and L2 penalties; the bias is not penalised."""
    size = 1 << BITS
    z, n = np.zeros((size + 1, n_langs)), np.zeros((size + 1, n_langs))

    def at(rows):
        w = -(z[rows] - np.sign(z[rows]) * L1) / ((BETA + np.sqrt(n[rows])) / ALPHA + L2)
        return np.where(np.abs(z[rows]) <= L1, 0.0, w)

    for _ in range(epochs):
        for label, used, x in data:
            rows = np.append(used, size)
            values = np.append(x, 1.0)
            w = at(rows)
            p = softmax(values @ w)
            p[label] -= 1
            g = values[:, None] * p[None, :]
            step = (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / ALPHA
            z[rows] += g - step * w
            n[rows] += g * g
    w = at(np.arange(size + 1))
    return w[:size], w[size]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def temperature(data, weights: np.ndarray, bias: np.ndarray) -> float:
    """Divisor of the logits with the least log loss on held-back examples."""
    if not data:
        return 1.0
    logits = np.array([x @ weights[u] + bias for _, u, x in data])
    labels = np.array([k for k, _, _ in data])

    def loss(t):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        return (np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]).mean()

    return float(min(np.geomspace(0.05, 5.0, 93), key=loss))


def predict(
    docs: DataFrame,
    model: dict,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    pack: bool = False,
) -> DataFrame:
    """The ``keep`` columns (or, packed, the whole row as ``row``), ``lang_pred``, ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            langs, scores = [], []
            for value in batch.column(0).field(place) if pack else batch.column(1):
                value = value.as_py()
                used, counts = counted(value) if value else ((), ())
                if len(used) and m["langs"]:
                    x = weighted(used, counts, m["idf"])
                    p = softmax((x @ m["weights"][used] + m["bias"]) / m["temperature"])
                    k = int(p.argmax())
                    langs.append(m["langs"][k])
                    scores.append(float(p[k]))
                else:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    first = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if pack else keep)))
    body = () if pack else (F.col(f"`{text}`").alias("text"),)  # packed rows hold their text
    place = docs.columns.index(text)
    chosen = docs.select(first.alias("row"), *body)
    kind = chosen.schema["row"].dataType.simpleString()
    out = chosen.mapInArrow(run, f"row {kind}, lang_pred string, score double")
    return out if pack else out.select(*(F.col("row")[c].alias(c) for c in keep), "lang_pred", "score")


def training(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents to learn from: those with an id that is not held out."""
    return docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))


def held_out(id_col):
    """The part that training never sees: a quarter of the ids, by CRC-32."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))
