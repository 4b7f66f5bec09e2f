"""Importance resampling: the ratio of two hashed n-gram models weighs each document, Gumbel top-k samples by weight.

Words (lower-cased A-Z) and pairs of neighbouring words are hashed into buckets, whose number grows with the root of the
corpus, as the number of its different words does (`buckets_for`). The raw model counts the buckets over all documents,
the target model over a bounded sample of documents labelled as good. A document's log
weight is the sum of ``log target - log raw`` over its n-grams. Adding independent Gumbel noise and taking the k
largest samples k documents without replacement in proportion to their weights.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.llm.textbatch import mix, sliced, text_buffers, word_hashes

LEAST_BUCKETS, BUCKETS_PER_ROOT = 10_000, 2  # buckets at least, and for each unit of the square root of the corpus in bytes
SAMPLE = 20_000  # labelled documents at most that the target model is fitted on
BINS = 4096


def buckets_for(corpus_bytes: int) -> int:
    """The power of two that holds the buckets of a corpus: 2**16 for half a GB, 2**25 (256 MB of ratios) for 100 TB."""
    wanted = max(LEAST_BUCKETS, BUCKETS_PER_ROOT * int(corpus_bytes**0.5))
    return 1 << (wanted - 1).bit_length()


def ngram_buckets(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of all texts, and the text of each."""
    words, firsts = word_hashes(*text_buffers(column))
    text = np.repeat(np.arange(len(column)), np.diff(firsts))
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    same = text[:-1] == text[1:]
    found = np.concatenate([words, pairs[same]]) % np.uint64(buckets)
    return found.astype(np.int64), np.concatenate([text, text[1:][same]])


def _counts(buckets: int):
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in sliced(batches, "text"):
            found, _ = ngram_buckets(batch.column(0), buckets)
            if buckets <= 4 * len(found):
                total += np.bincount(found, minlength=buckets)
            else:
                at, n = np.unique(found, return_counts=True)
                total[at] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def ngram_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many n-grams of ``texts (text)`` fall into each bucket; each task adds up its own."""
    parts = texts.select("text").mapInArrow(_counts(buckets), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.float64)
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # ``buckets`` rows at most
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def _weights(ratio: np.ndarray):
    def run(batches):
        for batch in sliced(batches, "text"):
            found, text = ngram_buckets(batch.column(1), len(ratio))
            weight = np.bincount(text, weights=ratio[found], minlength=batch.num_rows).astype(np.float64)
            n = np.bincount(text, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n), pa.array(weight)], names=["doc_id", "noise", "n_ngrams", "log_weight"]
            )

    return run


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The exact ``k``-th largest value, by counts in ever narrower bins; None without rows or for ``k`` below 1."""
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k < 1:
        return None
    k = min(k, n)
    while low < high:
        width = (high - low) / BINS
        bin_of = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        inside = values.filter((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))
        bins = inside.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):  # BINS rows at most
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
        if width <= 0:
            break
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    fraction: float | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int | None = None,
    sample: int = SAMPLE,
    seed: int = 11,
) -> DataFrame:
    """``(doc_id, n_ngrams, log_weight, gumbel_key, kept)`` for every row of ``docs``.

    ``kept`` marks the ``fraction`` of rows with the largest keys; without it, the share of good ones among the labels
    (all without labels). Rows whose key equals the last kept one are kept too, so repeated rows share their fate.
    The noise of a row is a function of its id, its text and ``seed``. Null and empty texts weigh 0. Labels with a null
    id or value are ignored; ids with several labels are good if any is. Other columns are not read. ``buckets`` are
    those of `buckets_for` unless given.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    buckets = buckets or buckets_for(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    good = known.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).orderBy(F.xxhash64("doc_id")).limit(sample)
    good = docs.sparkSession.createDataFrame([(r.doc_id,) for r in good.collect()], "doc_id long")  # bounded by ``sample``
    target = ngram_counts(texts.join(F.broadcast(good), "doc_id", "left_semi"), buckets)
    raw = ngram_counts(texts, buckets)
    log = lambda counts: np.log((counts + 1.0) / (counts.sum() + buckets))
    ratio = log(target) - log(raw) if target.sum() else np.zeros(buckets)

    uniform = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    noisy = texts.select("doc_id", "text", (-F.log(-F.log(uniform))).alias("noise"))
    scored = noisy.mapInArrow(_weights(ratio), "doc_id long, noise double, n_ngrams long, log_weight double")
    scored = written(scored.select("doc_id", "n_ngrams", "log_weight", (F.col("log_weight") + F.col("noise")).alias("gumbel_key")), "weights")
    if fraction is None:
        fraction = known.agg(F.avg("quality")).first()[0]
        fraction = 1.0 if fraction is None else fraction
    least = kth_largest(scored, "gumbel_key", round(fraction * scored.count()))
    kept = F.lit(False) if least is None else F.col("gumbel_key") >= F.lit(least)
    return scored.withColumn("kept", kept)
