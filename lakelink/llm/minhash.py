"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds its distinct shingles of `size` words. The sketch has WIDTH coordinates, filled in rounds: in each of the first
WIDTH rounds every shingle falls into a hashed coordinate with value round + fraction, in further rounds i it goes to coordinate
i - WIDTH, and the smallest value stays. All are filled after at most 2 WIDTH rounds, mostly after one or two, and
coordinates agree with probability equal to the Jaccard similarity, concentrated as if they were independent.

Bands of rows of the sketch are bucket keys; their size is the largest for which a pair at the threshold shares no key with
probability `miss` at most (a cheap test of four bits of each coordinate adds less than 1e-6). Documents with equal sets are one item. Candidates are verified on full sets of 64-bit shingle
hashes, and groups are the connected components of verified links (see groups.py).

Rows: null or empty text, or one without words, has an empty set and is linked with nothing; ties go to the smallest id;
rows that repeat an id count as one document of the smallest id for grouping and each come out; a null id is in no group and kept; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .groups import connect
from .scratch import drop, release, save
from .wordhash import mix, shingles, tidy, words

WIDTH = 128


def sketch(doc: np.ndarray, elements: np.ndarray, docs: int, width: int = WIDTH) -> np.ndarray:
    """docs x width sketches of the sets given as (doc, element), sorted by doc. Rows of empty sets are all ones."""
    out = np.full(docs * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(2 * width):
        h = mix(elements ^ mix(np.full(1, 2 * i + 1, np.uint64)))
        place = (h >> np.uint64(32)) % np.uint64(width) if i < width else np.uint64(i - width)
        value = (np.uint64(i) << np.uint64(56)) | (mix(h) >> np.uint64(8))
        np.minimum.at(out, doc * width + place.astype(np.int64) if i < width else doc * width + int(place), value)
        short = (out.reshape(docs, width) == np.uint64(0xFFFFFFFFFFFFFFFF)).any(1)
        if not short[doc].any():
            break
        keep = short[doc]
        doc, elements = doc[keep], elements[keep]
    return out.reshape(docs, width)


def bands(threshold: float, miss: float = 1e-6, width: int = WIDTH) -> tuple[int, int]:
    """(rows of a band, number of bands)."""
    return max(((r, width // r) for r in range(1, width + 1) if (1 - threshold**r) ** (width // r) <= miss), default=(1, width))


def features(docs: DataFrame, id_col: str, text_col: str, size: int, rows: int, count: int) -> DataFrame:
    """id, n (set size), s1, s2 (key of the set), keys (one for each band) and sig (four bits of each coordinate)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(1)):
                doc, sh = shingles(w, size)
                n = np.bincount(doc, minlength=w.docs)
                sums = np.zeros((w.docs, 2), np.uint64)
                at = np.flatnonzero(n)
                if len(at):
                    begin = (np.cumsum(n) - n)[at]
                    sums[at, 0] = np.add.reduceat(sh, begin)
                    sums[at, 1] = np.add.reduceat(mix(sh + np.uint64(77)), begin)
                whole = sketch(doc, sh, w.docs)
                bits = (mix(whole) & np.uint64(15)).reshape(w.docs, WIDTH // 16, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
                sig = np.bitwise_or.reduce(bits, axis=2)
                sk = whole[:, : rows * count].reshape(w.docs, count, rows)
                key = np.broadcast_to(mix(np.arange(1, count + 1, dtype=np.uint64)), (w.docs, count)).copy()
                for j in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sk[:, :, j])
                lists = pa.ListArray.from_arrays(np.arange(w.docs + 1, dtype=np.int32) * count, key.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, w.docs), pa.array(n.astype(np.int64)), pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].view(np.int64)), lists, pa.ListArray.from_arrays(np.arange(w.docs + 1, dtype=np.int32) * sig.shape[1], np.ascontiguousarray(sig).view(np.int64).ravel())], ["id", "n", "s1", "s2", "keys", "sig"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(tidy(run), "id long, n long, s1 long, s2 long, keys array<long>, sig array<long>")


def sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, text) -> (id, sh): the hashed shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(1)):
                doc, sh = shingles(w, size)
                off = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=w.docs))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, w.docs), pa.ListArray.from_arrays(off, sh.view(np.int64))], ["id", "sh"])

    return docs.mapInArrow(tidy(run), "id long, sh array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable over links with 100 * intersection >= percent * union) and kept."""
    rows, count = bands(percent / 100, miss)
    feats = save(features(docs, id_col, text_col, size, rows, count))
    reps = feats.filter("n > 0 and id is not null").groupBy("s1", "s2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
    reps = save(reps)
    keyed = reps.select("rep", "sig", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    # one document may stand for several sets if its id repeats, so items are numbered by the set's key
    buckets = save(keyed.join(shared, "key").select("key", F.col("rep").alias("id"), "sig"))
    release(docs.sparkSession)
    wanted = buckets.select("id").distinct()
    chosen = save(sets(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).join(wanted, "id", "left_semi"), size))
    release(docs.sparkSession)

    def linked(x: Column, y: Column) -> Column:
        # 100 i >= p u and u = na + nb - i give (100 + p) i >= p (na + nb)
        low, high = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))
        return (100 * low >= percent * high) & ((100 + percent) * F.size(F.array_intersect(x, y)) >= percent * (F.size(x) + F.size(y)))

    # equal coordinates: J + (1 - J) / 16 on average; five standard deviations below the threshold's rule a pair out
    j = percent / 100
    p = j + (1 - j) / 16
    least = int(WIDTH * p - 5 * (WIDTH * p * (1 - p)) ** 0.5)

    def near(x: Column, y: Column) -> Column:
        ones = F.lit(0x1111111111111111)
        differ = None
        for k in range(WIDTH // 16):
            v = F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))
            v = v.bitwiseOR(F.shiftrightunsigned(v, 2))
            v = v.bitwiseOR(F.shiftrightunsigned(v, 1)).bitwiseAND(ones)
            differ = F.bit_count(v) if differ is None else differ + F.bit_count(v)
        return differ <= WIDTH - least

    def fits(n: Column, most: Column, n2: Column, most2: Column) -> Column:
        return (100 * F.least(n, n2) >= percent * F.greatest(n, n2)) & ((100 + percent) * F.least(most, most2) >= percent * (n + n2))

    comp = connect(buckets, chosen.withColumnRenamed("sh", "x"), linked, near, fits=fits, percent=percent)
    drop(buckets, chosen)
    rep_of = reps.select("s1", "s2", "rep")
    if comp is not None:
        rep_of = rep_of.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("s1", "s2", F.coalesce("root", "rep").alias("root"))
    else:
        rep_of = rep_of.withColumnRenamed("rep", "root")
    out = feats.select("id", "n", "s1", "s2").join(rep_of, ["s1", "s2"], "left")
    root = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("root")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), root.alias("component_id"), F.coalesce(root == F.col("id"), F.lit(True)).alias("kept"))
