"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed left to right: each phrase is the shortest string at its place that is not yet in the dictionary, and
enters it (the last may be a repeat). The distinct phrases are hashed, and the fingerprint is `WIDTH` minimum-hash
coordinates of 16 bits each, as hex. The likeness of two fingerprints is the share of equal coordinates, an estimate of
the Jaccard similarity of the phrase sets. Equal texts have equal fingerprints.

Rows: a null text counts as empty; the likeness of two empty texts is 1, of an empty and another one 0. Order is
ascending id, nulls first, and for equal ids ascending text; the row after the last is the first. One row is its own next.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wordhash import BASE, mix, span_hash, tidy

WIDTH = 128
_MULTIPLY = (mix(np.arange(1, WIDTH + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
_ADD = (mix(np.arange(WIDTH + 1, 2 * WIDTH + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)[:, None]
#: Phrases that are hashed at once: bounds the memory of one step.
_STEP = 1024


def parse(text: str, known: dict[str, int]) -> list[int]:
    """Ends of the phrases of text; known gets each phrase with its number. A dictionary holds every prefix of its phrases, so the search for a phrase's end may start anywhere: at the length of the phrase before."""
    ends: list[int] = []
    n, s, guess = len(text), 0, 1
    while s < n:
        e = s + guess
        if text[s:e] in known:
            e += 1
            while text[s:e] in known and e <= n:
                e += 1
        else:
            e -= 1
            while e > s and text[s:e] not in known:
                e -= 1
            e += 1
        if e > n:
            ends.append(n)
            break
        known[text[s:e]] = len(ends)
        guess = e - s
        ends.append(e)
        s = e
    return ends


def parse_on(text: str, known: dict[str, int], upto: int) -> list[int]:
    """Ends of the phrases of text, after a parse of which only the first `upto` phrases count."""
    fresh: set[str] = set()

    def has(p: str) -> bool:
        return known.get(p, upto) < upto or p in fresh

    ends: list[int] = []
    n, s, guess = len(text), 0, 1
    while s < n:
        e = s + guess
        if has(text[s:e]):
            e += 1
            while e <= n and has(text[s:e]):
                e += 1
        else:
            e -= 1
            while e > s and not has(text[s:e]):
                e -= 1
            e += 1
        if e > n:
            ends.append(n)
            break
        fresh.add(text[s:e])
        guess = e - s
        ends.append(e)
        s = e
    return ends


def lowest(hashes: np.ndarray) -> np.ndarray:
    """Minimum of each of the WIDTH hash functions, of 32 bits."""
    low = np.full(WIDTH, np.uint32(0xFFFFFFFF))
    short = hashes.astype(np.uint32)
    for i in range(0, len(short), _STEP):
        v = _MULTIPLY * short[i : i + _STEP]
        v += _ADD
        np.minimum(low, v.min(1), out=low)
    return low


def digits(low: np.ndarray) -> np.ndarray:
    return (mix(low.astype(np.uint64)) >> np.uint64(48)).astype(">u2")


def units(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Parsed:
    """A text with its phrases and coordinates."""

    def __init__(self, text: str):
        self.text, self.known = text, {}
        self.ends = np.array(parse(text, self.known), np.int64)
        self.hashes = span_hash(units(text), np.concatenate([[0], self.ends[:-1]]).astype(np.int64), self.ends)
        self.own = digits(lowest(self.hashes))

    def edited(self, cut: int, edit: str) -> np.ndarray:
        """Coordinates of text[:cut] + edit. The phrases that end in the first `cut` characters are those of the text."""
        m = bisect_right(self.ends, cut)
        if m == len(self.ends) and m:  # the last phrase may be a repeat, and then goes on
            m -= 1
        tail = self.text[int(self.ends[m - 1]) if m else 0 : cut] + edit
        more = np.array(parse_on(tail, self.known, m), np.int64)
        h = span_hash(units(tail), np.concatenate([[0], more[:-1]]).astype(np.int64), more) if len(more) else np.zeros(0, np.uint64)
        return digits(np.minimum(lowest(self.hashes[:m]), lowest(h)))


def likeness(a: np.ndarray, b: np.ndarray, a_empty: bool, b_empty: bool) -> float:
    return float(a_empty and b_empty) if a_empty or b_empty else float((a == b).mean())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and `fingerprint` of each row."""
    field = docs.schema[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([Parsed(t or "").own.tobytes().hex() for t in b.column(1).to_pylist()])], [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), T.StructType([field, T.StructField("fingerprint", T.StringType())]))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rows_per_range: int = 4000, most_ranges: int = 4096) -> DataFrame:
    """Rows (range, order, text, borrowed), dealt by range and sorted: the text of each range, then the first text of the next.

    Ranges are cut at quantiles of the ids. Only the heads of the ranges, at most `most_ranges`, come to the driver as ids.
    """
    d = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(text_col, F.lit("")).alias("t"))
    total = d.select("i").count()
    n = int(min(most_ranges, max(1, -(-total // rows_per_range))))
    cuts = d.select(F.percentile_approx("i", [k / n for k in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    label = F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("i"))), F.lit(0)) if cuts else F.lit(0)
    d = d.withColumn("r", F.when(F.col("i").isNull(), 0).otherwise(label))
    heads = [(r.r, r.i, r.x) for r in d.groupBy("r").agg(F.min("i").alias("i"), F.max(F.col("i").isNull()).alias("x")).orderBy("r").collect()]
    ids = [i for _, i, _ in heads[1:]] + [i for _, i, x in heads[:1] if not x and i is not None]
    before = {i: heads[k - 1][0] for k, (_, i, _) in enumerate(heads)}
    lone = d.sparkSession.createDataFrame([(i, before[i]) for i in ids], "i long, p int")
    first = d.join(F.broadcast(lone), "i").groupBy("i", "p").agg(F.min("t").alias("t"))
    if heads and heads[0][2]:  # null ids come first: the next of the last row is the least text among them
        first = first.unionByName(d.filter("i is null").groupBy("i").agg(F.min("t").alias("t")).withColumn("p", F.lit(heads[-1][0])))
    borrowed = first.select(F.col("p").alias("r"), "i", "t", F.lit(True).alias("borrowed"))
    own = d.select("r", "i", "t", F.lit(False).alias("borrowed"))
    return own.unionByName(borrowed).repartition(max(n, 1), "r").sortWithinPartitions("r", "borrowed", F.col("i").asc_nulls_first(), "t")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text (the last quarter replaced by the beginning of the next text), and likenesses."""
    schema = f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def row(i, mine: Parsed, after: Parsed) -> tuple:
        t, following = mine.text, after.text
        q = len(t) // 4
        edit = following[:q]
        changed = mine.edited(len(t) - q, edit)
        whole = t[: len(t) - q] + edit
        return (i, len(t), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), mine.own.tobytes().hex(), changed.tobytes().hex(), likeness(mine.own, changed, not t, not whole), likeness(mine.own, after.own, not t, not following))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
        held = None  # (range, id, text): waits for the text after it
        for b in batches:
            out = []
            for r, i, t, borrowed in zip(*(c.to_pylist() for c in b.columns)):
                parsed = Parsed(t)
                if held and held[0] == r:
                    out.append(row(held[1], held[2], parsed))
                held = None if borrowed else (r, i, parsed)
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()])], names)

    return neighbours(docs, id_col, text_col).mapInArrow(tidy(run), schema)
