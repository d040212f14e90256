"""Best targets of each query in buckets of equal keys, by agreement over all pairs of a bucket, without a row for each pair.

Keys are dealt to parts, and a bucket of more than CHUNK queries or targets to a grid of chunks. A chunk's common tokens are counted at once: those
that many pairs share by a product of matrices of 0 and 1, others by their lists of records. Only the best of each query and source leave a chunk.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, BLOCK, SLAB = 2048, 128, 256
#: Of chunks whose pairs all leave them.
WHOLE = 1024
SETS = ["name_tokens", "addr_tokens", "addr_numbers"]
WEIGHTS = [1.5, 2.0, 2.5]
FOUND = "q_id string, source string, t_id string, agreement double"


def give_back() -> None:
    """Memory that a worker no longer needs goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


class Common:
    """Numbers of common elements of one kind of set between the queries [s, m) and the targets [m, e) of a chunk."""

    def __init__(self, off: np.ndarray, val: np.ndarray, s: int, m: int, e: int):
        self.nq, self.nt = m - s, e - m
        v = val[off[s] : off[e]]
        size = np.diff(off[s : e + 1])
        self.q_size, self.t_size = size[: self.nq], size[self.nq :]
        row = np.repeat(np.arange(e - s, dtype=np.int32), size)
        cut = off[m] - off[s]
        if not cut or cut == len(v):
            self.rare = self.dense = None
            return
        u, code = np.unique(v, return_inverse=True)
        code = code.astype(np.int32)
        cq, ct = np.bincount(code[:cut], minlength=len(u)), np.bincount(code[cut:], minlength=len(u))
        both = (cq > 0) & (ct > 0)
        dense = both & (cq * ct > self.nq * self.nt / 500 + (self.nq + self.nt) / 20)
        rank = np.cumsum(dense) - 1
        keep = dense[code]
        self.width = int(dense.sum())
        self.dense = (row[keep], rank[code[keep]]) if self.width else None
        sparse = (both & ~dense)[code]
        self.rare = None
        if sparse.any():
            qs, ts = np.flatnonzero(sparse[:cut]), cut + np.flatnonzero(sparse[cut:])
            ts = ts[np.argsort(code[ts], kind="stable")]
            self.rare = row[qs], ct[code[qs]], np.searchsorted(code[ts], code[qs]), row[ts] - self.nq

    def of(self, a: int, b: int) -> np.ndarray:
        """Of the queries a to b and all targets."""
        out = np.zeros((b - a, self.nt), np.float32)
        if self.dense is not None:
            row, column = self.dense
            own, there = (row >= a) & (row < b), row >= self.nq
            for first in range(0, self.width, SLAB):
                w = min(SLAB, self.width - first)
                x, y = np.zeros((b - a, w), np.float32), np.zeros((self.nt, w), np.float32)
                here = (column >= first) & (column < first + w)
                x[row[own & here] - a, column[own & here] - first] = 1
                y[row[there & here] - self.nq, column[there & here] - first] = 1
                out += x @ y.T
        if self.rare is not None:
            row, n, begin, target = self.rare
            lo, hi = np.searchsorted(row, [a, b])
            cuts = lo + np.searchsorted(np.cumsum(n[lo:hi]), np.arange(1, int(n[lo:hi].sum()) // 1_000_000 + 1) * 1_000_000)
            for s, e in zip([lo, *cuts], [*cuts, hi]):
                rep = n[s:e]
                at = np.repeat(begin[s:e] - (np.cumsum(rep) - rep), rep) + np.arange(rep.sum())
                np.add.at(out.reshape(-1), np.repeat(row[s:e] - a, rep) * self.nt + target[at], np.float32(1))
        return out

    def jaccard(self, a: int, b: int) -> np.ndarray:
        common = self.of(a, b).astype(float)
        return common / np.maximum(self.q_size[a:b, None] + self.t_size - common, 1)


def best(limit: int | None):
    """(bucket, query, id, source, sets, postal) of one part -> FOUND, the best `limit` of each query and source in each chunk; None: a row for every pair of rows."""

    def run(keys, table):
        give_back()  # what earlier tasks left
        order = pc.sort_indices(table.select(["bucket", "query", "id"]), sort_keys=[("bucket", "ascending"), ("query", "descending"), ("id", "ascending")])
        table = table.take(order).combine_chunks()
        n = table.num_rows
        column = lambda c: table.column(c).combine_chunks()
        bucket, ids = (column(c).dictionary_encode().indices.to_numpy() for c in ("bucket", "id"))
        query = column("query").to_numpy(zero_copy_only=False)
        source, postal = column("source").dictionary_encode(), column("postal").fill_null("").dictionary_encode()
        empty = np.array([x == "" for x in postal.dictionary.to_pylist()], bool)
        names, source, postal = source.dictionary, source.indices.to_numpy(zero_copy_only=False), postal.indices.to_numpy(zero_copy_only=False)
        own_id = column("id")
        sets = [(np.concatenate([[0], np.cumsum(column(c).value_lengths().fill_null(0).to_numpy())]), column(c).flatten().to_numpy(zero_copy_only=False)) for c in SETS]
        del table, column  # the sets are read from here on
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(starts[1:], n)
        middles = starts + np.add.reduceat(query.astype(np.int64), starts) if n else starts
        out = []
        for s, m, e in zip(starts.tolist(), middles.tolist(), ends.tolist()):
            if s == m or m == e:
                continue
            parts = [Common(off, val, s, m, e) for off, val in sets]
            own, src = postal[m:e], source[m:e]
            heads = np.flatnonzero(np.diff(ids[m:e], prepend=-1)) if limit else np.arange(e - m)  # rows that repeat an id are one target
            for a in range(0, m - s, BLOCK):
                b = min(a + BLOCK, m - s)
                x = sum(w * p.jaccard(a, b) for w, p in zip(WEIGHTS, parts))
                mine = postal[s + a : s + b]
                x += np.where((mine[:, None] == own) & ~empty[mine][:, None], 2.0, 0.0)
                x = np.floor(x * 1e9 + 0.5)  # half up, as round() of a column
                if len(heads) < e - m:
                    x = np.maximum.reduceat(x, heads, axis=1)
                for k in np.unique(src[heads]):
                    at = np.flatnonzero(src[heads] == k)
                    y = x[:, at]
                    if limit and len(at) > limit:
                        order = y.astype(np.int64) * -16384 + np.arange(len(at))
                        pick = np.argpartition(order, limit - 1, axis=1)[:, :limit]
                    else:
                        pick = np.broadcast_to(np.arange(len(at)), y.shape)
                    score = np.take_along_axis(y, pick, axis=1).ravel() / 1e9
                    out.append((np.repeat(np.arange(s + a, s + b), pick.shape[1]), m + heads[at[pick.ravel()]], score))
        q, t, score = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        made = pa.table({"q_id": own_id.take(q), "source": names.take(pa.array(source[t])), "t_id": own_id.take(t), "agreement": score})
        give_back()
        return made

    return run


def best_in_buckets(left: DataFrame, right: DataFrame, limit: int | None, chunk: int | None = None) -> DataFrame:
    """FOUND over the rows of blocking.keyed(): of each query and source at least the best `limit`; None: of every pair of rows with equal keys."""
    chunk = chunk or (CHUNK if limit else WHOLE)
    parts = (4 if limit else 32) * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = lambda d, x, y: d.select("country", "key", F.lit(x).alias("x"), F.lit(y).alias("y"))
    sizes = one(left, 1, 0).unionByName(one(right, 0, 1)).groupBy("country", "key").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).filter((F.greatest("x", "y") > chunk) & (F.least("x", "y") > 0))
    sizes = sizes.select("country", "key", F.ceil(F.col("x") / chunk).cast("int").alias("nx"), F.ceil(F.col("y") / chunk).cast("int").alias("ny"))

    def dealt(d: DataFrame, p: str, own: str, other: str) -> DataFrame:
        d = d.filter("country is not null").join(F.broadcast(sizes), ["country", "key"], "left").fillna(1, ["nx", "ny"])
        place = F.pmod(F.xxhash64(f"{p}_id"), F.col(own)).cast("string")
        d = d.withColumn("there", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        there = F.col("there").cast("string")
        grid = (place, there) if p == "q" else (there, place)
        bucket = F.concat_ws("\x00", "country", *grid, "key")
        return d.select(F.pmod(F.xxhash64(bucket), F.lit(parts)).cast("int").alias("part"), bucket.alias("bucket"), F.lit(p == "q").alias("query"), F.col(f"{p}_id").alias("id"), F.lit("").alias("source") if p == "q" else F.col("source"),
                        *(F.col(f"{p}_{c}").alias(c) for c in SETS), F.col(f"{p}_addr_postal").alias("postal"))

    rows = dealt(left, "q", "nx", "ny").unionByName(dealt(right, "t", "ny", "nx"))
    return rows.groupBy("part").applyInArrow(best(limit), FOUND)
