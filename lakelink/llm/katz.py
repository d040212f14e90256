"""Katz backoff bigram model over whole texts, with counts in partitioned tables.

Tokens of a text: its words, then one end. P(w | v) is d_r r / (c(v) + DELTA) for a pair seen r times, with Good-Turing discounts d_r
for r <= K, and alpha(v) P1(w) otherwise; P1 is discounted the same way over the V known tokens and one unknown token, and alpha
makes every row sum to 1 exactly: alpha(v) = left(v) / (1 - sum of P1 over v's followers), where left(v) is the discounted mass and
DELTA / (c(v) + DELTA), which keeps it positive where nothing is discounted. An unknown v backs off at no cost.

Counting and scoring share one pass over the corpus. Texts are read in chunks; each chunk sends its pairs to the buckets of their second
word as sorted arrays (distinct pairs, then the local numbers of their texts), so a bucket knows all counts of its words. Words that hold
a 1 / HOT share of the tokens (there are at most HOT of them, counted before) go by the pair's hash, so none fills a bucket.
Buckets add up, for each text, what does not depend on the pairs' discounts, and how many of its pairs occur 1 to K times.
Backed-off pairs ask the buckets of their first word for alpha. Nothing but counts of counts and hot words comes to the driver.

Rows: a null text is empty and has the end only; repeated rows are scored alike; null ids are kept; an empty table gives an empty result, and
without training rows every token is unknown. The plan that makes docs must give rows in the same order when a task is repeated, as scans do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import drop, release, save
from .wordhash import mix, tidy, tidy_group, words

K = 5
DELTA = 0.1
HOT = 2048
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_U64 = np.uint64


def discounts(n: np.ndarray) -> np.ndarray:
    """d[0..K] from counts of counts n[0..K+1]; (r - 0.5) / r where Good-Turing gives no discount in (0, 1]."""
    d = np.ones(K + 1)
    top = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        gt = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        x = (gt - top) / (1 - top) if top < 1 else 0.0
        d[r] = x if 0 < x <= 1 else (r - 0.5) / r
    return d


def left_over(n: np.ndarray, d: np.ndarray) -> float:
    r = np.arange(1, K + 1)
    return float((n[1 : K + 1] * r * (1 - d[1:])).sum()) + DELTA


class Unigrams:
    """P1 and the base model from N, V, counts of counts and the counts of hot words."""

    def __init__(self, total: int, kinds: int, n: np.ndarray, hot: dict[int, int]):
        self.total, self.kinds = total, kinds
        self.d = discounts(n)
        self.unknown = left_over(n, self.d) / (total + DELTA)
        keys = sorted(hot)
        self.hot = np.array(keys, _U64)
        self.hot_count = np.array([hot[k] for k in keys], np.int64)

    def p1(self, c: np.ndarray) -> np.ndarray:
        seen = np.where(c <= K, self.d[np.minimum(c, K)], 1.0) * c / (self.total + DELTA)
        return np.where(c > 0, seen, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.kinds + 1)))


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, held out, text of each token, token) of runs of texts with about `most` bytes; an end after each text."""
    for batch in batches:
        held = np.array(batch.column(2).to_pylist(), bool)
        parts, begin, size = [], 0, 0
        # words are hashed in small slices: the steps by bytes take far more memory than the tokens they leave
        for w in words(batch.column(1), min(most, 1 << 20)):
            last = np.cumsum(np.bincount(w.doc, minlength=w.docs))
            parts.append((np.insert(w.doc, last, np.arange(w.docs)) + (w.first - begin), np.insert(w.hash, last, END)))
            size += len(w.units)
            end = w.first + w.docs
            if size >= most or end == batch.num_rows:
                doc, token = (np.concatenate(x) for x in zip(*parts))
                yield batch.column(0).slice(begin, end - begin), held[begin:end], doc, token
                parts, begin, size = [], end, 0


def place(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> _U64(16)) % _U64(n)).astype(np.int64)


def pair_order(part: np.ndarray, cur: np.ndarray, prev: np.ndarray, parts: int) -> np.ndarray:
    """Sort keys: all bits that a part's number needs, then as many of both words as fit."""
    rest = 64 - parts.bit_length()
    own = rest // 2
    return (part.astype(_U64) << _U64(rest)) | (cur >> _U64(64 - (rest - own)) << _U64(own)) | (prev >> _U64(64 - own))


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new)


def planes(x: np.ndarray) -> bytes:
    """Bytes of one significance together: sorted keys and small counts then compress."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def unplanes(data: memoryview, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size).reshape(size, n).T).view(kind).ravel()


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a) for a in arrays)], np.int64).tobytes()
    return head + b"".join(planes(a) for a in arrays)


def unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    view = memoryview(data)
    sizes = np.frombuffer(view[8 : 8 + 8 * len(kinds)], np.int64).tolist()
    at, out = 8 + 8 * len(kinds), []
    for kind, n in zip(kinds, sizes):
        out.append(unplanes(view[at:], kind, n))
        at += n * np.dtype(kind).itemsize
    return out


_ROW = "part long, kind string, chunk long, data binary"


def _rows(rows: list[tuple[int, str, int, bytes]]) -> pa.RecordBatch:
    a = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(a[0], pa.int64()), pa.array(a[1], pa.string()), pa.array(a[2], pa.int64()), pa.array(a[3], pa.binary())], ["part", "kind", "chunk", "data"])


def _by_part(part: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """Ranges of equal, sorted part numbers."""
    edges = np.searchsorted(part, np.arange(n + 1))
    for k in np.flatnonzero(np.diff(edges)):
        yield int(k), slice(int(edges[k]), int(edges[k + 1]))


def count_words(parts: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, doc, token in chunks(batches, most):
            keys, n = np.unique(token[~held[doc]], return_counts=True)
            part = place(keys, parts)
            order = np.argsort(part, kind="stable")
            keys, n, part = keys[order], n[order].astype(np.uint32), part[order]
            yield _rows([(k, "word", 0, pack(keys[s], n[s])) for k, s in _by_part(part, parts)])

    return run


def total_words(keys, table):
    got = [unpack(x, _U64, np.uint32) for x in table.column("data").to_pylist()]
    word, back = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
    c = np.bincount(back, weights=np.concatenate([g[1] for g in got])).astype(np.int64)
    big = c >= c.sum() / HOT
    return pa.table({
        "total": [int(c.sum())], "kinds": [len(c)], "n": [[int((c == r).sum()) for r in range(K + 2)]],
        "hot": [[{"w": int(w), "c": int(x)} for w, x in zip(word[big].view(np.int64), c[big])]],
    }, schema=pa.schema([("total", pa.int64()), ("kinds", pa.int64()), ("n", pa.list_(pa.int64())), ("hot", pa.list_(pa.struct([("w", pa.int64()), ("c", pa.int64())])))]))


def send_pairs(parts: int, most: int, uni):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = uni.value.hot
        task, number = TaskContext.get().partitionId(), 0
        for ids, held, doc, cur in chunks(batches, most):
            chunk = (task << 24) | number
            number += 1
            first = np.concatenate([[True], doc[1:] != doc[:-1]])
            prev = np.where(first, START, np.roll(cur, 1))
            at = np.searchsorted(hot, cur)
            at[at == len(hot)] = 0
            is_hot = hot[at] == cur if len(hot) else np.zeros(len(cur), bool)
            part = place(np.where(is_hot, mix(prev * _U64(3) + cur), cur), parts)
            order = np.argsort(pair_order(part, cur, prev, parts))
            part, cur, prev, doc = part[order], cur[order], prev[order], doc[order]
            new = np.ones(len(cur), bool)
            new[1:] = (cur[1:] != cur[:-1]) | (prev[1:] != prev[:-1]) | (part[1:] != part[:-1])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(cur)))
            entry_part = part[at]
            tag = (doc.astype(np.uint32) << np.uint32(1)) | held[doc].astype(np.uint32)
            wide = np.uint32 if len(held) > 32767 else np.uint16
            out = []
            where = dict(_by_part(part, parts))
            for k, s in _by_part(entry_part, parts):
                c, p, n = cur[at[s]], prev[at[s]], count[s].astype(np.uint32)
                b = runs(c)
                out.append((k, "pair", chunk, pack(c[b], np.diff(np.append(b, len(c))).astype(np.uint32), p, n, tag[where[k]].astype(wide), np.array([wide == np.uint32], np.uint8))))
            size = np.bincount(doc, minlength=len(held)).astype(np.uint32)
            valid = np.array(ids.is_valid().to_pylist(), np.uint8)
            out.append((parts + chunk % parts, "text", chunk, pack(np.array(ids.fill_null(0).to_pylist(), np.int64), valid, held.astype(np.uint8), size)))
            yield _rows(out)

    return run


def read_pairs(data: bytes) -> list[np.ndarray]:
    wide = data[-1]
    return unpack(data, _U64, np.uint32, _U64, np.uint32, np.uint32 if wide else np.uint16, np.uint8)[:5]


def score_pairs(parts: int, uni):
    """Of one bucket: sums for each text, what contexts have here, questions to contexts, counts of counts."""

    def run(keys, table):
        kinds = table.column("kind").to_pylist()
        if kinds[0] == "text":
            return table
        u = uni.value
        chunk_ids, blobs = table.column("chunk").to_pylist(), table.column("data").to_pylist()
        order = sorted(range(len(blobs)), key=lambda i: chunk_ids[i])
        got = [read_pairs(blobs[i]) for i in order]
        del blobs
        sizes = [(len(g[3]), len(g[4])) for g in got]
        cur = np.concatenate([np.repeat(g[0], g[1]) for g in got])
        prev = np.concatenate([g[2] for g in got])
        count = np.concatenate([g[3] for g in got]).astype(np.int32)
        tags = np.concatenate([g[4].astype(np.uint32) for g in got])
        del got
        trained = np.add.reduceat((~tags & 1).astype(np.int32), np.cumsum(count) - count)
        # equal pairs of several chunks
        sort = np.lexsort((prev, cur)).astype(np.int32)
        cs, ps = cur[sort], prev[sort]
        del cur, prev
        new = np.ones(len(cs), bool)
        new[1:] = (cs[1:] != cs[:-1]) | (ps[1:] != ps[:-1])
        pair = np.empty(len(cs), np.int32)
        pair[sort] = np.cumsum(new, dtype=np.int32) - 1
        at = np.flatnonzero(new)
        r_pair = np.add.reduceat(trained[sort], at).astype(np.int64)
        pair_cur, pair_prev = cs[at], ps[at]
        b = runs(pair_cur)
        c_word = np.add.reduceat(r_pair, b)
        word = pair_cur[b]
        if len(u.hot):
            i = np.searchsorted(u.hot, word)
            i[i == len(u.hot)] = 0
            c_word = np.where(u.hot[i] == word, u.hot_count[i], c_word)
        c_pair = np.repeat(c_word, np.diff(np.append(b, len(pair_cur))))
        del cs, ps, sort, new, trained
        p1 = u.p1(c_pair)
        # of each pair: base, fixed part of the score
        base = u.base(c_pair)
        fixed = np.where(r_pair > K, np.log10(np.maximum(r_pair, 1)), 0.0) + np.where(r_pair == 0, np.log10(p1), 0.0)
        fixed -= np.where((c_pair > 0) & (pair_cur != END), np.log10(c_pair + DELTA), 0.0)
        out = []
        asked = []
        begin_e = begin_t = 0
        for (n_e, n_t), i in zip(sizes, order):
            e, t = slice(begin_e, begin_e + n_e), slice(begin_t, begin_t + n_t)
            begin_e, begin_t = e.stop, t.stop
            doc = (tags[t] >> 1).astype(np.int64)
            n = int(doc.max()) + 1
            of = np.repeat(pair[e], count[e])
            own = np.flatnonzero(np.bincount(doc, minlength=n))
            r = r_pair[of]
            sums = [np.bincount(doc, weights=x[of], minlength=n)[own] for x in (base, fixed)]
            known = np.bincount(doc[c_pair[of] > 0], minlength=n)[own].astype(np.uint32)
            low = [np.bincount(doc[r == k], minlength=n)[own].astype(np.uint32) for k in range(1, K + 1)]
            out.append((0, "sums", chunk_ids[i], pack(own.astype(np.uint32), *sums, known, *low)))
            ask = np.flatnonzero(r == 0)
            if len(ask):
                asked.append((pair_prev[of[ask]], doc[ask].astype(np.uint32), np.full(len(ask), chunk_ids[i], _U64)))
        if asked:  # of all chunks together: one row for each bucket asked
            v, d, c = (np.concatenate(x) for x in zip(*asked))
            q = place(v, parts)
            s = np.argsort(q, kind="stable")
            v, d, c, q = v[s], d[s], c[s], q[s]
            out += [(k, "ask", 0, pack(v[x], d[x], c[x])) for k, x in _by_part(q, parts)]
        # followers seen in training, by context
        live = np.flatnonzero(r_pair)
        v = pair_prev[live]
        s = np.argsort(v)
        v, r, p = v[s], r_pair[live][s], p1[live][s]
        if len(v):
            b = runs(v)
            mass = np.add.reduceat(p, b)
            low = [np.add.reduceat((r == k).astype(np.uint32), b) for k in range(1, K + 1)]
            v = v[b]
            q = place(v, parts)
            s = np.argsort(q, kind="stable")
            v, mass, low, q = v[s], mass[s], [x[s].astype(np.uint32) for x in low], q[s]
            out += [(k, "context", 0, pack(v[x], mass[x], *(y[x] for y in low))) for k, x in _by_part(q, parts)]
        n_r = np.array([(r_pair == k).sum() for k in range(K + 2)], np.int64)
        out.append((0, "counts", 0, pack(n_r)))
        return pa.Table.from_batches([_rows(out)])

    return run


def answer(d: np.ndarray):
    """Of one bucket of contexts: log10 of alpha(v) (c(v) + DELTA) for each question."""
    loss = np.arange(1, K + 1) * (1 - d[1:])

    def run(keys, table):
        kinds, blobs = (table.column(c).to_pylist() for c in ("kind", "data"))
        seen = [unpack(x, _U64, np.float64, *[np.uint32] * K) for k, x in zip(kinds, blobs) if k == "context"]
        if seen:
            word, back = np.unique(np.concatenate([s[0] for s in seen]), return_inverse=True)
            mass = np.bincount(back, weights=np.concatenate([s[1] for s in seen]))
            left = DELTA + sum(np.bincount(back, weights=np.concatenate([s[1 + k] for s in seen])) * loss[k - 1] for k in range(1, K + 1))
            value = np.log10(left / np.maximum(1 - mass, 1e-300))
        else:
            word, value = np.zeros(0, _U64), np.zeros(0)
        asked = [unpack(x, _U64, np.uint32, _U64) for k, x in zip(kinds, blobs) if k == "ask"]
        if not asked:
            return pa.Table.from_batches([_rows([])])
        v, doc, chunk = (np.concatenate(x) for x in zip(*asked))
        i = np.searchsorted(word, v)
        i[i == len(word)] = 0
        got = np.where(word[i] == v, value[i], 0.0) if len(word) else np.zeros(len(v))
        order = np.lexsort((doc, chunk))
        got, doc, chunk = got[order], doc[order], chunk[order]
        begin = np.append(runs(chunk), len(chunk)).tolist()
        out = []
        for s, e in zip(begin, begin[1:]):
            b = runs(doc[s:e])
            out.append((0, "told", int(chunk[s]), pack(doc[s:e][b], np.add.reduceat(got[s:e], b))))
        return pa.Table.from_batches([_rows(out)])

    return run


def finish(d: np.ndarray, trained: int, total: int):
    weight = np.log10(d[1:] * np.arange(1, K + 1))

    def run(keys, table):
        kinds, blobs = table.column("kind").to_pylist(), table.column("data").to_pylist()
        ids, valid, held, size = unpack(blobs[kinds.index("text")], np.int64, np.uint8, np.uint8, np.uint32)
        n = len(ids)
        base, score, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
        score -= np.log10(trained + DELTA) if trained else 0.0
        for k, x in zip(kinds, blobs):
            if k == "sums":
                own, b, f, kn, *low = unpack(x, np.uint32, np.float64, np.float64, np.uint32, *[np.uint32] * K)
                base[own] += b
                known[own] += kn
                score[own] += f + sum(a * w for a, w in zip(low, weight))
            elif k == "told":
                own, x = unpack(x, np.uint32, np.float64)
                score[own] += x
        return pa.table({"id": pa.array(ids, mask=valid == 0), "held_out": pa.array(held.astype(bool)), "n_tokens": pa.array(size.astype(np.int64)), "n_known": pa.array(known), "train_tokens": pa.array(np.full(n, total)), "base_score": pa.array(base), "score": pa.array(score)})

    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", *, bucket_bytes: int = 12 << 20, chunk_bytes: int = 6 << 20) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score (add-0.1 unigrams) and score (log10 probability by the model)."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), F.coalesce(held_out, F.lit(False)).alias("held"))
    size = d.agg(F.sum(F.octet_length("t")).alias("b"), F.count_if(~F.col("held")).alias("n")).first()
    parts = max(spark.sparkContext.defaultParallelism, -(-(size.b or 0) // bucket_bytes))
    # groups by number: as many partitions as buckets, whatever the session's setting
    deal = lambda df, key, n: df.repartition(int(n), key).groupBy(key)
    stats = save(deal(d.mapInArrow(tidy(count_words(parts, chunk_bytes)), _ROW), "part", parts).applyInArrow(tidy_group(total_words), "total long, kinds long, n array<long>, hot array<struct<w:long,c:long>>"))
    sums = stats.agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds"), *(F.sum(F.col("n")[r]).alias(f"n{r}") for r in range(K + 2))).first()
    total = sums.total or 0
    hot = stats.select(F.explode("hot").alias("h")).select("h.w", "h.c").filter(F.col("c") * HOT >= total).collect()
    n1 = np.array([sums[f"n{r}"] or 0 for r in range(K + 2)], np.float64)
    uni = spark.sparkContext.broadcast(Unigrams(total, sums.kinds or 0, n1, {h.w & (1 << 64) - 1: h.c for h in hot}))
    drop(stats)
    release(spark)
    found = save(deal(d.mapInArrow(tidy(send_pairs(parts, chunk_bytes, uni)), _ROW), "part", parts).applyInArrow(tidy_group(score_pairs(parts, uni)), _ROW), "kind")
    n2 = np.zeros(K + 2)
    for row in found.filter("kind = 'counts'").groupBy().agg(F.collect_list("data").alias("x")).collect():
        for x in row.x:
            n2 += unpack(x, np.int64)[0]
    release(spark)  # after a further job: Spark holds on to the last one's shuffles
    d2 = discounts(n2)
    told = deal(found.filter("kind in ('context', 'ask')").select("part", "kind", "chunk", "data"), "part", parts).applyInArrow(tidy_group(answer(d2)), _ROW)
    rest = found.filter("kind in ('sums', 'text')").select("part", "kind", "chunk", "data").unionByName(told)
    out = deal(rest, "chunk", parts).applyInArrow(tidy_group(finish(d2, int(size.n or 0), int(total))), "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
