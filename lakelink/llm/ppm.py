"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order context tree over the UTF-8 bytes of lower-cased text. A node predicts the symbols seen after its context by
count / (total + distinct) and escapes with distinct / (total + distinct) to the next shorter context, where the symbols
already offered are excluded; below order 0 the unseen bytes are equally likely. Every node's distribution sums to 1,
so minus its log2 is an exact code length. Statistics are frozen after training: scoring a text changes nothing.

Training takes a bounded sample of labelled rows (`rows_per_lang`, `bytes_per_lang`, the first `longest` characters of a text from its first letter,
those with the smallest hash of their id) of every label; everything else covers all rows. If the trees of all labels would take more
than `most_bytes` of memory, every label's bytes are halved until they fit; labels that do not fit at all are an error, none is left out.

Rows: null or letterless text has language `und` and score 0; null ids are kept; repeated rows are scored alike; an
empty training set makes every row `und`; extra columns pass through `identify` untouched. The posterior of the best
language under equal priors is the score; ties go to the alphabetically first language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .wordhash import slices, tidy, trim

UNKNOWN = "und"


def pairs(t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each context of k bytes with the byte after it in the lowest place, and its count; the context's nearest byte is its most significant one, so parents are prefixes."""
    context = np.zeros(max(0, len(t) - k), np.uint64)
    for j in range(1, k + 1):
        context |= t[k - j : len(t) - j] << np.uint64(8 * (k - j))
    return np.unique((context << np.uint64(8)) | t[k:], return_counts=True)


def frequent(found: tuple[np.ndarray, np.ndarray], min_count: int) -> np.ndarray:
    """Contexts seen at least min_count times."""
    context, back = np.unique(found[0] >> np.uint64(8), return_inverse=True)
    return context[np.bincount(back, weights=found[1], minlength=len(context)) >= min_count]


class Model:
    """Context trees of several languages over one union of contexts.

    child[node, byte]: the node whose context has that byte in front, 0 if none. logp[node, byte, language]: log2 probability.
    """

    def __init__(self, samples: dict[str, bytes], order: int = 4, min_count: int = 12):
        self.langs, self.order = sorted(samples), order
        texts = [np.frombuffer(samples[k], np.uint8).astype(np.uint64) for k in self.langs]
        self.child = np.zeros((1, 256), np.int32)
        union, parents = [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)]  # of each order: contexts, and their places one order down
        first = 0
        for k in range(1, order + 1):
            kept = [frequent(pairs(t, k), min_count) for t in texts]
            contexts = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
            up = np.searchsorted(union[-1], contexts >> np.uint64(8))
            self.child[first + up, (contexts & np.uint64(255)).astype(np.int64)] = len(self.child) + np.arange(len(contexts))
            first = len(self.child)
            self.child = np.vstack([self.child, np.zeros((len(contexts), 256), np.int32)])
            union.append(contexts)
            parents.append(up)
        self.logp = np.zeros((len(self.child), 256, len(texts)), np.float32)
        for li, t in enumerate(texts):  # one language's tables at a time
            self._learn(t, li, union, parents, min_count)

    def _learn(self, t: np.ndarray, li: int, union: list[np.ndarray], parents: list[np.ndarray], min_count: int) -> None:
        before = escaped = counts = np.zeros((0, 256))  # of the next lower order, which is all that an order needs
        first = 0
        for k, contexts in enumerate(union):
            pair, n = found = pairs(t, k)
            place = np.searchsorted(contexts, pair >> np.uint64(8))
            place[place == len(contexts)] = 0
            fits = contexts[place] == pair >> np.uint64(8) if len(contexts) else np.zeros(len(pair), bool)
            count = np.zeros((len(contexts), 256))
            count[place[fits], (pair[fits] & np.uint64(255)).astype(np.int64)] = n[fits]
            seen = count > 0
            total, distinct = count.sum(1, keepdims=True), seen.sum(1, keepdims=True)
            full = distinct == 256
            whole = np.maximum(total + distinct * ~full, 1)
            if k == 0:
                fallback = np.where(seen, 0, 1.0) / np.maximum(256 - distinct, 1)
                dist = np.where(seen, count / whole, fallback * np.where(total > 0, distinct * ~full / whole, 1.0))
            else:
                at = parents[k]
                offered = counts[at] > 0
                rest = escaped[at]
                up = counts[at] * ~seen
                up_seen = up > 0
                n_e, d_e = up.sum(1, keepdims=True), up_seen.sum(1, keepdims=True)
                d_esc = d_e * ((rest * ~offered).sum(1, keepdims=True) > 0)
                fallback = np.where(up_seen, up / np.maximum(n_e + d_esc, 1), np.where(offered, 0, rest * np.where(d_e > 0, d_esc / np.maximum(n_e + d_esc, 1), 1.0)))
                dist = np.where(seen, count / whole, fallback * (distinct * ~full / whole))
                # contexts that only other languages keep stand for the shorter one
                other = ~np.isin(contexts, frequent(found, min_count))
                dist[other], fallback[other], count[other] = before[at[other]], escaped[at[other]], counts[at[other]]
            self.logp[first : first + len(contexts), :, li] = np.log2(np.maximum(dist, 1e-30))
            before, escaped, counts = dist, fallback, count
            first += len(contexts)

    def bits(self, off: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Code length in bits of each text under each language."""
        n = len(raw)
        since = np.arange(n) - np.repeat(off[:-1], np.diff(off))
        node = np.zeros(n, np.int32)
        alive = np.ones(n, bool)
        for j in range(1, self.order + 1):
            alive &= since >= j
            step = np.zeros(n, np.int32)
            at = np.flatnonzero(alive)
            step[at] = self.child[node[at], raw[at - j]]
            alive = step > 0
            node = np.where(alive, step, node)
        gained = np.zeros((n + 1, len(self.langs)))
        np.cumsum(self.logp[node, raw], axis=0, dtype=np.float64, out=gained[1:])
        return gained[off[:-1]] - gained[off[1:]]


def memory(samples: dict[str, bytes], order: int, min_count: int = 12) -> int:
    """Bytes that building a Model takes at most: eight tables of one language's largest order, and the model."""
    per = [1]
    for k in range(1, order + 1):
        kept = [frequent(pairs(np.frombuffer(text, np.uint8).astype(np.uint64), k), min_count) for text in samples.values()]
        per.append(len(np.unique(np.concatenate(kept))) if kept else 0)
    return 256 * (64 * max(per) + 4 * (1 + len(samples)) * sum(per))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, order: int = 4, rows_per_lang: int = 300, bytes_per_lang: int = 200_000, longest: int = 20_000, most_bytes: int = 1 << 28) -> Model:
    """Fit on a bounded sample of the labelled rows of docs, of every language."""
    named = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    cut = F.when(F.length(text_col) <= longest, F.col(text_col)).otherwise(F.substring(F.regexp_replace(text_col, r"^\P{L}+", ""), 1, longest))
    keyed = named.select(F.col(lang_col).alias("l"), F.col(id_col).alias("i"), F.xxhash64(F.col(id_col).cast("string"), F.lit(7)).alias("h"))
    # about twice the rows wanted of each language pass a cut of the hash, so that ranking them needs no language in one place
    every = keyed.groupBy("l").agg(F.approx_count_distinct("h").alias("n")).collect()
    cuts = docs.sparkSession.createDataFrame([(r.l, min(1.0, (2 * rows_per_lang + 50) / r.n)) for r in every], "l string, cut double")
    passed = keyed.join(F.broadcast(cuts), "l").filter(F.shiftrightunsigned("h", 11) / float(1 << 53) < F.col("cut")).drop("cut")
    rank = Window.partitionBy("l").orderBy("h", "i")
    chosen = passed.withColumn("n", F.row_number().over(rank)).filter(F.col("n") <= rows_per_lang)
    ids = chosen.select("l", "i", "h").distinct().orderBy("l", "h", "i").collect()
    order_of = {(r.l, r.i): k for k, r in enumerate(ids)}
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(r.l, r.i) for r in ids], keyed.select("l", "i").schema))
    got = named.select(F.col(lang_col).alias("l"), F.col(id_col).alias("i"), cut.alias("t")).join(wanted.select(F.col("l").alias("l2"), F.col("i").alias("i2")), (F.col("l") == F.col("l2")) & F.col("i").eqNullSafe(F.col("i2")))
    # of rows that repeat an id, the first few texts are enough
    got = got.withColumn("n", F.row_number().over(Window.partitionBy("l", "i").orderBy("t"))).filter("n <= 4").select("l", "i", "t").collect()
    parts: dict[str, bytearray] = {}
    for lang, _, text in sorted(got, key=lambda r: (order_of[r[0], r[1]], r[2])):
        own = parts.setdefault(lang, bytearray())
        if len(own) < bytes_per_lang:
            own += pc.utf8_lower(pa.scalar(text)).as_py().encode() + b"\n"
    if lost := {r.l for r in every} - set(parts):
        raise ValueError(f"no training text of the languages {sorted(lost)}")
    samples, most = {k: bytes(v) for k, v in parts.items()}, max(map(len, parts.values()), default=0)
    while memory(samples, order) > most_bytes:
        most //= 2
        if most < 256:
            raise ValueError(f"the trees of {len(samples)} languages take more than {most_bytes} bytes")
        samples = {k: v[:most] for k, v in samples.items()}
    model = Model(samples, order)
    trim()
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", *, prefix: str = "") -> DataFrame:
    """docs with the columns {prefix}lang_pred, {prefix}score (0 to 1) and {prefix}bits_per_byte."""
    names = [f"{prefix}lang_pred", f"{prefix}score", f"{prefix}bits_per_byte"]
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"docs has columns {sorted(clash)}; give another prefix")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index(text_col)
    flag = "_has_letter"
    while flag in docs.columns:
        flag += "_"
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        langs = np.array([*m.langs, UNKNOWN], object)
        for batch in batches:
            n = batch.num_rows
            best, post, rate = np.full(n, len(m.langs)), np.zeros(n), np.zeros(n)
            has = np.array(batch.column(flag).to_pylist(), bool)
            texts = batch.column(text_at)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) if m.langs else np.zeros(0)
            cuts = np.unique(np.searchsorted(ends, np.arange(1 << 18, ends[-1] if len(ends) else 0, 1 << 18)) + 1).tolist()
            for begin, end in zip([0, *cuts], [*cuts, n]) if m.langs else ():
                _, off, raw = next(slices(pc.utf8_lower(texts.slice(begin, end - begin)), 1 << 62), (0, np.zeros(1, np.int64), np.zeros(0, np.uint8)))
                bits = m.bits(off, raw)
                rows = slice(begin, begin + len(bits))
                best[rows] = bits.argmin(1)
                gap = np.minimum((bits - bits.min(1, keepdims=True)) * np.log(2), 700)
                post[rows] = 1 / np.exp(-gap).sum(1)
                rate[rows] = bits.min(1) / np.maximum(np.diff(off), 1)
            best[~has], post[~has] = len(m.langs), 0.0
            own = [batch.column(c) for c in batch.schema.names if c != flag]
            yield pa.RecordBatch.from_arrays([*own, pa.array(langs[best], pa.string()), pa.array(post), pa.array(rate)], [*(c for c in batch.schema.names if c != flag), *names])

    return docs.withColumn(flag, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))).mapInArrow(tidy(score, shared), schema)
