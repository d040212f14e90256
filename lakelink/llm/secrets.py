"""Secret scans in SQL functions only.

Base spans come from three patterns (leftmost, non-overlapping, greedy): key assignments, access keys and long hex runs.
Two character Markov models add spans of kind `random`: one of random strings, one of ordinary identifiers, both order 1
over 64 symbols and trained on labelled samples. Of a run of 20 or more key characters, each part outside the base spans is random if its
log-likelihood ratio is at least `threshold` per transition, and in sum at least that of the shortest run at the threshold.

Positions are code points, ends exclusive. They come from splitting a text at its matches and adding up lengths.
Rows: a null text counts as empty and has no span; null ids and repeated rows are kept as they are.
"""

from __future__ import annotations

import math
import random
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base kinds, in listed order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # 16 characters in all
HEX = r"[0-9a-f]{32,}"
LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"
SYMBOLS = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+_"


def code(ch: str) -> int:
    """Symbol number of a character; / and - share those of + and _."""
    return SYMBOLS.index({"/": "+", "-": "_"}.get(ch, ch))


def samples(n: int = 4000, seed: int = 5) -> list[tuple[str, bool]]:
    """Labelled strings (text, random): keys in several alphabets, and identifiers in several styles made of syllables."""
    r = random.Random(seed)
    alphabets = ["0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits, string.ascii_letters]
    out = [("".join(r.choices(r.choice(alphabets), k=r.randint(20, 64))), True) for _ in range(n)]
    onset = ["", "b", "c", "d", "f", "g", "h", "j", "l", "m", "n", "p", "r", "s", "t", "v", "w", "st", "tr", "ch", "sh", "th", "pl", "gr", "pr", "qu"]
    nucleus = ["a", "e", "i", "o", "u", "ea", "ou", "io", "ie", "ai"]
    coda = ["", "", "n", "r", "s", "t", "l", "d", "m", "nd", "ng", "nt", "st", "ck", "x"]
    words = ["".join(r.choice(onset) + r.choice(nucleus) + r.choice(coda) for _ in range(r.randint(1, 4))) for _ in range(n)]
    styles = [lambda w: "_".join(w), lambda w: w[0] + "".join(map(str.capitalize, w[1:])), lambda w: "".join(w), lambda w: "-".join(w), lambda w: "/".join(w), lambda w: "_".join(w).upper(), lambda w: "_".join(w) + str(r.randint(0, 99)), lambda w: "".join(w).upper()]
    return out + [(r.choice(styles)(r.choices(words, k=r.randint(2, 8))), False) for _ in range(n)]


def ratios(labelled: list[tuple[str, bool]], smooth: float = 0.5) -> list[float]:
    """log P_random(b | a) - log P_identifier(b | a), for symbol pairs in row order."""
    n = len(SYMBOLS)
    counts = {kind: [[smooth] * n for _ in range(n)] for kind in (True, False)}
    for text, kind in labelled:
        for a, b in zip(text, text[1:]):
            counts[kind][code(a)][code(b)] += 1
    rows = {kind: [[math.log(c / sum(row)) for c in row] for row in m] for kind, m in counts.items()}
    return [x - y for a, b in zip(rows[True], rows[False]) for x, y in zip(a, b)]


def spans(text: Column, pattern: str, kind: str, order: int) -> Column:
    """array<struct<start, end, order, kind, match>> of the matches of pattern."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    step = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,o:int,k:string,m:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("s"), end.alias("e"), F.lit(order).alias("o"), F.lit(kind).alias("k"), x["m"].alias("m")))).alias("out"))

    zipped = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    return F.when(F.size(found) > 0, F.aggregate(zipped, step, add)["out"]).otherwise(step["out"])


def likelihood_ratio(s: Column, table: Column, codes: Column) -> Column:
    """Summed log-likelihood ratio of s's transitions."""
    ids = F.transform(F.split(s, ""), lambda c: F.element_at(codes, F.ascii(c) + 1))
    pairs = F.zip_with(F.slice(ids, F.lit(1), F.size(ids) - 1), F.slice(ids, F.lit(2), F.size(ids) - 1), lambda a, b: F.element_at(table, a * len(SYMBOLS) + b + 1))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def outside(x: Column, base: Column) -> Column:
    """The parts of span x, as spans, that no span of base (sorted by start) covers."""
    part = lambda s, e: F.struct(s.alias("s"), e.alias("e"), x["o"].alias("o"), x["k"].alias("k"), F.substring(x["m"], s - x["s"] + 1, e - s).alias("m"))
    none = F.array().cast("array<struct<s:int,e:int,o:int,k:string,m:string>>")
    add = lambda acc, b: F.struct(F.greatest(acc["at"], b["e"]).alias("at"), F.concat(acc["out"], F.when(b["s"] > acc["at"], F.array(part(acc["at"], b["s"]))).otherwise(none)).alias("out"))
    done = lambda acc: F.concat(acc["out"], F.when(acc["at"] < x["e"], F.array(part(acc["at"], x["e"]))).otherwise(none))
    return F.aggregate(F.filter(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])), F.struct(x["s"].alias("at"), none.alias("out")), add, done)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = 0.5, labelled: list[tuple[str, bool]] | None = None) -> DataFrame:
    """id, and `spans`: array<struct<start, end, kind, match>> by start, then kind as listed (assign, access, hex, random)."""
    table = F.array(*map(F.lit, ratios(labelled or samples())))
    codes = F.array(*(F.lit(code(chr(i)) if chr(i) in SYMBOLS + "/-" else 0) for i in range(128)))
    d = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("t"))
    d = d.withColumn("assign", F.filter(spans(F.col("t"), ASSIGN, "assign", 0), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 8))
    d = d.select(id_col, F.concat("assign", spans(F.col("t"), ACCESS, "access", 1), spans(F.col("t"), HEX, "hex", 2)).alias("base"), spans(F.col("t"), CANDIDATE, "random", 3).alias("more"))
    base = F.array_sort("base")
    parts = F.flatten(F.transform("more", lambda x: outside(x, base)))
    free = F.filter(parts, lambda x: likelihood_ratio(x["m"], table, codes) >= threshold * F.greatest(F.length(x["m"]) - 1, F.lit(LEAST - 1)))
    ranked = F.array_sort(F.concat("base", free))  # by start, end, order: two spans of one kind never share a start
    ranked = F.array_sort(F.transform(ranked, lambda x: F.struct(x["s"].alias("s"), x["o"].alias("o"), x["e"].alias("e"), x["k"].alias("k"), x["m"].alias("m"))))
    return d.select(id_col, F.transform(ranked, lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), x["k"].alias("kind"), x["m"].alias("match"))).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the SHA-256 of the base spans and the list of all spans as text."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(id_col, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(listed(F.filter("spans", lambda x: x["kind"] != "random")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
