"""Text views of names and addresses as column expressions; Arrow UDFs only for Unicode forms that Spark has no function for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .strings import latin_fold

#: Fixed literals that mean a missing text.
MISSING = ["", "null", "<null>", "none", "nan"]
#: Legal suffixes and their standard forms, on which results depend.
SUFFIXES = {
    "pvt": "private", "pvtltd": "private limited", "ltd": "limited", "llp": "llp", "inc": "incorporated", "corp": "corporation", "co": "company", "llc": "llc", "plc": "plc", "sa": "sa", "sarl": "sarl", "sas": "sas",
    "sasu": "sasu", "gmbh": "gmbh", "ag": "ag", "nv": "nv", "bv": "bv", "pty": "proprietary", "pte": "private", "intl": "international", "svc": "services", "svcs": "services", "mfg": "manufacturing",
    "assoc": "associates", "bros": "brothers", "dept": "department", "enterprises": "enterprises", "enterprise": "enterprises", "private": "private", "limited": "limited", "incorporated": "incorporated",
    "corporation": "corporation", "company": "company",
}
#: Fixed Unicode blocks of the Indic scripts.
INDIC = {
    "Devanagari": (0x900, 0x97F), "Bengali": (0x980, 0x9FF), "Gurmukhi": (0xA00, 0xA7F), "Gujarati": (0xA80, 0xAFF), "Odia": (0xB00, 0xB7F),
    "Tamil": (0xB80, 0xBFF), "Telugu": (0xC00, 0xC7F), "Kannada": (0xC80, 0xCFF), "Malayalam": (0xD00, 0xD7F),
}


@F.pandas_udf(T.StringType())
def nfkc_casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.casefold() if x.isascii() else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(T.StringType())
def fold_accents(s: pd.Series) -> pd.Series:
    """Marks on Latin letters go, others stay."""
    return s.map(lambda x: x if x is None or x.isascii() else latin_fold(x))


def marks_off(x: str) -> str:
    return x.casefold() if x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).casefold()


@F.pandas_udf(T.StringType())
def retrieval_fold(s: pd.Series) -> pd.Series:
    """Compatibility forms without any combining mark, case-folded."""
    return s.map(lambda x: None if x is None else marks_off(x))


def by_script(x: Column, other, ascii=F.lower) -> Column:
    """ascii of texts in ASCII, which no Python worker sees; other, an Arrow UDF, of the rest."""
    plain = ~x.rlike(r"[^\x00-\x7f]")
    return F.when(plain, ascii(x)).otherwise(other(F.when(~plain, x)))


def is_missing(x: Column) -> Column:
    return x.isNull() | F.lower(F.trim(x)).isin(MISSING)


def normalized(x: Column) -> Column:
    """Case-folded NFKC: separators become single spaces, letters, digits and marks stay, all else is deleted."""
    y = F.regexp_replace(by_script(x, nfkc_casefold), r"[\p{Z}\t\n,\-/.&]", " ")
    y = F.trim(F.regexp_replace(F.regexp_replace(y, r"[^\p{L}\p{N}\p{Mn}\p{Mc} ]", ""), " +", " "))
    return F.when(is_missing(x), "").otherwise(y)


def tokens(x: Column) -> Column:
    return F.filter(F.split(x, " "), lambda t: t != "")


def numbers(x: Column) -> Column:
    """Sorted distinct runs of digits that stand as words."""
    return F.array_sort(F.array_distinct(digit_words(x)))


def digit_words(x: Column) -> Column:
    """Runs of digits that stand as words, in order."""
    return F.filter(F.split(x, r"[^\p{L}\p{N}_]+"), lambda w: w.rlike(r"^\p{Nd}+$"))


def postal(x: Column) -> Column:
    """The first of five or six digits."""
    return F.get(F.filter(digit_words(x), lambda w: F.length(w).between(5, 6)), 0)


def views(x: Column) -> Column:
    n = normalized(x)
    return F.struct(n.alias("normalized"), fold_accents(n).alias("folded"), F.replace(n, F.lit(" "), F.lit("")).alias("compact"), tokens(n).alias("tokens"), F.array_sort(F.array_distinct(F.regexp_extract_all(n, F.lit(r"\p{Nd}+"), F.lit(0)))).alias("numeric_tokens"))


def core_and_suffix(name: Column, suffixes: dict[str, str] | None = None) -> Column:
    """struct<core, suffix>: up to three trailing legal forms go to suffix in standard form; a name of nothing else is its own core."""
    table = F.create_map(*[F.lit(x) for kv in (suffixes or SUFFIXES).items() for x in kv])
    t = tokens(name)
    last = [table[F.element_at(t, F.when(F.size(t) >= k, -k).otherwise(F.lit(None)))] for k in (1, 2, 3)]
    n = F.when(last[0].isNull(), 0).when(last[1].isNull(), 1).when(last[2].isNull(), 2).otherwise(3)
    n = F.when(F.size(t) == 0, 0).otherwise(n)
    whole = n >= F.size(t)
    suffix = F.concat_ws(" ", *(F.when(n >= k, last[k - 1]) for k in (3, 2, 1)))
    core = F.when(whole, F.array_join(t, " ")).otherwise(F.array_join(F.slice(t, F.lit(1), F.greatest(F.size(t) - n, F.lit(0))), " "))
    return F.struct(core.alias("core"), suffix.alias("suffix"))


def script_counts(x: Column) -> dict[str, Column]:
    """Characters of x in each Indic block."""
    return {k: F.regexp_count(x, F.lit(f"[\\x{{{a:x}}}-\\x{{{b:x}}}]")) for k, (a, b) in INDIC.items()}


def script(x: Column) -> Column:
    """The Indic script with the most letters, 'Latin' where none beats the others; ties go to the one met first."""
    letter = {k: F.regexp_count(x, F.lit(f"[[\\x{{{a:x}}}-\\x{{{b:x}}}]&&\\p{{L}}]")) for k, (a, b) in INDIC.items()}
    every = F.regexp_count(x, F.lit(r"\p{L}"))
    rest = every - sum(letter.values())
    first = {k: F.length(F.regexp_extract(x, f"^[^\\x{{{a:x}}}-\\x{{{b:x}}}]*", 0)) for k, (a, b) in INDIC.items()}
    low = F.length(F.regexp_extract(x, "^(?:[\\x{900}-\\x{d7f}]|[^\\p{L}])*", 0))
    best = F.array_max(F.array(F.struct(rest.alias("n"), (-low).alias("p"), F.lit("Latin").alias("k")), *(F.struct(letter[k].alias("n"), (-first[k]).alias("p"), F.lit(k).alias("k")) for k in INDIC)))
    return F.when(F.coalesce(every, F.lit(0)) == 0, "Latin").otherwise(best["k"])


def has_indic(x: Column) -> Column:
    return F.coalesce(x.rlike("[\\x{900}-\\x{d7f}]"), F.lit(False))


def transliterated(t: Column, dictionary: Column) -> Column:
    """Tokens looked up in a map column, others as they are."""
    return F.transform(t, lambda x: F.coalesce(dictionary[x], x))


def char_ngrams(x: Column, low: int = 3, high: int = 4) -> Column:
    """Character n-grams of each word padded with one space; a size that a word fills at once is its last."""
    def gram(w: Column, n: int):
        return lambda i: F.substring(w, i, F.lit(n))

    def of(word: Column) -> Column:
        w = F.concat(F.lit(" "), word, F.lit(" "))
        parts = [F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))), gram(w, n)) for n in range(low, high + 1)]
        out = parts[0]
        for n in range(low + 1, high + 1):
            out = F.when(F.length(w) > n - 1, F.concat(out, parts[n - low])).otherwise(out)
        return out

    return F.flatten(F.transform(tokens(x), of))


def anchors(addr_tokens: Column) -> Column:
    """First and last two tokens of four or more characters that are not numbers."""
    ends = F.concat(F.slice(addr_tokens, 1, 2), F.when(F.size(addr_tokens) >= 2, F.slice(addr_tokens, -2, 2)).otherwise(addr_tokens))
    return F.array_distinct(F.filter(ends, lambda t: (F.length(t) >= 4) & ~t.rlike(r"^\p{Nd}+$")))


def combined_view(core: Column, name: Column, translit: Column, addr_tokens: Column) -> Column:
    """Retrieval text: core, other forms of the name, first and last four address tokens."""
    main = F.when(core != "", core).otherwise(name)
    tail = F.when(F.size(addr_tokens) > 4, F.slice(addr_tokens, -4, 4))
    return F.concat_ws(" ", main, F.when(name != main, name), F.when((translit != main) & (translit != ""), translit), F.slice(addr_tokens, 1, 4), tail)


def name_view(core: Column, norm: Column, folded: Column, translit: Column) -> Column:
    """Retrieval text of a name: its distinct non-empty forms, then its fold without any mark."""
    return F.array_join(F.array_distinct(F.filter(F.array(core, norm, folded, translit, by_script(norm, retrieval_fold)), lambda x: x != "")), " ")


def address_view(folded: Column, norm: Column) -> Column:
    return by_script(F.coalesce(F.nullif(folded, F.lit("")), norm), retrieval_fold)


@F.pandas_udf(T.StringType())
def nfkc_lower(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).lower())


def deleted_punctuation(x: Column) -> Column:
    """The older normal form: what is no letter, digit, mark or space is deleted, not made a space; a missing text is empty."""
    y = F.regexp_replace(by_script(x, nfkc_lower), r"[^\p{L}\p{N}\p{Mn}\p{Mc}\p{Zs}]", "")
    return F.when(x.isNull() | F.lower(x).isin("", "null", "<null>", "none"), "").otherwise(F.trim(F.regexp_replace(y, r"\p{Zs}+", " ")))


def range_script(x: Column) -> Column:
    """The script with most code points in its block ('Latin' is U+0041 to U+007A), 'Unknown' if there are none; ties go to the one met first."""
    blocks = {"Latin": (0x41, 0x7A), **INDIC}
    n = {k: F.regexp_count(x, F.lit(f"[\\x{{{a:x}}}-\\x{{{b:x}}}]")) for k, (a, b) in blocks.items()}
    before = {k: F.length(F.regexp_extract(x, f"^[^\\x{{{a:x}}}-\\x{{{b:x}}}]*", 0)) for k, (a, b) in blocks.items()}
    best = F.array_max(F.array(*(F.struct(n[k].alias("n"), (-before[k]).alias("p"), F.lit(k).alias("k")) for k in blocks)))
    return F.when(F.coalesce(best["n"], F.lit(0)) == 0, "Unknown").otherwise(best["k"])


def record(name: Column, address: Column, dictionary: Column | None = None) -> list[dict[str, Column]]:
    """Columns of a preprocessed record, in steps: the columns of a step read those of the one before, so each is worked out once."""
    n, a, words = F.col("name_norm"), F.col("addr_norm"), F.col("addr_digit_words")
    cs = core_and_suffix(n)
    same = lambda x: x
    return [
        {"name_raw": name, "addr_raw": address, "name_norm": normalized(name), "addr_norm": normalized(address)},
        {"name_tokens": tokens(n), "addr_tokens": tokens(a), "addr_digit_words": digit_words(a)},
        {
            "name_folded": by_script(n, fold_accents, same), "name_retrieval": by_script(n, retrieval_fold), "name_compact": F.replace(n, F.lit(" "), F.lit("")), "name_core": cs["core"], "name_suffix": cs["suffix"],
            "name_numeric_tokens": F.array_sort(F.array_distinct(F.regexp_extract_all(n, F.lit(r"\p{Nd}+"), F.lit(0)))),
            "name_translit": F.when(has_indic(name), F.array_join(transliterated(F.col("name_tokens"), dictionary), " ") if dictionary is not None else n).otherwise(""),
            "addr_folded": by_script(a, fold_accents, same), "addr_compact": F.replace(a, F.lit(" "), F.lit("")), "addr_empty": a == "", "addr_numbers": F.array_sort(F.array_distinct(words)),
            "addr_numeric_tokens": F.array_sort(F.array_distinct(F.regexp_extract_all(a, F.lit(r"\p{Nd}+"), F.lit(0)))),
            "addr_postal": F.get(F.filter(words, lambda w: F.length(w).between(5, 6)), 0), "script": script(name), "is_indic": has_indic(name),
        },
    ]
