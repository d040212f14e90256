"""Registered queries of the record-linkage engine and their SQL, over whole tables.

Documents stand for records: the first line is the name, the rest the address, the language the country; doc_id % 3 names the source.
Matches are documents of equal text. Oracles repeat the derivation in SQL; texts here are Latin, for which NFKC and case folding are lower case and ss for ß.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import similarity as S
from .functions import text as X
from .operators import blocking as B
from .operators import contracts, decode, features, metrics, mining, profile, training
from .operators.cells import key_candidates, once
from .operators.scratch import save
from .plans.linker import prepare

K = 5
BUDGET = 8
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def raw_records(spark: SparkSession, d: str) -> DataFrame:
    src = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"))
    first = F.substring_index("text", "\n", 1)
    return table(spark, d, "documents").select(
        src.alias("source"), F.concat(src, F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), F.col("doc_id").alias("ordinal"), F.col("lang").alias("country"),
        first.alias("business_name"), F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("business_address"), "text",
    )


def records(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Prepared records with these columns, or all; no other is worked out."""
    made = prepare(raw_records(spark, d))
    return made.select("source", "entity_id", "ordinal", "country", *columns) if columns else made


def sides(spark: SparkSession, d: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Queries and targets, kept for the steps that read them; a lost executor's part is made again from the scan."""
    r = records(spark, d, *dict.fromkeys([*B.HELD, "name_norm", *columns])).persist(StorageLevel.MEMORY_AND_DISK)
    return r.filter("source = 'S1'"), r.filter("source <> 'S1'")


def whole_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """With every column; what is not read is not worked out."""
    r = records(spark, d)
    return r.filter("source = 'S1'"), r.filter("source <> 'S1'")


def truth_pairs(spark: SparkSession, d: str) -> DataFrame:
    r = raw_records(spark, d).select("source", "entity_id", F.sha2("text", 256).alias("h"))
    return r.filter("source = 'S1'").select("h", F.col("entity_id").alias("s1_id")).join(r.filter("source <> 'S1'").select("h", F.col("entity_id").alias("target_id")), "h").select("s1_id", "target_id")


def truth(spark: SparkSession, d: str) -> DataFrame:
    s1 = raw_records(spark, d).filter("source = 'S1'").select(F.col("entity_id").alias("s1_id"))
    lists = truth_pairs(spark, d).groupBy("s1_id").agg(F.array_sort(F.collect_set("target_id")).alias("target_ids"))
    return s1.join(lists, "s1_id", "left").select("s1_id", F.coalesce("target_ids", F.array().cast("array<string>")).alias("target_ids"))


def scored(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("s1_id"), F.col("l_partkey").alias("target_id")).agg(F.round(F.max(F.col("l_discount") * 10), 6).alias("prob"))


def _norm(x: str) -> str:
    n = f"trim(regexp_replace(regexp_replace(regexp_replace(replace(lower({x}), 'ß', 'ss'), '[\\p{{Z}}\\t\\n,\\-/.&]', ' ', 'g'), '[^\\p{{L}}\\p{{N}}\\p{{Mn}}\\p{{Mc}} ]', '', 'g'), ' +', ' ', 'g'))"
    return f"CASE WHEN lower(trim({x})) IN ('', 'null', '<null>', 'none', 'nan') THEN '' ELSE {n} END"


VIEWS = f"""er AS (SELECT *, addr_norm = '' AS addr_empty, list_filter(string_split(name_norm, ' '), lambda x: x <> '') AS name_tokens, list_filter(string_split(addr_norm, ' '), lambda x: x <> '') AS addr_tokens,
              list_sort(list_distinct(list_filter(string_split(regexp_replace(addr_norm, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'), ' '), lambda x: regexp_full_match(x, '[0-9]+')))) AS addr_numbers,
              list_filter(string_split(regexp_replace(addr_norm, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'), ' '), lambda x: regexp_full_match(x, '[0-9]{{5,6}}'))[1] AS addr_postal FROM er1),
q AS (SELECT * FROM er WHERE source = 'S1'), t AS (SELECT * FROM er WHERE source <> 'S1')"""
ER = f"""
er0 AS (SELECT 'S' || (doc_id % 3 + 1) AS source, doc_id AS ordinal, upper(trim(lang)) AS country, split_part(text, chr(10), 1) AS business_name,
               substr(text, length(split_part(text, chr(10), 1)) + 2) AS business_address, text FROM documents),
er1 AS (SELECT *, source || '-' || ordinal AS entity_id, {_norm('business_name')} AS name_norm, {_norm('business_address')} AS addr_norm FROM er0),
{VIEWS},
tp AS (SELECT DISTINCT q.entity_id AS s1_id, t.entity_id AS target_id FROM q JOIN t ON md5(q.text) = md5(t.text)),
truth AS (SELECT q.entity_id AS s1_id, coalesce(list_sort(list(tp.target_id) FILTER (tp.target_id IS NOT NULL)), []) AS target_ids FROM q LEFT JOIN tp ON tp.s1_id = q.entity_id GROUP BY 1)
"""
JAC = "(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) ELSE 0 END)"


def _j(c: str) -> str:
    return JAC.format(a=f"q.{c}", b=f"t.{c}")


AGREE = f"(1.5 * {_j('name_tokens')} + 2.0 * {_j('addr_tokens')} + 2.5 * {_j('addr_numbers')} + CASE WHEN q.addr_postal = t.addr_postal THEN 2.0 ELSE 0 END)"


def _ranked(pairs: str, limit: int = 20) -> str:
    """pairs: SQL of (q_id, t_id)."""
    return f"""SELECT * FROM (SELECT q_id, source, t_id, agreement, CAST(row_number() OVER (PARTITION BY q_id, source ORDER BY agreement DESC, t_id) AS INTEGER) AS rank FROM (
      SELECT p.q_id, t.source, p.t_id, round({AGREE}, 9) AS agreement FROM ({pairs}) p JOIN q ON q.entity_id = p.q_id JOIN t ON t.entity_id = p.t_id)) WHERE rank <= {limit}"""


def _equal(column: str) -> str:
    return f"WITH {ER} " + _ranked(f"SELECT q.entity_id AS q_id, t.entity_id AS t_id FROM q JOIN t ON q.country = t.country AND q.{column} = t.{column} AND q.{column} <> ''")


def shown(d: DataFrame) -> DataFrame:
    return d.select("q_id", "source", "t_id", F.round("agreement", 9).alias("agreement"), "rank")


@query(f"WITH {ER} " + _ranked("""SELECT q.entity_id AS q_id, t.entity_id AS t_id FROM q JOIN t ON q.country = t.country AND q.name_norm = t.name_norm AND q.name_norm <> ''""") + "")
def exact_name_block(spark, d):
    return shown(B.equal(*sides(spark, d), "name_norm", K))


@query(f"WITH {ER} " + _ranked("SELECT q.entity_id AS q_id, t.entity_id AS t_id FROM q JOIN t ON q.country = t.country AND strip_accents(q.name_norm) = strip_accents(t.name_norm) AND q.name_norm <> ''"))
def folded_name_block(spark, d):
    return shown(B.equal(*sides(spark, d, "name_retrieval"), "name_retrieval", K))


_SUFFIX = "coalesce(list_contains([" + ", ".join(f"'{k}'" for k in X.SUFFIXES) + "], name_tokens[-{k}]), false)"
_ENDS = f"(CASE WHEN NOT {_SUFFIX.format(k=1)} THEN 0 WHEN NOT {_SUFFIX.format(k=2)} THEN 1 WHEN NOT {_SUFFIX.format(k=3)} THEN 2 ELSE 3 END)"
CORE = f"array_to_string(CASE WHEN {_ENDS} >= len(name_tokens) THEN name_tokens ELSE name_tokens[1:len(name_tokens) - {_ENDS}] END, ' ')"
CORES = f"qk AS (SELECT country, entity_id, {CORE} AS core FROM q), tk AS (SELECT country, entity_id, {CORE} AS core FROM t)"
CORE_PAIRS = "SELECT qk.entity_id AS q_id, tk.entity_id AS t_id FROM qk JOIN tk ON qk.country = tk.country AND qk.core = tk.core AND qk.core <> ''"


@query(f"WITH {ER}, {CORES} " + _ranked(CORE_PAIRS))
def core_name_block(spark, d):
    return shown(B.equal(*sides(spark, d, "name_core"), "name_core", K))


@query(_equal("addr_norm"))
def exact_addr_block(spark, d):
    return shown(B.equal(*sides(spark, d, "addr_norm"), "addr_norm", K))


RARE = """
df AS (SELECT country, source, key, count(*) AS df FROM (SELECT country, source, unnest(list_distinct(list_filter(name_tokens, lambda x: length(x) >= 4))) AS key FROM t) GROUP BY ALL),
nt AS (SELECT country, source, count(*) AS n FROM t GROUP BY ALL),
idf AS (SELECT df.*, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM df JOIN nt USING (country, source)),
rare AS (SELECT country, source, key, df, idf FROM (SELECT *, quantile_cont(idf, {p}) OVER (PARTITION BY country, source) AS cut FROM idf) WHERE idf >= cut - 1e-12 AND df BETWEEN 2 AND 100)
"""


@query(f"WITH {ER}, {RARE.format(p=0.05)} SELECT country, source, key, df, round(idf, 9) AS idf FROM rare")
def rare_idf_threshold(spark, d):
    return B.rare_keys(sides(spark, d)[1], 0.05).withColumn("idf", F.round("idf", 9))


@query(f"WITH {ER}, {RARE.format(p=0.05)} " + _ranked("""SELECT DISTINCT a.id AS q_id, b.id AS t_id FROM (SELECT country, entity_id AS id, unnest(list_distinct(name_tokens)) AS key FROM q) a
  JOIN (SELECT x.country, x.id, x.key FROM (SELECT country, source, entity_id AS id, unnest(list_distinct(name_tokens)) AS key FROM t) x JOIN rare USING (country, source, key)) b USING (country, key)"""))
def rare_token_block(spark, d):
    return shown(B.rare_token(*whole_sides(spark, d), K, 0.05))


ANCHOR = "list_distinct(list_filter(list_concat(addr_tokens[1:2], addr_tokens[-2:]), lambda x: length(x) >= 4 AND NOT regexp_full_match(x, '[0-9]+')))"


@query(f"""WITH {ER}, qa AS (SELECT country, entity_id AS id, unnest({ANCHOR}) AS key FROM q), ta AS (SELECT country, source, entity_id AS id, unnest({ANCHOR}) AS key FROM t),
  ok AS (SELECT country, source, key FROM ta GROUP BY ALL HAVING count(*) BETWEEN 2 AND 200) """ + _ranked("SELECT DISTINCT qa.id AS q_id, x.id AS t_id FROM qa JOIN (SELECT ta.* FROM ta JOIN ok USING (country, source, key)) x USING (country, key)"))
def address_anchor_block(spark, d):
    return shown(B.address_anchor(*sides(spark, d), K))


COMPOUND = "list_distinct(list_concat(flatten(list_transform(name_tokens[1:2], lambda a: list_transform(addr_numbers, lambda b: a || '|#' || b))), CASE WHEN addr_postal IS NULL THEN [] ELSE list_transform(name_tokens[1:2], lambda a: a || '|@' || addr_postal) END))"


@query(f"WITH {ER}, qc AS (SELECT country, entity_id AS id, unnest({COMPOUND}) AS key FROM q), tc AS (SELECT country, entity_id AS id, unnest({COMPOUND}) AS key FROM t) " + _ranked("SELECT DISTINCT qc.id AS q_id, tc.id AS t_id FROM qc JOIN tc USING (country, key)"))
def compound_block(spark, d):
    return shown(B.compound(*sides(spark, d), K))


def raw_parts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("entity_id"), F.when(F.col("p_partkey") % 2 == 1, "S1").otherwise("S2").alias("source"), F.lit("all").alias("country"),
                    F.col("p_name").alias("business_name"), F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string")).alias("business_address"))


def parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts as records: odd keys are queries, even keys targets of one source."""
    return prepare(raw_parts(spark, d))


def part_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Queries and targets among parts, equal ones once, and (rep, id) of all queries."""
    one, members = once(raw_parts(spark, d), max(B.limit_of(K), 3 * K, 12))
    p = prepare(one)
    return p.filter("source = 'S1'"), p.filter("source = 'S2'"), members


def for_all(found: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of each query for all its equals."""
    return found.withColumnRenamed("q_id", "rep").join(members, "rep").select(*(F.col("id").alias(c) if c == "q_id" else c for c in found.columns))


def _exact(limit: int, most: int) -> str:
    """Pairs of equal names under the policy for overfull buckets."""
    return f"""SELECT q_id, t_id FROM (SELECT *, bool_or(n > {limit} AND fine) OVER (PARTITION BY q_id, source) AS done FROM (
      SELECT q.entity_id AS q_id, t.entity_id AS t_id, t.source, t.n, len(list_intersect(q.addr_numbers, t.addr_numbers)) > 0 OR coalesce(q.addr_postal = t.addr_postal, false) AS fine
      FROM q JOIN (SELECT *, count(*) OVER (PARTITION BY country, source, name_norm) AS n FROM t) t ON q.country = t.country AND q.name_norm = t.name_norm AND q.name_norm <> ''))
      WHERE n <= {limit} OR fine OR (n <= {most} AND NOT done)"""


PARTS = f"""er1 AS (SELECT 'P-' || p_partkey AS entity_id, CASE WHEN p_partkey % 2 = 1 THEN 'S1' ELSE 'S2' END AS source, 'ALL' AS country, {_norm('p_name')} AS name_norm,
  {_norm("p_brand || ' ' || p_type || ' ' || p_size")} AS addr_norm FROM part), {VIEWS}"""


@query(f"WITH {PARTS} " + _ranked(_exact(15, 15), 15))
def bucket_overflow_policy(spark, d):
    p = parts(spark, d)
    return shown(B.exact_name(p.filter("source = 'S1'"), p.filter("source = 'S2'"), K, 15))


GRAMS = """list_concat(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3)), CASE WHEN length(w) > 1 THEN list_transform(range(1, length(w)), lambda i: substr(' ' || w || ' ', i, 4)) ELSE [] END)"""


@query(f"""WITH {PARTS}, tx AS (SELECT DISTINCT source, name_norm AS id FROM er1), wd AS (SELECT source, id, unnest(list_filter(string_split(id, ' '), lambda x: x <> '')) AS w FROM tx),
   tf AS (SELECT source, id, g, 1 + ln(count(*)) AS tf FROM (SELECT source, id, unnest({GRAMS}) AS g FROM wd) GROUP BY ALL), df AS (SELECT g, count(*) AS df FROM tf WHERE source = 'S2' GROUP BY 1),
   wt AS (SELECT source, id, g, tf * (ln((1 + (SELECT count(*) FROM tx WHERE source = 'S2'))::DOUBLE / (1 + coalesce(df, 0))) + 1) AS w FROM tf LEFT JOIN df USING (g)),
   un AS (SELECT source, id, g, w / sqrt(sum(w * w) OVER (PARTITION BY source, id)) AS w FROM wt),
   sc AS (SELECT a.id AS q_id, b.source, b.id AS t_id, sum(a.w * b.w) AS score FROM un a JOIN un b ON a.g = b.g AND a.source = 'S1' AND b.source = 'S2' GROUP BY ALL HAVING sum(a.w * b.w) > 0.12),
   rk AS (SELECT q_id, source, t_id, round(score, 9) AS score, CAST(row_number() OVER (PARTITION BY q_id ORDER BY round(score, 9) DESC, t_id) AS INTEGER) AS rank FROM sc) SELECT * FROM rk WHERE rank <= 15""")
def tfidf_topn_join(spark, d):
    p = parts(spark, d).select("source", "country", F.col("name_norm").alias("id"), F.col("name_norm").alias("text")).distinct()
    return B.similar(p.filter("source = 'S1'").drop("source"), p.filter("source = 'S2'"), 15).withColumn("score", F.round("score", 9))


@query("""SELECT name, array_to_string(list_sort(list_distinct(flatten(list_transform(list_filter(string_split(name, ' '), lambda x: x <> ''), lambda w:
   list_concat(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3)), CASE WHEN length(w) + 2 > 3 THEN list_transform(range(1, length(w)), lambda i: substr(' ' || w || ' ', i, 4)) ELSE [] END))))), '|') AS grams
   FROM (SELECT DISTINCT lower(p_name) AS name FROM part)""")
def char_ngrams(spark, d):
    p = table(spark, d, "part").select(F.lower("p_name").alias("name")).distinct()
    grams = F.array_sort(F.array_distinct(X.char_ngrams(F.col("name"))))
    return p.select("name", F.array_join(grams, "|").alias("grams"))


def candidate_rows(spark: SparkSession, d: str) -> DataFrame:
    """Candidates by the equality, rare-token, anchor and compound channels, from cells; the similarity channel has a query of its own."""
    return B.top_k(B.with_score(key_candidates(*whole_sides(spark, d), K, B.limit_of(K), 0.05)), K)


_CHANNELS = {
    "exact_name": _exact(20, 100), "folded_name": "SELECT q.entity_id AS q_id, t.entity_id AS t_id FROM q JOIN t ON q.country = t.country AND strip_accents(q.name_norm) = strip_accents(t.name_norm) AND q.name_norm <> ''",
    "core_name": CORE_PAIRS, "exact_addr": "SELECT q.entity_id AS q_id, t.entity_id AS t_id FROM q JOIN t ON q.country = t.country AND q.addr_norm = t.addr_norm AND q.addr_norm <> ''",
    "rare_token": """SELECT DISTINCT a.id AS q_id, b.id AS t_id FROM (SELECT country, entity_id AS id, unnest(list_distinct(name_tokens)) AS key FROM q) a
      JOIN (SELECT x.country, x.id, x.key FROM (SELECT country, source, entity_id AS id, unnest(list_distinct(name_tokens)) AS key FROM t) x JOIN rare USING (country, source, key)) b USING (country, key)""",
    "address_anchor": "SELECT DISTINCT qa.id AS q_id, x.id AS t_id FROM qa JOIN (SELECT ta.* FROM ta JOIN ok USING (country, source, key)) x USING (country, key)",
    "compound": "SELECT DISTINCT qc.id AS q_id, tc.id AS t_id FROM qc JOIN tc USING (country, key)",
}
TOP = f"""{ER}, {CORES}, {RARE.format(p=0.05)}, qa AS (SELECT country, entity_id AS id, unnest({ANCHOR}) AS key FROM q), ta AS (SELECT country, source, entity_id AS id, unnest({ANCHOR}) AS key FROM t),
  ok AS (SELECT country, source, key FROM ta GROUP BY ALL HAVING count(*) BETWEEN 2 AND 200),
  qc AS (SELECT country, entity_id AS id, unnest({COMPOUND}) AS key FROM q), tc AS (SELECT country, entity_id AS id, unnest({COMPOUND}) AS key FROM t),
  ch AS ({" UNION ALL ".join(f"SELECT q_id, source, t_id, '{name}' AS channel, rank FROM ({_ranked(sql)})" for name, sql in _CHANNELS.items())}),
  mg AS (SELECT q_id, source, t_id, list_sort(list(DISTINCT channel)) AS channels, min(rank) AS best_rank, max((channel = 'exact_name')::INT) AS en, max((channel = 'exact_addr')::INT) AS ea, max((channel = 'rare_token')::INT) AS rt, max((channel = 'address_anchor')::INT) AS aa FROM ch GROUP BY 1, 2, 3),
  ev AS (SELECT mg.*, {_j("addr_numbers")} AS no, CASE WHEN q.addr_empty OR t.addr_empty THEN 0.0 ELSE {JAC.format(a="string_split(strip_accents(q.addr_norm), ' ')", b="string_split(strip_accents(t.addr_norm), ' ')")} END AS ad FROM mg JOIN q ON q.entity_id = q_id JOIN t ON t.entity_id = t_id),
  sc AS (SELECT *, round((4.0 * en + 3.0 * ea + 1.5 * rt + 1.8 * aa)::DOUBLE + 2.0 * ad + 1.5 * no + (0.15 * len(channels))::DOUBLE + 0.05::DOUBLE / greatest(best_rank, 1), 9) AS cand_score FROM ev),
  top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id, source ORDER BY cand_score DESC, t_id) AS rn FROM sc) WHERE rn <= {K})"""


def _balanced(budget: int) -> str:
    return f"""i1 AS (SELECT *, rn <= CASE WHEN source = 'S2' THEN {(budget + 1) // 2} ELSE {budget // 2} END AS own FROM top),
  i2 AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY own DESC, cand_score DESC, t_id) AS place FROM i1),
  bal AS (SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY cand_score DESC, t_id) AS INTEGER) AS rank FROM i2 WHERE place <= {budget})"""


@query(f"WITH {TOP} SELECT q_id, source, t_id, array_to_string(channels, ',') AS channels, best_rank, round(cand_score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM top")
def candidate_topk(spark, d):
    c = candidate_rows(spark, d)
    return c.select("q_id", "source", "t_id", F.array_join("channels", ",").alias("channels"), "best_rank", F.round("cand_score", 6).alias("score"), F.col("rn").alias("rank"))


@query(f"WITH {TOP}, {_balanced(BUDGET)} SELECT q_id, source, t_id, rank, round(cand_score, 6) AS score FROM bal")
def balanced_merge(spark, d):
    return B.balanced(candidate_rows(spark, d), BUDGET).select("q_id", "source", "t_id", "rank", F.round("cand_score", 6).alias("score"))


@query()
def all_channels(spark, d):
    q, t, members = part_sides(spark, d)
    return for_all(B.candidates(q, t, K, 0.05).select("q_id", "t_id", F.array_join("channels", ",").alias("channels"), "rn"), members)


def exact_lists(spark: SparkSession, d: str) -> DataFrame:
    return B.equal(*sides(spark, d), "name_norm", K).groupBy(F.col("q_id").alias("s1_id")).agg(F.array_sort(F.collect_set("t_id")).alias("ids"))


LISTS = f"rk AS ({_ranked('SELECT q.entity_id AS q_id, t.entity_id AS t_id FROM q JOIN t ON q.country = t.country AND q.name_norm = t.name_norm AND q.name_norm <> {e}'.format(e=chr(39) * 2))}), lists AS (SELECT q_id AS s1_id, list_sort(list(t_id)) AS ids FROM rk GROUP BY 1), al AS (SELECT truth.*, coalesce(ids, []) AS ids, len(list_intersect(target_ids, coalesce(ids, []))) AS tp FROM truth LEFT JOIN lists USING (s1_id))"
FB = "CASE WHEN len(target_ids) = 0 AND {n} = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 5.0 * tp / (5.0 * tp + 4.0 * ({n} - tp) + len(target_ids) - tp) END"


@query(f"WITH {ER}, {LISTS} SELECT round(avg({FB.format(n='len(ids)')}), 9) AS macro_f05 FROM al")
def macro_f05(spark, d):
    return metrics.macro_f_half(truth(spark, d), exact_lists(spark, d))


def _recall(s: str) -> str:
    return f"round(coalesce(sum(len(list_filter(list_intersect(target_ids, ids), lambda x: x LIKE '{s}%')))::DOUBLE / nullif(sum(len(list_filter(target_ids, lambda x: x LIKE '{s}%'))), 0), 1.0), 9)"


def _pick(p: float) -> str:
    return f"CAST(list_sort(list(len(ids)))[CAST(least(floor({p} * count(*)), count(*) - 1) AS BIGINT) + 1] AS INTEGER)"


@query(f"""WITH {ER}, {LISTS} SELECT {_recall('S')} AS pair_recall, {_recall('S2')} AS s2_recall, {_recall('S3')} AS s3_recall, round(avg((tp = len(target_ids))::INT), 9) AS complete_recall,
   round(avg({FB.format(n='tp')}), 9) AS oracle_f05, round(avg(len(ids)), 9) AS mean_candidates, CAST(max(len(ids)) AS BIGINT) AS max_candidates, CAST(sum(len(ids)) AS BIGINT) AS total_candidates,
   {_pick(0.5)} AS median_candidates, {_pick(0.95)} AS p95_candidates, {_pick(0.99)} AS p99_candidates FROM al""")
def blocking_report(spark, d):
    return metrics.blocking_report(truth(spark, d), exact_lists(spark, d))


@query(f"""WITH {TOP}, {_balanced(25)}, ks AS (SELECT unnest([1, 2, 3, 4, 6, 8]) AS k),
   c AS (SELECT k, q_id AS s1_id, count(*) AS n_cand, count(tp.s1_id) AS hits FROM bal JOIN ks ON rank <= k LEFT JOIN tp ON tp.s1_id = q_id AND target_id = t_id GROUP BY 1, 2),
   e AS (SELECT ks.k, len(target_ids) AS n, coalesce(n_cand, 0) AS n_cand, coalesce(hits, 0) AS tp FROM truth CROSS JOIN ks LEFT JOIN c ON c.k = ks.k AND c.s1_id = truth.s1_id),
   g AS (SELECT CAST(k AS INTEGER) AS k, round(sum(tp) / sum(n), 9) AS pair_recall, round(avg((tp = n)::INT), 9) AS complete_recall, round(avg(CASE WHEN n = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 5.0 * tp / (4.0 * tp + n) END), 9) AS oracle_f05,
     round(quantile_cont(n_cand, 0.95), 9) AS p95_candidates FROM e GROUP BY 1)
   SELECT *, round(oracle_f05 - lag(oracle_f05) OVER (ORDER BY k), 9) AS delta, k = (SELECT min(k) FROM g WHERE oracle_f05 >= 0.995 * (SELECT max(oracle_f05) FROM g)) AS recommended FROM g""")
def pareto_by_k(spark, d):
    ranked = B.balanced(candidate_rows(spark, d), 25).select(F.col("q_id").alias("s1_id"), F.col("t_id").alias("target_id"), "rank")
    return metrics.pareto(truth(spark, d), ranked, [1, 2, 3, 4, 6, 8])


SCORED = "s AS (SELECT l_orderkey AS s1_id, l_partkey AS target_id, round(max(l_discount * 10), 6) AS prob FROM lineitem GROUP BY ALL)"
WON = SCORED + ", w AS (SELECT s1_id, target_id, prob FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY prob DESC, s1_id) AS n FROM s WHERE prob >= 0.5) WHERE n = 1)"


@query(f"WITH {WON} SELECT * FROM w")
def exclusive_decode(spark, d):
    return decode.exclusive(scored(spark, d), 0.5)


@query(f"WITH {SCORED} SELECT * FROM s WHERE prob >= 0.5")
def nonexclusive_decode(spark, d):
    return decode.nonexclusive(scored(spark, d), 0.5)


@query(f"WITH {WON} SELECT o_orderkey AS s1_id, coalesce(string_agg(target_id::VARCHAR, ',' ORDER BY target_id::VARCHAR), '') AS matched_entity_ids FROM orders LEFT JOIN w ON s1_id = o_orderkey GROUP BY 1")
def complete_output(spark, d):
    s1 = table(spark, d, "orders").select(F.col("o_orderkey").alias("s1_id"))
    return decode.complete(s1, decode.exclusive(scored(spark, d), 0.5))


GOLD = "SELECT l_orderkey AS s1_id, list(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS g FROM lineitem GROUP BY 1"


@query(f"""WITH {SCORED}, gold AS (SELECT s1_id, coalesce(g, []) AS g FROM ({GOLD})), h AS (SELECT i * 0.1 AS threshold FROM range(0, 10) x(i)), pol AS (SELECT unnest([true, false]) AS exclusive),
  w AS (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY prob DESC, s1_id) = 1 AS won FROM s),
  p AS (SELECT exclusive, round(threshold, 1) AS threshold, s1_id, count(*) AS n, count(*) FILTER (list_contains(g, target_id)) AS tp FROM w JOIN gold USING (s1_id) JOIN h ON prob >= round(threshold, 1) JOIN pol ON (NOT exclusive OR won) GROUP BY ALL),
  f AS (SELECT pol.exclusive, round(h.threshold, 1) AS threshold, CASE WHEN coalesce(n, 0) = 0 AND len(g) = 0 THEN 1.0 WHEN coalesce(tp, 0) = 0 THEN 0.0 ELSE 5.0 * tp / (5.0 * tp + 4.0 * (n - tp) + len(g) - tp) END AS v
        FROM gold, h, pol LEFT JOIN p ON p.s1_id = gold.s1_id AND p.threshold = round(h.threshold, 1) AND p.exclusive = pol.exclusive)
  SELECT exclusive, CAST(threshold AS DOUBLE) AS threshold, round(avg(v), 9) AS macro_f05 FROM f GROUP BY ALL""")
def threshold_sweep(spark, d):
    gold = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("s1_id")).agg(F.collect_set(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("target_ids"))
    return decode.sweep(scored(spark, d), gold, [round(i * 0.1, 1) for i in range(10)])


@query(f"WITH {ER}, rk AS ({_ranked('SELECT q.entity_id AS q_id, t.entity_id AS t_id FROM q JOIN t ON q.country = t.country AND q.addr_norm = t.addr_norm AND q.addr_norm <> {e}'.format(e=chr(39) * 2))}), l AS (SELECT q_id AS s1_id, t_id AS target_id, rank, CAST(tp.s1_id IS NOT NULL AS INTEGER) AS label FROM rk LEFT JOIN tp ON tp.s1_id = q_id AND tp.target_id = t_id) SELECT s1_id, target_id, rank, label FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, label ORDER BY rank, target_id) AS n FROM l) WHERE label = 1 OR n <= 2")
def hard_negatives(spark, d):
    c = B.equal(*sides(spark, d, "addr_norm"), "addr_norm", K).select(F.col("q_id").alias("s1_id"), F.col("t_id").alias("target_id"), "rank")
    return training.training_pairs(c, truth_pairs(spark, d), 2)


@query(f"""WITH {ER}, x AS (SELECT unnest([{{'kind': 'all', 'm': len(target_ids)}}, {{'kind': CASE WHEN len(target_ids) > 0 THEN 'nonsingleton' END, 'm': len(target_ids)}}, {{'kind': 'S2', 'm': len(list_filter(target_ids, lambda i: i LIKE 'S2%'))}},
   {{'kind': 'S3', 'm': len(list_filter(target_ids, lambda i: i LIKE 'S3%'))}}], recursive := true) FROM truth)
   SELECT kind, count(*) AS n, CAST(min(m) AS BIGINT) AS least, CAST(max(m) AS BIGINT) AS most, round(avg(m), 9) AS mean, CAST(list_sort(list(m))[CAST(least(floor(0.5 * count(*)), count(*) - 1) AS BIGINT) + 1] AS INTEGER) AS median,
   CAST(list_sort(list(m))[CAST(least(floor(0.95 * count(*)), count(*) - 1) AS BIGINT) + 1] AS INTEGER) AS p95 FROM x WHERE kind IS NOT NULL GROUP BY kind""")
def match_distribution(spark, d):
    return profile.match_distribution(truth(spark, d))


@query(f"WITH {ER} SELECT CAST(len(target_ids) AS INTEGER) AS matches, count(*) AS n FROM truth GROUP BY 1 ORDER BY n DESC, matches LIMIT 15")
def match_histogram(spark, d):
    return profile.histogram(truth(spark, d))


@query(f"WITH {ER} SELECT count(*) FILTER (a > 0) AS targets, CAST(coalesce(sum(a), 0) AS BIGINT) AS again FROM (SELECT count(DISTINCT s1_id) - 1 AS a FROM tp GROUP BY target_id)")
def multi_link(spark, d):
    return profile.multi_link(truth_pairs(spark, d))


@query(f"WITH {ER}, h AS (SELECT len(list_filter(target_ids, lambda i: i LIKE 'S2%')) > 0 AS a, len(list_filter(target_ids, lambda i: i LIKE 'S3%')) > 0 AS b FROM truth) SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 'only_s2' WHEN b THEN 'only_s3' ELSE 'neither' END AS coverage, count(*) AS n FROM h GROUP BY 1")
def coverage_classes(spark, d):
    return profile.coverage_classes(truth(spark, d))


@query(f"WITH {ER} SELECT source, country, count(*) AS n, count(*) FILTER (addr_empty) AS n_empty, round(avg(addr_empty::INT), 9) AS empty_rate FROM er GROUP BY ALL")
def empty_rate(spark, d):
    return profile.empty_rate(records(spark, d))


_INDIC = "[\\x{900}-\\x{D7F}]"


@query("SELECT lang AS country, 'Latin' AS script, count(*) AS n, count(*) FILTER (regexp_matches(text, '" + _INDIC + "')) AS n_indic, "
       + ", ".join(f"count(*) FILTER (regexp_matches(text, '[\\x{{{a:x}}}-\\x{{{b:x}}}]')) AS any_{k.lower()}" for k, (a, b) in X.INDIC.items()) + " FROM documents GROUP BY 1")
def script_profile(spark, d):
    return profile.script_profile(raw_records(spark, d), F.col("text"), "country")


def token_pairs(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d).select("entity_id", "name_tokens")
    return truth_pairs(spark, d).join(r.select(F.col("entity_id").alias("target_id"), F.col("name_tokens").alias("a")), "target_id").join(r.select(F.col("entity_id").alias("s1_id"), F.col("name_tokens").alias("b")), "s1_id")


TOKENS = "pr AS (SELECT t.name_tokens AS a, q.name_tokens AS b FROM tp JOIN t ON t.entity_id = target_id JOIN q ON q.entity_id = s1_id)"
BEST = ", tot AS (SELECT l, sum(n) AS total FROM c GROUP BY 1), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l ORDER BY n DESC, r) AS k FROM c) WHERE k = 1) SELECT l AS token, r AS translation, n, CAST(total AS BIGINT) AS total FROM b JOIN tot USING (l) WHERE total >= {least} AND n::DOUBLE / total >= {share}"


@query(f"WITH {ER}, {TOKENS}, c AS (SELECT l, r, count(*) AS n FROM (SELECT l, unnest(list_distinct(b)) AS r FROM (SELECT unnest(list_distinct(a)) AS l, b FROM pr)) GROUP BY ALL)" + BEST.format(least=2, share=0.5))
def cooccurrence_dictionary(spark, d):
    return mining.cooccurrence(token_pairs(spark, d), 2, 0.5)


POSITIONAL = f"{TOKENS}, c AS (SELECT l, r, count(*) AS n FROM (SELECT unnest(a) AS l, unnest(b) AS r FROM pr WHERE len(a) = len(b)) GROUP BY ALL)"


@query(f"WITH {ER}, {POSITIONAL}" + BEST.format(least=3, share=0.75))
def positional_dictionary(spark, d):
    return mining.positional(token_pairs(spark, d))


@query(f"WITH {ER}, {POSITIONAL}, dict AS (SELECT token FROM ({'WITH z AS (SELECT 1)' + BEST.format(least=3, share=0.75)})), e AS (SELECT entity_id, unnest(name_tokens) AS token FROM er), g AS (SELECT entity_id, count(*) AS n, count(dict.token) AS k FROM e LEFT JOIN dict USING (token) GROUP BY 1) SELECT CASE WHEN k = n THEN 'full' WHEN k > 0 THEN 'partial' ELSE 'none' END AS coverage, count(*) AS n FROM g GROUP BY 1")
def dictionary_coverage(spark, d):
    return mining.coverage(records(spark, d), F.col("name_tokens"), mining.positional(token_pairs(spark, d)))


@query(f"WITH {ER}, x AS (SELECT DISTINCT q.entity_id FROM q JOIN t ON q.country = t.country AND q.addr_norm = t.addr_norm AND q.addr_norm <> '') SELECT entity_id FROM q WHERE entity_id NOT IN (SELECT entity_id FROM x)")
def coverage_antijoin(spark, d):
    q, t = sides(spark, d, "addr_norm")
    return q.join(B.equal(q, t, "addr_norm", K).select(F.col("q_id").alias("entity_id")), "entity_id", "left_anti").select("entity_id")


@query(f"WITH {ER} SELECT entity_id, source FROM t WHERE entity_id IN (SELECT target_id FROM tp)")
def semi_filter(spark, d):
    return raw_records(spark, d).filter("source <> 'S1'").join(truth_pairs(spark, d).select(F.col("target_id").alias("entity_id")), "entity_id", "left_semi").select("entity_id", "source")


@query(f"WITH {ER} SELECT count(*) AS pairs, count(*) FILTER (q.country <> t.country) AS crossing FROM tp JOIN q ON q.entity_id = s1_id JOIN t ON t.entity_id = target_id")
def cross_label_pairs(spark, d):
    r = raw_records(spark, d)
    a, b = r.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("ca")), r.select(F.col("entity_id").alias("target_id"), F.col("country").alias("cb"))
    return truth_pairs(spark, d).join(a, "s1_id").join(b, "target_id").agg(F.count("*").alias("pairs"), F.count_if(F.col("ca") != F.col("cb")).alias("crossing"))


@query(f"""WITH {ER}, {LISTS}, sh AS (SELECT s1_id, row_number() OVER (ORDER BY s1_id) AS o, ids AS c, target_ids AS p FROM al)
   SELECT s1_id AS key, 'predictions_are_candidates' AS rule FROM sh WHERE len(list_filter(p, lambda x: NOT list_contains(c, x))) > 0
   UNION ALL SELECT * FROM (SELECT '' AS key, 'ordinals_contiguous' AS rule FROM q HAVING max(ordinal) - min(ordinal) + 1 <> count(DISTINCT ordinal))""")
def contract_violations(spark, d):
    gold = truth(spark, d).select("s1_id", F.col("target_ids").alias("prediction_ids"))
    rows = gold.join(exact_lists(spark, d).withColumnRenamed("ids", "candidate_ids"), "s1_id", "left").withColumn("candidate_ids", F.coalesce("candidate_ids", F.array().cast("array<string>")))
    o = raw_records(spark, d).select(F.col("entity_id").alias("s1_id"), "ordinal")
    return contracts.shard_rows(rows.join(o, "s1_id"))


@query(f"WITH {ER} SELECT entity_id, CAST(('0x' || substr(md5(entity_id), 1, 8))::BIGINT % 100 AS INTEGER) AS share FROM q")
def entity_split(spark, d):
    return raw_records(spark, d).filter("source = 'S1'").select("entity_id", training.split_share(F.col("entity_id")).alias("share"))


@query(f"WITH {ER} SELECT entity_id, name_norm, addr_norm, strip_accents(name_norm) AS name_folded, replace(name_norm, ' ', '') AS name_compact, CAST(len(name_tokens) AS INTEGER) AS n_tokens, addr_empty FROM er")
def text_views(spark, d):
    return records(spark, d).select("entity_id", "name_norm", "addr_norm", "name_folded", "name_compact", F.size("name_tokens").alias("n_tokens"), "addr_empty")


@query(f"WITH {ER} SELECT entity_id, array_to_string(addr_numbers, ',') AS numbers, addr_postal FROM er")
def address_numbers_postal(spark, d):
    return records(spark, d).select("entity_id", F.array_join("addr_numbers", ",").alias("numbers"), "addr_postal")


@query("SELECT s_suppkey, s_name || ' co ltd' AS name, s_name AS core, 'company limited' AS suffix FROM supplier")
def legal_suffix_split(spark, d):
    n = F.concat("s_name", F.lit(" co ltd"))
    return table(spark, d, "supplier").select("s_suppkey", n.alias("name"), X.core_and_suffix(n).alias("x")).select("s_suppkey", "name", "x.core", "x.suffix")


@query(f"WITH {ER} SELECT q.entity_id AS q_id, t.entity_id AS t_id, round({AGREE}, 9) AS agreement FROM q JOIN t ON q.country = t.country AND q.name_norm = t.name_norm AND q.name_norm <> ''")
def secondary_agreement(spark, d):
    q, t = whole_sides(spark, d)  # bucket sizes need names only, and the rest is read once
    return B.all_equal(q, t, "name_norm").select("q_id", "t_id", "agreement")


def name_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of distinct part names that share a word: a key join, not all pairs."""
    n = table(spark, d, "part").select("p_name").distinct().select("p_name", F.explode(F.split("p_name", " ")).alias("w"))
    return n.select(F.col("p_name").alias("a"), "w").join(n.select(F.col("p_name").alias("b"), "w"), "w").filter("a < b").select("a", "b").distinct()


NAMES = "n AS (SELECT DISTINCT p_name, unnest(string_split(p_name, ' ')) AS w FROM part), np AS (SELECT DISTINCT x.p_name AS a, y.p_name AS b FROM n x JOIN n y USING (w) WHERE x.p_name < y.p_name)"


@query(f"WITH {NAMES} SELECT a, b, round(jaro_winkler_similarity(a, b), 9) AS jw FROM np")
def jaro_winkler_pairs(spark, d):
    return name_pairs(spark, d).select("a", "b", F.round(S.jaro_winkler_udf("a", "b"), 9).alias("jw"))


@query()
def fuzzy_ratio_family(spark, d):
    r = lambda f: F.round(f("a", "b"), 9)
    return name_pairs(spark, d).select("a", "b", r(S.ratio_udf).alias("ratio"), r(S.sort_ratio_udf).alias("sort"), r(S.set_ratio_udf).alias("set"), r(S.partial_ratio_udf).alias("partial"))


_STANDARD = "map_extract(MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in X.SUFFIXES.items()) + "}, name_tokens[-{k}])[1]"
_FORMS = ", ".join(f"CASE WHEN {_ENDS} >= {k} THEN {_STANDARD.replace('{k}', str(k))} END" for k in (3, 2, 1))
_PAIR = {
    "name_len_ratio": "coalesce(least(length(a.name_norm), length(b.name_norm))::DOUBLE / nullif(greatest(length(a.name_norm), length(b.name_norm)), 0), 0)", "name_exact": "a.name_norm <> '' AND a.name_norm = b.name_norm",
    "name_folded_exact": "a.folded <> '' AND a.folded = b.folded", "suffix_match": "a.suffix <> '' AND a.suffix = b.suffix", "suffix_mismatch": "a.suffix <> '' AND b.suffix <> '' AND a.suffix <> b.suffix", "first_tok_match": "coalesce(a.name_tokens[1] = b.name_tokens[1], false)",
    "is_cross_script": "false", "either_addr_empty": "a.addr_empty OR b.addr_empty", "both_addr_empty": "a.addr_empty AND b.addr_empty", "addr_exact": "w AND a.addr_norm = b.addr_norm", "num_match": "w AND shared", "num_any_overlap": "w AND shared",
    "num_exact_set": "w AND nums AND a.addr_numbers = b.addr_numbers", "num_jaccard": f"CASE WHEN w THEN {JAC.format(a='a.addr_numbers', b='b.addr_numbers')} ELSE 0 END", "num_conflict": "w AND nums AND a.addr_numbers <> b.addr_numbers",
    "post_match": "w AND coalesce(a.addr_postal = b.addr_postal, false)", "post_conflict": "w AND coalesce(a.addr_postal <> b.addr_postal, false)", "is_s2": "top.source = 'S2'", "channel_count": "len(channels)", "exact_name_hit": "en", "exact_addr_hit": "ea", "rare_token_hit": "rt",
    "address_anchor_hit": "aa", "tfidf_name_score": "0", "tfidf_addr_score": "ad", "reciprocal_rank": "1.0::DOUBLE / (best_rank + 1)",
}


@query(f"""WITH {TOP}, fr AS (SELECT *, strip_accents(name_norm) AS folded, array_to_string(list_filter([{_FORMS}], lambda x: x IS NOT NULL), ' ') AS suffix FROM er)
   SELECT q_id, t_id, top.source, {", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in _PAIR.items())}
   FROM top JOIN fr a ON a.entity_id = q_id JOIN fr b ON b.entity_id = t_id, LATERAL (SELECT NOT a.addr_empty AND NOT b.addr_empty AS w, len(a.addr_numbers) > 0 AND len(b.addr_numbers) > 0 AS nums, len(list_intersect(a.addr_numbers, b.addr_numbers)) > 0 AS shared)""")
def pair_features_boolean(spark, d):
    q, t = whole_sides(spark, d)
    return features.pair_features(candidate_rows(spark, d), q, t, strings=False)


@query()
def pair_features_full(spark, d):
    q, t, members = part_sides(spark, d)
    c = save(B.candidates(q, t, K, 0.05))  # their shuffle files go before the texts are joined
    return for_all(features.pair_features(c, q, t), members)


@query()
def gbt_match(spark, d):
    q, t = whole_sides(spark, d)
    c = save(candidate_rows(spark, d))  # their shuffle files go before the texts are joined
    gold = truth_pairs(spark, d).select(F.col("s1_id").alias("q_id"), F.col("target_id").alias("t_id"), F.lit(1).alias("label")).distinct()
    labelled = features.pair_features(c, q, t).join(gold, ["q_id", "t_id"], "left").fillna(0, ["label"])
    labelled = save(labelled, batch=500)  # each pass of the training reads it
    model = training.fit(labelled, features.FEATURES, trees=10, depth=4, least=5)
    return training.predict(model, labelled, features.FEATURES).select("q_id", "t_id", "label", F.round("prob", 6).alias("prob"))


@query(f"WITH {ER}, c AS (SELECT unnest([{{'source': 'S2', 'matches': len(list_filter(target_ids, lambda i: i LIKE 'S2%'))}}, {{'source': 'S3', 'matches': len(list_filter(target_ids, lambda i: i LIKE 'S3%'))}}], recursive := true) FROM truth) SELECT source, CAST(matches AS INTEGER) AS matches, count(*) AS n FROM c GROUP BY ALL")
def source_histograms(spark, d):
    return profile.source_histograms(truth(spark, d))


@query(f"WITH {ER} SELECT source, country, count(*) AS matched, count(*) FILTER (addr_empty) AS n_empty FROM t WHERE entity_id IN (SELECT target_id FROM tp) GROUP BY ALL")
def empty_among_matches(spark, d):
    return profile.empty_among_matches(records(spark, d, "addr_empty").filter("source <> 'S1'"), truth_pairs(spark, d))


@query(f"WITH {ER} SELECT count(*) AS queries, count(*) FILTER (len(target_ids) > 0) AS with_match, CAST(sum(len(target_ids)) AS BIGINT) AS matches, round(avg(len(target_ids)), 9) AS mean_matches FROM truth")
def run_summary(spark, d):
    return profile.run_summary(truth(spark, d).withColumnRenamed("target_ids", "ids"))


@query(f"WITH {ER}, k AS (SELECT *, {CORE} AS core, strip_accents(name_norm) AS folded FROM er) SELECT entity_id, array_to_string(CASE WHEN core = name_norm THEN [] ELSE [core] END || CASE WHEN name_norm = '' THEN [] ELSE [name_norm] END || CASE WHEN folded = name_norm OR folded = core THEN [] ELSE [folded] END, ' ') AS name_view, strip_accents(addr_norm) AS address_view FROM k")
def retrieval_views(spark, d):
    c = F.col
    r = records(spark, d, "name_norm", "name_core", "name_folded", "name_translit", "addr_folded", "addr_norm")
    return r.select("entity_id", X.name_view(c("name_core"), c("name_norm"), c("name_folded"), c("name_translit")).alias("name_view"), X.address_view(c("addr_folded"), c("addr_norm")).alias("address_view"))


@query("""SELECT doc_id, CASE WHEN lower(text) IN ('', 'null', '<null>', 'none') THEN '' ELSE trim(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\p{N}\\p{Mn}\\p{Mc}\\p{Zs}]', '', 'g'), '\\p{Zs}+', ' ', 'g')) END AS older_norm FROM documents""")
def older_normalised(spark, d):
    return table(spark, d, "documents").select("doc_id", X.deleted_punctuation(F.col("text")).alias("older_norm"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '[A-z]') THEN 'Latin' ELSE 'Unknown' END AS script FROM documents")
def script_by_ranges(spark, d):
    return table(spark, d, "documents").select("doc_id", X.range_script(F.col("text")).alias("script"))


@query("SELECT c.entity_id AS key, 'sources_disjoint' AS rule FROM (SELECT o_custkey::VARCHAR AS entity_id FROM orders GROUP BY 1) c JOIN (SELECT l_suppkey::VARCHAR AS entity_id FROM lineitem GROUP BY 1) l USING (entity_id)")
def source_overlap(spark, d):
    return contracts.overlap(table(spark, d, "orders").select(F.col("o_custkey").alias("entity_id")), table(spark, d, "lineitem").select(F.col("l_suppkey").alias("entity_id")))


@query("SELECT CAST(floor(o_orderkey / 1000) AS BIGINT) AS shard, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders GROUP BY 1")
def query_shards(spark, d):
    return table(spark, d, "orders").groupBy(B.shard(F.col("o_orderkey"), 1000).alias("shard")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query(f"""WITH {PARTS}, s AS (SELECT country, source, name_norm, count(*) AS n FROM t WHERE name_norm <> '' GROUP BY ALL HAVING count(*) > 15),
   x AS (SELECT q.entity_id, s.country, s.source, s.name_norm, EXISTS (SELECT 1 FROM t WHERE t.country = s.country AND t.source = s.source AND t.name_norm = s.name_norm AND (len(list_intersect(q.addr_numbers, t.addr_numbers)) > 0 OR coalesce(q.addr_postal = t.addr_postal, false))) AS kept
         FROM q JOIN s ON s.country = q.country AND s.name_norm = q.name_norm)
   SELECT country, source, count(DISTINCT name_norm) AS n_buckets, count(*) AS n_queries FROM x WHERE NOT kept GROUP BY ALL""")
def bucket_overflow_counts(spark, d):
    p = parts(spark, d)
    return B.overflow(p.filter("source = 'S1'"), p.filter("source = 'S2'"), K, 15)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
