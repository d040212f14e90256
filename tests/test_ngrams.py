"""The similarity channel in cells against cosines worked out one by one, and candidates of all channels against the channels one by one."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from lakelink.functions import text as X
from lakelink.operators import blocking as B
from lakelink.operators import ngrams

from test_candidates import sides
from test_cells import rows


def plain(q, t, top, threshold):
    out = set()
    for country, source in {(c, s) for c, s, _, _ in t}:
        own = [(i, Counter(ngrams.grams(x, {}))) for c, s, i, x in t if (c, s) == (country, source)]
        df = Counter(g for _, x in own for g in x)

        def unit(x, n=len(own), df=df):
            v = {g: (1 + math.log(k)) * (math.log((1 + n) / (1 + df[g])) + 1) for g, k in x.items()}
            norm = math.sqrt(sum(w * w for w in v.values()))
            return {g: w / norm for g, w in v.items()}

        held = [(i, unit(x)) for i, x in own]
        for c, i, x in q:
            if c == country:
                v = unit(Counter(ngrams.grams(x, {})))
                scores = [(-round(s, 9), j) for j, y in held if (s := sum(w * y.get(g, 0.0) for g, w in v.items())) > threshold]
                out |= {(i, source, j, -s, n + 1) for n, (s, j) in enumerate(sorted(scores)[:top])}
    return out


def test_cosines_of_cells(spark):
    """Copies beyond `top`, ties, several sources and countries, words of one letter, no words, and n-grams that no target holds."""
    r = random.Random(2)
    words = ["a", "ab", "étoile", "etoile", "boulangerie", "12", "rue", "garage", "port", "acme"]
    some = lambda: " ".join(r.choices(words, k=r.randint(0, 4)))
    t = [(r.choice(["FR", "IN"]), r.choice(["S2", "S3"]), f"t{i:03d}", some()) for i in range(200)] + [("FR", "S2", f"c{i}", "acme acme") for i in range(9)]
    q = [(r.choice(["FR", "IN", "US"]), f"q{i:03d}", r.choice([some(), "acme", "zzz acme"])) for i in range(60)]
    left, right = spark.createDataFrame(q, "country string, id string, text string"), spark.createDataFrame(t, "country string, source string, id string, text string")
    want = plain(q, t, 6, 0.12)
    for chunks in ((7, 20), (ngrams.QUERIES, ngrams.TARGETS)):
        got = ngrams.best_cosines(left, right, 6, 0.12, chunks)
        assert len(want) > 200 and {(x.q_id, x.source, x.t_id, round(x.score, 9), x["rank"]) for x in got.collect()} == want


def test_grams_are_those_of_the_column(spark):
    texts = ["", "a", "ab c", "étoile  12", "😀x boulangerie"]
    d = spark.createDataFrame([(x,) for x in texts], "x string").select("x", X.char_ngrams(F.col("x")).alias("g"))
    assert all(sorted(r.g) == sorted(ngrams.grams(r.x, {})) for r in d.collect())


def test_candidates_give_what_the_channels_give(spark):
    q, t = sides(spark, rows())
    k = 5
    view = lambda d, *more: d.select("country", *more, F.col("entity_id").alias("id"), X.combined_view(F.col("name_core"), F.col("name_norm"), F.col("name_translit"), F.col("addr_tokens")).alias("text"))
    found = {"char_name": B.similar(view(q), view(t, "source"), 3 * k), "exact_name": B.exact_name(q, t, k), "folded_name": B.equal(q, t, "name_retrieval", k), "core_name": B.equal(q, t, "name_core", k),
             "exact_addr": B.equal(q, t, "addr_norm", k), "rare_token": B.rare_token(q, t, k, 0.05), "address_anchor": B.address_anchor(q, t, k), "compound": B.compound(q, t, k)}
    columns = ["q_id", "source", "t_id", F.array_join("channels", ",").alias("c"), "best_rank", *B._FLAGS, F.round("tfidf_name_score", 9), F.round("number_overlap", 9), F.round("tfidf_addr_score", 9), "cand_score", "rn"]
    want = {tuple(x) for x in B.top_k(B.enrich(B.merge(found), q, t), k).select(*columns).collect()}
    got = B.candidates(q, t, k, 0.05)
    assert len(want) > 500 and any("char_name" == x[3] for x in want) and {tuple(x) for x in got.select(*columns).collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "gram" not in plan and "addr_tokens" not in plan  # pairs are joined neither by n-grams nor with sets


def test_features_read_written_candidates(spark, tmp_path):
    """The features' joins with texts begin from a written table of the best k, so the files of its shuffles are gone."""
    from lakelink import catalog

    data = [(i, f"{w} ring", f"Brand#{i % 5}", "LARGE", i % 7) for i in range(24) for w in [("hot", "cold", "blue")[i % 3]]]
    spark.createDataFrame(data, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    d = catalog.queries()["pair_features_full"](spark, str(tmp_path))
    assert "Window" not in d._jdf.queryExecution().optimizedPlan().toString() and any("lakelink-" in f for f in d.inputFiles()) and d.count() > 20
