"""Retrieval, quotas, pair features and contracts on small cases with known results."""

import pytest
from pyspark.sql import functions as F

from lakelink.functions import text
from lakelink.operators import blocking, contracts, features
from lakelink.plans.linker import prepare

RAW = "entity_id string, source string, country string, business_name string, business_address string"


def sides(spark, rows):
    d = prepare(spark.createDataFrame([(i, i[:2], c, n, a) for i, c, n, a in rows], RAW)).persist()
    return d.filter("source = 'S1'"), d.filter("source <> 'S1'")


def test_oversized_buckets_are_ranked_by_address(spark):
    rows = [(f"S2_f{i:02d}", "FRANCE", "Acme", f"{i} Rue Victor Hugo") for i in range(20)] + [("S1_f", "FRANCE", "Acme", "17 Rue Victor Hugo Apt 2")]
    rows += [(f"S2_i{i:03d}", "INDIA", "Acme", f"{i} Rue de Paris") for i in range(120)] + [("S1_i", "INDIA", "Acme", "117 Rue de Paris Batiment B")]
    got = blocking.candidates(*sides(spark, rows), 1).collect()
    assert {(r.q_id, r.t_id) for r in got} == {("S1_f", "S2_f17"), ("S1_i", "S2_i117")} and min(r.tfidf_addr_score for r in got) > 0


def test_typo_and_anchor(spark):
    rows = [("S2_right", "FRANCE", "Boulangerie Etoile", ""), ("S2_wrong", "FRANCE", "Garage du Port", ""), ("S1_f", "FRANCE", "Boulangeriee Etolie", "")]
    rows += [("S2_a", "INDIA", "Northwind Trading", "12 azalea avenue lyon"), ("S2_b", "INDIA", "Coastal Imports", "55 azalea avenue nice"), ("S1_i", "INDIA", "Unrelated Alias", "77 azalea avenue paris")]
    got = {(r.q_id, r.t_id): r for r in blocking.candidates(*sides(spark, rows), 2).collect()}
    assert "char_name" in got["S1_f", "S2_right"].channels and got["S1_f", "S2_right"].best_rank == 1 and ("S1_f", "S2_wrong") not in got
    assert "address_anchor" in got["S1_i", "S2_a"].channels


def test_overflow_is_counted(spark):
    rows = [(f"S2_{i}", "FRANCE", "Acme", f"{i} Rue de Paris") for i in range(9)] + [("S1_a", "FRANCE", "Acme", "3 Quai"), ("S1_b", "FRANCE", "Acme", "Quai")]
    got = blocking.overflow(*sides(spark, rows), 5, 8).collect()
    assert [tuple(r) for r in got] == [("FRANCE", "S2", 1, 1)] and blocking.overflow(*sides(spark, rows), 5, 9).count() == 0


def test_quota(spark):
    top = spark.createDataFrame([("q", "S2", "a", 1.0), ("q", "S2", "b", 0.9), ("q", "S3", "c", 0.2), ("q", "S3", "d", 0.1)], "q_id string, source string, t_id string, cand_score double")
    assert [(r.t_id, r["rank"]) for r in blocking.balanced(top, 2).orderBy("rank").collect()] == [("a", 1), ("c", 2)]
    assert {r.t_id for r in blocking.balanced(top.filter("source = 'S2'"), 2).collect()} == {"a", "b"}


def test_pair_features(spark):
    rows = [("S1_a", "FRANCE", "Café Étoile", ""), ("S2_a", "FRANCE", "Cafe Etoile", ""), ("S1_b", "FRANCE", "Acme", "12 34 Rue de Paris"), ("S2_b", "FRANCE", "Acme", "12 99 Rue de Paris"), ("S1_c", "FRANCE", "", ""), ("S2_c", "FRANCE", "", "")]
    pairs = spark.createDataFrame([(f"S1_{x}", f"S2_{x}", "S2", ["char_name"], 1, 0, 0, 0, int(x == "b"), 0.0, 0.0) for x in "abc"],
                                  "q_id string, t_id string, source string, channels array<string>, best_rank int, exact_name int, exact_addr int, rare_token int, address_anchor int, tfidf_name_score double, tfidf_addr_score double")
    d = features.pair_features(pairs, *sides(spark, rows))
    assert d.columns[3:] == features.FEATURES
    got = {r.q_id[-1]: r for r in d.collect()}
    assert got["a"].name_folded_ratio == got["a"].name_folded_exact == 1 and got["a"].name_exact == 0
    b = got["b"]
    assert (b.num_any_overlap, b.num_exact_set, b.num_conflict, b.address_anchor_hit, b.name_jw) == (1, 0, 1, 1, 1) and 0 < b.num_jaccard < 1
    assert got["c"].name_exact == got["c"].name_folded_exact == got["c"].addr_exact == got["c"].num_exact_set == got["c"].name_set == 0 and got["c"].both_addr_empty == 1


def test_metadata_and_overlap(spark):
    schema = "target_id string, source string, channel_count int, best_rank int, exact_name int, exact_addr int, rare_token int, address_anchor int, tfidf_name_score double, tfidf_addr_score double, number_overlap double"
    good = spark.createDataFrame([("t", "S2", 3, 1, 1, 0, 0, 0, 0.5, 0.0, 0.0)], schema)
    assert len(contracts.rebuilt_metadata(good).first().channels) == 3
    for broken in ("best_rank - 1 AS best_rank", "0 AS channel_count", "double('nan') AS number_overlap"):
        with pytest.raises(ValueError):
            contracts.rebuilt_metadata(good.selectExpr(*(c for c in good.columns if not broken.endswith(f" {c}")), broken))
    with pytest.raises(ValueError):
        contracts.rebuilt_metadata(good.drop("source"))
    a, b = (spark.createDataFrame([(x,) for x in s], "entity_id string") for s in ("xy", "yz"))
    assert [r.key for r in contracts.overlap(a, b).collect()] == ["y"]


def test_older_forms(spark):
    d = spark.createDataFrame([("A-b  C. é",), ("null",), (None,), ("कि a",), ("^12",), ("12",)], "x string")
    got = d.select(text.deleted_punctuation(d.x).alias("n"), text.range_script(d.x).alias("s")).collect()
    assert [r.n for r in got] == ["ab c é", "", "", "कि a", "12", "12"] and [r.s for r in got] == ["Latin", "Latin", "Unknown", "Devanagari", "Latin", "Unknown"]
    one = spark.createDataFrame([("cafe", "café sa", "cafe sa", "", "", "Bât 3")], "c string, n string, f string, t string, af string, an string")
    assert tuple(one.select(text.name_view(one.c, one.n, one.f, one.t), text.address_view(one.af, one.an)).first()) == ("cafe café sa cafe sa", "bat 3")


def test_ties_to_nine_places(spark):
    """1.5 * 0 + 2 * 3/5 and 1.5 * 4/5 differ in the last bit of a double; the smaller id comes first."""
    held = "name_tokens array<long>, {p}_addr_tokens array<long>, {p}_addr_numbers array<long>, {p}_addr_postal string"
    pairs = spark.createDataFrame([("q", "S2", "a", [1], [1, 2, 3, 4, 5], [], None, [2], [1, 2, 3], [], None), ("q", "S2", "b", [1, 2, 3, 4, 5], [1], [], None, [1, 2, 3, 4], [2], [], None)],
                                  "q_id string, source string, t_id string, q_" + held.format(p="q") + ", t_" + held.format(p="t"))
    assert [(r.t_id, r["rank"]) for r in blocking.ranked(pairs, 2).orderBy("rank").collect()] == [("a", 1), ("b", 2)]


def test_whole_name_buckets(spark, tmp_path):
    """The query on equal names ranks every target of a bucket, whatever its size."""
    from lakelink import catalog

    rows = [(3 * i, f"Acme\nrue {i}", "en", "web", 1) for i in range(2)] + [(3 * i + 1, f"Acme\nplace {i}", "en", "web", 1) for i in range(130)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.queries()["exact_name_block"](spark, str(tmp_path)).groupBy("q_id").count().collect()
    assert {r.q_id: r["count"] for r in got} == {"S1-0": 20, "S1-3": 20}
    assert catalog.queries()["blocking_report"](spark, str(tmp_path)).first().total_candidates == 40


def test_buckets_in_chunks(spark):
    """Large buckets dealt to chunks give what all pairs give, ids that repeat count once, and no country meets no country."""
    import random

    from lakelink.operators import buckets

    r = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(f"S{1 + (i % 3 == 0)}_{i % 140:03d}", r.choice(["FRANCE", "FRANCE", "INDIA", None]), "Acme", " ".join(r.choices(words, k=r.randint(0, 12))) + r.choice(["", " 75001", " 75001 12", " 12"])) for i in range(150)]
    q, t = sides(spark, rows)
    left, right = (blocking.keyed(d, d.name_norm, p) for d, p in ((q, "q"), (t, "t")))
    want = blocking.ranked(left.join(right, ["country", "key"]), 5).collect()
    for chunk in (8, 8192):
        got = blocking.first_ranks(buckets.best_in_buckets(left, right, 5, chunk), 5).collect()
        assert len(want) > 100 and {tuple(x) for x in got} == {tuple(x) for x in want}


def test_all_pairs_of_a_bucket(spark):
    """Without a limit every two rows with equal names give a row, also those that repeat an id, from chunks as from a join."""
    from collections import Counter

    from lakelink.operators import buckets

    rows = [(f"S{1 + i % 3}_{i % 25:02d}", "FRANCE" if i % 7 else None, ["Acme", "Boulangerie Etoile"][i % 2], f"{i % 5} rue {i % 4} de Paris 7500{i % 3}") for i in range(90)]
    q, t = sides(spark, rows)
    left, right = (blocking.keyed(d, d.name_norm, p) for d, p in ((q, "q"), (t, "t")))
    pairs = left.join(right, ["country", "key"])
    want = Counter(tuple(x) for x in pairs.select("q_id", "source", "t_id", F.round(blocking.agreement(), 9)).collect())
    assert max(want.values()) > 1
    for chunk in (8, 2048):
        assert Counter(tuple(x) for x in buckets.best_in_buckets(left, right, None, chunk).collect()) == want
    assert blocking.all_equal(q, t, "name_norm").count() == sum(want.values())
