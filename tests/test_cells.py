"""Candidates by cells against the channels one by one."""

import random

from pyspark.sql import functions as F

from lakelink import catalog
from lakelink.operators import blocking as B
from lakelink.operators import features
from lakelink.operators.cells import key_candidates

from test_candidates import sides


def by_channels(q, t, k):
    found = {"exact_name": B.exact_name(q, t, k), "folded_name": B.equal(q, t, "name_retrieval", k), "core_name": B.equal(q, t, "name_core", k), "exact_addr": B.equal(q, t, "addr_norm", k),
             "rare_token": B.rare_token(q, t, k, 0.05), "address_anchor": B.address_anchor(q, t, k), "compound": B.compound(q, t, k)}
    return B.top_k(B.enrich(B.merge(found), q, t), k)


def rows():
    """Names of many and of few records, beyond the limits of 20 and 100, with and without shared numbers, accents, suffixes, no address and no country."""
    r = random.Random(11)
    words = [f"wort{i}" for i in range(30)] + ["étoile", "etoile", "über", "uber"]
    names = ["Acme", "Acme Ltd", "Acmé", "Café Étoile", "Cafe Etoile sarl"]
    out = []
    for i in range(620):
        name = names[min(r.randrange(9), 4)] if i % 3 else " ".join(r.choices(words, k=r.randint(1, 4)))
        address = "" if r.random() < 0.1 else " ".join(r.choices(words, k=r.randint(1, 9))) + r.choice(["", "", " 12", " 75001", " 7 69002"])
        out.append((f"S{1 + i % 3}_{i:03d}", r.choice(["FRANCE", "FRANCE", "FRANCE", "INDIA", None]), name, address))
    return out


def test_cells_give_what_the_channels_give(spark):
    q, t = sides(spark, rows())
    columns = ["q_id", "source", "t_id", F.array_join("channels", ","), "best_rank", "exact_name", "exact_addr", "rare_token", "address_anchor", F.round("number_overlap", 9), F.round("tfidf_addr_score", 9), "cand_score", "rn"]
    want = {tuple(x) for x in by_channels(q, t, 5).select(*columns).collect()}
    for chunks in ((40, 30), (16384, 32768)):
        got = B.top_k(B.with_score(key_candidates(q, t, 5, B.limit_of(5), 0.05, chunks=chunks)), 5)
        assert len(want) > 500 and {tuple(x) for x in got.select(*columns).collect()} == want


def test_no_join_of_pairs_with_sets(spark, tmp_path):
    """The plan of the candidates joins no pairs with the sets of their records: each record goes to the cells of its country."""
    data = [(i, n + "\n" + a, c, "web", 1) for i, (_, c, n, a) in enumerate(rows())]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    plan = catalog.queries()["candidate_topk"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "FlatMapGroupsInArrow" in plan


def test_features_without_texts(spark):
    """Without string distances features are the same, and digests take the place of texts in the joins."""
    q, t = sides(spark, rows())
    pairs = by_channels(q, t, 2)
    plain = features.pair_features(pairs, q, t, strings=False)
    whole = features.pair_features(pairs, q, t).select(*plain.columns)
    assert "md5(" in plain._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in plain.collect()} == {tuple(r) for r in whole.collect()} and plain.count() > 100


def test_training_reads_a_written_table(spark, tmp_path, monkeypatch):
    """The passes of the training read features that were written once, and do not work them out anew."""
    data = [(i, n + "\n" + a, c, "web", 1) for i, (_, c, n, a) in enumerate(rows()[:90])]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    monkeypatch.setattr(catalog.training, "fit", lambda table, *a, **k: seen.append(table))
    monkeypatch.setattr(catalog.training, "predict", lambda model, table, used: table.withColumn("prob", F.lit(0.0)))
    catalog.queries()["gbt_match"](spark, str(tmp_path))
    assert len(seen[0].inputFiles()) and not any("documents.parquet" in f for f in seen[0].inputFiles())


def test_classifier_gets_every_feature(spark, tmp_path, monkeypatch):
    """The classifier learns from all features, those of string distances included, with the values of pair_features()."""
    data = [(i, n + "\n" + a, c, "web", 1) for i, (_, c, n, a) in enumerate(rows()[:120])]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    monkeypatch.setattr(catalog.training, "fit", lambda table, used, **k: seen.append((table, used)))
    monkeypatch.setattr(catalog.training, "predict", lambda model, table, used: table.withColumn("prob", F.lit(0.0)))
    catalog.queries()["gbt_match"](spark, str(tmp_path))
    table, used = seen[0]
    assert used == features.FEATURES and set(used) <= set(table.columns)
    assert table.filter("name_jw > 0 and name_jw < 1 and name_partial > 0").count()
