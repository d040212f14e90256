import pytest
from pyspark.sql import functions as F

from lakelink.functions import strings, text
from lakelink.functions.similarity import f_half
from lakelink.operators import contracts, decode, metrics, mining, training
from lakelink.plans import manifest
from lakelink.plans.linker import prepare
from lakelink.sources import tables
from lakelink.streaming import winners


def test_text_views(spark):
    cases = {"Café Étoile": ("café étoile", "cafe etoile"), "Ｓｔｒａße  AG": ("strasse ag", "strasse ag"), "Unit 12 / Café 50001": ("unit 12 café 50001", "unit 12 cafe 50001"), "कंपनी Café": ("कंपनी café", "कंपनी cafe"),
             "": ("", ""), "null": ("", ""), "<NULL>": ("", ""), "NaN": ("", ""), "O'Neil#1": ("oneil1", "oneil1")}
    d = spark.createDataFrame([(k,) for k in cases], "x string").select("x", text.views(F.col("x")).alias("v")).collect()
    assert {r.x: (r.v.normalized, r.v.folded) for r in d} == cases
    v = next(r.v for r in d if r.x.startswith("Unit"))
    assert v.compact == "unit12café50001" and v.numeric_tokens == ["12", "50001"]
    assert spark.createDataFrame([(None,)], "x string").select(text.normalized(F.col("x"))).first()[0] == ""


def test_suffix_script_numbers(spark):
    d = spark.createDataFrame([("acme private ltd", "a5कि12 x कि 12 १२ 9_ 75001"), ("co ltd", "")], "n string, a string")
    got = d.select(text.core_and_suffix(F.col("n")).alias("c"), text.numbers(F.col("a")).alias("k"), text.postal(F.col("a")).alias("p"), text.script(F.col("a")).alias("s")).collect()
    assert tuple(got[0].c) == ("acme", "private limited") and tuple(got[1].c) == ("co ltd", "company limited")
    assert got[0].k == ["12", "75001", "१२"] and got[0].p == "75001" and got[1].p is None and got[1].s == "Latin"
    grams = spark.createDataFrame([("a",), ("ab",), ("abc",)], "x string").select(text.char_ngrams(F.col("x"))).collect()
    assert [r[0] for r in grams] == [[" a "], [" ab", "ab ", " ab "], [" ab", "abc", "bc ", " abc", "abc "]]


def test_string_similarities():
    assert strings.ratio("abcd", "abxd") == 75 and strings.ratio("", "") == 100
    assert strings.set_ratio("a b c", "c b") == 100 and strings.set_ratio("", "a") == 0
    assert strings.sort_ratio("b a", "a b") == 100 and strings.partial_ratio("bcd", "abcde") == 100
    assert round(strings.jaro_winkler("martha", "marhta"), 4) == 0.9611


def test_metric_goldens(spark):
    truth = spark.createDataFrame([("1", ["A", "B"]), ("2", []), ("3", ["C"])], "s1_id string, target_ids array<string>")
    found = spark.createDataFrame([("1", ["A"]), ("3", ["C", "D"])], "s1_id string, ids array<string>")
    assert round(metrics.macro_f_half(truth, found).first()[0], 4) == 0.7963
    assert round(spark.range(1).select(f_half(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"), F.lit("b"), F.lit("c")))).first()[0], 3) == 0.714


def test_decode_and_stream(spark):
    s = spark.createDataFrame([("S1-a", "S2-x", 0.9), ("S1-b", "S2-x", 0.9), ("S1-b", "S2-y", 0.4)], "s1_id string, target_id string, prob double")
    assert [tuple(r)[:2] for r in decode.exclusive(s, 0.5).collect()] == [("S1-a", "S2-x")]
    assert decode.nonexclusive(s, 0.5).count() == 2
    ids = spark.createDataFrame([("S1-a",), ("S1-c",)], "s1_id string")
    assert sorted(map(tuple, decode.complete(ids, decode.exclusive(s, 0.5)).collect())) == [("S1-a", "S2-x"), ("S1-c", "")]
    w = spark.createDataFrame([], winners.SCHEMA)
    for p, q in ((0.8, "b"), (0.7, "a"), (0.9, "c"), (0.9, "a")):
        w = winners.fold(w, spark.createDataFrame([(q, "T1", p)], winners.SCHEMA), 0.5)
    assert w.first().s1_id == "a"


def test_sweep_policy(spark):
    s = spark.createDataFrame([("a", "x", 0.6), ("b", "x", 0.5), ("b", "z", 0.75)], "s1_id string, target_id string, prob double")
    truth = spark.createDataFrame([("a", ["x"]), ("b", ["z"])], "s1_id string, target_ids array<string>")
    best = decode.best_policy(decode.sweep(s, truth, [0.4, 0.55, 0.7])).first()
    assert (best.exclusive, best.threshold, best.macro_f05) == (True, 0.4, 1.0)


def test_mining_and_training(spark):
    d = spark.createDataFrame([(["x", "y"], ["a", "b"])] * 3 + [(["x"], ["a", "c"])], "a array<string>, b array<string>")
    assert [tuple(r)[:2] for r in mining.positional(d).orderBy("token").collect()] == [("x", "a"), ("y", "b")]
    c = spark.createDataFrame([("q", f"t{i}", i) for i in range(5)], "s1_id string, target_id string, rank int")
    t = spark.createDataFrame([("q", "t4")], "s1_id string, target_id string")
    assert sorted((r.target_id, r.label) for r in training.training_pairs(c, t, 2).collect()) == [("t0", 0), ("t1", 0), ("t4", 1)]


def test_contracts(spark):
    schema = "ordinal long, s1_id string, candidate_ids array<string>, prediction_ids array<string>"
    good = spark.createDataFrame([(0, "a", ["x", "y"], ["x"]), (1, "b", [], [])], schema)
    assert contracts.shard_rows(good).count() == 0
    bad = spark.createDataFrame([(0, "a", ["y", "x"], ["z"]), (2, "a", [], [])], schema)
    assert {r.rule for r in contracts.shard_rows(bad).collect()} == {"candidates_sorted_unique", "predictions_are_candidates", "s1_id_repeats", "ordinals_contiguous"}
    with pytest.raises(ValueError):
        contracts.require_none(contracts.shard_rows(bad))


def test_sources(spark, tmp_path):
    f = tmp_path / "s1.tsv"
    f.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"s1_{i}\tCompany {i}\t{i}00 Main\t{c}\n" for i, c in enumerate(["INDIA", "FRANCE", "INDIA", "US", "INDIA"])))
    got = tables.read_ordered(spark, str(f), "INDIA").orderBy("ordinal").collect()
    assert [(r.ordinal, r.entity_id) for r in got] == [(0, "s1_0"), (2, "s1_2"), (4, "s1_4")]
    assert tables.read_strict(spark, str(f)).count() == 5 and tables.read_lenient(spark, str(f), "US").count() == 1
    s1 = spark.createDataFrame([("a", 0), ("b", 1)], "s1_id string, ordinal long")
    with pytest.raises(ValueError):
        tables.merge_parts(s1, spark.createDataFrame([("a", "x")], "s1_id string, ids string"))
    with pytest.raises(ValueError):
        tables.merge_parts(s1, spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "s1_id string, ids string"))
    f.write_text("e1\tName\tStreet\tUS\t\n")
    assert tuple(tables.read_lenient(spark, str(f)).first()) == ("e1", "Name", "Street", "US")


def test_manifest(tmp_path):
    (tmp_path / "a").write_text("x")
    manifest.save(tmp_path / "m.json", {"stage": 10}, {"a": tmp_path / "a"})
    assert manifest.valid(tmp_path / "m.json", {"stage": 10}, {"a": tmp_path / "a"}) and not manifest.valid(tmp_path / "m.json", {"stage": 20}, {"a": tmp_path / "a"})
    (tmp_path / "a").write_text("y")
    assert not manifest.valid(tmp_path / "m.json", {"stage": 10}, {"a": tmp_path / "a"})


def test_prepare(spark):
    raw = spark.createDataFrame([("S1-1", "S1", " france", "Café Étoile Ltd", "Unit 12")], "entity_id string, source string, country string, business_name string, business_address string")
    r = prepare(raw).first()
    assert (r.country, r.name_core, r.name_folded, r.addr_numbers) == ("FRANCE", "café étoile", "cafe etoile ltd", ["12"])
