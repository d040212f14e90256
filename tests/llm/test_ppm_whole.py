"""Every label is learned: more than 64 of them, and one whose texts are all long."""

import random

from lakelink.llm import ppm


def test_every_label(spark):
    r = random.Random(6)
    rows, words = [], {}
    for k in range(70):
        lang = f"l{k:02}"
        words[lang] = ["".join(r.choices(r.sample("abcdefghijklmnopqrstuvwxyz", 6), k=5)) for _ in range(6)]
        for i in range(4):
            rows.append((10 * k + i, " ".join(r.choices(words[lang], k=100)), lang))
    rows += [(1000, " 1 " + "жизнь и дорога " * 2000, "long"), (1001, "дорога и жизнь", None)]
    model = ppm.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == sorted([*words, "long"])
    ask = [(k, " ".join(r.choices(w, k=30)), lang) for k, (lang, w) in enumerate(words.items())] + [(99, "дорога и жизнь", "long")]
    got = ppm.identify(spark.createDataFrame(ask, "doc_id long, text string, lang string"), model).filter("lang_pred <> lang").count()
    assert got == 0
