"""Language identification: held-out accuracy, rejection, awkward rows."""

import math
import zlib

import numpy as np
import pytest
from odd import TEXTS, documents

from finwater.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es", "und"}
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in held]) >= 0.98
    sure = np.mean([r["score"] for r in held])
    assert abs(sure - 1) < 0.05  # confidence is in step with accuracy
    assert np.mean([r["rejected"] for r in rows]) < 0.02
    # a rerun agrees
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op4_language_id(spark, SF).collect()))


def test_labels_are_no_input(spark):
    """Predictions depend on the text alone."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs)
    a = langid.predict(docs, model, keep=["doc_id"]).collect()
    b = langid.predict(docs.selectExpr("doc_id", "text", "'en' AS lang").repartition(7), model, keep=["doc_id"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_odd_rows(spark):
    model = langid.fit(documents(spark))
    got = langid.predict(documents(spark), model, keep=["doc_id", "score"], prefix="p_").collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = next(t for i, t, *_ in TEXTS if i == r["doc_id"])
        if text is None or not any(c.isalpha() for c in text):
            assert (r["p_lang_pred"], r["p_score"], r["p_rejected"]) == ("und", 0.0, True)
        else:
            assert r["p_lang_pred"] in {"en", "de", "fr"}
    kept = langid.keep_identified(documents(spark))
    assert kept.dtypes == documents(spark).dtypes and not {2, 3, 6} & {r["doc_id"] for r in kept.collect()}


def test_no_rows_and_no_labels(spark):
    empty = documents(spark).limit(0)
    assert langid.predict(empty, langid.fit(empty), keep=["doc_id"]).collect() == []
    unlabelled = documents(spark).drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    rows = langid.predict(unlabelled, langid.fit(unlabelled), keep=["doc_id"]).collect()
    assert {r["lang_pred"] for r in rows} == {"und"}


def test_prediction_is_independent_of_grouping():
    rows = [(lang, i, (lang + str(i % 3) + "xyz ").encode() * 5) for lang in ("aa", "bb") for i in range(40)]
    model = langid.train(rows)
    texts = [b"aa1xyz bb", b"", b"bb0xyz " * 70_000, b"aa2"]
    one = [tuple(c[0] for c in model.predict([t])) for t in texts]
    assert one == list(zip(*model.predict(texts)))


def test_foreign_texts_go_with_one_two_or_four_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(5)
    odd = ["".join(rng.choice(list(a), 6)) for a in ("бвгджзклмнп", "漢字仮名交文日本", "qxzjkvwQXZ") for _ in range(60)]
    foreign = [" ".join(odd[k : k + 60]).encode() for k in (0, 60, 120)]
    for langs in (["en"], ["en", "de"], ["en", "de", "fr", "es"]):
        some = docs.filter(docs["lang"].isin(langs))
        model = langid.fit(some)
        assert model.predict(foreign)[2] == [True] * 3
        kept = [not r["rejected"] for r in langid.predict(some.filter(langid.held_out()), model, keep=["doc_id"]).collect()]
        assert np.mean(kept) > 0.97


def plain_prediction(model, text):
    """Language, confidence and rejection from sums over the model's table,
    subword by subword."""
    raw = b" " + (text or "").lower().encode().translate(bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))) + b" "
    sums, n, new = [0] * len(model.langs), 0, 0
    for size in (2, 3, 4):
        for at in range(len(raw) - size + 1):
            part = raw[at : at + size]
            if b" " in part[1:-1] or (part[:1] == b" " == part[-1:]):
                continue
            value = int.from_bytes(part, "little") ^ (0x9E3779B9 * size & 0xFFFFFFFF)
            row = (value * 2654435761 & 0xFFFFFFFF) >> 16
            n += 1
            new += not model.seen[row]
            sums = [s + int(model.table[row, k]) for k, s in enumerate(sums)]
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, True
    z = [(s / max(n, 1) / langid.SCALE + b) / model.temperature for s, b in zip(sums, model.bias.tolist())]
    e = [math.exp(x - max(z)) for x in z]
    p = [x / sum(e) for x in e]
    best = p.index(max(p))  # a tie goes to the first language by name
    share = new / max(n, 1)
    strange = max(share - 3 * math.sqrt(9 * share * (1 - share) / max(n, 1)), 0.0)
    return model.langs[best], p[best], p[best] < model.threshold or strange > model.unseen


def test_predictions_equal_plain_sums(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.filter("length(text) < 3000").collect()]
    rows += [(-1, None), (-2, "12 34 !?"), (-3, "漢字 kana"), (-4, "a"), (-5, "xqzj " * 40), (-6, "theé\u0000 A.b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.predict(df, model, keep=["doc_id"]).collect()}
    assert model.langs == sorted(model.langs) and len(got) == len(rows)
    for i, text in rows:
        lang, score, rejected = plain_prediction(model, text)
        assert (got[i]["lang_pred"], got[i]["rejected"]) == (lang, rejected), i
        assert got[i]["score"] == pytest.approx(score, rel=1e-9, abs=1e-12)
