"""Subwords and scores against plain loops, gradients against differences, accuracy on held-out rows."""

import unicodedata
import zlib

import numpy as np
import pytest
from rowsmith.llm import language_id as lid

SMALL = "/root/testdata/sf0.01"
TEXTS = [
    "", "a", "Ab1cd  ef", "...x", "naïve café ", "漢字かな", "12 34", "a\nb\tc", " हिन्दी ", "İstanbul", "x" * 700 + " yz",
]


def plain_subwords(text):
    """n-grams of each word between gaps, gaps across which none goes."""
    inside = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    found = []
    for word in inside.split():
        closed = f" {word} "
        for n in lid.N_GRAMS:
            found += [closed[i : i + n] for i in range(len(closed) - n + 1)]
    return found


def bucket(gram):
    return int(lid.subwords(np.array([ord(c) for c in gram], np.uint32))[[2, 3, 4].index(len(gram))][1][0])


@pytest.mark.parametrize("text", TEXTS)
def test_subwords_equal_plain_loop(text):
    assert sorted(lid.buckets_of(text)) == sorted(map(bucket, plain_subwords(text)))


def test_scores_do_not_depend_on_the_batch(monkeypatch):
    random = np.random.default_rng(3)
    model = lid.Model(["a", "b", "c"], random.normal(size=(lid.BUCKETS, 3)).astype(np.float32), random.normal(size=3))
    together = model.logits(TEXTS)
    for text, found in zip(TEXTS, together):
        buckets = [bucket(g) for g in plain_subwords(text)]
        expected = model.bias + (model.table[buckets].astype(float).mean(axis=0) if buckets else 0)
        assert found == pytest.approx(expected, abs=1e-5)
        assert model.logits([text])[0] == pytest.approx(found, abs=1e-6)
    monkeypatch.setattr(lid, "_CHUNK", 7)
    monkeypatch.setattr(lid, "_GROUP", 9)
    assert model.logits(TEXTS) == pytest.approx(together, abs=1e-5)


def test_gradients_equal_differences():
    random = np.random.default_rng(5)
    embeddings, weights, bias = random.normal(size=(9, 4)), random.normal(size=(4, 3)), random.normal(size=3)
    bags = [np.array([0, 3, 3]), np.array([1]), np.array([8, 2, 0, 0])]
    labels = np.array([0, 2, 1])
    _, used, of_rows, of_weights, of_bias = lid.gradients(embeddings, weights, bias, bags, labels)
    whole = np.zeros_like(embeddings)
    whole[used] = of_rows
    for values, found in ((embeddings, whole), (weights, of_weights), (bias, of_bias)):
        for at in np.ndindex(values.shape):
            kept, losses = values[at], []
            for step in (1e-5, -1e-5):
                values[at] = kept + step
                losses.append(lid.gradients(embeddings, weights, bias, bags, labels)[0])
            values[at] = kept
            assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(found[at], abs=1e-6)


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = lid.identify(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"]]
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in tested]
    assert len(right) > 150 and np.mean(right) > 0.97
    accepted = [ok for ok, r in zip(right, tested) if not r["rejected"]]
    assert len(accepted) > 0.9 * len(right) and np.mean(accepted) > 0.98


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, lang_pred string, n string, id string")


def test_labels_of_held_out_rows_are_not_learnt(spark):
    texts = {"aa": "der die das und ein haus", "bb": "the house and of with", "cc": "la casa es de los"}
    rows = [(i, f"{texts[k]} {texts[k][: i % 7 + 3]}", k) for i in range(90) for k in [sorted(texts)[i % 3]]]
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else k) for i, t, k in rows]
    odd = [(None, "the house", "qq"), (200, None, "aa"), (201, "12 3", None), (202, "", "bb"), (203, "́", "bb"), (0, rows[0][1], rows[0][2])]
    results = []
    for chosen in (rows, other):
        found = lid.identify(frame(spark, [(*r, "c", "c", "c", "c") for r in chosen + odd])).collect()
        results.append(sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["lang_pred"], r["score"], r["rejected"]) for r in found))
    assert results[0] == results[1]
    by_id = {r["doc_id"]: r for r in found}
    assert {by_id[i]["lang_pred"] for i in (200, 201, 202, 203)} == {"und"} and by_id[200]["score"] == 0
    assert by_id[None]["held_out"] is False and by_id[None]["lang_pred"] == "bb"
    assert len(found) == 96


@pytest.mark.parametrize("rows", [[], [(1, "text", None), (2, None, "en")], [(i, "one language", "en") for i in range(20)]])
def test_nothing_or_one_language_to_learn(spark, rows):
    found = lid.identify(frame(spark, [(*r, "c", "c", "c", "c") for r in rows])).collect()
    assert len(found) == len(rows)
    assert {r["lang_pred"] for r in found} <= ({"en"} if len(rows) == 20 else {"und"})
