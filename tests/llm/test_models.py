import random

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import crf_language, gru_toxicity
from barloom.llm.common import held_out, table
from barloom.llm.queries import op2_crf_language, op3_gru_toxicity
from barloom.llm.word_hash import word_features

A, B = "the of and to in is that for with was".split(), "der die und das ist nicht mit von ein auch".split()


def sentences(seed, words, n=60):
    rng = random.Random(seed)
    return [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(n)]


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "ab", "straße", "überaus", "x" * 300]
    ids, begin = word_features(words)
    for i, w in enumerate(words):
        alone, _ = word_features([w])
        assert (ids[begin[i] : begin[i + 1]] == alone).all()


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4])
    scores, trans = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    got, expected = crf_language.forward_backward(scores.copy(), lengths, trans, pairs=True)
    plain, _ = crf_language.forward_backward(scores.copy(), lengths, trans)
    want, pairs = [], np.zeros((3, 3))
    for at, n in zip([0, 3, 4], lengths):
        own, total = np.zeros((n, 3)), 0
        for path in np.ndindex(*[3] * n):
            p = np.exp(sum(scores[at + t, k] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total += p
            for t, k in enumerate(path):
                own[t, k] += p
        for path in np.ndindex(*[3] * n):
            p = np.exp(sum(scores[at + t, k] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            for a, b in zip(path, path[1:]):
                pairs[a, b] += p / total
        want.append(own / total)
    assert np.allclose(got, np.concatenate(want)) and np.allclose(plain, got) and np.allclose(expected, pairs)


def test_words_of_mixed_text_are_labelled():
    model = crf_language.train(sentences(1, A) + sentences(2, B), ["en"] * 60 + ["de"] * 60)
    words, marginals = model.label_words([" ".join(A + B)])[0]
    names = [model.languages[k] for k in marginals.argmax(axis=1)]
    assert names[:9] == ["en"] * 9 and names[11:] == ["de"] * 9


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    got = op2_crf_language(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    right, n = got.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.9


def test_language_edges(edge_docs, no_docs):
    model = crf_language.train(sentences(1, A) + sentences(2, B), ["en"] * 60 + ["de"] * 60)
    got = crf_language.identify(edge_docs, model, edge_docs.columns, names=("lang_pred", "own")).collect()
    assert len(got) == edge_docs.count()
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {2, 3, 6} and all(0 <= r.own <= 1 and r.score == "x" for r in got)
    assert crf_language.identify(no_docs, model, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in crf_language.identify(edge_docs, crf_language.learn(no_docs), ["doc_id"]).collect()} == {"und"}


def test_gradients():
    rng = np.random.default_rng(2)
    net = gru_toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    vectors = rng.normal(size=(6, gru_toxicity.CHARS + gru_toxicity.WORDS))
    index = rng.integers(0, 6, (5, gru_toxicity.WINDOW))
    mask = np.arange(gru_toxicity.WINDOW) < np.array([[32], [1], [7], [32], [20]])
    want = np.array([1, 0, 1, 0, 1.0])

    def loss():
        s = net.run(net.project(vectors), index, mask).astype(np.float64)
        return np.mean(np.log1p(np.exp(s)) - want * s)

    grads, dvec = net.gradients(vectors, index, mask, want)
    for name, grad, value in [*((k, g, net.p[k]) for k, g in grads.items()), ("vectors", dvec, vectors)]:
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(4)]:
            was, step = value[at], 1e-2
            value[at] = was + step
            up = loss()
            value[at] = was - step
            down = loss()
            value[at] = was
            assert abs((up - down) / (2 * step) - grad[at]) < 2e-3, (name, at)


def test_windows_cover_all_words_and_overlap():
    for n in (1, 5, 31, 32, 33, 56, 57, 1000):
        starts = gru_toxicity.window_starts(n)
        assert starts[0] == 0 and starts[-1] + gru_toxicity.WINDOW >= n
        assert all(b - a == gru_toxicity.STRIDE < gru_toxicity.WINDOW for a, b in zip(starts, starts[1:]))
        assert n <= gru_toxicity.WINDOW or starts[-1] < n


def test_toxic_words_are_learned():
    rng = random.Random(4)
    fill = [f"w{rng.randint(0, 60)}{c}" for c in "abcdefgh" for _ in range(20)]
    texts, labels = [], []
    for i in range(400):
        words = rng.choices(fill, k=rng.randint(20, 120))
        if i % 2:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["scoundrel", "villain"])
        texts.append(" ".join(words))
        labels.append(i % 2)
    scorer = gru_toxicity.train(texts[:300], labels[:300])
    scores = np.array(scorer.score(texts[300:]))
    assert ((scores >= 0.5) == np.array(labels[300:])).mean() > 0.9
    assert scorer.score([None, "", "123"]) == [scorer.empty] * 3 and scorer.empty < 0.5


def test_toxicity_query(spark, sf_dir):
    got = op3_gru_toxicity(spark, sf_dir).collect()
    assert len(got) == table(spark, sf_dir, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    scorer = gru_toxicity.learn(edge_docs, labels)
    got = gru_toxicity.score(edge_docs, scorer, ["doc_id"])
    assert got.count() == edge_docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    none = gru_toxicity.learn(no_docs, labels)
    assert {r.score < 0.5 for r in gru_toxicity.score(edge_docs, none, ["doc_id"]).collect()} == {True}
    assert gru_toxicity.score(no_docs, scorer, ["doc_id"]).count() == 0


def test_held_out_rows_are_a_fifth(spark):
    assert 150 < spark.range(1000).select(held_out("id").alias("h")).where("h").count() < 250


def test_numbers_are_no_letters(spark):
    rows = [(i, f"{'der die das und' if i % 2 else 'the and of to'} word{i}", "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame([*rows, (900, "½ ² Ⅷ 12 ³", None), (901, "½ x", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in crf_language.identify(docs, crf_language.learn(docs), ["doc_id"]).collect()}
    assert found[900] == "und" and found[901] != "und"


def test_texts_in_no_learned_language_are_unfamiliar(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = crf_language.learn(docs)
    strange = [
        "日本語の文章をここに書きますが、これは学習されていない言語です。" * 3,
        "Это предложение написано на языке, которого модель никогда не видела раньше. " * 3,
        "qwkjx zxqpv wvtrbg hjkqw xcvzq pqlmzk rtgbhy vfrxq zaqxsw cderfv " * 3,
        "ეს წინადადება დაწერილია უცნობ ენაზე, რომელიც მოდელს არასოდეს უნახავს " * 2,
    ]
    assert model.judge(strange)[2] == [False] * 4
    judged = crf_language.identify(docs, model, ["doc_id"], familiar="usual").where(held_out() & (F.col("lang_pred") != "und"))
    kept, all_ = judged.where("usual").count(), judged.count()
    assert kept >= 0.995 * all_, (kept, all_)
