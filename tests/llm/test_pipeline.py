import hashlib
from array import array

import corpus_pipeline as P
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from test_trie_join import shingles

from barloom.llm import crf_language, spm_bpe
from barloom.llm.common import only_last, stored, table


def near(a, b):
    both = len(a & b)
    return a and b and 100 * both >= 80 * (len(a) + len(b) - both)


def test_stages_one_after_the_other(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = {}
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == table(spark, sf_dir, "documents").columns
    assert [n for n, _ in P.STAGES] == ["language", "near_copies", "repeats", "decontaminate", "tokens"]
    # near copies: brute force over all pairs of the stage's input
    before = {k: shingles(r.text, 5) for k, r in kept["language"].items()}
    group = {k: k for k in before}
    for a in sorted(before):
        for b in sorted(before):
            if b < a and near(before[a], before[b]):
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert set(kept["near_copies"]) == set(group.values())
    # benchmark items are gone, other documents stay as they are
    items = [" ".join(r.text.split()) for r in table(spark, sf_dir, "benchmark").collect()]
    left = {k: " ".join(r.text.split()) for k, r in kept["decontaminate"].items()}
    assert not any(i in t for t in left.values() for i in items)
    assert all(kept["repeats"][k] == r for k, r in kept["decontaminate"].items())
    assert all(r.n_chars == len(r.text) for r in kept["repeats"].values())
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    codec = tiktoken.Encoding("o", pat_str=public_tokenizers.PATTERN, mergeable_ranks=spm_bpe.read_ranks(path), special_tokens={})
    for k, r in kept["tokens"].items():
        text = kept["decontaminate"][k].text
        assert bytes(r.decoded) == text.encode()
        assert hashlib.sha256(r.ids).digest() == hashlib.sha256(array("I", codec.encode_ordinary(text)).tobytes()).digest()
    assert set(kept["tokens"]) == set(kept["decontaminate"])


def test_stages_take_edges_and_clashing_names(spark, sf_dir, edge_docs, no_docs):
    for start in (edge_docs.withColumn("n_chars", edge_docs.doc_id), no_docs.withColumn("n_chars", no_docs.doc_id)):
        docs = start
        for name, stage in P.STAGES:
            out = stored(stage(spark, docs, sf_dir), name)
            if name != "tokens":
                assert out.columns == start.columns
                docs = out
        assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in start.collect()}


def test_near_copies_without_a_key(spark):
    words = [f"w{i}" for i in range(50)]
    rows = [(None, " ".join(words)), (None, " ".join(words)), (None, " ".join(words[:-1])), (4, " ".join([*words, "more"])), (None, "quite another text of its own"), (4, "a second text of four, without a copy"), (None, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = P.near_copies(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    left = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert left == sorted([(4, rows[3][1]), (0, rows[4][1]), (4, rows[5][1]), (0, "")]) or (len(left) == 4 and (4, rows[5][1]) in left)


def test_only_the_last_table_stays(spark, tmp_path):
    from barloom.session import shared_root
    from barloom.sources.files import children

    before = set(children(spark, shared_root(spark)))
    df = spark.range(3)
    with only_last(spark):
        for name in ("one", "two"):
            with only_last(spark):
                stored(df, f"way-{name}")
                df = stored(df, name)
    left = set(children(spark, shared_root(spark))) - before
    assert [n.split("-")[0] for n in left] == ["two"] and df.count() == 3


def test_language_is_judged_by_the_random_field(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    strange = [
        "Η πρόταση",
        "Tämä lause on kirjoitettu kielellä jota malli ei ole koskaan nähnyt",
        "Ta věta je napsána v jazyce který model nikdy předtím neviděl",
        "asdf jkl qwer zxcv hjkl uiop",
        "日本語の文章をここに書きますが、これは学習されていない言語です。",
    ]
    usual = docs.where("lang = 'en' AND length(text) > 500").orderBy("doc_id").first().text.split()[:40]
    strange.append(" ".join(["qwkjx zxqpv"] * 60 + usual))  # few distinct words are strange, most words are
    added = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(strange)], "doc_id long, text string")
    kept = {r.doc_id for r in P.language(spark, docs.unionByName(added, allowMissingColumns=True), "").select("doc_id").collect()}
    assert not {i for i in kept if i >= 10**9}
    with_letters = {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()}
    assert kept == with_letters


def test_learned_labels_are_the_only_languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = crf_language.learn(docs, foreign=True)
    texts = [r.text for r in docs.limit(50).collect()] + [None, "", "123", "word " * 3, "Это предложение"]
    assert set(model.judge(texts)[0]) <= {r.lang for r in docs.select("lang").distinct().collect()} | {"und"}
    assert crf_language.learn(docs.where("false"), foreign=True).judge(["some text"])[0] == ["und"]
    made = crf_language.foreign_texts(["some words, and more", "", "one two"])
    assert [[len(w) for w in t.split()] for t in made] == [[4, 5, 3, 4], [], [3, 3]]
