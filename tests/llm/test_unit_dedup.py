import random

from pyspark.sql import functions as F

from barloom.llm import unit_dedup as U
from barloom.llm.common import table
from barloom.llm.queries import op1_unit_dedup


def plain(texts):
    """key: (text, spans) by going through the documents in order."""
    owner = {}
    for key in sorted(texts):
        for _, _, _, digest in U.units(texts[key] or ""):
            if digest:
                owner.setdefault(digest, key)
    out = {}
    for key, text in texts.items():
        taken = {u[3]: owner[u[3]] for u in U.units(text or "") if u[3] and owner[u[3]] != key}
        spans = U.removals(text, taken, key) if text else []
        for a, b, _ in reversed(spans):
            text = text[:a] + text[b:]
        out[key] = text, spans
    return out


def got(df):
    return {r.doc_id: (r.text, [tuple(x) for x in r.removed]) for r in df.collect()}


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    assert got(op1_unit_dedup(spark, sf_dir)) == plain(texts)


def test_units_are_the_text():
    for text in ("", "a", "One two. Three four!\nFive\n\n six? ", "no end", "\n\n", "A.  B"):
        assert "".join(text[a:b] for a, b, _, _ in U.units(text)) == text


def test_a_passage_stays_in_its_first_document(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    sentence = lambda: " ".join(word() for _ in range(9)).capitalize() + "."
    passage = " ".join(sentence() for _ in range(8))
    docs = [(i, f"{sentence()} {sentence()} {passage} {sentence()}") for i in range(5)] + [(9, " ".join(sentence() for _ in range(6)))]
    cut = U.dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = {r.doc_id: r for r in cut.collect()}
    assert rows[0].text == docs[0][1] and rows[9].text == docs[5][1] and not rows[9].removed
    for i in range(1, 5):
        assert passage not in rows[i].text and len(rows[i].removed) == 8 and {x.first for x in rows[i].removed} == {0}
        assert "".join(docs[i][1][x.start : x.end] for x in rows[i].removed).strip() == passage


def test_case_and_space_do_not_matter_short_repeats_stay(spark):
    rows = [(1, "Alpha beta gamma delta epsilon zeta eta theta.\nYes it is."), (2, "ALPHA  beta\tgamma delta epsilon zeta eta theta.\nOwn words here, quite different ones.\nYes it is.")]
    out = got(U.dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[2][0] == "Own words here, quite different ones.\nYes it is."


def test_rank_decides_who_keeps(spark):
    rows = [(1, "Alpha beta gamma delta epsilon zeta eta theta.", 9), (2, "Alpha beta gamma delta epsilon zeta eta theta.", 3)]
    out = got(U.dedup(spark.createDataFrame(rows, "doc_id long, text string, place long"), rank="place"))
    assert out[1][0] == "" and out[2][0] == rows[1][1]


def test_edges(spark, edge_docs, no_docs):
    out = U.dedup(edge_docs)
    assert out.count() == edge_docs.count() and U.dedup(no_docs).count() == 0
    rows = {(r.doc_id, i): r for i, r in enumerate(out.orderBy("doc_id").collect())}
    texts = {r.doc_id: r.text for r in edge_docs.collect()}
    for (key, _), r in rows.items():
        if key == 5:  # a copy of document 4, twice: both rows lose all
            assert r.text == "" and len(r.removed) > 1000
        else:
            assert r.text == texts[key] and not r.removed
    named = U.dedup(edge_docs, removed="cut")
    assert named.columns == [*edge_docs.columns, "cut"] and {r.removed for r in named.collect()} == {"x"}
    assert dict(named.dtypes)["cut"] == "array<struct<start:bigint,end:bigint,first:bigint>>"


def test_a_line_in_every_document(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("One line that all of the documents do share here.\n"), F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id")) for c in "abcdefghij"])).alias("text"))
    kept = U.dedup(rows).where(F.col("text").contains("all of the documents")).select("doc_id").collect()
    assert [r[0] for r in kept] == [0]


def test_short_units_are_looked_up_with_their_neighbours(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    sentences, lines = "!! ".join(word() for _ in range(60)) + "!!", "\n".join(word() for _ in range(60))
    chinese = "\n".join("".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(30)) for _ in range(4)) + "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(30)) + "。" + "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(20)) + "。"
    stubs = f"{word()}! {' '.join(word() for _ in range(20))}. {word()}!"
    texts = [sentences, lines, chinese, stubs]
    frame = [f"{' '.join(word() for _ in range(9))}.\n" for _ in range(4)]
    rows = [*enumerate(texts), *[(10 + i, t) for i, t in enumerate(texts)], *[(20 + i, frame[i] + t) for i, t in enumerate(texts)]]
    out = got(U.dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, text in enumerate(texts):
        assert out[i] == (text, []) and out[10 + i][0] == "" and out[20 + i][0] == frame[i]


def test_unrepeated_short_units_stay_between_removed_ones(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    a, b = (" ".join(word() for _ in range(9)) + ".\n" for _ in range(2))
    own = "".join(f"{word()}!\n" for _ in range(30))
    rows = [(1, a + b), (2, a + own + b), (3, "ha! " * 40)]
    out = got(U.dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[2][0] == own and out[3][0] == "ha! " * 8


def test_short_repeats_go_where_they_are_no_chance(spark):
    rows = [(i, f"The menu opens here now. Words of {i} alone {i}.\nAll rights are reserved.\nFew words {i}.") for i in range(1, 10)]
    rows += [(20, "Here it is again. Twice.\nNot by chance at all.\nBy chance 7."), (21, "Also 21 of own. Here it is again. More words of 21.\nNot by chance at all.\n")]
    rows += [(0, "Read this first please. One 0 two three. Read this first please. Four 0 five.")] + [(i, f"Read this first please. Six {i} seven.") for i in range(30, 38)]
    out = got(U.dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[1][0] == rows[0][1]
    assert all(out[i][0] == f"Words of {i} alone {i}.\nFew words {i}." for i in range(2, 10))
    assert out[20][0] == rows[9][1] and out[21][0] == "Also 21 of own. Here it is again. More words of 21.\n"
    assert out[0][0] == "Read this first please. One 0 two three. Four 0 five." and all(out[i][0] == f"Six {i} seven." for i in range(30, 38))


def test_rows_without_a_rank_of_their_own(spark):
    text = " ".join(f"word{i}" for i in range(60)) + ".\n"
    other = " ".join(f"term{i}" for i in range(60)) + ".\n"
    rows = [(None, text), (None, text), (None, other), (7, other), (7, other + text), (7, other), (3, "Own words of three, all of them alone here.")]
    out = U.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sum(r.text.count(text) for r in out) == 1 and sum(r.text.count(other) for r in out) == 1
    assert [r.text for r in out if r.doc_id == 3] == [rows[-1][1]]
    keeper = next(r for r in out if other in r.text)
    assert keeper.doc_id == 7  # a row without a rank is last
    assert {s.first for r in out for s in r.removed} <= {7, None}
