import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barloom.llm import pair_index_bpe as bpe
from barloom.llm.queries import op11_pair_index_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "aabbé'stredllmvΣİßǅ  \n\t09½²<|startoftext|>ةक्षि한글é하͸\U0001f600Ɤ\x00\x85"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), raw, library.decode(ids, skip_special_tokens=False)


def test_random_texts_as_the_library_and_small_memory(library):
    random.seed(5)
    texts = ["".join(random.choices(LETTERS, k=random.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 5001, "<|endoftext|>", "<|endoftext|><|startoftext|>x<|endoftext|>", "", "A<|endoftext|>'s", "ΑΣ ΟΔΟΣ", "I'LL we'Re"]
    codec = bpe.Codec(bpe.Vocabulary(PATH), memory=50_000)
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert (len(ids), ids.tobytes(), codec.decode(ids)) == expected(library, text), text


def test_overlapping_pairs_join_from_the_left():
    class Toy:
        left, right, made = np.array([0, 2]), np.array([0, 0]), np.array([2, 3])

    merged = lambda *w: [x.tolist() for x in bpe.PairIndex(Toy).merge(np.array(sum(w, [])), np.array(list(map(len, w))))]
    assert merged([0, 0, 0]) == [[3], [1]]
    assert merged([0, 0, 0, 0, 0], [1], [0, 0]) == [[2, 3, 1, 2], [2, 1, 1]]


def test_merges_out_of_order_are_refused(tmp_path):
    data = json.loads(open(PATH, encoding="utf-8").read())
    data["model"]["merges"].append(data["model"]["merges"].pop(0))
    path = tmp_path / "other.json"
    path.write_text(json.dumps(data), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(path))


def test_query_over_whole_tables(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op11_pair_index_bpe(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        n, raw, decoded = expected(library, text or "")
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (n, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_edge_rows_and_decoding(edge_docs, no_docs, library):
    coded = bpe.encode(edge_docs, PATH, ["doc_id"])
    rows = coded.collect()
    assert len(rows) == edge_docs.count()
    texts = {r.doc_id: r.text for r in edge_docs.select("doc_id", "text").collect()}
    for r in rows:
        assert (r.n_tokens, bytes(r.ids), r.decoded) == expected(library, texts[r.doc_id] or "")
    back = bpe.decode(coded.select("doc_id", "ids"), PATH, ["doc_id"])
    assert sorted((r.doc_id or 0, r.decoded) for r in back.collect()) == sorted((r.doc_id or 0, r.decoded) for r in rows)
    assert bpe.encode(no_docs, PATH, ["doc_id"]).count() == 0
    assert bpe.encode_digests(no_docs, PATH, ["doc_id"]).count() == 0
