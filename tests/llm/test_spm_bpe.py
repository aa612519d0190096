import hashlib
from array import array

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import spm_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = spm_bpe.read_ranks(PATH)
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = spm_bpe.codec_factory(PATH, PATTERN)()


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_are_those_of_tiktoken(text):
    ids = CODEC.encode(text)
    assert ids == array("I", TIKTOKEN.encode_ordinary(text)).tobytes()
    assert CODEC.decode(ids) == text.encode()


def test_every_entry_of_the_vocabulary_is_one_piece():
    mapped = [t.decode("latin-1").translate(CODEC.letters) for t in CODEC.tokens]
    assert CODEC.pieces.encode(mapped) == [[i] for i in range(len(mapped))]


def test_other_vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = spm_bpe.codec_factory(path, PATTERN)()
    other = tiktoken.Encoding("o", pat_str=PATTERN, mergeable_ranks=spm_bpe.read_ranks(path), special_tokens={})
    for text in ("größer è già", "中文 текст", "a  b\n\n c"):
        assert codec.encode(text) == array("I", other.encode_ordinary(text)).tobytes()


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(spm_bpe, "MEMORY", 1000)
    codec = spm_bpe.codec_factory(PATH, PATTERN)()
    for text in ("one two three four", "five six seven", "one two eight nine ten eleven twelve"):
        assert codec.encode(text) == array("I", TIKTOKEN.encode_ordinary(text)).tobytes()


def test_edges(edge_docs, no_docs):
    rows = spm_bpe.encode_digests(edge_docs, PATH, PATTERN, ["doc_id"]).collect()
    texts = {r.doc_id: r.text or "" for r in edge_docs.collect()}
    assert len(rows) == edge_docs.count()
    for r in rows:
        ids = array("I", TIKTOKEN.encode_ordinary(texts[r.doc_id])).tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert spm_bpe.encode(no_docs, PATH, PATTERN, ["doc_id"]).count() == 0
