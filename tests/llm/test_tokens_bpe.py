import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from casewise.llm.bpe import TreeEncoder, encode_decode, encode_run, split_leaves
from casewise.llm.tokens import ChunkEncoder

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = ["", " ", "a  b", "\n\nx", "don't 'stop 'll x's", "日本語 テスト  é́", "a\x1cb c", "<|endoftext|> hi<|startoftext|>",
       "Σας ΑΣ ΣΑΣ", "İstanbul K", "tab\t\tq 'r 're 've", "½ ² 3.14 10,000", "a ́b", "foo\n bar \n baz", " lead",
       "trail ", "a\x7fb \x00c", "\xad soft", "``'s''s 's's", "fin.\r\n\r\nNext", "x" * 3000, "ab " * 900]


def random_texts(n, seed=1, size=40):
    rnd = random.Random(seed)
    alphabet = "ab'sé \n\t\xa0.,!0½日ΣKı́\x85 <|"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, size))) for _ in range(n)]


@pytest.mark.parametrize("path, kind", [(BYTE, "byte"), (WORD, "word")])
def test_chunks_equal_the_library(path, kind):
    enc = ChunkEncoder(path, kind)
    texts = ODD + random_texts(1500)
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == enc.library.encode(text, add_special_tokens=False).ids, text
    assert [x.tolist() for x in enc.encode([None])] == [[]]


def test_tree_equals_whole_encoding():
    enc = TreeEncoder(BYTE)
    texts = ODD + random_texts(300, 2, 400) + ["".join(random.Random(3).choices("theandingsé", k=5000)), "ab<|endoftext|>" * 50, "a'll 're " * 60]
    for text in texts:
        for leaf in (7, 33, 200):
            parts = split_leaves(text, leaf)
            assert "".join(parts) == text and all(len(p) <= leaf for p in parts)
            got = enc.tree([(p, x.tolist()) for p, x in zip(parts, enc.chunks.encode(parts), strict=True)])
            assert got == enc.library.encode(text, add_special_tokens=False).ids, (text, leaf)


def test_unsplit_run():
    enc = TreeEncoder(BYTE)
    for seed in range(30):
        run = "".join(random.Random(seed).choices(["the", "and", "ing", "e", "r", "s", "ü"], k=400))
        for leaf in (5, 40):
            assert encode_run(run.encode(), enc.raw, enc.text, leaf) == enc.library.encode(run, add_special_tokens=False).ids


def test_operator(spark):
    texts = [*ODD, None, "word " * 50, "word " * 50, "ü" * 333]
    docs = spark.createDataFrame([(i if i % 5 else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    got = encode_decode(docs, BYTE, keep=["doc_id"], leaf_chars=64).collect()
    lib = ChunkEncoder(BYTE, "byte").library
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = [(i if i % 5 else None, (ids := lib.encode(t or "", add_special_tokens=False).ids), lib.decode(ids, skip_special_tokens=False)) for i, t in enumerate(texts)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert encode_decode(docs.limit(0), BYTE).count() == 0
    assert encode_decode(docs.withColumn("decoded", F.lit(1)), BYTE).columns == ["doc_id", "ids", "decoded"]
