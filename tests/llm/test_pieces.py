"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from cohortlens.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = [
    "Hello world  a\n b ", "", " ", "   ", None, "▁", "▁▁a", "a▁b", " a", "a ", "\n", "\n\n a", "<s> </s> <unk> <0x0A>", " ⁇ ", "x" * 5000,
    " " * 5000, "ab" * 3000, "日本語テキスト" * 50, "\x00a\x00", "😀👍🏽", "1234567 89", "the theses there" * 20, "aaaa  bbbb   cccc    d     e",
]


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(PATH, 2000)


def round_trip(codec, texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in codec.encode(texts)]
    assert got == [LIBRARY.encode(t or "") for t in texts]
    ended = [g + [codec.end_id] for g in got]
    flat = np.array([i for g in ended for i in g], np.int64)
    assert codec.decode(flat, np.cumsum([0, *map(len, ended)])) == [LIBRARY.decode(g) for g in ended]


def test_odd_texts(codec):
    round_trip(codec, ODD)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(codec, seed):
    draw = random.Random(seed)
    some = [*"abcdefghiejklmnopqrstuvwxyz  eeetthhaaiinn   ABCTHE019.,\n\t▁é", "ing", "tion", "the", " the", "    "]
    every = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    round_trip(codec, ["".join(draw.choice(some if draw.random() < 0.97 else every) for _ in range(draw.randrange(60))) for _ in range(5000)])


def test_any_ids_decode_as_the_library_does(codec):
    draw = random.Random(3)
    rows = [[draw.randrange(32000 if draw.random() < 0.6 else 300) for _ in range(draw.randrange(12))] for _ in range(3000)]
    flat = np.array([i for r in rows for i in r], np.int64)
    assert codec.decode(flat, np.cumsum([0, *map(len, rows)])) == [LIBRARY.decode(r) for r in rows]


def test_forgetting_pairs_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "PAIRS", 3)
    round_trip(pieces.PieceCodec(PATH, 5), ODD[:12] * 2)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.byte_fallback = False
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceCodec(str(tmp_path / "m"))


def test_rows_and_columns(spark):
    rows = [*((i, t, "a") for i, t in enumerate(ODD)), (None, "of no key", "b"), (3, "again", "c"), (3, "again", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(1))
    encoded = pieces.encode_pieces(docs, PATH, keep=("doc_id",))
    assert encoded.columns == ["doc_id", "ids"]
    want = sorted(((i, LIBRARY.encode(t or "") + [2]) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == want
    decoded = pieces.decode_pieces(encoded.union(spark.createDataFrame([(99, None)], "doc_id long, ids array<int>")), PATH)
    texts = sorted([*((i, LIBRARY.decode(ids)) for i, ids in want), (99, None)], key=str)
    assert sorted(((r.doc_id, r.decoded) for r in decoded.collect()), key=str) == texts
    assert pieces.decode_pieces(pieces.encode_pieces(docs.limit(0), PATH), PATH).collect() == []


def test_query(spark):
    got = queries.op13_pieces(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_eos=True)
        want.append((d.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(LIBRARY.decode(ids))))
    assert sorted(tuple(r) for r in got) == sorted(want)
