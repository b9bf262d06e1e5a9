import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallyward.llm import bpe, packing
from tallyward.llm import codec as codec_module
from tallyward.llm.codec import Codec
from tallyward.llm.queries import VOCABULARY, op6_bpe, op7_best_fit_packing

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a", "a  ", "a   b", "x\n  b", "<|endoftext|> a<|endoftext|>b", "a \x1c b", "it's 12 \t z's\n\n\n  q", "\n \n a", "a\x85 b", "　 b", "a" * 5000, "ab " * 4000, "中文没有空格" * 900]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("length", T.StringType()), T.StructField("salt", T.StringType())])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def random_texts(n):
    rnd = random.Random(7)
    parts = ["a", "b ", " ", "\n", "\t", "'s", "1", "é", " ", "中", "\x1c", "<|endoftext|>", "<|endo", "ftext|>", "!", "🙂", "lorem ipsum "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(n)]


def test_codec_gives_the_ids_of_the_library(library):
    texts = ODD + random_texts(1500)
    got = Codec.of(VOCABULARY).encode_many([t.encode() for t in texts])
    for text, ids in zip(texts, got):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, repr(text)
        assert Codec.of(VOCABULARY).decode(ids) == library.decode(expected, skip_special_tokens=False)


def twins(n):
    """Two words whose polynomial hashes modulo 2^64 are equal for every odd base."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [8, 16, 24, 512, 1024, 2048])
@pytest.mark.parametrize("apart", [False, True])
def test_ids_are_reused_for_equal_bytes_only(library, n, apart):
    codec, pair = Codec(VOCABULARY), [f"{t} {t}" for t in twins(n)]
    batches = [[pair[0]], [pair[1]]] if apart else [pair]
    got = [ids.tolist() for texts in batches for ids in codec.encode_many([t.encode() for t in texts])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in pair]


def test_pieces_with_equal_keys_keep_their_own_ids(library, monkeypatch):
    monkeypatch.setattr(codec_module, "_keys", lambda words, sizes: np.full(len(sizes), np.uint64(5)))
    codec, texts = Codec(VOCABULARY), ODD + random_texts(200)
    for _ in range(2):
        for text, ids in zip(texts, codec.encode_many([t.encode() for t in texts])):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_colliding_words_in_encoding_and_packing(spark, library):
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate([*twins(1024), *twins(2048)])], SCHEMA)
    for row in bpe.encode_documents(docs.coalesce(1), VOCABULARY).collect():
        assert row.decoded in (*twins(1024), *twins(2048)) and row.token_ids == library.encode(row.decoded, add_special_tokens=False).ids
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_packing(packing.best_fit_packing(docs.coalesce(1), VOCABULARY).toPandas(), texts, library, 1024)


@pytest.mark.parametrize("mean", [3, 40])
def test_chunk_joins_are_repaired(library, monkeypatch, mean):
    monkeypatch.setattr(bpe, "MEAN_CHUNK", mean)
    monkeypatch.setattr(bpe, "WINDOW", 2)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 20_000)  # the table forgets
    table = bpe.ChunkTable(Codec.of(VOCABULARY))
    texts = ODD + random_texts(800)
    for text, ids in zip(texts, table.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_shared_passage_is_encoded_once():
    rnd = random.Random(1)
    passage = " ".join("".join(rnd.choices("abcdefg", k=5)) for _ in range(2000))
    table = bpe.ChunkTable(Codec.of(VOCABULARY))
    table.encode(["one start " + passage])
    known = set(table.known)
    table.encode(["another, longer beginning " + passage])
    assert len(set(table.known) - known) <= 2


def test_op6_rows(spark, library):
    rows = {r.doc_id: r for r in op6_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text, add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_documents_gives_ids_and_text(spark):
    df = spark.createDataFrame([(1, "a b", "x", "y"), (2, None, None, None), (None, "c", None, None)], SCHEMA)
    rows = sorted(bpe.encode_documents(df, VOCABULARY).collect(), key=lambda r: str(r.doc_id))
    assert [(r.doc_id, r.decoded) for r in rows] == [(1, "a b"), (2, ""), (None, "c")]
    assert rows[1].token_ids == []


def check_packing(rows: pd.DataFrame, texts: dict, library, size: int):
    for doc_id, own in rows.groupby("doc_id"):
        ids = np.array([*library.encode(texts[doc_id], add_special_tokens=False).ids, 2], "<u4")
        own = own.sort_values("piece")
        assert own.piece.tolist() == list(range(len(own)))
        assert own.length.sum() == len(ids) and own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        if len(ids) <= size:
            assert len(own) == 1
        assert (own.length.iloc[1:] == size).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for _, seq in rows.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == [0, *seq.length.cumsum().tolist()[:-1]]
        assert seq.length.sum() <= size


def test_op7_rows(spark, library):
    rows = op7_best_fit_packing(spark, SF).toPandas()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(rows.doc_id) == set(texts)
    check_packing(rows, texts, library, 1024)
    least = -(-int(rows.length.sum()) // 1024)
    assert rows.sequence_id.nunique() <= least * 1.02 + 1


def test_packing_of_odd_rows(spark, library):
    data = [(i, t, "x", None) for i, t in enumerate(ODD)] + [(3, ODD[3], None, None), (99, None, None, None)]
    rows = packing.best_fit_packing(spark.createDataFrame(data, SCHEMA), VOCABULARY, size=64).toPandas()
    doubled = rows[rows.doc_id == 3]
    assert len(doubled) == 2 and (doubled.piece == 0).all()
    for _, seq in rows.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == [0, *seq.length.cumsum().tolist()[:-1]] and seq.length.sum() <= 64
    check_packing(rows[rows.doc_id != 3].assign(sequence_id=range(len(rows) - 2), offset=0), {**dict(enumerate(ODD)), 99: ""}, library, 64)
    assert packing.best_fit_packing(spark.createDataFrame([], SCHEMA), VOCABULARY).count() == 0
    assert bpe.bpe_digests(spark.createDataFrame([], SCHEMA), VOCABULARY).count() == 0


def test_best_two_fit_places_all_and_swaps_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]  # 6+3 leaves 1; 3 is replaced by 2+2
    assert packing.best_two_fit(counts, 10) == [([6, 2, 2], 1), ([3], 1)]
    rnd = np.random.default_rng(0)
    for _ in range(20):
        counts = np.zeros(65, np.int64)
        counts[1:] = rnd.integers(0, 50, 64) * (rnd.random(64) < 0.5)
        patterns = packing.best_two_fit(counts, 64)
        placed = np.zeros(65, np.int64)
        for lengths, bins in patterns:
            assert sum(lengths) <= 64
            np.add.at(placed, lengths, bins)
        assert (placed == counts).all()
