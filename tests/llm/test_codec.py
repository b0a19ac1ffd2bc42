import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from modenorm.llm import curve_pack, piece_codec, queries, token_store
from modenorm.llm.word_ids import WordIds
from tests.conftest import SF001

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = ["a", "b", "The", " ", " ", "  ", "\n", "\t", "é", "É", "漢", "😀", "'s", "'", "1", "23", ".", ",", "!!", " ",
            "\x1c", "́", "İ", "Σ", "ß", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "<|endof", "\r", "word", "?", "▁", "<s>", "\x00", "thing", "the "]


def texts(n=2500, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + [
        "", " ", "\n", "\n\n", "a\n\nb", " a", "a ", " " * 70, "a" * 3000, " " * 500 + "x", "aa  " * 100,
        "".join(rnd.choice("aeinst hr") for _ in range(40_000))]


def test_pieces_equal_the_library():
    model = piece_codec.PieceModel(piece_codec.read_model(PIECES))
    import codecs
    codecs.register_error("each-byte", piece_codec._each_byte)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    cache, all_texts = {}, texts()
    for k in range(0, len(all_texts), 300):
        part = all_texts[k:k + 300]
        for t, data in zip(part, model.encode_texts(part, cache)):
            ids = np.frombuffer(data, "<u4")
            assert ids.tolist() == library.encode(t, add_bos=True, add_eos=True), repr(t)
            assert model.decode_ids(ids) == library.decode(ids.tolist()), repr(t)


def test_decode_of_broken_bytes_equals_the_library():
    model = piece_codec.PieceModel(piece_codec.read_model(PIECES))
    import codecs
    codecs.register_error("each-byte", piece_codec._each_byte)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rnd = random.Random(1)
    for _ in range(1500):
        ids = [rnd.choice([0, 1, 2, 3, 50, 200, 226, 133, 29871, 259, 263, 300, 13]) for _ in range(rnd.randint(0, 8))]
        assert model.decode_ids(np.array(ids, "<u4")) == library.decode(ids), ids


def test_op1_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.op1_sentencepiece(spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        ids = library.encode(text[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_encode_then_decode_as_two_steps(spark):
    df = spark.createDataFrame([(1, "two words"), (2, None), (3, "")], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in piece_codec.decode(piece_codec.encode(df, PIECES), PIECES).collect()}
    assert rows == {1: "two words", 2: "", 3: ""}


@pytest.mark.parametrize("name, lowered", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_word_ids_equal_the_library(name, lowered):
    with open(public_tokenizers.path(name), "rb") as f:
        words = WordIds(f.read(), lowered)
    library = Tokenizer.from_file(public_tokenizers.path(name))
    all_texts = texts(4000, 9)
    for k in range(0, len(all_texts), 300):
        part = all_texts[k:k + 300]
        ids, at = words.encode(pa.array([*part, None], pa.string()))
        assert len(at) == len(part) + 2 and at[-1] == at[-2] == len(ids)
        for t, a, b, ref in zip(part, at, at[1:], library.encode_batch(part, add_special_tokens=False)):
            assert ids[a:b].tolist() == ref.ids, repr(t)


def test_simple8b_round_trip():
    rnd = np.random.default_rng(1)
    for k in range(150):
        n, high = int(rnd.integers(0, 4000)), int(rnd.integers(0, 63))
        v = rnd.integers(0, 2 ** 63, n).astype(np.uint64) >> np.uint64(63 - high)
        if k % 3 == 0:
            v[rnd.random(n) < 0.1] = np.uint64(2 ** 64 - 1)
        if k % 5 == 0:
            v[:] = token_store.ESCAPE
        if k % 4 == 1:
            v[rnd.random(n) < 0.97] = 0
        words, offsets = token_store.encode_blocks(v)
        assert (token_store.decode_blocks(words, offsets, n) == v).all()
    zeros = np.zeros(1024, np.uint64)
    assert len(token_store.encode_blocks(zeros)[0]) == 5  # four words of 240 and the rest


def test_op4_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF001}/documents.parquet").collect())
    rows = {r.doc_id: r for r in queries.op4_token_store(spark, SF001).collect()}
    assert len(rows) == len(docs)
    start = 0
    for doc, text in docs:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        r = rows[doc]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_hilbert_keys_visit_neighbours():
    points = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = curve_pack.hilbert_keys(points, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_op6_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    ids = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for d, t in docs.items()}
    rows = queries.op6_packing(spark, SF001).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert len(own) == r.length > 0 and r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert by_doc.keys() == docs.keys()
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[d])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0  # full, or a power of two: no padding at all


def test_added_tokens_are_the_librarys(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "x<|endoftext|><|endoftext|>\n y  z"), (4, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: [*library.encode(t, add_special_tokens=False).ids, 0] for d, t in rows}
    assert want[1] == [64, 220, 50256, 275, 0]
    got = {r.doc_id: r for r in curve_pack.pack(df, public_tokenizers.path("byte_bpe_50k.json")).collect() if r.length == r.doc_tokens}
    assert all(r.ids_crc32 == zlib.crc32(np.array(want[d], "<u4").tobytes()) for d, r in got.items()) and got


CLASH = "doc_id long, text string, ids string, start long, n_tokens long, length int, sequence_id string"


@pytest.mark.parametrize("name", ["op1", "op4", "op6"])
def test_codec_edges(spark, tmp_dir, name):
    """Empty tables, null ids, null and empty texts, repeated rows, a very long text, columns with clashing names."""
    rows = [(5, "one two"), (5, "one two"), (None, "no id"), (2, None), (3, ""), (4, "long words <|endoftext|> " * 60_000), (None, None)]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], CLASH)
    json_path = public_tokenizers.path("word_bpe_49k.json" if name == "op4" else "byte_bpe_50k.json")

    def apply(frame, at):
        if name == "op1":
            return piece_codec.digests(frame, PIECES)
        return token_store.store_digests(frame, f"{tmp_dir}/{at}", json_path) if name == "op4" else curve_pack.pack(frame, json_path)

    assert apply(df.limit(0), "none").collect() == []
    out = apply(df, "all").collect()
    if name == "op1":
        library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        want = sorted((str(d), len(ids := library.encode(t or "", add_bos=True, add_eos=True)),
                       hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()) for d, t in rows)
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256) for r in out) == want
        return
    library = Tokenizer.from_file(json_path)
    ids = [(str(d), np.array([*library.encode(t or "", add_special_tokens=False).ids, 1 if name == "op4" else 0], "<u4")) for d, t in rows]
    if name == "op4":
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in out) == sorted((d, len(x), zlib.crc32(x.tobytes())) for d, x in ids)
        ends = sorted((r.start, r.start + r.n_tokens) for r in out)
        assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    else:
        assert sum(r.length for r in out) == sum(len(x) for _, x in ids)
        known = {(d, len(x)): x for d, x in ids}
        for r in out:
            x = known[str(r.doc_id), r.doc_tokens]
            assert zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32


def test_copies_spread_over_partitions_and_neighbours_meet(spark):
    rows = [(k, "the same words again") for k in range(3000)]
    out = curve_pack.pack(spark.createDataFrame(rows, "doc_id long, text string"),
                          public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len({r.sequence_id >> 33 for r in out}) > 4
    assert sum(r.length for r in out) == 3000 * out[0].doc_tokens


@pytest.mark.parametrize("name", ["op4", "op6"])
def test_partitions_follow_measured_bytes_and_a_hot_id_spreads(spark, monkeypatch, tmp_dir, name):
    from modenorm.sources import io

    monkeypatch.setattr(io, "PARTITION_BYTES", 20_000)
    rows = [(7 if k % 3 == 0 else k, "the same words again " * 5 + str(k if k % 2 else "")) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json" if name == "op4" else "byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    n_ids = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    if name == "op4":
        token_store.write_tokens(df, f"{tmp_dir}/store", path, 1)
        held = spark.read.parquet(f"{tmp_dir}/store").groupBy("part").agg({"n_ids": "sum"}).collect()
        got = token_store.read_tokens(spark, f"{tmp_dir}/store").selectExpr("doc_id", "start", "octet_length(ids) DIV 4 AS n").collect()
        ends = sorted((r.start, r.start + r.n) for r in got)
        assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
        by_place = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
        assert by_place == sorted(d for d, _ in rows)
    else:
        out = curve_pack.pack(df, path).selectExpr("sequence_id >> 33 AS part", "length")
        held = out.groupBy("part").agg({"length": "sum"}).collect()
    sizes = [r[1] for r in held]
    assert sum(sizes) == n_ids and len(sizes) > 8 and max(sizes) < n_ids / 6
