"""SentencePiece encoding and decoding against the library."""

import random
import tracemalloc

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from gaugeframe.llm import sentencepiece_bpe as bpe  # noqa: E402
from gaugeframe.llm.sentencepiece_bpe import Pieces, decode, encode  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Pieces.read(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def split(flat, counts):
    ends = np.cumsum(counts)
    return [flat[e - n : e].tolist() for e, n in zip(ends, counts)]


def made_up(seed):
    rng = random.Random(seed)
    parts = ["a", "b", "t", "h", "e", " ", "  ", "th", "in", "▁", "\n", "1", "é", "你", "😀", "　",
             "-", "=", ".", "x", "\t", "ñ", "ß", "\x00", " the", " an", "</s>", "<0x0A>", "�"]
    out = ["", " ", "  ", "a", "<s></s>", "\n", "▁▁"]
    out += [" " * n + tail for n in range(14, 36) for tail in ("", "x", "word", ".")]
    out += ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(1_500)]
    # Long words, with the same pair at many places, next to each other or not.
    out += ["".join(rng.choices(["the", "in", "er", "an", "th"], k=rng.randrange(50, 900)))
            for _ in range(80)]
    out += ["".join(rng.choices(" -=a", k=rng.randrange(50, 900))) for _ in range(80)]
    out += [c * 777 for c in ("a", "th", "-", "=", "ab", "nn", "zz", "***", "é")]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ids_and_texts_equal_the_library(pieces, library, seed):
    texts = made_up(seed)
    got = split(*pieces.encode(texts))
    decoder = pieces.decoder()
    for text, ids in zip(texts, got):
        assert ids == library.encode(text), repr(text)
        with_end = ids + [pieces.end_id]
        assert decoder.decode(np.array(with_end, np.int64)).decode() == library.decode(with_end)


def test_any_ids_decode_like_the_library(pieces, library):
    rng = random.Random(3)
    decoder = pieces.decoder()
    for _ in range(3_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3), 259, 29871])
               for _ in range(rng.randrange(10))]
        assert decoder.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


@pytest.mark.parametrize("chunk", [40, 1_000])
def test_cuts_of_long_texts_change_nothing(pieces, library, monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    texts = made_up(4)[:600] + ["one two " * 400, "x" * 3_000, " " * 2_000 + "end"]
    assert split(*pieces.encode(texts)) == [library.encode(t) for t in texts]


def test_long_words_and_memory(pieces, library):
    rng = random.Random(5)
    word = "".join(rng.choices("aeinorstlkm", k=150_000))
    assert pieces.encode([word])[0].tolist() == library.encode(word)
    text = "some words in a row, " * 150_000  # 3 million characters
    tracemalloc.start()
    flat, _ = pieces.encode([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert flat.tolist() == library.encode(text) and peak < 400e6


def test_tables_with_nulls_repeats_and_clashing_columns(spark, pieces, library):
    rows = [(1, "Hello  wörld", "x", "y"), (1, "Hello  wörld", "x", "y"), (None, None, "x", None),
            (3, "", None, "z"), (4, "tab\tand\nline", "q", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    coded = encode(docs.repartition(2), pieces)
    assert coded.columns == ["doc_id", "text", "decoded", "ids"]
    out = decode(coded, pieces).orderBy("doc_id").collect()
    assert sorted(r["ids"] for r in out) == sorted(library.encode(t or "") + [2] for _, t, _, _ in rows)
    assert all(r["decoded"] == (r["text"] or "") for r in out)
    assert decode(encode(docs.limit(0), pieces), pieces).count() == 0
    odd = spark.createDataFrame([([5, None, 99_999, -4],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in decode(odd, pieces).collect()] == [
        library.decode([5]), "", ""]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.byte_fallback = False
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="byte fallback"):
        Pieces.read(str(tmp_path / "m.model"))
