"""Encoding, spans and decoding against the library, with and without a character map."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tidalfed.llm import pieces, queries

PATH = queries.tokenizer(pieces.MODEL)
LETTERS = (" \n\tabcABC.,ⅧİééÅ½▁▁  \0�\U0001f600日本語한<s></s><0x41>’ﬁ​́"
           "ｶﾞｱ㍿　ﷺ각")


def texts(seed, n, most):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, most))) for _ in range(n)]


def assert_same(model, library, some):
    for text in some:
        ids, begins, ends = model.encoded(text)
        wanted = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in wanted], repr(text)
        for i, begin, end, p in zip(ids, begins, ends, wanted):
            if not model.is_byte[i]:  # byte pieces: the whole character's span here
                assert (begin, end) == (p.begin, p.end), repr(text)
        assert model.decoded(ids) == library.decode(ids.tolist()), repr(text)


def test_model_as_given():
    model = pieces.Pieces(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert_same(model, library, texts(1, 3000, 30))
    assert_same(model, library, ["ab" * 5000, "\U0001f9ff" * 50, "a" * 20_001, " " * 3000])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("suffix", [False, True])
def test_character_maps(tmp_path, rule, prefix, squeeze, suffix):
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    source = sentencepiece_model_pb2.ModelProto()
    source.ParseFromString(normalizer.serialized_model_proto())
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.normalizer_spec.precompiled_charsmap = source.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.add_dummy_prefix = prefix
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    proto.trainer_spec.treat_whitespace_as_suffix = suffix
    path = tmp_path / "mapped.model"
    path.write_bytes(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    assert_same(pieces.Pieces(str(path)), library, texts(2, 400, 20))


def test_spans_cover_the_text():
    model = pieces.Pieces(PATH)
    for text in texts(3, 300, 30):
        source = text.encode()
        ids, begins, ends = model.encoded(text)
        assert (np.diff(begins) >= 0).all() and (ends >= begins).all()
        assert not len(ids) or (begins[0] == 0 and ends[-1] == len(source))
        if not model.is_byte[ids].any():
            assert b"".join(source[a:b] for a, b in zip(begins, ends)) == source


def test_decoding_any_ids():
    model = pieces.Pieces(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    draw = random.Random(4)
    some = [0, 1, 2, *(3 + b for b in (0xE2, 0x96, 0x81, 0xF0, 0x9F, 0x98, 0x80, 0x20)),
            259, 450, 13, 28705, 29871, 31822]
    for _ in range(5000):
        ids = [draw.choice(some) for _ in range(draw.randint(0, 9))]
        assert model.decoded(np.array(ids, np.int64)) == library.decode(ids), ids


def test_query(spark, small):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = {r["doc_id"]: r["text"] for r in
            spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.QUERIES["op11_sentencepiece"](spark, small).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(rows[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark):
    schema = "doc_id long, text string, ids string, decoded int, _text string"
    rows = [(1, None, "x", 1, "y"), (1, "", None, None, None), (None, " \n", "x", 1, "y"),
            (2, "word " * 300_000, "x", 1, "y"), (2, "word " * 300_000, "x", 1, "y")]
    got = pieces.digests(spark.createDataFrame(rows, schema), PATH).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "2", "2", "None"]
    assert [(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
            for r in got if r["doc_id"] == 1] == [(0, empty, empty)] * 2
    assert len({r["decoded_sha256"] for r in got if r["doc_id"] == 2}) == 1
    assert pieces.digests(spark.createDataFrame([], schema), PATH).collect() == []
