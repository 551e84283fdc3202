import base64
import hashlib

import pyarrow as pa
import pytest
from helpers import awkward, frame, prose, with_clashes
from hypothesis import given
from hypothesis import strategies as st

from waterline.llm import arrowtext
from waterline.llm import byte_bpe as B

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MIXED = "Grüße, l'été — 日本語テスト 👩‍👩‍👧  　 it's  10³ \r\n\t\x00x́ <|endoftext|> Ⅻ ５ ﻿"


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(PATH)


@pytest.fixture(scope="module")
def exact(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return B.Vocabulary.from_ranks(ranks, public_tokenizers.PATTERN)


def texts():
    return [
        MIXED, "", " ", "   lead", "trail   ", "a" * 3000, "日" * 700, " ".join(prose(1, 30_000)), "\n\n  \n x", MIXED * 300, "don't DON'T we'Re",
        "x" + " " * 70_000 + "y", "　 ".join(["ab"] * 40_000),
    ]


def encoded(rows, vocabulary):
    ids, cuts = B.encode_texts(pa.array(rows, pa.string()), vocabulary.serialised)
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def test_ids_equal_those_by_ranks(vocabulary, exact):
    got = encoded(texts(), vocabulary)
    assert got == [exact.encode_ordinary(t) for t in texts()]
    assert B.decode_lists(pa.array(got, pa.list_(pa.int32())), vocabulary)[0] == [t.encode() for t in texts()]


def test_every_character_among_others(vocabulary, exact):
    lines = [f"a{chr(c)}1 {chr(c)}{chr(c)} b" for c in [*range(0x3000), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F700)]]
    assert encoded(lines, vocabulary) == [exact.encode_ordinary(t) for t in lines]


def test_texts_are_cut_where_ids_do_not_change(exact):
    rows = ["  two  words\tand  é x éé y", "", "日本 語　 x ~ z", MIXED * 3]
    data, offsets = arrowtext.utf8(pa.array(rows))
    starts = [*B.part_starts(data, offsets).tolist(), len(data)]
    parts = [data[a:b].tobytes().decode() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert "".join(parts) == "".join(rows) and set(offsets.tolist()) <= set(starts) and " é" not in parts and " x" in parts
    assert [i for p in parts for i in exact.encode_ordinary(p)] == [i for r in rows for i in exact.encode_ordinary(r)]


@given(st.lists(st.text(st.sampled_from("ab 1'\t\n.é\u00a0\u3000\u2009日s")), max_size=6))
def test_any_texts(rows):
    ranks = {bytes([b]): b for b in range(256)} | {b" a": 256, b"ab": 257, b"\xc3\xa9": 258, b"'s": 259, b"  ": 260}
    small = B.Vocabulary.from_ranks(ranks, public_tokenizers.PATTERN)
    exact = tiktoken.Encoding("any", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert encoded(rows, small) == [exact.encode_ordinary(t) for t in rows]


def test_offsets_equal_the_librarys(vocabulary):
    rows = [MIXED, "", "日本 naïve 👩‍👧"]
    ids, cuts = B.encode_texts(pa.array(rows), vocabulary.serialised)
    starts, ends = B.character_offsets(pa.array(rows), B.token_bytes(ids, vocabulary.offsets), cuts)
    for k, text in enumerate(rows):
        one = B._engine(vocabulary.serialised).encode(text, add_special_tokens=False)
        own = slice(cuts[k], cuts[k + 1])
        assert list(zip(starts[own].tolist(), ends[own].tolist(), strict=True)) == one.offsets


def test_split_characters_come_whole(vocabulary):
    ids, cuts = B.encode_texts(pa.array([MIXED]), vocabulary.serialised)
    sizes = B.token_bytes(ids, vocabulary.offsets)
    starts, ends = B.character_offsets(pa.array([MIXED]), sizes, cuts)
    assert (starts[1:] < ends[:-1]).any()  # some are split
    assert "".join(B.token_texts(MIXED.encode(), sizes)) == MIXED


def test_a_token_that_no_merge_makes_is_taken_whole():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257}
    vocabulary = B.Vocabulary.from_ranks(ranks, public_tokenizers.PATTERN)
    exact = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cases = ["xyz", "xyzxyz", "abab xyz", "aab"]
    assert encoded(cases, vocabulary) == [exact.encode_ordinary(t) for t in cases]
    assert B.last_parts(b"xyz", ranks) is None
    with pytest.raises(ValueError):
        B.Vocabulary.from_ranks({b"a": 0}, public_tokenizers.PATTERN)


def test_frames(spark, vocabulary, exact):
    shared = vocabulary.share(spark)
    rows = with_clashes(awkward(spark)).selectExpr("*", "CAST(1 AS INT) AS ids", "'x' AS starts")
    got = B.encode(rows, shared, offsets=True, keep_text=True)
    assert got.columns[-3:] == ["ids", "starts", "ends"]
    found = B.decode(got.repartition(3), shared, pieces=True).collect()
    assert len(found) == rows.count()
    for r in found:
        text = r.text or ""
        assert r.ids == exact.encode_ordinary(text) and r.decoded == bytearray(text.encode()) and r.decoded_text == text
        assert "".join(r.pieces) == text and (not r.ids or (r.starts[0] == 0 and r.ends[-1] == len(text)))
    digests = {r.doc_id: r for r in B.round_trip_digests(B.encode(awkward(spark).select("doc_id", "text"), shared), shared).collect()}
    want = exact.encode_ordinary("ÄÖ ÿ 　x   y")
    assert digests[9].n_tokens == len(want) and digests[9].decoded_sha256 == hashlib.sha256("ÄÖ ÿ 　x   y".encode()).hexdigest()
    assert digests[9].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
    assert digests[1].n_tokens == 0 and digests[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert B.encode(frame(spark, []), shared).count() == 0


def test_ids_without_a_token_decode_to_null(spark, vocabulary):
    rows = spark.createDataFrame([(1, [50256]), (2, [-1]), (3, None), (4, [5, None]), (5, []), (6, [255, 0])], "doc_id long, ids array<int>")
    got = {r.doc_id: r for r in B.decode(rows, vocabulary.share(spark), pieces=True).collect()}
    assert all(got[k].decoded is None and got[k].pieces is None for k in (1, 2, 3, 4))
    assert got[5].decoded == b"" and len(got[6].decoded) == 2
    assert B.round_trip_digests(rows, vocabulary.share(spark)).filter("doc_id = 1").first().decoded_sha256 is None


def test_rank_file(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)) + b"\n")
    assert B.read_ranks(str(path))[b"\xff"] == 255
