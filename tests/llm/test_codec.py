import hashlib
import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from paperloom.llm import piece_codec as P  # noqa: E402
from tests.llm.cases import docs, no_docs, odd_docs, prose  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return P.PieceCodec(f.read())


def texts():
    rng = random.Random(7)
    letters = "ab é\n\t  ▁中\U0001f600\x00.,<s>0x0A \r\x0b　"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return made + [" ", "  lead", "tail  ", "\n\nx", "x\n", "▁▁a", "<0x0A>", "</s> <unk>", "a" * 5000, prose(1, 3000)] + [r[1] or "" for r in odd_docs()]


def test_ids_and_text_are_the_librarys(codec):
    for text in texts():
        ids = codec.encode(text)[0].tolist()
        assert ids == codec.library.encode(text), text
        assert codec.decode(ids) == codec.library.decode(ids), text


def test_spans_cover_the_source(codec):
    for text in texts():
        ids, begins, ends = codec.encode(text)
        data = text.encode()
        assert b"".join(data[a:b] for a, b in zip(begins, ends)) == data
        for a, b, i in zip(begins, ends, ids.tolist()):
            piece = codec.bytes_of[i]
            assert piece in (data[a:b].replace("▁".encode(), b" "), b" " + data[a:b].replace("▁".encode(), b" ")) or codec.kinds[i] == 6


def offsets(library, text):
    """The library's own offsets of each piece, in bytes of the text."""
    return [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]


def test_spans_are_the_librarys_offsets(codec):
    for text in texts():
        ids, begins, ends = codec.encode(text)
        assert list(zip(begins.tolist(), ends.tolist())) == offsets(codec.library, text), text


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [False, True])
def test_spans_with_a_full_map(rule, squeeze):
    """Against the library's offsets for a unigram model that is put together by hand, with a compiled map."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule) if rule != "identity" else None
    if made:
        spec.ParseFromString(made.serialized_model_proto())
    spec.normalizer_spec.add_dummy_prefix = True
    spec.normalizer_spec.remove_extra_whitespaces = squeeze
    spec.normalizer_spec.escape_whitespaces = True
    spec.trainer_spec.model_type = 1
    del spec.pieces[:]
    for piece, kind in [("<unk>", 2), ("<s>", 3), ("</s>", 3)] + [(p, 1) for p in ["▁", "a", "b", "c", "e", "f", "i", "n", "A", "B", "1", "2", "ab", "fi", "▁a", "▁fi", "ne", "株", "式", "ガ", "é", "(", ")", "x", "ss", "s", "t"]]:
        spec.pieces.add(piece=piece, score=-float(len(spec.pieces)) / 10, type=kind)
    codec = P.PieceCodec(spec.SerializeToString())
    rng = random.Random(3)
    letters = ["ab", " ", "  ", "ﬁ", "ne", "Ａ", "①", "㍿", "ｶﾞ", "e\u0301", "\u3000", "\u200b", "ß", "A", "c", "\t", "\n", "…", "q"]
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        ids, begins, ends = codec.encode(text)
        found = codec.library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in found] == codec.library.encode(text)
        assert codec.decode(ids.tolist()) == codec.library.decode(ids.tolist())
        want = offsets(codec.library, text)
        assert list(zip(begins.tolist(), ends.tolist())) == want, (text, ids, begins, ends, want)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_compiled_map(rule):
    """Normalisation by longest prefix gives what the library's normaliser gives, with sources."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False)
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(library.serialized_model_proto())
    table = P.CharacterMap(spec.normalizer_spec.precompiled_charsmap)
    for text in ["ＡＢＣ ①②", "ﬁne Å Å ㍿", "plain", "é é", "　x​", "ｶﾞ"]:
        data, out, at = text.encode(), b"", 0
        while at < len(data):
            size, piece = table.longest(data, at)
            if not size:
                size = next(k for k in (1, 2, 3, 4) if at + k == len(data) or data[at + k] & 0xC0 != 0x80)
                piece = data[at : at + size]
            out += piece
            at += size
        assert out.decode() == library.normalize(text), text


def test_query_rows(spark):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.digests(docs(spark, clash=("ids", "decoded")), PATH).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {(i, len(ids := library.encode(t or "")), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t, *_ in odd_docs()}
    assert got == want
    assert P.digests(no_docs(spark), PATH).collect() == []


def test_span_columns(spark, codec):
    for r in P.encode(docs(spark), PATH).join(docs(spark), "doc_id").select("text", "ids", "begins", "ends").collect():
        ids, begins, ends = codec.encode(r.text)
        assert r.ids == ids.tolist() and r.begins == begins.tolist() and r.ends == ends.tolist()


def test_query_has_the_spans_of_every_row(spark, codec):
    import numpy as np

    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts())] + [(9999, None, "en", "a", 0)]
    got = {r.doc_id: r.spans_sha256 for r in P.digests(docs(spark, rows), PATH).collect()}
    for i, t, *_ in rows:
        spans = offsets(codec.library, t or "")
        whole = np.array([a for a, _ in spans] + [b for _, b in spans], "<i4").tobytes()
        assert got[i] == hashlib.sha256(whole).hexdigest(), t
