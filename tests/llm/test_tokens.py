"""Encoding and decoding against the library, on texts that make both hard."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from barlight.llm import queries, tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "e", " ", "  ", "     ", "\n", "\r\n", "\t", "é", "中", "文", "▁", "<s>", "<0x0A>", "0", ".", "​", "😀", "ا", "in", "ing", "//", "==", "́", "\x00", "�", "한", "A", ");", " "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(4)
    pieces = sorted(tokens.model(PATH).id)
    out = [None, "", " ", "   ", "\n", "a", " a", "▁a", "<unk>", " " * 70 + "x", "ab" * 2000, "中" * 3000, "word " * 3000]
    out += ["".join(rng.choice(BITS) for _ in range(rng.randrange(80))) for _ in range(1500)]
    return out + ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(1500)]


def check(library, text, ids, decoded):
    want = library.encode(text or "", add_bos=True, add_eos=True)
    assert list(memoryview(bytes(ids)).cast("I")) == want, text
    assert decoded == library.decode(want), text


def test_as_the_library_does(library):
    m = tokens.model(PATH)
    for t in texts():
        ids = m.encode(t or "")
        check(library, t, ids, m.decode(ids))


def test_long_texts_in_parts(library, monkeypatch):
    monkeypatch.setattr(tokens, "PART", 40)
    m = tokens.Model(PATH)
    for t in texts():
        ids = m.encode(t or "")
        check(library, t, ids, m.decode(ids))


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    m = tokens.Model(PATH)
    for t in texts()[:400]:
        ids = m.encode(t or "")
        check(library, t, ids, m.decode(ids))


def test_takes_back_what_failed():
    """Backtracking is needed: the longest match doesn't always go with what was taken."""
    m = tokens.Model(PATH)
    taken_back = 0
    for t in texts():
        for unit in m.unit.findall((t or "").replace(" ", tokens.SPACE)):
            longest, at = [""] * len(unit), 0
            for last, (k, piece) in m.matches.iter(unit):
                longest[last - k] = piece
            greedy = []
            while at < len(unit) and longest[at]:
                greedy.append(m.id[longest[at]])
                at += len(longest[at])
            taken_back += at == len(unit) and greedy != m.encoded(unit)
    assert taken_back > 100


def test_rows(spark, library):
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts()[:200])] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    out = tokens.decode(tokens.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        check(library, r.text, r.ids, r.decoded)
    assert tokens.decode(tokens.encode(docs.where("false"), PATH), PATH).count() == 0
    assert tokens.decode(spark.createDataFrame([(None,)], "ids binary"), PATH).collect()[0].decoded is None


def test_other_models_are_refused(tmp_path):
    proto = tokens.protobuf.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    other = tmp_path / "other.model"
    other.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        tokens.Model(str(other))


def test_query(spark, library):
    rows = queries.op11_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    texts_of = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts_of)
    for r in rows:
        ids = library.encode(texts_of[r.doc_id], add_bos=True, add_eos=True)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want
