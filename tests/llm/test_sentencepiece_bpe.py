"""The agenda of pairs against the sentencepiece library, text by text."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from simsift.llm import queries, sentencepiece_bpe
from tests.conftest import SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_bpe.Vocabulary(PATH)


TEXTS = st.one_of(st.text(max_size=60), st.text(alphabet="ab  ▁\n\tthe<0x41>é", max_size=80), st.lists(st.sampled_from(["the", "  ", "language", "▁", " ", "ing", "<s>", "😀"]), max_size=20).map("".join))


@settings(max_examples=400, deadline=None)
@given(TEXTS)
@example(" " * 37)
@example("▁▁▁ ▁")
@example("\x00a\x00")
@example("ﬁ Å ａ")
def test_ids_are_the_librarys(vocabulary, text):
    kept, differ, want = {}, set(), vocabulary.library.encode(text)
    for _ in range(2):  # then from what is kept
        [ids, twice], agree = vocabulary.encode_texts([text, text], kept, differ)
        assert ids.tolist() == twice.tolist() == want and agree == [True, True] and not differ


def test_segments_don_t_change_the_agenda(vocabulary):
    text = "the same words, the same words   and some OTHERS: the end"
    normal = vocabulary.library.normalize(text)
    want = vocabulary.library.encode(text)
    assert [vocabulary.ids[x] for x in vocabulary.agenda(normal)] == want
    for segments in ([normal], vocabulary.segments.findall(normal)):
        assert np.frombuffer(b"".join(vocabulary.encode(segments)), np.int32).tolist() == want
        assert np.frombuffer(b"".join(vocabulary.together(segments)), np.int32).tolist() == want
    assert len(segments) == 11


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="▁abcthe.ing😀", min_size=1, max_size=40), min_size=1, max_size=8))
def test_agendas_side_by_side_are_those_of_heaps(vocabulary, segments):
    assert vocabulary.together(segments) == [vocabulary.spelt(s) for s in segments]


def test_a_text_with_a_differing_segment_doesn_t_agree(vocabulary, monkeypatch):
    monkeypatch.setattr(vocabulary, "encode", lambda found: [b"1234" if "bad" in s else type(vocabulary).encode(vocabulary, [s])[0] for s in found])
    kept, differ = {}, set()
    assert vocabulary.encode_texts(["good one", "a bad one", ""], kept, differ)[1] == [True, False, True]
    assert vocabulary.encode_texts(["bad", "x bad"], kept, differ)[1] == [False, False]


def test_a_very_long_word(vocabulary):
    text = "abcabd" * 30_000
    assert vocabulary.encode_texts([text], {}, set())[0][0].tolist() == vocabulary.library.encode(text)


def test_odd_rows(odd, none):
    rows = sentencepiece_bpe.encode(odd.repartition(3), PATH).collect()
    library = sentencepiece_bpe.Vocabulary(PATH).library
    want = sorted(((r["doc_id"], library.encode(r["text"] or ""), library.decode(library.encode(r["text"] or "")), True) for r in odd.collect()), key=str)
    assert sorted(((r["doc_id"], r["ids"], r["decoded"], r["agrees"]) for r in rows), key=str) == want
    assert sentencepiece_bpe.encode(none, PATH).collect() == []


def test_other_vocabularies_are_refused(tmp_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH).serialized_model_proto()
    trainer = dict(sentencepiece_bpe.message(model))[2]
    at = model.index(trainer) + trainer.index(b"\x18\x02")  # the type of the vocabulary: merges
    changed = tmp_path / "other.model"
    changed.write_bytes(model[: at + 1] + b"\x01" + model[at + 2 :])
    with pytest.raises(ValueError, match="merge-type"):
        sentencepiece_bpe.Vocabulary(str(changed))


def test_the_query_as_registered(spark):
    library = sentencepiece_bpe.Vocabulary(PATH).library
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in queries.QUERIES["op12_sentencepiece"](spark, SMALL).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["agrees"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True)
