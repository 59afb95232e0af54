import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from simsift.llm.token_files import FRAME_IDS, ShardReader, ShardWriter, read_documents, read_shards, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def shard(documents):
    out = io.BytesIO()
    w = ShardWriter(out)
    for i, ids in documents:
        w.add(i, np.array(ids, "<u4"))
    w.close()
    return out.getvalue()


@pytest.mark.parametrize("lengths", [[], [0], [3, 0, 5], [FRAME_IDS], [FRAME_IDS - 1, 2, 3 * FRAME_IDS + 5, 1]])
def test_shards_round_trip(lengths):
    rng = np.random.default_rng(1)
    docs = [(None if k == 1 else k, rng.integers(0, 1 << 32, n, dtype=np.uint32)) for k, n in enumerate(lengths)]
    data = shard(docs)
    reader = ShardReader(Source(data))
    assert reader.doc_ids == [i for i, _ in docs]
    for k in reversed(range(len(docs))):
        assert (reader.document(k) == docs[k][1]).all()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole == b"".join(ids.astype("<u4").tobytes() for _, ids in docs)


def test_only_the_wanted_frames_are_read():
    data = shard([(k, np.full(FRAME_IDS, k)) for k in range(20)])
    reader = ShardReader(Source(data))
    seen = []
    reader._at, plain = lambda o, n: seen.append(n) or plain(o, n), reader._at
    reader.document(13)
    assert len(seen) == 1


def test_damage_is_noticed():
    data = bytearray(shard([(1, range(1000))]))
    data[-23] ^= 1  # the first checksum in the seek table
    with pytest.raises(ValueError, match="checksum"):
        ShardReader(Source(bytes(data))).document(0)
    with pytest.raises(ValueError, match="seek table"):
        ShardReader(Source(bytes(data[:-1])))


def test_files_equal_the_library(spark, odd, none):
    t = Tokenizer.from_file(PATH)
    rows = sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    manifest = write_shards(odd, PATH, 2)
    got = sorted(map(tuple, read_shards(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [r[0] for r in rows]
    want = sorted((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, x in ((i or -1, x) for i, x in rows) for ids in [t.encode(x or "", add_special_tokens=False).ids + [2]])
    assert sorted((r[0] or -1, r[2], r[3]) for r in got) == want
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]
    some = read_documents(manifest, spark.createDataFrame([(0,), (7,)], "doc_id long")).collect()
    assert {r["doc_id"] for r in some} == {0, 7} and all(r["ids"][-1] == 2 for r in some)
    assert read_shards(write_shards(none, PATH, 2)).collect() == []


def test_words_alone_encode_as_in_texts(spark):
    from simsift.llm.token_files import WordEncoder
    from tests.conftest import SMALL

    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    texts += ["<|endoftext|> a<|startoftext|>b", "ΟΔΟΣ Σ", "é ́x", "a\x1cb\x85c d"]
    t = Tokenizer.from_file(PATH)
    got = WordEncoder(PATH)([x.encode() for x in texts])
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_a_worker_keeps_one_operators_cache():
    from simsift.llm._text import worker_cache
    from simsift.llm.token_files import encoder

    one = encoder(PATH)
    assert encoder(PATH) is one
    worker_cache("")
    assert encoder(PATH) is not one


def test_words_are_kept_by_generation_and_letters_skip_the_normalizer(monkeypatch):
    """A full cache costs no frequent word its ids, and words of ASCII letters go to the model alone, lower-cased."""
    from simsift.llm import token_files

    monkeypatch.setattr(token_files, "CACHED_WORDS", 60)
    encode, t, seen = token_files.WordEncoder(PATH), Tokenizer.from_file(PATH), []
    plain = encode._together
    encode._together = lambda tokenizer, words: seen.append((tokenizer is encode.letters, words)) or plain(tokenizer, words)
    letters = lambda k: "".join(chr(97 + int(x)) for x in str(k))
    for k in range(40):
        text = f"Often SEEN often, often. {letters(k)} {letters(k).upper()}x X{letters(k)}. ñ{k}|é don't I'LL ßz K İ " + "Long" * 30
        got = encode([text.encode(), b" ", b"", f"\t{text}\n".encode()])
        want = t.encode(text, add_special_tokens=False).ids
        assert [x.tolist() for x in got] == [want, [], [], want]
        assert len(encode.known) + len(encode.older) < 90  # a generation may pass its half by parts of the last words
    assert all(w.isalpha() and w.islower() for x, words in seen if x for w in words)
    assert sum(w == b"often" for x, words in seen for w in words) == 1
    assert encode([]) == []
