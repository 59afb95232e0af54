import math
import random
import time
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from simsift.llm import language_id, quality, toxicity
from simsift.llm._ftrl import Ftrl, labelled_sample
from simsift.llm._text import chunks
from simsift.llm.language_id import in_fold

MIDDLE = "/root/testdata/sf0.01"


def auc(rows):
    ones = [s for s, y in rows if y]
    zeros = [s for s, y in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MIDDLE}/labels.parquet")


def test_ftrl_learns_a_rule():
    rng, model = np.random.default_rng(0), Ftrl(2, 50, alpha=0.5, l1=0.1)
    for _ in range(2000):
        x = rng.choice(49, 5, replace=False)
        model.update(np.array([3 in x, 4 in x], np.float32), np.append(x, 49), np.ones(6, np.float32))
    w = model.weights()
    assert w[0].argmax() == 3 and w[1].argmax() == 4
    assert not Ftrl(1, 9, l1=2.0).weights().any()


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 1).alias("y"))
    some = labelled_sample(rows, "y", 1000).select("doc_id").collect()
    assert 800 < len(some) < 1200 and some == labelled_sample(rows, "y", 1000).select("doc_id").collect()
    assert labelled_sample(rows, "y", 10_000).count() == 10_000


@pytest.mark.parametrize("classes", [2, 3, 4, 7, 8, 40])
def test_codewords_differ(classes):
    code = language_id.codewords(classes).astype(int)
    apart = [(code[i] != code[j]).sum() for i in range(classes) for j in range(i)]
    assert min(apart) >= (1 if classes == 2 else 2 if classes < 8 else 5)
    assert all(abs(c.sum()) < classes for c in code.T)


def test_languages_of_held_out_rows(docs):
    folded = docs.withColumn("held_out", in_fold(F.col("doc_id"), 4, 2))
    model = language_id.fit(folded.where("NOT held_out"))
    got = language_id.predict(folded.where("held_out").select("doc_id", "lang", "text"), model).collect()
    right = np.mean([r["lang"] == r["lang_pred"] for r in got])
    assert right > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_language_cases(odd, none):
    rows = language_id.predict(odd, language_id.fit(odd)).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] in (1, 2, 3):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert all(r["lang_pred"] in ("de", "en") for r in rows if r["doc_id"] in (0, 4, 5, 6))
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.fit(none)).collect()} == {"und"}
    one = language_id.predict(odd, language_id.fit(odd.where("lang = 'en'"))).collect()
    assert {r["lang_pred"] for r in one} == {"en", "und"} and {r["score"] for r in one} == {0.0, 1.0}
    assert language_id.predict(none, language_id.fit(odd)).collect() == []


def test_quality_of_held_out_rows(docs, labels):
    folded = docs.withColumn("held_out", in_fold(F.col("doc_id"), 5, 0)).join(labels, "doc_id")
    weights = quality.fit(folded.where("NOT held_out"))
    got = quality.score(folded.where("held_out").select("doc_id", "quality", "text"), weights).collect()
    assert auc([(r["score"], r["quality"]) for r in got]) > 0.97
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) for r in got)


def test_toxicity_of_held_out_rows_and_their_disguises(docs, labels):
    folded = docs.withColumn("held_out", in_fold(F.col("doc_id"), 4, 2)).join(labels, "doc_id")
    model = toxicity.fit(docs, folded.where("NOT held_out"))
    test = folded.where("held_out").select("doc_id", "toxic", "text")
    got = toxicity.score(test, model).collect()
    assert auc([(r["score"], r["toxic"]) for r in got]) > 0.85
    plain = "thes enanre idiot and the worthless loser is pathetic trash stupid"
    leet = "thes enanre 1d10t and the w0rthless l o s e r is p4thetic tr@sh stuuupid"
    rows = folded.sparkSession.createDataFrame([(plain,), (leet,)], "text string").withColumn("id", F.monotonically_increasing_id())
    scores = [r["score"] for r in toxicity.score(rows, model).orderBy("id").collect()]
    assert min(scores) > 0.5 and abs(scores[0] - scores[1]) < 0.05


@pytest.mark.parametrize("seen", ["1d10t", "i d i o t", "i.d.i.o.t", "idiooot", "!diot", "iiddiioott", "IIddiioott!", '"iiddiioott,"'])
def test_disguises_are_undone(seen):
    counts = np.zeros(28**3)
    for word, n in (("idiot", 50), ("the", 500), ("ideal", 20), ("riot", 20)):
        code = [0, 0, *(ord(c) - 96 for c in word), 0]
        for a, b, c in zip(code, code[1:], code[2:]):
            counts[a * 784 + b * 28 + c] += n
    restorer = toxicity.Restorer(toxicity.CharModel(counts))
    texts = pa.array(["plain words", f"the {seen} the", None, "", seen])
    [chunk] = chunks(texts)
    new = restorer.chunk(chunk)
    got = [bytes(new.buf[a:b]).decode().split() for a, b in zip(new.offsets[:-1], new.offsets[1:])]
    assert got == [["plain", "words"], ["the", "idiot", "the"], [], [], ["idiot"]]


def test_only_words_doubled_throughout_are_marked():
    texts = ["aabb ccdd", "committee bookkeeper", "iiddiioot iiddiiootx", "x aabbcc, 1122334455 ------", "llaammaa", "", "AAbbCC"]
    for c in chunks(pa.array(texts)):
        starts, ends = toxicity.disguised(c)
        got = [bytes(c.buf[a:b]).decode() for a, b in zip(starts, ends)]
    assert got == ["aabbcc,", "llaammaa", "AAbbCC"]


@pytest.mark.parametrize("text,letter", [("½", False), ("²①Ⅷ", False), ("12 _ !", False), ("", False), ("a", True), ("ü1", True), ("1½ʰ", True), ("語", True)])
def test_letters_are_those_of_unicode(text, letter):
    assert language_id.has_letter(text) == letter == any(unicodedata.category(c).startswith("L") for c in text)


def test_rare_languages_are_learned(spark):
    rows = [(i, "der hund und die katze " * 3, "de") for i in range(600)] + [(1000 + i, "kvik zorp blun trax " * 3, "xx") for i in range(4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.predict(table, language_id.fit(table, sample_rows=40)).where("doc_id >= 1000").collect()
    assert {r["lang_pred"] for r in got} == {"xx"}


def test_decoding_is_exact_and_linear():
    rng = np.random.default_rng(2)
    model = toxicity.CharModel(rng.integers(0, 50, 28**3).astype(float))

    def cost(seen):
        """The least cost over all readings, by listing them."""
        best = []

        def go(i, a, b, total, text):
            if i == len(seen):
                return best.append((total + model.cost[a][b][0], text))
            c = seen[i]
            if c in toxicity.LEET:
                out = [(x, toxicity.STANDS_FOR + math.log(len(toxicity.LEET[c]))) for x in toxicity.LEET[c]] + [(c, toxicity.AS_IT_IS)]
            elif c in toxicity.APART:
                out = [("", toxicity.JOINED), (" ", toxicity.PARTED)]
            else:
                out = [(c, 0.0)]
            if i and c == seen[i - 1] and c not in toxicity.APART:
                longer = (i > 1 and seen[i - 2] == c) or (i + 1 < len(seen) and seen[i + 1] == c)
                out.append(("", toxicity.REPEATED if longer else toxicity.TWICE))
            for x, more in out:
                k = 0 if x in ("", " ") else ord(x) - 96 if "a" <= x <= "z" else 27
                if not x:
                    go(i + 1, a, b, total + more, text)
                elif x == " ":
                    go(i + 1, 0, 0, total + more + (model.cost[a][b][0] if b else 0), text + x)
                else:
                    go(i + 1, b, k, total + more + model.cost[a][b][k], text + x)

        go(0, 0, 0, 0.0, "")
        return min(best)[1]

    for seen in ("1d10t", "s.h.1.t", "bb00bb", "1|1!!1", "a5$h0l3", "w0w w0w"):
        assert model.decode(seen) == cost(seen)
    took = []
    for n in (20_000, 80_000):
        began = time.perf_counter()
        assert len(model.decode("1d" * (n // 2))) >= n // 2
        took.append(time.perf_counter() - began)
    assert took[1] < 8 * took[0]


def test_a_long_disguised_word_is_read_whole():
    model = toxicity.Restorer(toxicity.CharModel(np.ones(28**3)))
    [chunk] = chunks(pa.array(["1d10t" * 4000 + " the end", "a$$"]))
    new = model.chunk(chunk)
    texts = [bytes(new.buf[a:b]).decode() for a, b in zip(new.offsets[:-1], new.offsets[1:])]
    assert texts[0].endswith("the end") and len(texts[0]) > 12_000 and not model.known.get(b"1d10t" * 4000) and "$" not in texts[1]


def test_label_cases(odd, none, spark):
    marked = odd.withColumn("toxic", F.when(F.col("doc_id") == 4, 1).when(F.col("doc_id") < 3, 0)).withColumn("quality", F.col("toxic"))
    for fit, score in ((lambda d: toxicity.fit(odd, d), toxicity.score), (quality.fit, quality.score)):
        got = score(odd, fit(marked)).collect()
        assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
        empty = {r["score"] for r in got if r["doc_id"] in (1, 2)}
        assert len(empty) == 1
        assert {r["score"] for r in score(odd, fit(marked.limit(0))).collect()} == {0.5}
        assert score(none, fit(marked)).collect() == []


def test_chunks_hold_all_texts():
    rng = random.Random(1)
    texts = [None if rng.random() < 0.1 else "ü" * rng.randint(0, 50) for _ in range(500)]
    got = []
    for c in chunks(pa.array(texts).slice(3), limit=200, rows=7):
        got += [bytes(c.buf[a:b]).decode() for a, b in zip(c.offsets[:-1], c.offsets[1:])]
    assert got == [t or "" for t in texts[3:]]
