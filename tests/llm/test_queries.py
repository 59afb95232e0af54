"""Every numbered query is run as registered; columns, types and rows are held against plain code."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from simsift.llm import queries
from tests.conftest import SMALL
from tests.llm import test_lattice_lm, test_mixing, test_warc

COLUMNS = {
    "op1_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op3_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5_warc_segments": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op6_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op7_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op8_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10_lattice_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op11_vector_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op12_sentencepiece": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op13_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}
FOLDS = {"op1_language_id": (4, 2), "op3_toxicity": (4, 2), "op8_quality": (5, 0), "op10_lattice_lm": (10, 0)}


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def results(spark):
    made = {}

    def rows(name):
        if name not in made:
            df = queries.QUERIES[name](spark, SMALL)
            made[name] = dict(df.dtypes), [r.asDict() for r in df.collect()]
        return made[name]

    return rows


def test_all_are_there():
    assert set(queries.QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_types_and_folds(results, docs, spark, name):
    types, rows = results(name)
    for column in COLUMNS[name].split(", "):
        column, kind = column.split()
        assert types[column] == kind
    table, key = {"op5_warc_segments": ("pages", "page_id"), "op11_vector_codes": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    want = list(docs) if key == "doc_id" else [r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()]
    assert sorted(r[key] for r in rows) == sorted(want)
    if name in FOLDS:
        mod, rest = FOLDS[name]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == rest) for r in rows)
    if "predicted" in types:
        assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_languages(results, docs):
    for r in results("op1_language_id")[1]:
        text = docs[r["doc_id"]]["text"] or ""
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not any(map(str.isalpha, text)))


def test_mixes(results, spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    want, sizes = test_mixing.queue(table), {}
    for r in table.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    goal, source = test_mixing.targets(sizes), {r["doc_id"]: r["source"] for r in table.collect()}
    for r in results("op4_mix_sources")[1]:
        s = source[r["doc_id"]]
        assert r["taken"] == want[r["doc_id"]] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s])


def test_archives(results, spark):
    names = list(COLUMNS["op5_warc_segments"].replace(",", "").split()[::2])
    got = sorted((tuple(r[n] for n in names) for r in results("op5_warc_segments")[1]), key=str)
    assert got == test_warc.expected(spark.read.parquet(f"{SMALL}/pages.parquet").collect())


def test_token_files(results, docs):
    from tokenizers import Tokenizer

    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r["doc_id"]: r for r in results("op9_token_files")[1]}
    for doc_id in sorted(docs):
        ids = np.array([*tokenizer.encode(docs[doc_id]["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_language_model(results, docs):
    rows = results("op10_lattice_lm")[1]
    held = {r["doc_id"]: r["held_out"] for r in rows}
    assert test_lattice_lm.plain(rows) == sorted(test_lattice_lm.base([(i, d["text"], held[i]) for i, d in docs.items()]), key=str)
    assert all(np.isfinite([r["score"], r["lattice_score"]]).all() for r in rows)


def test_the_pipelines_first_and_last_stages(spark, docs):
    """Toxicity against the operator's own score of whole texts, mixing and token files against plain code."""
    import corpus_pipeline as cp
    from simsift.llm import toxicity
    from simsift.llm.language_id import in_fold
    from tokenizers import Tokenizer

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    learn = table.where(~in_fold(F.col("doc_id"), 4, 2))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(learn, learn.join(labels, "doc_id").select("doc_id", "text", "toxic"))
    bad = {r["doc_id"] for r in toxicity.score(table.select("doc_id", "text"), model).where("predicted = 1").collect()}
    assert sorted(r["doc_id"] for r in cp.drop_toxic(spark, table, SMALL).collect()) == sorted(set(docs) - bad)

    taken, mixed = test_mixing.queue(table), {}
    rows = cp.mix_sources(spark, table, SMALL)
    for r in rows.collect():
        assert r["text"] == docs[r["doc_id"]]["text"]
        mixed[r["doc_id"]] = mixed.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert {k: v for k, v in mixed.items() if v} == {k: v for k, v in taken.items() if v}

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted((r["doc_id"], r["n_tokens"]) for r in cp.write_tokens(spark, rows, SMALL).collect())
    assert got == sorted((r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in rows.collect())
