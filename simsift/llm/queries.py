"""The numbered queries and, where SQL can say them, their DuckDB forms."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.llm import decontamination, exact_dedup, language_id, lattice_lm, mixing, near_dedup, periodic_runs, quality, sentencepiece_bpe, token_files, toxicity, vector_codes, warc
from simsift.llm._space import read_table
from simsift.llm.language_id import in_fold


def _labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Training rows with the label; of labels for a doc_id more than once each counts."""
    return docs.where("NOT held_out").join(labels.select("doc_id", label), "doc_id").select("doc_id", "text", label)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", in_fold(F.col("doc_id"), 4, 2))
    model = language_id.fit(docs.where("NOT held_out"))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), width=2, percent=80)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", in_fold(F.col("doc_id"), 4, 2))
    model = toxicity.fit(docs.where("NOT held_out"), _labelled(docs, read_table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs.select("doc_id", "held_out", "text"), model)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op5_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(read_table(spark, sf_dir, "pages"), min_bytes=0)
    records = warc.reassemble(warc.read_segments(archives))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"), keep="max")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", in_fold(F.col("doc_id"), 5, 0))
    model = quality.fit(_labelled(docs, read_table(spark, sf_dir, "labels"), "quality"))
    return quality.score(docs.select("doc_id", "held_out", "text"), model)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.read_shards(token_files.write_shards(read_table(spark, sf_dir, "documents"), path, end_id=2))


def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", in_fold(F.col("doc_id"), 10, 0))
    return lattice_lm.score(docs, public_tokenizers.path("piece_bpe_32k.model"), kind="lang")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compressed(read_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode(read_table(spark, sf_dir, "documents"), path))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(read_table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_near_dedup,
        op3_toxicity,
        op4_mix_sources,
        op5_warc_segments,
        op6_decontamination,
        op7_exact_dedup,
        op8_quality,
        op9_token_files,
        op10_lattice_lm,
        op11_vector_codes,
        op12_sentencepiece,
        op13_periodic_runs,
    )
}


def _codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Rounds written out one after the other; the codebooks after r rounds are the table b{r}."""
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))""",
        f"""p AS MATERIALIZED (SELECT r, vec_id, part, list_slice(q, part * (len(q) // {parts}) + 1, (part + 1) * (len(q) // {parts})) AS x FROM v, generate_series(0, {parts - 1}) AS g(part))""",
        f"b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p QUALIFY entry < {entries})",
    ]
    for n in range(rounds + 1):
        near = "min({'far': CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'entry': entry})"
        steps.append(f"a{n} AS MATERIALIZED (SELECT r, part, x, {near} AS best FROM p JOIN b{n} USING (part) GROUP BY r, part, x)")
        if n < rounds:
            steps.append(
                f"""m{n} AS MATERIALIZED (SELECT part, entry, list((s - (s % n + n) % n) // n ORDER BY k) AS c FROM (SELECT part, best.entry AS entry, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n
                FROM a{n}, generate_series(1, (SELECT max(len(x)) FROM p)) AS g(k) GROUP BY ALL) GROUP BY part, entry)"""
            )
            steps.append(f"b{n + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN m{n} USING (part, entry))")
    steps.append(f"coded AS MATERIALIZED (SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.far) AS BIGINT) AS error FROM a{rounds} GROUP BY r)")
    digest = f"SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{rounds}"
    return f"""WITH {", ".join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, ({digest}) AS codebooks_sha256 FROM v JOIN coded USING (r)"""


_UPPER, _LOWER = decontamination.UPPER, decontamination.LOWER

SQL = {
    "op2_near_dedup": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * x >= 80 * (na.n + nb.n - x)),
        r AS (SELECT doc_id, doc_id AS o FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.o = l.a)
        SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(o) AS component_id, doc_id = min(o) AS kept
        FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
    "op6_decontamination": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{decontamination.WORD}') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{decontamination.WORD}') AS w FROM benchmark),
        g AS (SELECT DISTINCT item_id, list_slice(w, s + 1, s + least(10, len(w))) AS g
              FROM (SELECT item_id, w, unnest(generate_series(0, greatest(len(w) - 10, 0))) AS s FROM b WHERE len(w) > 0)),
        k AS (SELECT DISTINCT len(g) AS k FROM g),
        dw AS (SELECT doc_id, s, k, list_slice(w, s + 1, s + k) AS g
               FROM (SELECT doc_id, w, k, unnest(generate_series(0, len(w) - k)) AS s FROM d, k WHERE len(w) >= k)),
        hits AS (SELECT doc_id, s, k, item_id FROM dw JOIN g USING (g)),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                    FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS p FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
        t AS MATERIALIZED (SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS word FROM d),
        c AS (SELECT word, count(*) AS c FROM t GROUP BY word),
        gp AS (SELECT g, i, g[i] AS word FROM (SELECT g, unnest(generate_series(1, len(g))) AS i FROM (SELECT DISTINCT g FROM g))),
        rare AS MATERIALIZED (SELECT g, list(word ORDER BY n, i)[1:2] AS r FROM (SELECT g, i, word, coalesce(c, 0) AS n FROM gp LEFT JOIN c USING (word)) GROUP BY g HAVING min(n) > 0),
        close AS (SELECT DISTINCT doc_id, g FROM rare JOIN t ON word = r[1] WHERE len(r) = 1 UNION
                  SELECT DISTINCT a.doc_id, g FROM rare JOIN t a ON a.word = r[1] JOIN t b ON b.doc_id = a.doc_id AND b.word = r[2] WHERE a.p <> b.p AND abs(a.p - b.p) < 10),
        near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM close JOIN g USING (g) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
    """,
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_vector_codes": _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE),
}
