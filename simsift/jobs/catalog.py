"""Every registered query of the similarity-search library, by name, with its DuckDB form.

The tables stand in for a library: a document is a record, its source an archive, doc_id its line,
its tokens the fingerprint, and document 0 the query. Embeddings' signs are a second fingerprint,
lineitem the records that are split into chunks, and parts' keys the molecules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from simsift.functions import records, similarity, smiles
from simsift.functions.fingerprints import packed, query_words, sign_bits
from simsift.jobs.legacy import legacy_search
from simsift.jobs.merge import merge
from simsift.jobs.report import report
from simsift.jobs.search import search as search_shards
from simsift.jobs.search import shard_hits, shard_metadata, summary
from simsift.jobs.split import split
from simsift.operators import brackets, chunks, recover, search, shards, threshold_index
from simsift.sources import cxsmiles, manifest, sinks
from simsift.space import new_folder, read_table, written
from simsift.streaming.top_k import fold_top_k

TOP_K, GROUP_K, LARGE_GROUP_K, CUTOFF, TASKS, CHUNK = 100, 5, 2_500, 0.1, 7, 10_000
#: Brackets over the scores that documents have.
WIDE = [(i / 10, (i + 1) / 10) for i in range(9, -1, -1)]
DIMS = 64
#: Of the jobs over documents: documents an archive, shards, K and cutoff of a shard, K of the merge.
DOCS, SHARDS, SHARD_K, SHARD_CUTOFF, MERGE_K = 90, 2, 40, 0.05, 30

#: Of the index: the least cutoff that it serves, and the search's.
INDEX_LEAST, INDEX_CUTOFF = 0.1, 0.15

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle:
            ORACLES[query.__name__] = oracle
        return query

    return add


LIBRARY = """
WITH manifest AS (SELECT source AS source_file, CAST(row_number() OVER (ORDER BY source) - 1 AS INT) AS archive_index FROM (SELECT DISTINCT source FROM documents)),
fp AS (SELECT doc_id AS ligand_line, source AS source_file, text AS record,
              list_distinct(list_transform(list_filter(string_split_regex(lower(text), '[ \\t\\n\\r]+'), lambda t: t <> ''),
                                           lambda t: CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 2048 AS INT))) AS bits FROM documents),
library AS (SELECT fp.*, archive_index FROM fp JOIN manifest ON fp.source_file IS NOT DISTINCT FROM manifest.source_file),
q AS (SELECT bits AS qb FROM fp WHERE ligand_line = 0),
sized AS (SELECT *, len(list_intersect(bits, qb)) AS x FROM library, q WHERE len(bits) > 0),
scored AS (SELECT archive_index, source_file, ligand_line, x / (len(bits) + len(qb) - x) AS tanimoto FROM sized),
best AS (SELECT *, row_number() OVER (ORDER BY tanimoto DESC, archive_index, ligand_line) AS rank FROM scored)
"""


def _library(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[int]]:
    docs = read_table(spark, sf_dir, "documents")
    return search.document_library(docs), search.query_bits(docs)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.scored(*_library(spark, sf_dir))


def _every_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    library, query = _library(spark, sf_dir)
    return library.select("archive_index", search.score_of(query).alias("tanimoto"))


@registered(LIBRARY + f"SELECT rank, tanimoto, archive_index, source_file, ligand_line FROM best WHERE rank <= {TOP_K}")
def similarity_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, cut to the K best, rank."""
    best = search.ranked(search.top(_scored(spark, sf_dir), TOP_K))
    return best.select("rank", "tanimoto", "archive_index", "source_file", "ligand_line")


@registered(LIBRARY + "SELECT tanimoto, archive_index, ligand_line FROM scored")
def similarity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("tanimoto", "archive_index", "ligand_line")


@registered(LIBRARY + f"SELECT tanimoto, archive_index, ligand_line FROM scored WHERE tanimoto >= {CUTOFF}")
def similarity_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.scored(*_library(spark, sf_dir), cutoff=CUTOFF).select("tanimoto", "archive_index", "ligand_line")


@registered(
    LIBRARY
    + f"""SELECT archive_index, group_rank, tanimoto, ligand_line FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY archive_index ORDER BY tanimoto DESC, ligand_line) AS INT) AS group_rank FROM scored) WHERE group_rank <= {GROUP_K}"""
)
def topk_per_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = search.top_in_groups(_scored(spark, sf_dir), GROUP_K, "archive_index")
    return best.select("archive_index", "group_rank", "tanimoto", "ligand_line")


@registered(LIBRARY + f"SELECT rank, tanimoto, archive_index, ligand_line FROM best WHERE rank <= {TOP_K}")
def topk_partial_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By way of archive and shard lists: the same rows as one search."""
    docs = read_table(spark, sf_dir, "documents")
    hits = search.scored(search.document_library(docs), search.query_bits(docs))
    best = search.top_by_levels(hits, search.manifest_of(docs, "source").count(), TOP_K, TASKS)
    return search.ranked(best).select("rank", "tanimoto", "archive_index", "ligand_line")


_METRICS = f"""archives AS (SELECT archive_index, count(*) AS records, count(*) FILTER (len(bits) > 0) AS valid,
  count(*) FILTER (len(bits) > 0 AND len(list_intersect(bits, qb)) / (len(bits) + len(qb) - len(list_intersect(bits, qb))) >= {CUTOFF}) AS passing_cutoff
  FROM library, q GROUP BY archive_index)"""


@registered(f"{LIBRARY}, {_METRICS} SELECT *, least(passing_cutoff, {TOP_K}) AS retained FROM archives")
def archive_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.archive_counts(_every_score(spark, sf_dir), CUTOFF, TOP_K)


@registered(
    f"""{LIBRARY}, {_METRICS}, n AS (SELECT count(*) AS n FROM manifest),
    t AS (SELECT i AS task_index, n * (i - 1) // {TASKS} AS a, n * i // {TASKS} AS b FROM n, generate_series(1, {TASKS}) AS g(i))
    SELECT task_index, count(*) AS archive_count, CAST(sum(records) AS BIGINT) AS total_records, CAST(sum(valid) AS BIGINT) AS valid_records,
           CAST(sum(passing_cutoff) AS BIGINT) AS passing_cutoff, CAST(least(sum(least(passing_cutoff, {TOP_K})), {TOP_K}) AS BIGINT) AS retained,
           CASE WHEN sum(valid) > 0 THEN 100.0::DOUBLE * CAST(sum(passing_cutoff) AS BIGINT) / CAST(sum(valid) AS BIGINT) ELSE 0.0::DOUBLE END AS passing_percent
    FROM archives JOIN t ON archive_index >= a AND archive_index < b GROUP BY task_index"""
)
def shard_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = written(search.archive_counts(_every_score(spark, sf_dir), CUTOFF, TOP_K), "archive-metrics")
    return search.shard_counts(archives, archives.count(), TASKS, TOP_K)


@registered(LIBRARY + f"SELECT rank, tanimoto, archive_index, ligand_line, record FROM best JOIN library USING (archive_index, ligand_line) WHERE rank <= {TOP_K}")
def recover_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    library, query = _library(spark, sf_dir)
    best = search.ranked(search.top(search.scored(library, query), TOP_K))
    return recover.recover(best, library).select("rank", "tanimoto", "archive_index", "ligand_line", "record")


@registered(LIBRARY + f", hits AS (SELECT archive_index, ligand_line * 2 AS ligand_line FROM best WHERE rank <= {TOP_K}) SELECT * FROM hits WHERE NOT EXISTS (SELECT 1 FROM library l WHERE l.archive_index = hits.archive_index AND l.ligand_line = hits.ligand_line)")
def recover_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits whose line was tampered with: those without a record."""
    library, query = _library(spark, sf_dir)
    best = search.top(search.scored(library, query), TOP_K)
    moved = best.select("archive_index", (F.col("ligand_line") * 2).alias("ligand_line"))
    return recover.missing(moved, library)


@registered(LIBRARY + f"SELECT archive_index, count(*) AS hits, count(DISTINCT ligand_line) AS unique_lines, max(ligand_line) AS last_line FROM best WHERE rank <= {TOP_K} GROUP BY archive_index")
def needed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover.needed(search.top(_scored(spark, sf_dir), TOP_K))


_LARGE = f"SELECT rank, tanimoto, archive_index, ligand_line FROM best WHERE rank <= (SELECT count(*) * 3 // 5 FROM documents)"


@registered(LIBRARY + _LARGE)
def similarity_topk_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K beyond what one task may hold, three fifths of the library: cut by counts, not by sorting."""
    hits = written(_scored(spark, sf_dir), "hits")
    k = max(1, read_table(spark, sf_dir, "documents").count() * 3 // 5)
    return search.ranked_by_ranges(search.first_k(hits, k)).select("rank", "tanimoto", "archive_index", "ligand_line")


@registered(
    LIBRARY
    + f"""SELECT archive_index, group_rank, tanimoto, ligand_line FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY archive_index ORDER BY tanimoto DESC, ligand_line) AS INT) AS group_rank FROM scored) WHERE group_rank <= {LARGE_GROUP_K}"""
)
def topk_per_archive_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K beyond the planner's group limit."""
    best = search.top_in_groups(_scored(spark, sf_dir), LARGE_GROUP_K, "archive_index")
    return best.select("archive_index", "group_rank", "tanimoto", "ligand_line")


@registered(LIBRARY + f"SELECT tanimoto, archive_index, ligand_line FROM scored WHERE tanimoto >= {CUTOFF}")
def packed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's 2,048-bit fingerprints packed and stored once in order of popcount; the cutoff's
    bound prunes the scan, bit counts score what is left."""
    library, query = _library(spark, sf_dir)
    stored, path = packed(library.select("archive_index", "source_file", "ligand_line", "bits")), new_folder(spark, "packed")
    stored.repartitionByRange("popcount", "archive_index", "ligand_line").sortWithinPartitions("popcount").write.parquet(path)
    return search.scored_packed(spark.read.parquet(path), query_words(query), CUTOFF).select("tanimoto", "archive_index", "ligand_line")


@registered(LIBRARY + f"SELECT tanimoto, archive_index, ligand_line FROM scored WHERE tanimoto >= {INDEX_CUTOFF}")
def threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By an index of the records' rarest bits, built for cutoffs from 0.1 on: only candidates are scored."""
    library, query = _library(spark, sf_dir)
    path = new_folder(spark, "threshold-index")
    threshold_index.build(library, path, INDEX_LEAST)
    return threshold_index.search(spark, path, query, INDEX_CUTOFF).select("tanimoto", "archive_index", "ligand_line")


@registered(LIBRARY + f"SELECT rank, tanimoto, source_file, ligand_line FROM best WHERE rank <= {TOP_K}")
def locator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.locators(search.ranked(search.top(_scored(spark, sf_dir), TOP_K)))


@registered(
    LIBRARY
    + f"""SELECT rank, list_filter(string_split_regex(record, '[ \\t\\n\\r]+'), lambda t: t <> '')[1] AS smiles, CAST(ligand_line AS VARCHAR) AS ligand_name,
    source_file AS source_bz2, tanimoto FROM best JOIN library USING (archive_index, ligand_line, source_file) WHERE rank <= {TOP_K}"""
)
def pipeline_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pipeline(spark, sf_dir)


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    library, query = _library(spark, sf_dir)
    found = recover.recover(search.ranked(search.top(search.scored(library, query), TOP_K)), library)
    first = F.get(F.filter(F.split("record", r"[ \t\n\r]+"), lambda t: t != ""), F.lit(0))
    return sinks.pipeline_rows(found, first, F.col("ligand_line").cast("string"))


_WIDE = ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, '{a:.2f} – <{b:.2f}')" for i, (a, b) in enumerate(WIDE))
_BRACKETS = f"""brackets(bracket, low, high, label) AS (VALUES {_WIDE}),
inside AS (SELECT bracket, ligand_line, tanimoto FROM scored JOIN brackets ON tanimoto >= low AND tanimoto < high WHERE tanimoto < 1),
drawn AS (SELECT *, row_number() OVER (PARTITION BY bracket ORDER BY md5('42|' || ligand_line), ligand_line) AS n FROM inside),
picks AS (SELECT *, CAST(row_number() OVER (PARTITION BY bracket ORDER BY tanimoto DESC, ligand_line) AS INT) AS slot FROM drawn WHERE n <= 5)"""


@registered(f"{LIBRARY}, {_BRACKETS} SELECT brackets.bracket, low, high, label, count(ligand_line) AS n FROM brackets LEFT JOIN inside USING (bracket) GROUP BY ALL")
def bracket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brackets.counts(_scored(spark, sf_dir), WIDE)


@registered(f"{LIBRARY}, {_BRACKETS} SELECT bracket, slot, ligand_line, tanimoto FROM picks")
def bracket_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brackets.sample(_scored(spark, sf_dir), "ligand_line", WIDE).select("bracket", "slot", "ligand_line", "tanimoto")


@registered(
    f"""{LIBRARY}, {_BRACKETS} SELECT bracket, slot, label, ligand_line, tanimoto, tanimoto IS NULL AS is_placeholder
    FROM (SELECT bracket, label, CAST(s AS INT) AS slot FROM brackets, generate_series(1, 5) AS g(s)) LEFT JOIN picks USING (bracket, slot)"""
)
def bracket_gallery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = brackets.gallery(_scored(spark, sf_dir), "ligand_line", WIDE)
    return found.select("bracket", "slot", "label", "ligand_line", "tanimoto", "is_placeholder")


@registered(
    f"""WITH n AS (SELECT count(DISTINCT source) AS n FROM documents)
    SELECT i AS task_index, n * (i - 1) // {TASKS} AS slice_start, n * i // {TASKS} AS slice_end FROM n, generate_series(1, {TASKS}) AS g(i)"""
)
def task_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "documents").select("source").distinct().count()
    return shards.slices(n, TASKS, spark)


@registered(
    """WITH m AS (SELECT DISTINCT source FROM documents)
    SELECT sha256(string_agg(source || chr(10), '' ORDER BY source)) AS manifest_sha256, count(*) AS manifest_archive_count FROM m"""
)
def manifest_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.manifest_digest(search.manifest_of(read_table(spark, sf_dir, "documents"), "source"))


def _document_archives(spark: SparkSession, sf_dir: str, size: int = DOCS) -> str:
    """A manifest of archives that hold the documents in order of doc_id, a line each."""
    docs = read_table(spark, sf_dir, "documents")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]+", " ")
    rows = docs.select(F.lit("docs").alias("base"), F.col("doc_id").alias("line"), text.alias("record"))
    folder = new_folder(spark, "document-archives")
    files = cxsmiles.write_chunks(rows, size, "header", folder)
    manifest.write_manifest(f"{folder}/manifest.txt", [r["file"] for r in files.orderBy("chunk").toLocalIterator()])
    return f"{folder}/manifest.txt"


def _query_text(spark: SparkSession, sf_dir: str) -> str:
    row = read_table(spark, sf_dir, "documents").where("doc_id = 0").select("text").first()
    return row["text"] if row is not None else ""


def _searched(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The manifest and the shards' folder of a whole run."""
    archives, out = _document_archives(spark, sf_dir), new_folder(spark, "shards")
    search_shards(spark, archives, _query_text(spark, sf_dir), out, SHARDS, top_k=SHARD_K, min_tanimoto=SHARD_CUTOFF, kind="tokens")
    return archives, out


_RUN = f"""{LIBRARY}, n AS (SELECT count(DISTINCT doc_id // {DOCS}) AS n FROM documents),
t AS (SELECT CAST(i AS INT) AS task_index, CAST(n * (i - 1) // {SHARDS} AS INT) AS slice_start, CAST(n * i // {SHARDS} AS INT) AS slice_end, CAST(n AS INT) AS n FROM n, generate_series(1, {SHARDS}) AS g(i)),
every AS (SELECT task_index, CAST(doc_id // {DOCS} AS INT) AS archive, doc_id % {DOCS} AS line, tanimoto, s.ligand_line IS NOT NULL AS valid, text
          FROM documents LEFT JOIN scored s ON doc_id = s.ligand_line JOIN t ON doc_id // {DOCS} >= slice_start AND doc_id // {DOCS} < slice_end),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_index ORDER BY tanimoto DESC, archive, line) AS k FROM every WHERE tanimoto >= {SHARD_CUTOFF}) WHERE k <= {SHARD_K}),
final AS (SELECT *, row_number() OVER (ORDER BY tanimoto DESC, archive, line) AS rank FROM kept)"""


@registered(f"{_RUN} SELECT task_index, archive AS archive_index, line AS ligand_line, tanimoto FROM kept")
def search_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search over archives: every shard's hits, as the merge reads them."""
    _, out = _searched(spark, sf_dir)
    return shard_hits(spark, out, shard_metadata(spark, out)).select("task_index", "archive_index", "ligand_line", "tanimoto")


@registered(
    f"""{_RUN} SELECT t.task_index, any_value(slice_start) AS slice_start, any_value(slice_end) AS slice_end, any_value(slice_end - slice_start) AS archive_count, any_value(n) AS manifest_archive_count,
    count(*) AS total_records, count(*) FILTER (valid) AS valid_records, count(*) FILTER (tanimoto >= {SHARD_CUTOFF}) AS passing_cutoff,
    least(count(*) FILTER (tanimoto >= {SHARD_CUTOFF}), {SHARD_K}) AS retained FROM t JOIN every USING (task_index) GROUP BY t.task_index"""
)
def search_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, out = _searched(spark, sf_dir)
    names = ["task_index", "slice_start", "slice_end", "archive_count", "manifest_archive_count", "total_records", "valid_records", "passing_cutoff", "retained"]
    return shard_metadata(spark, out).select(*names)


@registered(
    f"""{_RUN}, m AS (SELECT t.task_index, any_value(slice_end - slice_start) AS archives, count(*) AS records, count(*) FILTER (valid) AS valid, count(*) FILTER (tanimoto >= {SHARD_CUTOFF}) AS passing
    FROM t JOIN every USING (task_index) GROUP BY t.task_index)
    SELECT task_index, format('{{:,}} archives, {{:,}} records, {{:,}} valid, {{:,}} passing ({{:.6f}}%), {{:,}} retained, {{:.3f}} s, {{:.2f}} records/s', archives, records, valid, passing,
    CASE WHEN valid > 0 THEN 100.0::DOUBLE * passing / valid ELSE 0.0::DOUBLE END, least(passing, {SHARD_K}), records / 7.0::DOUBLE, 7.0::DOUBLE) AS line FROM m"""
)
def search_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run prints of each shard, its time set to a seventh of a second a record."""
    _, out = _searched(spark, sf_dir)
    return summary(shard_metadata(spark, out).withColumn("elapsed_seconds", F.col("total_records") / F.lit(7.0)))


def _merged(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    archives, out = _searched(spark, sf_dir)
    locators, csv = new_folder(spark, "locators"), new_folder(spark, "pipeline")
    merge(spark, archives, out, SHARDS, locators, csv, MERGE_K, include_header=True, short="null")
    return locators, csv


_DOCS_FILE = "'docs.part' || lpad(CAST(archive AS VARCHAR), 5, '0') || '.cxsmiles.bz2'"


@registered(f"{_RUN} SELECT CAST(rank AS VARCHAR) AS rank, format('{{:.10f}}', tanimoto) AS tanimoto, {_DOCS_FILE} AS source_file, CAST(line AS VARCHAR) AS ligand_line FROM final WHERE rank <= {MERGE_K}")
def merge_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards checked and merged; the locator file's text, ten decimals and all, but for the folder."""
    locators, _ = _merged(spark, sf_dir)
    rows = spark.read.option("sep", "\t").option("header", True).schema("rank string, tanimoto string, source_file string, ligand_line string").csv(locators)
    return rows.withColumn("source_file", F.element_at(F.split("source_file", "/"), -1))


_LEGACY = f"""{LIBRARY}, n AS (SELECT CAST(tanimoto AS FLOAT) AS tanimoto, CAST(ligand_line // {DOCS} AS INT) AS archive, ligand_line % {DOCS} AS line FROM scored),
final AS (SELECT *, row_number() OVER (ORDER BY tanimoto DESC, archive, line) AS rank FROM n)"""


@registered(f"{_LEGACY} SELECT CAST(rank AS VARCHAR) AS rank, format('{{:.6f}}', CAST(tanimoto AS DOUBLE)) AS tanimoto, {_DOCS_FILE} AS source_file, CAST(line AS VARCHAR) AS ligand_line FROM final WHERE rank <= {TOP_K}")
def legacy_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older search over the folder of the documents' archives; its file's text but for the folder."""
    root, output = _document_archives(spark, sf_dir).rpartition("/")[0], new_folder(spark, "legacy-file")
    legacy_search(spark, root, _query_text(spark, sf_dir), output, TOP_K, kind="tokens")
    rows = spark.read.option("sep", "\t").option("header", True).schema("rank string, tanimoto string, source_file string, ligand_line string").csv(output)
    return rows.withColumn("source_file", F.element_at(F.split("source_file", "/"), -1))


_PARTS = r"list_filter(string_split_regex(text, '[\s\x1c-\x1f\x{00A0}\x{0085}\p{Z}]+'), lambda t: t <> '')"


@registered(
    f"""{_RUN} SELECT p[1] AS smiles, CASE WHEN len(p) >= 12 THEN p[len(p) - 10] END AS ligand_name, {_DOCS_FILE} AS source_file, tanimoto
    FROM (SELECT *, {_PARTS} AS p FROM final) WHERE rank <= {MERGE_K}"""
)
def merge_pipeline_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge's CSV with its header: records recovered from the archives' lines."""
    _, csv = _merged(spark, sf_dir)
    return sinks.read_pipeline(spark, csv, header=True).withColumn("source_file", F.element_at(F.split("source_file", "/"), -1))


@registered(
    f"""SELECT 'docs.part00000.part' || lpad(CAST(doc_id // {DOCS} AS VARCHAR), 5, '0') || '.cxsmiles.bz2' AS file, doc_id // {DOCS} AS chunk, count(*) AS records,
    CAST(sum(length(regexp_replace(coalesce(text, ''), '[\r\n]+', ' ', 'g'))) AS BIGINT) AS letters FROM documents GROUP BY ALL"""
)
def split_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive of all documents split into verified chunks; the published files, read back."""
    [whole] = manifest.read_manifest(_document_archives(spark, sf_dir, 1 << 40))
    files = split(spark, whole, DOCS).orderBy("chunk").collect()
    rows = cxsmiles.read_archives(spark, [r["file"] for r in files])
    per = rows.groupBy(F.element_at(F.split("source_file", "/"), -1).alias("file"), F.col("archive_index").cast("bigint").alias("chunk"))
    return per.agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("record")).alias("letters"))


def _pipeline_csv(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "pipeline")
    sinks.write_pipeline(_pipeline(spark, sf_dir), path)
    return path


_JOB_BRACKETS = f"""brackets(bracket, low, high, label) AS (VALUES {_WIDE}),
inside AS (SELECT bracket, CAST(ligand_line AS VARCHAR) AS ligand_name, source_file, tanimoto FROM best JOIN brackets ON tanimoto >= low AND tanimoto < high WHERE tanimoto < 1 AND rank <= {TOP_K}),
drawn AS (SELECT *, ligand_name || '|' || source_file AS key, row_number() OVER (PARTITION BY bracket ORDER BY md5('42|' || ligand_name || '|' || source_file), ligand_name || '|' || source_file) AS n FROM inside),
picks AS (SELECT *, CAST(row_number() OVER (PARTITION BY bracket ORDER BY tanimoto DESC, key) AS INT) AS slot FROM drawn WHERE n <= 5)"""


@registered(
    f"""{LIBRARY}, {_JOB_BRACKETS} SELECT bracket, slot, label, ligand_name, tanimoto, tanimoto IS NULL AS is_placeholder
    FROM (SELECT bracket, label, CAST(s AS INT) AS slot FROM brackets, generate_series(1, 5) AS g(s)) LEFT JOIN picks USING (bracket, slot)"""
)
def report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report(spark, _pipeline_csv(spark, sf_dir), new_folder(spark, "report"), ranges=WIDE)
    return found.select("bracket", "slot", "label", "ligand_name", "tanimoto", "is_placeholder")


@registered(
    """SELECT key, CASE WHEN key IN ('top_k', 'min_tanimoto') THEN 2 ELSE 1 END AS n_values, key NOT IN ('top_k', 'min_tanimoto') AS agree FROM (SELECT unnest(['task_count', 'manifest_sha256',
    'manifest_archive_count', 'query_smiles', 'top_k', 'min_tanimoto', 'radius', 'fp_size', 'use_chirality', 'header_lines']) AS key) WHERE EXISTS (SELECT 1 FROM documents)"""
)
def metadata_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two searches over the documents' archives whose K and cutoff differ, each of one shard."""
    archives, out, query = _document_archives(spark, sf_dir), new_folder(spark, "shards"), _query_text(spark, sf_dir)
    search_shards(spark, archives, query, out, SHARDS, [1], top_k=SHARD_K, min_tanimoto=SHARD_CUTOFF, kind="tokens")
    search_shards(spark, archives, query, out, SHARDS, [2], top_k=2 * SHARD_K, kind="tokens")
    return shards.agreement(shard_metadata(spark, out))


@registered(f"SELECT CAST(i AS BIGINT) AS task_index FROM generate_series(2, {SHARDS}) AS g(i) WHERE EXISTS (SELECT 1 FROM documents)")
def missing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of which one shard was searched."""
    archives, out = _document_archives(spark, sf_dir), new_folder(spark, "shards")
    done = search_shards(spark, archives, _query_text(spark, sf_dir), out, SHARDS, [1], top_k=SHARD_K, kind="tokens")
    return shards.missing_tasks(done, SHARDS)


_LINES = "SELECT l_orderkey * 10 + l_linenumber AS line FROM lineitem"


@registered(f"SELECT line // {CHUNK} AS chunk, count(*) AS ligands, min(line) AS first_line, max(line) AS last_line FROM ({_LINES}) GROUP BY chunk")
def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"))
    per = chunks.assigned(lines, CHUNK).groupBy("chunk")
    return per.agg(F.count(F.lit(1)).alias("ligands"), F.min("line").alias("first_line"), F.max("line").alias("last_line"))


@registered(
    f"""WITH c AS (SELECT o_orderkey // {CHUNK} AS chunk, count(*) AS records, min(o_orderkey) AS first_line, max(o_orderkey) AS last_line FROM orders GROUP BY chunk)
    SELECT *, (records = {CHUNK} OR (chunk = (SELECT max(chunk) FROM c) AND records <= {CHUNK})) AND first_line = chunk * {CHUNK} AND last_line - first_line + 1 = records AS exact FROM c"""
)
def chunk_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line"))
    return chunks.verified(chunks.assigned(lines, CHUNK), CHUNK)


@registered(f"SELECT doc_id, p[1] AS smiles, p[4] AS fourth, CASE WHEN len(p) >= 11 THEN p[len(p) - 10] END AS id, greatest(len(p) - 12, 0) AS n_annotations FROM (SELECT doc_id, {_PARTS} AS p FROM documents)")
def tokenize_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = records.record_tokens(F.col("text"))
    rows = read_table(spark, sf_dir, "documents").select("doc_id", parts.alias("p"))
    p = F.col("p")
    more = F.size(records.annotation(p)).cast("bigint").alias("n_annotations")
    return rows.select("doc_id", records.structure(p).alias("smiles"), records.column_at(p, 3).alias("fourth"), F.when(F.size(p) >= 11, records.identifier(p)).alias("id"), more)


@registered(f"SELECT source, count(*) FILTER (len(p) >= 12) AS complete, count(*) FILTER (len(p) < 12) AS short FROM (SELECT source, {_PARTS} AS p FROM documents) GROUP BY source")
def record_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents").select("source", records.complete(records.record_tokens(F.col("text"))).alias("whole"))
    return rows.groupBy("source").agg(F.count_if("whole").alias("complete"), F.count_if(~F.col("whole")).alias("short"))


@registered(
    """SELECT path, CASE WHEN path LIKE '%.cxsmiles.bz2' THEN regexp_extract(path, '([^/]+)\\.cxsmiles\\.bz2$', 1) END AS base
    FROM (SELECT '/library/' || p_brand || '/' || p_name || CASE WHEN p_partkey % 3 = 0 THEN '.txt' ELSE '.cxsmiles.bz2' END AS path FROM part)"""
)
def suffix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("p_partkey") % 3 == 0, F.lit(".txt")).otherwise(F.lit(".cxsmiles.bz2"))
    rows = read_table(spark, sf_dir, "part").select(F.concat(F.lit("/library/"), F.col("p_brand"), F.lit("/"), F.col("p_name"), end).alias("path"))
    return rows.select("path", records.base_name(F.col("path")).alias("base"))




@registered(
    """SELECT l_orderkey, l_linenumber, try_cast(CASE WHEN t IN ('NA', '') THEN NULL ELSE t END AS DOUBLE) AS number FROM (SELECT l_orderkey, l_linenumber,
    CASE l_linenumber % 4 WHEN 0 THEN 'NA' WHEN 1 THEN CAST(l_orderkey AS VARCHAR) || '.5' WHEN 2 THEN l_returnflag ELSE '' END AS t FROM lineitem)"""
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("l_linenumber") % 4
    text = F.when(kind == 0, F.lit("NA")).when(kind == 1, F.concat(F.col("l_orderkey").cast("string"), F.lit(".5"))).when(kind == 2, F.col("l_returnflag")).otherwise(F.lit(""))
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("t"))
    return rows.select("l_orderkey", "l_linenumber", records.number(F.col("t")).alias("number"))


_SIGNS = f"""WITH b AS (SELECT vec_id, list_filter(generate_series(1, {DIMS}), lambda i: embedding[i] > 0) AS bits FROM embeddings),
q AS (SELECT bits AS qb FROM b WHERE vec_id = 0), s AS (SELECT vec_id, len(bits) AS bits, len(list_intersect(bits, qb)) AS x, len(qb) AS nq FROM b, q),
r AS (SELECT vec_id, CAST(bits AS INT) AS popcount, CASE WHEN bits + nq = x THEN 1.0::DOUBLE ELSE x / (bits + nq - x) END AS tanimoto FROM s)"""


def _signs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[int]]:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", *[w.alias(f"w{i}") for i, w in enumerate(sign_bits(F.col("embedding"), DIMS))])
    words = [c for c in rows.columns if c != "vec_id"]
    row = rows.where("vec_id = 0").first()
    return rows, [row[c] for c in words]


@registered(f"{_SIGNS} SELECT * FROM r")
def embedding_sign_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, query = _signs(spark, sf_dir)
    words = [F.col(c) for c in rows.columns if c != "vec_id"]
    return rows.select("vec_id", similarity.popcount(words).alias("popcount"), similarity.word_tanimoto(words, query).alias("tanimoto"))


@registered(f"{_SIGNS} SELECT vec_id, tanimoto FROM r WHERE tanimoto >= 0.5")
def popcount_bound_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints stored in order of their popcount: the bound prunes row groups of the table, the
    exact predicate decides."""
    rows, query = _signs(spark, sf_dir)
    words = [F.col(c) for c in rows.columns if c != "vec_id"]
    path = new_folder(spark, "fingerprints")
    rows.withColumn("popcount", similarity.popcount(words)).repartitionByRange("popcount", "vec_id").sortWithinPartitions("popcount").write.parquet(path)
    low, high = similarity.popcount_bounds(sum((q & (1 << 64) - 1).bit_count() for q in query), 0.5)
    near = spark.read.parquet(path).where(F.col("popcount").between(low, min(high, 1 << 30)))
    near = near.select("vec_id", similarity.word_tanimoto(words, query).alias("tanimoto"))
    return near.where("tanimoto >= 0.5")


@registered(LIBRARY + f"SELECT rank, CAST(tanimoto AS FLOAT) AS tanimoto, archive_index, ligand_line FROM (SELECT * EXCLUDE (rank), row_number() OVER (ORDER BY CAST(tanimoto AS FLOAT) DESC, archive_index, ligand_line) AS rank FROM best WHERE CAST(tanimoto AS FLOAT) > CAST({CUTOFF} AS FLOAT)) WHERE rank <= {TOP_K}")
def legacy_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single precision, strict threshold."""
    library, query = _library(spark, sf_dir)
    hits = search.scored(library, query, single_precision=True, cutoff=CUTOFF, strict=True)
    return search.ranked(search.top(hits, TOP_K)).select("rank", "tanimoto", "archive_index", "ligand_line")


@registered(LIBRARY + f"SELECT rank, tanimoto, archive_index, ligand_line FROM best WHERE rank <= {TOP_K}")
def stream_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files of the library folded into a stored list, a file a batch."""
    docs = read_table(spark, sf_dir, "documents")
    query, archives = search.query_bits(docs), search.manifest_of(docs, "source")
    arriving = new_folder(spark, "arriving")
    docs.repartition(5, "doc_id").write.parquet(arriving)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(arriving)

    def score(batch: DataFrame) -> DataFrame:
        rows = batch.select(F.col("source").alias("source_file"), F.col("doc_id").alias("ligand_line"), search.token_bits(F.col("text")).alias("bits"))
        return search.scored(search.with_archive_index(rows, archives), query)

    return search.ranked(fold_top_k(stream, score, TOP_K)).select("rank", "tanimoto", "archive_index", "ligand_line")


#: Fragments whose concatenation is a structure; a part's key picks four.
FRAGMENTS = ("C", "CC", "C(=O)", "N", "C(C)", "O", "CN", "C1CCNCC1", "c1ccccc1", "S")


def _molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """base, line, record: a full library record for every part; its base is the part's brand."""
    piece = lambda k: F.element_at(F.array(*map(F.lit, FRAGMENTS)), ((F.col("p_partkey") / k).cast("bigint") % len(FRAGMENTS) + 1).cast("int"))
    structure = F.concat(F.lit("C"), piece(1), piece(10), piece(100), piece(1000), F.lit("O"))
    fields = [structure, F.concat(F.lit("P"), F.col("p_partkey").cast("string")), F.col("p_retailprice").cast("string"), F.col("p_size").cast("string"), *[F.lit(str(i)) for i in range(6)], F.lit("M"), F.lit("KEY")]
    parts = read_table(spark, sf_dir, "part")
    line = F.row_number().over(W.partitionBy("p_brand").orderBy("p_partkey")) - 1
    return parts.select(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "").alias("base"), line.cast("bigint").alias("line"), F.concat_ws(" ", *fields).alias("record"))


def _archives(spark: SparkSession, sf_dir: str, size: int = 500) -> list[str]:
    files = cxsmiles.write_chunks(_molecules(spark, sf_dir), size, " ".join(records.FIELDS), new_folder(spark, "archives"))
    return sorted(r["file"] for r in files.select("file").toLocalIterator())


@registered(
    """WITH p AS (SELECT regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') AS base, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS line FROM part),
    c AS (SELECT base || '.part' || lpad(CAST(line // 500 AS VARCHAR), 5, '0') || '.cxsmiles.bz2' AS file, line % 500 AS line FROM p)
    SELECT CAST(row_number() OVER (ORDER BY file) - 1 AS INT) AS archive_index, file, count(*) AS records, count(*) AS complete, max(line) AS last_line FROM c GROUP BY file"""
)
def cxsmiles_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as chunked archives, read back by the archive source."""
    rows = cxsmiles.read_archives(spark, _archives(spark, sf_dir))
    whole = records.complete(records.record_tokens(F.col("record")))
    file = F.element_at(F.split("source_file", "/"), -1).alias("file")
    return rows.groupBy("archive_index", file).agg(F.count(F.lit(1)).alias("records"), F.count_if(whole).alias("complete"), F.max("ligand_line").alias("last_line"))


@registered()
def ecfp_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circular fingerprints of the archives' structures, the K most like the first part's, recovered
    from only those blocks of the archives that hold a hit."""
    paths = _archives(spark, sf_dir)
    library = cxsmiles.read_archives(spark, paths)
    parts = library.withColumn("smiles", records.structure(records.record_tokens(F.col("record"))))
    query = smiles.query_fingerprint("CCCCO")
    hits = search.scored_packed(smiles.fingerprints(parts.drop("record")), query, more=("block", "row"))
    best = written(search.ranked(search.top(hits, TOP_K)), "ecfp-hits")
    found = cxsmiles.recovered(best)
    parts = records.checked(records.record_tokens(F.col("record")), F.col("record"))
    return found.select("rank", "tanimoto", "archive_index", "ligand_line", records.structure(parts).alias("smiles"), records.identifier(parts).alias("id"))


_LOCATOR = "SELECT CAST(rank AS VARCHAR) AS rank, format('{:.%df}', tanimoto) AS tanimoto, source_file, CAST(ligand_line AS VARCHAR) AS ligand_line FROM best WHERE rank <= %d"


def _locator_file(spark: SparkSession, ranked: DataFrame, digits: int) -> DataFrame:
    path = new_folder(spark, "locators")
    sinks.write_locators(ranked, path, digits)
    return spark.read.option("sep", "\t").option("header", True).schema("rank string, tanimoto string, source_file string, ligand_line string").csv(path)


@registered(LIBRARY + _LOCATOR % (10, TOP_K))
def locator_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tab-separated file's text, read back: ten decimals."""
    return _locator_file(spark, search.ranked(search.top(_scored(spark, sf_dir), TOP_K)), 10)


@registered(
    LIBRARY
    + f""", legacy AS (SELECT archive_index, source_file, ligand_line, CAST(tanimoto AS FLOAT) AS tanimoto FROM scored WHERE CAST(tanimoto AS FLOAT) > CAST({CUTOFF} AS FLOAT))
    SELECT CAST(rank AS VARCHAR) AS rank, format('{{:.6f}}', CAST(tanimoto AS DOUBLE)) AS tanimoto, source_file, CAST(ligand_line AS VARCHAR) AS ligand_line
    FROM (SELECT *, row_number() OVER (ORDER BY tanimoto DESC, archive_index, ligand_line) AS rank FROM legacy) WHERE rank <= {TOP_K}"""
)
def legacy_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older file: single precision, six decimals, hits joined to the list of archives for their path."""
    library, query = _library(spark, sf_dir)
    best = search.ranked(search.top(search.scored(library, query, single_precision=True, cutoff=CUTOFF, strict=True), TOP_K)).drop("source_file")
    listed = search.manifest_of(read_table(spark, sf_dir, "documents"), "source")
    return _locator_file(spark, best.join(listed, "archive_index"), 6)


@registered(
    LIBRARY
    + f"""SELECT list_filter(string_split_regex(record, '[ \\t\\n\\r]+'), lambda t: t <> '')[1] AS smiles, CAST(ligand_line AS VARCHAR) AS ligand_name,
    source_file, tanimoto FROM best JOIN library USING (archive_index, ligand_line, source_file) WHERE rank <= {TOP_K}"""
)
def pipeline_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's CSV, read back."""
    path = new_folder(spark, "pipeline")
    sinks.write_pipeline(_pipeline(spark, sf_dir), path)
    return sinks.read_pipeline(spark, path)
