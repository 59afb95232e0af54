"""Result files: ranked locators and the pipeline's CSV, and how numbers stand in them."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.functions.records import MISSING, number
from simsift.sources.manifest import opened

PIPELINE = ("smiles", "ligand_name", "source_bz2", "tanimoto")


def fixed(score: Column, digits: int = 10) -> Column:
    """A double with so many decimals, halves to the even digit of its exact decimal value."""
    return F.bround(score.cast("decimal(38,30)"), digits).cast(f"decimal(20,{digits})").cast("string")


def locators(ranked: DataFrame) -> DataFrame:
    return ranked.select("rank", "tanimoto", "source_file", "ligand_line")


def _write_ordered(ranked: DataFrame, fields: list[str], path: str, header: bool, line_end: str = "\n", **options: str) -> None:
    """Lines of delimited fields in order of rank. The ranges of ranks are written side by side, and the folder's parts in order
    of their names are the file's text; few rows are one part. See `joined`."""
    lines = ranked.select("rank", F.to_csv(F.struct(*fields), options).alias("value"))
    if header:
        top = ranked.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("rank"), F.lit(options.get("sep", ",").join(fields)).alias("value"))
        lines = lines.union(top)
    lines.repartitionByRange("rank").sortWithinPartitions("rank").select("value").write.option("lineSep", line_end).text(path)


def joined(spark: SparkSession, folder: str, file: str) -> None:
    """One file of a folder's parts, copied piece by piece in a task."""

    def copy(batches):
        for batch in batches:
            for source, target in zip(*(batch.column(k).to_pylist() for k in range(2))):
                (where, root), (store, path) = opened(source), opened(target)
                parts = sorted(x.path for x in where.get_file_info(fs.FileSelector(root)) if x.base_name.startswith("part-"))
                with store.open_output_stream(f"{path}.unfinished") as out:
                    for part in parts:
                        with where.open_input_stream(part) as data:
                            while piece := data.read(1 << 20):
                                out.write(piece)
                store.move(f"{path}.unfinished", path)
            yield batch

    spark.createDataFrame([(folder, file)], "folder string, file string").mapInArrow(copy, "folder string, file string").collect()


def write_locators(ranked: DataFrame, path: str, digits: int = 10) -> None:
    """Tab-separated, header, in order of rank."""
    rows = locators(ranked).withColumn("tanimoto", fixed(F.col("tanimoto"), digits))
    _write_ordered(rows, rows.columns, path, True, sep="\t")


def pipeline_rows(recovered: DataFrame, smiles: Column, name: Column) -> DataFrame:
    """The CSV's columns, and rank to order by."""
    return recovered.select("rank", smiles.alias("smiles"), name.alias("ligand_name"), F.col("source_file").alias("source_bz2"), "tanimoto")


def write_pipeline(rows: DataFrame, path: str, header: bool = False) -> None:
    _write_ordered(rows, list(PIPELINE), path, header, "\r\n", escape='"')


def read_pipeline(spark, path: str, header: bool = False) -> DataFrame:
    """smiles, ligand_name, source_file, tanimoto; rows without a structure or a numeric score are
    dropped, a header row by option."""
    schema = "smiles string, ligand_name string, source_file string, score string"
    rows = spark.read.schema(schema).option("header", header).option("escape", '"').csv(path)
    rows = rows.withColumn("tanimoto", number(F.trim("score"))).drop("score")
    return rows.where(~F.col("smiles").isin(*MISSING)).dropna(subset=["smiles", "tanimoto"])


def grouped(number: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(number, 0)
