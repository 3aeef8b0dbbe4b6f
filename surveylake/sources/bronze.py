"""Raw survey exports → Bronze: one Parquet partition per edition, every answer a string."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveylake.operators.harmonise import header_table, name_headers
from surveylake.sources.split_csv import PATH, read_split_csv

HEADER_READERS = 32
# Bytes of a file read for its header at first, and at most.
HEADER_BYTES, LONGEST_HEADER = 1 << 16, 1 << 22
# Files beyond this size are cut into ranges by ``split_csv``.
SPLIT_FROM = 1 << 27
# Editions written at a time, and rows of a Bronze file: a compressed file is a few megabytes, which is one task later.
EDITION_WRITERS, ROWS_PER_FILE = 8, 50_000
LINEAGE = ("survey_year", "arquivo_origem", "ingerido_em")


def list_csv_files(spark: SparkSession, raw_path: str) -> list[str]:
    """CSV exports directly under ``raw_path``, sorted, on any file system Spark can reach.

    An entry may be a file or a folder of part files, as long as its name ends in ``.csv``.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(raw_path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().toString() for status in files]
    return sorted(name for name in names if name.lower().endswith(".csv"))


def edition_year(path: str) -> int:
    """The first ``20xx`` in the base name of an export."""
    found = re.search(r"20\d{2}", path.rstrip("/").rsplit("/", 1)[-1])
    if not found:
        raise ValueError(f"no survey year in the file name: {path}")
    return int(found.group())


# A quoted field up to its closing quote and what follows it, or a plain one, in which a quote is a letter.
_FIELD = re.compile(r'"((?:[^"]|"")*+)"(?=\r?[,\n]|\r?\Z)|("(?:[^"]|"")*+"[^,\n]*|[^",\n][^,\n]*|)')


def first_record(text: str, whole: bool) -> list[str] | None:
    """Fields of the first record that is not empty, as Spark's reader cuts it; ``None`` if the text ends within it.

    ``whole`` says that the text goes on to the end of the file, where an unclosed quote is a letter.
    """
    at = len(text) - len(text.lstrip("\r\n"))
    fields: list[str] = []
    while at < len(text):
        found = _FIELD.match(text, at)
        quoted, plain = found.groups()
        at = found.end()
        if quoted is None and not plain and text[at : at + 1] == '"':  # never closed
            if not whole:
                return None
            quoted, at = text[at + 1 :].replace('""', '"'), len(text)
        fields.append(quoted.replace('""', '"') if quoted is not None else plain)
        if text[at : at + 1] == ",":
            at += 1
            if at == len(text):
                fields.append("")
            continue
        ended = text[at:].startswith(("\n", "\r\n")) or at == len(text) and whole
        if ended or whole:
            fields[-1] = fields[-1].removesuffix("\r") if quoted is None else fields[-1]
            return fields
        return None
    return fields if whole else None


def files_of(spark: SparkSession, path: str) -> list:
    """Statuses of the file, or of the part files of a folder, that are not empty."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    status = system.getFileStatus(place)
    found = system.listStatus(place) if status.isDirectory() else [status]
    named = {one.getPath().toString(): one for one in found if one.getLen()}
    return [named[name] for name in sorted(named) if not name.rsplit("/", 1)[-1].startswith(("_", "."))]


def read_header(spark: SparkSession, path: str, longest: int = LONGEST_HEADER) -> list[str]:
    """Raw column names of an export, repeated ones included: the first record, quoted line breaks and all.

    Only the head of the file is read, through the file system and without a Spark job: at most
    ``longest`` bytes, beyond which a header is an error. A quote opens a field only at its start, as
    in Spark's reader. An export that is a folder has the same header in each of its part files.
    """
    files = files_of(spark, path)
    if not files:
        return []
    place, size = files[0].getPath(), files[0].getLen()
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    wanted = min(size, HEADER_BYTES, longest)
    while True:
        stream = system.open(place)
        try:
            head = bytes(stream.readNBytes(wanted))
        finally:
            stream.close()
        # A character may be cut at the end of the head.
        text = head.decode("utf-8", "ignore" if wanted < size else "replace").removeprefix("\ufeff")
        fields = first_record(text, wanted >= size)
        if fields is not None:
            return fields
        if wanted >= min(size, longest):
            raise ValueError(f"no end of the header within {wanted} bytes: {path}")
        wanted = min(size, longest, wanted * 8)


def read_survey_csv(
    spark: SparkSession, paths: list[str], multi_line: bool = True, columns: int | None = None
) -> DataFrame:
    """Every column a string, quoted line breaks kept, the header record skipped.

    Columns are named by the header, or ``c0``, ``c1`` … if their number is given, which leaves
    repeated header names to the caller. With ``multi_line`` a file is one task (``split_csv`` has a
    reader without that limit); pass ``False`` for exports without line breaks inside answers.
    """
    reader = spark.read
    if columns is not None:
        reader = reader.schema(", ".join(f"c{i} string" for i in range(columns)))
    return (
        reader.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )


@dataclass
class EditionFiles:
    """Exports of one edition that share one header."""

    key: str
    year: int
    columns: list[str]
    paths: list[str] = field(default_factory=list)
    largest: int = 0  # bytes of the largest file


def group_exports(spark: SparkSession, paths: list[str]) -> list[EditionFiles]:
    """Exports by edition and header, so that one read serves all files with the same header.

    No Spark job is run, whatever the number of exports.
    """
    groups: dict[tuple, EditionFiles] = {}
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda path: read_header(spark, path), paths))
        sizes = list(pool.map(lambda path: max((one.getLen() for one in files_of(spark, path)), default=0), paths))
    for path, columns, size in zip(paths, headers, sizes):
        if not columns:  # an empty file
            continue
        year = edition_year(path)
        slot = (year, *columns)
        if slot not in groups:
            groups[slot] = EditionFiles(f"{year}/{len(groups)}", year, columns)
        groups[slot].paths.append(path)
        groups[slot].largest = max(groups[slot].largest, size)
    return list(groups.values())


def named_columns(spark: SparkSession, groups: list[EditionFiles]) -> dict[str, list[tuple[str, bool]]]:
    """Column name and junk flag of every position, for each header group. Metadata only."""
    headers = header_table(spark, {group.key: group.columns for group in groups})
    named: dict[str, list[tuple[str, bool]]] = {group.key: [] for group in groups}
    for row in name_headers(headers).orderBy("edition", "pos").collect():
        named[row["edition"]].append((row["name"], row["junk"]))
    return named


def with_lineage(df: DataFrame, year: int, path: str = "_metadata.file_path") -> DataFrame:
    """Edition, source export and ingestion time."""
    plain = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    export = F.regexp_extract(plain, r"([^/]+\.(?i:csv))(?:/[^/]+)?$", 1)
    return df.select(
        *df.drop(path).columns,
        F.lit(year).cast("int").alias("survey_year"),
        export.alias("arquivo_origem"),
        F.current_timestamp().alias("ingerido_em"),
    )


def bronze_frames(
    spark: SparkSession, paths: list[str], multi_line: bool = True, split_from: int = SPLIT_FROM
) -> dict[int, DataFrame]:
    """One DataFrame per edition. Files of one edition are combined, never replaced.

    Multi-line files of more than ``split_from`` bytes are read by many tasks each.
    """
    groups = group_exports(spark, paths)
    names = named_columns(spark, groups)
    editions: dict[int, list[DataFrame]] = {}
    for group in groups:
        if multi_line and group.largest > split_from:
            raw = with_lineage(read_split_csv(spark, group.paths, len(group.columns)), group.year, PATH)
        else:
            raw = with_lineage(read_survey_csv(spark, group.paths, multi_line, len(group.columns)), group.year)
        renamed = raw.toDF(*[name for name, _ in names[group.key]], *LINEAGE)
        kept = [name for name, junk in names[group.key] if not junk]
        editions.setdefault(group.year, []).append(renamed.select(*kept, *LINEAGE))
    return {
        year: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        for year, parts in sorted(editions.items())
    }


def ingest(
    spark: SparkSession, raw_path: str, bronze_path: str, multi_line: bool = True, split_from: int = SPLIT_FROM
) -> dict[int, dict[str, int]]:
    """Write every edition found; only the partitions of these editions are replaced.

    Returns rows and columns per edition, counted while writing.
    """
    paths = list_csv_files(spark, raw_path)
    if not paths:
        raise FileNotFoundError(f"no CSV export in {raw_path}")
    return write_editions(spark, paths, bronze_path, multi_line, split_from)


def write_editions(
    spark: SparkSession, paths: list[str], bronze_path: str, multi_line: bool = True, split_from: int = SPLIT_FROM
) -> dict[int, dict[str, int]]:
    """Write the editions of these exports, each one's partition whole; rows and columns per edition.

    Editions are written side by side, as an export that is not cut is one task: each write has its own
    staging folder and replaces its own partition only.
    """

    def write(year: int, df: DataFrame) -> dict[str, int]:
        seen = Observation()
        (
            df.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .partitionBy("survey_year")
            .parquet(bronze_path)
        )
        return {"rows": seen.get["rows"], "columns": len(df.columns)}

    editions = bronze_frames(spark, paths, multi_line, split_from)
    with ThreadPoolExecutor(EDITION_WRITERS) as pool:
        return dict(zip(editions, pool.map(write, editions.keys(), editions.values())))


def bronze_editions(spark: SparkSession, bronze_path: str) -> list[int]:
    """Editions present, from the names of the partition folders alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(bronze_path)
    entries = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [re.fullmatch(r"survey_year=(\d+)", entry.getPath().getName()) for entry in entries]
    return sorted(int(name.group(1)) for name in names if name)


def read_edition(spark: SparkSession, bronze_path: str, year: int) -> DataFrame:
    """One edition through its own path, so that no other edition's columns are imposed on it."""
    return spark.read.parquet(f"{bronze_path}/survey_year={year}")
