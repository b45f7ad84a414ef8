"""Readers: typed CSV by spec, inferred CSV, folder discovery, manifest."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.casting import CASTS
from ..session import small_frame
from .quoted import records
from .specs import TABLES, TableSpec


#: Holds the text of a CSV row that has more or fewer fields than the header.
BAD_ROW = "_bad_row"


#: How all CSV files are written. A part file whose header differs from the first one's is an error, not a shift of columns.
CSV = {"quote": '"', "escape": '"', "nullValue": "", "enforceSchema": "false"}


def _names(spark: SparkSession, path: str, header: bool = True) -> list[str]:
    """The column names of the first file; without a header numbered ones for its first row."""
    names = spark.read.options(**CSV, header=header, multiLine=True).csv(path).columns
    if not names:
        raise ValueError(f"no columns to parse in {path}")
    return names


def _quoted_records(spark: SparkSession, path: str, names: list[str], header: bool = True) -> DataFrame:
    """(record): the rows of files with line breaks in values, read in splits, without their headers."""
    found = records(spark, path)
    if not header:
        return found.select("record")
    # The header of every file is compared with that of the first, as it is passed over.
    first = spark.read.options(**CSV, multiLine=True).csv(path).first()
    plain = ", ".join(f"c{i} STRING" for i in range(len(names)))
    own = F.from_csv("record", f"{plain}, {BAD_ROW} STRING", {**CSV, "multiLine": "true", "columnNameOfCorruptRecord": BAD_ROW})
    same = own[BAD_ROW].isNull()
    for i, name in enumerate(first):
        same &= own[f"c{i}"].eqNullSafe(F.lit(name and name.removeprefix("\ufeff")))
    passed = F.when(same, False).otherwise(F.raise_error(F.concat(F.lit(f"CSV header is not {','.join(names)} in "), "file")))
    return found.where(F.when(F.col("first"), passed).otherwise(True)).select("record")


def _csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool, header: bool = True) -> DataFrame:
    """The columns of ``schema`` and ``BAD_ROW``, the text of rows with more or fewer fields."""
    full, options = StructType([*schema.fields, StructField(BAD_ROW, StringType())]), {**CSV, "columnNameOfCorruptRecord": BAD_ROW}
    if not multi_line:
        return spark.read.schema(full).options(**options, header=header).csv(path)
    found = _quoted_records(spark, path, schema.names, header)
    row = F.from_csv("record", full.toDDL(), {**options, "multiLine": "true"})
    return found.select(row.alias("row")).select("row.*")


def _csv_text(spark: SparkSession, path: str, multi_line: bool = False, header: bool = True) -> DataFrame:
    """Every column as text, and ``BAD_ROW``. Files are read in splits, whether values hold line breaks or not."""
    schema = StructType([StructField(n, StringType()) for n in _names(spark, path, header)])
    return _csv(spark, path, schema, multi_line, header)


def clean(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Apply the declared casts to the columns that are there; pass the others through."""

    def rule(name: str) -> Column:
        c = F.col(f"`{name}`")
        return CASTS[columns[name]](c).alias(name) if name in columns else c

    return df.select(*[rule(name) for name in df.columns])


def read_table(spark: SparkSession, path: str, spec: TableSpec, keep_bad_rows: bool = False) -> DataFrame:
    """A CSV file (or folder of part files) with the spec's types; on demand with ``BAD_ROW``."""
    df = clean(_csv_text(spark, path, spec.multi_line), spec.columns)
    return df if keep_bad_rows else df.drop(BAD_ROW)


def may_break_lines(path: str) -> bool:
    """Whether values of a CSV file may hold line breaks, so that its records must be put together first.

    Files of a known table follow its spec; any other file is taken to, which is always right but
    scans files that are longer than a split twice.
    """
    spec = next((s for s in TABLES.values() if fnmatch(file_name(path), s.file_pattern)), None)
    return spec is None or spec.multi_line


def inferred_schema(spark: SparkSession, path: str, multi_line: bool) -> StructType:
    """The types of a CSV file's whole content, as Spark infers them."""
    names = _names(spark, path)
    if not multi_line:
        return spark.read.options(**CSV, header=True, inferSchema=True).csv(path).schema
    # A header of its own, which no record repeats, so that the reader takes none of the records for one.
    mark = uuid.uuid4().hex
    header = small_frame(spark, [(",".join(f"{mark}_{i}" for i in range(len(names))),)], "record string")
    texts = header.unionByName(_quoted_records(spark, path, names))
    texts = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(**CSV, header=True, inferSchema=True, multiLine=True)
    found = DataFrame(reader._jreader.csv(texts), spark).schema
    return StructType([StructField(n, f.dataType) for n, f in zip(names, found.fields, strict=True)])


def read_inferred(spark: SparkSession, path: str, multi_line: bool | None = None, keep_bad_rows: bool = False) -> DataFrame:
    """A CSV file or folder with types inferred from its whole content; on demand with ``BAD_ROW``."""
    multi_line = may_break_lines(path) if multi_line is None else multi_line
    df = _csv(spark, path, inferred_schema(spark, path, multi_line), multi_line)
    return df if keep_bad_rows else df.drop(BAD_ROW)


def discover(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """The datasets of a folder: matching files, and folders of part files with such a name.

    One directory listing through Hadoop, so any file system Spark reads will do. Empty files
    are listed too, which Spark's own file sources leave out.
    """
    root = folder.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    names = sorted(status.getPath().getName() for status in found)
    return [f"{root}/{name}" for name in names if fnmatch(name, pattern)]


def file_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def locate(paths: list[str], spec: TableSpec) -> list[str]:
    """All discovered paths that belong to a spec."""
    return [p for p in paths if fnmatch(file_name(p), spec.file_pattern)]


@dataclass(frozen=True)
class ManifestEntry:
    file: str
    table: str
    format: str = "csv"
    header: bool = True


@dataclass(frozen=True)
class Manifest:
    entries: tuple[ManifestEntry, ...]
    target_schema: str

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(tuple(ManifestEntry(**entry) for entry in raw["files"]), raw["target_schema"])

    @staticmethod
    def from_file(spark: SparkSession, path: str) -> Manifest:
        """Read a (small) manifest from any path Spark can reach."""
        row = spark.read.option("wholetext", True).text(path).first()
        return Manifest.from_json(row[0])


def read_entry(spark: SparkSession, entry: ManifestEntry, root: str = "") -> DataFrame:
    """A manifest entry as its format has it; a CSV entry as text, with ``BAD_ROW``."""
    path = f"{root.rstrip('/')}/{entry.file}" if root else entry.file
    if entry.format == "csv":
        return _csv_text(spark, path, may_break_lines(path), entry.header)
    return spark.read.format(entry.format).load(path)
