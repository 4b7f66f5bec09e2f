"""File sources. Listings are frames, so long ones stay on the executors."""

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from weftwork.operators.elements import union_all
from weftwork.operators.selection import READ_ALL, effective_sequences


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """``path, name, modified, bytes`` of the files in a folder that are not empty; their content is not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )
    return listing.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


#: The formats whose reader merges the schemas of files by itself.
MERGING = {"parquet", "orc", "json"}


def _layouts(spark: SparkSession, fmt: str, path: str | list[str], wanted: Column, **options) -> dict[str, list[str]]:
    """The files that are wanted, by what tells their schema: the header of CSV files, else the schema in the file.

    Headers come from one pass over the first blocks of the files; what is gathered is one line for each file, as much
    as Spark's own listing of them holds.
    """
    layouts: dict[str, list[str]] = {}
    listing = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup", "encoding", "lineSep")}
    if fmt == "csv":
        lines = spark.read.options(**listing).text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
        lines = lines.filter((F.col("file_block_start") == 0) & wanted).withColumn("line", F.monotonically_increasing_id())
        files = lines.groupBy("file_path").agg(F.min_by("value", "line").alias("layout")).collect()
    else:
        listed = spark.read.format("binaryFile").options(**listing).load(path)
        found = [unquote(r[0]) for r in listed.select("_metadata.file_path").filter(wanted).collect()]
        files = [(file, spark.read.format(fmt).options(**options).load(file).schema.json()) for file in found]
    for file, layout in sorted(files):
        layouts.setdefault(layout, []).append(unquote(file))
    return layouts


def _with_common_types(frames: list[DataFrame]) -> list[DataFrame]:
    """The frames with each column in one type: numbers are left to the union, what differs else becomes text."""
    kinds: dict[str, set] = {}
    for frame in frames:
        for field in frame.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType)
    differing = {name for name, found in kinds.items() if len(found) > 1 and not all(isinstance(t, NumericType) for t in found)}
    return [f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in differing}) if differing else f for f in frames]


def load_files(spark: SparkSession, path: str | list[str], fmt: str, wanted: Column | None = None, **options) -> DataFrame:
    """The rows of files of any schemas, by column name; a column that a file lacks is null in its rows.

    ``wanted`` is a condition on ``file_path``. Formats that merge schemas are read at once. Files of others are grouped
    by the schema found in each, and each group is read with its own. CSV files without a header go by position.
    """
    wanted = F.lit(True) if wanted is None else wanted
    named = str(options.get("header", "false")).lower() == "true"
    if fmt in MERGING or (fmt == "csv" and not named):
        frame = spark.read.format(fmt).options(**({"mergeSchema": "true"} | options)).load(path)
        given = frame.columns
        return frame.select("*", F.col("_metadata.file_path").alias("file_path")).filter(wanted).select(given)
    layouts = _layouts(spark, fmt, path, wanted, **options)
    own = {k: v for k, v in options.items() if k not in ("pathGlobFilter", "recursiveFileLookup")}
    frames = [spark.read.format(fmt).options(**own).load(files) for _, files in sorted(layouts.items())]
    if not frames:
        return spark.createDataFrame([], "struct<>")
    return union_all(_with_common_types(frames))


def scan_files(spark: SparkSession, paths: list[str], fmt: str = "parquet", **options) -> DataFrame:
    """Union of several files or folders by column name, with the columns of all; a path that does not exist is skipped."""
    frames = []
    for path in paths:
        try:
            frames.append(load_files(spark, path, fmt, **options))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not frames:
        raise FileNotFoundError(f"none of {paths} exists")
    return union_all(frames if fmt in MERGING else _with_common_types(frames))


def read_text_lines(spark: SparkSession, path: str, extension: str = ".txt") -> DataFrame:
    """Lines of the text files directly in a folder that have the extension."""
    return spark.read.option("pathGlobFilter", f"*{extension}*").text(path)


def sequence_of(path: Column, extension: str) -> Column:
    """The number a sequence file is named by, or the folder of its name that holds it; null for other names."""
    form = rf"(?:^|/)(\d+){extension.replace('.', chr(92) + '.')}(?:/[^/]+)?$"
    return F.nullif(F.regexp_extract(path, form, 1), F.lit("")).try_cast("bigint")


def sequence_files(spark: SparkSession, path: str, extension: str = ".parquet") -> DataFrame:
    """``path, sequence_id`` of the files named ``<number><extension>``, or in a folder of that name."""
    files = list_files(spark, path, f"*{extension}", recursive=True)
    return files.select("path", sequence_of(F.col("path"), extension).alias("sequence_id")).dropna()


def read_sequence(
    spark: SparkSession, path: str, cursor: int, fmt: str = "parquet", extension: str = ".parquet", **options
) -> DataFrame:
    """The sequence files a cursor selects, with the columns of all files; one a file lacks is null in its rows.

    Selection is a filter on the file path, which Spark applies to the listing, so the rows of other files are not
    read. Formats without schema merging are read as `load_files` says, with the columns of the selected files.
    """
    number = sequence_of(F.col("file_path"), extension)
    reading = {"pathGlobFilter": f"*{extension}", "recursiveFileLookup": "true"} | options
    if cursor == READ_ALL:
        return load_files(spark, path, fmt, number.isNotNull(), **reading)
    highest = effective_sequences(sequence_files(spark, path, extension), cursor).agg(F.max("sequence_id")).first()[0]
    # the selected ids are exactly those up to the highest of them
    return load_files(spark, path, fmt, number <= F.lit(highest).cast("bigint"), **reading)


def _without_scheme(path: Column) -> Column:
    return F.regexp_replace(path, "^[a-z][a-z0-9]*:/*", "/")


def list_schemas(spark: SparkSession, path: str) -> DataFrame:
    """The data schema ids under a folder: the names of its sub-folders, ``name=value`` reduced to the value."""
    files = list_files(spark, path, recursive=True)
    base = F.concat(_without_scheme(F.lit(path.rstrip("/"))), F.lit("/"))
    full = _without_scheme(F.col("path"))
    inside = F.substring(full, F.position(base, full) + F.length(base), F.length(full))
    folder = F.when(inside.contains("/"), F.substring_index(inside, "/", 1))
    return files.select(F.substring_index(folder, "=", -1).alias("data_schema_id")).dropna().distinct()


def dealt_out(frame: DataFrame) -> DataFrame:
    """A scan that has fewer splits than the session has cores, dealt out evenly over the cores; any other as it is.

    For small input with costly work on each row. There are fewer splits than cores only while the input is smaller than
    a split for each core, so nothing large is ever shuffled for this.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    if frame.isStreaming or frame.rdd.getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores)
