"""CSV and JSON files. Schemas are given, never inferred."""

import csv
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.schemas import LEDGER_JSON, ORDER_LABELS, REGISTRY_LABELS, text_schema
from orderloom.sources.tables import union_all


# Columns that every file of a kind has; a file without is not of that kind.
ORDER_KEY_LABEL = "Numero Pedido"
REGISTRY_KEY_LABEL = "CNPJ"


def registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Company registry exports: comma, UTF-8, header, every column text. Columns go by
    name, whatever their order in a file."""
    return _by_header(spark, path, REGISTRY_KEY_LABEL, list(REGISTRY_LABELS), {})


def order_csvs(spark: SparkSession, folder: str, header: list[str] | None = None,
               name_glob: str = "Pedidos_A_Preparar_*.csv") -> DataFrame:
    """Order exports anywhere below a folder, put together by column name.

    A byte-order mark is tolerated, a short line is filled with nulls, a line with
    too many fields is skipped. Files are read in one go per distinct header; ``header`` saves
    looking for them where all files share it.
    """
    found_below = {"recursiveFileLookup": True, "pathGlobFilter": name_glob}
    if header:
        return _csv(spark, [folder], header, **found_below)
    return _by_header(spark, folder, ORDER_KEY_LABEL, list(ORDER_LABELS), found_below)


def _by_header(spark: SparkSession, path: str, key: str, labels: list[str],
               options: dict) -> DataFrame:
    """Files under a path by the names in their first lines. A file whose first line has no
    column ``key`` is an error, not silently left out."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(_first_lines(spark, path, options).items()):
        names = tuple(next(csv.reader([line]), ()))
        if key not in names:
            raise ValueError(f"no column {key} in the first line of {file}")
        by_header.setdefault(names, []).append(unquote(file))
    if not by_header:
        return spark.createDataFrame([], text_schema(labels))
    return union_all([_csv(spark, files, list(names)) for names, files in sorted(by_header.items())])


def _first_lines(spark: SparkSession, path: str, options: dict) -> dict[str, str]:
    """First line of each file, without a byte-order mark.

    Only the split that holds a file's beginning is looked at, and of it the first row; the
    driver gets one short row per file, no more than the file list Spark itself keeps.
    """
    lines = (spark.read.options(**options).text(path)
             .select("value", F.col("_metadata.file_path").alias("path"),
                     F.monotonically_increasing_id().alias("row"))
             .where("_metadata.file_block_start = 0"))
    bare = F.regexp_replace(F.min_by("value", "row"), "^\ufeff|\\r$", "")
    return {r.path: r.line for r in lines.groupBy("path").agg(bare.alias("line")).collect()}


def _csv(spark: SparkSession, paths: list[str], names: list[str],
               **options: object) -> DataFrame:
    """Files with the same header. One more column than the header catches the first
    surplus field, which is how too long lines are told from short ones."""
    df = (spark.read.schema(text_schema([*names, "_surplus", "_bad"]))
          .option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_bad").option("encoding", "UTF-8").options(**options)
          .csv(paths))
    return df.where(F.col("_surplus").isNull() & ~_too_long(F.col("_bad"), len(names))).select(*names)


def _too_long(line: Column, width: int) -> Column:
    """A raw line with more separators, outside quotes, than ``width`` fields need."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.coalesce(F.size(F.split(bare, ",")) > width, F.lit(False))


# What may stand between the texts of JSON arrays, without white space: in the middle, before the
# first and behind the last text of a file, and in a file without texts.
BETWEEN, BEFORE, BEHIND, NO_TEXT = (
    rf"^(?:{p})$" for p in (r",|\](?:\[\])*\[", r"(?:\[\])*\[", r"\](?:\[\])*", r"(?:\[\])+"))


def _quoted(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of files between quotes: (path, place, value, number, inside).

    Files are cut at quotes, so a single line of any length is read by many tasks. A quote is a
    character of a text if a backslash that counts stands before it; ``number`` is the number of
    true quotes before a piece, odd inside texts. It is summed up in each split and over the splits
    of a file (one row each).
    """
    pieces = (spark.read.option("lineSep", '"').text(path)
              .select("value", F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("row"))
              .withColumn("true", F.length(F.regexp_extract("value", r"(\\*)$", 1)) % 2 == 0))
    split, before = Window.partitionBy("path", "block").orderBy("row"), (Window.unboundedPreceding, -1)
    file = Window.partitionBy("path").orderBy("block")
    quotes = F.coalesce(F.sum(F.col("true").cast("long")).over(split.rowsBetween(*before)), F.lit(0))
    sums = (pieces.groupBy("path", "block").agg(F.sum(F.col("true").cast("long")).alias("n"))
            .select("path", "block", F.coalesce(F.sum("n").over(file.rowsBetween(*before)), F.lit(0))
                    .alias("before")))
    number = F.col("here") + F.col("before")
    return (pieces.withColumn("here", quotes).join(sums, ["path", "block"])
            .select("path", F.struct("block", "row").alias("place"), "value", number.alias("number"),
                    (number % 2 == 1).alias("inside")))


def _sound(pieces: DataFrame) -> DataFrame:
    """One row: are all files arrays of texts, with nothing but commas and brackets between?"""
    between = F.when(~F.col("inside"), F.regexp_replace("value", r"[ \t\n\r]+", ""))
    files = pieces.withColumn("between", between).groupBy("path").agg(
        F.count("*").alias("n"), F.count_if(~F.col("between").rlike(BETWEEN)).alias("ends"),
        F.count_if(F.col("inside") & F.col("value").rlike(r"[\x00-\x1F]")).alias("broken"),
        F.min_by("between", "place").alias("first"), F.max_by("between", "place").alias("last"))
    sound = F.when(F.col("n") == 1, F.col("first").rlike(NO_TEXT)).otherwise(
        (F.col("ends") == 2) & F.col("first").rlike(BEFORE) & F.col("last").rlike(BEHIND))
    whole = F.coalesce(sound, F.lit(False)) & (F.col("broken") == 0)
    return files.agg(F.coalesce(F.bool_and(whole), F.lit(False)).alias("sound"))


def sent_registry(spark: SparkSession, path: str, on_corrupt: str = "empty") -> DataFrame:
    """Order numbers of JSON array files (a file may hold several arrays), as distinct rows.

    Files are read by many tasks, however their lines are cut; a comma, bracket or escaped
    quote in a text is part of it. Texts and commas must alternate between brackets. Anything else
    makes the set corrupt: no rows then, or an error with ``on_corrupt="fail"``. A missing file
    gives no rows.
    """
    try:
        pieces = _quoted(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], text_schema(["order_no"]))
    # The pieces of a text are those with its number of quotes before them; most have one.
    texts = (pieces.where("inside").groupBy("path", "number")
             .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("pieces"))
             .select(F.array_join("pieces.value", '"').alias("text")))
    value = F.get(F.from_json(F.concat(F.lit('["'), "text", F.lit('"]')), "array<string>"), F.lit(0))
    numbers = texts.select(value.alias("order_no"))
    # A text that is none (an unknown escape) is null here.
    read = numbers.agg(F.coalesce(F.bool_and(F.col("order_no").isNotNull()), F.lit(True)).alias("sound"))
    sound = _sound(pieces).union(read).agg(F.bool_and("sound").alias("sound"))
    if on_corrupt == "fail" and not sound.first()[0]:
        raise ValueError(f"not a JSON array of texts: {path}")
    return numbers.where(sound.scalar()).distinct()


def company_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed registry answers, one JSON object per line, as ``doc`` text."""
    return spark.read.text(path).select(F.col("value").alias("doc"))


def ledger_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed ledger documents, one per line or one per file, as ``doc`` text."""
    return spark.read.text(path, wholetext=whole_files).select(F.col("value").alias("doc"))


def explode_ledger(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Ledger documents -> one row per (branch, day, customer)."""
    branches = docs.select(F.explode(F.from_json(doc, LEDGER_JSON)).alias("branch", "entry"))
    days = branches.select(
        "branch", F.col("entry.horario").alias("sent_time"),
        F.try_to_date("entry.ultima_saudacao").alias("greeted_day"),
        F.explode("entry.clientes").alias("day", "codes"))
    return days.select("branch", F.explode("codes").alias("codcli"),
                       F.try_to_date("day").alias("sent_day"), "sent_time", "greeted_day")
