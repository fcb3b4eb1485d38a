"""CSV at the edges: quoted multi-line fields, missing markers, two encodings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantflow.functions.text import null_if_na
from variantflow.sources.scratch import written

_WRITTEN = {"header": True, "quote": '"', "escape": '"', "lineSep": "\n"}
#: an empty field is kept apart from a missing one
_READ = {"header": True, "quote": '"', "escape": '"', "nullValue": "\x00", "emptyValue": ""}
#: fields of a row beyond those of the header
_SURPLUS = "_surplus"
#: where ``on_bad="keep"`` puts what is wrong with a row
BAD = "_bad_row"


def _by_line_end(
    spark: SparkSession, path: str | Sequence[str], line_end: str | None
) -> list[tuple[str | list[str], str]]:
    """Files by their line end: that of a file's first line.

    A line end inside quotes then stays what it is, whichever the rows have.
    """
    paths = path if isinstance(path, str) else list(path)
    if line_end:
        return [(paths, line_end)]
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.endswith("value", F.lit("\r")).alias("cr"), F.monotonically_increasing_id().alias("line"),
    )
    first = lines.filter("at = 0").groupBy("file").agg(F.min_by("cr", "line").alias("cr"))
    # a listing of files is on the driver anyway
    found = {r["file"]: r["cr"] for r in first.collect()}
    if len(set(found.values())) < 2:
        return [(paths, "\r\n" if any(found.values()) else "\n")]
    return [(sorted(f for f, cr in found.items() if cr == is_cr), end) for is_cr, end in ((False, "\n"), (True, "\r\n"))]


def _raw(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str],
    multi_line: bool,
    line_end: str | None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """All fields as texts, one column more for what a row has too much, and the file's name."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _SURPLUS)])
    reader = spark.read.options(**_READ, multiLine=multi_line, encoding=encoding).schema(schema)
    place = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    if not multi_line:  # lines are cut at any line end
        df = reader.csv(path if isinstance(path, str) else list(path))
    else:
        groups = _by_line_end(spark, path, line_end)
        if len(groups) > 1 and isinstance(path, str):
            reader = reader.option("basePath", path)
        parts = [reader.option("lineSep", end).csv(files) for files, end in groups]
        return reduce(DataFrame.unionByName, [p.withColumns(place) for p in parts])
    return df.withColumns(place)


def _header(spark: SparkSession, path: str | Sequence[str], multi_line: bool) -> list[str]:
    """Column names of the files, without those that are folder names."""
    paths = path if isinstance(path, str) else list(path)
    found = spark.read.options(**_READ, multiLine=multi_line).csv(paths)
    names = [f.name for f in found.select("*", "_metadata.file_path").schema.fields[:-1] if f.name not in _folders(found)]
    if not names:
        raise ValueError(f"no header in {', '.join(paths)}: a CSV file has a line with the names of its columns at least")
    return names


def same_header(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """Column names of files whose first lines are the same; other files raise."""
    lines = spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.rtrim("value", F.lit("\r")).alias("value"), F.monotonically_increasing_id().alias("line"),
    )
    first = lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "line").alias("value"))
    found = first.groupBy("value").agg(F.min("file").alias("file")).orderBy("file").limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"different columns in {found[0]['file']} and {found[1]['file']}")
    return _header(spark, files, multi_line=True)


def _folders(df: DataFrame) -> set[str]:
    """Columns that come from folder names ``name=value``."""
    files = df.inputFiles()[:1]
    return {part.partition("=")[0] for f in files for part in f.split("/")[:-1] if "=" in part}


# Texts that are values of a type.  Casts take much more (yes, 1d, blanks around), which are texts here.
_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))$"
_BOOLEAN = r"^(?i:true|false)$"
#: decimal digits that a double surely keeps apart, and the whole numbers it keeps
_DIGITS, _WHOLE = 17, 1 << 53
#: what the values of a column are, as bits that an aggregate joins
_BOOL, _INT, _LONG, _DOUBLE, _ROUNDED, _TEXT = (1 << i for i in range(6))


def _kind(c):
    """The bit of one value: the narrowest type that keeps it as it is."""
    whole = c.try_cast("bigint")
    # digits that count: without sign, point, exponent and zeros in front
    digits = F.regexp_replace(F.regexp_replace(c, r"[eE].*$|[^0-9eE]", ""), r"^0+", "")
    return (
        F.when(c.isNull(), 0)
        .when(
            c.rlike(_INTEGER),
            F.when(c.try_cast("int").isNotNull(), _INT)
            .when(whole.isNull(), _TEXT)
            .when(whole.between(-_WHOLE, _WHOLE), _LONG)
            .otherwise(_LONG + _ROUNDED),
        )
        .when(c.rlike(_NUMBER), F.when(F.length(digits) <= _DIGITS, _DOUBLE).otherwise(_TEXT))
        .when(c.rlike(_BOOLEAN), _BOOL)
        .otherwise(_TEXT)
    )


def _type_of(kinds: int) -> T.DataType:
    """The type of a column from the kinds of its values; text where no other keeps them all."""
    if kinds == _BOOL:
        return T.BooleanType()
    if kinds == _INT:
        return T.IntegerType()
    if kinds and not kinds & (_BOOL | _DOUBLE | _TEXT):
        return T.LongType()
    if kinds & _DOUBLE and not kinds & (_BOOL | _ROUNDED | _TEXT):
        return T.DoubleType()
    return T.StringType()


def _inferred(df: DataFrame, names: Sequence[str]) -> T.StructType:
    """The narrowest type that keeps every value of each column, in one pass."""
    found = df.agg(*[F.bit_or(_kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(names)]).first()
    return T.StructType([T.StructField(c, _type_of(found[i] or 0)) for i, c in enumerate(names)])


def _value(c, kind: T.DataType):
    """A text as a value of a type; NULL where it is none."""
    if isinstance(kind, T.BooleanType):
        return F.when(c.rlike(_BOOLEAN), c.try_cast(kind))
    if isinstance(kind, T.IntegralType):
        return F.when(c.rlike(_INTEGER), c.try_cast(kind))
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        value = F.when(c.rlike(_NUMBER), c.try_cast(kind))
        return F.when(~F.isnan(value), value)
    return c.try_cast(kind)


def _typed(raw: DataFrame, schema: T.StructType, on_bad: str) -> DataFrame:
    """The columns of ``schema``, and what is wrong with a row that does not fit.

    Short rows are padded with NULL.  A row with too many fields or with a text
    that is no value of its column's type stops the job, or is kept with a
    reason in ``BAD``.  NaN is NULL.
    """
    if on_bad not in ("fail", "keep"):
        raise ValueError("on_bad is 'fail' or 'keep'")
    out, reasons = {}, [F.when(F.col(_SURPLUS).isNotNull(), F.lit("too many fields"))]
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            continue
        value = _value(c, f.dataType)
        # without missing markers a NaN may be there, which is a value that is missing
        nan = F.lower(c) == "nan" if isinstance(f.dataType, T.FractionalType) else F.lit(False)
        reasons.append(F.when(c.isNotNull() & value.isNull() & ~nan, F.concat(F.lit(f"{f.name}: "), c)))
        out[f.name] = value
    reason = F.nullif(F.concat_ws("; ", *reasons), F.lit(""))
    if on_bad == "keep":
        return raw.withColumn(BAD, reason).withColumns(out)
    fits = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("bad row in "), F.col("_file"), F.lit(": "), reason)))
    return raw.filter(fits.isNull()).withColumns(out)


def _missing(df: DataFrame, names: Sequence[str], na_tokens: bool) -> DataFrame:
    """NULL for empty fields and, if wanted, for the missing markers, in texts and numbers alike."""
    cell = (lambda c: null_if_na(c)) if na_tokens else (lambda c: c)
    return df.withColumns({c: cell(F.nullif(F.col(f"`{c}`"), F.lit(""))) for c in names})


def csv_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    *,
    na_tokens: bool = True,
    multi_line: bool = True,
    position: bool = False,
    on_bad: str = "fail",
    line_end: str | None = None,
) -> DataFrame:
    """Read headered CSV.  Empty fields and missing markers become NULL.

    Line ends are those of each file's first line, which takes a pass over the
    files unless ``line_end`` is given; inside quotes they are kept as they are.
    Without a schema the types are inferred from what is left after the markers,
    at the cost of one more pass: ``true`` and ``false`` in any case are booleans,
    digits are whole numbers, and decimals with a point, an exponent or ``inf``
    are doubles.  Everything else is text, and so is a column with a value that
    its numbers would change: a whole number beyond 64 bits, one beyond 2**53
    beside decimals, or more than 17 digits.  A file without a header raises.  ``on_bad``: ``fail`` stops at a row with too
    many fields or an unreadable value, ``keep`` tells what is wrong in ``BAD``
    (count its non-NULL rows).  A quoted line break makes a file unsplittable:
    pass ``multi_line=False`` for files without such fields and write large
    tables as many files.

    ``position`` adds ``_file``, ``_block`` (where the split of the file starts)
    and ``_pos``, which sort in file order.  They stay the same for as long as
    the files do.
    """
    names = schema.fieldNames() if schema else _header(spark, path, multi_line)
    read = _raw(spark, path, names, multi_line, line_end)
    folders = [c for c in read.columns if c not in (*names, _SURPLUS, "_file", "_block")]
    raw = _missing(read, names, na_tokens)
    df = _typed(raw, schema or _inferred(raw, names), on_bad)
    if position:
        df = df.withColumn("_pos", F.monotonically_increasing_id())
    bad = [BAD] if on_bad == "keep" else []
    places = ["_file", "_block", "_pos"] if position else []
    return df.select(*[F.col(f"`{c}`") for c in (*names, *folders)], *bad, *places)


def numbered(rows: DataFrame, name: str = "row_idx") -> DataFrame:
    """Rows of :func:`csv_scan` with ``position``, numbered from 0 in file order.

    Rows are counted for each split of a file, and each split gets the number of
    rows before it: one more pass over the files, but no sort, copy or shuffle.
    Files that change between the two passes raise.  What comes to the driver is a
    row for each split, as many as its own listing has.
    """
    split = ["_file", "_block"]
    counts = rows.groupBy(*split).agg(F.min("_pos").alias("first"), F.max("_pos").alias("last"), F.count("*").alias("n"))
    before, starts = 0, []
    for r in sorted(counts.collect(), key=lambda r: (r["_file"], r["_block"])):
        if r["last"] - r["first"] != r["n"] - 1:
            raise ValueError(f"rows of {r['_file']} have no position of their own")
        starts.append((r["_file"], r["_block"], before - r["first"]))
        before += r["n"]
    shifts = rows.sparkSession.createDataFrame(starts, "_file string, _block long, _shift long")
    told = rows.join(F.broadcast(shifts), split, "left")
    changed = F.raise_error(F.concat(F.lit("a file has changed since its rows were counted: "), "_file"))
    number = F.coalesce(F.col("_pos") + F.col("_shift"), changed.cast("long"))
    return told.withColumn(name, number).drop(*split, "_pos", "_shift")


def file_encodings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, is_utf8) for each file, checked line by line in parallel.

    The text source keeps the bytes of a line, and no UTF-8 sequence holds a
    line feed, so a file is valid exactly when all of its lines are.
    """
    lines = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(F.is_valid_utf8("value")).alias("is_utf8")
    )


def encoding_fallback_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    *,
    na_tokens: bool = True,
    multi_line: bool = True,
    on_bad: str = "fail",
    line_end: str | None = None,
) -> DataFrame:
    """:func:`csv_scan` of files that are UTF-8 or, where that fails, latin1.

    Latin1 maps every byte to a character, so all files are parsed that way
    once; texts of valid UTF-8 files are turned back into bytes and decoded.
    Names and types without a schema are those of :func:`csv_scan`.
    """
    names = schema.fieldNames() if schema else _header(spark, path, multi_line)
    read = _raw(spark, path, names, multi_line, line_end, "ISO-8859-1")
    folders = [c for c in read.columns if c not in (*names, _SURPLUS, "_file", "_block")]
    latin = written(
        file_encodings(spark, path).filter(~F.col("is_utf8")).select(F.col("file").alias("_file")),
        "latin1-files",
    )
    tagged = read.join(latin.withColumn("_latin1", F.lit(True)), "_file", "left")

    def decoded(name: str):
        c = F.col(f"`{name}`")
        return F.when(F.col("_latin1"), c).otherwise(F.decode(F.encode(c, "ISO-8859-1"), "UTF-8"))

    raw = _missing(tagged.withColumns({c: decoded(c) for c in names}), names, na_tokens)
    df = _typed(raw, schema or _inferred(raw, names), on_bad)
    bad = [BAD] if on_bad == "keep" else []
    return df.select(*[F.col(f"`{c}`") for c in (*names, *folders)], *bad)


def csv_export(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 1_000_000,
    encoding: str = "UTF-8",
    mode: str = "errorifexists",
) -> None:
    """Write with a header and without an index; NULL and NaN are empty fields.

    Bounded files keep a later multi-line scan parallel.
    """
    nan_free = {
        f.name: F.when(~F.isnan(f"`{f.name}`"), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    out = df.withColumns(nan_free) if nan_free else df
    writer = out.write.mode(mode).options(
        **_WRITTEN,
        encoding=encoding,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=max_records_per_file,
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
