"""Tabular sources and sinks (SRC7, SRC8, SNK1-SNK4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import exprs as E


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC7: CSV with a header; explicit schema when known (no inference pass)."""
    r = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    return (r.schema(schema) if schema is not None else r.option("inferSchema", False)).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """SNK1/SNK2: parquet (default) or CSV tables."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_summary(df: DataFrame, path: str) -> None:
    """SNK3: one JSON document per row (nested structs/maps kept)."""
    df.write.mode("overwrite").json(path)


def adapt_upload(df: DataFrame, name: str = "uploaded.csv", test_id: str | None = None) -> tuple[DataFrame, str]:
    """SRC8: recognise an uploaded table. Wide (any i_/ii_ column) passes
    through; long needs question_raw + parameter (any case) and gets the
    I/II/result aliases and defaults. Returns (df, 'wide'|'long')."""
    cols = df.columns
    if any(c.startswith("i_") or c.startswith("ii_") for c in cols):
        return df, "wide"
    low = {c.lower(): c for c in cols}
    if "question_raw" not in low or "parameter" not in low:
        raise ValueError("Unsupported table format. Required columns: question_raw and parameter.")

    def pick(*names):
        for n in names:
            if n in cols:
                return F.col(n)
            if n.lower() in low:
                return F.col(low[n.lower()])
        return None

    stem = test_id or name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    qraw = F.col(low["question_raw"])
    exprs = {
        "source_file": pick("source_file") if pick("source_file") is not None else F.lit(name),
        "source_type": pick("source_type") if pick("source_type") is not None else F.lit("upload"),
        "test_id": pick("test_id") if pick("test_id") is not None else F.lit(stem),
        "question_raw": qraw,
        "question_code": pick("question_code") if pick("question_code") is not None else qraw,
        "question_text": pick("question_text") if pick("question_text") is not None else qraw,
        "question_type": pick("question_type") if pick("question_type") is not None else F.lit("other"),
        "parameter": F.col(low["parameter"]),
        "metric_i": E.to_double(pick("metric_i", "I", "i") if pick("metric_i", "I", "i") is not None else F.lit(None)),
        "metric_ii": E.to_double(pick("metric_ii", "II", "ii") if pick("metric_ii", "II", "ii") is not None else F.lit(None)),
        "score_result": E.to_double(pick("score_result", "Результат", "result", "score")
                                    if pick("score_result", "Результат", "result", "score") is not None else F.lit(None)),
    }
    out = df.select(*[v.cast("string" if k not in ("metric_i", "metric_ii", "score_result") else "double").alias(k)
                      for k, v in exprs.items()])
    for c, t in [("question_type_code", "string"), ("is_allowed", "boolean"), ("waiting_answer_raw", "string"),
                 ("waiting_answer_label", "string"), ("waiting_answer_ru", "string")]:
        out = out.withColumn(c, F.lit(None).cast(t))
    chk = out.agg(F.count("metric_i").alias("i"), F.count("metric_ii").alias("ii")).first()
    if chk["i"] == 0 and chk["ii"] == 0:
        raise ValueError("No numeric I/II metrics were found in the file.")
    return out.select(*[f.name for f in S.RAW.fields]), "long"


#: Names under which a long upload may carry a field: the first that is a column is used, as written or in other case.
UPLOAD_NAMES = {c: [c] for c in S.RAW.fieldNames()} | {
    "metric_i": ["metric_i", "I", "i"], "metric_ii": ["metric_ii", "II", "ii"],
    "score_result": ["score_result", "Результат", "result", "score"]}
UNSUPPORTED = "Unsupported table format. Required columns: question_raw and parameter."
NO_METRICS = "No numeric I/II metrics were found in the file."


def scan_uploads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """SRC8 over a folder: all ``*.csv`` tables under it, whatever their headers, by one plan.

    Returns (files, rows). A file: path, source_file (its name), layout (wide, long or unsupported), n_rows and the error
    that keeps it out (null: none). A row: path, source_file, layout, ``names`` (the file's header) and ``vals``.

    Rows are read as arrays and meet their file's header in a join on the path, so the plan does not grow with the number
    of layouts and no header reaches the driver, which reads one number: the most columns of a line. A file is read by one
    task, record by record (quoted line breaks). Defined cases: a file without a line is not listed; a header alone is a
    file of 0 rows; lines shorter than the header are filled with nulls, longer ones keep what the header names; of equal
    column names the first counts; a leading byte-order mark is dropped."""
    def reader():
        return spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)

    width = reader().text(folder).agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))) + 1).first()[0] or 1
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    lines = (reader().schema(schema).option("header", False).option("multiLine", True).option("escape", '"').csv(folder)
             .select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("_at"),
                     F.array(*schema.fieldNames()).alias("vals")))
    heads = lines.groupBy("path").agg(F.min_by("vals", "_at").alias("names"), F.min("_at").alias("_first"))
    heads = heads.withColumn("names", F.transform("names", lambda n: F.ltrim(n, F.lit("\ufeff"))))
    low = F.transform("names", lambda n: F.lower(n))
    heads = heads.select("path", F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("source_file"),
                         "names", "_first",
                         F.when(F.exists("names", lambda n: n.startswith("i_") | n.startswith("ii_")), "wide")
                         .when(F.array_contains(low, "question_raw") & F.array_contains(low, "parameter"), "long")
                         .otherwise("unsupported").alias("layout"))
    rows = lines.join(heads, "path").where(F.col("_at") > F.col("_first")).drop("_at", "_first")
    usable = F.coalesce(*[_numeric(c) for c in ("metric_i", "metric_ii")]).isNotNull()
    seen = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(usable).alias("_usable"))
    files = heads.join(seen, "path", "left").select(
        "path", "source_file", "layout", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.when(F.col("layout") == "unsupported", UNSUPPORTED)
        .when((F.col("layout") == "long") & (F.coalesce("_usable", F.lit(0)) == 0), NO_METRICS).alias("error"))
    return files, rows


def _field(column: str, default: Column | None = None) -> Column:
    """Value of a field in a row of :func:`scan_uploads`; the default where the file has no such column."""
    def place(names, name):
        return F.nullif(F.array_position(names, name).cast("int"), F.lit(0))

    low = F.transform("names", lambda n: F.lower(n))
    at = F.coalesce(*[p for n in UPLOAD_NAMES.get(column, [column]) for p in (place(F.col("names"), n), place(low, n.lower()))])
    value = F.get("vals", at - 1)
    return value if default is None else F.when(at.isNull(), default).otherwise(value)


def _numeric(column: str) -> Column:
    return E.to_double(_field(column))


def _stem() -> Column:
    return F.regexp_replace("source_file", r"\.[^.]*$", "")


def upload_long(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Records of the long files that can be used, in the columns of all raw sources, with the defaults of an upload."""
    good = files.where("layout = 'long' AND error IS NULL").select("path")
    raw = _field("question_raw")
    defaults = {"source_file": F.col("source_file"), "source_type": F.lit("upload"), "test_id": _stem(), "question_code": raw,
                "question_text": raw, "question_type": F.lit("other")}

    def column(f: T.StructField) -> Column:
        if f.dataType == T.DoubleType():
            return _numeric(f.name)
        value = _field(f.name, defaults.get(f.name))
        return value.try_cast("boolean") if f.dataType == T.BooleanType() else value

    return rows.where("layout = 'long'").join(good, "path", "left_semi").select(*[column(f).alias(f.name) for f in S.RAW.fields])


def upload_wide(rows: DataFrame, ids: list[str], cols: list[str]) -> DataFrame:
    """Rows of the wide files: ``ids`` as text (test_id and source_file by default from the file's name) and ``cols`` as
    numbers, null where a file has no such column."""
    defaults = {"source_file": F.col("source_file"), "test_id": _stem()}
    return rows.where("layout = 'wide'").select(*[_field(c, defaults.get(c)).alias(c) for c in ids], *[_numeric(c).alias(c) for c in cols])


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.FEEDBACK)


def upsert_feedback_log(spark: SparkSession, log_dir: str, new: DataFrame, batch_id: int | None = None, keep: int = 3) -> DataFrame:
    """SNK4 with safe overwrite: versions live in ``log_dir/v=<n>``; the new latest-wins table is written to the next
    version (never over an existing one). Versions are found by listing the folder; only the newest complete one is read,
    and a read error propagates instead of starting anew.

    ``batch_id``: id of a stream's micro-batch. A version holds an empty file ``_batch-<id>`` for the last one folded in,
    so a batch that is played again writes nothing. Complete versions older than the newest ``keep`` are removed."""
    from ..operators.feedback import upsert_feedback
    log_dir = log_dir.rstrip("/")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(log_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def listed(folder: str) -> list[str]:
        return [s.getPath().getName() for s in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []

    versions = sorted(int(n[2:]) for n in listed(log_dir) if n.startswith("v=") and n[2:].isdigit())
    complete = [v for v in versions if fs.exists(path(f"{log_dir}/v={v}/_SUCCESS"))]
    newest = f"{log_dir}/v={complete[-1]}" if complete else None
    folded = max([int(n[7:]) for n in listed(newest) if n.startswith("_batch-")], default=None) if newest else None
    if batch_id is not None and folded is not None and batch_id <= folded:
        return spark.read.parquet(newest)
    target = f"{log_dir}/v={(versions[-1] if versions else -1) + 1}"
    upsert_feedback(spark.read.parquet(newest) if newest else None, new).write.mode("errorifexists").parquet(target)
    mark = folded if batch_id is None else batch_id
    if mark is not None:
        fs.create(path(f"{target}/_batch-{mark}")).close()
    for v in complete[:max(0, len(complete) + 1 - keep)]:
        fs.delete(path(f"{log_dir}/v={v}"), True)
    return spark.read.parquet(target)
