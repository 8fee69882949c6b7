"""Interpretation of document table rows (CEL1, WIN1, EXP1, EXP2).

Input: one row per table row with the cells as an array (``cells``) or, for
already-split tables, one column per header field. The question text and the
result are carried down a document (across tables and questions, never
reset); rows without a channel are dropped after they updated that state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as E
from .ordered import carry_forward


def interpret_rows(rows: DataFrame, doc: str = "doc", order: list[str] | None = None,
                   question: str = "cell_question", parameter: str = "cell_parameter",
                   metric_i: str = "cell_i", metric_ii: str | None = None, result: str = "cell_result") -> DataFrame:
    """CEL1+WIN1 on split cells: carried question/result, parsed numbers,
    question code/text/type of the carried question."""
    order = order or ["row_no"]
    q = F.nullif(E.utrim(F.coalesce(F.col(question), F.lit(""))), F.lit(""))
    d = rows.select("*", q.alias("_q"), E.to_float(result).alias("_r"))
    c = carry_forward(d, [doc], order, ["_q", "_r"])
    p = E.utrim(F.coalesce(F.col(parameter), F.lit("")))
    parts = E.question_parts(F.col("ffill__q"))
    out = c.where(p != "").select(
        F.col(doc), *[F.col(o) for o in order],
        F.col("ffill__q").alias("question_raw"),
        parts["code"].alias("question_code"), parts["text"].alias("question_text"), parts["type"].alias("question_type"),
        p.alias("parameter"), E.to_float(metric_i).alias("metric_i"),
        (E.to_float(metric_ii) if metric_ii else F.lit(None).cast("double")).alias("metric_ii"),
        F.col("ffill__r").alias("score_result"))
    return out


def header_rows(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """Flag header rows: some cell equals 'вопрос' and some equals 'параметр'
    (case-insensitive)."""
    low = F.transform(F.col(cells), lambda x: F.lower(x))
    return rows.withColumn("is_header", F.array_contains(low, "вопрос") & F.array_contains(low, "параметр"))


def cells_to_fields(rows: DataFrame, doc: str = "doc", table: str = "tbl_no", row: str = "row_no",
                    cells: str = "cells") -> DataFrame:
    """Map every data row's cells to header fields: the last header row of
    the same table (or the default header), looked up case-insensitively;
    short rows are padded with ''. Blank rows are dropped first."""
    nonblank = F.exists(F.col(cells), lambda x: F.length(x) > 0)
    r = header_rows(rows.where(nonblank), cells)
    # only the header's row number is carried; the header itself is joined by that number
    r = r.withColumn("_hdr_row", F.when(F.col("is_header"), F.col(row).cast("double")))
    heads = r.where("is_header").select(F.col(doc).alias("_h_doc"), F.col(table).alias("_h_tbl"),
                                        F.col(row).cast("double").alias("_h_row"), F.col(cells).alias("_hdr"))
    c = carry_forward(r, [doc, table], [row], ["_hdr_row"])
    c = c.join(heads, (F.col(doc) == F.col("_h_doc")) & (F.col(table) == F.col("_h_tbl"))
               & (F.col("ffill__hdr_row") == F.col("_h_row")), "left")
    hdr = F.coalesce(F.col("_hdr"), F.array(*[F.lit(h) for h in K.DOCX_DEFAULT_HEADER]))
    up = F.transform(hdr, lambda h: F.lower(h))
    rev = F.reverse(up)

    def field(name):
        # last header cell with this (case-insensitive) name wins; '' when the row is shorter
        pos = F.array_position(rev, F.lit(name))
        idx = F.size(up) - pos  # 0-based index of the last occurrence
        return F.when(pos > 0, F.coalesce(F.get(F.col(cells), idx.cast("int")), F.lit("")))

    data = c.where(~F.col("is_header"))
    return data.select(doc, table, row, field("вопрос").alias("cell_question"), field("параметр").alias("cell_parameter"),
                       field("i").alias("cell_i"), field("ii").alias("cell_ii"), field("результат").alias("cell_result"))
