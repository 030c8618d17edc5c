"""Text of PDF files: text layers and OCR are plug-ins, their order, cleaning and choice are not.

A plug-in for text layers is any callable bytes -> texts of the pages.  One for OCR is a
pair: `render`, bytes -> (raster as a two-dimensional uint8 array, height in points)
of each page, and `recognise`, raster -> text.  Both run on the executors, a file at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import layout
from .records import MIN_CACHED_BYTES, best_text

Extract = Callable[[bytes], Iterable[str]]
Render = Callable[[bytes], Iterable[tuple[np.ndarray, float]]]
Recognise = Callable[[np.ndarray], str]
MAGIC = b"%PDF"


def _run(batches: Iterator[pd.DataFrame], one: Callable[[bytes], Iterable[str]]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for key, content in zip(pdf["path"], pdf["content"], strict=True):
            try:
                rows = [(key, n, text, None) for n, text in enumerate(one(bytes(content)))]
            except Exception as e:  # noqa: BLE001  a file that can't be read is an outcome, not the end of the job
                rows = [(key, None, None, f"{type(e).__name__}: {e}")]
            yield pd.DataFrame(rows, columns=["path", "page", "text", "error"]).astype({"page": "Int64"})


def pages(files: DataFrame, extract: Extract) -> DataFrame:
    """(path, page, text, error): a row per page of each file (path, content); one with the error where it can't be read."""
    return files.select("path", "content").mapInPandas(partial(_run, one=extract), "path string, page long, text string, error string")


def read_page(gray: np.ndarray, height: float, page: int, recognise: Recognise) -> str:
    """Text of a raster: the head over its full width, below it the left and then the right column."""
    top = layout.split_at(gray, height, page)
    rows, width = gray.shape
    scale = rows / height
    if page == 0 and top >= height - layout.LEAST_HEIGHT:
        return recognise(gray)

    def region(x0: float, y0: float, x1: float, y1: float) -> str:
        if x1 <= x0 or y1 - y0 < layout.LEAST_HEIGHT:
            return ""
        return recognise(gray[int(y0 * scale) : int(y1 * scale), int(x0 * scale) : int(x1 * scale)]).rstrip()

    wide = width / scale
    left, right = wide / 2 - layout.GUTTER / 2, wide / 2 + layout.GUTTER / 2
    head = recognise(gray[: int(top * scale)]).rstrip() if page == 0 else ""
    return "\n\n".join(x for x in (head, region(0, top, left, height), region(right, top, wide, height)) if x)


def ocr_pages(files: DataFrame, render: Render, recognise: Recognise) -> DataFrame:
    """(path, page, text, error): pages read by OCR in reading order."""

    def one(content: bytes) -> list[str]:
        return [read_page(gray, height, n, recognise) for n, (gray, height) in enumerate(render(content))]

    return files.select("path", "content").mapInPandas(partial(_run, one=one), "path string, page long, text string, error string")


def joined(rows: DataFrame, separator: str = "\n") -> DataFrame:
    """(path, text): the pages of each file in order, cleaned of page numbers; no row for a file that couldn't be read."""
    parts = F.array_sort(F.collect_list(F.when(F.col("page").isNotNull(), F.struct("page", "text"))))
    text = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), separator)
    return rows.where("error is null").groupBy("path").agg(T.clean_page_lines(text).alias("text"))


def valid(content: Column, length: Column) -> Column:
    """Whether bytes are a PDF file of some size."""
    return F.coalesce((F.substring(content, 1, len(MAGIC)) == F.lit(bytearray(MAGIC))) & (length > MIN_CACHED_BYTES), F.lit(False))


def combined(files: DataFrame, extract: Extract, ocr: tuple[Render, Recognise] | None = None) -> DataFrame:
    """(path, pdf_text, method, readable, error): the best text of each file (path, content).

    The text layer if it is readable, else OCR; a file that is no PDF, or of which nothing could be read, has an error and no text.
    OCR runs only on files whose layer isn't readable; its errors leave the layer.
    """
    checked = files.select("path", "content", valid(F.col("content"), F.octet_length("content")).alias("good"))
    good = checked.where("good")
    layers = pages(good, extract)
    raw = good.select("path").join(joined(layers), "path", "left").select("path", F.col("text").alias("raw"))
    failed = layers.where("error is not null").groupBy("path").agg(F.min("error").alias("error"))
    if ocr:
        poor = good.join(raw.where(~F.coalesce(T.is_readable(F.col("raw")), F.lit(False))).select("path"), "path", "left_semi")
        raw = raw.join(joined(ocr_pages(poor, *ocr), "\n\n").withColumnRenamed("text", "ocr"), "path", "left")
    else:
        raw = raw.withColumn("ocr", F.lit(None).cast("string"))
    read = best_text(raw).join(failed, "path", "left")
    out = read.select("path", F.col("text").alias("pdf_text"), "method", "readable", F.when(F.col("text") == "", F.col("error")).alias("error"))
    return out.unionByName(checked.where("not good").select("path", F.lit(None).cast("string").alias("pdf_text"), F.lit("pdf_unreadable").alias("method"), F.lit(False).alias("readable"), F.lit("no PDF").alias("error")))


def rebuild(docs: DataFrame, texts: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with their text taken anew from files, and all rows with their outcome.

    docs: line (their order), url, pdf_url, pdf_file, text; texts: from `combined`, with the file's name in its path.
    The file is pdf_file, or the last part of pdf_url.  `limit` counts documents that could be read, in order.
    """
    wanted = docs.withColumn("name", F.coalesce(F.nullif(F.col("pdf_file"), F.lit("")), F.element_at(F.split("pdf_url", "/"), -1)))
    files = texts.select(F.element_at(F.split("path", "/"), -1).alias("name"), "pdf_text", "method", "readable")
    rows = wanted.join(files, "name", "left")
    read = F.coalesce(F.col("readable"), F.lit(False)) | F.coalesce(T.is_readable(F.col("pdf_text")), F.lit(False))
    outcome = F.when(F.coalesce("name", F.lit("")) == "", "no file name").when(F.col("method").isNull(), "missing file").when(~read, "not readable").otherwise("ok")
    rows = rows.withColumn("outcome", outcome)
    done = rows.where("outcome = 'ok'").withColumn("text", F.col("pdf_text")).withColumn("text_source", F.col("method"))
    done = done.orderBy("line").limit(limit) if limit is not None else done
    return done.drop("pdf_text", "readable", "outcome"), rows.select("line", "url", "name", "outcome")
