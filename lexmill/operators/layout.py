"""Page layout: where a page of one column goes over into two, from a grayscale raster.

Numpy over whole rasters in Arrow batches; no PDF library is needed, rasters come
from a plug-in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Raster resolution, darkness, strip height in pixels, score and persistence of a gutter, gutter width in points.
DPI, DARK, STRIP, SCORE, PERSIST, GUTTER = 150, 210, 12, 8.0, 2, 14.0
TOP_SHARE, LATE_SHARE, LEAST_HEAD, SHIFT, LEAST_SIDE = 0.20, 0.88, 50.0, 10.0, 20
#: Regions lower than this many points aren't read.
LEAST_HEIGHT = 20


def strip_scores(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper edges of the strips and the gutter score of each: dark points beside the middle over those in it."""
    h, w = gray.shape
    tops = np.arange(int(h * TOP_SHARE), h - STRIP, STRIP)
    x = np.arange(0, w, 2)
    left, right, centre = x < int(w * 0.38), x > int(w * 0.62), (x >= int(w * 0.42)) & (x <= int(w * 0.58))
    scores = np.zeros(len(tops))
    for k, top in enumerate(tops):
        dark = gray[top : top + STRIP : 2, ::2] < DARK
        a, b, c = (int(dark[:, zone].sum()) for zone in (left, right, centre))
        scores[k] = 0.0 if a < LEAST_SIDE or b < LEAST_SIDE else (a + b) / (c + 1)
    return tops, scores


def split_at(gray: np.ndarray, height: float, page: int) -> float:
    """Points from the top where two columns begin; the page's height for one column."""
    if page > 0:
        return 0.0
    tops, scores = strip_scores(gray)
    run = 0
    for k, s in enumerate(scores):
        run = run + 1 if s >= SCORE else 0
        if run >= PERSIST:
            y = tops[k - PERSIST + 1] * (height / gray.shape[0]) + SHIFT
            return height if y < LEAST_HEAD or y >= LATE_SHARE * height else float(y)
    return height


@F.pandas_udf(DoubleType())
def split_y(w: pd.Series, h: pd.Series, gray: pd.Series, height: pd.Series, page: pd.Series) -> pd.Series:
    return pd.Series([split_at(np.frombuffer(g, np.uint8).reshape(int(b), int(a)), float(c), int(p)) for a, b, g, c, p in zip(w, h, gray, height, page, strict=True)])


def column_clips(width: Column, height: Column, top: Column) -> Column:
    """The left and the right column's rectangle below `top`."""
    middle = width / 2
    box = lambda a, b: F.struct(a.alias("x0"), top.alias("y0"), b.alias("x1"), height.alias("y1"))
    return F.array(box(F.lit(0.0), middle - GUTTER / 2), box(middle + GUTTER / 2, width))


def intersection(a: Column, b: Column) -> Column:
    """The common rectangle; null if it is empty or lower than 20 points."""
    x0, y0 = F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"])
    x1, y1 = F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"])
    return F.when((x1 > x0) & (y1 - y0 >= LEAST_HEIGHT), F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))


def assembled(head: Column, left: Column, right: Column) -> Column:
    """Head, left and right column in reading order, a blank line between them, empty parts left out."""
    return F.array_join(F.filter(F.array(head, left, right), lambda x: F.coalesce(F.trim(x), F.lit("")) != ""), "\n\n")
