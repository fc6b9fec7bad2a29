"""Sampling grid of each city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse import schemas as S


def grid_points(boxes: DataFrame, size: int = S.GRID_SIZE, bbox_col: str = "bbox") -> DataFrame:
    """Centres of the ``size`` x ``size`` cells of each box, as ``grid_id``, ``lat``, ``lon``.

    ``bbox_col`` holds "minLon,minLat,maxLon,maxLat"; text of any other form gives no points.
    A narrow plan: the grid indices are generated per row, nothing is joined.
    """
    others = [c for c in boxes.columns if c != bbox_col]
    corner = F.transform(F.split(bbox_col, ","), lambda part: F.trim(part).try_cast("double"))
    index = F.sequence(F.lit(0), F.lit(size - 1))
    lon0, lat0, lon1, lat1 = (F.get("corner", F.lit(k)) for k in range(4))
    step_x = (lon1 - lon0) / F.lit(size)
    step_y = (lat1 - lat0) / F.lit(size)
    return (
        boxes.select(*others, corner.alias("corner"))
        .filter((F.size("corner") == 4) & F.forall("corner", lambda v: v.isNotNull()))
        .select(*others, "corner", F.explode(index).alias("i"))
        .select(*others, "corner", "i", F.explode(index).alias("j"))
        .select(
            *others,
            F.concat_ws("_", F.lit("grid"), F.col("i"), F.col("j")).alias("grid_id"),
            (lat0 + F.col("j") * step_y + step_y / 2).alias("lat"),
            (lon0 + F.col("i") * step_x + step_x / 2).alias("lon"),
        )
    )
