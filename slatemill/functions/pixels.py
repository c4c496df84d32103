"""Statistics of pictures: shares and counts of pixels, in Arrow batches over raw RGB bytes."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def statistics(rgb: np.ndarray) -> tuple[float, int, int, float]:
    """(share of pixels that are not white, red ones, blue ones, share of the canvas that the content's box takes) of an array (height, width, 3)."""
    r, g, b = (rgb[:, :, k].astype(int) for k in range(3))
    ink = (rgb < 246).any(axis=2)
    red, blue = (r > 145) & (g < 115) & (b < 115), (b > 145) & (r < 110) & (g < 170)
    ys, xs = np.nonzero(ink)
    box = 0.0 if len(xs) < 20 else (xs.max() - xs.min() + 1) * (ys.max() - ys.min() + 1) / ink.size
    return round(float(ink.mean()), 4), int(red.sum()), int(blue.sum()), round(float(box), 4)


def picture_statistics(df: DataFrame, width: str = "width", height: str = "height", rgb: str = "rgb") -> DataFrame:
    """df without its pixels, with nonwhite_ratio, red_pixels, blue_pixels and content_canvas_ratio; all null where the bytes are missing or do not fit the size."""
    rest = [c for c in df.columns if c != rgb]

    def measure(batches):
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            rows = []
            for w, h, data in zip(get(width).to_pylist(), get(height).to_pylist(), get(rgb).to_pylist()):
                fits = data is not None and w and h and len(data) == 3 * w * h
                rows.append(statistics(np.frombuffer(data, np.uint8).reshape(h, w, 3)) if fits else (None,) * 4)
            kinds = (pa.float64(), pa.int64(), pa.int64(), pa.float64())
            made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.nulls(0, k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*(get(c) for c in rest), *made], names=[*rest, "nonwhite_ratio", "red_pixels", "blue_pixels", "content_canvas_ratio"])

    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in rest)
    return df.mapInArrow(measure, spec + ", nonwhite_ratio double, red_pixels long, blue_pixels long, content_canvas_ratio double")
