"""Order-dependent operators as higher-order folds: running-mean row clusters, cell text merging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_clusters(boxes: Column) -> Column:
    """Row number (from 0) of each box in an array of structs with cy, cx and height: sorted by cy and cx, a box opens a new
    row when it lies further from the running mean of the row than max(12, 0.6 of the median height)."""
    heights = F.array_sort(F.transform(boxes, lambda b: b["height"].cast("double")))
    n = F.size(heights)
    half = F.floor((n - 1) / 2).cast("int")
    median = (F.element_at(heights, half + 1) + F.element_at(heights, F.floor(n / 2).cast("int") + 1)) / 2
    reach = F.greatest(F.lit(12.0), median * 0.6)
    ordered = F.array_sort(F.transform(boxes, lambda b: F.struct(b["cy"].cast("double").alias("cy"), b["cx"].cast("double").alias("cx"), b["id"].alias("id"))))
    zero = F.struct(F.lit(-1).alias("row"), F.lit(0.0).alias("total"), F.lit(0).alias("k"), F.array().cast("array<struct<id:bigint,row:int>>").alias("out"))

    def step(a: Column, b: Column) -> Column:
        opens = (a["k"] == 0) | (F.abs(b["cy"] - a["total"] / F.greatest(a["k"], F.lit(1))) > reach)
        row = a["row"] + F.when(opens, 1).otherwise(0)
        return F.struct(row.alias("row"), (F.when(opens, F.lit(0.0)).otherwise(a["total"]) + b["cy"]).alias("total"), (F.when(opens, 0).otherwise(a["k"]) + 1).alias("k"), F.concat(a["out"], F.array(F.struct(b["id"].cast("bigint").alias("id"), row.alias("row")))).alias("out"))

    return F.when(F.size(boxes) > 0, F.aggregate(ordered, zero, step, lambda a: a["out"])).otherwise(F.array().cast("array<struct<id:bigint,row:int>>"))


def merge_cell_texts(items: Column, gap: float = 8.0) -> Column:
    """Texts of a cell in reading order: repeats of the text before are left out; a line break if any two of them lie more
    than `gap` apart vertically, else a space. items: array of structs cy, cx, text."""
    ordered = F.array_sort(F.transform(items, lambda b: F.struct(b["cy"].alias("cy"), b["cx"].alias("cx"), b["text"].alias("text"))))
    zero = F.array().cast("array<struct<cy:double,cx:double,text:string>>")
    kept = F.aggregate(ordered.cast("array<struct<cy:double,cx:double,text:string>>"), zero, lambda a, b: F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["text"] == b["text"]), a).otherwise(F.concat(a, F.array(b))))
    spread = F.exists(F.zip_with(F.slice(kept, 2, F.greatest(F.lit(0), F.size(kept) - 1)), F.slice(kept, 1, F.greatest(F.lit(0), F.size(kept) - 1)), lambda x, y: x["cy"] - y["cy"]), lambda g: g > gap)
    texts = F.transform(kept, lambda x: x["text"])
    return F.when(spread, F.array_join(texts, "\n")).otherwise(F.array_join(texts, " "))
