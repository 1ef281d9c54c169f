"""Boundaries to what is not relational: PDF decoding, recognition of page images, language models. A provider is a
function over one input that runs inside mapInPandas, once per row; a failure gives an error row and never fails the job.
Without a provider the table-backed defaults read precomputed text."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = "doc_id string, page_index int, width double, height double, lines array<string>, ocr_used boolean, error string"


#: Languages of recognition; least and greatest resolution; what switches something off.
LANGUAGES = ("ch", "en", "chinese_cht", "ja", "ko", "th", "fr", "de", "ru", "es", "pt", "it", "ar", "vi")
DPI, OFF = (72, 1200), ("0", "false", "")


@dataclass(frozen=True)
class Settings:
    """Limits of a run, checked when made."""

    ocr_enabled: bool = True
    ocr_table_enabled: bool = True
    ocr_language: str = "ch"
    ocr_dpi: int = 300
    ocr_reduced_dpi: int = 220
    ocr_batch_pages: int = 6
    ocr_large_document: int = 8
    ocr_seconds: float = 180
    ocr_soft_seconds: float | None = None
    pipeline_seconds: float = 1200
    refine_rounds: int = 2
    refine_candidates: int = 12
    chars_per_page: int = 60
    heading_words: int = 14
    languages: tuple[str, ...] = LANGUAGES

    def __post_init__(self):
        if self.ocr_language.strip().lower() not in self.languages:
            raise ValueError(f"ocr_language must be one of {self.languages}")
        if not all(DPI[0] <= x <= DPI[1] for x in (self.ocr_dpi, self.ocr_reduced_dpi)):
            raise ValueError(f"resolutions must lie between {DPI[0]} and {DPI[1]}")
        if min(self.ocr_batch_pages, self.ocr_large_document, self.refine_candidates, self.heading_words) < 1 or min(self.ocr_seconds, self.pipeline_seconds) <= 0:
            raise ValueError("limits must be positive")
        if self.refine_rounds < 0 or self.chars_per_page < 0:
            raise ValueError("rounds and characters must not be negative")

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None, **changes) -> Settings:
        """Settings as the environment has them, and `changes` over them."""
        env = os.environ if env is None else env
        on = lambda name: env.get(name, "1").strip().lower() not in OFF
        soft = env.get("OCR_SOFT_TIMEOUT_SECONDS")
        found = {
            "ocr_enabled": on("OCR_ENABLED"), "ocr_table_enabled": on("OCR_TABLE_ENABLED"), "ocr_language": env.get("OCR_LANG", "ch"), "ocr_dpi": int(env.get("OCR_DPI", "300")), "ocr_reduced_dpi": int(env.get("OCR_REDUCED_DPI", "220")),
            "ocr_batch_pages": int(env.get("OCR_PAGE_BATCH_SIZE", "6")), "ocr_large_document": int(env.get("OCR_LARGE_DOC_PAGE_THRESHOLD", "8")), "ocr_seconds": float(env.get("OCR_TIMEOUT_SECONDS", "180")), "ocr_soft_seconds": float(soft) if soft else None,
            "pipeline_seconds": float(env.get("PIPELINE_TIMEOUT_SECONDS", "1200")), "refine_rounds": int(env.get("LLM_STRUCTURE_REFINE_ROUNDS", "2")), "refine_candidates": int(env.get("LLM_STRUCTURE_REFINE_CANDIDATES", "12")),
        }
        return cls(**(found | changes))

    @property
    def soft_limit(self) -> float:
        """Seconds after which a recognition run begins no further batch."""
        return self.ocr_seconds if self.ocr_soft_seconds is None else self.ocr_soft_seconds

    def plan(self, pages: int) -> dict:
        """Resolution and batches of a recognition run over so many pages."""
        reduced = pages >= self.ocr_large_document and self.ocr_reduced_dpi < self.ocr_dpi
        return {"dpi": self.ocr_reduced_dpi if reduced else self.ocr_dpi, "batches": -(-max(0, pages) // self.ocr_batch_pages), "reduced": reduced}


def decode_pages(files: DataFrame, decode: Callable[[bytes], list[dict]]) -> DataFrame:
    """Pages of files(path, content): decode returns a dict per page with lines, width and height."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "page_index", "width", "height", "lines", "ocr_used", "error"]
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"]):
                try:
                    for i, p in enumerate(decode(bytes(content))):
                        rows.append((path, i, p.get("width"), p.get("height"), list(p["lines"]), False, None))
                except Exception as error:  # a broken file is a row, not a failed job
                    rows.append((path, None, None, None, [], False, f"{type(error).__name__}: {error}"[:300]))
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(run, PAGES)


def open_both(content: bytes, first: Callable[[bytes], object], second: Callable[[bytes], object]) -> tuple[object, object] | None:
    """Both decoders' documents, or None if one of them does not open; the first is closed if the second fails."""
    try:
        one = first(content)
    except Exception:
        return None
    try:
        return one, second(content)
    except Exception:
        close = getattr(one, "close", None)
        if close:
            close()
        return None


def page_texts(native: DataFrame, other: DataFrame, recognised: DataFrame) -> DataFrame:
    """Lines of pages: recognised text where there is some, else the first decoder's, else the second's; lines are
    normalised and empty ones left out. All three have (doc_id, page_index, text); native has width and height too."""
    keys = ["doc_id", "page_index"]
    met = native.join(other.select(*keys, F.col("text").alias("_other")), keys, "left").join(recognised.select(*keys, F.col("text").alias("_ocr")), keys, "left")
    used = F.coalesce(F.col("_ocr"), F.lit("")) != ""
    text = F.when(used, F.col("_ocr")).otherwise(F.when(F.coalesce(F.col("text"), F.lit("")) != "", F.col("text")).otherwise(F.coalesce("_other", F.lit(""))))
    flat = lambda x: F.trim(F.regexp_replace(x, r"(?U)[\s\u3000]+", " "))
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), flat), lambda x: x != "")
    return met.select(*keys, "width", "height", lines.alias("lines"), used.alias("ocr_used"))


def with_recognised(pages: DataFrame, recognised: DataFrame) -> DataFrame:
    """Pages whose text is replaced by recognised text(doc_id, page_index, text) where that was accepted."""
    text = recognised.select("doc_id", "page_index", F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "").alias("_ocr"))
    met = pages.join(text, ["doc_id", "page_index"], "left")
    return met.withColumn("lines", F.coalesce("_ocr", "lines")).withColumn("ocr_used", F.col("_ocr").isNotNull()).drop("_ocr")


def regular_grid(grid: str):
    """A recognised table as a regular one: null below two rows; rows padded to the widest, empty columns at the end cut."""
    g = F.col(grid)
    width = F.array_max(F.transform(g, lambda r: F.size(r)))
    padded = F.transform(g, lambda r: F.concat(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), F.array_repeat(F.lit(""), width - F.size(r))))
    used = F.greatest(F.lit(1), F.array_max(F.transform(padded, lambda r: F.coalesce(F.array_max(F.transform(r, lambda c, i: F.when(c != "", i + 1).otherwise(0))), F.lit(0)))))
    return F.when(F.size(g) >= 2, F.transform(padded, lambda r: F.slice(r, 1, used)))
