"""Recognition of page images: an engine behind a provider boundary, and adapters of what engines return.

An engine is made once per worker and language; where it cannot be made there is none, and pages keep their native text. A
run works in batches of pages and looks at its soft limit between batches, so that finished pages are kept.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

_LOCK = threading.RLock()
#: Name that a recognised text's origin begins with; fewest filled cells of a table; points to an inch.
ORIGIN, FILLED_LEAST, INCH = "paddleocr", 4, 72


@lru_cache(maxsize=1)
def installed() -> str | None:
    """Version of the engine's library, None where it is missing."""
    with _LOCK:
        try:
            import paddleocr
        except Exception:
            return None
        return getattr(paddleocr, "__version__", "unknown")


def origin() -> str:
    """What recognised text names as its origin."""
    version = installed()
    return f"{ORIGIN}-{version}" if version else ORIGIN


@lru_cache(maxsize=8)
def text_engine(lang: str):
    """The worker's engine of a language, None where it cannot be made."""
    with _LOCK:
        if installed() is None:
            return None
        try:
            from paddleocr import PaddleOCR

            return PaddleOCR(lang=lang)
        except Exception:
            return None


@lru_cache(maxsize=1)
def table_engine():
    with _LOCK:
        try:
            from paddleocr import TableStructureRecognition

            return TableStructureRecognition()
        except Exception:
            return None


def raw_result(engine, image):
    """What an engine returns for an image; older ones want to be told to look at the angle."""
    try:
        return engine.ocr(image)
    except TypeError:
        return engine.ocr(image, cls=True)


def bgr(samples: bytes, height: int, width: int, channels: int):
    """A rendered page as an array in the channel order of the engines."""
    import numpy as np

    image = np.frombuffer(samples, np.uint8).reshape(height, width, channels)
    return image[:, :, [2, 1, 0]].copy() if channels >= 3 else image


def chunks(pages: list[int], size: int) -> list[list[int]]:
    size = max(1, int(size))
    return [pages[i : i + size] for i in range(0, len(pages), size)]


def _lines(raw) -> Iterator[tuple[str, float | None, object]]:
    """(text, confidence, box) of a result: records with parallel lists, or nested pairs of a box and (text, confidence)."""
    known = raw if isinstance(raw, dict) else getattr(raw, "__dict__", {})
    texts = known.get("rec_texts")
    if isinstance(texts, (list, tuple)):
        scores, boxes = known.get("rec_scores") or [], known.get("rec_polys") if known.get("rec_polys") is not None else known.get("dt_polys")
        boxes = [] if boxes is None else boxes
        for i, text in enumerate(texts):
            if isinstance(text, str):
                yield text, scores[i] if i < len(scores) else None, boxes[i] if i < len(boxes) else None
    elif isinstance(raw, str):
        yield raw, None, None
    elif isinstance(raw, tuple) and raw and isinstance(raw[0], str):
        yield raw[0], raw[1] if len(raw) > 1 else None, None
    elif isinstance(raw, list):
        if len(raw) == 2 and isinstance(raw[1], (tuple, list)) and raw[1] and isinstance(raw[1][0], str):
            yield raw[1][0], raw[1][1] if len(raw[1]) > 1 else None, raw[0]
        else:
            for child in raw:
                yield from _lines(child)


def flat_text(raw) -> str:
    """The lines of a result with something in them, trimmed, one below the other."""
    return "\n".join(text.strip() for text, _, _ in _lines(raw) if text.strip())


def confidences(raw) -> list[tuple[str, float]]:
    """Lines with their confidence, surest first; an unknown confidence is zero."""
    found = [(text.strip(), 0.0 if sure is None else float(sure)) for text, sure, _ in _lines(raw) if text.strip()]
    return sorted(found, key=lambda x: -x[1])


def rectangle(box) -> tuple[float, float, float, float] | None:
    """Least and greatest coordinates of four numbers or of a polygon's points; None where it is no box."""
    if hasattr(box, "tolist"):
        box = box.tolist()
    if not isinstance(box, (list, tuple)):
        return None
    flat: list[float] = []
    for point in box:
        point = point.tolist() if hasattr(point, "tolist") else point
        flat += map(float, point) if isinstance(point, (list, tuple)) else [float(point)]
    if len(flat) < 4 or len(flat) % 2:
        return None
    xs, ys = flat[0::2], flat[1::2]
    return min(xs), min(ys), max(xs), max(ys)


def placed_lines(raw) -> list[dict]:
    """Lines with their rectangles, by the height and then the side of their centres."""
    out = []
    for text, _, box in _lines(raw):
        rect = rectangle(box)
        if text.strip() and rect:
            out.append({"text": text.strip(), "rect": rect, "cx": (rect[0] + rect[2]) / 2, "cy": (rect[1] + rect[3]) / 2})
    return sorted(out, key=lambda x: (x["cy"], x["cx"]))


def meaningful(grid: list[list[str]]) -> bool:
    return sum(bool(str(c).strip()) for row in grid for c in row) >= FILLED_LEAST


@dataclass
class Run:
    """What a run did."""

    requested: int
    batch_size: int
    seconds: float | None
    executed: int = 0
    successful: int = 0
    batches: int = 0
    timed_out: bool = False
    confidences: dict[int, list[tuple[str, float]]] = field(default_factory=dict)


def recognise(pages: list[int], render: Callable[[int], object], engine, batch_size: int = 6, seconds: float | None = None, clock: Callable[[], float] = time.perf_counter, read: Callable = raw_result) -> tuple[dict[int, str], Run]:
    """(text by page, what was done). A page that cannot be rendered or read is left out; once `seconds` have passed no
    further batch begins, and what is finished is kept. Without an engine nothing is done."""
    run = Run(len(pages), max(1, int(batch_size)), seconds)
    texts: dict[int, str] = {}
    if engine is None or not pages:
        return texts, run
    began = clock()
    for batch in chunks(pages, run.batch_size):
        if seconds is not None and clock() - began >= seconds:
            run.timed_out = True
            break
        run.batches += 1
        for page in batch:
            run.executed += 1
            try:
                raw = read(engine, render(page))
            except Exception:  # one page less
                continue
            text = flat_text(raw)
            if text:
                texts[page] = text
                run.successful += 1
            sure = confidences(raw)
            if sure:
                run.confidences[page] = sure
    return texts, run


def recognised_pages(files: DataFrame, opener: Callable[[bytes, int], tuple[int, Callable[[int], object]]], engine: Callable[[], object], dpi: int = 300, batch_size: int = 6, seconds: float | None = None) -> DataFrame:
    """files(path, content, pages array) -> (doc_id, page_index, text, timed_out, error), a file at a time inside the tasks.
    opener(content, dpi) gives the number of pages and a function that renders one; engine makes the worker's engine."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows: list[tuple] = []
            for path, content, wanted in zip(part["path"], part["content"], part["pages"]):
                try:
                    n, render = opener(bytes(content), max(INCH, dpi))
                    texts, done = recognise([int(p) for p in wanted if 0 <= p < n], render, engine(), batch_size, seconds)
                    rows += [(path, page, text, done.timed_out, None) for page, text in texts.items()] or [(path, None, None, done.timed_out, None)]
                except Exception as error:
                    rows.append((path, None, None, False, f"{type(error).__name__}: {error}"[:300]))
            yield pd.DataFrame(rows, columns=["doc_id", "page_index", "text", "timed_out", "error"])

    return files.select("path", "content", "pages").mapInPandas(run, "doc_id string, page_index int, text string, timed_out boolean, error string")


def recognised_tables(results: Iterable[dict], lines: list[dict], match: Callable[[tuple, list[dict]], int | None], rows_of: Callable[[list[dict]], list[int]], merge: Callable[[list[tuple]], str]) -> list[list[list[str]]]:
    """Grids of the tables that an engine found on a page: its cells in rows, the page's lines put into them; grids with too
    little in them are left out. match, rows_of and merge are the geometry of the plans, handed in."""
    grids = []
    for found in results:
        cells = [{"rect": r, "cx": (r[0] + r[2]) / 2, "cy": (r[1] + r[3]) / 2, "texts": []} for r in map(rectangle, found.get("bbox", [])) if r]
        for line in lines:
            at = match(line["rect"], cells)
            if at is not None:
                cells[at]["texts"].append((line["cy"], line["cx"], line["text"]))
        rows: dict[int, list[dict]] = {}
        for cell, row in zip(cells, rows_of(cells)):
            rows.setdefault(row, []).append(cell)
        width = max(map(len, rows.values()), default=0)
        grid = [[merge(c["texts"]) for c in sorted(rows[r], key=lambda c: c["cx"])] for r in sorted(rows)]
        grid = [row + [""] * (width - len(row)) for row in grid]
        if meaningful(grid):
            grids.append(grid)
    return grids
