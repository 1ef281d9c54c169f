"""What the pipeline does between reviews: suspicious blocks, a model's decisions on candidates, pages to recognise, the
plan of a recognition run, and the repairs of a document."""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.lines import any_of
from stratafold.functions.patterns import Refine
from stratafold.plans.checks import PROBLEMS, scored
from stratafold.plans.registry import query, with_
from stratafold.plans.review import BLOCK_REASONS, reason_tests, score_of
from stratafold.plans.state import relations, texts, whole
from stratafold.plans.text_layer import gate, metrics, tally, watermark
from stratafold.sources.language import SUMMARY_RULES, TAG_RULES

#: Candidates that a model is shown; reasons that do not settle a block's case; pages, resolution and batch of
#: a recognition run; Chinese names of the dimensions, as the signature of the deductions has them.
SHOWN, SOFT_BLOCKS = 12, ("sentence_fragment", "lowercase_fragment")
LARGE_FROM, FULL_DPI, REDUCED_DPI, LEAST_DPI, BATCH_PAGES, TABLE_BATCH = 8, 300, 220, 72, 6, 4
DIMENSIONS = {"base": "基础质量", "factual": "事实正确性", "consistency": "一致性与可追溯性"}


def suspects(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """`bsus`: blocks with a reason to doubt them; `hard` tells whether one of the reasons settles the case."""
    tests = reason_tests(d, "txt")
    tests["very_short_fragment"] = f"(length(txt) <= 3 AND kind IN ({d.lit('表格碎片')}, {d.lit('标题')}))"
    tests["sentence_fragment"] = f"(title <> '' AND {d.ends('title', '.')} AND {d.words('title')} <= 6)"
    tests["lowercase_fragment"] = f"(title <> '' AND {d.match('title', Refine.TRAILING_FRAGMENT_RE)} AND length(content) < 160)"
    codes = (*BLOCK_REASONS, *SOFT_BLOCKS)
    return relations(d, given, "blk") | {
        "b0": f"SELECT doc_id, ord, {d.norm('kind')} AS kind, {d.norm('title')} AS title, {d.norm('content')} AS content, page_no FROM blk",
        "b1": "SELECT *, CASE WHEN title <> '' THEN title ELSE content END AS txt FROM b0",
        "b2": d.pin("(SELECT * FROM b1 WHERE txt <> '') x", **{f"r_{c}": f"({tests[c]})" for c in codes}),
        "b3": f"SELECT doc_id, ord, kind, txt, page_no, {score_of(codes)} AS score, {any_of([f'r_{c}' for c in BLOCK_REASONS])} AS hard FROM b2",
        "bsus": "SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ord) AS BIGINT) AS place FROM b3 WHERE score > 0",
    }


@query
def t02_suspicious_blocks(d, given=None):
    """The blocks that a model is shown: most reasons first."""
    return with_(suspects(d, given), f"SELECT doc_id, ord, kind, txt, page_no, score, place FROM bsus WHERE place <= {SHOWN}")


@query
def g06_hard_blocks(d, given=None):
    return with_(suspects(d, given), "SELECT doc_id, ord, score, hard FROM bsus")


@query
def j12_decisions(d, given=None):
    """Decisions of a model on candidates that exist and that the action suits, in the order in which they are carried out:
    merges from the last place back, then blocks."""
    said = f"SELECT doc_id, concat('blk-', ord) AS candidate_id, {texts(d, 'ord', 'delete', 'to_body', 'keep', 'rename')} AS action FROM blk UNION ALL SELECT doc_id, concat('sec-', ord) AS candidate_id, {texts(d, 'ord', 'merge_previous', 'merge_next', 'keep', 'delete')} AS action FROM sec"
    fits = "((left(c.candidate_id, 3) = 'sec' AND action IN ('merge_previous', 'merge_next')) OR (left(c.candidate_id, 3) = 'blk' AND action IN ('delete', 'to_body')))"
    return with_(
        suspects(d, given) | relations(d, given, "sec") | {
            "cand": "SELECT doc_id, concat('blk-', ord) AS candidate_id, ord FROM bsus WHERE place <= 12 UNION ALL SELECT doc_id, concat('sec-', ord) AS candidate_id, ord FROM sec WHERE length(title) <= 6",
            "said": said,
            "ok": f"SELECT c.doc_id, c.candidate_id, action, ord, CASE WHEN left(c.candidate_id, 3) = 'sec' THEN -ord ELSE 1000 + ord END AS turn FROM cand c JOIN said s ON c.doc_id = s.doc_id AND c.candidate_id = s.candidate_id WHERE {fits}",
        },
        "SELECT doc_id, candidate_id, action, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY turn) AS BIGINT) AS step FROM ok",
    )


def targets(d: Dialect, given: dict[str, str] | None) -> dict[str, str]:
    """`tgt`: pages whose text layer is too weak and that have no recognised text yet, with the reasons."""
    named = gate()
    return relations(d, given, "pg") | {
        "pr": d.rows("pg", d.split("text", "\n"), "raw", "i", "doc_id, page_no, ocr_injected, i, raw"),
        "pn": f"SELECT doc_id, page_no, i AS line_no, line FROM (SELECT doc_id, page_no, i, {d.norm('raw')} AS line FROM pr WHERE NOT ocr_injected) x WHERE line <> ''",
        "pm": metrics(d, "pn", "doc_id, page_no"),
        "pw": f"SELECT *, 1 AS pages, {watermark(d)} AS watermark FROM pm",
        "pt": "SELECT p.doc_id, p.page_no, " + ", ".join(f"coalesce(({v}), {'true' if k == 'low_text_chars' else 'false'}) AS {k}" for k, v in named.items()) + " FROM pg p LEFT JOIN pw w ON p.doc_id = w.doc_id AND p.page_no = w.page_no WHERE NOT p.ocr_injected",
        "tgt": f"SELECT * FROM pt WHERE {any_of([*named])}",
    }


@query
def x20_ocr_targets(d, given=None):
    return with_(targets(d, given), f"SELECT doc_id, page_no, {', '.join(gate())} FROM tgt")


@query
def s08_s09_ocr_runs(d, given=None):
    """Plan of a document's recognition run: pages, resolution, batches of pages and of tables."""
    return with_(
        targets(d, given) | {"n": "SELECT doc_id, count(*) AS pages FROM tgt GROUP BY doc_id"},
        f"SELECT doc_id, pages, CAST(greatest({LEAST_DPI}, CASE WHEN pages >= {LARGE_FROM} THEN least({FULL_DPI}, {REDUCED_DPI}) ELSE {FULL_DPI} END) AS BIGINT) AS dpi, pages >= {LARGE_FROM} AS reduced, {d.div(f'(pages + {BATCH_PAGES - 1})', str(BATCH_PAGES))} AS batches, {d.div(f'(pages + {TABLE_BATCH - 1})', str(TABLE_BATCH))} AS table_batches FROM n",
    )


@query
def s08_page_batches(d, given=None):
    """Batch of every page to be recognised."""
    return with_(targets(d, given), f"SELECT doc_id, page_no, {d.div('(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_no) AS BIGINT) - 1)', str(BATCH_PAGES))} AS batch_no FROM tgt")


@query
def x20_repair_plan(d, given=None):
    """What is done to a document that has not passed: recognise pages and parse again, parse again, rebuild single outputs,
    or nothing, with the reason."""
    has = lambda a: tally(f"action = {d.lit(a)}") + " > 0"
    return with_(
        scored(d, given) | targets(d, given) | {
            "todo": f"SELECT doc_id, {has('标记需OCR')} AS ocr, {has('重跑parser')} AS parse, {has('重建markdown')} AS markdown, {has('重建summary')} AS summary, {has('重建tags')} AS tags, {has('清洗标签噪音')} AS clean FROM lev GROUP BY doc_id",
            "nt": "SELECT doc_id, count(*) AS n FROM tgt GROUP BY doc_id",
        },
        """SELECT w.doc_id, CASE WHEN ocr AND coalesce(n, 0) = 0 THEN 'stop: no page to recognise' WHEN ocr THEN 'recognise, parse' WHEN parse THEN 'parse' WHEN markdown OR summary OR tags OR clean THEN 'rebuild' ELSE 'stop: nothing to repair' END AS step,
          (NOT ocr OR coalesce(n, 0) > 0) AND (ocr OR parse OR markdown) AS markdown, (NOT ocr OR coalesce(n, 0) > 0) AND (ocr OR parse OR summary) AS summary, (NOT ocr OR coalesce(n, 0) > 0) AND (ocr OR parse OR tags) AS tags, (NOT ocr OR coalesce(n, 0) > 0) AND clean AND (ocr OR parse OR NOT tags) AS clean FROM todo w LEFT JOIN nt ON w.doc_id = nt.doc_id""",
    )


@query
def p02_round_states(d, given=None):
    """What a round hands on: the score and how many issues of each review are open."""
    return with_(scored(d, whole(d, given)) | {"n": "SELECT doc_id, review, count(*) AS n FROM iss GROUP BY doc_id, review"}, "SELECT t.doc_id, score, redline, review, coalesce(n, 0) AS n_issues FROM total t LEFT JOIN n ON t.doc_id = n.doc_id")


@query
def c16_rule_signature(d):
    """Short hash over the table of deductions, by issue."""
    rows = sorted((i, DIMENSIONS[dim], pts) for i, _, dim, pts, *_ in PROBLEMS if dim)
    table = "\n".join(f"{i}|{dim}|{pts:.2f}" for i, dim, pts in rows)
    return f"SELECT left({d.sha256(d.lit(table))}, 8) AS signature"


@query
def c15_prompt_signature(d):
    """Short hash over the rules that a model is given for summaries and tags."""
    return f"SELECT left({d.sha256(d.lit(SUMMARY_RULES + chr(10) + '---' + chr(10) + TAG_RULES))}, 8) AS signature"
