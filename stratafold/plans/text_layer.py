"""Queries over lines of documents: cleaning, repeated noise, text-layer metrics, profile, OCR gate and OCR evaluation."""

from __future__ import annotations

from stratafold.functions import lines as L
from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Local, Ocr, Parser, Profile, Rx
from stratafold.plans.corpora import doc_arrays, doc_lines, spec_lines
from stratafold.plans.registry import query, with_

#: Longest short line of repeated noise, of the layout mode; characters and pages of the OCR gate.
NOISE_LENGTH, SHORT_LINE, CHAR_FLOOR, FLOOR_PER_PAGE = 50, 18, 60, 50


def tally(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def repeated_noise(d: Dialect, lines: str, least: str = "2") -> str:
    """(source, line): lines on at least `least` distinct pages of a document; here a source is a document, doc_id a page."""
    return f"SELECT source, line, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_pages FROM {lines} GROUP BY source, line HAVING count(DISTINCT doc_id) >= {least} AND (length(line) <= {NOISE_LENGTH} OR {d.search('line', L.LONG_NOISE)})"


#: Counts of lines by what they hold.
LINE_COUNTS = {"content": ("search", Profile.CONTENT_LINE_RE), "advert": ("search", Profile.ADVERTISEMENT_LINE_RE), "front": ("search", Profile.FRONT_MATTER_LINE_RE), "section": ("search", Profile.SECTION_SIGNAL_LINE_RE)}
HINTS = {"numbered": ("match", Profile.NUMBERED_HEADING_RE), "parts": ("match", Profile.PART_RE), "product_hints": ("search", Profile.PRODUCT_HINT_RE), "manual_hints": ("search", Profile.MANUAL_HINT_RE), "report_hints": ("search", Profile.REPORT_HINT_RE)}


def _signals(d: Dialect) -> str:
    """Entities are counted in the joined text, as a match may reach over a line end."""
    return f"SELECT *, section_lines + {d.count('full_text', Profile.STANDARD_ENTITY_RE)} + {d.count('full_text', Profile.NUMERIC_PARAM_RE)} + {d.count('full_text', Profile.TABLE_SIGNAL_RE)} AS signals FROM joined"


def metrics(d: Dialect, lines: str, keys: str = "doc_id", hints: bool = False) -> str:
    """Text-layer metrics per document, or per other keys, from lines in rows: one aggregate, with the hints of the profile
    if they are wanted."""
    counts = [f"{tally(getattr(d, how)('line', p))} AS {k}_lines" for k, (how, p) in LINE_COUNTS.items()] + [f"{tally(getattr(d, how)('line', p))} AS {k}" for k, (how, p) in HINTS.items() if hints]
    return with_(
        {"joined": f"SELECT {keys}, {d.join_in_order('line', 'line_no')} AS full_text, CAST(sum(length(line)) AS BIGINT) AS char_count, count(*) AS line_count, {', '.join(counts)}, {tally(f'length(line) <= {SHORT_LINE}')} AS short_lines FROM {lines} GROUP BY {keys}"},
        _signals(d),
    )


def array_metrics(d: Dialect, arrays: str, hints: bool = False) -> str:
    """The same from one row per document with its lines as an array: no row is exploded, and nothing is shuffled."""
    one = lambda how, p: d.tally_in("lines", "x", getattr(d, how)("x", p))
    counts = [f"{one(how, p)} AS {k}_lines" for k, (how, p) in LINE_COUNTS.items()] + [f"{one(how, p)} AS {k}" for k, (how, p) in HINTS.items() if hints]
    return with_(
        {
            "flat": d.pin(f"({arrays}) a", full_text=d.joined("lines", "\n"), line_count=d.size("lines")),
            "joined": f"SELECT doc_id, source, full_text, CAST(length(full_text) - line_count + 1 AS BIGINT) AS char_count, line_count, {', '.join(counts)}, {d.tally_in('lines', 'x', f'length(x) <= {SHORT_LINE}')} AS short_lines FROM flat",
        },
        _signals(d),
    )


def watermark(d: Dialect) -> str:
    """Reason why a text holds no more than a watermark, or ''; the first that applies."""
    entity = f"({d.search('full_text', Profile.STANDARD_ENTITY_RE)} OR {d.search('full_text', Profile.NUMERIC_PARAM_RE)} OR {d.search('full_text', Profile.SECTION_NUM_RE)})"
    return f"""CASE WHEN full_text = '' THEN ''
      WHEN {d.only('length(full_text) < 300', f"{d.search('full_text', Profile.WATERMARK_URL_RE)} AND length(full_text) < 300")} THEN 'watermark_url_short_body'
      WHEN {d.search('full_text', Profile.WATERMARK_KEYWORDS_RE)} THEN 'watermark_keyword'
      WHEN advert_lines > 0 AND signals = 0 THEN 'advertisement_without_structure'
      WHEN content_lines > 0 AND front_lines >= greatest(2, content_lines - 1) AND signals = 0 THEN 'metadata_only'
      WHEN {d.only('length(full_text) < 220', f'NOT {entity} AND length(full_text) < 220 AND content_lines <= 4')} THEN 'no_structural_entities' ELSE '' END"""


def gate() -> dict[str, str]:
    """The OCR gate over rows with metrics and watermark: named reasons, one page per document."""
    floor = f"greatest({CHAR_FLOOR}, pages * {FLOOR_PER_PAGE})"
    return {
        "low_text_chars": f"char_count < {floor}",
        "watermark_only": "watermark <> ''",
        "advertisement_without_structure": "advert_lines >= 0.25 * greatest(1, content_lines) AND signals = 0",
        "metadata_heavy_low_structure": f"signals <= 1 AND front_lines >= 0.6 * greatest(1, content_lines) AND char_count < greatest(4 * {floor}, pages * 160)",
    }


#: What a language is told by.
LANGUAGES = {"zh": Rx("[一-鿿]"), "en": Profile.ENGLISH_HINT_RE, "de": Profile.GERMAN_HINT_RE}


def language(d: Dialect, text: str, counted: bool = False) -> str:
    """The language of a text; the counts of its hints may be columns."""
    zh, en, de = LANGUAGES if counted else (d.count(text, p) for p in LANGUAGES.values())
    return f"CASE WHEN {zh} >= 30 THEN 'zh' WHEN {de} >= {en} AND {de} >= 3 THEN 'de' WHEN {en} >= 3 THEN 'en' WHEN {d.search(text, Rx('[äöüßÄÖÜ]'))} THEN 'de' ELSE 'unknown' END"


def profiled(d: Dialect, measured: str, tables: str = "0", pages: str = "1") -> str:
    """Document profile from metrics with hints: language, OCR gate, layout, document type and confidence (in hundredths)."""
    reasons = gate()
    counts = {"counted": d.pin("metric", **{k: d.count("full_text", p) for k, p in LANGUAGES.items()})} if d.name == "spark" else {}
    n_models = d.size(d.distinct(f"filter({d.extract_all('full_text', Profile.MODEL_RE)}, x -> length(x) >= 4)" if d.name == "spark" else f"[x FOR x IN {d.extract_all('full_text', Profile.MODEL_RE)} IF length(x) >= 4]"))
    kind = """CASE WHEN standards >= 4 OR parts >= 1 OR numbered >= 3 THEN 'standard'
      WHEN (product_hints >= 2 AND tables >= 2 AND models >= 1) OR (product_hints >= 4 AND tables >= 1) OR (models >= 8 AND tables >= 1) THEN 'product_catalog'
      WHEN manual_hints >= 4 THEN 'manual' WHEN report_hints >= 3 THEN 'report' ELSE 'unknown' END"""
    score = """CASE doc_type WHEN 'standard' THEN 58 + standards * 1.5 + parts * 8 + least(12, numbered) WHEN 'product_catalog' THEN 55 + product_hints * 3 + least(18, models)
      WHEN 'manual' THEN 52 + manual_hints * 4 WHEN 'report' THEN 52 + report_hints * 5 ELSE 28 + standards + product_hints * 2 END"""
    layout = """CASE WHEN needs_ocr THEN 'scan_like' WHEN line_count = 0 THEN 'single_column' WHEN tables >= 4 AND short_lines >= 0.35 * line_count THEN 'dense_table'
      WHEN tables >= 2 THEN 'table_driven' WHEN short_lines >= 0.55 * line_count THEN 'fragmented' ELSE 'single_column' END"""
    return with_(
        {
            "metric": f"SELECT *, CAST({pages} AS BIGINT) AS pages, CAST({tables} AS BIGINT) AS tables FROM ({measured}) m",
            **counts,
            "marked": d.pin("counted" if counts else "metric", watermark=watermark(d), standards=d.count("full_text", Profile.STANDARD_RE), models=n_models, language=language(d, "full_text", bool(counts))),
            "gated": f"SELECT *, {' OR '.join(f'({v})' for v in reasons.values())} AS needs_ocr, {kind} AS doc_type FROM marked",
        },
        f"SELECT doc_id, language, doc_type, CAST(floor(least(98, greatest(0, {score})) + 0.5) AS BIGINT) AS confidence_pct, needs_ocr, {layout} AS layout, line_count, char_count, signals, standards, models FROM gated",
    )


@query
def c01_normalised_lines(d):
    return f"SELECT doc_id, line_no, CAST(length(line) AS BIGINT) AS n_chars, CAST({d.words('line')} AS BIGINT) AS n_words, line FROM ({doc_lines(d)}) l"


@query
def c05_clip(d):
    return f"SELECT doc_id, line_no, CASE WHEN length(line) > 60 THEN concat(rtrim(left(line, 60)), '...') ELSE line END AS clipped FROM ({doc_lines(d)}) l"


@query
def c07_append_lines(d):
    """Body of a document without lines that repeat the line before."""
    return with_(
        {"l": doc_lines(d), "b": "SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM l"},
        f"SELECT doc_id, count(*) AS n_lines, {d.sha256(d.join_in_order('line', 'line_no'))} AS body_sha FROM b WHERE before IS NULL OR before <> line GROUP BY doc_id",
    )


@query
def c14_short_hash(d):
    return f"SELECT doc_id, left({d.sha256('text')}, 8) AS signature FROM documents WHERE text IS NOT NULL"


@query
def f01_header_noise(d):
    return with_({"l": spec_lines(d)}, f"SELECT doc_id, page_index, line_no, line FROM l WHERE {L.header_noise(d, 'line')}")


@query
def f02_repeated_noise(d):
    return repeated_noise(d, f"({doc_lines(d)}) l")


@query
def f01_clean_lines(d):
    return with_(
        {"l": doc_lines(d), "noise": repeated_noise(d, "l", "3")},
        f"SELECT l.doc_id, line_no, CAST(length(l.line) AS BIGINT) AS n_chars FROM l LEFT JOIN noise n ON l.source = n.source AND l.line = n.line WHERE n.line IS NULL AND NOT {L.header_noise(d, 'l.line')}",
    )


@query
def a01_text_metrics(d):
    quality = f"{d.count('full_text', Rx(Profile.VALID_CHAR_RE.pattern))}"
    return with_({"m": array_metrics(d, doc_arrays(d))}, f"SELECT doc_id, char_count, line_count, content_lines, advert_lines, front_lines, short_lines, signals, {quality} AS valid_chars, {watermark(d)} AS watermark_reason FROM m")


@query
def a02_quality_ratio(d):
    valid = d.count("full_text", Rx(Profile.VALID_CHAR_RE.pattern))
    return with_({"m": array_metrics(d, doc_arrays(d))}, f"SELECT doc_id, round(CAST({valid} AS DOUBLE) / greatest(1, char_count), 6) AS quality_ratio FROM m")


@query
def a03_watermark(d):
    return with_({"m": array_metrics(d, doc_arrays(d)), "w": f"SELECT doc_id, {watermark(d)} AS reason FROM m"}, "SELECT reason, count(*) AS n_docs FROM w GROUP BY reason")


@query
def a04_ocr_gate(d):
    named = ", ".join(f"{v} AS {k}" for k, v in gate().items())
    return with_({"m": array_metrics(d, doc_arrays(d)), "w": f"SELECT *, 1 AS pages, {watermark(d)} AS watermark FROM m"}, f"SELECT doc_id, {named} FROM w")


@query
def a05_profile(d):
    return profiled(d, array_metrics(d, doc_arrays(d), hints=True))


@query
def a05_spec_profile(d):
    first = with_({"s": spec_lines(d)}, f"SELECT doc_id, {d.struct(p='page_index', l='line_no')} AS line_no, line FROM s WHERE page_index < 30")
    return profiled(d, metrics(d, f"({first}) l", hints=True), tables="4", pages="50")


@query
def a06_language(d):
    return with_({"l": doc_lines(d), "t": f"SELECT doc_id, {d.join_in_order('line', 'line_no')} AS t FROM l GROUP BY doc_id", "g": f"SELECT t.doc_id, {language(d, 't')} AS detected FROM t"}, "SELECT lang, detected, count(*) AS n_docs FROM g JOIN documents x ON g.doc_id = x.doc_id GROUP BY lang, detected")


@query
def a07_layout(d):
    return with_({"p": profiled(d, array_metrics(d, doc_arrays(d), hints=True))}, "SELECT layout, needs_ocr, count(*) AS n_docs FROM p GROUP BY layout, needs_ocr")


def ocr_evaluated(d: Dialect, lines: str) -> str:
    """OCR page evaluation of lines (doc_id, line_no, line): counts, ratios in thousandths, grade and inject flag."""
    share = lambda n, m: f"CAST(floor(1000.0 * {n} / greatest(1, {m}) + 0.5) AS BIGINT)"
    letters = d.count("line", Rx("[一-鿿A-Za-z]"))
    return with_(
        {
            "o1": f"SELECT doc_id, {d.join_in_order('line', 'line_no')} AS t, count(*) AS n_lines, CAST(count(DISTINCT line) AS BIGINT) AS n_distinct, {tally('length(line) <= 1')} AS single, {tally('length(line) < 6')} AS short, {tally(f'{letters} = 1')} AS one_letter, {tally(L.ocr_line_signal(d, 'line'))} AS sections FROM {lines} GROUP BY doc_id",
            "o2": f"SELECT *, CAST(length(t) AS BIGINT) AS text_length, {d.count('t', Ocr.CONTENT_CHAR_RE)} AS content_chars, {d.count('t', Rx(r'[^A-Za-z0-9_ÄÖÜäöüßàâçéèêëîïôûùüÿñáíóúÁÉÍÓÚÑÀÂÇÈÊËÎÏÔÛÙ一-鿿\s]'))} AS puncts, {d.count('t', Ocr.STANDARD_SIGNAL_RE)} AS standards, {d.count('t', Ocr.TABLE_SIGNAL_RE)} AS figures FROM o1",
            "o3": f"SELECT *, {share('puncts', 'text_length - n_lines + 1')} AS punct_m, {share('single', 'n_lines')} AS single_m, {share('(n_lines - n_distinct)', 'n_lines')} AS dup_m, {share('short', 'n_lines')} AS short_m, {share('one_letter', 'n_lines')} AS letter_m FROM o2",
            "o4": "SELECT *, short_m > 500 OR letter_m > 300 AS fragmented, punct_m <= 400 AND single_m <= 400 AND dup_m <= 350 AS good, sections + standards + figures > 0 AS strong FROM o3",
            "o5": "SELECT *, CASE WHEN content_chars < 12 THEN 0 WHEN content_chars >= 80 AND n_lines >= 4 AND good THEN 2 WHEN content_chars >= 36 AND strong AND single_m <= 600 THEN 1 WHEN content_chars >= 28 AND good AND n_lines >= 3 THEN 1 ELSE 0 END AS level FROM o4",
        },
        "SELECT *, CASE greatest(0, level - CASE WHEN fragmented THEN 1 ELSE 0 END) WHEN 2 THEN '通过' WHEN 1 THEN '边缘' ELSE '拒绝' END AS grade FROM o5",
    )


@query
def a08_ocr_evaluation(d):
    return with_({"l": doc_lines(d), "o": ocr_evaluated(d, "l")}, "SELECT doc_id, n_lines, text_length, content_chars, sections, standards, figures, single_m, dup_m, short_m, letter_m, grade, grade <> '拒绝' AS inject FROM o")


@query
def a08f_ocr_batch(d):
    accepted = tally("grade <> '拒绝'")
    return with_(
        {"l": doc_lines(d), "o": ocr_evaluated(d, "l")},
        f"SELECT source, count(*) AS target_pages, {tally("grade = '通过'")} AS passed, {tally("grade = '边缘'")} AS marginal, {tally("grade = '拒绝'")} AS rejected, CASE WHEN {accepted} = 0 THEN '失败' WHEN {accepted} = count(*) THEN '成功' ELSE '部分成功' END AS conclusion FROM o JOIN documents x ON o.doc_id = x.doc_id GROUP BY source",
    )


@query
def f29_f30_script_tests(d):
    x = "line"
    return f"SELECT doc_id, line_no, {d.search(x, Local.CJK_RE)} AS has_cjk, ({d.search(x, Local.LATIN_RE)} AND NOT {d.search(x, Local.CJK_RE)}) AS is_foreign FROM ({doc_lines(d)}) l"


@query
def n08_translation(d):
    """The first phrase of the translation table found in a line."""
    return f"SELECT * FROM (SELECT doc_id, page_index, line_no, {d.first_of('line', Local.TRANSLATION_PATTERNS)} AS translated FROM ({spec_lines(d)}) l) t WHERE translated <> ''"


@query
def n09_display(d):
    first = d.first_of("line", Local.TRANSLATION_PATTERNS)
    return with_(
        {"t": f"SELECT doc_id, page_index, line_no, line, {first} AS translated FROM ({spec_lines(d)}) l"},
        "SELECT doc_id, page_index, line_no, CASE WHEN translated <> '' THEN concat(translated, '（原文：', line, '）') ELSE concat('原文：', line) END AS shown FROM t",
    )


@query
def n13_fallback_counts(d):
    first = d.first_of("line", Local.TRANSLATION_PATTERNS)
    return with_({"t": f"SELECT DISTINCT line_no, line FROM (SELECT line_no, line, {first} AS translated FROM ({spec_lines(d)}) l) x WHERE translated = ''"}, "SELECT line_no AS kind, count(*) AS n_texts FROM t GROUP BY line_no")


@query
def x13_rules(d):
    kind = d.first_of("line", Parser.RULE_PATTERNS)
    return with_(
        {"l": spec_lines(d), "r": f"SELECT doc_id, page_index, line_no, line, {kind} AS rule_type FROM l", "n": "SELECT *, row_number() OVER (PARTITION BY doc_id, rule_type, line ORDER BY page_index, line_no) AS k FROM r WHERE rule_type <> ''"},
        "SELECT doc_id, rule_type, line, page_index, concat('rule-', CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_index, line_no) AS VARCHAR(20))) AS rule_id FROM n WHERE k = 1",
    )


@query
def x14_inspections(d):
    """Lines with an inspection hint, of documents as given."""
    return f"SELECT doc_id, line_no, line FROM ({doc_lines(d)}) l WHERE {d.search('line', Parser.INSPECTION_HINT_RE)}"
