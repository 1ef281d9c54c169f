"""Line predicates as SQL expressions: each takes a dialect and the name of a column with a normalised line.

They are kept small on purpose: plans put them into boolean columns tier by tier, so that no projection outgrows what the
JVM compiles, and a predicate used by several rules is worked out once.
"""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.patterns import Ocr, Parser, Rx

#: Exact lines that are no headings, fragments of notices, header and footer lines, word limit of headings.
BANNED_HEADINGS = ("mm", "bar", "%", "°C", "DN", "kg", "x", "X", "a", "b", "c", "d", "e", "f", "g", "h", "图 1", "图 2", "图 3", "表 1", "表 2", "表 3")
NOTICE_FRAGMENTS = (
    "The reproduction, distribution and utilization of this document",
    "All rights reserved in case of patent/utility model/trademark protection.",
    "未经书面许可不得复制",
    "如有疑问，一概以最新德文本为准",
    "This document remains the property of",
)
HEADER_FOOTER = (
    Rx(r"^\d+\s*/\s*\d+$"),
    Rx(r"^第\s*\d+\s*页$"),
    Rx(r"^Page\s+\d+$"),
    Rx(r"^Page\s+\d+\s+of\s+\d+$"),
    Rx(r"^Seite\s+\d+$"),
    Rx(r"^Seite\s+\d+\s*[:\-]\s*.*$"),
    Rx(r"^\d{4}[-/]\d{2}$"),
    Rx(r"^[A-Z]{1,5}\s+\d+(?:[-/]\d+)?\s*(?:Teil|Part)?\s*\d*$"),
)
LONG_NOISE = Rx(r"SN\s*200|第\s*\d+\s*页|2007\s*年\s*\d+\s*月")
MAX_HEADING_WORDS = 14
SKIPPED_ANYWHERE = (Parser.LEGAL_NOTICE_RE, Parser.BOILERPLATE_FRAGMENT_RE, Parser.ADVERTISEMENT_NOISE_RE, Parser.CORPORATE_NOTICE_RE)
SKIPPED_WHOLE = (Parser.PAGE_HEADER_NOISE_RE, Parser.FOOTNOTE_CONTINUE_RE, Parser.DOC_VERSION_RE, Parser.ICS_RE)
SKIPPED_BEGIN = (Parser.METADATA_PREFIX_RE, Parser.METADATA_LABEL_RE, Parser.TOTAL_PAGES_RE, Parser.EDITION_HEADER_RE)


def any_of(tests: list[str]) -> str:
    return "(" + " OR ".join(tests) + ")"


def header_noise(d: Dialect, x: str) -> str:
    return any_of([*(f"contains({x}, {d.lit(f)})" for f in NOTICE_FRAGMENTS), *(d.search(x, p) for p in HEADER_FOOTER)])


def part_heading(d: Dialect, x: str) -> str:
    return d.match(x, Parser.PART_HEADING_RE)


def toc_line(d: Dialect, x: str) -> str:
    return any_of(
        [
            d.only(f"(contains({x}, '.....') OR contains({x}, '…'))", d.search(x, Parser.TOC_LINE_RE)),
            d.only(f"length({x}) <= 8", d.one_of(f"lower({x})", ("contents", "inhalt", "目录"))),
            f"({d.search(x, Parser.TOC_HEADER_RE)} AND {d.search(x, Rx('[0-9]'))})",
            d.only(f"lower(right({x}, 9)) = ' contents'", f"right(lower({x}), 9) = ' contents'"),
            d.only(f"lower(right({x}, 7)) = ' inhalt'", f"right(lower({x}), 7) = ' inhalt'"),
        ]
    )


def metadata_line(d: Dialect, x: str) -> str:
    return any_of([d.search(x, Parser.METADATA_PARAM_RE), d.search(x, Parser.DATE_LIKE_RE)])


def spec_dense(d: Dialect, x: str) -> str:
    """A line that reads like recognised data: many digits with size tokens, or sentence cues among digits."""
    digits, specs = d.count(x, Rx(r"[0-9²³¹]")), d.count(x, Parser.SPEC_TOKEN_RE)
    cue = d.search(x, Parser.SENTENCE_DATA_CUE_RE)
    # the glued-number pattern looks ahead for an ideograph; it is spelled as a match that ends in one
    glue = Rx(Parser.LEADING_NUMERIC_CJK_GLUE_RE.pattern.replace("(?=[一-鿿])", "[一-鿿]"))
    return any_of(
        [
            d.match(x, glue),
            f"(length({x}) >= 12 AND {d.search(x, Parser.SENTENCE_HEADING_CUE_RE)} AND ({cue} OR {digits} > 0))",
            f"({digits} >= 4 AND {specs} >= 1)",
            f"({digits} >= 5 AND {cue})",
            f"(length({x}) >= 18 AND {cue} AND {digits} >= 2)",
            f"(length({x}) - length(replace({x}, ' ', '')) <= 1 AND {specs} >= 2)",
        ]
    )


def uneven_brackets(x: str) -> str:
    return f"length(replace({x}, '(', '')) <> length(replace({x}, ')', ''))"


def heading_fragment(d: Dialect, x: str, metadata: str, dense: str) -> str:
    """Pieces that are no heading; `metadata` and `dense` name the columns with those two tests."""
    whole = (Parser.SECTION_NUMBER_ONLY_RE, Parser.SHORT_TOKEN_RE, Parser.LETTER_RANGE_RE, Parser.VALUE_FRAGMENT_RE)
    return any_of(
        [
            metadata,
            dense,
            d.search(x, Parser.ADVERTISEMENT_NOISE_RE),
            d.starts(x, "(", "+", "-", "≤", "≥"),
            d.ends(x, "-", "/"),
            d.match(x, Parser.LEADING_CONJUNCTION_RE),
            d.match(x, Parser.LOWERCASE_FRAGMENT_RE),
            *(d.full(x, p) for p in whole),
            f"({d.search(x, Parser.SENTENCE_VERB_RE)} AND {d.words(x)} >= 3)",
            f"({d.ends(x, '.', ',', ';')} AND {d.words(x)} >= 2)",
            uneven_brackets(x),
        ]
    )


def table_fragment(d: Dialect, x: str, in_cell: str = "false") -> str:
    """Pieces of tables; `in_cell` names the column that tells whether the line equals a cell of its page."""
    whole = (Parser.FOOTNOTE_CONTINUE_RE, Parser.SHORT_TOKEN_RE, Parser.LETTER_RANGE_RE, Parser.VALUE_FRAGMENT_RE, Parser.FOOTNOTE_MARKER_RE, Parser.TABLE_HEADER_FRAGMENT_RE, Parser.HEADER_TOKEN_FRAGMENT_RE, Parser.HEADER_VALUE_RE)
    return any_of(
        [
            f"({in_cell} AND length({x}) <= 120)",
            d.match(x, Parser.NOISE_MARKER_RE),
            *(d.full(x, p) for p in whole),
            d.ends(x, "-", "/"),
            d.match(x, Parser.LEADING_CONJUNCTION_RE),
            f"({d.search(x, Parser.SENTENCE_VERB_RE)} AND {d.words(x)} >= 3)",
            d.only(f"length({x}) <= 40", f"({d.match(x, Parser.LOWERCASE_FRAGMENT_RE)} AND length({x}) <= 40 AND {d.words(x)} <= 5)"),
            d.match(x, Rx(r"\d+(?:\s+\d+){2,}$")),
            d.only(f"length({x}) <= 40", f"({d.count(x, Rx('[0-9]'))} >= 3 AND length({x}) <= 40 AND NOT {d.search(x, Parser.SCAN_TEXT_RE)})"),
            d.only(f"contains({x}, 'DN')", f"({d.search(x, Rx(r'\bDN\b'))} AND {d.words(x)} >= 3)"),
        ]
    )


def standard_line(d: Dialect, x: str) -> str:
    return d.only(f"length({x}) <= 180", f"({d.search(x, Parser.STANDARD_RE)} AND NOT {d.match(x, Parser.NUMBERED_HEADING_RE)} AND length({x}) <= 180)")


def caption(d: Dialect, x: str) -> str:
    return any_of([d.match(x, Parser.TABLE_CAPTION_RE), d.match(x, Parser.FIGURE_CAPTION_RE), d.match(x, Rx(r"(?:Legend|Symbol|图例|符号|说明)\b", True))])


def skipped(d: Dialect, x: str) -> str:
    return any_of([f"{x} = ''", *(d.search(x, p) for p in SKIPPED_ANYWHERE), *(d.full(x, p) for p in SKIPPED_WHOLE), *(d.match(x, p) for p in SKIPPED_BEGIN), toc_line(d, x)])


def number_noise(d: Dialect, number: str, title: str) -> str:
    """Numbers that look like table data rather than section numbers."""
    return any_of(
        [
            d.full(number, Rx(r"\d{1,2}(?:\.\d{1,2}){2,}")),
            d.full(number, Rx(r"[1-9]\d+\.0")),
            d.full(number, Rx(r"\d{4,}")),
            d.full(number, Parser.FOOTNOTE_MARKER_RE),
            d.search(title, Rx(r"\bM\d{2,3}[Xx×][\d.]+")),
            f"{number} = '0'",
            d.full(title, Rx("[*·•●■◆]*")),
        ]
    )


def heading_barred(d: Dialect, x: str) -> str:
    """Rejections of a heading candidate by its text alone, besides the fragment tests."""
    return any_of(
        [
            f"{x} = ''",
            f"length({x}) > 100",
            d.one_of(x, BANNED_HEADINGS),
            d.match(x, Parser.GENERIC_NOISE_HEADING_RE),
            d.full(x, Parser.PAGE_HEADER_NOISE_RE),
            d.match(x, Parser.NOISE_MARKER_RE),
            d.full(x, Parser.DOC_VERSION_RE),
            d.full(x, Parser.ICS_RE),
            d.search(x, Parser.CORPORATE_NOTICE_RE),
            d.full(x, Parser.FOOTNOTE_CONTINUE_RE),
            standard_line(d, x),
        ]
    )


def ocr_fragment_heading(d: Dialect, x: str) -> str:
    """Recognised pieces that are no heading: units, letter markers, trailing ideographic punctuation, function characters,
    very short or letterless pieces, uneven brackets."""
    compact = f"replace({x}, ' ', '')"
    return any_of(
        [
            d.full(x, Parser.UNIT_ONLY_FRAGMENT_RE),
            d.full(x, Parser.LETTER_MARKER_RE),
            d.ends(x, "。", "，", "；", "：", "．"),
            d.search(x, Rx("[的是为被及与和或]")),
            f"(length({compact}) < 4 AND NOT {d.full(compact, Rx('[一-鿿]{2,3}'))})",
            f"({x} <> '' AND NOT {d.search(x, Rx('[一-鿿A-Za-z]'))})",
            uneven_brackets(x),
        ]
    )


def in_pieces_heading(d: Dialect, x: str) -> str:
    """Headings that a recognised page in pieces does not have: very short ones that no standard section is called."""
    compact = f"replace({x}, ' ', '')"
    return f"(length({compact}) <= 6 AND NOT {d.full(compact, Parser.COMMON_SHORT_CJK_HEADING_RE)} AND NOT {d.search(x, Parser.GENERIC_SHORT_HEADING_RE)})"


def without_prefix(d: Dialect, x: str) -> str:
    """A heading without the date or number that recognition puts before some of them."""
    one, two = (d.extract(x, p, 1) for p in (Parser.DATE_PREFIX_HEADING_RE, Parser.NUMERIC_PREFIX_HEADING_RE))
    return f"CASE WHEN {one} <> '' THEN {one} WHEN {two} <> '' THEN {two} ELSE {x} END"


def inspection_method(d: Dialect, x: str) -> str:
    """The method of an inspection by the first word of the table that it holds."""
    return "CASE " + " ".join(f"WHEN contains(lower({x}), {d.lit(word)}) THEN {d.lit(method)}" for word, method in Parser.INSPECTION_METHODS) + " ELSE '检验' END"


def ocr_line_signal(d: Dialect, x: str) -> str:
    return d.search(x, Ocr.SECTION_SIGNAL_RE)
