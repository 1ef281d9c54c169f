"""Queries that extract numeric parameters from lines and table rows, and canonical standard codes."""

from __future__ import annotations

from stratafold.functions.dialect import Dialect
from stratafold.functions.lines import any_of, metadata_line
from stratafold.functions.patterns import Guard, Parser, Rx
from stratafold.plans.corpora import spec_cells, spec_lines
from stratafold.plans.registry import query, with_

#: Canonical names by word, in order; units by spelling; blacklisted candidates.
NAMES = (
    (Rx(r"\b(weight|gewicht)\b"), "重量"),
    (Rx(r"\b(length|länge|laenge)\b"), "长度"),
    (Rx(r"\b(width|breite)\b"), "宽度"),
    (Rx(r"\b(height|höhe|hoehe)\b"), "高度"),
    (Rx(r"\b(diameter|durchmesser|dn|d\d+)\b"), None),
    (Rx(r"\b(radius|halbmesser|r)\b"), "半径"),
    (Rx(r"\b(thickness|wanddicke|wall thickness|厚度|壁厚)\b"), "厚度"),
    (Rx(r"\b(pressure|druck)\b"), "压力"),
    (Rx(r"\b(temperature|temperatur)\b"), "温度"),
    (Rx(r"\b(tolerance|abweichung)\b"), "公差"),
    (Rx(r"\b(roughness|ra|rz)\b"), "粗糙度"),
    (Rx(r"\b(angle|winkel)\b"), "角度"),
)
UNITS = {"um": "μm", "μm": "μm", "°c": "℃", "n/mm²": "N/mm2", "n/mm2": "N/mm2", "kn/m2": "kN/m2"}
BLACKLIST = (
    Rx(r"\d{4}[-—/.]\d{1,2}[-—/.]{1,2}\d{1,2}(?:\s*[发实施布]+)?"),
    Rx(r"(?:DIN|EN|ISO|IEC|JIS|ASTM|SN|SEW|DVS|AD|TRbF|GB|CB|CH|JB|YB|HG|QC|LY|BB|MT|SH|SY|DL|JJG|JJF)(?:/[TZ])?\s*\d+[-—–─.]\d+"),
    Rx(r"(?:分类号|U|ICS)\s*[:：]?\s*[A-Z]?\d+(?:\.\d+)*"),
    Rx(r"代替.+"),
)
GLUED = Rx(Parser.LEADING_NUMERIC_CJK_GLUE_RE.pattern.replace("(?=[一-鿿])", "[一-鿿]"))


def name_of(d: Dialect, x: str, context: str, always: bool = False) -> str:
    """The canonical name of a label in its context: the label itself where none is known, '' where that is too long to be a
    name, unless it is to be taken always."""
    source = f"lower(concat({x}, ' ', {context}))"
    cases = " ".join(f"WHEN {d.search(source, rx)} THEN {d.lit(v) if v else x}" for rx, v in NAMES)
    return f"CASE {cases} ELSE {x} END" if always else f"CASE {cases} WHEN length({x}) <= 40 THEN {x} ELSE '' END"


def unit_of(d: Dialect, x: str) -> str:
    plain = f"replace({x}, 'µ', 'μ')"
    return f"CASE lower({plain}) " + " ".join(f"WHEN {d.lit(k)} THEN {d.lit(v)}" for k, v in UNITS.items()) + f" ELSE {plain} END"


def banned(d: Dialect, x: str) -> str:
    return any_of([metadata_line(d, x), d.search(x, Parser.STANDARD_RE)])


def value_like(d: Dialect, x: str) -> str:
    whole = [f"{d.extract(x, p)} = {x}" for p in (Parser.RANGE_RE, Parser.COMPARE_RE)] + [d.full(x, p) for p in (Parser.DIMENSION_VALUE_RE, Parser.PURE_NUMERIC_VALUE_RE)]
    return f"({x} <> '' AND NOT {banned(d, x)} AND {any_of(whole)})"


def rejected(d: Dialect, name: str, value: str, merged: str, value_ok: str) -> str:
    """Candidates that are no parameter; merged is name, value and context in one text."""
    specs = d.count(merged, Parser.SPEC_TOKEN_RE)
    return any_of(
        [
            f"{merged} = ''",
            *(d.full(x, p) for x in (name, value, merged) for p in BLACKLIST),
            d.search(merged, Parser.FRONT_MATTER_CUE_RE),
            d.search(merged, Parser.FRONT_MATTER_SECTION_RE),
            banned(d, name),
            f"({name} <> '' AND NOT {d.search(name, Rx('[A-Za-z一-鿿]'))})",
            d.match(name, GLUED),
            d.match(value, GLUED),
            d.full(name, Parser.CODE_LIKE_VALUE_RE),
            d.full(value, Parser.CODE_LIKE_VALUE_RE),
            f"({specs} >= 2 AND NOT {d.search(merged, Parser.RANGE_RE)} AND NOT {d.search(merged, Parser.COMPARE_RE)} AND NOT {value_ok})",
            f"(length({merged}) >= 20 AND {d.search(merged, Parser.SENTENCE_DATA_CUE_RE)} AND {specs} >= 1 AND NOT contains({merged}, ':') AND NOT contains({merged}, '：'))",
            f"(length({merged}) <= 6 AND NOT {d.search(merged, Rx('[0-9]'))})",
        ]
    )


def made(d: Dialect, rows: str, keys: str, hint: str = "''") -> dict[str, str]:
    """Parameters from rows with name, value and context: range, comparison or plain number, with unit and bounds."""
    rng = lambda g: d.extract("value", Parser.RANGE_RE, g)
    cmp_ = lambda g: d.extract("value", Parser.COMPARE_RE, g)
    dot = lambda x: f"replace({x}, ',', '.')"
    return {
        "p0": f"SELECT * FROM {rows} WHERE name <> '' AND value <> ''",
        "p1": d.pin("p0", merged=d.norm(f"concat(name, {d.lit(' ')}, value, {d.lit(' ')}, context)"), value_ok=value_like(d, "value")),
        "p2": d.pin("p1", refused=rejected(d, "name", "value", "merged", "value_ok")),
        "p3": d.pin("(SELECT * FROM p2 WHERE NOT refused) x", is_range=d.search("value", Parser.RANGE_RE), is_compare=d.search("value", Parser.COMPARE_RE), low=dot(rng(1)), high=dot(rng(2)), range_unit=rng(3), sign=cmp_(1), bound=dot(cmp_(2)), compare_unit=cmp_(3), seen_unit=d.extract("value", Parser.UNIT_TOKEN_RE), hint=hint),
        "p4": f"""SELECT {keys}, name, CASE WHEN is_range THEN concat(low, '~', high) WHEN is_compare THEN bound ELSE value END AS clean_value,
          CASE WHEN is_range THEN low ELSE '' END AS lower_bound, CASE WHEN is_range THEN high ELSE '' END AS upper_bound, CASE WHEN is_range THEN '范围' WHEN is_compare THEN sign ELSE '' END AS comparator,
          CASE WHEN is_range THEN CASE WHEN range_unit <> '' THEN range_unit ELSE hint END WHEN is_compare THEN CASE WHEN compare_unit <> '' THEN compare_unit ELSE hint END WHEN hint <> '' THEN hint ELSE seen_unit END AS raw_unit
          FROM p3 WHERE is_range OR is_compare OR {d.search('value', Rx('[0-9]'))}""",
        "params": f"SELECT {keys}, name, clean_value, lower_bound, upper_bound, comparator, {unit_of(d, 'raw_unit')} AS unit FROM p4",
    }


def text_candidates(d: Dialect, lines: str | None = None, keys: str = "doc_id, page_index", at: str = "line_no", around: str = "''", ref: str = "''") -> dict[str, str]:
    """(name, value) from lines: `label: value` first, else a range, else a comparison under a canonical name or the line
    before it. `lines` are in order of `at` within `keys`; around is the title and ref the reference of their section."""
    order = f"PARTITION BY {keys} ORDER BY {at}"
    right = d.norm("substr(line, cut + 1)")
    more = "" if lines is None else f", {ref} AS ref"
    twice = d.norm(f"concat(line, ' ', line, ' ', {around})")
    return {
        "spec": lines or spec_lines(d),
        # no value is without a digit, so the costly tests are left to lines that have one
        "l0": d.pin("spec", cut=d.colon("line"), digit=d.search("line", Rx(r"\d")), merged=twice),
        "l1": d.pin("l0", line_value=f"(digit AND {value_like(d, 'line')})", ranged=f"CASE WHEN digit THEN {d.extract('line', Parser.RANGE_RE)} ELSE '' END", compared=f"CASE WHEN digit THEN {d.extract('line', Parser.COMPARE_RE)} ELSE '' END"),
        "l2": d.pin("l1", label=f"CASE WHEN digit AND cut > 0 THEN {d.norm('left(line, greatest(cut - 1, 0))')} ELSE '' END", tail=f"CASE WHEN digit AND cut > 0 THEN {right} ELSE '' END", canon=f"CASE WHEN ranged <> '' OR compared <> '' THEN {name_of(d, 'line', around)} ELSE '' END"),
        "l3": d.pin("l2", labelled=f"(digit AND {value_like(d, 'tail')})", refused=f"CASE WHEN digit THEN length(line) > 160 OR {d.search('line', Parser.STANDARD_RE)} OR {rejected(d, 'line', 'line', 'merged', 'line_value')} ELSE true END"),
        "l4": f"SELECT *, coalesce(lag(line) OVER ({order}), '') AS prev, coalesce(lag(line_value) OVER ({order}), false) AS prev_value FROM l3",
        "l5": f"SELECT {keys}, {at}{more}, CASE WHEN labelled THEN label WHEN canon <> '' THEN canon WHEN prev <> '' AND length(prev) <= 40 AND NOT prev_value THEN prev ELSE '' END AS name, CASE WHEN labelled THEN tail WHEN ranged <> '' THEN ranged ELSE compared END AS value FROM l4 WHERE NOT refused AND (labelled OR ranged <> '' OR compared <> '')",
        "cand": f"SELECT *, concat(name, ' ', {'ref' if lines is not None else d.lit('')}) AS context FROM l5",
    }


@query
def f18_f20_value_tests(d):
    return with_(
        {"k": spec_cells(d)},
        f"SELECT doc_id, page_index, row_idx, value, {value_like(d, 'value')} AS is_value, {d.full('unit', Rx('(?:unit|einheit|单位|mm|cm|m|bar|kg|g)', True))} AS is_unit, {banned(d, 'value')} AS is_banned FROM k",
    )


@query
def f21_rejected_lines(d):
    return with_({"l": spec_lines(d), "v": f"SELECT *, {value_like(d, 'line')} AS ok FROM l"}, f"SELECT doc_id, page_index, line_no, {rejected(d, 'line', 'line', 'line', 'ok')} AS rejected FROM v")


@query
def x11_x12_text_parameters(d):
    return with_(text_candidates(d) | made(d, "cand", "doc_id, page_index, line_no"), "SELECT * FROM params")


def canonical(d: Dialect, x: str) -> str:
    g = lambda n: d.extract(x, Guard.STANDARD_CODE_TOKEN_RE, n)
    year = d.replace_all(g(4), Rx("[-—–_.一]+"), "-")
    long_year = f"CASE WHEN length({year}) = 2 THEN concat(CASE WHEN {year} >= '80' THEN '19' ELSE '20' END, {year}) ELSE {year} END"
    return f"CASE WHEN {d.search(x, Guard.STANDARD_CODE_TOKEN_RE)} THEN concat(upper({g(1)}), CASE WHEN {g(2)} <> '' THEN concat('/', upper({g(2)})) ELSE '' END, ' ', {g(3)}, '-', {long_year}) ELSE '' END"


@query
def n14_canonical_codes(d):
    return f"SELECT doc_id, page_index, line_no, {canonical(d, 'line')} AS code FROM ({spec_lines(d)}) l WHERE {d.search('line', Guard.STANDARD_CODE_TOKEN_RE)}"


@query
def n15_code_sets(d):
    tokens = d.rows("spec", d.extract_all("line", Guard.STANDARD_CODE_TOKEN_RE, 0), "token", "n", "doc_id, token")
    return with_({"spec": spec_lines(d), "t": tokens, "c": f"SELECT DISTINCT doc_id, {canonical(d, 'token')} AS code FROM t"}, "SELECT doc_id, count(*) AS n_codes, min(code) AS first_code FROM c GROUP BY doc_id")


@query
def n02_n04_names_and_units(d):
    return with_({"k": spec_cells(d)}, f"SELECT DISTINCT label, {name_of(d, 'label', d.lit(''))} AS name, {unit_of(d, 'unit')} AS unit FROM k")
