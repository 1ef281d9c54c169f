"""Expressions that Spark SQL and DuckDB spell differently, so that an operator is written once and planned by either.

Spark patterns carry (?U), which makes \\s, \\d, \\w and \\b follow Unicode; those of registered queries do not, as their SQL
knows these classes for ASCII only. Texts are assumed to be normalised lines, without
line breaks, where a pattern is anchored at the end.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

from stratafold.functions.patterns import Rx


#: What \\s and \\b stand for in patterns of ASCII. Java's own \\b looks at all letters, and its \\s takes in vertical tabs.
BLANKS = r" \t\n\f\r"
WORD_EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"


def ascii_classes(pattern: str) -> str:
    """A pattern whose \\b and \\s are of ASCII in Java; its \\w and \\d are anyway."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        one = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        at += len(one)
        if one == "\\s":
            one = BLANKS if inside else f"[{BLANKS}]"
        elif one == "\\S" and not inside:
            one = f"[^{BLANKS}]"
        elif one == "\\b" and not inside:
            one = WORD_EDGE
        elif one == "[" and not inside:
            inside = True
        elif one == "]" and inside and out[-1] not in ("[", "^"):
            inside = False
        out.append(one)
    return "".join(out)


#: Characters that Java takes for these letters where case is folded.
ALSO = {"i": "\u0130\u0131", "s": "\u017f", "k": "\u212a"}
CLASSES = {"CATEGORY_DIGIT": [(48, 57)], "CATEGORY_WORD": [(48, 57), (65, 90), (95, 95), (97, 122)], "CATEGORY_SPACE": [(9, 10), (12, 13), (32, 32)]}


def begins(items) -> tuple[list[tuple[int, int]], bool] | None:
    """(ranges, always): the characters with which a match of parsed items can begin, and whether it takes one at all; None if
    that is not known. Lookarounds count for nothing, so that there may be more characters than needed, never fewer."""
    found: list[tuple[int, int]] = []
    for op, arg in items:
        kind = str(op)
        if kind in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        if kind == "LITERAL":
            return [*found, (arg, arg)], True
        if kind == "IN":
            for o, a in arg:
                if str(o) not in ("LITERAL", "RANGE", "CATEGORY") or str(o) == "CATEGORY" and str(a) not in CLASSES:
                    return None
                found += [(a, a)] if str(o) == "LITERAL" else [a] if str(o) == "RANGE" else CLASSES[str(a)]
            return found, True
        if kind == "BRANCH":
            parts = [begins(x) for x in arg[1]]
        elif kind == "SUBPATTERN" and not arg[1] and not arg[2]:
            parts = [begins(arg[3])]
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            parts = [begins(arg[2])]
        else:
            return None
        if None in parts:
            return None
        found += [r for p in parts for r in p[0]]
        if all(p[1] for p in parts) and not (kind.endswith("REPEAT") and arg[0] == 0):
            return found, True
    return found, False


@cache
def guarded(pattern: str, ignore_case: bool) -> tuple[str, str]:
    """(guard, pattern): a lookahead for the characters with which a match of an ASCII pattern can begin, where it begins with a
    word's edge or alternatives. Java would try each of these at every place of a line. What is found stays the same: the
    guard lets through all that the pattern does, and before a word character an edge is where none stands before it. A pattern
    that Python's parser does not know, such as one with \\p{L}, is left as it is."""
    try:
        items = list(re._parser.parse(pattern))
    except re.error:
        return "", pattern
    edge, known = pattern.startswith(r"\b"), begins(items)
    inner = items[1:] if edge else items
    while len(inner) and str(inner[0][0]) == "SUBPATTERN":
        inner = list(inner[0][1][3])
    if known is None or not known[1] or not (edge or inner and str(inner[0][0]) == "BRANCH") or "^" in pattern or "$" in pattern:
        return "", pattern
    ranges = known[0]
    if ignore_case:
        if any(b > 127 and chr(c) != chr(c).swapcase() for a, b in ranges for c in range(max(a, 128), min(b, 0x2E80) + 1)):
            if any(a <= ord(x) <= b for a, b in ranges for also in ALSO.values() for x in also):
                return "", pattern
            ranges = [*ranges, (128, 0xFFFF)]  # whatever else is folded to such a letter
        ascii_ = {chr(c) for a, b in ranges for c in range(a, min(b, 127) + 1)}
        ranges = ranges + [(ord(x), ord(x)) for c in ascii_ for x in (c.lower(), c.upper(), *ALSO.get(c.lower(), ""))]
    low = sorted({c for a, b in ranges for c in range(a, min(b, 127) + 1)})
    high = [r for r in ranges if r[1] > 127]
    word = not high and all(chr(c).isalnum() or c == 95 for c in low)
    if len(low) > 62:
        return "", pattern
    guard = "(?=[" + "".join(rf"\x{c:02x}" for c in low) + (rf"\x{{{max(128, min(a for a, _ in high)):x}}}-\x{{{max(b for _, b in high):x}}}" if high else "") + "])"
    return guard, rf"(?<!\w){pattern[2:]}" if edge and word else pattern


class Dialect:
    name = ""

    #: First columns of a step that several others read. The column is read by none of them; it keeps Spark, which plans a
    #: step anew for each of its readers, to one plan: a step that draws at random is carried out once, behind an exchange
    #: that all of its readers share.
    once = ""

    def apart(self, *tables: str) -> str:
        """For the first place after SELECT: tables that grow with the input and are joined by shuffles. Spark takes their
        size from the files, not from the rows that are made of them, and would send them through the driver."""
        return ""

    def dealt(self, table: str, rows: int, *by: str) -> str:
        """For the first place after SELECT: rows are dealt out by columns, to one task for so many rows of a table. Spark
        would choose by the packed bytes of the rows, of which the windows that follow hold many times as much."""
        return ""

    def once_each(self, table: str, keep: str, **columns: str) -> str:
        """Columns `keep` of a table and more that are worked out once for each row, however many conditions or elements of
        arrays ask for them later."""
        return f"SELECT {keep}, {', '.join(f'{v} AS {k}' for k, v in columns.items())} FROM {table}"

    def only(self, when: str, test: str) -> str:
        """A test that nobody asks for where `when` does not hold, or that `when` follows from: there Spark says false without
        working it out. DuckDB works it out everywhere."""
        return test

    def lit(self, text: str) -> str:
        raise NotImplementedError

    def rx(self, rx: Rx | str, before: str = "", after: str = "") -> str:
        raise NotImplementedError

    def found(self, x: str, pattern: str) -> str:
        raise NotImplementedError

    def search(self, x: str, rx: Rx | str) -> str:
        """True if the pattern occurs in x."""
        return self.found(x, self.rx(rx))

    def match(self, x: str, rx: Rx | str) -> str:
        """True if x begins with the pattern."""
        return self.found(x, self.rx(rx, "^(?:", ")"))

    def full(self, x: str, rx: Rx | str) -> str:
        """True if all of x is the pattern."""
        return self.found(x, self.rx(rx, "^(?:", ")$"))

    def words(self, x: str) -> str:
        """Words of a normalised text."""
        return f"(CASE WHEN {x} = '' THEN 0 ELSE length({x}) - length(replace({x}, ' ', '')) + 1 END)"

    def ends(self, x: str, *ends: str) -> str:
        return f"right({x}, 1) IN ({', '.join(self.lit(e) for e in ends)})"

    def starts(self, x: str, *starts: str) -> str:
        return f"left({x}, 1) IN ({', '.join(self.lit(e) for e in starts)})"

    def one_of(self, x: str, values) -> str:
        return f"{x} IN ({', '.join(self.lit(v) for v in values)})"

    def colon(self, x: str) -> str:
        """Place of the first colon, half or full width; 0 if there is none."""
        return f"position(':' IN replace({x}, '：', ':'))"

    def each(self, array: str, value: Callable[[str, str], str], x: str = "x", i: str = "i") -> str:
        """`value` of every element of an array; value gets the names of the element and of its index from 0."""
        raise NotImplementedError

    def kept(self, array: str, test: Callable[[str, str], str], x: str = "x", i: str = "i") -> str:
        """The elements of an array that pass a test of the element and its index from 0."""
        raise NotImplementedError

    def first_kept(self, array: str, test: Callable[[str, str], str], x: str = "x", i: str = "i") -> str:
        return self.get(self.kept(array, test, x, i), "0")

    def any_kept(self, array: str, test: Callable[[str, str], str], x: str = "x", i: str = "i") -> str:
        return f"{self.size(self.kept(array, test, x, i))} > 0"

    def first_of(self, x: str, table, default: str = "''", how: str = "search") -> str:
        """The value of the first row (pattern, value) of a table whose pattern is found in x."""
        return "CASE " + " ".join(f"WHEN {getattr(self, how)(x, rx)} THEN {self.lit(v)}" for rx, v in table) + f" ELSE {default} END"


class Spark(Dialect):
    name = "spark"
    once = "rand(7) AS once, "

    def apart(self, *tables: str) -> str:
        return f"/*+ MERGE({', '.join(tables)}) */ "

    def only(self, when: str, test: str) -> str:
        return f"CASE WHEN {when} THEN {test} ELSE false END"

    def dealt(self, table: str, rows: int, *by: str) -> str:
        return f"/*+ REPARTITION(TASKS[{table}, {rows}], {', '.join(by)}) */ "

    def lit(self, text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t") + "'"

    def rx(self, rx: Rx | str, before: str = "", after: str = "") -> str:
        rx = Rx(rx) if isinstance(rx, str) else rx
        return self.lit(f"(?U{'i' * rx.ignore_case})" + before + rx.pattern + after)

    def found(self, x: str, pattern: str) -> str:
        return f"{x} RLIKE {pattern}"

    def count(self, x: str, rx: Rx | str) -> str:
        digits = re.fullmatch(r"\[0-9([²³¹]*)\]", rx if isinstance(rx, str) else rx.pattern)
        if digits:  # regexp_count makes a list of all matches
            return f"CAST(length({x}) - length(translate({x}, {self.lit('0123456789' + digits[1])}, '')) AS BIGINT)"
        return f"CAST(regexp_count({x}, {self.rx(rx)}) AS BIGINT)"

    def extract(self, x: str, rx: Rx | str, group: int = 0) -> str:
        return f"regexp_extract({x}, {self.rx(rx)}, {group})"

    def extract_all(self, x: str, rx: Rx | str, group: int = 0) -> str:
        return f"regexp_extract_all({x}, {self.rx(rx)}, {group})"

    def replace_all(self, x: str, rx: Rx | str, by: str = "") -> str:
        return f"regexp_replace({x}, {self.rx(rx)}, {self.lit(by)})"

    def norm(self, x: str) -> str:
        return f"trim(regexp_replace({x}, {self.lit('(?U)[' + chr(92) + 's' + chr(92) + 'x{1c}-' + chr(92) + 'x{1f}]+')}, ' '))"

    def rows(self, table: str, array: str, value: str, index: str = "", keep: str = "*") -> str:
        """A row per element of `array`; the index counts from 0."""
        call = f"LATERAL VIEW posexplode({array}) e AS {index}, {value}" if index else f"LATERAL VIEW explode({array}) e AS {value}"
        return f"SELECT {keep} FROM {table} {call}"

    def pin(self, table: str, **columns: str) -> str:
        """Add columns that are worked out once, where they stand: a one-row generator keeps the optimiser from copying
        them into every later condition."""
        return f"SELECT * FROM {table} LATERAL VIEW inline(array(struct({', '.join(columns.values())}))) pinned AS {', '.join(columns)}"

    def once_each(self, table: str, keep: str, **columns: str) -> str:
        """Pinned, as Spark would put the columns into the conditions on them and into every call of a lambda that reads
        them."""
        return f"SELECT {keep}, {', '.join(columns)} FROM {table} LATERAL VIEW inline(array(struct({', '.join(columns.values())}))) pinned AS {', '.join(columns)}"

    def split(self, x: str, by: str) -> str:
        return f"split({x}, {self.lit(by)})"

    def series(self, n: int) -> str:
        return f"sequence(1, {n})"

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})"

    def array(self, parts) -> str:
        return f"array({', '.join(parts)})"

    def join_in_order(self, x: str, order: str, by: str = "\n", where: str = "true") -> str:
        return f"array_join(transform(array_sort(collect_list(CASE WHEN {where} THEN named_struct('o', {order}, 'x', {x}) END)), s -> s.x), {self.lit(by)})"

    def at(self, array: str, index: int) -> str:
        """Element of an array, counted from 1; null beyond its end."""
        return f"try_element_at({array}, {index})"

    def size(self, array: str) -> str:
        return f"CAST(size({array}) AS BIGINT)"

    def mapped(self, array: str, x: str, value: str, where: str) -> str:
        """`value` of every element x of an array; of these the ones that satisfy `where`, a condition on y."""
        return f"filter(transform({array}, {x} -> {value}), y -> {where})"

    def tally_in(self, array: str, x: str, condition: str) -> str:
        """Number of elements x of an array that satisfy a condition."""
        return f"CAST(size(filter({array}, {x} -> {condition})) AS BIGINT)"

    def distinct(self, array: str) -> str:
        return f"array_distinct({array})"

    def sha256(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def number(self, x: str) -> str:
        return f"try_cast({x} AS DOUBLE)"

    def record(self, **fields: str) -> str:
        """A JSON object of the fields, none of which is null."""
        return f"to_json(named_struct({', '.join(f'{self.lit(k)}, {v}' for k, v in fields.items())}))"

    def quoted(self, x: str) -> str:
        """A text as JSON."""
        return f"substr(to_json(named_struct('x', {x})), 6, length(to_json(named_struct('x', {x}))) - 6)"

    def pattern_split(self, x: str, by: str) -> str:
        return self.split(x, f"[{by}]")

    def head(self, array: str, n: int) -> str:
        """The first n elements of an array."""
        return f"slice({array}, 1, {n})"

    def list_in_order(self, x: str, order: str, where: str = "true") -> str:
        """The values of a group as an array, by order."""
        return f"transform(array_sort(collect_list(CASE WHEN {where} THEN named_struct('o', {order}, 'x', {x}) END)), s -> s.x)"

    def each(self, array, value, x="x", i="i"):
        return f"transform({array}, ({x}, {i}) -> {value(x, i)})"

    def kept(self, array, test, x="x", i="i"):
        return f"filter({array}, ({x}, {i}) -> {test(x, i)})"

    def get(self, array: str, index: str) -> str:
        """Element of an array, counted from 0; null beyond its ends."""
        return f"get({array}, CAST({index} AS INT))"

    def struct(self, **fields: str) -> str:
        return f"named_struct({', '.join(f'{self.lit(k)}, {v}' for k, v in fields.items())})"

    def split_cells(self, x: str) -> str:
        """Cells of a row that is written with bars."""
        return f"split({x}, '[|]')"

    def none_of(self, array: str) -> str:
        """An empty array of the same kind."""
        return f"slice({array}, 1, 0)"

    def chained(self, *arrays: str) -> str:
        """Arrays end to end."""
        return f"concat({', '.join(arrays)})"

    def upto(self, n: str) -> str:
        """The numbers from 0 to n - 1, for n of 1 or more."""
        return f"sequence(0, CAST({n} AS INT) - 1)"

    def most(self, array: str) -> str:
        return f"array_max({array})"

    no_tables = "CAST(array() AS ARRAY<ARRAY<ARRAY<STRING>>>)"

    def parsed_json(self, x: str) -> str:
        """A text as JSON; null if it is none."""
        return f"try_parse_json({x})"

    def json_kind(self, v: str) -> str:
        """'ARRAY', 'OBJECT' or another word for what a JSON value is; null for null."""
        return f"regexp_extract(schema_of_variant({v}), '^[A-Z]+', 0)"

    def json_items(self, v: str, path: str = "") -> str:
        """The elements of a JSON array, or of one under a name; null if it is no array."""
        where = "$" + (f"[\"{path}\"]" if path else "")
        return f"try_variant_get({v}, {self.lit(where)}, 'array<variant>')"

    def json_has(self, v: str, name: str) -> str:
        return f"(try_variant_get({v}, {self.lit(f'$["{name}"]')}, 'variant') IS NOT NULL)"

    def json_text(self, v: str, name: str) -> str:
        """A text under a name of a JSON object; '' if there is none."""
        return f"coalesce(try_variant_get({v}, {self.lit(f'$["{name}"]')}, 'string'), '')"

    def part_of(self, array: str, start: str, n: str) -> str:
        """At most n elements of an array from an index that counts from 0."""
        return f"slice({array}, {start} + 1, {n})"

    def rest(self, array: str) -> str:
        """An array without its first element."""
        return f"slice({array}, 2, greatest(size({array}) - 1, 0))"

    def holds(self, array: str, x: str) -> str:
        return f"array_contains({array}, {x})"

    def first_by(self, x: str, order: str, where: str = "true") -> str:
        """The value of a group's first row by order, of those that satisfy `where`; null if none does."""
        return f"min_by({x}, {order}) FILTER (WHERE {where})"

    def last_seen(self, x: str, over: str) -> str:
        """The last value that is not null, over a window."""
        return f"last_value({x}) IGNORE NULLS OVER ({over})"

    def joined(self, array: str, by: str) -> str:
        return f"array_join({array}, {self.lit(by)})"


class Registered(Spark):
    """Spark with the classes of the SQL that registered queries are compared with: there \\w, \\d, \\s and \\b are of ASCII, so
    that a word ends before an umlaut, and only case is folded for all letters."""

    def rx(self, rx: Rx | str, before: str = "", after: str = "") -> str:
        rx = Rx(rx) if isinstance(rx, str) else rx
        guard, pattern = ("", rx.pattern) if before else guarded(rx.pattern, rx.ignore_case)
        return self.lit(guard + "(?iu)" * rx.ignore_case + ascii_classes(before + pattern + after))

    def norm(self, x: str) -> str:
        # a blank that stands alone stays, so it is not replaced by itself
        rare = r"\t\n\f\r\x{3000}\x{a0}"
        return f"trim(regexp_replace({x}, {self.lit(f'[ {rare}]{{2,}}|[{rare}]')}, ' '))"


class Duck(Dialect):
    name = "duckdb"

    def lit(self, text: str) -> str:
        parts = text.replace("'", "''").split("\n")
        return "'" + parts[0] + "'" if len(parts) == 1 else "(" + " || chr(10) || ".join(f"'{p}'" for p in parts) + ")"

    def rx(self, rx: Rx | str, before: str = "", after: str = "") -> str:
        rx = Rx(rx) if isinstance(rx, str) else rx
        return self.lit("(?i)" * rx.ignore_case + before + rx.pattern + after)

    def found(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {pattern})"

    def count(self, x: str, rx: Rx | str) -> str:
        return f"CAST(len(regexp_extract_all({x}, {self.rx(rx)})) AS BIGINT)"

    def extract(self, x: str, rx: Rx | str, group: int = 0) -> str:
        return f"regexp_extract({x}, {self.rx(rx)}, {group})"

    def extract_all(self, x: str, rx: Rx | str, group: int = 0) -> str:
        return f"regexp_extract_all({x}, {self.rx(rx)}, {group})"

    def replace_all(self, x: str, rx: Rx | str, by: str = "") -> str:
        return f"regexp_replace({x}, {self.rx(rx)}, {self.lit(by)}, 'g')"

    def norm(self, x: str) -> str:
        return f"trim(regexp_replace({x}, '[\\s\\x{{3000}}\\x{{a0}}]+', ' ', 'g'))"

    def rows(self, table: str, array: str, value: str, index: str = "", keep: str = "*") -> str:
        inner = f"SELECT *, unnest({array}) AS {value}" + (f", CAST(unnest(range(len({array}))) AS INT) AS {index}" if index else "") + f" FROM {table}"
        return f"SELECT {keep} FROM ({inner})"

    def pin(self, table: str, **columns: str) -> str:
        return f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in columns.items())} FROM {table}"

    def split(self, x: str, by: str) -> str:
        return f"string_split({x}, {self.lit(by)})"

    def series(self, n: int) -> str:
        return f"CAST(range(1, {n + 1}) AS INT[])"

    def div(self, a: str, b: str) -> str:
        return f"({a} // {b})"

    def array(self, parts) -> str:
        return f"[{', '.join(parts)}]"

    def join_in_order(self, x: str, order: str, by: str = "\n", where: str = "true") -> str:
        return f"coalesce(string_agg({x}, {self.lit(by)} ORDER BY {order}) FILTER ({where}), '')"

    def at(self, array: str, index: int) -> str:
        return f"({array})[{index}]"

    def size(self, array: str) -> str:
        return f"CAST(len({array}) AS BIGINT)"

    def mapped(self, array: str, x: str, value: str, where: str) -> str:
        return f"[y FOR y IN [{value} FOR {x} IN {array}] IF {where}]"

    def tally_in(self, array: str, x: str, condition: str) -> str:
        return f"CAST(len([{x} FOR {x} IN {array} IF {condition}]) AS BIGINT)"

    def distinct(self, array: str) -> str:
        return f"list_distinct({array})"

    def sha256(self, x: str) -> str:
        return f"sha256({x})"

    def number(self, x: str) -> str:
        return f"try_cast({x} AS DOUBLE)"

    def record(self, **fields: str) -> str:
        return f"CAST(json_object({', '.join(f'{self.lit(k)}, {v}' for k, v in fields.items())}) AS VARCHAR)"

    def quoted(self, x: str) -> str:
        return f"CAST(to_json({x}) AS VARCHAR)"

    def pattern_split(self, x: str, by: str) -> str:
        return self.split(x, by)

    def head(self, array: str, n: int) -> str:
        return f"({array})[1:{n}]"

    def list_in_order(self, x: str, order: str, where: str = "true") -> str:
        return f"coalesce(list({x} ORDER BY {order}) FILTER ({where}), [])"

    def each(self, array, value, x="x", i="i"):
        return f"list_transform({array}, lambda {x}, {i}: {value(x, f'({i} - 1)')})"

    def kept(self, array, test, x="x", i="i"):
        return f"list_filter({array}, lambda {x}, {i}: {test(x, f'({i} - 1)')})"

    def get(self, array: str, index: str) -> str:
        return f"({array})[{index} + 1]"

    def struct(self, **fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def split_cells(self, x: str) -> str:
        return f"string_split({x}, '|')"

    def none_of(self, array: str) -> str:
        return f"({array})[1:0]"

    def chained(self, *arrays: str) -> str:
        out = arrays[0]
        for a in arrays[1:]:
            out = f"list_concat({out}, {a})"
        return out

    def upto(self, n: str) -> str:
        return f"range(0, {n})"

    def most(self, array: str) -> str:
        return f"list_max({array})"

    no_tables = "CAST([] AS VARCHAR[][][])"

    def parsed_json(self, x: str) -> str:
        return f"CASE WHEN json_valid({x}) THEN CAST({x} AS JSON) END"

    def json_kind(self, v: str) -> str:
        return f"CAST(json_type({v}) AS VARCHAR)"

    def json_items(self, v: str, path: str = "") -> str:
        at = f"json_extract({v}, {self.lit(f'$."{path}"')})" if path else v
        return f"CASE WHEN json_type({at}) = 'ARRAY' THEN json_extract({at}, '$[*]') END"

    def json_has(self, v: str, name: str) -> str:
        return f"json_exists({v}, {self.lit(f'$."{name}"')})"

    def json_text(self, v: str, name: str) -> str:
        return f"coalesce(json_extract_string({v}, {self.lit(f'$."{name}"')}), '')"

    def part_of(self, array: str, start: str, n: str) -> str:
        return f"({array})[{start} + 1:{start} + {n}]"

    def rest(self, array: str) -> str:
        return f"({array})[2:]"

    def holds(self, array: str, x: str) -> str:
        return f"list_contains({array}, {x})"

    def first_by(self, x: str, order: str, where: str = "true") -> str:
        return f"arg_min({x}, {order}) FILTER ({where})"

    def last_seen(self, x: str, over: str) -> str:
        return f"last_value({x} IGNORE NULLS) OVER ({over})"

    def joined(self, array: str, by: str) -> str:
        return f"array_to_string({array}, {self.lit(by)})"


SPARK, REGISTERED, DUCK = Spark(), Registered(), Duck()
