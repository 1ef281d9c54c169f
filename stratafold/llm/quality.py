"""Quality rules (op 1): a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import words_col

SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it its of on or that the to was were will with this which you not "
    "der die das den dem und ist von mit nicht ein eine einer zu im auf für sich auch als es an aus bei nach wie "
    "le la les un une des et est dans que qui pour par sur pas avec au aux du de ce se plus en "
    "el los las del y por con para una su al lo como más o pero sus no "
    "il di che per non da sono della i os e do um uma com não mais het een van dat op te zijn niet"
).split()


@dataclass(frozen=True)
class Rule:
    """A document keeps the rule if low <= measure <= high; measures of documents without words are zero."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are per word or per line with a word.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols", "symbol_ratio", None, 0.20),
    Rule("shouting", "exclaim_ratio", None, 0.30),
    Rule("stop_words", "stop_word_ratio", 0.015, None),
    Rule("alphabetic", "alpha_word_ratio", 0.60, None),
    Rule("bullets", "bullet_line_ratio", None, 0.90),
    Rule("ellipsis", "ellipsis_line_ratio", None, 0.40),
    Rule("repeated_lines", "dup_line_ratio", None, 0.40),
)

_MEASURES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "exclaim_ratio": ("n_exclaim", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "alpha_word_ratio": ("n_alpha_words", "n_words"),
    "bullet_line_ratio": ("n_bullet_lines", "n_lines"),
    "ellipsis_line_ratio": ("n_ellipsis_lines", "n_lines"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(words: Column, hashes: Column) -> Column:
    """Words in three-word windows that occur more than once. Windows whose hashes all differ hold no repeat; where some
    agree, the windows themselves are sorted with their place, those equal to a neighbour are kept, and the places they
    cover are counted once."""

    def body(s: Column) -> Column:
        last = F.size(s) - 1
        twin = lambda e, k: ((k > 0) & (s[k - 1]["x"] == e["x"])) | ((k < last) & (s[k + 1]["x"] == e["x"]))
        places = F.transform(F.filter(s, twin), lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    numbered = F.transform(hashes, lambda _, i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("x"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(F.sort_array(numbered), body)).otherwise(0)


def _kept(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """One boolean column per rule: true if the document passes it."""
    out = {}
    for r in rules:
        part, whole = _MEASURES[r.measure]
        tests = [F.col(part) >= r.low * F.col(whole)] if r.low is not None else []
        tests += [F.col(part) <= r.high * F.col(whole)] if r.high is not None else []
        out[f"pass_{r.name}"] = reduce(lambda a, b: a & b, tests)
    return out


def quality_rules(docs: DataFrame, text: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and one
    pass_<rule> column per rule. kept is false if base_failed (under 50 words, or over half of the words in repeated
    three-word windows) or if a rule fails.

    Everything is one chain of projections over the scan: no shuffle, no user function. Null texts count as empty; repeated
    rows give repeated rows; other columns are not read."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), t.alias("t"), words_col(t).alias("w"), F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("w")
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.col("w")[i], F.col("w")[i + 1], F.col("w")[i + 2]))).otherwise(F.array().cast("array<long>"))
    drop = lambda chars: F.length("t") - F.length(F.translate("t", chars, ""))
    some = lambda col, test: F.size(F.filter(col, test))
    bare = lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))
    counted = base.select(
        "_id",
        n.cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        drop(SYMBOLS).cast("long").alias("n_symbols"),
        drop("!").cast("long").alias("n_exclaim"),
        some("w", lambda w: bare(w).isin(*STOP_WORDS)).cast("long").alias("n_stop_words"),
        some("w", lambda w: w.rlike(r"\p{L}")).cast("long").alias("n_alpha_words"),
        F.size("lines").cast("long").alias("n_lines"),
        some("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]")).cast("long").alias("n_bullet_lines"),
        some("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")).cast("long").alias("n_ellipsis_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "w",
        hashes.alias("hashes"),
    )
    repeated = counted.withColumn("n_repeat_words", _covered(F.col("w"), F.col("hashes")).cast("long"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passed = _kept(rules)
    kept = reduce(lambda a, b: a & b, passed.values(), ~failed)
    return repeated.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), kept.alias("kept"), *(c.alias(k) for k, c in passed.items()))


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same in DuckDB SQL."""
    ws = r"[\x20\x09-\x0D]"
    tests = []
    for r in rules:
        part, whole = _MEASURES[r.measure]
        both = [f"{part} >= {r.low!r}::double * {whole}"] if r.low is not None else []
        both += [f"{part} <= {r.high!r}::double * {whole}"] if r.high is not None else []
        tests.append((r.name, "(" + " AND ".join(both) + ")"))
    stop = ", ".join("'" + w + "'" for w in sorted(set(STOP_WORDS)))
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    [x FOR x IN regexp_split_to_array(coalesce(text, ''), '{ws}+') IF x <> ''] AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents),
windows AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM base WHERE len(w) >= 3),
named AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM windows),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS c FROM named) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
counted AS (
  SELECT doc_id, len(w)::bigint AS n_words, length(regexp_replace(t, '{ws}', '', 'g'))::bigint AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
    (length(t) - length(replace(t, '!', '')))::bigint AS n_exclaim,
    len([x FOR x IN w IF lower(regexp_replace(x, '[.,;:!?]+$', '')) IN ({stop})])::bigint AS n_stop_words,
    len([x FOR x IN w IF regexp_matches(x, '\\p{{L}}')])::bigint AS n_alpha_words,
    len(lines)::bigint AS n_lines,
    len([x FOR x IN lines IF regexp_matches(x, '^{ws}*[-*•]')])::bigint AS n_bullet_lines,
    len([x FOR x IN lines IF regexp_matches(x, '(\\.\\.\\.|…){ws}*$')])::bigint AS n_ellipsis_lines,
    (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
    coalesce(n, 0)::bigint AS n_repeat_words
  FROM base LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(t for _, t in tests)} AS kept, {", ".join(f"{t} AS pass_{k}" for k, t in tests)}
FROM judged"""
