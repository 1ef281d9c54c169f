"""Secret scans (op 8): an incremental ledger of content-addressed blobs, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratafold.llm.common import fresh_path, materialise


@dataclass(frozen=True)
class SecretRule:
    """Matches of `pattern` whose `group` has at least `least` characters. A rule whose pattern changes gets a new version."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: A key from its header to its END line. The END line must be the next thing with a dash, bar an encryption header; where
#: it is missing, the Base64 text that begins right after the header is taken, with blanks, line ends and their escapes. A
#: header named in prose stays a match of its own. Loops are over single characters, so that no text exhausts the stack.
_PEM = "-----BEGIN [A-Z ]*PRIVATE KEY-----"
_SEALED = "[\\x09-\\x0D\\x20\\\\nr]*Proc-Type:[^:-]*DEK-Info:\\x20*[A-Za-z0-9-]+,[0-9A-Fa-f]+"
_BODY = "[\\x09-\\x0D\\x20\\\\]*[A-Za-z0-9+/]{16,}[A-Za-z0-9+/=\\x09-\\x0D\\x20\\\\]*[A-Za-z0-9+/=]"
_NAMES = _either_case("password|passwd|secret|token|api_?key")
#: The first three are the base kinds. A run of hex digits or an access key that is too short holds no longer match, so
#: their length is part of the pattern; a short assignment still uses up its text, so its length is tested afterwards.
RULES = (
    SecretRule("assign", f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    SecretRule("access", "AKIA[A-Z0-9]{12,}"),
    SecretRule("hex", "[0-9a-f]{32,}"),
    SecretRule("pem", f"{_PEM}(?:(?:{_SEALED})?(?:[^-]*-----END [A-Z ]*PRIVATE KEY-----|{_BODY}))?", version=2),
    SecretRule("bearer", "[Bb]earer\\x20+[A-Za-z0-9._~+/-]{20,}=*"),
    SecretRule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    SecretRule("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    # a longer scheme matches from a later letter on, and a bound on it keeps long words cheap
    SecretRule("login", "[a-z][a-z0-9+.-]{1,15}://[^\\x09-\\x0D\\x20/:@\"'<>]+:[^\\x09-\\x0D\\x20/@\"'<>]{3,}@", version=2),
)
BASE = ("assign", "access", "hex")
_SPAN = "array<struct<start:long,kind_no:int,end:long,kind:string>>"
#: What the ledger keeps of a finding: its rule and version, not the place of that rule in a caller's list.
_FOUND = "array<struct<start:long,end:long,rule:string>>"


def blob_of(text: Column | str) -> Column:
    """Content address of a version: SHA-256 of its text, null as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def find_spans(blobs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(blob, spans) for blobs(blob, text, todo), one row for each blob, with a finding; todo names the rule versions to apply.

    A match's place follows from the lengths of the matches and of the text between them, summed up in order, so a text
    with very many matches costs time in proportion. Spans are (start, end, rule and version), in code points, end
    exclusive."""
    t = F.col("text")
    none = F.array().cast("array<string>")
    found = blobs.select("blob", "text", *(F.when(F.array_contains("todo", r.key), F.regexp_extract_all(t, F.lit(r.pattern), F.lit(0))).otherwise(none).alias(f"m{n}") for n, r in enumerate(rules)))
    some = F.array(
        *(
            F.when(
                F.size(f"m{n}") > 0,
                F.struct(F.lit(n).alias("kind_no"), F.lit(r.key).alias("rule"), F.lit(r.least).alias("least"), F.arrays_zip(F.slice(F.split(t, r.pattern, -1), F.lit(1), F.size(f"m{n}")).alias("before"), F.col(f"m{n}").alias("hit"), F.regexp_extract_all(t, F.lit(r.pattern), F.lit(r.group)).alias("part")).alias("hits")),
            )
            for n, r in enumerate(rules)
        )
    )
    by_kind = found.where(" or ".join(f"size(m{n}) > 0" for n in range(len(rules)))).select("blob", F.explode(F.filter(some, lambda x: x.isNotNull())).alias("k"))
    hits = by_kind.select("blob", "k.kind_no", "k.rule", "k.least", F.posexplode("k.hits").alias("no", "h"))
    so_far = Window.partitionBy("blob", "kind_no").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = hits.select("blob", "kind_no", "rule", "least", "no", F.length("h.before").alias("gap"), F.length("h.hit").alias("len"), F.length("h.part").alias("part"))
    placed = sized.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far)).where("part >= least")
    span = F.struct((F.col("end") - F.col("len")).alias("start"), "end", "rule")
    return placed.groupBy("blob").agg(F.collect_list(span).cast(_FOUND).alias("spans"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scan_versions(versions: DataFrame, ledger: str, rules: tuple[SecretRule, ...] = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Bring the ledger at path `ledger` up to date with `versions` and return (blob, spans), one row for every blob of
    the ledger, with all findings of `rules`.

    The ledger holds rows (blob, scanned, spans): the rule versions applied to a blob and what they found, each finding with
    its rule version. Only pairs of a blob and a rule version that it lacks are scanned, and each blob once, however many
    paths, versions or repeated rows share it. One version stands in for its blob: the texts of the others stay where they
    are. Findings of rule versions that `rules` does not name stay in the ledger and do not count; spans are ordered by
    start and then by the order of `rules`, so another order may be given each time. Null texts are the empty blob and null
    ids do not matter; texts are scanned whole, whatever their length; other columns are not read; an empty table adds
    nothing to the ledger."""
    spark = versions.sparkSession
    all_keys = F.array(*[F.lit(r.key) for r in rules])
    hashed = versions.select(F.col(id_col).alias("id"), blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blobs = hashed.groupBy("blob").agg(F.min("id").alias("id"))
    if _exists(spark, ledger):
        seen = spark.read.parquet(ledger).groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("scanned"))
        todo = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(all_keys, F.coalesce("scanned", F.array().cast("array<string>")))).where("size(todo) > 0")
    else:
        todo = blobs.withColumn("todo", all_keys)
    todo = materialise(todo.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "blob", "todo"), "todo")
    # texts that wait for nothing stay where they are; of rows that share id and text one is kept, by the join's own keys
    named = hashed.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "blob", "text")
    unseen = named.join(todo.select("id", "blob"), ["id", "blob"], "left_semi").dropDuplicates(["id", "blob"]).join(todo, ["id", "blob"])
    found = materialise(find_spans(unseen.select("blob", "text", "todo"), rules), "findings")
    none = F.array().cast(_FOUND)
    new = todo.join(found, "blob", "left").select("blob", F.col("todo").alias("scanned"), F.coalesce("spans", none).alias("spans"))
    new.write.mode("append").parquet(ledger)
    place = F.create_map(*[F.lit(x) for n, r in enumerate(rules) for x in (r.key, n)])
    kind = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.kind)])
    named = F.filter("spans", lambda s: s["rule"].isin(*(r.key for r in rules)))
    own = F.transform(named, lambda s: F.struct(s["start"].alias("start"), place[s["rule"]].alias("kind_no"), s["end"].alias("end"), kind[s["rule"]].alias("kind")))
    kept = spark.read.parquet(ledger).select("blob", own.cast(_SPAN).alias("spans"))
    return kept.groupBy("blob").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def find_blobs(docs: DataFrame, ledger: str | None = None, rules: tuple[SecretRule, ...] = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(blob, spans) for the blobs with a finding, written to the shared folder."""
    ledger = ledger or fresh_path(docs.sparkSession, "ledger")
    return materialise(scan_versions(docs, ledger, rules, text, id_col).where("size(spans) > 0"), "blob-findings")


def find_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[SecretRule, ...] = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, spans) for every row of docs: the ledger's findings joined back to all paths. Without a ledger a new one is
    begun in the shared folder. Rows that repeat, or share a text, share the findings; a null id keeps its findings; other
    columns are not read, whatever their names; an empty table gives an empty table."""
    found = find_blobs(docs, ledger, rules, text, id_col)
    paths = docs.select(id_col, blob_of(text).alias("blob"))
    return paths.join(found, "blob", "left").select(id_col, F.coalesce("spans", F.array().cast(_SPAN)).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of (id, spans): counts of the base kinds, SHA-256 over the base spans, and all spans listed."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(id_col, *(count(k) for k in BASE), F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def disjoint(spans: Column) -> Column:
    """Spans, sorted by start, as (start, end) without overlaps: overlapping ones become one."""
    none = F.array().cast("array<struct<start:long,end:long>>")

    def step(acc: Column, s: Column) -> Column:
        open_ = acc["open"]
        now = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        wider = F.struct(open_["start"].alias("start"), F.greatest(open_["end"], s["end"]).alias("end"))
        apart = s["start"] >= open_["end"]
        return F.struct(F.when(apart, F.concat(acc["done"], F.array(open_))).otherwise(acc["done"]).alias("done"), F.when(apart, now).otherwise(wider).alias("open"))

    first = F.struct(none.alias("done"), F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")).alias("open"))
    return F.aggregate(spans, first, step, lambda acc: F.filter(F.concat(acc["done"], F.array(acc["open"])), lambda s: s["end"] > s["start"]))


def redact(text: Column, spans: Column, mark: str = "[SECRET]", step: int = 4096) -> Column:
    """The text with each span (overlapping ones as one) replaced by `mark`. A text is worked on in pieces of `step` code
    points, so that a long one with many spans is not read from its beginning for every span."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))

    def cut(piece: Column, no: Column, spans: Column) -> Column:
        low = no.cast("long") * step
        own = F.filter(spans, lambda s: (s["start"] < low + step) & (s["end"] > low))
        before = lambda own, k: F.when(k > 0, own[k - 1]["end"]).otherwise(low)
        between = lambda own, s, k: F.concat(F.substring(piece, (before(own, k) - low + 1).cast("int"), F.greatest(s["start"] - before(own, k), F.lit(0)).cast("int")), F.when(s["start"] >= low, F.lit(mark)).otherwise(F.lit("")))
        rest = lambda own: F.substring(piece, (F.element_at(own, -1)["end"] - low + 1).cast("int"), step)
        some = _let(own, lambda own: F.concat(F.array_join(F.transform(own, lambda s, k: between(own, s, k)), ""), rest(own)))
        return F.when(F.exists(spans, lambda s: (s["start"] < low + step) & (s["end"] > low)), some).otherwise(piece)

    return _let(disjoint(spans), lambda spans: F.array_join(F.transform(pieces, lambda piece, no: cut(piece, no, spans)), ""))


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def oracle(rules: tuple[SecretRule, ...] = RULES) -> str:
    """The digest of all documents in DuckDB SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = " UNION ALL ".join(
        f"SELECT rid, {n} AS kind_no, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(t, {q(r.pattern)}) AS m, regexp_extract_all(t, {q(r.pattern)}, {r.group}) AS g, regexp_split_to_array(t, {q(r.pattern)}) AS p FROM d" for n, r in enumerate(rules)
    )
    count = lambda k: f"count(*) FILTER (kind = '{k}') AS n_{k}"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
hits AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({kinds}) WHERE len(m) > 0),
sized AS (SELECT rid, kind_no, kind, least, i, length(p[i]) AS gap, length(m[i]) AS n, length(g[i]) AS part FROM hits),
placed AS (SELECT *, sum(gap + n) OVER (PARTITION BY rid, kind_no ORDER BY i) AS e FROM sized),
spans AS (SELECT rid, kind_no, kind, (e - n)::bigint AS s, e::bigint AS e FROM placed WHERE part >= least),
digest AS (
  SELECT rid, {", ".join(map(count, BASE))},
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS spans,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) FILTER (kind_no < {len(BASE)}) AS base
  FROM spans GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::bigint AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN digest USING (rid)"""
