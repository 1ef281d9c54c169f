"""Toxicity (op 6): a weighted finite-state pattern grammar over clauses.

A lexical transducer reads words and writes classes; transducers for threats, insults, negation, reported speech and targets
are composed with it into one table, which is run over each clause that holds an insult or a threat. What counts is the pattern
that a clause ends up in (bare, aimed, negated or reported insult; threat with or without a target), not the word alone.
Weights of words, word beginnings and patterns are learned from labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import materialise, tidy

#: Word beginnings that a task counts before it hands its counts on.
HELD = 100_000
#: Labelled rows used for fitting, at most, of either class.
MAX_TOXIC, MAX_CLEAN = 3000, 6000
#: Start of the insult lexicon; labels add words and word beginnings to it.
INSULTS = (
    "idiot idiots idiotic stupid moron morons moronic imbecile scum loser losers worthless pathetic disgusting trash clown clowns "
    "fool dumb jerk filthy vermin garbage scumbag bastard asshole retard "
    "dumm idiotin trottel versager abschaum widerlich arschloch dreckskerl vollidiot "
    "idiote imbécile stupide connard connasse ordure minable abruti crétin "
    "idiota imbécil estúpido estúpida basura asqueroso escoria payaso inútil"
).split()
#: Verbs of violence: forms that threaten by themselves, and forms that mostly tell of what was done, which threaten only
#: after a word of intent.
THREATS = (
    "kill hurt destroy beat shoot stab strangle murder töten töte umbringen umbringe umzubringen verprügeln verprügle verprügele "
    "tuer tue tuerai tuera tueras tuerons tueront frapper frapperai frappera frapperont détruire détruirai détruira détruiront "
    "matar mataré matará matarán matarte golpear golpearé golpeará golpearte destruir destruiré destruirá destruirte"
).split()
NARRATED = (
    "kills killed killing hurts hurting destroys destroyed destroying beats beaten beating shoots shot shooting stabs stabbed stabbing "
    "strangles strangled strangling murders murdered murdering tötest tötet tötete töteten getötet umbringst umbringt umgebracht verprügelst verprügelt "
    "tues tué tués tuée tuées tuez frappes frappé frappés frappée frappez détruis détruit détruite détruits "
    "mata matas mato mató matado matando golpea golpeo golpeó golpeado golpeando destruye destruyo destruyó destruido destruyendo"
).split()
#: Words that insult only a target that stands before them.
WEAK = "pig pigs rat rats snake coward cowards liar liars parasite parasites schwein schweine ratte ratten feigling lügner schmarotzer porc porcs lâche menteur menteuse cerdo cerda rata ratas cobarde mentiroso mentirosa parásito".split()
INTENT = "will i'll we'll he'll she'll they'll you'll gonna shall should must deserve deserves i'm we're am werde werden wirst wird sollst sollte solltest vais va allons serez seras sera mérites voy vamos vas deberías debería serás".split()
TARGETS = "you your you're u ur yourself they them he she him her du dich dir ihr euch sie tu te toi vous ils elle tú ti usted ustedes ellos eres".split()
NEGATIONS = "not no never isn't aren't wasn't don't nobody nicht kein keine nie niemals pas jamais aucun ne nunca ningún tampoco".split()
REPORTS = "said says called calls quoted quote wrote claimed according alleged sagte nannte schrieb zitierte laut disait appelé écrit selon dijo llamó escribió según".split()
PATTERNS = ("bare", "aimed", "negated", "reported", "threat", "aimed_threat")  # and the variety of insults that are meant
#: Weight of a document's insults from which the lexicon explains its label.
EXPLAINED = 4.0
#: Rounds of lexicon building: each works on the toxic documents that the lexicon does not explain yet.
ROUNDS = 4
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»]")
_ENDS = ".!?;:\n"
_END = re.compile(f"[{_ENDS}]")
#: Letters of the word beginnings that are features beside the whole words.
SHORTEST, LONGEST = 3, 12
#: Least log-odds of a learned stem, documents that a shorter stem weighs in a longer one's rate, and least log-odds of a
#: word that is an insult.
ENRICHED, SHRINK, MEANT = 1.8, 4.0, 0.7

Arcs = dict[tuple[object, str], tuple[object, str]]


@dataclass
class Transducer:
    """A deterministic transducer: (state, symbol) -> (state, symbol); a symbol without an arc is copied."""

    start: object
    arcs: Arcs

    def step(self, state: object, symbol: str) -> tuple[object, str]:
        return self.arcs.get((state, symbol), (state, symbol))


def compose(first: Transducer, second: Transducer, symbols: str) -> Transducer:
    """One transducer that feeds what `first` writes to `second`, with all arcs that can be reached laid out."""
    start = (first.start, second.start)
    arcs: Arcs = {}
    todo = [start]
    seen = {start}
    while todo:
        p, q = todo.pop()
        for s in symbols:
            p2, mid = first.step(p, s)
            q2, out = second.step(q, mid)
            arcs[(p, q), s] = (p2, q2), out
            if (p2, q2) not in seen:
                seen.add((p2, q2))
                todo.append((p2, q2))
    return Transducer(start, arcs)


# Symbols: I insult, T threat, U target, N negation, R report, Q quotation mark, o other; read besides: P intent, D narrated
# violence, W weak insult; written besides: n negated insult, m negated threat, r reported insult or threat, A aimed insult, H aimed threat.
_SYMBOLS = "ITUNRQo"
_READ = _SYMBOLS + "PDW"


def threatening(reach: int = 3) -> Transducer:
    """Narrated violence at most `reach` words after a word of intent is a threat; elsewhere it is nothing."""
    arcs: Arcs = {}
    for k in range(reach + 1):
        for s in _READ:
            arcs[k, s] = (reach, "o") if s == "P" else (max(0, k - 1), ("T" if k else "o") if s == "D" else s)
    return Transducer(0, arcs)


def insulting(reach: int = 4) -> Transducer:
    """A weak insult at most `reach` words after a target is an insult; elsewhere it is nothing."""
    arcs: Arcs = {}
    for k in range(reach + 1):
        for s in _SYMBOLS + "W":
            after = reach if s == "U" else max(0, k - 1)
            arcs[k, s] = after, ("I" if k else "o") if s == "W" else s
    return Transducer(0, arcs)


def negation(reach: int = 3) -> Transducer:
    """An insult or threat at most `reach` words after a negation is negated."""
    arcs: Arcs = {}
    for k in range(reach + 1):
        for s in _SYMBOLS:
            after = max(0, k - 1)
            arcs[k, s] = (reach, s) if s == "N" else (after, {"I": "n", "T": "m"}.get(s, s) if k else s)
    return Transducer(0, arcs)


def reported() -> Transducer:
    """What follows a verb of saying, or stands between quotation marks, is reported."""
    arcs: Arcs = {}
    for state in ("out", "said", "quote"):
        inside = state != "out"
        for s in _SYMBOLS + "nm":
            to = {"R": "said" if state == "out" else state, "Q": "out" if state == "quote" else "quote"}.get(s, state)
            arcs[state, s] = to, "r" if inside and s in "ITnm" else s
    return Transducer("out", arcs)


def targeted(reach: int = 6) -> Transducer:
    """An insult or threat at most `reach` words after a target is aimed at it."""
    arcs: Arcs = {}
    for k in range(reach + 1):
        for s in _SYMBOLS + "nmr":
            arcs[k, s] = (reach, s) if s == "U" else (max(0, k - 1), {"I": "A", "T": "H"}.get(s, s) if k else s)
    return Transducer(0, arcs)


GRAMMAR = compose(compose(compose(compose(threatening(), insulting(), _READ), negation(), _READ), reported(), _READ), targeted(), _READ)
_OUTCOME = {"I": 0, "A": 1, "n": 2, "r": 3, "T": 4, "H": 5}


class Grammar:
    """The lexicon of a model and the composed table."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float], weights: list[float] | None = None):
        import ahocorasick

        self.words, self.beginnings, self.weights = words, beginnings, weights
        self.kind = dict.fromkeys(TARGETS, "U") | dict.fromkeys(NEGATIONS, "N") | dict.fromkeys(REPORTS, "R") | dict.fromkeys('"“”«»', "Q") | dict.fromkeys(INTENT, "P") | dict.fromkeys(NARRATED, "D") | dict.fromkeys(WEAK, "W") | dict.fromkeys(THREATS, "T")
        self.lengths = sorted({len(b) for b in beginnings}, reverse=True)
        self.finder = ahocorasick.Automaton()
        tops = {b for b in beginnings if b[:-1] not in beginnings}
        for w in {*words, *tops, *THREATS, *NARRATED, *WEAK}:
            if w in tops or not any(w[:k] in tops for k in range(1, len(w))):
                self.finder.add_word(w, w)
        self.finder.make_automaton()

    def lexical(self, word: str) -> tuple[str, float]:
        """The lexical transducer: class and weight of a word."""
        weight = self.words.get(word)
        if weight is None:
            weight = next((self.beginnings[word[:n]] for n in self.lengths if word[:n] in self.beginnings), None)
        if weight is not None and weight >= MEANT:
            return "I", weight
        kind = self.kind.get(word, "o")
        return kind, 1.0 if kind in "TDW" else 0.0

    def features(self, text: str | None) -> list[float]:
        """Weights of the clauses' patterns, damped by a logarithm. Only clauses with a lexicon entry are parsed."""
        low = (text or "").lower()
        total = [0.0] * len(PATTERNS)
        meant: set[str] = set()
        done = 0
        for end, entry in self.finder.iter(low):
            at = end - len(entry) + 1
            if end < done or (at and low[at - 1].isalpha()):
                continue
            start = max(done, 1 + max(low.rfind(c, done, at) for c in _ENDS))
            stop = _END.search(low, end)
            done = stop.start() if stop else len(low)
            self.clause(low, start, done, total, meant)
        return [math.log1p(max(0.0, x)) for x in (*total, len(meant))]

    def clause(self, text: str, start: int, stop: int, total: list[float], meant: set[str]) -> None:
        """Run the table over text[start:stop], a whole clause, word by word."""
        state = GRAMMAR.start
        last_hit = None
        for found in _WORD.finditer(text, start, stop):
            word = found.group()
            kind, weight = self.lexical(word)
            state, out = GRAMMAR.arcs[state, kind]
            if out in _OUTCOME:
                total[_OUTCOME[out]] += weight
                last_hit = (out, weight, 0) if out in "IT" else None
                if out in "IA":
                    meant.add(word)
            elif last_hit:
                out_before, w, gone = last_hit
                if kind == "U":  # a target that follows aims a bare insult or threat too
                    total[_OUTCOME[out_before]] -= w
                    total[_OUTCOME[{"I": "A", "T": "H"}[out_before]]] += w
                    last_hit = None
                else:
                    last_hit = (out_before, w, gone + 1) if gone < 3 else None

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(id_col: str) -> object:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with three minimum hashes over their word triples: near copies share most of them."""
    from xxhash import xxh64_intdigest

    for batch in batches:
        signs: list[list[int]] = [[], [], []]
        for text in batch.column("text").to_pylist():
            words = (text or "").lower().split()
            triples = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
            for seed, out in enumerate(signs):
                out.append(min(xxh64_intdigest(t, seed) for t in triples) >> 1)
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("label"), *(pa.array(x, pa.int64()) for x in signs)], ["text", "label", "s0", "s1", "s2"])


def _beginnings(words: dict[str, float], begins: dict[str, float]):
    """Documents per word beginning (a whole word ends in $) and label; under "" all documents. Toxic documents that the
    lexicon explains are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        known = Grammar(words, begins)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                met = {*_WORD.findall((text or "").lower())}
                if label and sum(known.lexical(w)[1] for w in met) >= EXPLAINED:
                    continue
                found = {"", *(w + "$" for w in met)}
                for n in range(SHORTEST, LONGEST + 1):
                    found.update(w[:n] for w in met if len(w) >= n)
                (toxic if label else clean).update(found)
                if len(toxic) + len(clean) > HELD:
                    yield counted(toxic, clean)
                    toxic, clean = Counter(), Counter()
        yield counted(toxic, clean)

    def counted(toxic: Counter, clean: Counter) -> pa.RecordBatch:
        keys = [*{*toxic, *clean}]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], ["w", "t", "n"])

    return run


def stems(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int, tried: int) -> list[str]:
    """The shortest words and word beginnings that mark toxic documents: at least ENRICHED in them, and so clearly (by the
    likelihood ratio) that chance explains none of the `tried` ones."""
    share = (n_toxic + 1) / (n_toxic + n_clean + 2)
    odds = lambda t, n: math.log((t + 0.5) / (n_toxic + 1)) - math.log((n + 0.5) / (n_clean + 1))
    least = math.log(max(tried, 1)) + math.log(20)
    clear = lambda t, n: t * math.log(t / (share * (t + n))) + (n * math.log(n / ((1 - share) * (t + n))) if n else 0) >= least
    found = {w for w, t, n in rows if w and odds(t, n) >= ENRICHED and clear(t, n)}
    return [w for w in sorted(found) if not any(w[:k] in found for k in range(SHORTEST, len(w)))]


def weigh(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> tuple[dict[str, float], dict[str, float]]:
    """Log-odds of words and of word beginnings: each is drawn towards the one a letter shorter, so that a word seldom met
    counts as its stem does, and a harmless word under a telling stem does not."""
    share = (n_toxic + 1) / (n_toxic + n_clean + 2)
    rate: dict[str, float] = {}
    logit = lambda p: math.log(p / (1 - p))
    words: dict[str, float] = {}
    begins: dict[str, float] = {}
    for w, t, n in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        above = rate.get(w[:-1], share)
        rate[w] = (t + SHRINK * above) / (t + n + SHRINK)
        weight = min(8.0, logit(min(0.9999, max(0.0001, rate[w]))) - logit(share))
        if w.endswith("$"):
            words[w[:-1]] = weight
        else:
            begins[w] = weight
    return words, begins


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Logistic regression by Newton steps with a small ridge; the intercept comes first."""
    x = np.c_[np.ones(len(x)), x]
    # two prior rows per class keep the fit finite on tiny or one-sided samples; two more say that one aimed threat alone is
    # toxic, as labels without threats give that pattern no weight
    aimed = [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, math.log(2), 0.0]
    x = np.r_[x, [[1.0] + [0.0] * 7] * 2, [[1.0, 2.0, 2.0, 0.0, 0.0, 0.0, 0.0, 1.0]] * 2, [aimed] * 2]
    y = np.r_[y, 0, 0, 1, 1, 1, 1]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Grammar:
    """Learn from at most max_toxic and max_clean labelled documents whose id's CRC-32 is not a multiple of five. A document
    with several labels counts as toxic if one of them says so. Near copies in the sample count once, so that the words of
    a copied document do not pass for signs. Without usable labels (an empty table, null labels or ids) the start lexicon
    decides alone. Rows that repeat in docs count once, null texts as empty; other columns are not read, whatever their
    names. What reaches the driver are words of the sample, so it is bounded by the sample and not by docs."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label).alias("label"))
    pick = lambda value, most: usable.where(F.col("label") == value).orderBy(F.xxhash64(id_col), id_col).limit(most)
    chosen = materialise(pick(1, max_toxic).unionByName(pick(0, max_clean)), "labelled")
    known = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen.withColumnRenamed(id_col, "_id")), "_id").select("text", "label")
    signed = known.mapInArrow(tidy(_signed), "text string, label int, s0 long, s1 long, s2 long")
    for sign in ("s0", "s1", "s2"):  # of near copies the one with the least hash stays, whatever the partitioning
        first = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "s0", "s1", "s2")).alias("first")
        signed = signed.groupBy(F.col(sign).alias("sign"), "label").agg(first).select("first.text", "label", "first.s0", "first.s1", "first.s2")
    sample = materialise(signed, "sample")
    words = dict.fromkeys(INSULTS, 2.0)
    begins: dict[str, float] = {}
    for turn in range(ROUNDS):
        met = sample.mapInArrow(tidy(_beginnings(words if turn else {}, begins)), "w string, t long, n long").groupBy("w").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
        met = materialise(met.where("t + n >= 3 or w = ''"), "beginnings")
        n_toxic, n_clean = next(((r["t"], r["n"]) for r in met.where("w = ''").collect()), (0, 0))
        if n_toxic < 3:
            break
        least = math.exp(-ENRICHED) * (n_clean + 1) / (n_toxic + 1)
        # what comes back are words of a sample of at most max_toxic and max_clean documents
        rows = met.where("t >= 3").where(F.col("n") <= F.lit(least) * (F.col("t") + 1)).collect()
        new = stems([tuple(r) for r in rows], n_toxic, n_clean, met.where("t >= 3").count())
        if not new:
            break
        by_length: dict[int, list[str]] = {}
        for x in new:
            by_length.setdefault(len(x), []).append(x)
        below = met.where(reduce(lambda a, b: a | b, [F.substring("w", 1, n).isin(part) for n, part in by_length.items()])).collect()
        new_words, new_begins = weigh([tuple(r) for r in below], n_toxic, n_clean)
        words |= new_words
        begins |= new_begins
    grammar = Grammar(words, begins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Grammar(words, begins)
        for batch in batches:
            x = [g.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label").cast(pa.int64())], ["x", "y"])

    rows = sorted(sample.mapInArrow(tidy(run), "x array<double>, y long").collect())
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(PATTERNS) + 1)
    grammar.weights = _fit(x, np.array([r["y"] for r in rows], float))
    return grammar


def score_toxicity(docs: DataFrame, grammar: Grammar, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, held_out, score, predicted) for every document; predicted is 1 if score >= 0.5. Null and empty texts get the
    score of a text without patterns. Nothing but the text enters the score; whole texts are read. Repeated rows and null ids
    give rows of their own; other columns are not read, whatever their names; an empty table gives an empty table."""
    parts = grammar.words, grammar.beginnings, grammar.weights
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Grammar(*parts)
        for batch in batches:
            col = batch.column("_text")
            scores = [g.score(col[i].as_py()) for i in range(len(col))]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["_id", "held_out", "score", "predicted"])

    slim = docs.select(F.col(id_col).alias("_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(text).alias("_text"))
    return slim.mapInArrow(tidy(run), f"_id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("_id", id_col)


def keep_clean(docs: DataFrame, grammar: Grammar, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores below `least`, with all their columns; rows with equal texts share a fate."""
    parts = grammar.words, grammar.beginnings, grammar.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Grammar(*parts)
        for batch in batches:
            col = batch.column(text)
            yield batch.filter(pa.array([g.score(col[i].as_py()) < least for i in range(len(col))], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
