"""Token counts (op 9) and packing into fixed-length sequences (op 10: shortest pack first, op 12: best fit).

Token counts use one observation about the byte-level pre-tokeniser: a space that a non-blank character follows always starts
a new pre-token, whatever stands before it. So a text falls apart at its spaces into chunks whose pieces never depend on the
neighbours, and each distinct chunk has to be cut into pieces only once. Where a space has blanks on both sides (they would
be one pre-token), or the text holds the string of a special token, the text goes to the tokeniser whole; both ways give the
tokeniser's own result. Packing needs the ids themselves and cuts whole texts.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from stratafold.llm.common import group_rows, materialise, tidy

#: Bytes of chunks that a task keeps with their counts, at most; beyond it starts anew. It bounds memory and changes no result.
MAX_CACHED = 24_000_000
_UNSAFE = re.compile(r"\s \s")
#: Texts of these characters only, without very long runs of blanks, are cut by a second, faster library with the same
#: vocabulary and merges.
_COMMON = re.compile("[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")
_BLANKS = re.compile(r"\s{10000}")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _same_vocabulary(tok, special: set[str]) -> Callable[[str], list[int]] | None:
    """The byte-level BPE of `tok` in a faster library, built from its own vocabulary; None if ids do not follow the merges."""
    import json

    import tiktoken

    model = json.loads(tok.to_str())["model"]
    vocab, merges = model["vocab"], model["merges"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in merges]
    if model["type"] != "BPE" or made != list(range(256, 256 + len(made))) or any(c not in byte_of for w in vocab if w not in special for c in w):
        return None
    ranks = {bytes(byte_of[c] for c in w): i for w, i in vocab.items() if w not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Tokens:
    """The tokeniser of a file, without special tokens, truncation or padding."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.quick = _same_vocabulary(self.tok, set(special))

    def ids(self, text: str) -> list[int]:
        if self.quick and _COMMON.fullmatch(text) and not (len(text) >= 10000 and _BLANKS.search(text)) and not (self.special and self.special.search(text)):
            return self.quick(text)
        return self.tok.encode(text, add_special_tokens=False).ids

    def falls_apart(self, text: str) -> bool:
        """True if the pieces of the text are those of the chunks between its spaces."""
        return not _UNSAFE.search(text) and not (self.special and self.special.search(text))


@lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    """Loaded once per worker; about 50 MB, which no text adds to."""
    return Tokens(path)


class Counts(dict):
    """Number of pieces of each distinct chunk, worked out when it is first met. `lead` stands before every chunk."""

    def __init__(self, tokens: Tokens, lead: str):
        super().__init__()
        self.tokens, self.lead, self.held = tokens, lead, 0

    def __missing__(self, chunk: str) -> int:
        n = len(self.tokens.ids(self.lead + chunk))
        self.held += 100 + len(chunk)
        if self.held > MAX_CACHED:
            self.clear()
            self.held = 0
        self[chunk] = n
        return n


def _as_bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def token_counts(docs: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None, limit: int = 512) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit.

    The distinct chunks of a task's documents are counted once, joined to each document's chunk frequencies and summed; ids
    of a document are never laid out. The join is local to a task, which keeps the chunks it has met (MAX_CACHED bytes), so
    nothing is shuffled. Null and empty texts count as empty: 0 bytes, 0 tokens; a text of any length is read whole. Repeated
    rows and null ids give rows of their own; other columns are not read, whatever their names; an empty table gives an
    empty table."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        first, later = Counts(tokens, ""), Counts(tokens, " ")
        for batch in batches:
            n_bytes, n_tokens = [], []
            col = batch.column("_text")
            for i in range(len(col)):
                t = col[i].as_py() or ""
                n_bytes.append(len(t.encode()))
                if tokens.falls_apart(t):
                    head, *tail = t.split(" ")
                    freq = Counter(tail)
                    n_tokens.append(first[head] + sum(map(int.__mul__, map(later.__getitem__, freq), freq.values())))
                else:
                    n_tokens.append(len(tokens.ids(t)))
            counts = pa.array(n_tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n_bytes, pa.int64()), counts, pa.array([k > limit for k in n_tokens], pa.bool_())], ["_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    return slim.mapInArrow(tidy(run), f"_id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("_id", id_col)


def token_pieces(docs: DataFrame, max_len: int = 2048, text: str = "text", id_col: str = "doc_id", path: str | None = None, end_id: int = 1, with_ids: bool = True, short_first: bool = False) -> DataFrame:
    """Documents as token pieces of at most max_len ids: all pieces but the last (the first, when short_first) are full. A
    document's ids are those of its text (null: empty) and end_id. Columns: id, start, length, ids_crc32, doc_tokens, and ids
    when with_ids; when short_first also piece (from 0) and row, a number of the document that no other row has.

    Every row is a document: repeated rows and null ids give pieces of their own. Long texts are cut into as many pieces as
    they need. Other columns are not read, whatever their names; an empty table gives an empty table."""
    path = path or tokenizer_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        names = ["_id", "start", "length", "ids_crc32", "doc_tokens"] + ["piece", "row"] * short_first + ["ids"] * with_ids
        context = TaskContext.get()
        seen = (context.partitionId() if context else 0) << 33
        for batch in batches:
            col = batch.column("_text")
            rows: list[tuple] = []
            parts: list[bytes] = []
            held = 0

            def flush() -> pa.RecordBatch:
                out = [batch.column("_id").take(pa.array([r[0] for r in rows], pa.int64())), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 5))]
                if short_first:
                    out += [pa.array([r[5] for r in rows], pa.int32()), pa.array([seen + r[0] for r in rows], pa.int64())]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4"))))
                return pa.RecordBatch.from_arrays(out, names)

            for i in range(len(col)):
                t = col[i].as_py()
                ids = tokens.ids(t) if t else []
                ids.append(end_id)
                total = len(ids)
                lead = total % max_len if short_first else 0
                starts = [*([0] if lead else []), *range(lead, total, max_len)]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], total])):
                    part = _as_bytes(ids[start:end] if total > max_len else ids)
                    rows.append((i, start, len(part) // 4, zlib.crc32(part), total, piece))
                    if with_ids:
                        parts.append(part)
                    held += len(part)
                if held > 4_000_000:
                    yield flush()
                    rows, parts, held = [], [], 0
            if rows:
                yield flush()
            seen += len(col)

    slim = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    made = slim.mapInArrow(tidy(run), f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", piece int, row long" * short_first + ", ids array<int>" * with_ids)
    return made.withColumnRenamed("_id", id_col)


def shortest_pack_first(counts: dict[int, int], max_len: int) -> list[tuple[list[int], int]]:
    """Packing patterns over a histogram of lengths, longest lengths first; each length goes to the open pattern with the
    least content that still has room (the most room left), and the number of packs of each pattern is kept, not the packs.
    Returns (lengths, packs) pairs, packs > 0. The work depends on the number of distinct lengths alone."""
    room: list[dict[tuple[int, ...], int]] = [{} for _ in range(max_len + 1)]  # by space left: pattern -> packs
    top = -1
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while top > 0 and not room[top]:
                top -= 1
            if top < length or not room[top]:
                per = ()
                room_at, packs, space = None, left, max_len
            else:
                per, have = next(iter(room[top].items()))
                packs, space, room_at = min(left, have), top, room[top]
                if packs == have:
                    del room_at[per]
                else:
                    room_at[per] = have - packs
            new = (*per, length)
            after = space - length
            room[after][new] = room[after].get(new, 0) + packs
            top = max(top, after)
            left -= packs
    return [(list(p), n) for at in room for p, n in at.items()]


def best_fit(counts: dict[int, int], max_len: int) -> list[tuple[list[int], int]]:
    """Packing patterns over a histogram of lengths, longest lengths first; each length goes to the open packs with the least
    room that still holds it, as if its pieces came one by one: a pack is filled with as many of them as it takes before the
    next. Returns (lengths, packs) pairs, packs > 0.

    Packs with one room and one content are counted, not listed. A length splits one pattern at most into full, part-filled
    and untouched packs and opens two kinds of new ones, so there are at most four patterns for each distinct length, and the
    work does not depend on the number of pieces."""
    room: list[dict[tuple[int, ...], int]] = [{} for _ in range(max_len + 1)]  # by space left: pattern -> packs
    rooms: list[int] = []  # those spaces of which packs are open, ascending

    def add(space: int, pattern: tuple[int, ...], packs: int) -> None:
        if not room[space]:
            insort(rooms, space)
        room[space][pattern] = room[space].get(pattern, 0) + packs

    for length in sorted(counts, reverse=True):
        left = counts[length]
        after: list[tuple[int, tuple[int, ...], int]] = []  # packs that hold this length and have no room for another
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                space = rooms[k]
                pattern, have = room[space].popitem()
                if not room[space]:
                    del rooms[k]
            else:
                space, pattern, have = max_len, (), left
            each = space // length
            full = min(have, left // each)
            rest = min(left - full * each, each) if full < have else 0
            if full:
                after.append((space - each * length, (*pattern, *[length] * each), full))
            if rest:
                after.append((space - rest * length, (*pattern, *[length] * rest), 1))
            left -= full * each + rest
            if pattern and have > full + bool(rest):
                add(space, pattern, have - full - bool(rest))
        for space, pattern, packs in after:
            add(space, pattern, packs)
    return [(list(p), n) for at in room for p, n in at.items()]


def pack(pieces: DataFrame, max_len: int = 2048, id_col: str = "doc_id", plan: Callable[[dict[int, int], int], list[tuple[list[int], int]]] = shortest_pack_first, row_col: str | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces with a length of 1 to max_len: every piece lies in one sequence, sequences hold
    at most max_len ids, and the pieces of a sequence follow each other without a gap. `plan` makes the patterns from the
    histogram; pieces of one length are ranked by row_col (the document's id, if not given) and start.

    Only the histogram (at most max_len rows) and the sizes of the ranking groups reach the driver. Pieces find their place
    by the rank within their length; a length with many pieces is ranked in several groups, so that a common length has no
    task of its own. The place of a rank is looked up in the patterns, whose number is bounded by the histogram and
    not by the documents. Ids of tokens do not move: they stay with the pieces and join when sequences are laid out. An
    empty table gives an empty table. Ties are broken by document and start."""
    spark = pieces.sparkSession
    slim = pieces.drop("ids")
    counts = {r["length"]: r["count"] for r in slim.groupBy("length").count().collect()}
    group = group_rows(sum(counts.values()))
    groups = spark.createDataFrame([(k, -(-n // group)) for k, n in counts.items()] or [(0, 1)], "length long, _groups long")
    salted = slim.join(F.broadcast(groups), "length").withColumn("_salt", F.pmod(F.xxhash64(row_col or id_col, "start"), F.col("_groups"))).drop("_groups")
    salted = salted.select(*slim.columns, "_salt")
    base: dict[tuple[int, int], int] = {}
    seen = dict.fromkeys(counts, 0)
    for r in sorted(salted.groupBy("length", "_salt").count().collect()):
        base[r["length"], r["_salt"]] = seen[r["length"]]
        seen[r["length"]] += r["count"]
    slots: dict[int, list[tuple[int, int, int]]] = {}  # by length: ranks taken before, first sequence, offset
    used = dict.fromkeys(counts, 0)
    seq = 0
    for lengths, packs in plan(counts, max_len):
        offset = 0
        for length in lengths:
            slots.setdefault(length, []).append((used[length], seq, offset))
            used[length] += packs
            offset += length
        seq += packs
    table = {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in slots.items()}
    known = spark.sparkContext.broadcast((table, base))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, base = known.value
        for batch in batches:
            length, salt, rank = (batch.column(c).to_numpy() for c in ("length", "_salt", "_rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.lexsort((salt, length))
            edge = np.flatnonzero((np.diff(length[order]) != 0) | (np.diff(salt[order]) != 0)) + 1
            for at in np.split(order, edge):
                if not len(at):
                    continue
                n = int(length[at[0]])
                before, first, off = table[n]
                r = rank[at] - 1 + base[n, int(salt[at[0]])]
                k = np.searchsorted(before, r, "right") - 1
                sequence[at], offset[at] = first[k] + r - before[k], off[k]
            keep = [i for i, c in enumerate(batch.schema.names) if c not in ("_salt", "_rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(sequence), pa.array(offset)], [*(batch.schema.names[i] for i in keep), "sequence_id", "offset"])

    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(row_col or id_col, "start")))
    schema = StructType([*slim.schema.fields]).add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(tidy(place), schema)


def packed_documents(docs: DataFrame, max_len: int = 2048, **how) -> tuple[DataFrame, DataFrame]:
    """(packed, pieces): pieces are the tokenised and cut documents with their ids, written to the shared folder once;
    packed has the same rows without ids and with their places."""
    pieces = materialise(token_pieces(docs, max_len, **how), "pieces")
    return pack(pieces, max_len, how.get("id_col", "doc_id")), pieces


def best_fit_documents(docs: DataFrame, max_len: int = 2048, end_id: int = 0, **how) -> tuple[DataFrame, DataFrame]:
    """(packed, pieces) with only documents of more than max_len ids cut, from their end into full pieces, so that the first
    may be shorter, and best-fit patterns. Pieces of one length take the planned slots by their rank. Every row is a document,
    also repeated ones and those without an id: they are told apart by `row`. Null and empty texts are the id end_id alone.
    Other columns are not read; an empty table gives empty tables."""
    pieces = materialise(token_pieces(docs, max_len, end_id=end_id, short_first=True, **how), "pieces")
    return pack(pieces, max_len, how.get("id_col", "doc_id"), best_fit, "row"), pieces


def sequences(packed: DataFrame, pieces: DataFrame, max_len: int = 2048, id_col: str = "doc_id", pad_id: int = 50256) -> DataFrame:
    """The packed sequences: sequence_id, used (ids before padding) and ids, padded to max_len, except where `used` is a
    power of two. Documents' ids must be distinct."""
    met = packed.select(id_col, "start", "sequence_id", "offset").join(pieces.select(id_col, "start", "ids"), [id_col, "start"])
    whole = met.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
    used = F.size("ids")
    pad = F.when(used.bitwiseAND(used - 1) == 0, 0).otherwise(F.lit(max_len) - used)
    return whole.select("sequence_id", used.alias("used"), F.concat("ids", F.array_repeat(F.lit(pad_id), pad)).alias("ids"))
