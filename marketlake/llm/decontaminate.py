"""Benchmark decontamination by template windows and slot consistency.

Texts become template tokens: lower-cased words, with numbers, names and units
replaced by typed placeholders. Every run of ``window`` template tokens of an
item is a template window; documents that hold the same windows are found by a
hash join. The values behind the placeholders travel along: along one
alignment (document position minus item position) each value of the item must
map to one value of the document, so a question asked again with other
numbers or names is caught, while chance meetings of a template are not. Where
the values conflict, the largest set of windows that agree counts, and every
window whose values are all equal.

A capitalised word at the start of a sentence, and a word with capitals beyond
its first letter (McDonald, USA), may be a name or not. Windows that hold such
words come in two variants, all of them literal and all of them names.

Windows with fewer literal words than others, and items of a few tokens, are no
templates; they are joined by their exact words and values.

Before the join, documents drop windows whose hash is not set in a bitmap of
the items' hashes. The bitmap has a fixed size (2^22 bits, 512 KB), whatever
the number of items; it lets strays through, never drops a match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ddl, extended, free_name, stored

LITERAL, NUMBER, UNIT, CAPITAL, NOTHING, MIXED = 0, 1, 2, 3, 4, 5
NUMBER_RE = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:[a-z%°]{0,3})$")
STRIP = "\"'`´“”„«»‘’()[]{}<>.,;:!?…-–—*#$%&|/\\_=+~^@"
ENDS = re.compile(r"[.!?…:;]")
BITMAP_BITS = 22
CACHE_WORDS, PIECE_CHARS = 200_000, 1_000_000
#: The third form of a window, after the two variants of a template.
EXACT, EXACT_SEED = 2, 1 << 32

# Number words and units that stand for a slot.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
                "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
                "hundred thousand million billion").split()
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg lb lbs oz ton tons ml l litre litres liter "
         "liters gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
         "dollar dollars cent cents euro euros percent degree degrees mph kmh volt volts watt watts joule joules").split()
_WORD_KIND = {w: NUMBER for w in NUMBER_WORDS} | {w: UNIT for w in UNITS}
_PLACEHOLDER = {k: np.uint64(xxhash.xxh64_intdigest(name, 7)) for k, name in
                ((NUMBER, "<number>"), (UNIT, "<unit>"), (CAPITAL, "<name>"))}


@dataclass(frozen=True)
class Settings:
    """``window`` template tokens; windows with fewer than half literal words are matched exactly, values included.

    A document is contaminated by an item when ``min_windows`` of its distinct
    windows (13 tokens in a row), or half of them if fewer, align consistently.
    Items with fewer than ``least_tokens`` tokens are matched exactly too, so one
    of a word or two matches every document that holds them. Exact windows count
    with the others, and never raise the number that the templates alone need.
    """

    window: int = 8
    least_tokens: int = 5
    min_windows: int = 6


class _Tokens(dict):
    """Surface token -> row of (code, kind, ends a sentence)."""

    def __init__(self):
        super().__init__()
        self.code, self.kind, self.ends = [], [], []

    def __missing__(self, word: str) -> int:
        core = word.strip(STRIP)
        low = core.lower()
        kind = NOTHING if not core else _WORD_KIND.get(low, LITERAL)
        if kind == LITERAL and NUMBER_RE.match(low):
            kind = NUMBER
        elif kind == LITERAL and len(core) > 1 and core[0].isupper():
            kind = CAPITAL if core[1:].islower() else MIXED
        self.code.append(xxhash.xxh64_intdigest(low, 1))
        self.kind.append(kind)
        self.ends.append(bool(ENDS.search(word[word.rfind(core) + len(core):] if core else word)))
        self[word] = at = len(self)
        return at


def _hashes(code: np.ndarray, at: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of the windows of ``n`` codes that start at ``at``."""
    mixed = code ^ (code >> np.uint64(29))
    h = np.full(len(at), np.uint64(n + seed), np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + mixed[at + i]
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xD6E8FEB86659FD93)


def _windows(texts: list[str], tokens: _Tokens, lengths: list[int], own_length: int = 0, least: int = 5):
    """Windows of a list of texts: (text index, first token, hash, length, hash of the variant with all names, slots).

    With ``own_length`` (items) each text has windows of min(own_length, its
    tokens); otherwise (documents) windows of every length in ``lengths``.
    ``slots`` is a function giving the placeholder values of chosen windows.
    Each variant of a window is a window of its own.
    """
    split = [t.split() for t in texts]
    ids = np.fromiter((i for s in split for i in map(tokens.__getitem__, s)), np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(s) for s in split])
    kind = np.array(tokens.kind, np.int8)[ids] if len(ids) else np.zeros(0, np.int8)
    ends = np.array(tokens.ends, bool)[ids] if len(ids) else np.zeros(0, bool)
    value = np.array(tokens.code, np.uint64)[ids] if len(ids) else np.zeros(0, np.uint64)
    # a sentence starts at a text's first token and after a sentence mark, also when that stands alone
    start = np.ones(len(ids), bool)
    start[1:] = ends[:-1] | (doc[1:] != doc[:-1])
    keep = kind != NOTHING
    kind, value, doc, start = kind[keep], value[keep], doc[keep], start[keep]
    maybe = (kind == MIXED) | ((kind == CAPITAL) & start)
    kind = np.where(maybe, CAPITAL, kind)
    named = value.copy()
    for k, h in _PLACEHOLDER.items():
        named[kind == k] = h
    code = np.where(maybe, value, named)
    slot = np.stack([(kind != LITERAL) & ~maybe, kind != LITERAL])
    filled = np.concatenate((np.zeros((2, 1), np.int64), np.cumsum(slot, axis=1)), axis=1)
    unsure = np.concatenate(([0], np.cumsum(maybe)))
    size = np.bincount(doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(size)[:-1])) if len(texts) else np.zeros(0, np.int64)
    found = []
    for n in lengths:
        m = len(code) - n + 1
        if m <= 0:
            continue
        whole = doc[:m] == doc[n - 1:]
        if own_length:
            whole &= np.minimum(size, own_length)[doc[:m]] == n
        for form, tokens_of in enumerate((code, named, value)):
            ok = 2 * (filled[form % 2, n:] - filled[form % 2, :m]) <= n if n >= least else np.zeros(m, bool)
            if form == EXACT:
                ok = ~ok
            elif form:
                ok &= unsure[n:] > unsure[:m]
            at = np.nonzero(whole & ok)[0]
            h = _hashes(tokens_of, at, n, EXACT_SEED if form == EXACT else 0)
            general = _hashes(named, at, n) if own_length and form != EXACT else h
            found.append((at, h, np.full(len(at), n), np.full(len(at), form), (general & ~np.uint64(1)) | np.uint64(form == EXACT)))
    if not found:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
    at, h, n, form, general = (np.concatenate(x) for x in zip(*found))
    signed = value.view(np.int64)

    def slots(pick: np.ndarray) -> list[list[int]]:
        return [signed[a:a + k][slot[f, a:a + k]].tolist() if f != EXACT else [] for a, k, f in zip(at[pick], n[pick], form[pick])]

    return doc[at], at - first[doc[at]], h, n, general, slots


def _agreeing(windows: list[dict]) -> list[int]:
    """``g`` of the windows (g, vals, got) of one alignment that count: most that agree on one value for each, and those with equal values."""
    equal = {w["g"] for w in windows if list(w["vals"]) == list(w["got"])}
    maps = []
    for w in windows:
        pairs = set(zip(w["vals"], w["got"]))
        if w["g"] not in equal and len(pairs) == len({v for v, _ in pairs}):
            maps.append((w["g"], dict(pairs)))
    return sorted(equal | _largest(sorted(maps, key=repr)))


def _largest(maps: list[tuple[int, dict]]) -> frozenset:
    """The most names whose maps (name, value -> value) contradict each other nowhere, exactly.

    Windows that share no contradicted value are settled apart. Otherwise the
    value in most windows is tried with each of its partners; a window reaches
    few values, so what is left soon falls apart, and is settled once.
    """
    done: dict[tuple, frozenset] = {}

    def solve(left: tuple[int, ...]) -> frozenset:
        if left not in done:
            done[left] = best(left)
        return done[left]

    def best(left: tuple[int, ...]) -> frozenset:
        partners: dict[int, dict[int, int]] = {}
        for i in left:
            for v, x in maps[i][1].items():
                of = partners.setdefault(v, {})
                of[x] = of.get(x, 0) + 1
        torn = {v: of for v, of in partners.items() if len(of) > 1}
        if not torn:
            return frozenset(maps[i][0] for i in left)
        pieces = _pieces(left, torn)
        if len(pieces) > 1:
            return frozenset().union(*map(solve, pieces))
        v = max(torn, key=lambda v: (sum(torn[v].values()), v))
        return max((solve(tuple(i for i in left if maps[i][1].get(v, x) == x)) for x in sorted(torn[v])), key=len)

    def _pieces(left: tuple[int, ...], torn: dict) -> list[tuple[int, ...]]:
        """Windows linked by contradicted values or by one name."""
        root = {i: i for i in left}

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        seen: dict[tuple, int] = {}
        for i in left:
            for mark in [(0, maps[i][0]), *((1, v) for v in maps[i][1] if v in torn)]:
                root[find(i)] = find(seen.setdefault(mark, i))
        parts: dict[int, list[int]] = {}
        for i in left:
            parts.setdefault(find(i), []).append(i)
        return [tuple(x) for x in parts.values()]

    return solve(tuple(range(len(maps)))) if maps else frozenset()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        texts = [t.as_py() or "" for t in b.column("t")]
        sizes = np.cumsum([len(t) for t in texts])
        cuts = [0, *(np.nonzero(np.diff(sizes // PIECE_CHARS))[0] + 1).tolist(), len(texts)]
        for a, z in zip(cuts, cuts[1:]):
            yield b.column("id").slice(a, z - a), texts[a:z]


def item_windows(benchmark: DataFrame, settings: Settings, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, h, pos, n, vals, g): one row per item and distinct window; variants of one window share ``g``, odd for exact windows. Null and empty texts give none."""
    def run(batches):
        tokens = _Tokens()
        for ids, texts in _texts(batches):
            doc, pos, h, n, general, slots = _windows(texts, tokens, list(range(1, settings.window + 1)), settings.window, settings.least_tokens)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), pa.array(pos), pa.array(h.view(np.int64)), pa.array(n), pa.array(slots(np.arange(len(doc))), pa.list_(pa.int64())),
                                              pa.array(general.view(np.int64))], names=["item_id", "pos", "h", "n", "vals", "g"])

    rows = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).distinct()
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"item_id {kind}, pos long, h long, n long, vals array<long>, g long")
    return found.groupBy("item_id", "h").agg(F.min_by(F.struct("pos", "n", "vals", "g"), "pos").alias("w")).select("item_id", "h", "w.*")


def _bitmap(h: DataFrame) -> np.ndarray:
    """Bits of the items' hashes, packed: 2^22 bits at any number of items."""
    x = (F.shiftrightunsigned("h", 64 - BITMAP_BITS) + 1).alias("x")
    parts = (h.select(x).groupBy(F.bitmap_bucket_number("x").alias("b"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).collect())
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for b, bits in parts:
        out[(b - 1) * 4096:b * 4096] = np.frombuffer(bits, np.uint8)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, item_windows, matched_windows, coverage, kind): one row per contaminated document and item.

    ``kind`` is ``verbatim`` when some alignment has all values equal, else
    ``reparameterised``. Null or empty texts match nothing; rows that share an
    id (of any type) count as one document; no benchmark rows give an empty result.
    """
    items = stored(item_windows(benchmark, settings, item_col, item_text_col), "items")
    lengths = sorted(r[0] for r in items.select("n").distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(items))

    def run(batches):
        tokens, bitmap = _Tokens(), bits.value
        for ids, texts in _texts(batches):
            if len(tokens) > CACHE_WORDS:
                tokens = _Tokens()
            doc, pos, h, _, _, slots = _windows(texts, tokens, lengths, least=settings.least_tokens)
            x = (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            hit = np.nonzero(bitmap[x >> 3] >> (x & 7).astype(np.uint8) & 1)[0]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc[hit])), pa.array(h[hit].view(np.int64)), pa.array(pos[hit]), pa.array(slots(hit), pa.list_(pa.int64()))],
                                             names=["doc_id", "h", "at", "got"])

    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    windows = rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, h long, at long, got array<long>")
    aligned = (windows.join(items, "h").groupBy("doc_id", "item_id", (F.col("at") - F.col("pos")).alias("shift"))
               .agg(F.collect_set(F.struct("g", "vals", "got")).alias("ws")))
    pairs = F.expr("array_distinct(flatten(transform(ws, w -> arrays_zip(w.vals, w.got))))")
    aligned = aligned.withColumn("pairs", pairs).withColumn("same", F.expr("forall(pairs, p -> p.vals = p.got)"))
    conflict = F.expr("size(pairs) > size(array_distinct(transform(pairs, p -> p.vals)))")

    def settle(batches):
        for b in batches:
            kept = [_agreeing(ws) if ws else None for ws in b.column("torn").to_pylist()]
            yield extended(b, ("torn",), kept=pa.array(kept, pa.list_(pa.int64())))

    judged = aligned.select("doc_id", "item_id", "same", F.when(~conflict, F.col("ws.g")).alias("gs"), F.when(conflict, F.col("ws")).alias("torn"))
    judged = judged.mapInArrow(settle, f"{ddl(judged, ('torn',))}kept array<long>")
    per_window = judged.select("doc_id", "item_id", "same", F.explode(F.coalesce("gs", "kept")).alias("g")).groupBy("doc_id", "item_id", "g").agg(F.max("same").alias("same"))
    template = F.col("g") % 2 == 0
    pairs = per_window.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("matched_windows"), F.count_if(template).alias("matched_templates"), F.max("same").alias("same"))
    totals = items.groupBy("item_id").agg(F.count_distinct("g").alias("item_windows"), F.count_distinct(F.when(template, F.col("g"))).alias("templates"))

    def enough(matched: str, total: str):
        return (F.col(total) > 0) & (F.col(matched) >= F.least(F.lit(settings.min_windows), F.ceil(F.col(total) / 2)))

    return (pairs.join(totals, "item_id").filter(enough("matched_windows", "item_windows") | enough("matched_templates", "templates"))
            .select("doc_id", "item_id", "item_windows", "matched_windows",
                    (F.col("matched_windows") / F.col("item_windows")).alias("coverage"),
                    F.when(F.col("same"), "verbatim").otherwise("reparameterised").alias("kind")))


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text no item contaminates, judged by the text alone: ids may be null or repeat. Null texts stay."""
    name = F.md5(F.col(text_col).cast("binary"))
    bad = stored(matches(docs.select(name.alias("id"), F.col(text_col).alias("t")), benchmark, settings, "id", "t")
                 .select(F.col("doc_id").alias(free_name(docs, "contaminated_text"))).distinct(), "contaminated")
    return docs.join(bad, name == F.col(bad.columns[0]), "left_anti")
