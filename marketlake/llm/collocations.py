"""Collocations by Toivonen's mining: a sample proposes, full passes count exactly.

Phrases of one to five words are mined level by level on a sample of the
documents, at a lowered threshold. What is frequent there is proposed. The
full pass counts, over all texts, every word and every longer phrase whose
words without the last and without the first are both proposed: that is each
proposed phrase and the whole negative border. A border phrase that turns out
frequent is a failure of the sample: it is proposed too, and an expansion pass
counts the phrases that this brings within the border. That pass takes each
phrase it counts for frequent, so it expands to the full length at once and
the result is closed after it: every frequent phrase has been counted, because
a phrase is never more frequent than its parts.

Counting tasks know the proposals as a bit per hash value, in a bitmap sized
by their number and bounded by ``max_bits``. A hash that two phrases share
only lets a task count phrases that nobody asked for; counts are kept under
the phrases' own words, so no result depends on hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketlake.llm.common import discard, id_text, in_sample, stored


@dataclass(frozen=True)
class Settings:
    """``share`` of the documents is the sample, in which phrases are proposed from ``slack`` times their expected count on.

    Neither changes the result, only the work; nor do ``max_bits``, the bound of the bitmap (32 MB), and the
    sizes: bytes of a ``block`` of text, ``pairs`` that a task gathers before it sends them, words of the corpus for which
    there is a bucket of sums.
    """

    words: int = 5
    least: int = 100
    first: int = 2000
    share: float = 0.125
    slack: float = 0.6
    max_bits: int = 1 << 28
    block: int = 1 << 22
    pairs: int = 1 << 20
    bucket_words: int = 1 << 21


#: Line ends and `.,;:!?` part pieces, here all as full stops; tabs are spaces; A-Z become small.
_PLAIN = bytes.maketrans(b",;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"......... abcdefghijklmnopqrstuvwxyz")
_STOP = b"."


def tokens(block: bytes) -> list[bytes]:
    """Words of the UTF-8 text, and a full stop wherever a piece ends."""
    return block.translate(_PLAIN).replace(b".", b" . ").split()


def blocks(texts: list[bytes], size: int) -> Iterator[bytes]:
    """The texts, parted by full stops, in stretches of about ``size`` bytes that end between pieces."""
    held, n = [], 0
    for t in texts:
        while len(t) > size:
            end = max(t.rfind(c, 0, size) for c in (b".", b"\n", b",", b"!", b"?", b";", b":", b"\r"))
            if end < 0:
                break
            yield t[:end]
            t = t[end + 1:]
        held.append(t)
        n += len(t)
        if n >= size:
            yield b" . ".join(held)
            held, n = [], 0
    if held:
        yield b" . ".join(held)


# -- hashes and the bitmap

def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\x00" + word)


def longer(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    x = (h * np.uint64(0x9E3779B97F4A7C15)) ^ last
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _phrase_hashes(phrases: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, phrase in zip(b.column("lang").to_pylist(), b.column("phrase").to_pylist(), strict=True):
                words = np.array([word_hash(lang, w) for w in phrase.encode().split(b" ")], np.uint64)
                h = words[:1]
                for w in words[1:]:
                    h = longer(h, w)
                out.append(int(h[0]) - (1 << 64) * (int(h[0]) >> 63))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["h"])

    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


def _bitmap(phrases: DataFrame, bits: int) -> np.ndarray:
    """One bit per hash value of the phrases; at most ``bits`` / 32768 rows of 4 KB come to the driver."""
    at = _phrase_hashes(phrases).select(F.col("h").bitwiseAND(F.lit(bits - 1)).alias("at"))
    made = at.groupBy(F.shiftright("at", 15).alias("piece")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for piece, part in made.toLocalIterator():
        out[piece * 4096:(piece + 1) * 4096] = np.frombuffer(part, np.uint8)
    return out


# -- counting

class _Codes(dict):
    """Word -> code from 1 on; the stop is 0. ``hashes`` by code."""

    def __init__(self, lang: str):
        super().__init__({_STOP: 0})
        self.lang, self.words, self.hashes = lang, [_STOP], [0]

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.words)
        self.words.append(word)
        self.hashes.append(word_hash(self.lang, word))
        return code


def _distinct(code: np.ndarray, h: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A place and the number of each phrase of ``k`` words at the places ``at``: grouped by hash, compared by words.

    In order of the first two words, which lets the phrases be packed small.
    """
    _, shown, inverse, n = np.unique(h[at], return_index=True, return_inverse=True, return_counts=True)
    first = at[shown]
    of = first[inverse]
    if all((code[at + i] == code[of + i]).all() for i in range(k)):
        order = np.argsort(code[first] << 32 | code[first + 1])
        return first[order], n[order]
    words = np.stack([code[at + i] for i in range(k)], axis=1)
    _, shown, n = np.unique(words, axis=0, return_index=True, return_counts=True)
    return at[shown], n


def _counted(block: bytes, codes: _Codes, level: int | None, new: np.ndarray | None, old: np.ndarray | None, words: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(phrases, hashes, occurrences) of a block: of one ``level``, or of all.

    Phrases whose parts are all in ``new``. Where ``old`` is given, only those
    that it did not bring within the border; these are themselves taken for
    frequent, so that one pass reaches everything that follows from them.
    """
    code = np.array(list(map(codes.__getitem__, tokens(block))), np.int64)
    is_word = code > 0
    vocabulary = pa.array(codes.words, pa.binary()).cast(pa.string())
    hashes = np.array(codes.hashes, np.uint64)
    if old is None and level in (None, 1):
        n = np.bincount(code, minlength=1)
        n[0] = 0
        held = np.flatnonzero(n)
        yield vocabulary.take(pa.array(held)), hashes[held], n[held]
        yield pa.array([""]), np.zeros(1, np.uint64), np.array([is_word.sum()])
    if new is None:
        return
    last = h = hashes[code]
    wanted = is_word & has(new, h)
    known = is_word & has(old, h) if old is not None else None
    for k in range(2, (level or words) + 1):
        if len(code) < k:
            return
        wanted, h = wanted[:-1] & wanted[1:], longer(h[:-1], last[k - 1:])
        fresh = wanted
        if known is not None:
            known = known[:-1] & known[1:]
            fresh = wanted & ~known
        at = np.flatnonzero(fresh)
        if level in (None, k) and len(at):
            first, n = _distinct(code, h, at, k)
            yield pc.binary_join_element_wise(*[vocabulary.take(pa.array(code[first + i])) for i in range(k)], " "), h[first], n
        wanted = wanted & has(new, h)
        if known is not None:
            wanted, known = wanted | fresh, known & has(old, h)


def _packed(phrases: pa.StringArray, n: np.ndarray) -> bytes:
    """Phrases with their numbers, compressed: number of rows, lengths, numbers, letters."""
    ends = np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset:phrases.offset + len(phrases) + 1]
    letters = phrases.buffers()[2]
    raw = np.int64(len(n)).tobytes() + np.diff(ends).tobytes() + n.astype(np.int64).tobytes() + (letters.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if letters else b"")
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def _unpacked(packed: bytes) -> pa.Table:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd")
    rows = int.from_bytes(raw[:8].to_pybytes(), "little")
    ends = np.concatenate(([0], np.cumsum(np.frombuffer(raw, np.int32, rows, 8)))).astype(np.int32)
    phrases = pa.StringArray.from_buffers(rows, pa.py_buffer(ends), raw.slice(8 + 12 * rows))
    return pa.table({"phrase": phrases, "n": np.frombuffer(raw, np.int64, rows, 8 + 4 * rows)})


def _dealt(lang: str, found: list[tuple[pa.Array, np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, lang, pairs): the phrases of a language with their occurrences, one row for each bucket of hashes."""
    if not found:
        return
    rows = pa.table({"phrase": pa.chunked_array([x[0] for x in found]), "n": np.concatenate([x[2] for x in found]), "h": np.concatenate([x[1] for x in found])})
    rows = rows.group_by("phrase").aggregate([("n", "sum"), ("h", "min")])
    bucket = (rows["h_min"].to_numpy() >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, n = bucket[order], rows["n_sum"].to_numpy()[order]
    phrases = rows["phrase"].combine_chunks().take(pa.array(order))
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
    start = 0
    for end in ends:
        pairs = _packed(phrases.slice(start, end - start), n[start:end])
        yield pa.RecordBatch.from_arrays([pa.array([int(bucket[start])], pa.int32()), pa.array([lang]), pa.array([pairs], pa.binary())], names=["bucket", "lang", "pairs"])
        start = end


def _merged(least: int) -> Callable:
    """Sums of the pairs of one bucket, of phrases with ``least`` occurrences; the empty phrase always."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {}
        for b in batches:
            for lang, pairs in zip(b.column("lang").to_pylist(), b.column("pairs"), strict=True):
                held.setdefault(lang, []).append(_unpacked(pairs.as_py()))
        while held:
            lang, parts = held.popitem()
            sums = pa.concat_tables(parts).group_by("phrase").aggregate([("n", "sum")]).rename_columns(["phrase", "n"])
            sums = sums.filter(pc.or_(pc.greater_equal(sums["n"], least), pc.equal(sums["phrase"], "")))
            k = pc.if_else(pc.equal(sums["phrase"], ""), 0, pc.add(pc.count_substring(sums["phrase"], " "), 1)).cast(pa.int32())
            out = pa.table({"lang": pa.array([lang] * len(sums), pa.string()), "k": k, "phrase": sums["phrase"], "n": sums["n"]})
            yield from out.to_batches(max_chunksize=16384)
    return run


def count(texts: DataFrame, s: Settings, least: int, buckets: int, level: int | None = None, new: np.ndarray | None = None,
          old: np.ndarray | None = None) -> DataFrame:
    """(lang, k, phrase, n): phrases that occur ``least`` times in ``texts`` (lang, t), stored; the empty phrase has all words of a language.

    ``new`` and ``old`` are bitmaps of proposals, now and at the pass before.
    Tasks send their sums in ``buckets`` of hashes; a bucket is one task.
    """
    shared = texts.sparkSession.sparkContext.broadcast((new, old))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, old = shared.value
        codes: dict[str, _Codes] = {}
        found: dict[str, list] = {}
        rows = 0

        def read(lang: str, held: list[bytes]) -> int:
            n = 0
            for block in blocks(held, s.block):
                if lang not in codes or len(codes[lang]) > 200_000:
                    codes[lang] = _Codes(lang)
                for part in _counted(block, codes[lang], level, new, old, s.words):
                    found.setdefault(lang, []).append(part)
                    n += len(part[0])
            return n

        waiting: dict[str, list[bytes]] = {}
        size = 0
        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), b.column("t").cast(pa.binary()), strict=True):
                t = t.as_py()
                waiting.setdefault(lang, []).append(t)
                size += len(t)
                if size >= s.block:
                    rows += sum(read(x, held) for x, held in waiting.items())
                    waiting, size = {}, 0
                    if sum(map(len, codes.values())) > 500_000:
                        codes.clear()
                    if rows >= s.pairs:
                        while found:
                            yield from _dealt(*found.popitem(), buckets)
                        rows = 0
        for x, held in waiting.items():
            read(x, held)
        while found:
            yield from _dealt(*found.popitem(), buckets)

    parts = texts.select("lang", "t").mapInArrow(run, "bucket int, lang string, pairs binary")
    # a bucket is a partition: its sums need no sorting and no other bucket's memory
    sums = parts.repartitionById(buckets, F.col("bucket")).mapInArrow(_merged(least), "lang string, k int, phrase string, n long")
    return stored(sums, "phrases")


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(lang, k, phrase, n): all phrases of 1 to ``words`` words that occur ``least`` times, stored; k = 0 has all words of a language."""
    s = settings
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("t"), id_text(F.col(id_col)).alias("id"))
    rows = rows.filter(F.col("t").isNotNull())
    texts = rows.select("lang", "t")

    # the sample: level by level, at the lowered threshold
    sample = stored(rows.filter(in_sample(F.xxhash64("id", "t"), s.share)).select("lang", "t"), "sample")
    few = max(1, int(s.slack * s.share * s.least))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [count(sample, s, few, tasks, 1)]
    in_sample_words = parts[0].agg(F.sum(F.when(F.col("k") == 0, F.col("n"))), F.count(F.lit(1))).first()
    bits = _bits(in_sample_words[1], s)
    buckets = max(tasks, int((in_sample_words[0] or 0) / s.share / s.bucket_words) + 1)
    new = _bitmap(parts[0].filter("k = 1"), bits)
    for k in range(2, s.words + 1):
        parts.append(count(sample, s, few, max(tasks, int(buckets * s.share)), k, new))
        new |= _bitmap(parts[-1], bits)
    discard(sample, *parts)

    # the full pass: proposals and border; a further one for what failures bring within the border, and all that follows from that
    found = count(texts, s, s.least, buckets, None, new)
    failed = _bitmap(found.filter(f"k BETWEEN 1 AND {s.words - 1}"), bits)
    if (failed & ~new).any():
        found = found.unionByName(count(texts, s, s.least, buckets, None, new | failed, new))
    return found


def _bits(words: int, s: Settings) -> int:
    """A power of two of at least 64 bits per word of the sample: a bit is rarely set by chance."""
    return min(s.max_bits, 1 << max(20, (64 * words).bit_length()))


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by score, a, phrase.

    A phrase of two words or more that occurs ``a >= least`` times is scored at
    the cut where floor(1000 * a * n / (l * r)) is lowest, the first of equal
    ones. A phrase that lies inside a longer frequent one with as many
    occurrences is left out. Null texts hold no words, null languages are
    ``und``; ids only choose the sample. Repeated rows count as often as they
    occur. An empty table gives no rows.
    """
    s = settings
    found = frequent_phrases(docs, id_col, text_col, lang_col, s)
    totals = found.filter("k = 0").select("lang", F.col("n").alias("total"))
    parts = found.filter("k > 0").select("lang", "phrase", "n")
    phrases = found.filter("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))

    # one word shorter is enough: a phrase inside a much longer one also lies inside one in between, at least as frequent
    word = F.split("phrase", " ")
    shorter = F.explode(F.array(F.array_join(F.slice(word, F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice(word, F.lit(2), F.col("k") - 1), " ")))
    held = phrases.filter("k > 2").select("lang", shorter.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = phrases.join(held, ["lang", "phrase"], "left").filter("most IS NULL OR most < a").drop("most")

    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    cuts = kept.withColumn("cut", cut).withColumn("w", word)
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    # a is at most l and r, so the score is at most 1000 * n / r and fits 64 bits where the products do not
    score = F.expr("(CAST(a AS DECIMAL(19, 0)) * CAST(1000 * total AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    scored = lowest.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= s.first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece
  FROM documents),
worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spelled AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4), (5)) AS lengths(k) WHERE len(w) >= k),
counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM spelled GROUP BY ALL),
totals AS (
  SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (
  SELECT lang, k, phrase, f AS a FROM counts WHERE k >= 2 AND f >= 100),
closed AS (
  SELECT c.* FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM candidates b WHERE b.lang = c.lang AND b.k > c.k AND b.a >= c.a AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM closed)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail JOIN totals t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM scored QUALIFY rank <= 2000
"""
