"""Language labels for spans and documents of mixed-language text.

``train`` counts character n-grams (1 to 4, with word ends) per language over
a bounded, hash-chosen sample of labelled rows and learns which scripts each
language is written in. ``label`` scores every word of every text:

1. the script range of a word's first letter narrows the candidate languages
   (no narrowing where no learned language uses that script);
2. candidates get the word's summed n-gram log-probability;
3. Viterbi with a fixed penalty per language switch labels the words, and
   neighbouring words of one label form a span.

Most texts have one language. That is proved cheaply for a whole batch: if no
run of words gains half a penalty by leaving language ``a`` for any
single other language, then staying in ``a`` is the optimal path. Only the
other texts go through the Viterbi recursion, in fixed-size pieces of words
processed side by side.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ddl, extended, give_back, in_sample

WORD = re.compile(r"[^\W\d_]+")
ORDERS = (1, 2, 3, 4)
BUCKET_BITS = 16
#: Characters handled at a time, and words kept in a worker's score cache.
PIECE_CHARS, CACHE_WORDS = 1_000_000, 200_000
STEP = 128

# First code point of each script range (Unicode blocks), in order.
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"),
    (0xFF65, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_STARTS = np.array([a for a, _ in SCRIPT_RANGES])
_SCRIPT_OF = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])


@dataclass
class Model:
    """At most 2^16 x ``max_languages`` (256) log-probabilities: a proven size bound for the broadcast."""

    languages: list[str]
    logp: np.ndarray      # [order, bucket, language] flattened to [buckets, languages]
    allowed: np.ndarray   # [script, language]
    penalty: float


def held_out(key: Column) -> Column:
    """Rows that no model learns from: a quarter, by the CRC-32 of the key as text."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of ``^word$`` and the index of its word."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lens)
    buckets, owners = [], []
    h = np.zeros(len(cp), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(cp) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(1_000_003) + cp[n - 1:]
        inside = owner[:m] == owner[n - 1:]
        if n == 1:
            inside &= cp > 3
        mixed = (h[inside] * np.uint64(len(ORDERS)) + np.uint64(n - 1)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(owner[:m][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def _script(words: list[str]) -> np.ndarray:
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _SCRIPT_OF[np.searchsorted(_STARTS, first, side="right") - 1]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
          docs_per_language: int = 4000, penalty: float = 12.0, alpha: float = 0.5, max_languages: int = 256) -> Model:
    """Fit on about ``docs_per_language`` labelled rows of each language (all, where there are fewer).

    The sample is chosen by the hash of the row's key, so it is the same in
    every run. Counting is distributed; what reaches the driver is one count
    per (language, bucket) and per (language, script). Of more than
    ``max_languages`` labels those with most rows are learned (then by name);
    rows of the others teach nothing, and are labelled like any row.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    by_rows = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    sizes = dict(by_rows.orderBy(F.desc("n"), "lang").limit(max_languages).collect())
    languages = sorted(sizes)
    size = 1 << BUCKET_BITS
    if not languages:
        return Model([], np.zeros((size, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool), penalty)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, docs_per_language / n)).otherwise(share)
    sample = rows.filter(in_sample(F.col(key_col), share)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["t"]):
                words = Counter(WORD.findall(text.lower()))
                if not words:
                    continue
                distinct = list(words)
                times = np.fromiter(words.values(), np.float64, len(words))
                bucket, owner = _ngrams(distinct)
                grams[lang] = grams.get(lang, 0) + np.bincount(bucket, times[owner], size)
                letters = times * np.fromiter(map(len, distinct), np.float64, len(words))
                scripts[lang] = scripts.get(lang, 0) + np.bincount(_script(distinct), letters, len(SCRIPTS))
        for lang, c in grams.items():
            at = np.nonzero(c)[0]
            yield pd.DataFrame({"lang": lang, "slot": at, "n": c[at]})
            at = np.nonzero(scripts[lang])[0]
            yield pd.DataFrame({"lang": lang, "slot": -1 - at, "n": scripts[lang][at]})

    counts = sample.mapInPandas(count, "lang string, slot long, n double").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    grams = np.zeros((size, len(languages)))
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    col = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    slot, n = counts["slot"].to_numpy(np.int64), counts["n"].to_numpy(float)
    gram = slot >= 0
    grams[slot[gram], col[gram]] = n[gram]
    scripts[-1 - slot[~gram], col[~gram]] = n[~gram]
    logp = np.log(grams + alpha) - np.log(grams.sum(axis=0) + alpha * size)
    logp = (logp - logp.max(axis=1, keepdims=True)) / len(ORDERS)
    allowed = scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, logp.astype(np.float32), allowed, penalty)


class _Words(dict):
    """Word -> row of the score table; new words are noted for one scoring call."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.fresh = model, []
        self.scores = np.zeros((0, len(model.languages)), np.float32)
        self.letters = np.zeros(0, np.int32)

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = at = len(self)
        return at

    def score(self) -> None:
        """Append the rows of the new words."""
        if not self.fresh:
            return
        m = self.model
        bucket, owner = _ngrams(self.fresh)
        order = np.argsort(owner, kind="stable")
        starts = np.searchsorted(owner[order], np.arange(len(self.fresh)))
        s = np.add.reduceat(m.logp[bucket[order]], starts, axis=0)
        ok = m.allowed[_script(self.fresh)]
        ok[~ok.any(axis=1)] = True
        s = np.where(ok, s, np.float32(-1000))
        s -= s.max(axis=1, keepdims=True)
        self.scores = np.concatenate([self.scores, s])
        self.letters = np.concatenate([self.letters, np.fromiter((sum(map(str.isalpha, w)) for w in self.fresh), np.int32, len(self.fresh))])
        self.fresh = []


def _best_run(gain: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest sum over a run of neighbouring words, per document."""
    total = np.cumsum(gain)
    step = 2 * (np.abs(gain).sum() + 1)
    before = np.concatenate(([0.0], total[:-1])) - step * doc   # falls from document to document, so minima start anew
    return np.maximum.reduceat(total - step * doc - np.minimum.accumulate(before), starts)


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Best label sequence of each text: sum of word scores minus ``penalty`` per switch; ties go to the lower label.

    All texts are cut into pieces of ``STEP`` words (padded with zero scores);
    step i handles word i of every piece at once. One pass gives each piece's
    best score from each entry label to each exit label, the pieces of a text
    are chained, and a second pass keeps back pointers.
    """
    if not scores:
        return []
    n_lab = scores[0].shape[1]
    pieces = [max(1, -(-len(s) // STEP)) for s in scores]
    first = np.concatenate(([0], np.cumsum(pieces)))
    s = np.zeros((first[-1], STEP, n_lab))
    for i, x in enumerate(scores):
        s[first[i]:first[i + 1]].reshape(-1, n_lab)[:len(x)] = x

    def step(v, word):
        return np.maximum(v, v.max(axis=-1, keepdims=True) - penalty) + word

    through = np.broadcast_to(np.where(np.eye(n_lab, dtype=bool), 0.0, -np.inf), (len(s), n_lab, n_lab)).copy()
    for i in range(STEP):
        through = step(through, s[:, None, i])
    entry = np.zeros((len(s), n_lab))
    longest, counts, starts = max(pieces), np.array(pieces), first[:-1]
    for k in range(1, longest):
        at = starts[counts > k] + k
        entry[at] = (entry[at - 1][:, :, None] + through[at - 1]).max(axis=1)
    back = np.empty((len(s), STEP, n_lab), np.int16)
    v, own = entry, np.arange(n_lab, dtype=np.int16)
    for i in range(STEP):
        top = v.argmax(axis=1)
        stay = v >= v.max(axis=1, keepdims=True) - penalty
        back[:, i] = np.where(stay, own, top[:, None])
        v = step(v, s[:, i])
    # exit label -> entry label of each piece, then the texts from their last piece to the first
    rows = np.arange(len(s))
    enter = np.broadcast_to(own, (len(s), n_lab)).astype(np.int16)
    for i in range(STEP - 1, -1, -1):
        enter = np.take_along_axis(back[:, i], enter.astype(np.int64), axis=1)
    out_label = np.zeros(len(s), np.int64)
    out_label[first[1:] - 1] = v[first[1:] - 1].argmax(axis=1)
    for k in range(longest - 1, 0, -1):
        at = starts[counts > k] + k
        out_label[at - 1] = enter[at, out_label[at]]
    path = np.empty((len(s), STEP), np.int64)
    cur = out_label
    for i in range(STEP - 1, -1, -1):
        path[:, i] = cur
        cur = back[rows, i, cur].astype(np.int64)
    return [path[first[i]:first[i + 1]].reshape(-1)[:len(x)] for i, x in enumerate(scores)]


def _label_piece(texts: list[str], words: _Words) -> list[tuple]:
    """(language, score, spans) per text."""
    m = words.model
    if not m.languages:
        return [("und", 0.0, [])] * len(texts)
    found = [WORD.findall(t.lower()) for t in texts]
    counts = np.array([len(f) for f in found])
    ids = [np.fromiter(map(words.__getitem__, f), np.int64, len(f)) for f in found]
    words.score()
    out: list[tuple] = [("und", 0.0, [])] * len(texts)
    at = [i for i in range(len(texts)) if counts[i] and words.letters[ids[i]].any()]
    if not at:
        return out
    flat = np.concatenate([ids[i] for i in at])
    s = words.scores[flat].astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(counts[at])[:-1]))
    doc = np.repeat(np.arange(len(at)), counts[at])
    best = np.add.reduceat(s, starts, axis=0).argmax(axis=1)
    own = np.take_along_axis(s, best[doc][:, None], axis=1)[:, 0]
    single = np.ones(len(at), bool)
    for lang in range(len(m.languages)):
        # k runs then gain less than k * penalty / 2, which k - 1 switches cost at least when k > 1
        single &= _best_run(s[:, lang] - own, doc, starts) < m.penalty / 2
    mixed = np.nonzero(~single)[0]
    paths = dict(zip(mixed, viterbi([s[starts[k]:starts[k] + counts[at[k]]] for k in mixed], m.penalty)))
    for k, i in enumerate(at):
        if k not in paths:
            t = texts[i]
            a, b = _ends(t)
            out[i] = (m.languages[best[k]], 1.0, [(a, b, m.languages[best[k]])])
            continue
        path, letters = paths[k], words.letters[ids[i]]
        share = np.bincount(path, letters, len(m.languages))
        win = int(share.argmax())
        cuts = np.concatenate(([0], np.nonzero(np.diff(path))[0] + 1, [len(path)]))
        where = [x.span() for x in WORD.finditer(texts[i].lower())]
        spans = [(where[a][0], where[b - 1][1], m.languages[path[a]]) for a, b in zip(cuts, cuts[1:])]
        out[i] = (m.languages[win], float(share[win] / share.sum()), spans)
    return out


def _ends(text: str) -> tuple[int, int]:
    low = text.lower()
    a = WORD.search(low).start()
    b = len(low)
    while not WORD.match(low[b - 1]):
        b -= 1
    return a, b


def label(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """(id columns in ``keep``, id, lang_pred, score, spans) per row.

    ``spans`` are (start, end, lang) in code points of the lower-cased text;
    ``lang_pred`` is the language with most letters, ``score`` its share of
    them. Null texts, texts without letters, and every text where nothing was
    learned, are ``und`` with score 0 and no spans. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.logp, model.allowed, model.penalty))

    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(Model(*shared.value))
        for b in batches:
            texts = [t.as_py() or "" for t in b.column("t")]
            sizes = np.cumsum([len(t) for t in texts])
            cuts = [0, *(np.nonzero(np.diff(sizes // PIECE_CHARS))[0] + 1).tolist(), len(texts)]
            for a, z in zip(cuts, cuts[1:]):
                if len(words) > CACHE_WORDS:
                    words = _Words(Model(*shared.value))
                got = _label_piece(texts[a:z], words)
                yield extended(b.slice(a, z - a), ("t",), lang_pred=pa.array([x[0] for x in got], pa.string()), score=pa.array([x[1] for x in got], pa.float64()),
                               spans=pa.array([[{"start": p, "end": q, "lang": g} for p, q, g in x[2]] for x in got], spans))
                del got
            del b, texts
        del words
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), *keep, F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"{ddl(rows, ('t',))}lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
