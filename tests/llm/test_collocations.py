"""Collocations against a direct count of all phrases, whatever the sample proposes."""

import collections
import dataclasses
import re

import numpy as np
import pytest

from marketlake.llm import collocations as c

DOCS = "doc_id long, text string, lang string, phrase string, n long, k int, h long, t string"


def slow(rows, least, first, longest=5):
    out = []
    langs = collections.defaultdict(list)
    for _, text, lang in rows:
        langs["und" if lang is None else lang].append(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    for lang, texts in langs.items():
        f = collections.Counter()
        for t in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", t):
                w = re.findall("[^\x20\x09]+", piece)
                for k in range(1, longest + 1):
                    f.update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
        n = sum(v for p, v in f.items() if " " not in p)
        cand = {p: a for p, a in f.items() if " " in p and a >= least}
        scored = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b >= a and f" {p} " in f" {q} " for q, b in cand.items()):
                continue
            w = p.split(" ")
            cuts = [(1000 * a * n // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((p, a, f[" ".join(w[:k])], f[" ".join(w[k:])], n, score))
        scored.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i + 1, *x) for i, x in enumerate(scored[:first])]
    return sorted(out)


def mined(spark, rows, **settings):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], DOCS)
    found = c.collocations(docs, settings=dataclasses.replace(c.Settings(), **settings))
    return sorted(map(tuple, found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    vocabulary = [f"W{i}" if i % 3 else f"é{i}" for i in range(30)]
    passage = "The quick  Brown\tfox jumps over; it ran"
    rows = []
    for i in range(n):
        w = [vocabulary[j] for j in rng.zipf(1.5, 40) % 30]
        w.insert(int(rng.integers(0, 40)), passage if i % 4 == 0 else "a a a a!")
        rows.append((i, (" " if i % 2 else "\t").join(w) + (".\n" if i % 5 else ""), ["en", "de", None][i % 3]))
    return [*rows, (None, None, "en"), (n, "", None), (n, "", None), (n + 1, " .,\t!", "fr"), (n + 1, "a a a a", "und")]


@pytest.mark.parametrize("share, slack", [(0.5, 0.4), (0.05, 3.0), (1e-9, 1.0), (1.0, 1.0)])
def test_result_does_not_depend_on_the_sample(spark, share, slack):
    rows = corpus(1)
    assert mined(spark, rows, least=6, first=50, share=share, slack=slack) == slow(rows, 6, 50)


def test_small_blocks_and_a_small_bitmap_change_nothing(spark):
    rows = corpus(2)
    assert mined(spark, rows, least=5, first=2000, share=0.3, block=200, pairs=50, max_bits=1 << 16, bucket_words=100) == slow(rows, 5, 2000)


def test_a_very_long_text_of_one_phrase(spark):
    rows = [(1, "lang model " * 30_000, "en"), (2, "lang model", "en")]
    assert mined(spark, rows, block=5000) == slow(rows, 100, 2000)
    rows = [(1, "so it is. " * 30_000, "en")]
    assert mined(spark, rows, block=5000) == slow(rows, 100, 2000)


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_phrases_that_share_a_hash_are_counted_apart():
    code = np.array([1, 2, 1, 3, 1, 2])
    h = np.zeros(6, np.uint64)
    first, n = c._distinct(code, h, np.array([0, 2, 4]), 2)
    assert sorted(zip(code[first + 1].tolist(), n.tolist(), strict=True)) == [(2, 2), (3, 1)]
