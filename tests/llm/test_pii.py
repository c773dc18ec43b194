"""Base spans against Python's regular expressions; what the trees add, on texts made for it."""

import random
import re

from marketlake.llm import pii

DOCS = "doc_id long, text string, lang string, base string, spans string, t string, proposals int, id long"
RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(int(c) for c in reversed(d))) % 10 == 0


def counts(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")), "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def slow(text):
    return [(i, m.start(), m.end()) for i, (k, r) in enumerate(RULES.items()) for m in re.finditer(r, text or "") if counts(k, m[0])]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z", 1, 2) for i, t in texts], DOCS)


def found(spark, texts, model=None):
    rows = pii.redactions(frame(spark, texts), model=model).collect()
    return [(r["id"], [tuple(x) for x in r["base"]], [tuple(x) for x in r["spans"]]) for r in rows]


def noise(seed, n):
    rng = random.Random(seed)
    parts = ["@", ".", "a", "b-c", "+1", "+", " ", "-", "(", ")", "255", "256", "0", "00001", "4111 1111 1111 1111", "1.2.3.4", "x@y.z", "é", "😀", "99", "\n", "_", "%", "4111111111111112", "+49 30 1234567"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_base_spans_are_those_of_the_rules(spark):
    texts = [(i, noise(i, 40)) for i in range(300)] + [(None, None), (400, ""), (400, ""), (401, "no@domain a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 +1 2 +123456789")]
    got = sorted(found(spark, texts, pii.Model()), key=repr)
    assert got == sorted(((i, slow(t), slow(t)) for i, t in texts), key=repr)


def test_long_texts(spark):
    texts = {"a" * 200_000: 0, "1" * 200_000: 0, "1 " * 100_000: 0, "a@" * 50_000: 0, "+1" * 50_000: 0, "+" + "(" * 100_000: 0, "1.2." * 30_000: 15_000,
             "a@b" + ".c" * 50_000: 1, "(at) " * 30_000: 0, ":a" * 50_000: 0, "1.2.3.4 " * 20_000: 20_000, "a.b@" * 20_000: 10_000}
    got = {i: base for i, base, _ in found(spark, list(enumerate(texts)), pii.Model())}
    assert [len(got[i]) for i in range(len(texts))] == list(texts.values())
    assert got[10] == [(1, 8 * i, 8 * i + 7) for i in range(20_000)]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_trees_add_what_looks_like_base_spans_and_leave_other_numbers(spark):
    rng = random.Random(5)
    number = lambda: f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
    texts = []
    for i in range(600):
        cue = rng.choice(["call ", "phone: ", "tel "])
        texts.append((i, f"some words {cue}+1 {number()} and more words"))
        texts.append((1000 + i, f"order 2024/{rng.randrange(10**6, 10**7)}-{i} was sent, item {rng.randrange(10**8)}{i:04d}"))
    texts.append((5000, "some words call 1 (212) 555-0199 and more words"))
    texts.append((5001, "write to jane.doe(at)mail[dot]example[dot]com please"))
    out = {i: (base, spans) for i, base, spans in found(spark, texts)}
    assert all(out[i][0] == slow(t) and set(out[i][0]) <= set(out[i][1]) for i, t in texts)
    assert out[5000][0] == [] and out[5000][1] == [(3, 16, 32)]  # a phone number without its plus sign
    assert all(out[1000 + i][1] == [] for i in range(600))


def test_redacted_text(spark):
    rows = pii.redacted(frame(spark, [(1, "é: a@b.co, +49 30 1234567 or 10.0.0.1."), (2, None), (3, "plain")]), model=pii.Model()).collect()
    assert {r["id"]: r["text"] for r in rows} == {1: "é: [email], [phone] or [ip].", 2: "", 3: "plain"}


def test_every_proposal_counts(spark):
    """A kind that is rare among very many proposals gets its threshold: fitting and calibration leave no proposal out."""
    from pyspark.sql import functions as F

    ip = F.col("id") < 8
    x = F.struct(F.when(ip, 1).otherwise(0).alias("kind"), F.lit(0).cast("long").alias("start"), F.lit(9).cast("long").alias("end"), (ip | (F.col("id") % 2 == 0)).alias("held"),
                 *[(F.when(ip, 2.0).otherwise(1.0) if n == "kind" else F.when(ip, 9.0).otherwise((F.col("id") % 2).cast("double")) if n == "digits" else F.lit(0.0)).alias(f"f_{n}") for n in pii.FEATURES])
    rows = spark.range(300_000).select("id", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>").alias("base"), F.array(x).alias("proposals"))
    assert sorted(pii.train(rows, pii.Settings(trees=2, depth=2)).thresholds) == [0, 1]
