"""Personal data: fixed base rules, and spans that boosted trees add to them.

Base rules find e-mail addresses, IPv4 addresses, card numbers and phone
numbers; what they find is always redacted. Beside them generators with high
recall propose spans that may overlap: anything like an address, also with
``(at)`` and ``[dot]``, any run of seven digits or more with separators,
groups of hexadecimal digits between colons. A proposal that holds a base span
is a positive example, any other a negative one. Boosted trees see its format
(digits, letters, separators, groups, checksums) and its context (characters
beside it, cue words and digits around it), but not what tells base spans from
the rest by definition (the plus sign, the ending of a domain). Held-out
proposals calibrate one threshold per kind: the lowest score from which on
``precision`` of the proposals are positive. Proposals above it that overlap
no base span are redacted too.

Everything is built-in functions: matches come from one pattern, their places
from the lengths of the pieces between them, and the fitted trees are a
column expression. Patterns are possessive or bounded and start at the
beginning of a run, so that no text makes them slow.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, stored

KINDS = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Settings:
    """Trees are fitted on three quarters of all proposals, thresholds on the other quarter."""

    trees: int = 12
    depth: int = 4
    precision: float = 0.95
    seed: int = 12


@dataclass
class Model:
    """Boosted trees over ``FEATURES`` as (weight, root) and a threshold per kind; None redacts no proposal."""

    trees: list = field(default_factory=list)
    thresholds: dict = field(default_factory=dict)


# -- patterns

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Possessive and anchored to where a run starts (or the match before ended): the same matches as the plain rules, in linear time.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its rule to be tried.
_NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}

_AT, _DOT = r"(?:@|\x20?[\[(]at[\])]\x20?)", r"(?:\.|\x20?[\[(]dot[\])]\x20?)"
PROPOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,128}}+{_AT}{_LABEL}{{1,64}}(?:{_DOT}{_LABEL}{{1,64}}){{0,8}}",
    "number": r"(?<![0-9])\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,24}(?![0-9])",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){4,7}(?![0-9A-Fa-f:])",
}
_MAYBE = {"email": r"@|[\[(]at[\])]", "number": r"[0-9](?:[\x20().\-/]{0,2}[0-9]){6}", "ip": r":[0-9A-Fa-f]{0,4}:"}
#: Words that announce personal data, in the languages of common corpora.
_CUES = r"(?i)mail|contact|phone|tel|call|fax|mobile|handy|card|visa|iban|konto|carte|tarjeta|host|server|login|address|adress|dirección|ssn"


# -- matches and their places

def _running(sizes: Column, block: int = 256) -> Column:
    """Sums of an array's elements before each one; summed in blocks, so that long arrays are not copied at every step."""
    def sums(a: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("before"))
        return F.aggregate(a, start, lambda x, n: F.struct((x["sum"] + n).alias("sum"), F.concat(x["before"], F.array(x["sum"])).alias("before")))

    starts = F.when(F.size(sizes) > 0, F.sequence(F.lit(1), F.size(sizes), F.lit(block))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda i: sums(F.slice(sizes, i, block)))
    offsets = sums(F.transform(blocks, lambda b: b["sum"]))["before"]
    return F.flatten(F.zip_with(blocks, offsets, lambda b, o: F.transform(b["before"], lambda x: x + o)))


def _matches(df: DataFrame, patterns: dict, needs: dict, prefix: str, context: int = 0) -> DataFrame:
    """Adds ``prefix`` + name: array of (start, end, m, before, after), ends exclusive, code points; ``context`` characters beside the match."""
    names = [prefix + n for n in patterns]
    held = {n: F.when(F.col("t").rlike(needs[k]), F.regexp_extract_all("t", F.lit(patterns[k]), F.lit(0))) for n, k in zip(names, patterns, strict=True)}
    df = df.select("*", *[c.alias(f"{n}_m") for n, c in held.items()])
    df = df.select("*", *[F.when(F.size(f"{n}_m") > 0, F.split("t", patterns[k], -1)).alias(f"{n}_g") for n, k in zip(names, patterns, strict=True)])
    found = {n: F.zip_with(f"{n}_m", F.slice(f"{n}_g", F.lit(1), F.size(f"{n}_m")), lambda m, g: F.struct(
        m.alias("m"), F.char_length(g).cast("long").alias("gap"), F.char_length(m).cast("long").alias("size"), F.right(g, F.lit(context)).alias("before"))) for n in names}
    df = df.select("*", *[c.alias(f"{n}_s") for n, c in found.items()])
    df = df.select("*", *[_running(F.transform(f"{n}_s", lambda x: x["gap"] + x["size"])).alias(f"{n}_at") for n in names])
    placed = {n: F.transform(f"{n}_s", lambda x, i: F.struct(
        (F.get(f"{n}_at", i) + x["gap"]).alias("start"), (F.get(f"{n}_at", i) + x["gap"] + x["size"]).alias("end"), x["m"].alias("m"),
        x["before"].alias("before"), F.left(F.get(f"{n}_g", i + 1), F.lit(context)).alias("after"))) for n in names}
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,m:string,before:string,after:string>>")
    df = df.select("*", *[F.when(F.size(f"{n}_m") > 0, c).otherwise(nothing).alias(n) for n, c in placed.items()])
    return df.drop(*[n + x for n in names for x in ("_m", "_g", "_s", "_at")])


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _octets(m: Column) -> Column:
    """All dotted parts are 255 at most."""
    return F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.lpad(F.right(p, F.lit(3)), 3, "0") <= "255"))


def _luhn(m: Column) -> Column:
    n = F.length(_digits(m))
    return F.when(n.between(13, 19), F.call_function("luhn_check", _digits(m))).otherwise(False)


def _valid(kind: str, m: Column) -> Column:
    """Whether a match of a base rule counts."""
    return {"email": F.lit(True), "ip": _octets(m), "card": _luhn(m), "phone": F.length(_digits(m)).between(9, 15)}[kind]


# -- proposals and their features

def _count(m: Column, pattern: str) -> Column:
    return F.regexp_count(m, F.lit(pattern)).cast("double")


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


FEATURES = {
    "kind": lambda x: F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).cast("double"),
    "digits": lambda x: _count(x["m"], "[0-9]"),
    "letters": lambda x: _count(x["m"], "[A-Za-z]"),
    "spaces": lambda x: _count(x["m"], r"\x20"),
    "dots": lambda x: _count(x["m"], r"\."),
    "dashes": lambda x: _count(x["m"], "[-/]"),
    "brackets": lambda x: _count(x["m"], r"[()\[\]]"),
    "groups": lambda x: _count(x["m"], "[0-9]+"),
    "checksum": lambda x: _flag(_luhn(x["m"])),
    "octets": lambda x: _flag(x["m"].rlike(r"^[0-9]+(?:\.[0-9]+){3}$") & _octets(x["m"])),
    "joined": lambda x: _flag(x["before"].rlike(r"[\p{L}0-9]$")) + _flag(x["after"].rlike(r"^[\p{L}0-9]")),
    "quoted": lambda x: _flag(x["before"].rlike("[\"'=:]\\s?[\"']?$")),
    "cue": lambda x: _flag(x["before"].rlike(_CUES)),
    "digits_beside": lambda x: _count(F.concat(x["before"], x["after"]), "[0-9]"),
}
_CONTEXT = 24


def _holds_base(m: Column) -> Column:
    """Whether a proposal holds a span of a base rule."""
    hits = [F.exists(F.regexp_extract_all(m, F.lit(BASE[k]), F.lit(0)), lambda y: _valid(k, y)) for k in KINDS]
    return hits[0] | hits[1] | hits[2] | hits[3]


def _proposal(name: str, x: Column) -> Column:
    kind = F.lit(name) if name != "number" else (
        F.when(x["m"].rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), "ip").when(F.length(_digits(x["m"])).between(13, 19), "card").otherwise("phone"))
    return F.struct(kind.alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("m"), x["before"].alias("before"), x["after"].alias("after"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """``keep`` columns, id, base (kind, start, end) and proposals (kind, start, end, held, then ``FEATURES``) per row; null texts are empty."""
    df = docs.select(F.struct(*keep, F.col(id_col).alias("id")).alias("_own"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    df = _matches(df, BASE, _NEEDS, "_base_")
    df = _matches(df, PROPOSE, _MAYBE, "_maybe_", _CONTEXT)
    base = F.concat(*[F.transform(F.filter(f"_base_{k}", lambda x: _valid(k, x["m"])), lambda x: F.struct(
        F.lit(i).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))) for i, k in enumerate(KINDS)])
    df = df.select("_own", base.alias("base"), F.concat(*[F.transform(f"_maybe_{n}", lambda x: _proposal(n, x)) for n in PROPOSE]).alias("maybe"))
    seen = F.transform("maybe", lambda x: F.struct(
        (F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]) - 1).cast("int").alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        _holds_base(x["m"]).alias("held"), *[f(x).alias(f"f_{n}") for n, f in FEATURES.items()]))
    return df.select("_own.*", "base", seen.alias("proposals"))


# -- trees

def _node(node) -> tuple:
    """A fitted tree as (feature, threshold, left, right) or (value,)."""
    if node.numDescendants() == 0:
        return (node.prediction(),)
    split = node.split()
    return (split.featureIndex(), split.threshold(), _node(node.leftChild()), _node(node.rightChild()))


def _value(tree: tuple, x: Column) -> Column:
    if len(tree) == 1:
        return F.lit(float(tree[0]))
    at, threshold, left, right = tree
    return F.when(x[f"f_{list(FEATURES)[at]}"] <= float(threshold), _value(left, x)).otherwise(_value(right, x))


def score(model: Model, x: Column) -> Column:
    """Probability that a proposal is personal data, in steps of 1/1000."""
    margin = sum((F.lit(float(w)) * _value(t, x) for w, t in model.trees), F.lit(0.0))
    return F.round(1.0 / (1.0 + F.exp(-2.0 * margin)), 3)


def train(found: DataFrame, settings: Settings = Settings()) -> Model:
    """Trees and thresholds from ``spans``; without both positive and negative proposals the model adds nothing."""
    s = settings
    names = [f"f_{n}" for n in FEATURES]
    every = found.select(F.xxhash64("id", F.size("proposals"), "base").alias("of"), F.explode("proposals").alias("x")).select("of", "x.*")
    # the hash of row and place picks the quarter that calibrates; equal proposals are one row with their number, which the trees take as its weight
    parted = every.withColumn("part", F.when(F.pmod(F.xxhash64("of", "start", "end", F.lit("part")), F.lit(4)) == 0, 0).otherwise(1))
    counted = stored(parted.groupBy("part", "kind", "held", *names).agg(F.count(F.lit(1)).cast("double").alias("n")).withColumn("label", F.col("held").cast("double")), "proposals")
    fit = counted.filter("part <> 0")
    if len(fit.select("held").distinct().collect()) < 2:
        discard(counted)
        return Model()
    vector = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(maxIter=s.trees, maxDepth=s.depth, seed=s.seed, maxMemoryInMB=64, weightCol="n")
    fitted: GBTClassificationModel = trees.fit(vector.transform(fit).select("features", "label", "n"))
    model = Model([(w, _node(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True)])
    row = F.struct(*[F.col(f"f_{n}") for n in FEATURES])
    curve = (counted.filter("part = 0").withColumn("row", row).select("kind", score(model, F.col("row")).alias("p"), "label", "n")
             .groupBy("kind", "p").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect())  # at most a row per kind and thousandth
    for kind in range(len(KINDS)):
        good = n = 0.0
        for r in sorted((r for r in curve if r["kind"] == kind), key=lambda r: -r["p"]):
            good, n = good + r["good"], n + r["n"]
            if good >= s.precision * n:
                model.thresholds[kind] = r["p"]
    discard(counted)
    return model


def redactions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple = (), settings: Settings = Settings(), model: Model | None = None) -> DataFrame:
    """``keep`` columns, id, base and spans per row: arrays of (kind, start, end) by kind as in ``KINDS``, start; code points, ends exclusive.

    ``spans`` are all of ``base`` and what the model adds. Without a model one
    is fitted on the rows themselves. Null and empty texts hold nothing; rows
    without id and repeated rows are rows like any other; an empty table gives
    no rows.
    """
    found = stored(spans(docs, id_col, text_col, keep), "pii-spans")
    model = train(found, settings) if model is None else model
    base = F.array_sort("base")
    if not model.thresholds:
        return found.select(*keep, "id", base.alias("base"), base.alias("spans"))

    def added(x: Column) -> Column:
        least = F.lit(2.0)
        for k, t in model.thresholds.items():
            least = F.when(x["kind"] == k, F.lit(float(t))).otherwise(least)
        apart = ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        return F.when(x["held"], F.lit(False)).when(score(model, x) >= least, apart).otherwise(False)

    more = F.transform(F.filter("proposals", added), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.select(*keep, "id", base.alias("base"), F.array_sort(F.array_distinct(F.concat("base", more))).alias("spans"))


def spelled(found: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), model: Model | None = None) -> DataFrame:
    """(id, text) with every span replaced by its kind in square brackets; of overlapping spans the first one's kind stands."""
    docs = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = redactions(docs, id_col, "_text", keep=("_text",), settings=settings, model=model)
    names = F.array(*map(F.lit, KINDS))
    order = F.array_sort(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    cut = F.aggregate(order, start, lambda a, x: F.when(x["start"] >= a["at"], F.struct(
        x["end"].alias("at"), F.concat(a["parts"], F.array(F.substr(F.col("_text"), (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.concat(F.lit("["), F.get(names, x["kind"]), F.lit("]")))).alias("parts")))
        .otherwise(F.struct(F.greatest(a["at"], x["end"]).alias("at"), a["parts"].alias("parts"))))
    rest = F.substr(F.col("_text"), (F.col("cut.at") + 1).cast("int"))
    return found.select("id", "_text", cut.alias("cut")).select("id", F.concat(F.array_join("cut.parts", ""), rest).alias("text"))
