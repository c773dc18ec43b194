"""The operators against brute force, and on null, empty, tied, repeated and odd rows."""

import hashlib
import html
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from marketlake.llm import chat, components, decontaminate, embedding_dedup, langid, mixing, page_text, sharding, simhash, suffix_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, t string, fp long, size long"


def docs_of(spark, rows):
    """(doc_id, text, lang, source) rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 0, 1, "x", 2, 3) for r in rows], DOCS)


def words(rng, n, size=400):
    return " ".join(f"w{k}" for k in rng.integers(0, size, n))


ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n", "en", "a"), (None, "one two", None, "b"), (4, "a b c d e f", "en", None),
       (4, "a b c d e f", "en", None), (5, "1234 !!", "de", "b")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, [*ODD, (6, "lang " * 30_000, "en", "a")])


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, []) if False else spark.createDataFrame([], DOCS)


# -- components

def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (None, 3), (300, 301), (301, 300)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- SimHash

def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_matches_definition_and_spark_hash(spark):
    rng = np.random.default_rng(1)
    for t in (None, "", " ", "ÉA b", "A b\tc\nD", "a b c d e", words(rng, 300), "x y z"):
        assert simhash.fingerprint(t) == slow_fingerprint(t)
    assert spark.range(1).select(F.xxhash64(F.lit("a é"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest("a é".encode(), 42)


def test_groups_match_all_pairs(spark):
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = {int(s) for s in seeds} | {0}
    for s in seeds[:6]:                       # dense groups and chains of near copies
        f = int(s)
        for _ in range(60):
            f2 = f
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                f2 ^= 1 << int(b)
            fps.add(f2)
            f = f2 if rng.random() < 0.2 else f
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if ((x ^ y) & ((1 << 64) - 1)).bit_count() <= 4:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    want = {f: find(f) for f in fps}
    for blocks in (None, 7):
        found = dict(simhash.fingerprint_groups(spark.createDataFrame([(f,) for f in fps], "fp long"), 4, blocks).collect())
        assert {f: found.get(f, f) for f in fps} == want


def test_near_duplicates_on_odd_rows(spark, odd, empty):
    got = {(r["id"], r["fp"], r["component"]) for r in simhash.near_duplicates(odd).collect()}
    assert {(1, 0, 1), (2, 0, 1), (3, 0, 1)} <= got and simhash.near_duplicates(odd).count() == odd.count()
    kept = simhash.deduplicate(odd).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 4, 5, 6] and any(r["doc_id"] is None for r in kept)
    assert simhash.deduplicate(odd).columns == odd.columns
    assert simhash.near_duplicates(empty).count() == 0


# -- language ID

def test_viterbi_matches_plain_recursion():
    rng = np.random.default_rng(3)

    def plain(s, penalty):
        v, back = s[0].copy(), []
        for w in s[1:]:
            back.append(np.where(v >= v.max() - penalty, np.arange(len(v)), v.argmax()))
            v = np.maximum(v, v.max() - penalty) + w
        path = [int(v.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        return path[::-1]
    texts = [-rng.exponential(2, (n, 3)) for n in (1, 2, 127, 128, 129, 700)]
    assert [list(p) for p in langid.viterbi(texts, 3.0)] == [plain(s, 3.0) for s in texts]


def test_languages_spans_and_odd_rows(spark, odd, empty):
    en, ru, fr = "the cat sat on the mat and the dog ran", "кошка сидела на ковре и собака бежала", "le chat est sur la table et le chien court"
    train = docs_of(spark, [(i, t, lang, "s") for i, (t, lang) in enumerate([(en, "en"), (ru, "ru"), (fr, "fr")] * 20)])
    model = langid.train(train, penalty=4.0)
    mixed = f"{en} {en}. {ru}"
    rows = docs_of(spark, [(1, mixed, "fr", "s"), (2, fr, "ru", "s"), (3, "собака", "en", "s")])
    got = {r["id"]: r for r in langid.label(rows, model).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "ru"] and mixed[got[1]["spans"][1]["start"]:] == ru
    assert got[1]["lang_pred"] == "en" and got[2]["lang_pred"] == "fr" and got[3]["lang_pred"] == "ru"
    strange = {(r["id"], r["lang_pred"]) for r in langid.label(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (5, "und")} <= strange
    assert langid.label(rows, langid.train(empty)).filter("lang_pred <> 'und'").count() == 0


def test_two_runs_beside_the_best_single_language():
    class Words(dict):
        model = langid.Model(["a", "b", "c"], None, None, 12.0)
        scores = np.array([[-1.2, 0, -20], [-1.2, -20, 0]])
        letters = np.array([2, 2])

        def score(self):
            pass

    (lang, score, spans), = langid._label_piece([" ".join(["bx"] * 8 + ["cx"] * 8)], Words(bx=0, cx=1))
    assert [x[2] for x in spans] == ["b", "c"] and lang == "b" and score == 0.5


def test_labels_beyond_the_model_bound_are_labelled_by_the_others(spark):
    rows = [(i, f"the dog and the cat {i}", "en", "s") for i in range(6)] + [(10 + i, f"der Hund und die Katze {i}", "de", "s") for i in range(4)]
    rows += [(100 + i, f"word {i}", f"x{i}", "s") for i in range(300)]
    docs = docs_of(spark, rows)
    assert langid.train(docs, max_languages=2).languages == ["de", "en"]
    model = langid.train(docs)
    assert len(model.languages) == 256 and {"de", "en"} < set(model.languages)
    got = langid.label(docs, langid.train(docs, max_languages=2)).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got} == {"de", "en"}


def test_held_out_rule(spark):
    got = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


# -- sharding

def test_shards_match_prefix_sums(spark, empty):
    rng = np.random.default_rng(4)
    rows = [(i, words(rng, int(rng.integers(0, 60))), "en", "s") for i in range(500)] + [(None, None, None, None), (7, "again", "en", "s")]
    got = sharding.shard(docs_of(spark, rows), 24).collect()
    key = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    sizes = {}
    for i, t, *_ in rows:
        sizes[key(i)] = sizes.get(key(i), 0) + len((t or "").encode()) + 8
    total, before, want = sum(sizes.values()), 0, {}
    for k in sorted(sizes):
        want[k] = min(23, (2 * before + sizes[k]) * 24 // (2 * total))
        before += sizes[k]
    assert all(r["shard"] == want[key(r["id"])] for r in got) and len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    texts = {(i, zlib.crc32((t or "").encode())) for i, t, *_ in rows}
    assert {(r["id"], r["text_crc32"]) for r in got} == texts
    assert sharding.shard(empty, 24).count() == 0


def test_shards_of_rows_without_and_with_repeated_ids_are_even(spark):
    rng = np.random.default_rng(14)
    rows = [(None if i % 5 < 2 else i, words(rng, int(rng.integers(1, 60))), "en", "s") for i in range(2000)]
    rows += [(7, "the same row", "en", "s")] * 1500
    got = sharding.shard(docs_of(spark, rows), 24).collect()
    count = lambda x: sorted((str(i), z, n) for (i, z), n in Counter(x).items())
    assert count((r["id"], r["size"]) for r in got) == count((i, len(t.encode()) + 8) for i, t, *_ in rows)
    size, slots = Counter(), {}
    for r in got:
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    mean = sum(size.values()) / 24
    assert len(size) == 24 and max(abs(n - mean) for n in size.values()) < 0.05 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# -- decontamination

ITEM = "A train leaves Boston with 48 passengers and travels 120 miles to Albany before it stops for 30 minutes near the river bank"


def test_templates_catch_new_numbers_but_not_inconsistent_ones(spark, odd, empty):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "too short"), (5, "Each of 5 boxes holds 5 pens and 7 caps so that 5 more pens fit into 7 rows")], "item_id long, text string")
    other = ITEM.replace("48", "51").replace("120", "99").replace("Boston", "Denver")
    five = "Each of 8 boxes holds 8 pens and 3 caps so that 8 more pens fit into 3 rows"
    rows = [(10, f"Some words first. {ITEM}. And more.", "en", "s"), (11, f"before this {other} and after", "en", "s"), (12, ITEM.upper(), "en", "s"),
            (13, "A train of thought leaves me with nothing but words about a river and a bank", "en", "s"), (14, five, "en", "s"),
            (15, "Each of 8 boxes holds 9 pens and 3 caps so that 2 more pens fit into 6 rows", "en", "s")]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.matches(docs_of(spark, rows), bench).collect()}
    assert got[(10, 1)] == "verbatim" and got[(11, 1)] == "reparameterised" and got[(14, 5)] == "reparameterised"
    assert (15, 5) not in got and not any(d == 13 for d, _ in got)
    assert {r["doc_id"] for r in decontaminate.clean(docs_of(spark, rows), bench).collect()} >= {13, 15}
    assert decontaminate.matches(odd, bench).count() == 0 and decontaminate.matches(empty, bench).count() == 0
    assert decontaminate.clean(odd, bench.limit(0)).count() == odd.count()


def kinds(spark, docs, items):
    """{(document, item): kind} of texts numbered from 0."""
    rows = docs_of(spark, [(i, t, "en", "s") for i, t in enumerate(docs)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.matches(rows, bench).collect()}


def test_names_at_sentence_starts_and_with_inner_capitals(spark):
    items = ["Alice has 5 apples. Bob gives her 3. How many apples does Alice have?",
             "How much will McDonald pay when O'Brien sells him 4 of the old red chairs for the garden"]
    docs = ["Some say so. Carol has 7 apples. Dan gives her 2. How many apples does Carol have? Nobody knows.",
            "Tell me how much will DeVito pay when MacLeod sells him 9 of the old red chairs for the garden",
            "Tell me how much will Smith pay when JONES sells him 9 of the old red chairs for the garden",
            "Carol has many apples. Dan gives her a pear. How many pears does Carol want?"]
    assert kinds(spark, docs, items) == {(0, 0): "reparameterised", (1, 1): "reparameterised", (2, 1): "reparameterised"}


def test_conflicting_slots_drop_only_their_windows(spark):
    item = ("The old baker sells 48 fresh loaves every single morning before the church bell rings and the village children "
            "run along the narrow lane to school while the miller brings 48 new sacks of flour")
    fruit = ("Put 2 ripe apples from the green basket near the old kitchen door into the wooden bowl and then also "
             "add about 2 yellow pears that the neighbour left for us")
    docs = [item.replace("48 fresh", "51 fresh"), fruit.replace("2 ripe", "3 ripe").replace("2 yellow", "5 yellow"), item]
    assert kinds(spark, docs, [item, fruit]) == {(0, 0): "reparameterised", (1, 1): "reparameterised", (2, 0): "verbatim"}


def test_largest_agreeing_set_of_windows():
    windows = [{"g": 1, "vals": [5, 7], "got": [8, 3]}, {"g": 2, "vals": [5], "got": [8]}, {"g": 3, "vals": [5], "got": [9]},
               {"g": 4, "vals": [5, 5], "got": [8, 9]}, {"g": 5, "vals": [5], "got": [5]}, {"g": 6, "vals": [], "got": []}]
    assert decontaminate._agreeing(windows) == [1, 2, 5, 6]
    many = [{"g": 10 * v + k, "vals": [v], "got": [100 + min(k, 1)]} for v in range(12) for k in range(3)]
    assert decontaminate._agreeing(many) == sorted(10 * v + k for v in range(12) for k in (1, 2))


def test_agreeing_windows_against_all_choices():
    rng = np.random.default_rng(5)
    for _ in range(150):
        maps = [(int(rng.integers(0, 9)), {int(v): int(rng.integers(10, 13)) for v in rng.choice(5, size=int(rng.integers(0, 4)), replace=False)}) for _ in range(9)]
        best = max(len({maps[i][0] for i in pick}) for n in range(10) for pick in combinations(range(9), n)
                   if all(maps[a][1].get(v, x) == x for a in pick for b in pick for v, x in maps[b][1].items()))
        got = decontaminate._largest(maps)
        assert len(got) == best


def test_long_chains_of_conflicts_are_settled_exactly():
    # neighbours share a value and disagree on it: every other window can stay
    chain = [{"g": i, "vals": [1000 + i, 1001 + i], "got": [2 * i, 2 * i + 1]} for i in range(301)]
    assert len(decontaminate._agreeing(chain)) == 151


def test_clean_judges_rows_by_text_whatever_their_ids(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(None, f"no id. {ITEM}.", "en", "s"), (5, f"Here: {ITEM}", "en", "s"), (5, "a clean text with the id of another", "en", "s"), (None, None, "en", "s"), (6, "", "en", "s")]
    docs = docs_of(spark, rows).withColumn("contaminated_text", F.lit(1))
    assert sorted((r["doc_id"], r["text"]) for r in decontaminate.clean(docs, bench).collect() if r["doc_id"]) == [(5, rows[2][1]), (6, "")]
    assert decontaminate.clean(docs, bench).filter("doc_id IS NULL").collect()[0]["text"] is None
    named = docs_of(spark, rows[1:2]).withColumn("doc_id", F.lit("doc-a"))
    assert [r["doc_id"] for r in decontaminate.matches(named, bench).collect()] == ["doc-a"]


def test_numeric_and_short_items_match_verbatim(spark):
    items = ["Calculate 12 + 45 - 3 * 7 / 2", "Why is grass green?", "3 4 5 6 7 8 9 10 11 12 13 14"]
    docs = [f"Here it is: {items[0]} and so on", f"He asked: {items[1]} Nobody knew.", f"x {items[2]} y",
            "Here it is: Calculate 13 + 45 - 3 * 7 / 2 and so on", "Why is snow green?", "3 4 5 6 8 8 9 10 11 13 13 14", ""]
    assert kinds(spark, docs, items) == {(0, 0): "verbatim", (1, 1): "verbatim", (2, 2): "verbatim"}


# -- pages

PAGE = ("<html><head><title>t</title><script>var a='<p>x</p>'</script></head><body><header>Top</header><nav><ul><li>Menu</li></ul></nav>"
        "<div class='cookie-notice'>We use</div><main><h1>Head {n}</h1><p><b>Bold {n}.<br><p>Text &amp; more\n\n {n}<p>Shared line</p></main>"
        "<aside>Side</aside><section id='comments'><p>Reader {n}</p></section><form><p>Mail</p></form><footer>&copy;</footer>")


def test_pages_of_a_host(spark):
    rows = [(n, f"http://h.example/{n}", PAGE.format(n=n)) for n in range(6)] + [(90, None, None), (91, "odd", ""), (92, "http://x.example/", "<p>no <i>end"), (0, "http://h.example/0", PAGE.format(n=0))]
    got = {r["id"]: r["text"] for r in page_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(6):
        assert got[n] == f"Head {n}\nBold {n}.\nText & more {n}\nShared line"
    assert got[90] == got[91] == "" and got[92] == "no end"
    assert page_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_title_and_lead_outside_the_body_element_stay(spark):
    lead = ("<html><body><nav>Menu</nav><div class=promoted-by>Made by X</div><article><h1>Head {n}</h1><div class=lead>Lead {n}</div><div class=body><p>"
            + "long text {n} " * 60 + "</p></div></article></body></html>")
    one = "<html><head></head><body><div class=top></div><div class=main-text><h1>Title {n}</h1><p>" + "one paragraph {n} " * 60 + "</p></div></body></html>"
    rows = [(10 * k + n, f"http://h{k}.example/{n}", page.replace("{n}", str(n))) for k, page in enumerate((lead, one)) for n in range(5)]
    got = {r["id"]: r["text"] for r in page_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(5):
        assert got[n] == f"Head {n}\nLead {n}\n" + " ".join([f"long text {n}"] * 60)
        assert got[10 + n] == f"Title {n}\n" + " ".join([f"one paragraph {n}"] * 60)


def test_walk_decodes_and_closes():
    assert page_text.extract_blocks("<body><div><p>a<p>b</div>c&lt;d<!-- x --><br>e<hr>f", None) == ["a", "b", "c<d e", "f"]
    assert html.unescape("&amp;") == "&"


# -- embeddings

def test_links_match_all_pairs(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((400, 16))
    near = base[:60] + rng.standard_normal((60, 16)) * 0.05
    x = np.concatenate([base, near, np.repeat(base[:1], 40, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None] * 8), (904, [1.0, 2.0]), (905, []), (0, x[0].tolist())]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), embedding_dedup.Settings(block=64)).collect()
    fine = [(i, np.array(v)) for i, v in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    u = np.stack([v / np.linalg.norm(v) for _, v in fine])
    hit = u @ u.T >= 0.95
    want = sorted((i, int(h.sum()) - 1) for (i, _), h in zip(fine, hit))
    assert sorted((r["id"], r["links"]) for r in got if r["id"] < 900) == want
    label = np.arange(len(fine))
    for _ in range(len(fine)):
        label = np.array([label[h].min() for h in hit])
    assert sorted((r["id"], r["component"]) for r in got if r["id"] < 900) == sorted((fine[k][0], fine[label[k]][0]) for k in range(len(fine)))
    assert sorted((r["id"], r["links"], r["component"]) for r in got if r["id"] >= 900) == [(i, 0, i) for i in range(900, 906)]


@pytest.mark.parametrize("dim, rank", [(256, 4), (128, 16)])
def test_links_of_low_rank_vectors(spark, dim, rank):
    rng = np.random.default_rng(dim)
    plane = np.linalg.qr(rng.standard_normal((dim, rank)))[0].T
    base = rng.standard_normal((1200, rank))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.standard_normal((1200, rank))
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(0.951, 0.97, (1200, 1))
    x = np.concatenate([base, cosine * base + np.sqrt(1 - cosine ** 2) * aside]) @ plane
    got = embedding_dedup.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    hit = x @ x.T >= 0.95
    assert sorted((r["id"], r["links"]) for r in got) == [(i, int(h.sum()) - 1) for i, h in enumerate(hit)]


def test_vectors_travel_once_to_each_group_of_cells(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    x[1500:] = x[:1500] + rng.standard_normal((1500, 24)).astype(np.float32) * 0.05
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vid long, v array<float>").withColumn("n", F.lit(1).cast("long"))
    sent = embedding_dedup._links_of_dimension(rows, embedding_dedup.Settings(block=500))
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    centres = embedding_dedup.fit_centres(u, 55, 6)
    groups = embedding_dedup.group_cells(centres, np.full(55, 1 / 55), 1 / 6)
    assert 6 <= groups.max() + 1 <= 12 and np.bincount(groups).max() <= 55 / 6
    routed = list(embedding_dedup._route(centres, groups, embedding_dedup.Settings(), np.float32)(iter([rows.toPandas()])))
    got = pd.concat(routed)
    cells = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in got["cells"]]), axis=1)[:, :55]
    assert not got.duplicated(["vid", "grp"]).any() and got["home"].sum() == 3000 and {len(v) for v in got["v"]} == {24 * 4}
    per_vector = got.groupby("vid")["grp"].count()
    assert per_vector.max() <= groups.max() + 1 and len(got) < cells[got["home"].to_numpy()].sum()  # a row per cell before
    found = sent.groupBy("vid").agg(F.sum("links").alias("links")).collect()
    assert sorted((r["vid"], r["links"]) for r in found) == [(i, int(h.sum()) - 1) for i, h in enumerate(u @ u.T >= 0.95)]


def test_links_of_a_task_are_united_in_batches(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.repeat(rng.standard_normal((3, 16)), 300, axis=0) + rng.standard_normal((900, 16)) * 0.01
    chain = [(u, u + 1) for u in range(50)]
    least = np.arange(60)
    for at in range(49, -1, -1):   # the smallest comes last
        embedding_dedup._unite(least, np.array([chain[at][0]]), np.array([chain[at][1]]))
    assert least.tolist() == [0] * 51 + list(range(51, 60))
    monkeypatch.setattr(embedding_dedup, "AT_ONCE", 512)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted((r["id"], r["links"], r["component"]) for r in embedding_dedup.near_vectors(frame).collect())
    assert got == [(i, 299, i // 300 * 300) for i in range(900)]


# -- chat

def test_fold_and_round_trip(spark):
    log = [(1, 1, 1, "start", "user", "hi"), (1, 2, 1, "delta", None, " there"), (1, 3, 2, "start", "assistant", ""), (1, 4, 2, "delta", None, "bad"),
           (1, 5, 2, "regenerate", None, None), (1, 6, 2, "delta", None, "good </s>"), (1, 7, 2, "delta", None, "<|im_end|>"), (1, 8, 1, "edit", None, "hello"),
           (1, 9, 3, "start", "user", "gone"), (1, 10, 3, "delete", None, None), (2, 1, 1, "start", "a<|im_sep|>b", r"[\INST] [INST] [/INST] \<s>")]
    events = spark.createDataFrame(log, "conv long, seq long, msg long, kind string, role string, text string")
    got = {r["conv"]: r for r in chat.read_back(chat.render(chat.fold(events))).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "hello"), ("assistant", "good </s><|im_end|>")]
    assert got[1]["loss_text"] == "good </s><|im_end|>" and got[1]["formatted"].count(chat.END) == 2
    assert [tuple(t) for t in got[2]["turns"]] == [("a<|im_sep|>b", r"[\INST] [INST] [/INST] \<s>")] and got[2]["loss_text"] == ""


def test_turns_with_ties_nulls_and_repeats(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", "x"), (None, 1, None, "y"), (1, 2, "assistant", "é" * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv"]: [tuple(t) for t in r["turns"]] for r in chat.read_back(chat.render(chat.fold(chat.log_of_turns(turns)))).collect()}
    assert got == {1: [("assistant", "x"), ("user", ""), ("user", ""), ("assistant", "é" * 50_000)], None: [("", "y")]}
    assert chat.render(chat.fold(chat.log_of_turns(turns.limit(0)))).count() == 0


# -- suffix dedup

def slow_removed(texts, length=400):
    n = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            n[t[p:p + length]] = n.get(t[p:p + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if n[t[p:p + length]] > 1:
                gone[p:p + length] = True
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()),
                    bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def test_removed_bytes_match_definition(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 3000)   # long texts are cut into overlapping pieces
    rng = np.random.default_rng(8)
    passage = [words(rng, 150), words(rng, 300), "é" * 350]
    texts = [None, "", "short", words(rng, 2000), "ab" * 600, "ab" * 500 + "c"]
    for i in range(40):
        t = words(rng, int(rng.integers(0, 300))) + passage[i % 3] + words(rng, int(rng.integers(0, 200)))
        cut = int(rng.integers(0, len(t)))
        texts += [t, t[:cut] + "#" + t[cut:]] if i % 4 == 0 else [t]
    texts += [texts[10], texts[3] + texts[3][:900]]
    rows = [(None if i == 12 else i, t, None, None) for i, t in enumerate(texts)]
    got = suffix_dedup.remove_repeats(docs_of(spark, rows)).collect()
    have = sorted((r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in got)
    assert have == sorted(slow_removed([(t or "").encode() for t in texts]))
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


# -- toxicity

def test_grades_follow_wording(spark, odd, empty):
    rng = np.random.default_rng(9)
    rows, marks = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, words(rng, 40) + (" nasty vile" * (1 + i % 4) if bad else ""), "en", "s"))
        marks.append((i, 1, int(bad)))
    docs, labels = docs_of(spark, rows), spark.createDataFrame([*marks, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, toxicity.Settings(steps=200))
    assert list(model.cuts) == sorted(model.cuts)
    got = {r["id"]: r for r in toxicity.grade(docs, model).collect()}
    assert all(got[i]["toxic"] == bool(t) for i, _, t in marks)
    assert got[3]["severity"] > got[0]["severity"] > got[1]["severity"]
    assert toxicity.grade(odd, model).filter("toxic").count() == 0 and toxicity.grade(odd, model).count() == odd.count()
    none = toxicity.train(empty, labels)
    assert toxicity.grade(docs, none).filter("toxic").count() == 0


# -- mixing

def test_targets_stop_at_the_cap_and_reshare(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 400, None: 100}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    w = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    full, left = {}, dict(w)
    while True:
        per = (sum(sizes.values()) - sum(full.values())) / sum(left.values())
        over = [s for s in left if left[s] * per > 3 * sizes[s]]
        if not over:
            break
        full |= {s: 3 * sizes[s] for s in over}
        left = {s: x for s, x in left.items() if s not in over}
    assert got == pytest.approx(full | {s: x * per for s, x in left.items()})


def test_mix_comes_near_its_targets(spark, odd, empty):
    rng = np.random.default_rng(10)
    docs = docs_of(spark, [(i, words(rng, int(rng.integers(0, 50))), "en", ["big", "big", "big", "x", None][i % 5]) for i in range(2000)])
    rows = mixing.mix(docs, mixing.word_count()).collect()
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 25 and all(r["taken"] <= 3 * r["size"] for r in own)
    assert mixing.mixed_rows(docs, mixing.word_count()).columns == docs.columns
    assert mixing.mixed_rows(docs, mixing.word_count()).count() == sum(r["copies"] for r in rows)
    assert mixing.mix(odd, mixing.word_count()).count() == odd.count() and mixing.mix(empty, mixing.word_count()).count() == 0


def test_rows_of_one_id_are_cut_by_size_and_count(spark, tmp_path):
    """A source of rows without id, most of them equal: taken words meet the target, equal to a running sum over sorted rows."""
    rng = np.random.default_rng(3)
    rows = [(None, " ".join(["w"] * int(k)), None, "a") for k in [7] * 900 + rng.integers(0, 40, 300).tolist()]
    rows += [(5, " ".join(["w"] * int(k)), None, "b") for k in [3] * 400 + [0] * 50] + [(i, "x y z", None, "c") for i in range(2000)]
    got = mixing.mix(docs_of(spark, rows), mixing.word_count()).collect()
    assert len(got) == len(rows)
    for source in "abc":
        mine = sorted((r for r in got if r["source"] == source), key=lambda r: (hashlib.md5(f"{'' if r['id'] is None else r['id']}:mix".encode()).hexdigest(), r["size"]))
        total, goal = mine[0]["source_size"], mine[0]["target"]
        epochs = int(goal // total)
        run, want = 0, []
        for r in mine:
            run += r["size"]
            want.append((r["id"], r["size"], epochs + (goal - epochs * total > 0 and run - r["size"] / 2 <= goal - epochs * total)))
        assert sorted(want, key=str) == sorted(((r["id"], r["size"], r["copies"]) for r in mine), key=str)
        assert abs(sum(r["taken"] for r in mine) - goal) <= 20


# -- toxicity of small classes

def test_evidence_is_the_root_of_the_likelihood_ratio():
    bad, good = np.array([5.0, 0, 3, 11, 2]), np.array([0.0, 40, 60, 0, 38])
    got = toxicity.evidence(bad, good, 11.0, 200.0)
    for x, y, z in zip(bad, good, got):
        cells = [(x, 11, x + y), (y, 200, x + y), (11 - x, 11, 211 - x - y), (200 - y, 200, 211 - x - y)]
        g = 2 * sum(o * np.log(o / (n * total / 211)) for o, n, total in cells if o)
        assert np.isclose(abs(z), np.sqrt(max(g, 0))) and (z > 0) == (x / 11 > y / 200)


def test_few_toxic_documents_still_train_a_model(spark):
    rng = np.random.default_rng(2)
    rows = [(i, words(rng, 60) + (" gremlin vile" if i < 6 else ""), "en", "s") for i in range(90)]
    docs, labels = docs_of(spark, rows), spark.createDataFrame([(i, 0, int(i < 6)) for i in range(90)], "doc_id long, quality int, toxic int")
    got = toxicity.grade(docs, toxicity.train(docs, labels)).collect()
    assert {r["id"] for r in got if r["toxic"]} == set(range(6)) and all(r["fitted"] for r in got)
    untold = toxicity.grade(docs, toxicity.train(docs, labels.filter("toxic = 0"))).collect()
    assert not any(r["fitted"] or r["toxic"] for r in untold) and len(untold) == 90
