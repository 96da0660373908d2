import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldsieve.llm import components as cc
from fieldsieve.llm import jaccard_join, labelled, mixing, quality, simhash, toxicity
from fieldsieve.llm.jaccard_join import Similarity

WORDS = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "ion", "ou", "ent", "er")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


# --- SimHash ----------------------------------------------------------------------------------


def test_edited_texts_and_edge_cases(spark, edge, nothing):
    rows = simhash.edited_fingerprints(edge, n_ranges=3).collect()
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    docs = sorted(((r["doc_id"], r["text"] or "") for r in edge.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(rows) == len(docs)
    by_text = {}
    shas = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows)
    wanted = Counter()
    for k, (i, text) in enumerate(docs):
        half = len(text) // 2
        edited = text[: len(text) - half] + docs[(k + 1) % len(docs)][1][:half]
        wanted[i, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert shas == wanted
    for r in sorted(rows, key=key):
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_text[1] == by_text[5] and by_text[2] == by_text[3] == by_text[8] == {"0" * 32}
    assert simhash.edited_fingerprints(nothing).count() == 0
    alone = simhash.edited_fingerprints(edge.where("doc_id = 1")).first()
    assert alone["near_next"] == 1.0


def test_fingerprint_by_brute_force(spark):
    rng = random.Random(1)
    texts = [(i, sentence(rng, 40)) for i in range(20)]
    df = spark.createDataFrame(texts, "k long, t string")
    got = {r["k"]: (r["f0"], r["f1"]) for r in simhash.fingerprints(df, ["k"], "t").collect()}
    terms = {}
    for k, t in texts:
        w = t.split(" ")
        terms[k] = list(zip(w, [*w[1:], None]))
    pairs = sorted({p for v in terms.values() for p in v}, key=str)
    hashed = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h"))
    h = {(r["a"], r["b"]): r["h"] for r in hashed.withColumn("g", F.xxhash64("h")).collect()}
    g = {(r["a"], r["b"]): r["g"] for r in hashed.withColumn("g", F.xxhash64("h")).collect()}
    for k, v in terms.items():
        for half, table in enumerate((h, g)):
            bits = 0
            for j in range(64):
                vote = sum((1 if (table[p] >> j) & 1 else -1) * (len(p[0]) + len(p[1] or "")) for p in v)
                bits |= (vote > 0) << j
            assert got[k][half] % (1 << 64) == bits


def test_half_edited_is_nearer_than_another_text(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, sentence(rng, 200)) for i in range(50)], "doc_id long, text string")
    rows = simhash.edited_fingerprints(docs).collect()
    assert all(r["near_edited"] > r["near_next"] for r in rows)


@pytest.mark.parametrize("blocks", [None, 6])
def test_radius_search_finds_every_pair(spark, blocks):
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(30)]
    values = list(base)
    for b in base:
        for _ in range(4):
            for place in rng.sample(range(128), rng.randint(0, 5)):
                b ^= 1 << place
            values.append(b)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(v >> 64), signed(v & ((1 << 64) - 1))) for v in values] + [(None, 1)]
    df = spark.createDataFrame(rows, "f0 long, f1 long")
    got = simhash.within_radius(df, df, 3, blocks).collect()
    found = {(r["q0"], r["q1"], r["f0"], r["f1"]): r["distance"] for r in got}
    distinct = set(values)
    wanted = {
        (signed(a >> 64), signed(a & ((1 << 64) - 1)), signed(b >> 64), signed(b & ((1 << 64) - 1))): (a ^ b).bit_count()
        for a in distinct for b in distinct if 0 < (a ^ b).bit_count() <= 3
    }
    assert found == wanted and len(got) == len(found)
    with pytest.raises(ValueError):
        simhash.within_radius(df, df, 3, 3)


# --- Jaccard join -----------------------------------------------------------------------------

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = BLANK.findall((text or "").translate(LOWER))
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute_components(docs, n, percent):
    sets = {i: shingles(t, n) for i, t in docs}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    """Copies, near copies at every distance from the threshold, short texts, shared passages."""
    rng = random.Random(seed)
    passage = sentence(rng, 25)
    texts = [sentence(rng, rng.choice([1, 2, 3, 5, 9, 12, 20, 60])) for _ in range(60)]
    texts += [passage + " " + sentence(rng, rng.randint(1, 12)) for _ in range(60)]
    for base in [sentence(rng, n) for n in (6, 11, 14, 22, 45, 90)]:
        for _ in range(25):
            words = base.split()
            for _ in range(rng.randint(0, max(1, len(words) // 9))):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            if rng.random() < 0.5:
                words.append(rng.choice(WORDS))
            texts.append(" ".join(words))
    texts += rng.sample(texts, 20) + ["", "  ", None]
    return list(enumerate(texts))


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("often", [False, True])
def test_components_by_brute_force(spark, monkeypatch, words, percent, often):
    docs = corpus(words)
    if often:  # every token is frequent: only combinations and the key space of small sets are left
        monkeypatch.setattr(jaccard_join, "frequent_cells", lambda d, w: b"\xff" * (1 << (jaccard_join.CELL_BITS - 3)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = jaccard_join.similar_components(df, Similarity(words, percent)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(docs, words, percent)


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(8)
    for s in (Similarity(3, 90), Similarity(5, 80)):
        for n in [*range(1, 40), 60, 70, 80, 100, 200, 600]:
            for _ in range(6):
                x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                y = x
                while True:
                    z = y.copy()
                    z[rng.integers(len(z))] = rng.integers(0, 1 << 63)
                    z = np.unique(z[: len(z) - int(rng.integers(0, 2))])
                    common = len(np.intersect1d(x, z))
                    if not len(z) or 100 * common < s.percent * (len(x) + len(z) - common):
                        break
                    y = z
                frequent = rng.random(1 << jaccard_join.CELL_BITS) < rng.choice([0, 0.5, 0.9, 1])
                (a, spare_a), (b, spare_b) = (jaccard_join.set_keys(t, frequent, s) for t in (x, y))
                held = lambda k: (k % np.uint64(7), k)  # noqa: E731 - any order common to all sets
                a, b = (sorted(k, key=held)[: len(k) - gone] for k, gone in ((a, spare_a), (b, spare_b)))
                assert set(a) & set(b), (n, len(x), len(y))
                differ = int(np.unpackbits((jaccard_join.sketch(x) ^ jaccard_join.sketch(y)).view(np.uint8)).sum())
                assert differ <= len(x) + len(y) - 2 * len(np.intersect1d(x, y))


def test_word_rules():
    texts = ["A  b\tC\x0bd", "a b c d", "É b c", "é b c", "a\x85b c d", None, "", "a b", "a c"]
    sets = [tuple(s) for s in jaccard_join.token_sets(texts, 3)]
    assert sets[0] == sets[1] and sets[2] != sets[3] and len(sets[4]) == 1
    assert sets[5] == sets[6] == () and sets[7] != sets[8] and len(sets[7]) == 1


def test_join_edge_cases(spark, edge, nothing):
    rows = jaccard_join.similar_components(edge).collect()
    assert len(rows) == edge.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["component_id"] == by_id[5]["component_id"] == 1
    assert by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == by_id[8]["n_shingles"] == 0
    assert by_id[2]["component_id"] == 2 and by_id[3]["component_id"] == 3
    assert by_id[None]["component_id"] is None and by_id[6]["n_shingles"] == 1
    assert jaccard_join.similar_components(nothing).count() == 0


def test_one_of_each_group_stays_by_row(spark):
    rng = random.Random(3)
    base = sentence(rng, 60)
    near, own, other = base + " end", sentence(rng, 50), sentence(rng, 40)
    rows = [(2, base), (2, own), (1, near), (None, near), (None, base), (None, other), (5, None), (6, ""), (2, own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.lit("x"))
    kept = jaccard_join.without_copies(docs, Similarity(5, 80))
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"]), r["text_key"]) for r in kept.collect())
    wanted = [(1, near), (2, own), (None, other), (5, None), (6, "")]
    assert got == sorted((str(a), str(b), "x") for a, b in wanted)


def test_documents_of_a_mixture_by_row(spark):
    rows = [(None, "a b c", "en", "src0"), (None, "d e f", "en", "src0"), (7, "g h", "en", "src0"),
            (7, "i j", "en", "src0"), (7, "i j", "en", "src0"), (8, "", None, "src1"), (8, None, None, "src1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("row_key", F.lit(1)).withColumn("copies", F.lit(2))
    for share in ((1, 2), (1, 1), (2, 1)):
        def mixed(keyed, key):
            placed = keyed.withColumn("domain", F.lit("d"))
            return mixing.mix(placed, {}, share, 2, 3, carried=(key,))

        taken = mixing.mix(docs.withColumn("domain", F.lit("d")), {}, share, 2, 3)
        got = mixing.mixed_documents(docs, mixed)
        assert got.columns == docs.columns
        assert got.count() == taken.agg(F.sum("copies")).first()[0]
        if share == (2, 1):
            assert all(n == 2 * rows.count(r) for r, n in Counter(tuple(r)[:4] for r in got.collect()).items())


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7000, 7000), (None, 1)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["label"] for r in cc.components(df).collect()}
    assert all(got[i] == 0 for i in range(101)) and all(got[1000 + i] == 1000 for i in range(50))
    assert got[7000] == 7000
    assert cc.components(df.where("false")).count() == 0


def test_whole_join_counts_every_link(spark, edge, nothing, monkeypatch):
    monkeypatch.setattr(jaccard_join, "KEY_PART", 4)
    rng, texts = random.Random(8), []
    for _ in range(3):
        base = sentence(rng, 60).split()
        for k in range(14):
            texts.append(" ".join(base[:-1] + [f"end{k % 9}"]) if k else " ".join(base))
    texts += ["", None, "one two", sentence(rng, 40)]
    s = Similarity(words=3, percent=90)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(t.tolist()) for t in jaccard_join.token_sets(texts, 3)]
    near = lambda a, b: a and b and a != b and 100 * len(a & b) >= 90 * len(a | b)
    for r in jaccard_join.similar_links(docs, s).collect():
        own = sets[r["doc_id"]]
        wanted = [b for b in sets if near(own, b)]
        assert (r["linked_rows"], r["linked_sets"]) == (len(wanted), len(set(wanted)))
        assert r["copies"] == (sets.count(own) - 1 if own else 0)
    assert jaccard_join.similar_links(edge, s).count() == edge.count()
    assert jaccard_join.similar_links(nothing, s).count() == 0


def test_pairs_of_shared_passages_are_few(spark):
    """Keys that the same classes keep are one key, and the join leaves no pair that wide sketches rule out."""
    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage = words(700)
    texts = [f"{passage} {words(500)}" for _ in range(12)]
    texts += [f"{texts[0]} more", f"{texts[5]} more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    s = Similarity(3, 80)
    narrow, rows, classes, shared = jaccard_join._indexed(docs, s)
    lists = shared.groupBy("key").agg(F.sort_array(F.collect_list("class")).alias("of"))
    assert lists.count() == lists.select("of").distinct().count() > 0
    described = classes.select("class", "n", *jaccard_join._SKETCH)
    sketches = s.may_link(F.col("x.n"), F.col("y.n"), jaccard_join._different("x", "y"))
    assert jaccard_join._key_pairs(shared, described, rows, sketches, s).count() == 2
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_components(docs, s).collect()}
    assert got == {i: {12: 0, 13: 5}.get(i, i) for i in range(14)}


# --- classifiers --------------------------------------------------------------------------------


def labelled_texts(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = sentence(rng, rng.randint(20, 120))
        toxic, good = int(i % 5 == 0), int(i % 3 != 0)
        words = text.split()
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["scoundrel", "wretched", "blockhead"])
        if not good:
            words = [w + "###" for w in words] if i % 2 else [words[0]] * len(words)
        rows.append((i, " ".join(words), toxic, good))
    return rows


def test_toxicity_finds_the_roots_of_a_rare_language():
    rng, rows = random.Random(4), []
    syllables = ["ach", "lich", *(a + b for a in ("sch", "v", "k", "b", "g", "m") for b in ("ung", "eit", "er", "a"))]
    for i in range(2400):
        toxic, rare = int(i % 6 == 0), i % 5 == 0
        words = ["".join(rng.choices(syllables if rare else ["tion", "ing", "the", "re", "al"], k=3)) for _ in range(60)]
        if toxic:
            for at in rng.sample(range(60), 6):
                words[at] = "achlich" + rng.choice(syllables) if rare else rng.choice(["moron", "scum", "idiot"])
        rows.append((" ".join(words), toxic, rare))
    model = toxicity.fit([(t, y) for t, y, _ in rows[:1800]])
    score = model.score([t for t, _, _ in rows[1800:]])
    found = {(y, rare): [] for y in (0, 1) for rare in (False, True)}
    for s, (_, y, rare) in zip(score, rows[1800:], strict=True):
        found[y, rare].append(s >= 0.5)
    share = {key: np.mean(hits) for key, hits in found.items()}
    assert share[1, False] >= 0.8 and share[1, True] >= 0.5, share
    # One root by chance is common in clean texts of the rare language, and a sixth of all texts is toxic.
    assert share[0, False] < 0.06 and share[0, True] < 0.15, share


def test_toxicity_learns_and_leaves_clean_texts():
    rows = labelled_texts(1, 600)
    model = toxicity.fit([(t, y) for _, t, y, _ in rows[:400]])
    scores = model.score([t for _, t, _, _ in rows[400:]])
    truth = np.array([y for _, _, y, _ in rows[400:]])
    assert ((scores >= 0.5) == truth).mean() > 0.95
    odd = model.score(["", " ", "x" * 100_000, "\ud800 lone"])
    assert ((odd >= 0) & (odd <= 1)).all() and (odd < 0.5).all()
    assert (toxicity.fit([]).score(["a"]) < 1).all()
    assert (toxicity.fit([("a", 0)] * 5).score(["a"]) < 0.5).all()


def test_quality_learns():
    rows = labelled_texts(2, 600)
    model = quality.fit([(t, y) for _, t, _, y in rows[:400]])
    scores = model.score([t for _, t, _, _ in rows[400:]])
    truth = np.array([y for _, _, _, y in rows[400:]])
    assert ((scores >= 0.3) == truth).mean() > 0.95 and 0.5 <= model.temperature <= 10
    odd = model.score(["", " ", "x" * 100_000, "a a"])
    assert ((odd >= 0) & (odd <= 1)).all()
    assert len(quality.fit([]).score(["a", ""])) == 2
    again = quality.fit([(t, y) for _, t, _, y in rows[:400]])
    assert np.array_equal(again.score(["some text here"]), model.score(["some text here"]))


def test_scores_of_edge_cases(spark, edge, nothing):
    rows = labelled_texts(3, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")
    sample = labelled.labelled_sample(docs, docs.select("doc_id", "toxic"), "toxic", {1: 5, 0: 7})
    assert Counter(y for _, y in sample) == {1: 5, 0: 7}
    kept = {r["doc_id"] for r in docs.where(~labelled.held_out(F.col("doc_id"))).collect()}
    assert {t for t, _ in sample} <= {t for i, t, _, _ in rows if i in kept}
    model = toxicity.fit([(t, y) for _, t, y, _ in rows])
    scored = labelled.score_documents(edge, model.score, 0.5)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and scored.count() == edge.count()
    assert labelled.score_documents(nothing, model.score, 0.5).count() == 0
    left = labelled.kept_documents(edge, model.score, lambda s: s < 2)
    assert left.schema == edge.schema and left.count() == edge.count()
    assert labelled.kept_documents(edge, model.score, lambda s: s > 2).count() == 0


# --- mixing -----------------------------------------------------------------------------------


def water(budget, nodes):
    """Shares of sibling nodes (weight, capacity), by raising the level of the open ones."""
    given, open_ = [0.0] * len(nodes), {i for i, (w, c) in enumerate(nodes) if c}
    while open_ and budget > 1e-9:
        total = sum(nodes[i][0] for i in open_)
        step = min([budget / total] + [(nodes[i][1] - given[i]) / nodes[i][0] for i in open_])
        for i in open_:
            given[i] += step * nodes[i][0]
        budget -= step * total
        open_ = {i for i in open_ if nodes[i][1] - given[i] > 1e-9}
    return given


def test_shares_by_brute_force(spark):
    rng = random.Random(6)
    for _ in range(6):
        nodes = [(rng.randint(1, 9), rng.choice([0, rng.randint(1, 500)])) for _ in range(8)]
        capacity = sum(c for _, c in nodes)
        budget = min(capacity, rng.randint(0, capacity + 50))
        df = spark.createDataFrame(
            [(f"k{i}", w, c, budget) for i, (w, c) in enumerate(nodes)], "k string, weight int, capacity int, budget int"
        ).select("k", *[F.col(c).cast("decimal(38,0)") for c in ("weight", "capacity", "budget")])
        got = {r["k"]: int(r["budget"]) for r in mixing.share_out(df, [], ["k"]).collect()}
        assert sum(got.values()) == budget
        for i, (share, (_, c)) in enumerate(zip(water(budget, nodes), nodes)):
            assert got[f"k{i}"] <= c and abs(got[f"k{i}"] - share) <= 1 + 1e-6


def test_mixture_edge_cases(spark, edge, nothing):
    docs = edge.withColumn("domain", F.lit(None).cast("string"))
    taken = mixing.mix(docs, {}, (1, 1), 1, 3)
    assert taken.count() == edge.count() - taken.sparkSession.range(0).count() or taken.count() > 0
    total = taken.agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0]
    assert total == edge.agg(F.sum(mixing.token_count(F.col("text")))).first()[0]
    twice = mixing.mix(docs, {}, (2, 1), 2, 3)
    assert twice.agg(F.max("copies")).first()[0] == 2
    assert mixing.mix(nothing.withColumn("domain", F.lit("d")), {}, (1, 2), 1, 3).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, d, l, "s") for i, (d, l) in enumerate([("a", "x")] * 2 + [("a", "y")] * 20 + [("b", "x")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    weights = {("a",): 1, ("b",): 1, ("a", "x"): 1, ("a", "y"): 1}
    taken = mixing.mix(docs, weights, (200, 420), 1, 1)
    got = {(r["domain"], r["lang"]): r["t"] for r in taken.groupBy("domain", "lang").agg(F.sum("n_tokens").alias("t")).collect()}
    assert got == {("a", "x"): 20, ("a", "y"): 80, ("b", "x"): 100}
