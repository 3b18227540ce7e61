"""Spelling variants, Merkle manifest and source mixing against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

from llm_data import corpus, nothing, scratch  # noqa: F401
from pyspark.sql import functions as F
from settlebook.llm import merkle, mixing, places, spelling

# --- places -----------------------------------------------------------------


def test_places_count_every_row_of_a_group_that_is_in_many_parts(spark, scratch):
    rows = [("hot", i // 3) for i in range(3000)] + [("cold", 5), ("cold", None), ("", 1)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(7)
    got = places.places(df, scratch, "t", ["g"], ["v"]).collect()
    for g in ("hot", "cold", ""):
        own = sorted((r["place"], r["v"]) for r in got if r["g"] == g)
        want = sorted((v for h, v in rows if h == g), key=lambda v: (v is not None, v or 0))
        assert own == list(enumerate(want))
        assert {r["n"] for r in got if r["g"] == g} == {len(want)}


# --- spelling ---------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and len(b) - len(a) <= 1 and (a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:])


def check_pairs(spark, scratch, words):
    got = spelling.near_words(spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long"), scratch).collect()
    n = {w: i + 3 for i, w in enumerate(words)}
    assert all(r["n"] == n[r["word"]] and r["other_n"] == n[r["other"]] for r in got)
    pairs = [tuple(sorted((r["word"], r["other"]))) for r in got]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {tuple(sorted(p)) for p in itertools.combinations(words, 2) if one_edit(*p)}


def test_near_words_of_a_dense_set_with_runs(spark, scratch):
    r = random.Random(3)
    check_pairs(spark, scratch, sorted({"".join(r.choice("ab") for _ in range(r.randint(4, 8))) for _ in range(250)}))


def test_near_words_of_wide_characters_and_long_words(spark, scratch):
    r = random.Random(4)
    words = {"".join(r.choice("abcéß÷") for _ in range(r.randint(5, 6))) for _ in range(300)}
    words |= {"a" * 3000, "a" * 2999, "a" * 1500 + "b" + "a" * 1499, "b" + "a" * 2999, "a" * 2999 + "b", "a" * 12, "a" * 14}
    check_pairs(spark, scratch, sorted(words))


def grouped(rows):
    count = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            count[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w] or "", root(w), n, len(near[w]), words.get(form[w], 0)) for w, n in words.items())


def result(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def test_spelling_groups_against_brute_force(spark, corpus, scratch):
    assert result(spelling.group(corpus, scratch)) == grouped([(r["doc_id"], r["text"]) for r in corpus.collect()])


def test_spelling_chains_ties_and_repeats(spark, scratch):
    def rep(word, n):
        return " ".join([word] * n)
    text = " ".join([rep("Kitten", 40), rep("kittenn", 20), rep("kittennn", 9), rep("kittennnn", 3), rep("bitten", 40), rep("mitten", 20), rep("sitten", 19), rep("ÀÉÎÕÜ", 4), rep("àéîõü", 3)])
    rows = [(1, text), (1, text), (None, text), (7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    got = result(spelling.group(df, scratch))
    assert got == grouped(rows)
    roots = {g[0]: g[2] for g in got}
    assert roots["kittennnn"] == "kitten" and roots["mitten"] == "bitten"  # a tie of counts: code-point order


def test_spelling_of_long_texts_is_counted_by_slices(spark, scratch, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 64)
    text = " ".join(f"slice{c * 3} Überlang{'x' * 100}" for c in "abcdeabcdeabcde") + "tail"
    found = Counter(w for part in spelling.runs_of(text) for w in part)
    assert found == Counter(re.findall("[A-Za-zÀ-ÿ]+", text.translate(spelling.LOWERED)))


def test_spelling_of_nothing(nothing, scratch):
    assert spelling.group(nothing, scratch).count() == 0


# --- manifest ---------------------------------------------------------------


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree(leaves):
    """Root of the leaves, and per leaf its (left, right) siblings by level."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a // 8 * 8:a // 8 * 8 + 8]
            paths[i].append(("".join(run[:a % 8]), "".join(run[a % 8 + 1:])))
        level = [sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
        at = [a // 8 for a in at]
    return level[0], paths


def manifest_of(rows):
    def leaf(d, s, lang, n, t):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, s, lang, n, t)))
    groups = defaultdict(list)
    for d, s, lang, n, t in rows:
        low = None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        bad = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        groups[lang].append(((d is not None, d or 0), leaf(d, s, lang, n, t), leaf(d, s, lang, n, low) if bad else None, d))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: sorted(groups[g], key=lambda x: x[:2]) for g in langs}
    sub = {g: tree([x[1] for x in own[g]]) for g in langs}
    root, tops = tree([sub[g][0] for g in langs])
    out = []
    for i, g in enumerate(langs):
        for (_, digest, changed, d), path in zip(own[g], sub[g][1]):
            path = path + tops[i]
            h = changed or digest
            for left, right in path:
                h = sha(left + h + right)
            out.append((str(d), digest, sub[g][0], root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out)


def check_manifest(df, scratch):
    cols = ["doc_id", "source", "lang", "n_chars", "text"]
    got = merkle.manifest(df, scratch).withColumn("proof", F.sha2("proof", 256)).collect()
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"], r["verified"]) for r in got) == \
        manifest_of([tuple(r[c] for c in cols) for r in df.select(*cols).collect()])


def test_manifest_of_a_mixed_table(corpus, scratch):
    clash = corpus.withColumn("lang", F.when(F.col("doc_id") % 4 == 0, None).when(F.col("doc_id") % 4 == 1, "").otherwise(F.col("lang")))
    for c in ("leaf", "root", "digest", "place", "n", "g"):
        clash = clash.withColumn(c, F.lit(1))
    check_manifest(clash, scratch)


def test_manifest_over_several_tiers(spark, scratch, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(i, "s", ("aa", "b", None)[min(i % 5, 2)], i, f"Text {i}") for i in range(700)]
    rows += [(2000 + i, None, f"l{i}", None, None) for i in range(70)] + [(5, "s", "aa", 5, "Text 5")] * 9
    check_manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), scratch)


def test_manifest_of_full_blocks(spark, scratch):
    rows = [(i, "s", "x" if i < 4097 else "y", i, "T") for i in range(4097 + 512)]
    check_manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), scratch)


def test_manifest_of_one_row_and_of_none(spark, corpus, nothing, scratch):
    r = merkle.manifest(corpus.where("doc_id = 20"), scratch).collect()[0]
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof"] == "" and r["path"] == []
    assert merkle.manifest(nothing, type(scratch)(spark, "none")).count() == 0


def test_verification_finds_a_changed_text(corpus, scratch):
    got = merkle.manifest(corpus, scratch, tampered=F.col("doc_id") == 35).collect()
    assert {r["doc_id"] for r in got if not r["verified"]} == {35}


# --- mixing -----------------------------------------------------------------


def wanted(sizes, weights):
    """Targets per source by sharing again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        goal = {s: 3 * sizes[s] if s in stopped else left * weight[s] / sum(weight[x] for x in rest) for s in order}
        new = {s for s in rest if goal[s] > 3 * sizes[s]}
        if not new:
            return goal
        stopped |= new


def check_mix(df, scratch, near=0.02, **kw):
    got = mixing.mix(df, scratch, **kw).collect()
    rows = df.select("doc_id", "source", "text").collect()
    size = Counter()
    for r in rows:
        size[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    goal = wanted(size, kw.get("weights", (5, 2, 1)))
    assert len(got) == len(rows)
    by = Counter((r["source_size"], round(r["target"], 6)) for r in got)
    assert by == Counter((size[r["source"]], round(goal[r["source"]], 6)) for r in rows)
    assert all(0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[(r["source_size"], r["target"])] += r["taken"]
    for (_, target), t in taken.items():
        assert abs(t - target) <= max(near * target, 3), (t, target)
    return {(r["doc_id"], r["size"], r["taken"]) for r in got}


def text(n):
    return " ".join(["w"] * n)


def test_mix_comes_near_its_targets_and_is_the_same_again(spark, scratch):
    r = random.Random(5)
    rows = [(i, text(min(3000, int(r.paretovariate(1.1) * 10))), f"s{min(i % 13, 6)}", 1) for i in range(2000)]
    rows += [(3000 + i, text(20), None, 1) for i in range(30)] + [(4000, None, "s1", 1), (4001, "", "s1", 1), (None, text(7), "s2", 1), (9, text(9), "s2", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    assert check_mix(df, scratch) == check_mix(df.repartition(5), type(scratch)(spark, "again"))


def test_small_sources_stop_at_three_times_their_size(spark, scratch):
    rows = [(1, text(10), "a"), (2, text(20), "b"), (3, text(5), "b"), (4, text(1), "c")] + [(10 + i, text(30), "d") for i in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), scratch).collect()
    assert {r["doc_id"]: r["copies"] for r in got if r["doc_id"] < 10} == {1: 3, 2: 3, 3: 3, 4: 3}
    check_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), type(scratch)(spark, "again"), near=0.05)


def test_equal_sizes_beyond_a_stretch_of_places(spark, scratch):
    df = spark.range(70000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") % 9 > 0, "hot").otherwise("z").alias("source"))
    check_mix(df, scratch, near=0.001)


def test_mix_of_nothing_and_of_no_words(spark, corpus, nothing, scratch):
    assert mixing.mix(nothing, scratch).count() == 0
    none = mixing.mix(corpus.withColumn("text", F.lit(None).cast("string")), type(scratch)(spark, "none")).collect()
    assert len(none) == corpus.count() and {(r["target"], r["taken"]) for r in none} == {(0.0, 0)}
