"""Exact, near and substring deduplication against brute force."""

import hashlib
import re
from collections import defaultdict

from llm_data import corpus, nothing, prose, rows_of, scratch  # noqa: F401
from settlebook.llm import exact, near, substring, words
from settlebook.llm.components import components


def key_order(d):
    return (d is None, d if d is not None else 0)


def test_exact_against_brute_force(corpus, scratch):
    got = exact.dedup(corpus, scratch, block=64).collect()
    groups = defaultdict(list)
    for d, t in rows_of(corpus):
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(d)
    assert len(got) == corpus.count()
    for r in got:
        g = groups[r["text_sha256"]]
        assert r["group_size"] == len(g)
        assert r["keep_id"] == min(g, key=key_order)
    for sha, g in groups.items():
        kept = [r["doc_id"] for r in got if r["text_sha256"] == sha and r["kept"]]
        assert kept == [min(g, key=key_order)]


def test_exact_of_nothing(nothing, scratch):
    assert exact.dedup(nothing, scratch).count() == 0


def test_names_tell_texts_of_any_length_apart(spark, scratch):
    texts = ["ab" * n for n in range(0, 70)] + ["ab" * n + "c" for n in range(0, 70)] + ["ab" * 33]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = exact.identify(df, scratch, block=4).collect()
    names = {r["doc_id"]: (r["level"], r["name"]) for r in got}
    for i, s in enumerate(texts):
        for j, t in enumerate(texts):
            assert (names[i] == names[j]) == (s == t)


def sets_of(rows):
    out = []
    for d, t in rows:
        w = (t or "").encode().lower().split()
        out.append((d, frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()))
    return out


def linked(sets):
    """Component (list of row numbers) of each row."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, s) in enumerate(sets):
        for j, (_, t) in enumerate(sets[:i]):
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def check_near(df, scratch):
    sets = sets_of(rows_of(df))
    roots = linked(sets)
    members = defaultdict(list)
    for i, r in enumerate(roots):
        members[r].append(sets[i][0])
    want = []
    for i, (d, s) in enumerate(sets):
        known = [x for x in members[roots[i]] if x is not None]
        c = min(known) if known else None
        want.append((d, len(s), c, d == c))
    got = [tuple(r) for r in near.link(df, scratch).drop("th").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_against_brute_force(corpus, scratch):
    check_near(corpus, scratch)


def test_near_of_nothing(nothing, scratch):
    assert near.link(nothing, scratch).count() == 0


def test_near_dense_regions(spark, scratch):
    """More near copies than a region holds, of two families that share words."""
    rows = []
    for family in range(2):
        base = prose(family, 120).split(" ")
        for i in range(90):
            w = list(base)
            for k in range(family + 1 + i % 4):
                w[(i * 7 + k * 31) % len(w)] = f"w{i}x{k}"
            rows.append((family * 1000 + i, " ".join(w)))
    check_near(spark.createDataFrame(rows, "doc_id long, text string"), scratch)


def test_near_template_family(spark, scratch):
    """2000 documents of one template: siblings at 0.75, each with one partner at 0.80 to 0.82."""
    template = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(1000):
        for d in (i, 10000 + i):  # partners share the first words of what is their own
            own = [f"s{i}x{k}" if k < 10 + i % 3 else f"s{d}y{k}" for k in range(39)]
            rows.append((d, " ".join(template[:20] + own + template[59:])))
    sets = dict(sets_of(rows))
    alike = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in [(0, 1), *((i, 10000 + i) for i in range(1000))]]
    assert 0.74 < alike[0] < 0.76 and all(0.8 <= x < 0.82 for x in alike[1:])
    got = {r["doc_id"]: r["component_id"] for r in near.link(spark.createDataFrame(rows, "doc_id long, text string"), scratch).collect()}
    assert got == {d: d % 10000 for d, _ in rows}


def test_components_of_paths_stars_and_rings(spark, scratch):
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(300 + i, 300 + (i + 1) % 40) for i in range(40)]
    edges += [(500, 500), (i, 200) if (i := 160) else (0, 0)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), scratch, "c").collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 100 for i in range(200, 260))
    assert all(got[300 + i] == 300 for i in range(40))
    assert 500 not in got


def removed_words(rows, size):
    rows = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, w in rows:
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            least[k] = min(least.get(k, (True, 0)), key_order(d))
    out = []
    for d, w in rows:
        cov = [False] * len(w)
        for p in range(len(w) - size + 1):
            if least[tuple(w[p:p + size])] < key_order(d):
                cov[p:p + size] = [True] * size
        kept = [x for x, c in zip(w, cov) if not c]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_substring_against_brute_force(corpus, scratch):
    result = substring.dedup(corpus, scratch).collect()
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in result]
    assert sorted(got, key=str) == sorted(removed_words(rows_of(corpus), 50), key=str)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in result)


def test_substring_mosaics(spark, scratch):
    """Texts pieced together from parts of others, so that windows lie across factors of different sources."""
    import random
    r = random.Random(8)
    rows = [(i, prose(i, 200)) for i in range(10)]
    for i in range(10, 40):
        parts = []
        for _ in range(6):
            w = rows[r.randrange(len(rows))][1].split()
            a = r.randrange(max(1, len(w) - 60))
            parts += w[a:a + r.randint(20, 120)] + ["new"] * r.randint(0, 2)
        rows.append((i, " ".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substring.dedup(df, scratch).collect()]
    assert sorted(got) == sorted(removed_words(rows, 50))


def test_substring_of_nothing(nothing, scratch):
    assert substring.dedup(nothing, scratch).count() == 0


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    data = (prose(1, 500) + " " + "y" * 300 + "  \n\t " + prose(2, 100)).encode()
    whole = words.word_hashes(data).tolist()
    monkeypatch.setattr(words, "BLOCK", 64)
    assert words.word_hashes(data).tolist() == whole
    assert len(whole) == len(data.split())
    seen = dict(zip(data.split(), whole))
    assert [seen[w] for w in data.split()] == whole and len(set(seen.values())) == len(seen)


def test_windows_are_polynomials_of_their_words():
    w = words.word_hashes(prose(4, 90).encode())
    for size in (1, 2, 3, 12, 50):
        windows = words.runs(w, size)
        assert len(windows) == len(w) - size + 1
        again = [words.runs(w[i:i + size], size)[0] for i in range(len(windows))]
        assert windows.tolist() == again
