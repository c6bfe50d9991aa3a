"""N-gram joins, source divergence and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from curatrix.llm import divergence as dv
from curatrix.llm import ngram_join as nj
from curatrix.llm import resample as rs
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()


def _components(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for j, (a, s) in enumerate(zip(rows, sets, strict=True)):
        for i in range(j):
            same = rows[i][0] == a[0]
            if same or s and sets[i] and 100 * len(s & sets[i]) >= 85 * len(s | sets[i]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return sorted(((i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def _near_rows(rng, groups=12, size=9):
    """Families of near copies whose members are from alike to just not alike, a passage that most share, and odd rows."""
    word = lambda: "".join(rng.choice("abcdeÄß") for _ in range(rng.randrange(1, 6)))
    passage = " ".join(word() for _ in range(50))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([5, 8, 12, 40, 90]))]
        if rng.random() < 0.6:
            base[rng.randrange(len(base)) : 0] = passage.split()
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy).upper() if rng.random() < 0.2 else "\t".join(copy))
    rows += ["one two", "ONE\ntwo", "one", "", None, "  \n", "x " * 3000, "a b c d", "a b c d a b c d"]
    out = [(k * 3, t) for k, t in enumerate(rows)]
    rng.shuffle(out)
    return [*out, out[0], (None, out[5][1]), (None, "no id here at all"), (out[7][0], out[11][1]), (out[8][0], "quite another text of the same id"), (9_000, "one two"), (9_001, None)]


@pytest.mark.parametrize("block_bytes,block_rows,tell,docs,seed", [(8 << 20, 4096, 8, 200, 1), (3000, 3, 2, 10**9, 2), (1500, 2, 2, 10**9, 1)])
def test_jaccard_components_by_brute_force(spark, monkeypatch, block_bytes, block_rows, tell, docs, seed):
    monkeypatch.setattr(nj, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(nj, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(nj, "TELL", tell)
    monkeypatch.setattr(nj, "COMMON_DOCS", docs)
    rows = _near_rows(random.Random(seed))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, gram string").repartition(3)
    got = nj.jaccard_components(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == _components(rows)


def test_jaccard_components_of_a_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(map(tuple, nj.jaccard_components(df).collect()), key=repr) == _components(rows)
    assert nj.jaccard_components(df.limit(0)).collect() == []


def _joined(n, links):
    root = list(range(n))
    for _ in range(n):
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    return root


def _sets(rng, n, size):
    base = rng.integers(0, 1 << 62, size, dtype=np.uint64)
    return [np.unique(np.concatenate([rng.choice(base, rng.integers(3 * size // 4, size), replace=False), rng.integers(0, 1 << 62, rng.integers(0, size // 6), dtype=np.uint64)])) for _ in range(n)]


def _true(members):
    return [(i, j) for j in range(len(members)) for i in range(j) if 100 * len(np.intersect1d(members[i], members[j])) >= 85 * len(np.union1d(members[i], members[j]))]


def test_block_links_by_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(30):
        members = _sets(rng, 25, 60)
        true, found = _true(members), list(nj._block_links(members, 85))
        assert set(found) <= set(true) and _joined(25, found) == _joined(25, true)


@pytest.mark.parametrize("words", [1 << 22, 64])
def test_bitmaps_pass_over_no_link(monkeypatch, words):
    monkeypatch.setattr(nj, "COMPARE_WORDS", words)
    rng = np.random.default_rng(3)
    for size in (20, 60, 130, 600):
        members = _sets(rng, 20, size) + _sets(rng, 5, 2 * size)
        side, root = rng.integers(1, 3, 25), rng.integers(0, 12, 25)
        for sides in (side, np.zeros(25, int)):
            found = {(min(i, j), max(i, j)) for a, b, _ in nj.may_link(np.array([len(m) for m in members]), [nj.bitmap(m) for m in members], sides, root, 85) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
            able = {(i, j) for i, j in _true(members) if root[i] != root[j] and (sides is not side or side[i] != side[j])}
            assert able <= found and all(root[i] != root[j] and (sides is not side or side[i] != side[j]) for i, j in found)


def test_common_grams_are_last_but_not_lost(spark, monkeypatch):
    monkeypatch.setattr(nj, "COMMON_DOCS", 20)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words[:k] + [f"own{k}"] + words[k:]) for k in range(60)] + [" ".join(words), "all other words than those that are common here"]
    got = nj.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)).collect()
    assert sorted(map(tuple, got), key=repr) == _components(list(enumerate(texts)))


def test_radix_selection_by_sorting(spark):
    rng = random.Random(3)
    rows = [(g, rng.choice([0, 1, 5, 5, 5, 1023, 1024, 70_000, (1 << 33) + 7]), "".join(rng.choice("abé日") for _ in range(rng.randrange(0, 7)))) for g in ("x", "y", None) for _ in range(300)]
    rows = [r for r in rows if r[0]] + [("few", 3, "b"), ("few", 3, "a"), ("zero", 0, "q"), ("rep", 9, "same"), ("rep", 9, "same"), ("rep", 9, "same")]
    df = spark.createDataFrame(rows, "g string, v long, item string").repartition(3)
    for k in (1, 2, 40, 299, 1000):
        got = sorted(tuple(r) for r in dv.radix_top(df, ["g"], "v", "item", k).select("g", "v", "item", "rank").collect())
        want = []
        for g in {r[0] for r in rows}:
            some = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))[:k]
            want += [(*r, n) for n, r in enumerate(some, 1)]
        assert got == sorted(want)


def _divergence(rows, least, top):
    docs = [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for t, l, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= least)
        group = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in {d[1] for d in mine}}
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}  # noqa: B023, E731
        q, p = share(sum(group.values(), Counter())), {s: share(c) for s, c in group.items()}
        for s in group:
            found = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in group if o != s]
            out += [(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(sorted(found), 1)]
            found = sorted((q[t] - p[s][t], t.encode()) for t in kept if group[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("least,top", [(1, 5), (4, 3), (10**6, 5)])
def test_source_divergence_by_brute_force(spark, least, top):
    rng = random.Random(11)
    words = ["Az", "zß", "É", "日本", "a1b", "x-y", "tie", "tie2", "K"] + [f"w{c}" for c in "abcdefgh"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 12))), rng.choice(["en", "de", "", None]), rng.choice(["s", "é", "", None, "s2"])) for _ in range(120)]
    rows += [(None, "fr", "only"), ("123 456", "fr", "bare"), ("word " * 5000, "en", "s"), rows[3], rows[3]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, count long, term string").repartition(4)
    got = dv.source_divergence(df, least, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _divergence(rows, least, top)
    assert dv.source_divergence(df.limit(0), least, top).collect() == []


def _features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[k : k + n]).encode()) % 10000 for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def _resampled(rows, target, percent):
    raw = Counter(b for _, t in rows for b in _features(t)[1])
    aim = Counter(b for t in target for b in _features(t)[1])
    S, T = sum(raw.values()), sum(aim.values())
    out = []
    for i, t in rows:
        n, found = _features(t)
        weight = sum(math.floor(1000 * math.log((aim[b] + 1) * (S + 10000) / ((raw[b] + 1) * (T + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([n, i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[0] >= 20), key=lambda r: (-r[4], r[1] is not None, r[1] or 0, r[2], r[3]))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = k
    return sorted((tuple(r[1:]) for r in out), key=repr)


@pytest.mark.parametrize("chars", [1 << 20, 60])
def test_resampling_by_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(rs, "CALL_CHARS", chars)
    rng = random.Random(5)
    words = ["Alpha", "beta", "été", "日本", "x1", "9", "o'clock", "Omega"]
    rows = [(k, rng.choice([" ", "\n", ", "]).join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 19, 20, 21, 80])))) for k in range(150)]
    rows += [(500, None), (501, "..."), (502, "word" * 400), (None, "ten more words " * 9), (None, "beta " * 30), rows[4], rows[4], (7, "another text of the id seven " * 6)]
    target = ["alpha beta x1 alpha beta", None, "", "omega 9 omega"]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id long, text string, score long, rank string").repartition(4)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = rs.resample(df, aim, 30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == _resampled(rows, target, 30)
    assert rs.resample(df.limit(0), aim).collect() == []
    assert sorted(map(tuple, rs.resample(df, aim.limit(0), 5).collect()), key=repr) == _resampled(rows, [], 5)


def test_resampling_of_tables(spark):
    docs, aim = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    got = rs.resample(docs, aim)
    want = _resampled([tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in aim.select("text").collect()], 5)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert got.where(F.col("rank").isNotNull()).count() > 0


def test_pieces_keep_all_runs():
    text = "One two, three " * 50 + "x" * 300 + " four five"
    for most in (1, 10, 100, 10_000):
        seen = Counter()
        for piece, extra in rs.text_pieces(text, most):
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", piece)
            seen.update(tuple(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - extra) if k + n <= len(words))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        assert seen == Counter(tuple(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1))
