"""Line, document and span dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import line_dedup as ld
from curatrix.llm import simhash as sh
from curatrix.llm import span_dedup as sd
from curatrix.llm.components import components
from curatrix.llm.suffix_array import suffix_array


def _edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _lines_by_hand(rows):
    white = " \t\r\v\f"
    docs = sorted({(i is None, i or 0, t) for i, t in rows if t is not None}, key=lambda d: d[:2])
    seen, out = [], {}
    for none, i, text in docs:
        kept = []
        for raw in text.split("\n"):
            line = raw.strip(white)
            old = line and any(line == s or min(len(line), len(s)) >= ld.NEAR_CHARS and abs(len(line) - len(s)) <= 1 and _edit(line, s) <= 1 for s in seen)
            if not old:
                kept.append(raw)
            if line:
                seen.append(line)
        out[(None if none else i, text)] = "\n".join(kept)
    return out


def _line_rows(rng):
    base = ["the quick brown fox jumps over a dog", "ünïcode lines häve mäny wörds here", "short", "x" * 400, "lorem ipsum dolor sit amet consectetur"]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            s = rng.choice(base)
            k = rng.randrange(5)
            if k == 0 and s:
                p = rng.randrange(len(s))
                s = s[:p] + rng.choice("abcé") + s[p + 1 :]
            elif k == 1:
                p = rng.randrange(len(s) + 1)
                s = s[:p] + "z" + s[p:]
            elif k == 2 and s:
                p = rng.randrange(len(s))
                s = s[:p] + s[p + 1 :]
            lines.append(rng.choice(["", " "]) + s)
            if rng.random() < 0.2:
                lines.append("  ")
        rows.append((i, "\n".join(lines)))
    return rows + [(60, None), (61, ""), (62, "\n\n"), (None, "no id has this one line\nshort"), (3, rows[3][1]), (63, "y" * 3000), (64, "y" * 2999 + "w")]


def test_lines_by_brute_force(spark):
    rows = _line_rows(random.Random(5))
    df = spark.createDataFrame([(i, t, "n", 0) for i, t in rows], "doc_id long, text string, n_lines string, pos int").repartition(5)
    want = _lines_by_hand(rows)
    got = ld.dedup_lines(df).collect()
    assert len(got) == len(rows) and df.columns[3] == "pos"
    for r in got:
        if r.doc_id == 60:
            assert r.text is None and r.n_lines == 0
    texts = sorted((str(r.doc_id), r.text) for r in got if r.text is not None)
    assert texts == sorted((str(i), want[(i, t)]) for i, t in rows if t is not None)
    assert sum(r.n_near for r in got) > 10


@pytest.mark.parametrize("blocks,chars,long", [(2, 2, 3), (3, 4, 8), (64, 24, 96)])
def test_long_lines_are_cut_again(spark, monkeypatch, blocks, chars, long):
    monkeypatch.setattr(ld, "MOST_BLOCKS", blocks)
    monkeypatch.setattr(ld, "BLOCK_CHARS", chars)
    monkeypatch.setattr(ld, "LONG_BLOCK", long)
    rng = random.Random(8)
    base = ["".join(rng.choice("abé ") for _ in range(n)).strip() + "x" for n in (16, 17, 40, 90, 150)]
    rows = []
    for i in range(50):
        s = rng.choice(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            p, k = rng.randrange(len(s)), rng.randrange(3)
            s = s[:p] + ["", "z", "z" + s[p]][k] + s[p + 1 :]
        rows.append((i, s))
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {(r.doc_id, r.text) for r in got.collect()} == {(k[0], v) for k, v in _lines_by_hand(rows).items()}


def test_very_long_lines(spark):
    import time

    rng = random.Random(2)
    line = "".join(rng.choice("abcdefgh ") for _ in range(1_000_000)).strip() + "end"
    other = line[:700_001] + "X" + line[700_002:]
    rows = [(1, line), (2, other), (3, line[:10] + line[11:]), (4, other[:5] + "Y" + other[6:]), (5, line[:-1])]
    began = time.time()
    got = {r.doc_id: (r.n_removed, r.n_near, r.text) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # The fourth is within one edit of the second, and two of the first.
    assert got == {1: (0, 0, line), 2: (1, 1, ""), 3: (1, 1, ""), 4: (1, 1, ""), 5: (1, 1, "")}
    assert time.time() - began < 60


def test_lines_without_broadcast(spark, monkeypatch):
    rows = _line_rows(random.Random(6))[:30]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(tuple, ld.dedup_lines(df).collect()))
    monkeypatch.setattr(ld, "BROADCAST_LINES", -1)
    assert sorted(map(tuple, ld.dedup_lines(df).collect())) == one


def test_line_stage_drops_emptied_documents(spark):
    df = spark.createDataFrame([(1, "a line of text", "en", "s", 14), (2, "a line of text", "en", "s", 14), (3, "", "en", "s", 0), (4, None, "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in ld.drop_repeated_lines(df).collect()) == [1, 3, 4]
    assert ld.drop_repeated_lines(df.limit(0)).columns == df.columns and ld.drop_repeated_lines(df.limit(0)).count() == 0


def _components_by_hand(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_simhash_by_brute_force(spark):
    import xxhash

    rng = random.Random(7)
    words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(300)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        texts.append(" ".join(base))
        near = list(base)
        near[rng.randrange(len(near))] = "Changed"
        texts += [" ".join(near), " ".join(base).upper(), "\t".join(base) + "\n"]
    texts += ["", None, "  \n", "one", "one two", "ONE two", "word " * 20000]
    prints = {}
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    want = _components_by_hand(prints)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.near_duplicates(df).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    kept = {r.doc_id for r in sh.keep_first_of_each(df.withColumn("fp", F.lit(1))).collect()}
    assert kept == set(want.values())
    assert sh.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [4096, 20, 3])
def test_links_connect_all_close_fingerprints(spark, monkeypatch, most):
    monkeypatch.setattr(sh, "LONG_LIST", most)
    rng = random.Random(8)
    prints = set()
    for _ in range(15):
        base = rng.getrandbits(64)
        for _ in range(30):
            x = base
            for _ in range(rng.randrange(0, 7)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = {x - (1 << 64) if x >> 63 else x: x for x in prints}
    df = spark.createDataFrame([(k,) for k in signed], "fp long")
    edges = sh.links(df).collect()
    assert len(edges) <= len(sh.FOURS) * len(signed) + len(sh.FIVES) * len(signed)
    root = {k: k for k in signed}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for e in edges:
        x, y = sorted((find(e.a), find(e.b)))
        root[y] = x
    want = _components_by_hand(signed)
    assert {k: find(k) for k in signed} == want


def test_fours_hold_every_five_once():
    assert len(sh.FOURS) == 14
    assert all(sum(set(s) <= set(f) for s in sh.FOURS) == 1 for f in sh.FIVES)


def test_long_list_lookup_equals_comparison(monkeypatch):
    rng = np.random.default_rng(9)
    fps = np.unique((np.uint64(0xABCDEF0123) << np.uint64(24)) | (rng.integers(0, 1 << 24, 300).astype(np.uint64) & np.uint64(0x3F003F)))
    a = {tuple(x) for x in zip(*sh.list_links(fps), strict=True)}
    monkeypatch.setattr(sh, "LONG_LIST", 1)
    monkeypatch.setattr(sh, "MOST_HITS", 10)
    short = {tuple(x) for x in zip(*sh.list_links(fps), strict=True)}
    monkeypatch.setattr(sh, "MOST_HITS", 1 << 20)
    assert short == a
    b = {tuple(x) for x in zip(*sh.list_links(fps), strict=True)}
    assert a == b


def test_components_of_chains_and_stars(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (5, 4)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_suffix_array_by_sorting(letters):
    rng = np.random.default_rng(letters)
    for _ in range(200):
        a = rng.integers(0, letters, rng.integers(0, 60))
        assert suffix_array(a) == sorted(range(len(a)), key=lambda i: a[i:].tolist())


def _spans_by_hand(rows):
    seen, out = {}, []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, t in order:
        raw = (t or "").encode()
        for k in range(len(raw) - sd.LENGTH + 1):
            seen.setdefault(raw[k : k + sd.LENGTH], i)
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - sd.LENGTH + 1):
            first = seen[raw[k : k + sd.LENGTH]]
            if first is not None and (i is None or first < i):
                gone[k : k + sd.LENGTH] = b"\1" * sd.LENGTH
        out.append((i, len(raw), sum(gone), hashlib.sha256(bytes(c for c, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return out


def _random_contexts(rng, n):
    """Contexts of one anchor that share more or less of what is around it."""
    gram = rng.integers(97, 100, sd.GRAM)
    rows = rng.integers(97, 99, (n, sd.CONTEXT)).astype(np.uint8)
    rows[:, sd.BACK : sd.BACK + sd.GRAM] = gram
    for i in range(1, n):
        other = int(rng.integers(i))
        a, b = sorted(rng.integers(0, sd.CONTEXT, 2))
        rows[i, min(a, sd.BACK) : max(b, sd.BACK + sd.GRAM)] = rows[other, min(a, sd.BACK) : max(b, sd.BACK + sd.GRAM)]
    return rows, rng.random((n, sd.WINDOW_GRAMS)) < 0.95


def test_strings_of_contexts_by_brute_force():
    rng = np.random.default_rng(14)
    for n in (0, 1, 2, 30, 120):
        rows, valid = _random_contexts(rng, n)
        ids = rng.integers(0, 50, n)
        got = sd.least_ids(np.zeros(n, np.uint64), rows, valid, ids)
        want = np.repeat(ids[:, None], sd.WINDOW_GRAMS, axis=1)
        for j in range(sd.WINDOW_GRAMS):
            known = {}
            for i in np.flatnonzero(valid[:, j]):
                known.setdefault(rows[i, j : j + sd.LENGTH].tobytes(), []).append(ids[i])
            for i in np.flatnonzero(valid[:, j]):
                want[i, j] = min(known[rows[i, j : j + sd.LENGTH].tobytes()])
        assert (got == want).all()


def test_the_suffix_order_decides(monkeypatch):
    rng = np.random.default_rng(15)
    rows, valid = _random_contexts(rng, 120)
    ids = rng.permutation(120)
    right = sd.least_ids(np.zeros(120, np.uint64), rows, valid, ids)
    monkeypatch.setattr(sd, "suffix_array", lambda symbols: list(range(len(symbols))))
    assert (sd.least_ids(np.zeros(120, np.uint64), rows, valid, ids) != right).any()


@pytest.mark.parametrize("array_contexts", [6000, 5])
def test_spans_by_brute_force(spark, monkeypatch, array_contexts):
    monkeypatch.setattr(sd, "ARRAY_CONTEXTS", array_contexts)
    monkeypatch.setattr(sd, "FILE_BYTES", 1000 * array_contexts)
    monkeypatch.setattr(sd, "ROW_GROUP", 7)
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 40))) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [rng.choice([*passages, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))]) for _ in range(rng.randrange(0, 4))]
        text = "".join(parts)
        if text and rng.random() < 0.5:
            p = rng.randrange(len(text))
            text = text[:p] + "#" + text[p + 1 :]
        rows.append((i, text))
    rows += [(80, None), (81, ""), (82, "a" * 300), (83, "a" * 49), (84, "a" * 500), (85, "\0" * 120), (86, "\0" * 90), (None, passages[0] * 2), (2, rows[2][1]), (2, passages[1] + passages[1]), (87, "ab" * 3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, body int").repartition(4)
    got = [(r.doc_id, r.n_bytes, sum(b - a for a, b in zip(r.starts, r.ends, strict=True)), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in sd.remove_repeats(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, _spans_by_hand(rows)))
    assert sd.remove_repeats(df.limit(0)).count() == 0
