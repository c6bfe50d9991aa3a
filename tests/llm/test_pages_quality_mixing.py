"""Archives, page texts, quality rules, mixing and the pipeline."""

import hashlib
import io
import re
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from curatrix.llm import archives as ar
from curatrix.llm import html_text as ht
from curatrix.llm import mixing as mx
from curatrix.llm import quality as ql
from curatrix.llm.common import shared_dir

SF = "/root/testdata/sf0.001"


def test_archives_round_trip(spark):
    long = "é" * 600
    rows = [(1, "http://a/", long), (2, "http://b/", long), (3, None, "short"), (4, "x\r\ny", "short"), (5, "u", None), (6, "u", ""), (None, "u", long), (2, "http://b2/", long), (7, "u", "z" * 200_000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, records string").repartition(3)
    packages = ar.write_packages(df, shared_dir(spark, "packages"))
    assert sum(n for _, n in packages) == len(rows)
    got = ar.read_packages(spark, [u for u, _ in packages]).collect()
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = html == long and i != 2
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert all(bytes(r.payload) == (dict((k[0], k[2]) for k in rows)[r.page_id] or "").encode() for r in got if r.record_type == "response" and r.page_id is not None)
    assert ar.write_packages(df.limit(0), shared_dir(spark, "packages")) == [] and ar.read_packages(spark, []).count() == 0


def test_zip64_directories_and_damage(monkeypatch):
    def package():
        out = io.BytesIO()
        writer = ar.PackageWriter(out)
        for i in range(5):
            writer.add(i, ar.make_record(i, "u", b"p%d" % i, hashlib.sha1(b"p%d" % i).hexdigest(), None, False))
        writer.close()
        return out.getvalue()

    plain = package()
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    wide = package()
    assert b"PK\x06\x06" in wide and b"PK\x06\x06" not in plain
    for raw in (plain, wide):
        assert [r["page_id"] for r in ar.read_package(pa.BufferReader(raw))] == list(range(5))
        assert set(ar.StoredZip(pa.BufferReader(raw)).members) == set(zipfile.ZipFile(io.BytesIO(raw)).namelist())
    with pytest.raises(ValueError):
        ar.StoredZip(pa.BufferReader(plain[:-30]))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(ar.ARCHIVE, "x" * 100)
    with pytest.raises(ValueError):
        ar.StoredZip(pa.BufferReader(packed.getvalue())).data(ar.ARCHIVE)
    record = ar.make_record(1, "u", b"abc", hashlib.sha1(b"abd").hexdigest(), None, False)
    with pytest.raises(ValueError):
        ar.parse_record(record)


@pytest.mark.parametrize("html, text", [
    ("<div id=content><article class=post>main text</article><div id=comments class=comments-area><ol class=comment-list><li class=comment><article class=comment-body>reader said so</article></ol></div></div>", "main text"),
    ("<article>kept</article><section class=related><article>teaser</article></section>", "kept"), ("<section class=related><article>teaser</article></section><main>kept</main>", "kept"),
    ("<div class=comments><article>only this</article></div>", "only this"), ("<article class=post>t</article><article class=comment>c</article>", "t"), ("<article class=comment>c</article>", "c"),
    ("<article><p class=social>a</p><p class=comment>b</p>c</article>", "a b c"), ("<article><ul class=menu><li>soup<li>fish</ul>c</article>", "soup fish c"), ("<article><ul class=social><li><a href=x>Share</a><li><a href=y>Mail</a></ul>c</article>", "c"),
    ("<article><ul class=menu><li>soup <a href=x>of the day</a> with bread<li>fish</ul></article>", "soup of the day with bread fish"), ("<article>a<div class=social>s</div><div hidden>h</div>b</article>", "a b"),
    (None, ""), ("", ""), ("plain  text &amp; more", "plain text & more"), ("<article><p>a<b>b</b>c<p>d</article>", "abc d"),
    ("<nav>menu</nav><article><h1>T</h1><p>one<br>two</p><aside>no</aside><div class='ad-box'>no</div></article><footer>f</footer>", "T one two"),
    ("<main>x<form>f</form><section id=comments>c</section>y</main>", "x y"), ("<script>var t='</p>';</script><p>a&lt;b</p><style>p{}</style>", "a<b"),
    ("<article>a<!-- c --> b<article class=comment>no</article></article>", "a b"), ("<div role=navigation>n</div><p>t</p>", "t"), ("<p>unclosed <b>bold <i>it", "unclosed bold it"),
    ("<head><meta charset=utf-8><body><p>t</p>", "t"), ("<p>a</p><div id=cookieBanner>c</div><ul class='sidebar_left'><li>s</ul>b", "a b"), ("<article><p>a<span class=ad>x</span>b</p></article>", "a b"),
    ("<article>x < y & z</article>", "x < y & z"), ("<div class='site has-sidebar'><article>A</article></div>", "A"), ("<article class='post comments-open'>B</article>", "B"),
    ("<article class='post widget-area'>C</article>", "C"), ("<div id=related-work><article>D</article></div>", "D"), ("<article><p class=share-price>5</p><h1 class=entry-header>T</h1></article>", "5 T"),
    ("<svg><p>one</p><p>two</p>", "one two"), ("<object><p>x</p>", "x"), ("<textarea><p>y</p>", "y"), ("<title><p>z</p>", "z"), ("<svg><text>no</text></svg>v", "v"), ("<form id=f><main>q</main></form>", "q"),
    ("<nav>menu<article>kept</article>", "kept"), ("<aside><article>teaser</article></aside><article>kept</article>", "kept"), ("<p class=ad>no<p>yes", "yes"), ("<p title=\"a>b\">t</p>", "t"), ("<p title=it's>t</p>", "t"),
    ("<article>a<aside>b<article>no</article></aside>c</article>", "a c"), ("<a href=\"x>unclosed", "unclosed"), ("text<", "text<"), ("<p>a<!-- b", "a"), ("a<br/>b<hr/>c", "a b c"), ("<article>a<nav/>b</article>", "a b"), ("<header>h</header><article><header>Title</header>t</article>", "Title t"), ("<p hidden>h</p><p>&nbsp;v&nbsp;w</p>", "v w"),
])
def test_page_text(html, text):
    assert ht.host_texts([ht.blocks(html or "")]) == [text]


def test_host_boilerplate_is_removed_outside_articles_only():
    notice = "this site stores small files on your device to work well"
    pages = [f"<p>{notice}</p><p>page {i} has text of its own here</p>" for i in range(4)]
    quoted = [f"<article><p>{notice}</p><p>own {i}</p></article>" for i in range(4)]
    assert ht.host_texts([ht.blocks(p) for p in pages]) == [f"page {i} has text of its own here" for i in range(4)]
    assert ht.host_texts([ht.blocks(p) for p in quoted]) == [f"{notice} own {i}" for i in range(4)]


def test_repeated_runs_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(0, 60))
        ids, pages = rng.integers(0, 3, n), np.sort(rng.integers(0, 5, n))
        for k in range(n):
            if k + 1 == n or pages[k + 1] != pages[k]:
                ids[k] = -k - 1
        assert ht.suffix_order(ids).tolist() == sorted(range(n), key=lambda i: ids[i:].tolist())
        got = ht.repeated_starts(ids, pages, 3, 2)
        want = np.zeros(n, bool)
        for i in range(n - 2):
            want[i] = len({pages[j] for j in range(n - 2) if (ids[j : j + 3] == ids[i : i + 3]).all()}) >= 2
        assert (got == want).all()
        covered = [any(got[max(0, i - 2) : i + 1]) for i in range(n)]
        assert ht._cover(got, 3).tolist() == covered


@pytest.mark.parametrize("html", ["<a " * 350_000, '<a b=">" ' * 100_000, "<a><b>" * 90_000 + "</c>" * 90_000, "<" * 1_000_000, "<p>" * 300_000, "<svg>" * 200_000, "<article>" * 100_000, "<a b='" * 170_000, "<textarea>" * 100_000, "&#" * 500_000, "<article>" + "<ul class=menu>x" * 60_000])
def test_long_pages_of_unclosed_tags_are_parsed_in_linear_time(html):
    import time

    began = time.process_time()
    ht.blocks(html)
    assert time.process_time() - began < 2


def _brute_force_texts(rows):
    """The operator by its definition: runs of eight words on three distinct pages of a host."""
    parsed = [(i, re.match("[a-z]+://([^/?#]*)", u)[1] if u else "", ht.blocks(h or "")) for i, u, h in rows]
    least = {}
    for i, host, page in parsed:
        key = (host, tuple(page))
        least[key] = min((k for k in (least.get(key), i) if k is not None), default=None)
    streams = {}
    for (host, page), owner in least.items():
        words = [w for _, t in page for w in t.split(" ")]
        streams[host, page] = ((owner, None) if owner is not None else (None, page), words)
    on = {}
    for (host, _), (owner, words) in streams.items():
        for k in range(len(words) - 7):
            on.setdefault((host, tuple(words[k : k + 8])), set()).add(owner)
    out = []
    for i, host, page in parsed:
        words = [w for _, t in page for w in t.split(" ")]
        starts = [k + 8 <= len(words) and len(on[host, tuple(words[k : k + 8])]) >= 3 for k in range(len(words))]
        across = [any(starts[max(0, k - 7) : k + 1]) for k in range(len(words))]
        has_article, kept, at = any(k in (ht.ARTICLE, ht.HINTED_ARTICLE) for k, _ in page), [], 0
        for kind, text in page:
            own = text.split(" ")
            gone = across[at : at + len(own)]
            if not all(gone):
                gone = [any(starts[at + m] and m + 8 <= len(own) for m in range(max(0, k - 7), k + 1)) for k in range(len(own))]
            at += len(own)
            if kind == ht.BOILERPLATE or has_article and kind in (ht.OPEN, ht.HINTED_OPEN) or kind in (ht.HINTED_ARTICLE, ht.HINTED_OPEN) and 2 * sum(gone) >= len(own):
                continue
            kept += [w for w, g in zip(own, gone, strict=True) if kind in (ht.ARTICLE, ht.HINTED_ARTICLE) or not g]
        out.append((i, " ".join(kept)))
    return sorted(map(str, out))


@pytest.mark.parametrize("most", [500, 3])
def test_whole_operator_by_brute_force(spark, monkeypatch, most):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(60)]
    parts = [" ".join(rng.choice(words, int(n))) for n in (3, 5, 9, 12, 20, 30)]
    forms = ["<p>{}</p>", "<div class='post-share'>{}</div>", "<div class=ad>{}</div>", "<nav>{}</nav>", "<article><p>{}</p><div class=more-related>{}</div></article>", "{}", "<li>{}</li>"]
    rows = []
    for i in range(160):
        html = "".join(f.replace("{}", str(rng.choice(parts)) if rng.random() < 0.6 else " ".join(rng.choice(words, int(rng.integers(0, 25))))) for f in rng.choice(forms, int(rng.integers(0, 6)), p=[0.3, 0.2, 0.1, 0.1, 0.06, 0.12, 0.12]))
        rows.append((None if i % 37 == 0 else i - i % 9 // 8, None if i % 41 == 0 else f"http://h{int(rng.choice([0, 0, 0, 1, 2]))}/p", None if i % 50 == 49 else html))
    rows += rows[:4]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    want = _brute_force_texts(rows)
    monkeypatch.setattr(ht, "SHARD_PAGES", most)
    assert sorted(str((r.page_id, r.text)) for r in ht.extract_text(df).collect()) == want
    plain = sorted(str((i, ht._kept(ht.blocks(h or ""), np.zeros(len([w for _, t in ht.blocks(h or "") for w in t.split(" ")]), bool)))) for i, _, h in rows)
    assert want != plain


def test_pages_with_large_hosts(spark, monkeypatch):
    rows = [(i, f"http://h{i % 2}/x", f"<article>{i}</article>") for i in range(50)] + [(None, None, None), (3, "http://h1/x", "<article>3</article>")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, html string, shards string")
    want = sorted(str((i, u, re.sub("<[^>]*>", "", h or ""))) for i, u, h in rows)
    for most, hosts in ((2000, 100), (5, 100), (5, 0)):
        monkeypatch.setattr(ht, "SHARD_PAGES", most)
        monkeypatch.setattr(ht, "BROADCAST_HOSTS", hosts)
        assert sorted(str((r.page_id, r.url, r.text)) for r in ht.extract_text(df).collect()) == want
    assert ht.extract_text(df.limit(0)).count() == 0


def test_runs_are_counted_over_whole_hosts(spark, monkeypatch):
    notice = "this site stores small files on your device to work well"
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(400)]
    htmls = [f"<div>{' '.join(rng.choice(words, 12))} {notice if i in (3, 40, 77) else ''}</div><nav>{notice[:9]}</nav>" for i in range(90)] + [f"<div>{notice} x{i}</div><article>a{i}</article>" for i in range(2)]
    df = spark.createDataFrame([(i, "http://h/x", h) for i, h in enumerate(htmls)], "page_id long, url string, html string").repartition(5)
    want = ht.host_texts([ht.blocks(h) for h in htmls])
    assert not any(notice in t for t in want)
    for most, hosts in ((2000, 100), (5, 100), (5, 0)):
        monkeypatch.setattr(ht, "SHARD_PAGES", most)
        monkeypatch.setattr(ht, "BROADCAST_HOSTS", hosts)
        assert [r.text for r in ht.extract_text(df).orderBy("page_id").collect()] == want


def _brute_force_repeated(rows):
    """How many words of each page are in runs of eight words on three distinct pages of a host."""
    parsed = [(i, re.match("[a-z]+://([^/?#]*)", u)[1], tuple(w for _, t in ht.blocks(h) for w in t.split(" ")), h) for i, u, h in rows]
    least, on = {}, {}
    for i, host, _, html in parsed:
        least[host, html] = min(i, least.get((host, html), i))
    for _, host, words, html in parsed:
        for k in range(len(words) - 7):
            on.setdefault((host, words[k : k + 8]), set()).add(least[host, html])
    covered = [[any(j + 8 <= len(w) and len(on[host, w[j : j + 8]]) >= 3 for j in range(max(0, k - 7), k + 1)) for k in range(len(w))] for _, host, w, _ in parsed]
    return sorted((i, sum(c)) for (i, *_), c in zip(parsed, covered, strict=True))


@pytest.mark.parametrize("most", [500, 3])
def test_arrays_judge_pages_with_articles_on_hosts_of_any_size(spark, monkeypatch, most):
    rng = np.random.default_rng(12)
    words = [f"w{k}" for k in range(300)]
    menus = [" ".join(rng.choice(words, 9)) for _ in range(12)]
    own = [" ".join(rng.choice(words, 30)) for _ in range(40)]
    htmls = [f"<nav>{rng.choice(menus)}</nav><article>{rng.choice(own)} {rng.choice(menus)}</article><footer>{rng.choice(menus)}</footer>" for _ in range(90)]
    rows = [(i - i % 7 // 6, f"http://h{i % 3 // 2}/p", h) for i, h in enumerate(htmls + htmls[:9])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    monkeypatch.setattr(ht, "SHARD_PAGES", most)
    got = ht.extract_text(df).collect()
    assert sorted((r.page_id, r.n_repeated) for r in got) == _brute_force_repeated(rows)
    assert sum(r.n_repeated for r in got) > 500
    assert sorted(r.text for r in got) == sorted(re.search("<article>(.*)</article>", h)[1] for *_, h in rows)


def test_runs_of_contexts_come_from_the_suffix_order(monkeypatch):
    rng = np.random.default_rng(3)
    pages = {}
    for _ in range(300):
        begin = int(rng.integers(0, 12))
        pages.setdefault(b" ".join(b"%d" % (k % 17 if rng.random() < 0.97 else 99) for k in range(begin, begin + int(rng.integers(8, 13)))), set()).add(f"p{rng.integers(0, 9)}")
    on = {}
    for context, some in pages.items():
        words = context.split(b" ")
        for k in range(len(words) - 7):
            on.setdefault(tuple(words[k : k + 8]), set()).update(some)
    want = {}
    for context in pages:
        words = context.split(b" ")
        if bits := sum(1 << k for k in range(len(words) - 7) if len(on[tuple(words[k : k + 8])]) >= 3):
            want[context] = bits
    assert 0 < len(want) < len(pages)
    assert ht.repeated_in_contexts(pages) == want
    monkeypatch.setattr(ht, "suffix_order", lambda ids: np.arange(len(ids)))
    assert ht.repeated_in_contexts(pages) != want


def test_equal_runs_of_a_host_have_equal_anchors():
    rng = np.random.default_rng(6)
    pages = [rng.integers(0, 3, int(n)).tolist() for n in rng.integers(0, 60, 80)]
    hosts = np.arange(80) % 2
    at, hashes = ht.anchors(np.array(sum(pages, []), np.uint64), np.array(list(map(len, pages))), hosts)
    found = dict(zip(at.tolist(), hashes.tolist(), strict=True))
    assert len(found) < sum(map(len, pages)) / 2
    anchors, begin = {}, 0
    for host, page in zip(hosts.tolist(), pages, strict=True):
        for k in range(len(page) - 7):
            own = {(j, found[begin + k + j]) for j in range(5) if begin + k + j in found}
            key = (host, tuple(page[k : k + 8]))
            anchors[key] = anchors.get(key, own) & own
        begin += len(page)
    assert anchors and all(anchors.values())


def test_word_ids_tell_words_apart():
    rng = np.random.default_rng(2)
    pages = [[], [""], ["a"], ["x" * 1_500_000, "b"], ["\u00e9", "a", "x" * 1_500_000, "x" * 1_499_999]] + [["ab"[int(k) % 2] * (int(k) // 2 + 1) for k in rng.integers(0, 40, 9)] for _ in range(30)]
    part = pa.record_batch({"blocks": pa.array([["left", "out"], *([" ".join(p[:2]), *p[2:]] if p else [] for p in pages)], pa.list_(pa.string()))}).slice(1)
    *words, sizes = ht._words(part)
    flat = [w for p in pages for w in p or [""]]
    assert sizes.tolist() == [len(p) or 1 for p in pages]
    assert [words[0][a:b].tobytes().decode() for a, b in zip(words[1], words[2], strict=True)] == flat
    ids = ht.word_ids(*words).tolist()
    assert len(set(ids)) == len(set(flat)) == len(set(zip(ids, flat, strict=True)))


def test_copies_and_repeated_rows_of_a_page_are_one_page(spark, monkeypatch):
    story = "a story of well over eight words that only this page tells"
    assert ht.host_texts([ht.blocks(f"<div>{story}</div>")] * 4) == [story] * 4
    ids = [(i, f"<div>{story}</div>") for i in (1, 2, 3, None)]
    again = [(9, f"<div>{story.upper()} {k}</div>") for k in range(4)]
    nulls = [(None, f"<div>three rows without id share these words of theirs here {k}</div>") for k in range(3)]
    df = spark.createDataFrame([(i, "http://h/x", h) for i, h in ids + again + nulls], "page_id long, url string, html string")
    want = sorted([story] * 4 + [f"{story.upper()} {k}" for k in range(4)] + ["0", "1", "2"])
    for most in (2000, 1):
        monkeypatch.setattr(ht, "SHARD_PAGES", most)
        assert sorted(r.text for r in ht.extract_text(df).collect()) == want


@pytest.mark.parametrize("text", [None, "", " \n\t", "a b c", "a b c a b c", "x y z q x y z", "l1\nl2\nl1\n\n \nl1", "a\x1fb c d", "# $ %% a*", "word " * 500, "é à\x0bü\x0c"])
def test_base_statistics_by_brute_force(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
    lines, seen, dup = t.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    base, features = ql.statistics(text)
    assert base == [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked)]
    assert len(features) == len(ql.FEATURES) and np.isfinite(features).all()


def test_trees_are_monotone_and_flat():
    rng = np.random.default_rng(5)
    x = rng.random((2000, 3))
    y = (x[:, 0] + 0.3 * rng.random(2000) - 0.6 * (x[:, 1] > 0.5) > 0.4).astype(float)
    trees = ql.fit_trees(x, y, [1, -1, 0])
    assert (((trees.score(x) > 0) == y).mean()) > 0.9
    probe = rng.random((300, 3))
    for f, sign in ((0, 1), (1, -1)):
        low, high = probe.copy(), probe.copy()
        low[:, f], high[:, f] = np.minimum(probe[:, f], 0.3), np.maximum(probe[:, f], 0.7)
        assert (sign * (trees.score(high) - trees.score(low)) >= -1e-12).all()
    for i in range(20):
        total = trees.bias
        for k in trees.roots:
            while trees.left[k] != k:
                k = trees.left[k] if probe[i, trees.feature[k]] <= trees.threshold[k] else trees.right[k]
            total += trees.value[k]
        assert total == pytest.approx(trees.score(probe[i : i + 1])[0])
    assert (ql.fit_trees(np.zeros((0, 3)), np.zeros(0), [0, 0, 0]).score(probe) == 0).all()
    assert ql.fit_trees(x, np.ones(2000), [0, 0, 0]).score(probe).min() > 0


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    order = labels.orderBy(F.xxhash64("doc_id"), "doc_id")
    trees = ql.fit_quality(docs, labels, sample=200)
    rest = order.offset(200).select("doc_id", "quality")
    judged = ql.judge(docs, trees).join(rest, "doc_id").where("not base_failed")
    right = judged.agg(F.avg(((F.col("quality") == 1) == F.col("kept")).cast("double"))).first()[0]
    assert right > 0.97
    assert sorted(r.doc_id for r in ql.keep_good(docs, trees).collect()) == sorted(r.doc_id for r in ql.judge(docs, trees).where("kept").collect())
    assert ql.judge(docs.limit(0), trees).count() == 0 and ql.fit_quality(docs, labels.limit(0)).score(np.zeros((1, len(ql.FEATURES)))).shape == (1,)


def test_sainte_lague_by_highest_quotients():
    rng = np.random.default_rng(6)
    for _ in range(100):
        n = int(rng.integers(1, 8))
        votes, most, seats = rng.integers(0, 50, n), rng.integers(0, 30, n), int(rng.integers(0, 120))
        want = np.zeros(n, int)
        for _ in range(min(seats, int(most[votes > 0].sum()))):
            q = np.where((want < most) & (votes > 0), votes / (2 * want + 1), -1)
            want[int(np.argmax(q))] += 1
        got = mx.sainte_lague(votes, seats, most)
        assert got.sum() == want.sum() and (got <= most).all()
        quotients = lambda s: sorted((votes[i] / (2 * k + 1) for i in range(n) for k in range(s[i])), reverse=True)  # noqa: E731, B023
        assert np.allclose(quotients(got), quotients(want))


def _mixed(spark, parts):
    rng = np.random.default_rng(7)
    rows = [(int(i), [None, "b", "a", "é", ""][int(rng.choice(5, p=[0.1, 0.5, 0.2, 0.15, 0.05]))], int(rng.integers(0, 900))) for i in range(3000)] + [(7, "a", 50), (7, "a", 50), (None, None, 20)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, source string, size long, taken int, shard int, turn int").repartition(parts)
    return rows, sorted(map(str, (tuple(r) for r in mx.mix(df).select("doc_id", "source", "size", "source_size", "target", "taken").collect()))), mx.mix(df)


def test_mix_meets_targets_and_reruns_agree(spark):
    rows, once, df = _mixed(spark, 2)
    assert once == _mixed(spark, 7)[1]
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * sizes[s], weights[s] * level) for s in order) < 1.5 * total else (low, level)
    got = df.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w"), F.min("target").alias("v"), F.max("source_size").alias("z"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    for r in got:
        want = min(2 * sizes[r.source], weights[r.source] * low)
        assert r.w == r.v == pytest.approx(want) and r.z == sizes[r.source] and r.over <= 0
        assert abs(r.t - want) <= 2 * mx.BLOCK_TOKENS
    assert len(once) == len(rows)


def test_words_taken_by_brute_force(spark):
    """Each row's words by walking over all tokens of its source, block by block."""
    rng = np.random.default_rng(16)
    rows = [(int(i) if i % 50 else None, ["a", "b", None][int(rng.choice(3, p=[0.7, 0.2, 0.1]))], int(rng.integers(0, 200))) for i in range(400)] + [(7, "a", 50), (7, "a", 50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(3)
    got = mx.mix(df).collect()
    marked = df.select("*", F.xxhash64(F.lit(8), "doc_id", "source", "size").alias("turn")).collect()
    every, per = len(rows), {}
    for r in marked:
        per.setdefault(r.source, []).append(r)
    shards = {s: max(1, len(rs) * int(every**0.5) // every) for s, rs in per.items()}
    units = {}
    for s, rs in per.items():
        for r in rs:
            units.setdefault((s, r.turn % shards[s]), []).append(r)
    plan = mx.plan_units([(s, k, sum(r["size"] for r in rs)) for (s, k), rs in units.items()], 8)
    times = {}
    for s, shard, _, _, start, first, base, run_start, run_end, wrap_end, _ in plan:
        n = sum(r["size"] for r in units[s, shard])
        for at in range(first, start + n, mx.BLOCK_TOKENS):
            times[s, at // mx.BLOCK_TOKENS] = base + (run_start <= at < run_end) + (first <= at < wrap_end)
    want = []
    for s in per:
        at = 0
        for k in sorted(k for q, k in units if q == s):
            for r in sorted(units[s, k], key=lambda r: (r.turn, r.doc_id is not None, r.doc_id or 0, r["size"])):
                want.append((r.doc_id, s, r["size"], sum(times[s, t // mx.BLOCK_TOKENS] for t in range(at, at + r["size"]))))
                at += r["size"]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.source, r["size"], r.taken)) for r in got)


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mx.mix(empty).count() == 0
    zeros = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r.taken for r in mx.mix(zeros).collect()] == [0, 0]
    texts = spark.createDataFrame([(1, "a b c", "s"), (2, None, "s"), (3, "", "t")], "doc_id long, text string, source string")
    assert {r.doc_id for r in mx.mix_documents(texts).collect()} <= {1}


def test_first_split_by_brute_force():
    rng = np.random.default_rng(17)
    for _ in range(20):
        x = rng.integers(0, 6, (60, 3)).astype(float)
        y = (rng.random(60) < 0.2 + 0.6 * (x[:, int(rng.integers(3))] > 2)).astype(float)
        if not 0 < y.sum() < 60:
            continue
        trees = ql.fit_trees(x, y, [0, 1, -1], trees=1, depth=1, rate=1.0, least=2.0, penalty=1.0)
        p = y.mean()
        grad, hess = p - y, np.full(60, p * (1 - p))
        value = lambda m: -grad[m].sum() / (hess[m].sum() + 1.0)  # noqa: E731, B023
        gain = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1.0) / 2  # noqa: E731, B023
        best = (1e-6, None)
        for f, sign in enumerate((0, 1, -1)):
            for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])):
                low = x[:, f] <= cut
                if low.all() or not low.any() or hess[low].sum() < 2 or hess[~low].sum() < 2 or sign * (value(~low) - value(low)) < 0:
                    continue
                won = gain(low) + gain(~low) - gain(np.ones(60, bool))
                if won > best[0] + 1e-12:
                    best = (won, low)
        scores = trees.score(x) - trees.bias
        want = np.where(best[1], value(best[1]), value(~best[1])) if best[1] is not None else np.full(60, value(np.ones(60, bool)))
        assert np.allclose(scores, want)


def test_stages_on_nulls_empty_tables_and_clashing_names(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, fp int, score double, row int"
    words = " ".join(f"word{k} is number {k}" for k in range(40))
    rows = [(1, words, "en", "a", len(words), 1, 2, 0.5, 3), (1, words, "en", "a", len(words), 1, 2, 0.5, 3), (2, None, None, None, None, None, None, None, None), (None, words + " more", "en", None, 5, 1, 1, 1.0, 1), (3, "", "en", "b", 0, 1, 1, 1.0, 1), (4, words.upper() + "\n\nx" * 50, "de", "b", 9, 1, 1, 1.0, 1), (None, None, None, "c", 1, 1, 1, 1.0, 1)]
    df = spark.createDataFrame(rows, schema)
    for now in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, SF)
            assert out.columns == df.columns or name == "sentencepiece"
            found = out.collect()
            if now is not df:
                assert found == []
            if name in ("quality_rules", "line_dedup", "simhash"):
                assert all(r.text is None or isinstance(r.text, str) for r in found)
    kept = corpus_pipeline.STAGES[2][1](spark, df, SF)
    assert {r.doc_id for r in kept.collect()} >= {None, 1, 2}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash", "mixing", "sentencepiece"]
    now, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, SF)
        if name != "sentencepiece":
            assert now.columns == columns
        assert now.count() > 0
        if name != "mixing":
            assert {r[0] for r in now.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
    assert now.count() == corpus_pipeline.run(spark, SF).count()
