import html as H
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import chat_format, html_text, jaccard_join, lattice_dedup
from corpusloom.llm.components import components

from .helpers import HAS_DATA, ROWS, SF, documents, words


def united(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [*rng.integers(0, 300, (200, 2)).tolist(), *[(i, i + 1) for i in range(400, 460)], *[(500, i) for i in range(501, 540)], (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame([tuple(x) for x in links] + [(None, 1)], "a long, b long")).collect()}
    roots, least = united(600, links), {}
    for i, r in enumerate(roots):
        least[r] = min(i, least.get(r, i))
    assert got == {i: least[roots[i]] for x in links if x[0] != x[1] for i in x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Jaccard join


def brute_join(rows):
    sets = []
    for _, t, *_ in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(t)]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    roots, least = united(len(rows), links), defaultdict(list)
    for r, row in zip(roots, rows):
        if row[0] is not None:
            least[r].append(row[0])
    return sorted((repr(row[0]), len(s), repr(min(least[r]) if least[r] else None)) for r, s, row in zip(roots, sets, rows))


def planted(seed, n=260):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [list(rng.choice(vocabulary, int(rng.integers(3, 50)))) for _ in range(12)]
    shared, rows = list(rng.choice(vocabulary, 30)), []
    for i in range(n):
        b = list(base[int(rng.integers(0, 12))])
        for _ in range(int(rng.choice([0, 0, 1, 1, 2, 4]))):
            b.insert(int(rng.integers(0, len(b) + 1)), str(rng.choice(vocabulary)))
        if rng.random() < 0.3:
            b = shared + b[: int(rng.integers(0, 14))]
        rows.append((int(i * 3 + 5), " ".join(b), None, None))
    return [*rows, (9000, "a b", None, None), (9001, "A  B", None, None), (9002, "a", None, None), (9003, "Á", None, None), (9004, "á", None, None), *ROWS]


@pytest.mark.parametrize("seed,short,sublist", [(0, 8, 4096), (1, 2, 8), (2, 0, 3)])
def test_join_matches_brute_force(spark, monkeypatch, seed, short, sublist):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard_join, "SUBLIST", sublist)
    monkeypatch.setattr(jaccard_join, "FREQUENT_SETS", 2 if short < 8 else 8)
    monkeypatch.setattr(jaccard_join, "GROUP", 4)
    monkeypatch.setattr(jaccard_join, "DENSE", 128 if short == 8 else 1)
    monkeypatch.setattr(jaccard_join, "SOME", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2048 if short == 8 else 5)
    rows = planted(seed)
    got = jaccard_join.jaccard_components(documents(spark, rows)).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == brute_join(rows)


def test_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(documents(spark, [])).count() == 0
    assert [tuple(r) for r in jaccard_join.jaccard_components(documents(spark, [(1, None, None, None)])).collect()] == [(1, 0, 1)]


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=80, unique=True), st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=80, unique=True), st.integers(0, 80))
def test_sketches_never_rule_out_a_link(a, b, common):
    x, y = np.unique(np.array(a, np.uint64)), np.unique(np.array(a[:common] + b, np.uint64))
    inter = len(np.intersect1d(x, y))
    linked = 4 * inter >= 3 * (len(x) + len(y) - inter)
    assert (inter >= jaccard_join.least_overlap(len(x), len(y))) == linked
    if linked:
        assert jaccard_join.sketch_allows(jaccard_join.odd_sketch(x), len(x), jaccard_join.odd_sketch(y), len(y))


def test_list_skipping_equals_the_filter():
    rng = np.random.default_rng(3)
    p = np.empty(200, jaccard_join._POSTING)
    p["key"], p["id"], p["size"] = 1, np.arange(200), rng.integers(4, 60, 200)
    p["pos"] = [rng.integers(0, jaccard_join.prefix_length(int(s))) for s in p["size"]]
    lst = jaccard_join.IndexList(p)
    for i in range(200):
        a, pa = int(lst.size[i]), int(lst.pos[i])
        want = [j for j in range(200) if min(a - pa, lst.size[j] - lst.pos[j]) >= jaccard_join.least_overlap(a, int(lst.size[j]))]
        assert sorted(lst.partners(a, pa)) == want


# Lattice


def test_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 2
    p = lattice_dedup.nearest_point(x)
    assert ((2 * p) % 2 == (2 * p[:, :1]) % 2).all() and (p.sum(1) % 2 == 0).all()
    mine = ((x - p) ** 2).sum(1)
    for v in lattice_dedup.MINIMAL:
        assert (((x - p - v) ** 2).sum(1) >= mine - 1e-9).all()
    assert mine.max() <= 1 + 1e-9 and len(lattice_dedup.MINIMAL) == 240


def brute_links(rows, least=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if o else None for o, (_, v) in zip(ok, rows)]
    unit = [u / np.sqrt(u @ u) if u is not None else None for u in unit]
    return [(i, j) for i in range(len(rows)) for j in range(i) if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least - 1e-15]


def run_lattice(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "v", "node", "hub", "key", "label")})
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice_dedup.near_duplicates(df).collect()}


def test_near_duplicates(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 64))
    rows = [(i * 2 + 3, (base[i % 12] / 8 + rng.normal(size=64) * rng.choice([0.005, 0.01, 0.02])).tolist()) for i in range(240)]
    rows += [(5000 + i, base[0].tolist()) for i in range(60)]
    rows += [(1, None), (6000, [0.0] * 64), (6001, [1.0, None]), (6002, [float("nan")] * 64), (6003, [float("inf"), 1.0]), (6004, []), (6005, [1e300] * 64), (6006, [1e300] * 64), (6007, [1.0, 2.0]), (6008, [2.0, 4.0])]
    got, links = run_lattice(spark, rows), brute_links(rows)
    n, roots = Counter(i for x in links for i in x), united(len(rows), links)
    least = {}
    for r, (i, _) in zip(roots, rows):
        least[r] = min(i, least.get(r, i))
    assert got == {i: (n[k], least[roots[k]], i == least[roots[k]]) for k, (i, _) in enumerate(rows)}
    assert run_lattice(spark, []) == {}


def test_repeated_and_null_ids_of_vectors(spark):
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.01]), (None, [0.99, 0.0]), (5, [0.0, 1.0]), (5, [0.0, 1.0]), (None, None), (7, [2.0, 0.1]), (None, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice_dedup.near_duplicates(df).collect() if r.vec_id is not None)
    assert got == [(3, 3, 3, True), (3, 3, 3, True), (5, 1, 5, True), (5, 1, 5, True), (7, 3, 3, False)]
    null = sorted(((r.n_links, r.component_id, r.kept) for r in lattice_dedup.near_duplicates(df).collect() if r.vec_id is None), key=repr)
    assert null == [(0, None, False), (0, None, False), (3, 3, False)]


def test_groups_of_pairs_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "GROUP", 50)
    monkeypatch.setattr(lattice_dedup, "PARTNERS", 3)
    test_near_duplicates(spark)


@pytest.mark.parametrize("cell,cliques,block", [(1, 1, 1024), (1, 0, 7), (3, 10, 2)])
def test_blocks_of_hot_cells_agree(spark, monkeypatch, cell, cliques, block):
    monkeypatch.setattr(lattice_dedup, "HOT_CELL", cell)
    monkeypatch.setattr(lattice_dedup, "HOT_CLIQUES", cliques)
    monkeypatch.setattr(lattice_dedup, "BLOCK", block)
    test_near_duplicates(spark)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    for cos, want in ((0.9, 0.93), (0.95, 0.999)):
        y = cos * x + np.sqrt(1 - cos * cos) * z
        (a, pa), (b, pb) = lattice_dedup.cells(x), lattice_dedup.cells(y)
        found = (a == b).any(1) | (pa == b[:, :, None]).any((1, 2)) | (pb == a[:, :, None]).any((1, 2))
        assert found.mean() > want


# Pages


def brute_runs(streams, run):
    seen = defaultdict(set)
    for k, s in enumerate(streams):
        for i in range(len(s) - run + 1):
            seen[tuple(s[i : i + run])].add(k)
    out = []
    for s in streams:
        hit = [False] * len(s)
        for i in range(len(s) - run + 1):
            if len(seen[tuple(s[i : i + run])]) > 1:
                hit[i : i + run] = [True] * run
        out.append(hit)
    return out


@settings(deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), min_size=1, max_size=6))
def test_suffix_array_finds_repeated_runs(streams):
    assert [x.tolist() for x in html_text.repeated(streams)] == brute_runs(streams, html_text.RUN)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header class=top>Site</header>
<nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use</div><!-- x --><article><header><h1>T &amp;amp; x</h1></header><p><b>A<i>b</i> c<br><p>two&nbsp; lines
here &lt;p&gt;<div class="share-buttons">share</div><form><input>q</form><ul><li>one<li>two</ul><section class="comments"><p>nice</section><p hidden>h</article><aside>s</aside><footer>f"""


def test_blocks():
    assert html_text.main_texts([html_text.blocks_of(PAGE)]) == ["T &amp; x\nAb c\ntwo lines here <p>\none\ntwo"]
    assert html_text.blocks_of("a < b <p title='x>y'>z</p><![CDATA[q&r]]> <!-- u") == [(1, "a < b"), (1, "z"), (1, "q&r")]
    assert html_text.blocks_of("") == html_text.blocks_of("<<>") [:0] == []


@pytest.mark.parametrize("page", ["<a " + '"' * 200_001, "<a " * 200_000, '<a ">' * 100_000, "<div>" * 50_000 + "</span>" * 100_000, "<" * 300_000, "<!--" * 100_000, "<b>" * 20_000 + "<p>x</b>" * 20_000, "<li>" * 100_000])
def test_parsing_is_linear(page):
    import time

    start = time.process_time()
    html_text.blocks_of(page)
    assert time.process_time() - start < 5


def test_pages_without_an_article(spark):
    menu, foot = "Home News Sport Weather Culture Science Travel Contact About", "Copyright of this site and all of its many friendly authors 2024"
    page = lambda i: f"<div>{menu}</div><div>unique story number {i} about thing {i * 7} that is told once only</div><div>{foot}</div>"
    rows = [(i, f"http://h{i % 2}.example/{i}?x", page(i)) for i in range(10)] + [(20, None, "<p>alone</p>"), (21, "http://h0.example/", None), (21, "http://h0.example/", ""), (None, "x", "<p>y</p>"), (4, "http://h0.example/4?x", page(4))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("z") for c in ("id", "host", "part", "zones", "texts", "text", "h")})
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect()), key=repr)
    text = lambda i: f"unique story number {i} about thing {i * 7} that is told once only"
    # Page 4 is there twice: copies have their story each, though it stands on two pages.
    want = [(i, text(i), len(text(i))) for i in [*range(10), 4]] + [(20, "alone", 5), (21, "", 0), (21, "", 0), (None, "y", 1)]
    assert got == sorted(want, key=repr)
    assert html_text.extract(df.where("false")).count() == 0


@pytest.mark.parametrize("pages", [4, 64])
def test_runs_are_found_across_the_groups_of_a_host(spark, monkeypatch, pages):
    monkeypatch.setattr(html_text, "PAGES", pages)
    story = lambda i: f"unique story number {i} about thing {i * 7} that is told once only"
    foot = "Copyright of this site and all of its many friendly authors 2024"
    rows = [(i, "http://h.example/", f"<div>{story(i)}</div>" + (f"<div>{foot}</div>" if i % 20 == 0 else "")) for i in range(40)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(i, story(i)) for i in range(40)]


@pytest.mark.parametrize("pages", [4, 64])
def test_copies_of_a_page_keep_their_text(spark, monkeypatch, pages):
    monkeypatch.setattr(html_text, "PAGES", pages)
    story = lambda i: f"unique story number {i} about thing {i * 7} that is told once only"
    foot = "Copyright of this site and all of its many friendly authors 2024"
    rows = [(100 * c + i, f"http://h.example/{c}", f"<div>{story(i)}</div><div>{foot}</div>") for i in range(12) for c in range(3)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted((100 * c + i, story(i)) for i in range(12) for c in range(3))


def test_names_of_elements():
    for name in ("share-buttons", "cookieNotice", "ad", "ad-slot-3", "sidebar left", "nav_bar", "newsletter-signup", "col-2 related-posts", "comments"):
        assert html_text._names(name, html_text._SIGNS), name
    for name in ("market-share", "legal-notice-analysis", "lead", "shareholders", "article-body", "social-policy", "search-for-truth", "widgetry", "box"):
        assert not html_text._names(name, html_text._OUTER_SIGNS), name


@pytest.mark.parametrize("pages", [4, 64])
def test_open_blocks_beside_an_article_and_notices_in_main(spark, monkeypatch, pages):
    monkeypatch.setattr(html_text, "PAGES", pages)
    story = lambda i: f"unique story number {i} about thing {i * 7} that is told once only"
    foot, notice = "Copyright of this site and all of its many friendly authors 2024", "All of the times on this page are local ones, as they were"
    beside = lambda i: f"<h1>Title {i}</h1><article><p>teaser {i}</p></article><div>{story(i)}</div><div>{foot}</div>"
    within = lambda i: f"<main><h1>Title {i}</h1><p>{notice}</p><article><p>{story(i)}</p></article></main>"
    rows = [(i, f"http://h{i % 2}.example/", (within if i % 2 else beside)(i)) for i in range(40)]
    # Two stories of a main element that are the same on two pages are no notices, nor is what is all of a main element.
    rows += [(40 + i, "http://h1.example/", f"<main><p>{story(99)}</p><p>{story(40 + i)}</p></main>") for i in range(2)] + [(50, "http://h1.example/", f"<main><p>{notice}</p></main>")]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert got[i] == (f"Title {i}\n{story(i)}" if i % 2 else f"Title {i}\nteaser {i}\n{story(i)}")
    assert [got[i] for i in (40, 41, 50)] == [f"{story(99)}\n{story(40)}", f"{story(99)}\n{story(41)}", notice]


def brute_pages(hosts):
    """The rule for pages given as blocks, said again: host → {page: blocks} gives page → text."""
    out = {}
    for pages in hosts.values():
        streams = {i: [t for zone, text in blocks if zone != html_text.ARTICLE for t in [*text.split(" "), "\n"]] for i, blocks in pages.items()}
        seen = defaultdict(set)
        for i, s in streams.items():
            for k in range(len(s) - 7):
                seen[tuple(s[k : k + 8])].add(tuple(pages[i]))
        most = max(3, -(-len({tuple(b) for b in pages.values()}) // 2))
        whole = defaultdict(set)
        for blocks in pages.values():
            for zone, text in blocks:
                if zone != html_text.ARTICLE and len(text.split(" ")) < 8:
                    whole[text].add(tuple(blocks))
        for i, blocks in pages.items():
            s, kept, at = streams[i], [], 0
            hit = {least: {j for k in range(len(s) - 7) if len(seen[tuple(s[k : k + 8])]) >= least for j in range(k, k + 8)} for least in (2, most)}
            size = lost = 0
            for zone, text in blocks:
                n = len(text.split(" "))
                if zone == html_text.ARTICLE:
                    kept.append((text, True, zone))
                    size += n
                    continue
                own = sum(j in hit[most if zone == html_text.MAIN else 2] for j in range(at, at + n))
                at += n + 1
                unique = own < 0.8 * n and len(whole[text]) < most
                if zone != html_text.BOILERPLATE:
                    kept.append((text, unique, zone))
                if zone == html_text.MAIN:
                    size, lost = size + n, lost + n * (not unique)
            out[i] = "\n".join(text for text, unique, zone in kept if unique or zone == html_text.MAIN and 2 * lost >= size)
    return out


@pytest.mark.parametrize("pages", [4, 64, 1000])
def test_results_do_not_depend_on_how_a_host_is_dealt(spark, monkeypatch, pages):
    """Short menus and footers go; a notice is judged by different pages, so copies of a page do not make it rarer or more frequent."""
    monkeypatch.setattr(html_text, "PAGES", pages)
    story = lambda i: f"story {i} of thing {i * 7} is number {i * 13} here told for {i * 17}"
    notice = "All times on this page are local ones always"
    short = lambda i: f"<div>Home News Sport</div><div>{story(i)}</div><div>Yes</div><div>{story(i + 30)}</div><div>Copyright 2020 Foo Inc</div>" if i < 3 else f"<div>Home News Sport</div><div>{story(i)}</div><div>Copyright 2020 Foo Inc</div>"
    rows = [(i, "http://short.example/", short(i)) for i in range(10)]
    rows += [(100 + i, "http://copies.example/", f"<main><p>{story(i)}</p><p>{notice}</p></main>" if i < 24 else f"<main><p>{story(50)}</p></main>") for i in range(80)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(10)] == [f"{story(i)}\nYes\n{story(i + 30)}" if i < 3 else story(i) for i in range(10)]
    assert [got[100 + i] for i in range(80)] == [story(i) if i < 24 else story(50) for i in range(80)]  # 24 of 25 different pages have the notice


@pytest.mark.parametrize("seed,pages", [(0, 64), (1, 64), (2, 4), (3, 4)])
def test_pages_match_brute_force(spark, monkeypatch, seed, pages):
    monkeypatch.setattr(html_text, "PAGES", pages)
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    some = lambda n: " ".join(rng.choice(vocabulary, n))
    shared = [some(int(n)) for n in rng.integers(2, 25, 12)]
    wrap = {html_text.OPEN: "<div>{}</div>", html_text.ARTICLE: "<article><p>{}</p></article>", html_text.MAIN: "<main><p>{}</p></main>", html_text.BOILERPLATE: "<nav>{}</nav>"}
    hosts, rows = defaultdict(dict), []
    for i in range(90):
        host = f"h{int(rng.choice([0, 0, 0, 1, 2]))}.example"
        zones = rng.choice(list(wrap), int(rng.integers(0, 7)), p=[0.5, 0.15, 0.2, 0.15])
        blocks = [(int(z), str(rng.choice(shared)) if rng.random() < 0.5 else some(int(rng.integers(1, 30)))) for z in zones]
        hosts[host][i] = blocks
        if rng.random() < 0.1 and blocks:
            hosts[host][1000 + i] = blocks  # a copy
    for host, own in hosts.items():
        rows += [(i, f"http://{host}/{i}", "".join(wrap[z].format(t) for z, t in blocks)) for i, blocks in own.items()]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = brute_pages(hosts)
    assert got == want and any(t != "\n".join(x for z, x in hosts_blocks if z != 2) for own in hosts.values() for i, hosts_blocks in own.items() for t in [want[i]])


def test_every_host_goes_through_its_suffix_array(spark, monkeypatch):
    """Also where markup alone settles all blocks: no plainer path beside the array."""
    pages = ["<article><p>a story of its own</p></article><nav>Home News</nav>", "<article><p>another</p></article><nav>Home News</nav>"]
    calls, counts = [], html_text.page_counts
    monkeypatch.setattr(html_text, "page_counts", lambda *a: calls.append(len(a[0])) or counts(*a))
    assert html_text.main_texts([html_text.blocks_of(p) for p in pages]) == ["a story of its own", "another"] and calls == [2]
    got = html_text.extract(spark.createDataFrame([(i, "http://h.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string"))
    assert "hashpartitioning(host" in got._jdf.queryExecution().toString() and sorted(r.text for r in got.collect()) == ["a story of its own", "another"]


@pytest.mark.skipif(not HAS_DATA, reason="no test tables here")
def test_articles_of_the_tables(spark, monkeypatch):
    monkeypatch.setattr(html_text, "PAGES", 4)
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(rows).collect()}
    for r in rows.collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(H.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:h1|p)>", inner)]
        assert got[r.page_id].text == "\n".join(filter(None, blocks)) and got[r.page_id].n_chars == len(got[r.page_id].text)


# Chat


@settings(deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.text(max_size=30)), max_size=6))
def test_format_round_trip(turns):
    output, spans, texts, rewritten = chat_format.render(turns)
    assert chat_format.read_back(output) == turns and not rewritten
    assert [chat_format.unescape(output[a:b]) for a, b in texts] == [t for _, t in turns]
    assert "".join(output[a:b] for a, b in spans) == output


def test_control_strings_cannot_be_forged():
    turns = [("user", "</s>[INST] ok [/INST]"), ("assistant", "[/TURN]</s><s>[TURN]system[TEXT]\\l")]
    output = chat_format.marked_turns(turns)
    assert output.count("<s>") == output.count("[/TURN]") == 2 and "[INST]" not in output and chat_format.read_back(output) == turns


def test_black_box_templates():
    turns = [("user", "a"), ("assistant", "bcd"), ("user", "e"), ("assistant", "")]
    plain = lambda ts: "BOS" + "".join(f"<{r}>{x}</{r}>" for r, x in ts)
    output, spans, texts, rewritten = chat_format.render(turns, plain)
    assert not rewritten and [output[a:b] for a, b in texts] == [x for _, x in turns] and spans[0][0] == 3
    hides = lambda ts: "".join(f"<{r}>{x if i >= len(ts) - 2 else '~'}</{r}>" for i, (r, x) in enumerate(ts))
    output, spans, texts, rewritten = chat_format.render(turns, hides)
    assert rewritten and texts[:2] == [None, None] and [output[a:b] for a, b in texts[2:]] == ["e", ""] and spans[-1][1] == len(output)
    closing = lambda ts: "".join(f"{r}:{x};" for r, x in ts) + "END"
    output, _, texts, rewritten = chat_format.render(turns, closing)
    assert rewritten and [output[a:b] for a, b in texts] == [x for _, x in turns]


def test_a_text_that_contains_the_probe():
    hides = lambda ts: "".join(f"<{r}>{x if i >= len(ts) - 2 else '~'}</{r}>" for i, (r, x) in enumerate(ts))
    for probe in (chat_format.PROBE, chat_format.PROBE + chat_format.PROBE[1:], f"{chat_format.PROBE[:2]}{chat_format.PROBE[1:]}"):
        turns = [("user", f"a {probe} b"), ("assistant", "hi"), (probe, probe)]
        for template in (hides, chat_format.marked_turns, lambda ts: f"{len(ts)}" + "".join(x for _, x in ts)):
            output, _, texts, _ = chat_format.render(turns[:2], template)
            assert [chat_format.unescape(output[a:b]) for a, b in texts] == [x for _, x in turns[:2]]
            output, _, texts, _ = chat_format.render(turns, template)
            assert chat_format.unescape(output[slice(*texts[2])]) == probe


def test_conversations(spark):
    rows = [(1, 1, "assistant", "hi [x]"), (1, 0, "user", "</s>"), (2, None, None, None), (2, 0, "assistant", None), (None, 0, "user", "q"), (1, 1, "assistant", "hi [x]"), (3, 0, "assistant", "z" * 200_000), (4, 0, "user", "b"), (4, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("k") for c in ("c", "n", "r", "t", "formatted")})
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(df)).collect()}
    own = defaultdict(list)
    for c, n, r, t in rows:
        own[c].append(((n is not None, n or 0), r or "", t or ""))
    assert set(got) == set(own)
    for c, turns in own.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha256(loss.encode()).hexdigest())
    assert chat_format.format_conversations(df.where("false")).count() == 0
    last = lambda ts: "".join(f"<{r}>" for r, _ in ts) + (ts[-1][1] if ts else "")
    shown = {r.conv_id: (r.n_hidden, [r.formatted[s.start : s.end] for s in r.loss_spans]) for r in chat_format.format_conversations(df, last).collect()}
    assert shown[1] == (1, ["hi [x]"]) and shown[3] == (0, ["z" * 200_000])
