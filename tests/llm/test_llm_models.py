"""SimHash links, vantage-point search, line field and page text against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leadlift.llm import line_crf, queries, simhash, site_style, vantage
from leadlift.llm.components import connected


def plain_simhash(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{doc_id: component} by comparing all pairs."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in ids}


def test_simhash_query_is_brute_force(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    prints = {i: plain_simhash(t) for i, t in docs.items()}
    components = plain_components(prints)
    rows = queries.op7_simhash(spark, small).collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == components[row["doc_id"]]


def clustered(count, seed):
    """Distinct points, many of them chains and clouds of few different bits."""
    draw = random.Random(seed)
    points = set()
    while len(points) < count:
        point = draw.getrandbits(64)
        for _ in range(draw.choice((1, 1, 1, 5, 60))):
            points.add(point)
            for _ in range(draw.randint(1, 6)):
                point ^= 1 << draw.randrange(64)
    return sorted(points)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_shards_lose_no_link(spark, monkeypatch, bits):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 64)
    monkeypatch.setattr(simhash, "HOME_BLOCK", 40)
    monkeypatch.setattr(simhash, "VISITOR_BLOCK", 100)
    points = np.array(clustered(1500, bits), dtype=np.uint64)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp bigint")
    got = {r["node"]: r["root"] for r in connected(simhash.links(table, bits)).collect()}
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= bits
    forest = simhash.Forest(len(points))
    forest.add(*np.nonzero(close))
    forest.merge()
    signed = points.view(np.int64)
    expected = {}
    for i, r in enumerate(forest.root):
        expected.setdefault(int(r), []).append(int(signed[i]))
    assert {frozenset(g) for g in expected.values() if len(g) > 1} == {
        frozenset(n for n, r in got.items() if r == root) for root in set(got.values())
    }


def test_near_duplicates_of_odd_rows(spark):
    rows = [(9, None, "a"), (4, "", "b"), (7, " \t", "c"), (5, "One two", "d"), (5, "One two", "d"), (None, "one two", "e"), (8, "x y z w v", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(9, 4), (4, 4), (7, 4), (5, 5), (None, 5), (8, 8)}
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(4, "", "b"), (5, "One two", "d"), (None, "one two", "e"), (8, "x y z w v", None)], key=str
    )
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, j) for j in range(2000, 2300)] + [(5, 5), (None, 1)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000} | {j: 1000 for j in range(2000, 2300)}


def brute_nearest(vectors, k, every):
    ids = sorted(vectors)
    table = np.array([vectors[i] for i in ids])
    out = {}
    for i in ids:
        if i % every == 0:
            scores = table @ vectors[i]
            found = sorted(((-s, j) for s, j in zip(scores.tolist(), ids) if j != i))[:k]
            out[i] = [j for _, j in found]
    return out


def rows_by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def test_factor_one_is_exact(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 12))
    vectors = {i: (centres[i % 6] + 0.3 * draw.normal(size=12)).tolist() for i in range(900)}
    table = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>")
    got = rows_by_query(vantage.nearest(table, k=10, every=20, factor=1.0, shard_rows=200).collect())
    assert got == brute_nearest({i: np.array(v) for i, v in vectors.items()}, 10, 20)


def test_recall_on_the_table(spark, medium):
    rows = spark.read.parquet(f"{medium}/embeddings.parquet").collect()
    exact = brute_nearest({r["vec_id"]: np.array(r["embedding"]) for r in rows}, 20, 20)
    found = queries.op2_vantage_search(spark, medium).collect()
    got = rows_by_query(found)
    assert set(got) == set(exact) and all(len(v) == 20 for v in got.values())
    assert sum(len(set(got[q]) & set(exact[q])) for q in exact) / sum(map(len, exact.values())) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (None, [1.0, 1.0]), (1, [1.0, 1.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, rank int")
    got = [tuple(r) for r in vantage.nearest(table, k=5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 0, 0.0)]
    assert vantage.nearest(table.limit(0)).count() == 0
    assert vantage.nearest(table.where("vec_id = 20")).count() == 0


def test_chain_marginals_are_those_of_all_labellings():
    draw = np.random.default_rng(1)
    sizes, moves = np.array([1, 3, 5]), draw.normal(size=(2, 2))
    odds = draw.normal(size=(3, 5)) * 3
    logz, good, pairs = line_crf.chain(np.where(np.arange(5) < sizes[:, None], odds, 0), sizes, moves)
    for d, size in enumerate(sizes):
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(size)):
            score = sum(odds[d, t] * y for t, y in enumerate(labels))
            weights[labels] = np.exp(score + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total = sum(weights.values())
        assert np.isclose(logz[d], np.log(total))
        for t in range(size):
            assert np.isclose(good[d, t], sum(w for y, w in weights.items() if y[t]) / total)
        for a, b in itertools.product((0, 1), repeat=2):
            expected = sum(w * sum(p == (a, b) for p in zip(y, y[1:])) for y, w in weights.items()) / total
            assert np.isclose(pairs[d, a, b], expected)


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.op8_quality(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    accuracy = np.mean([r["predicted"] == r["quality"] for r in rows])
    assert auc > 0.95 and accuracy > 0.95
    assert np.mean([s >= line_crf.THRESHOLD for s in good]) > 0.98


def test_quality_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", None), (3, "\n\n", "y"), (3, "\n\n", "y"), (None, "a" * 50000, "z"), (4, "l\n" * 20000, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame(
        [(i, q, None) for i, q in ((1, 1), (2, 0), (3, 1), (4, 0), (5, 1), (None, 0), (7, None))],
        "doc_id bigint, quality int, toxic int",
    )
    got = line_crf.quality(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    kept = line_crf.keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert line_crf.quality(docs, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    assert line_crf.quality(docs.limit(0), labels).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><script>var a='</p>';</script><style>p{{}}</style></head><body>"
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav><!-- x --><div class=\"ad\">Buy</div><div class='{box}'>{same}</div>"
    "<article><h1>Head  {n}</h1><p><b>First\n {n}.<br><p>Second &lt;b&gt; &eacute;&nbsp;x.</p></article>"
    "<div id=comments><p>nice</p></div><form><p>Mail</p></form><footer>&copy; all</footer></body></html>"
)


def test_main_text(spark):
    pages = [(i, f"https://h.example/{i}", PAGE.format(n=i, box="box", same="Same everywhere")) for i in range(8)]
    plain = "<body><div class=top>Welcome to us</div><div class=story><p>Story number {n} tells {n}</p></div></body>"
    pages += [(100 + i, f"http://k.example/{i}", plain.replace("{n}", str(i))) for i in range(9)]
    odd = [(200, None, None), (201, "no url", ""), (202, "http://z/", "<p>open <i>in"), (203, "http://z/", "a < b <"), (None, "http://z/", "<script>x"), (204, "http://z/", "<p>d</p>")]
    pages += odd + odd[-1:]
    table = spark.createDataFrame([(*p, "t") for p in pages], "page_id bigint, url string, html string, text string")
    rows = site_style.extract_main_text(table).collect()
    assert len(rows) == len(pages)
    got = {r["page_id"]: r["text"] for r in rows}
    for i in range(8):
        assert got[i] == f"Head {i}\nFirst {i}.\nSecond <b> é x."
    for i in range(9):
        assert got[100 + i] == f"Story number {i} tells {i}"
    assert (got[200], got[201], got[202], got[203], got[None], got[204]) == ("", "", "open in", "a < b <", "", "d")
    assert site_style.extract_main_text(table.limit(0)).count() == 0


def test_main_text_of_the_table(spark, medium):
    """The given pages are an article between a menu, an advert and a footer; its blocks are read by splitting."""
    import html
    import re

    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{medium}/pages.parquet").collect()}
    rows = queries.op10_main_text(spark, medium).collect()
    assert len(rows) == len(source)
    for row in rows:
        inside = re.search(r"<article>(.*?)(?:</article>|<footer>)", source[row["page_id"]], re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", inside)
        texts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in blocks]
        assert row["text"] == "\n".join(t for t in texts if t)
        assert row["n_chars"] == len(row["text"])


def test_a_common_host_keeps_articles_it_repeats(spark):
    pages = [(i, "http://h.example/", PAGE.format(n=i if i % 3 else 0, box="b", same="s")) for i in range(30)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    tree = site_style.style_tree(table).where(F.col("place").endswith("article/p")).first()
    assert tree["pages"] == 30
    texts = [r["text"] for r in site_style.extract_main_text(table).collect()]
    assert all(t.startswith("Head") and "Second" in t for t in texts)


def test_rare_elements_of_copies_stay(spark):
    page = "<article><h1>Head {n}</h1><p>Text of {n}.</p><p>More of {n}.</p>{rare}</article>"
    copy = page.format(n="all", rare="<blockquote>Said once</blockquote>")
    pages = [(i, "http://h.example/", page.format(n=i, rare="")) for i in range(8)]
    pages += [(100 + i, "http://h.example/copy", copy) for i in range(2)]
    # as many copies as there may be, on one host or on a host each
    pages += [(200 + i, "http://h.example/copies", copy.replace("blockquote", "h2")) for i in range(9)]
    pages += [(300 + i, f"http://{i}.example/", copy.replace("blockquote", "h3")) for i in range(9)]
    # the same short text below a rare path of different pages
    pages += [(400 + i, "http://h.example/", page.format(n=50 + i, rare="<h4>Note</h4>")) for i in range(3)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in site_style.extract_main_text(table).collect()}
    assert len(got) == len(pages)
    for i in (*range(100, 102), *range(200, 209), *range(300, 309)):
        assert got[i] == "Head all\nText of all.\nMore of all.\nSaid once"
    for i in range(3):
        assert got[400 + i] == f"Head {50 + i}\nText of {50 + i}.\nMore of {50 + i}.\nNote"


def test_pages_that_share_their_article_keep_it(spark):
    body = "<p>The first of two long paragraphs of the agency.</p><p>The second one, on every page.</p>"
    ad = "<div class=box>Buy</div>"
    for main in ("article", "main"):
        page = f"<div class=top>Us</div><{main}><h1>Head {{n}}</h1><p>{{text}}</p>{{body}}{ad}</{main}>"
        pages = [(i, "http://h.example/", page.format(n=i, text="By us", body=body)) for i in range(30)]
        pages += [(100 + i, "http://k.example/", page.format(n=i, text=f"Own text of {i}", body="")) for i in range(9)]
        table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
        got = {r["page_id"]: r["text"] for r in site_style.extract_main_text(table).collect()}
        shared = "The first of two long paragraphs of the agency.\nThe second one, on every page."
        for i in range(30):
            assert got[i] == f"Head {i}\nBy us\n{shared}"
        for i in range(9):
            assert got[100 + i] == f"Head {i}\nOwn text of {i}"


def test_names_of_ancestors_do_not_count(spark):
    text = "<h1>Head {n}</h1><p>Text of {n}, as long as it is.</p>"
    bodies = [
        f'<div class="content has-sidebar"><article>{text}</article></div>',
        f'<div class="layout nav-open"><main>{text}</main></div>',
        f'<article>{text}<p class="search-result">Found {{n}}</p></article>',
        f'<article>{text}<section id="related-work"><p>Work {{n}}</p></section></article>',
        f'<div class="menu"><article>{text}<div class="comments"><p>Reader {{n}}</p></div></article></div>',
        f'<form id="page"><div class="nav">Menu {{n}}</div><article>{text}<div class="ad">Buy {{n}}</div></article></form>',
    ]
    more = ["", "", "\nFound {n}", "\nWork {n}", "", ""]
    for pages_of_host in (1, 9):
        pages = [
            (100 * k + n, f"http://h{k}.example/{n}", body.format(n=n))
            for k, body in enumerate(bodies)
            for n in range(pages_of_host)
        ]
        table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
        got = {r["page_id"]: r["text"] for r in site_style.extract_main_text(table).collect()}
        for k, rest in enumerate(more):
            for n in range(pages_of_host):
                assert got[100 * k + n] == f"Head {n}\nText of {n}, as long as it is." + rest.format(n=n)


def test_the_tree_finds_articles_without_telling_names(spark, medium):
    """The given pages with their telling tags written as plain boxes, classes and roles taken off."""
    import re
    from collections import Counter

    pages = spark.read.parquet(f"{medium}/pages.parquet")
    expected = {r["page_id"]: r["text"] for r in site_style.extract_main_text(pages).collect()}
    plain = F.regexp_replace("html", "<(/?)(?:article|nav|footer|aside|header|main)\\b[^>]*>", "<$1div>")
    plain = F.regexp_replace(plain, " (?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\\s>]+)", "")
    rows = site_style.extract_main_text(pages.withColumn("html", plain)).collect()
    right = said = wanted = 0
    for row in rows:
        found, words = Counter(re.findall(r"\S+", row["text"])), Counter(re.findall(r"\S+", expected[row["page_id"]]))
        right += sum((found & words).values())
        said += sum(found.values())
        wanted += sum(words.values())
    assert right / said > 0.97 and right / wanted > 0.97


def test_long_broken_pages_take_time_in_proportion():
    import time

    started = time.process_time()
    for page in ("<div>x" * 150_000, "<p><article>" + "<div>" * 60_000 + "<p></p>" * 60_000, "<ul><li>" * 60_000 + "y"):
        read = site_style.Page(page)
        assert site_style.main_text(read, set()).replace("\n", "") in ("x" * 150_000, "", "y")
        assert len(site_style.statistics(read)) < 500_000
    assert time.process_time() - started < 30


def test_importance_is_that_of_a_plain_computation(spark):
    import math

    pages = [(n, "http://h.example/", f"<div class=a>Same</div><div class=b>T of {n % 4}</div><p>Par {n}</p>") for n in range(8)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r["place"]: r["importance"] for r in site_style.style_tree(table).collect()}
    # distinct pages: 8; the text of b is one of 4, each on two pages
    assert got["div.a"] == pytest.approx(0.0)
    assert got["div.b"] == pytest.approx(0.9 * (1 - math.log(2) / math.log(8)))
    assert got["p"] == pytest.approx(0.9)


def test_vantage_ties_and_lengths(spark):
    """At factor one the result is that of brute force, equal scores across the last place included."""
    import numpy as np

    from leadlift.llm.vantage import nearest

    draw = np.random.default_rng(6)
    small = draw.integers(-1, 2, (900, 4)).astype(float)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(small) if v.any()]
    rows += [(2000 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    found = {}
    for r in nearest(df, k=7, every=20, factor=1.0, shard_rows=600).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    points = dict(rows)
    for q, got in found.items():
        scores = sorted(((-sum(a * b for a, b in zip(points[q], v)), i) for i, v in rows if i != q))[:7]
        assert sorted(got) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    mixed = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(ValueError):
        nearest(mixed)


def test_keys_that_look_like_paths():
    from leadlift.llm.chat import canonical

    for record in ('{"messages[]": {"role": "user", "content": "q"}}', '{"messages[].role": 1, "messages[].content": 2}'):
        assert canonical(record)[1] is None
    assert canonical('{"messages": [{"role": "user", "content": "q"}]}')[1] == [{"turn": 0, "role": "user", "text": "q"}]


def test_classifier_learns_from_all_of_long_texts(spark):
    """Texts whose bad lines all come after line 200, repeated ids, and labels of documents that are not there."""
    from leadlift.llm import line_crf

    good, bad = "A plain line of words that reads well enough.", "$$$ 1234 !!! ### click click $$$"
    assert {line_crf.window(i, 1000).start > 200 for i in range(50)} == {True, False}
    assert line_crf.window(3, 5) == slice(0, line_crf.SAMPLE_LINES)
    rows, labels = [], []
    for i in range(120):
        lines = [good] * 220 + [bad if i % 2 else good] * 900
        rows.append((i, "\n".join(lines)))
        labels.append((i, 1 - i % 2))
    rows += [rows[1]] * 30
    labels += [labels[0]] * 20 + [(10_000 + i, 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    told = spark.createDataFrame(labels, "doc_id bigint, quality int")
    scores = {r.doc_id: r.score for r in line_crf.quality(docs, told).collect()}
    assert min(scores[i] for i in range(0, 120, 2)) > max(scores[i] for i in range(1, 120, 2))
