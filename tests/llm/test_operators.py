"""Each operator against brute force on small tables, and on odd rows."""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from silverlode.llm import (
    attention,
    bpe,
    bwt_dedup,
    minhash,
    mixing,
    perplexity,
    pii,
    queries,
    rotated_codes,
    sharding,
    templates,
)
from silverlode.llm.common import stored, table
from silverlode.session import own_session

ROWS = 10


def docs_of(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text").toPandas()


def component_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


# -- personal data


def plain_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for k, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            n = sum(c.isdigit() for c in m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) < 256 for x in m[0].split(".")),
                "card": 14 <= n <= 19 and pii._luhn(pii._digits(m[0])),
                "phone": 10 <= n <= 15,
            }
            if good[kind]:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_base_spans_on_random_signs():
    draw = random.Random(1)
    signs = "0123456789..+-() @@a.b% \n4111111111111111"
    for _ in range(5000):
        text = "".join(draw.choice(signs) for _ in range(60))
        assert pii.base_spans(text) == plain_spans(text)


def test_sure_contexts_find_unseen_identifiers(spark):
    cards = ["4111111111111111", "5500005555555559", "340000000000009", "30000000000004", "6011000000000004"] * 3
    cards += [f"{n}" for n in ("4012888888881881", "4222222222222220", "5105105105105100", "5555555555554444") * 2]
    rows = [(i, f"please charge card number {c} before noon") for i, c in enumerate(cards)]
    rows += [(100, "please charge card number 4111111111111112 before noon"), (101, "order 4111111111111113 shipped")]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.start, s.end, s.kind) for s in found[100].spans] == [(26, 42, 2)] and not found[100].base
    assert not found[101].spans
    red = pii.redacted(spark.createDataFrame([found[0]]), ["doc_id", "text"]).first()
    assert red.text == "please charge card number <CARD> before noon"


def test_sure_contexts_find_new_forms(spark):
    rows = [(i, f"please call me at +1 (743) 555-{3000 + i} before noon") for i in range(100)]
    rows += [(100 + i, f"you may write to ann.{i}@mail.example.com about it") for i in range(40)]
    new = ["(555) 123-4567", "555-123-4567", "020 7946 0958", "555.1234"]
    rows += [(200 + i, f"please call me at {x} before noon") for i, x in enumerate(new)]
    rows += [(300, "you may write to john (at) example.com about it"), (301, "then call me at: 020 7946 0999, or not")]
    rows += [(400 + i, f"we look at {x} before noon") for i, x in enumerate(["nothing", "a 1999 film", *"abcdefghi"])]
    rows += [(500 + i, f"in shop {i} of +1 (743) 555-{4000 + i} now") for i in range(40)]
    rows += [(600 + i, f"a part of {x} now") for i, x in enumerate(["777123499", *"abcdefghijklmnopqrstuvwxyz"])]
    texts = dict(rows)
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r.doc_id: [(pii.KINDS[s.kind], texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in found if r.doc_id >= 200}
    assert [spans[200 + i] for i in range(len(new))] == [[("phone", x)] for x in new]
    assert spans[300] == [("email", "john (at) example.com")] and spans[301] == [("phone", "020 7946 0999")]
    assert not any(spans[i] for i in spans if 400 <= i < 500 or i >= 600)


# -- substring dedup


def plain_removal(texts):
    first, out = {}, {}
    for i, text in sorted(texts.items()):
        for k in range(len(text) - 49):
            first.setdefault(text[k : k + 50], i)
    for i, text in texts.items():
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - 49):
            if first[text[k : k + 50]] < i:
                gone[k : k + 50] = True
        out[i] = (int(gone.sum()), hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_repeats_are_removed_as_by_brute_force(spark, sf_dir):
    texts = {r.doc_id: (r.text or "").encode() for r in docs_of(spark, sf_dir).itertuples()}
    found = queries.queries()["op2_bwt_repeats"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in found} == plain_removal(texts)


def test_window_minima_on_a_small_alphabet():
    draw = random.Random(2)
    base = "".join(draw.choice("ab") for _ in range(400))
    segments = list({base[i : i + draw.randint(50, 80)].encode() for i in draw.sample(range(320), 40)})
    docs = np.array(draw.choices(range(9), k=len(segments)))
    least = defaultdict(lambda: 99)
    for s, d in zip(segments, docs, strict=True):
        for k in range(len(s) - 49):
            least[s[k : k + 50]] = min(least[s[k : k + 50]], d)
    for s, found in zip(segments, bwt_dedup.window_minima(segments, docs), strict=True):
        assert found.tolist() == [least[s[k : k + 50]] for k in range(len(s) - 49)]


# -- near duplicates


def test_near_duplicates_as_by_brute_force(spark, sf_dir):
    sets = {r.doc_id: set(minhash.shingles(r.text).tolist()) for r in docs_of(spark, sf_dir).itertuples()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = minhash.near_duplicates(table(spark, sf_dir, "documents")).collect()
    assert links
    assert {r.doc_id: r.component_id for r in found} == component_of(sets, links)
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(sets[r.doc_id]) for r in found)


BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def test_texts_of_a_repeated_id_have_components_of_their_own(spark):
    other, third = BASE.replace("e", "x"), BASE.replace("e", "y")
    rows = [(1, BASE), (2, BASE + " end"), (2, other), (2, other), (2, third), (3, other + " end"), (4, third), (4, third), (None, BASE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_print", F.lit("t")).repartition(3)
    found = {tuple(r) for r in minhash.near_duplicates(docs).select("doc_id", "component_id", "kept").collect()}
    assert found == {(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (4, 2, False), (None, None, True)}
    left = minhash.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.select("doc_id", "text").collect()), key=str) == sorted(
        [(1, BASE), (2, other), (2, third), (None, BASE)], key=str
    )


def test_rows_that_repeat_under_one_id_stay_once(spark):
    rows = [(5, BASE)] * 4 + [(5, BASE + " end"), (6, BASE)] + [(7, "")] * 3 + [(None, BASE)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in minhash.deduplicated(docs).collect()]
    assert len(found) == 6 and len([r for r in found if r[0] == 5]) == 1
    assert found.count((7, "")) == 3 and found.count((None, BASE)) == 2 and 6 not in {r[0] for r in found}


def test_pairs_of_blocks_of_a_family_are_dealt_to_many_tasks(spark, monkeypatch):
    """One family holds all sets: without an exchange by pair, all of its pairs would be one task's."""
    monkeypatch.setattr(minhash, "PAIR_BYTES", 8000)
    sets = spark.range(3000).select(F.expr("cast(1 + id div 10000 AS int)").alias("family"), "id", F.encode(F.lit("x" * 16), "UTF-8").alias("hashes"))
    size = spark.createDataFrame([(1, 3000, 48000, 12)], "family int, members long, bytes long, blocks int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = minhash._pairs(sets, size).applyInArrow(
            lambda t: t.slice(0, 1).select(["low", "high"]), "low int, high int"
        ).select("low", "high", F.spark_partition_id().alias("task"))
        plan = seen._jdf.queryExecution().executedPlan().toString()
        tasks = {r.task for r in seen.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"Exchange hashpartitioning\(family#\d+L?, low#\d+L?, high#\d+L?, \d+\), REPARTITION", plan), plan
    assert seen.count() == 78 and len(tasks) > 20


def test_vectors_link_as_by_brute_force(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(12, 16))
    rows = []
    for i in range(120):
        v = base[i % 12] + draw.normal(size=16) * draw.choice([0.0, 0.05, 0.15])
        rows.append((i, [float(x) for x in v], int(i % 2)))
    odd = [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, rows[0][1], None), (None, rows[0][1], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in rotated_codes.near_vectors(frame).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: k for i, _, k in rows}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and unit[a] @ unit[b] >= 0.98]
    degree = Counter(x for pair in links for x in pair)
    component = component_of(unit, links)
    assert links and len(found) == len(rows) + len(odd)
    assert all((found[i].n_links, found[i].component_id) == (degree[i], component[i]) for i in unit)
    assert all(found[i].n_links == 0 and found[i].kept for i in (200, 201, 202, 203, None))


# -- web pages


def test_main_text_of_a_page():
    page = (
        '<html><body class="has-sidebar"><header>Home</header><div class="cookie-notice">Cookies</div><div id="content"><h1>T&eacute;'
        "</h1><p>one<b>two</b>\n three<p>four &amp; five<ul><li>a<li>b</ul><div class=comments><p>hi</div></div><script>if(a<b)</script>"
    )
    assert [t for t, _ in templates.blocks(page)] == ["Té", "onetwo three", "four & five", "a", "b"]
    assert templates.blocks(None) == [] == templates.blocks("")
    assert len(templates.blocks("<div>" * 2000 + "x")) == 1


def test_what_recurs_on_a_host_goes_and_copied_prose_stays(spark):
    rows = [
        (
            i,
            f"http://{'a' if i < 20 else 'b'}.example/{i}",
            f"<div>Follow us</div><article><h1>T{i}</h1><p>same words everywhere</p><div>Read more</div></article>"
            if i % 2
            else f"<div>Follow us</div><p>Body {i}</p>",
        )
        for i in range(22)
    ] + [(50, None, None)]
    found = {r.page_id: r.main_text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1] == "T1\n\nsame words everywhere" and found[2] == "Body 2"
    assert found[20] == "Follow us\n\nBody 20" and found[50] == ""


def test_whole_pages_are_counted(spark):
    rows = [
        (
            i,
            f"http://a.example/{i}",
            f"<p>Welcome to us</p><nav>Menu</nav><article><h1>T{i}</h1><div><p>Body {i}</p></div><div><p>Join us</p></div><p>End {i}</p></article>"
            if i < 6
            else f"<article><h1>C</h1><div><p>copied words</p></div></article><i>{i}</i>"
            if i < 12
            else f"<p>Body {i}</p>" + ("<div><p>On few pages</p></div>" if i < 17 else ""),
        )
        for i in range(100)
    ]
    hashes = [templates.read(h)[1] for _, _, h in rows[:2]]
    assert templates.parse("<nav>Menu</nav>").children[0].hash in hashes[0] & hashes[1]
    assert templates.parse("<p>Welcome to us</p>").children[0].hash in hashes[0] & hashes[1]
    found = {r.page_id: r.main_text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == f"T{i}\n\nBody {i}\n\nEnd {i}" for i in range(6))
    assert all(found[i] == "C\n\ncopied words" for i in range(6, 12))
    assert all(found[i] == f"Body {i}" for i in range(12, 100))


def test_no_text_of_an_article_is_lost():
    def texts(page):
        return [t for t, _ in templates.blocks(page)]

    assert texts("<body><article><p>one</article><div>x</div><article><p>two, longer</article>") == ["one", "two, longer"]
    assert texts('<div class=entry><p>one</div><div class="post"><p>two</div>') == ["one", "two"]
    page = (
        '<article><section id="search-trees"><h2 id="related-work">a</h2><p class="share-price">b</p></section>'
        '<section id="comments-on-x"><p>c</p></section><div class="comments">hi</div><div class="x share">hi</div></article>'
    )
    assert texts(page) == ["a", "b", "c"]
    assert texts('<div class="site-footer">f</div><div id="adBox">f</div><div class="share-price">1 EUR</div>') == ["1 EUR"]


ARTICLE = "<article><h1>T</h1><p>Body one.</p><p>Body two.</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        ARTICLE + '<section id="comments"><article class="comment-body"><p>hi</p></article></section>',
        ARTICLE + '<article class="comment-body"><p>hi, a comment that is longer than all of the article</p></article>',
        ARTICLE.replace("</article>", '<div class="comments-area"><ol class="comment-list"><li>hi</ol></div></article>'),
        ARTICLE.replace("</article>", '<div id="comments"><p>hi</p></div></article>'),
        ARTICLE.replace("</article>", '<ul><li class="comment">hi</li><li class="comment even depth 2">hi</li></ul></article>'),
        '<div class="post-content"><h1>T</h1><p>Body one.</p><p>Body two.</p></div><div class="post-comments"><p>hi</p></div>',
        '<div class="post-content"><h1>T</h1><p>Body one.</p><p>Body two.</p></div><div class="content-sidebar"><p>hi</p></div>',
        ARTICLE.replace("<p>Body two", '<p class="advert">buy</p><p>Body two'),
        "<h1>T</h1><p>Body one.</p><p>Body two.</p>" + '<div id="comments"><article><p>hi</p></article></div>',
    ],
)
def test_comments_adverts_and_sidebars_go(page):
    assert [t for t, _ in templates.blocks(page)] == ["T", "Body one.", "Body two."]


def test_given_pages_have_their_articles(spark, sf_dir):
    """By patterns, as each given page has one article of headings, paragraphs and inline signs only."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    pages = {r.page_id: r.html for r in table(spark, sf_dir, "pages").collect()}
    found = queries.queries()["op5_site_templates"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        (article,) = re.findall(r"(?s)<article\b[^>]*>(.*?)</article>", pages[r.page_id])
        parts = re.split(r"(?i)</?(?:p|h[1-6])\b[^>]*>", re.sub(r"(?i)<br\b[^>]*>", " ", article))
        texts = [" ".join(html.unescape(re.sub(r"(?s)<!--.*?-->|<[^>]*>", "", x)).split()) for x in parts]
        assert r.text == "\n\n".join(t for t in texts if t) and r.n_chars == len(r.text), r.page_id


def test_pages_with_odd_columns_and_no_pages(spark):
    rows = [(1, None, None, "a"), (1, "x", "", "b"), (None, "http://h/1", ARTICLE, "c"), (2, "http://h/1", ARTICLE, "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    pages = pages.withColumns({"host": F.lit("h"), "key": F.lit(1), "template": F.lit("t"), "row": F.lit("r")})
    found = templates.extract(pages)
    assert sorted(found.columns) == sorted(pages.columns) and found.count() == 4
    assert {r.main_text for r in found.collect()} == {"", "T\n\nBody one.\n\nBody two."}
    assert templates.extract(pages.limit(0)).collect() == []


def test_vectors_with_odd_columns_and_no_vectors(spark):
    rows = [(1, [1.0, 0.0], 1, 5), (1, [1.0, 0.0], 1, 6), (None, [1.0, 0.0], 1, 7), (2, [2.0, 0.0], 1, 8), (3, None, None, 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component_id int")
    vectors = vectors.withColumns({"print": F.lit("p"), "kept": F.lit("k"), "n_links": F.lit(0), "dim": F.lit(1)})
    found = sorted(map(tuple, rotated_codes.near_vectors(vectors).collect()), key=str)
    assert found == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (None, 0, None, True)], key=str)
    assert rotated_codes.near_vectors(vectors.limit(0)).collect() == []


def test_vectors_planted_in_the_given_table_link_as_by_brute_force(spark, sf_dir):
    """No two given vectors are alike, so copies at angles around the threshold are put beside them: all pairs, no loss."""
    vectors = table(spark, sf_dir, "embeddings")
    draw, rows = np.random.default_rng(8), []
    for i, r in enumerate(vectors.where("label is not null").limit(200).collect()):
        v = np.array(r.embedding, float)
        for k in range(1 + i % 4):
            off = draw.normal(size=len(v))
            off -= off @ v / (v @ v) * v
            angle = np.arccos(draw.uniform(0.972, 0.995))
            turned = np.cos(angle) * v / np.linalg.norm(v) + np.sin(angle) * off / np.linalg.norm(off)
            rows.append((100_000 + 10 * i + k, (turned * draw.uniform(0.5, 2)).astype(np.float32).tolist(), r.label))
    vectors = vectors.unionByName(spark.createDataFrame(rows, vectors.schema))
    given = [r for r in vectors.collect() if r.embedding is not None and r.label is not None]
    unit = np.array([r.embedding for r in given], float)
    norm = np.linalg.norm(unit, axis=1)
    links = [
        (given[i].vec_id, given[j].vec_id)
        for i, j in zip(*np.nonzero(np.triu(unit @ unit.T / np.outer(norm, norm) >= 0.98, 1)), strict=True)
        if given[i].label == given[j].label
    ]
    found = rotated_codes.near_vectors(vectors).collect()
    counts = Counter(x for link in links for x in link)
    assert len(links) > 200 and {r.vec_id: r.n_links for r in found} == {r.vec_id: counts[r.vec_id] for r in found}
    assert {r.vec_id: r.component_id for r in found} == component_of([r.vec_id for r in found], links)


# -- mixing, sharding


def test_mix_meets_targets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = mixing.mix(docs).select("doc_id", "source", "mix.*").toPandas()
    assert (rows.taken <= 3 * rows["size"]).all()
    by = rows.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert abs(by.target.sum() - by["size"].sum()) < 1e-3 and (by.target <= 3 * by["size"] + 1e-6).all()
    assert (abs(by.taken - by.target) <= 0.03 * by.target + 3 * mixing.BLOCK_WORDS).all()
    texts = mixing.mixed_texts(mixing.mix(docs)).select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert texts == rows.taken.sum()


def test_short_cells_over_many_shards_meet_targets(spark):
    rows = [(i, "big", "w " * 2000) for i in range(300)]
    rows += [(1000 + i, "one", "w " * 20) for i in range(300)] + [(2000 + i, "ten", "w " * 100) for i in range(300)]
    rows += [(3000 + i, "two", "w " * 7) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(docs, weights=(1000, 100, 100, 0.5), shard_words=2000).cache()
    found = mixed.groupBy("source").agg(F.sum("mix.taken").alias("taken"), F.first("mix.target").alias("target")).collect()
    assert {r.source for r in found} == {"big", "one", "ten", "two"}
    assert all(abs(r.taken - r.target) <= 0.03 * r.target + 3 * mixing.BLOCK_WORDS for r in found), found
    texts = mixing.mixed_texts(mixed).select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert texts == sum(r.taken for r in found)
    assert mixed.where(F.col("mix.taken") > 3 * F.col("mix.size")).isEmpty()


def test_excess_of_capped_sources_is_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 1)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes, (5, 2, 1), 3).collect()}
    assert found == {"a": 30.0, "b": 300.0, "c": pytest.approx(778.0), None: 3.0}


def test_shards_differ_by_one_row_at_most(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sharding.shuffled(docs).select("doc_id", "place.*").toPandas()
    counts = rows.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert counts["count"].max() - counts["count"].min() <= 1
    assert (counts["max"] + 1 == counts["count"]).all() and (counts["nunique"] == counts["count"]).all()
    order = rows.sort_values(["slot", "shard"]).doc_id.tolist()
    assert sum(b == a + 1 for a, b in pairwise(order)) < len(order) / 10


def test_places_do_not_depend_on_the_layout_of_tasks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    equal = spark.range(700).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    docs = docs.unionByName(equal).withColumn("more", F.length("text") % 7)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {key: spark.conf.get(key) for key in keys}
    places = []
    for values in ((8, "true", 10 << 20), (8, "true", 10 << 20), (4, "false", -1), (50, "true", -1), (50, "false", 10 << 20)):
        for key, value in zip(keys, values, strict=True):
            spark.conf.set(key, value)
        rows = sharding.shuffled(docs.repartition(values[0]), bucket_rows=40).select("doc_id", "text", "place.*").collect()
        places.append(sorted(map(str, rows)))
    for key, value in before.items():
        spark.conf.set(key, value)
    assert all(p == places[0] for p in places) and len(places[0]) == docs.count()


def test_all_orders_are_drawn_alike(spark):
    """Fisher-Yates over three items: six orders, each about as often."""
    items = spark.range(6000).select(sharding._fisher_yates(F.array(F.lit(0), F.lit(1), F.lit(2)), F.col("id"), 5).alias("order"))
    found = Counter(tuple(r.order) for r in items.collect())
    assert len(found) == 6 and all(850 < n < 1150 for n in found.values())


# -- quality


def test_base_counts():
    text = "a b c d a b c\nx #$\nx #$\n\n"
    assert perplexity.base_counts(text) == (11, 13, 4, 1, 6)
    assert perplexity.base_counts(None) == (0, 0, 0, 0, 0)


def test_kneser_ney_sums_to_one(spark):
    docs = spark.createDataFrame([("en", "the cat sat on the mat and the rat ran " * 3)], "lang string, text string")
    model = perplexity.kneser_ney(perplexity.count_grams(docs)).toPandas()
    own = perplexity.Model(*[model[c].to_numpy() for c in ("length", "gram", "logp", "backoff")])
    every = np.arange(1 << 21, dtype=np.int64)
    for context in ("th", " t", "qz"):
        codes = (ord(context[0]) << 42) | (ord(context[1]) << 21) | every
        assert np.exp(own.logp(codes)).sum() == pytest.approx(1, abs=1e-3)


def test_perplexity_is_the_median_of_the_windows(spark, sf_dir):
    """Against the whole model, which falls back to shorter grams, text by text."""
    docs = table(spark, sf_dir, "documents").where("lang = 'fr'")
    model = perplexity.kneser_ney(perplexity.count_grams(docs)).toPandas()
    own = perplexity.Model(*[model[c].to_numpy() for c in ("length", "gram", "logp", "backoff")])
    found = perplexity.rules(docs, ["doc_id", "text"]).collect()
    assert len(found) > 10
    for r in found:
        if r.text:
            logp = own.logp(perplexity.grams([r.text])[0])
            cuts = np.array_split(logp, 1) if len(logp) < 512 else [
                logp[i * len(logp) // (len(logp) // 256) : (i + 1) * len(logp) // (len(logp) // 256)] for i in range(len(logp) // 256)
            ]
            assert r.quality.log_perplexity == pytest.approx(np.median([-c.mean() for c in cuts]), abs=1e-4)


def test_languages_in_parts_score_the_same(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents").unionByName(
        spark.createDataFrame([(None, "", "xx", None, 0), (-1, None, None, None, None)], table(spark, sf_dir, "documents").schema)
    )
    whole = {r.doc_id: r.quality for r in perplexity.rules(docs, ["doc_id"]).collect()}
    sizes = {r.language: r.n for r in perplexity.count_grams(docs).groupBy("language").agg(F.count("gram").alias("n")).collect()}
    monkeypatch.setattr(perplexity, "GROUP_ENTRIES", sorted(sizes.values())[-1] // 2 + 1)  # the largest in two parts, some passes
    parts = {r.doc_id: r.quality for r in perplexity.rules(docs, ["doc_id"]).collect()}
    assert whole.keys() == parts.keys() and len(whole) == docs.count()
    for i, q in whole.items():
        assert parts[i][:6] == q[:6] and parts[i].kept == q.kept
        assert parts[i].log_perplexity == pytest.approx(q.log_perplexity, abs=1e-6)


def plain_verdict(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words) < 50 or 100 * len(again) > 50 * len(words)


def test_bands_reject_junk_and_keep_clean_texts(spark, sf_dir):
    """Planted among the given documents; shuffled words keep their letters in order, so a model of letters cannot tell most."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    draw = random.Random(3)
    good = [r for r in docs.where("lang = 'en'").collect() if labels.get(r.doc_id) == 1 and len((r.text or "").split()) >= 60]
    some = [r.text for r in good[:20]]
    junk = {
        "hex words": [" ".join("%x" % draw.getrandbits(32) for _ in range(120)) for _ in range(20)],
        "reversed": [t[::-1] for t in some],
        "shuffled letters": [" ".join("".join(draw.sample(w, len(w))) for w in t.split()) for t in some],
        "another language": [r.text for r in docs.where("lang = 'de' AND length(text) > 600").limit(20).collect()],
    }
    rows = [(-1000 * i - j, t, "en") for i, texts in enumerate(junk.values(), 1) for j, t in enumerate(texts)]
    rows += [(-9000 - j, t + "\n" + junk["another language"][j][: len(t) // 3], "en") for j, t in enumerate(some)]
    found = {r.doc_id: r.quality for r in perplexity.rules(docs.unionByName(spark.createDataFrame(rows, docs.schema)), ["doc_id"]).collect()}
    for i, (kind, texts) in enumerate(junk.items(), 1):
        assert sum(found[-1000 * i - j].kept for j in range(len(texts))) <= 0.1 * len(texts), kind
    clean = [i for i, label in labels.items() if label == 1 and i in found and not found[i].base_failed]
    assert sum(found[i].kept for i in clean) >= 0.95 * len(clean)
    assert sum(found[-9000 - j].kept for j in range(len(some))) >= 0.9 * len(some)  # a foreign passage is no junk
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(found[i].base_failed == plain_verdict(t) for i, t in texts.items())
    assert all(q.kept == (not q.base_failed and q.lower <= q.log_perplexity <= q.upper) for q in found.values() if not q.base_failed)
    refused = [i for i in texts if not found[i].kept and not found[i].base_failed]
    assert refused  # the bands decide on the given documents too


def test_attention_learns_and_gradients_are_right(spark, sf_dir):
    rows = queries.queries()["op9_attention_bags"](spark, sf_dir).toPandas()
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    labels = table(spark, sf_dir, "labels").toPandas()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.9
    draw = np.random.default_rng(4)
    bags = [draw.normal(size=(n, attention.FEATURES)).astype(np.float32) for n in (1, 3, 2)]
    model = attention.fit(bags, np.array([1.0, 0.0, 1.0]), epochs=1)
    x, bag, y, w = np.concatenate(bags).astype(float), np.repeat(range(3), [1, 3, 2]), np.array([1.0, 0, 1]), np.ones(3)
    loss = lambda: -np.mean([np.log(p if t else 1 - p) for p, t in zip(model._forward(x, bag, 3)["p"], y, strict=True)])
    slopes = model.gradients(x, bag, y, w)
    for name in ("W", "V", "U", "w", "c", "d"):
        at = np.unravel_index(abs(slopes[name]).argmax(), slopes[name].shape)
        model.weights[name][at] += 1e-5
        up = loss()
        model.weights[name][at] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(slopes[name][at], rel=1e-3)
        model.weights[name][at] += 1e-5


# -- tokens


def test_encoding_is_that_of_the_library(spark, sf_dir):
    ranks = bpe.read_ranks(queries.RANKS)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["a\x1cb \x85y　w", "", "   ", "\n\n \t x", "a" * 3000, "日本語" * 200, "🙂👨‍👩‍👧" * 50, "<|endoftext|>", "x²³ ١٢", " " * 999 + "x"]
    texts = odd + docs_of(spark, sf_dir).text.tolist()
    encoder, decoder = bpe.Encoder(ranks, public_tokenizers.PATTERN), bpe.Decoder(ranks)
    ids = encoder.texts(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [plain.encode_ordinary(t) for t in texts]
    assert decoder.texts(ids) == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        decoder.texts([np.array([1 << 20], "<u4").tobytes()])


def test_round_trip_is_decode_of_encode(spark, sf_dir, odd_docs):
    for docs in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        two = bpe.decode(bpe.encode(docs, queries.RANKS, public_tokenizers.PATTERN), queries.RANKS)
        one = bpe.round_trip(docs, queries.RANKS, public_tokenizers.PATTERN)
        assert one.columns == two.columns
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


# -- odd rows


def results(docs):
    return {
        "pii": pii.find(docs),
        "bwt": bwt_dedup.remove_repeats(docs),
        "minhash": minhash.near_duplicates(docs),
        "mix": mixing.mix(docs),
        "rules": perplexity.rules(docs),
        "shards": sharding.shuffled(docs),
        "bpe": bpe.decode(bpe.encode(docs, queries.RANKS, public_tokenizers.PATTERN), queries.RANKS),
        "score": attention.score(docs, attention.fit([], np.empty(0))),
    }


@pytest.mark.parametrize("name", ["pii", "bwt", "minhash", "mix", "rules", "shards", "bpe", "score"])
def test_odd_rows_and_no_rows(odd_docs, no_docs, name):
    found = results(odd_docs)[name].collect()
    assert len(found) == ROWS
    assert results(no_docs)[name].collect() == []
    if name == "minhash":
        assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1, None: None, 7: 7, 8: 8, 9: 9}
    if name == "bwt":
        assert all(not r.removed for r in found if r.doc_id in (1, None)) and all(r.kept == b"" for r in found if r.doc_id == 5)
    if name == "rules":
        assert all(r.quality.base_failed for r in found if r.doc_id in (2, 3, 4, 7, 8, 9))


def test_pipeline(spark, sf_dir, odd_docs, no_docs):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "personal_data", "source_mix", "byte_bpe",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_docs, sf_dir).columns == odd_docs.columns, name
        assert stage(spark, no_docs, sf_dir).count() == 0


def plain_targets(sizes):
    """Weights 5, 2, 1 in turn over sources in order, none above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = (total - sum(fixed.values())) / sum(weight[s] for s in names if s not in fixed) if len(fixed) < len(names) else 0
        over = [s for s in names if s not in fixed and rest * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: fixed.get(s, rest * weight[s]) for s in names}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_each_stage_does_its_work_on_its_own_input(spark, sf_dir):
    """Stage by stage over the smallest tables, each held against plain Python on the rows that it was given."""
    import corpus_pipeline

    def words(text):
        return (text or "").encode().split()

    frames = [table(spark, sf_dir, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], sf_dir), name))
    given, good, one, safe, mixed, encoded = ([r.asDict() for r in f.collect()] for f in frames)
    of = [{r["doc_id"]: r for r in rows} for rows in (given, good, one, safe)]

    # quality rules: rows as they were, none that the base rules reject, few others gone
    assert all(of[0][i] == r for i, r in of[1].items())
    base = {i for i, r in of[0].items() if plain_verdict(r["text"])}
    assert not base & of[1].keys() and len(of[1]) >= 0.95 * (len(given) - len(base))

    # near duplicates: rows as they were, one of each group
    sets = {i: set(minhash.shingles(r["text"]).tolist()) for i, r in of[1].items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    assert of[2].keys() == {i for i, c in component_of(sets, links).items() if i == c} and len(one) == len(of[2]) < len(good)
    assert all(of[1][i] == r for i, r in of[2].items())

    # personal data: all rows, and base spans give way to their kinds; more may
    assert of[3].keys() == of[2].keys() and len(safe) == len(one)
    for i, r in of[3].items():
        text, at, parts = of[2][i]["text"], 0, []
        for start, kind, end in plain_spans(text):
            if start >= at:
                parts += [text[at:start], f"<{pii.KINDS[kind].upper()}>"]
            at = max(at, end)
        plain = "".join([*parts, text[at:]])
        assert not plain_spans(r["text"]) and r["n_chars"] == len(r["text"])
        assert r["text"] == plain or sum(map(r["text"].count, ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>"))) > len(parts) // 2
        assert {k: v for k, v in r.items() if k not in ("text", "n_chars")} == {k: v for k, v in of[2][i].items() if k not in ("text", "n_chars")}

    # the mix: whole texts, and words of a text in order; sources near their targets, no text above three times
    taken, sizes, parts = Counter(), Counter(), Counter()
    for r in safe:
        sizes[r["source"]] += len(words(r["text"]))
    for r in mixed:
        whole, got = words(of[3][r["doc_id"]]["text"]), words(r["text"])
        rest = iter(whole)
        assert got and all(w in rest for w in got) and r["source"] == of[3][r["doc_id"]]["source"]
        taken[r["source"]] += len(got)
        parts[r["doc_id"]] += len(got)
    assert all(n <= 3 * len(words(of[3][i]["text"])) for i, n in parts.items())
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 0.05 * target + 2 * mixing.BLOCK_WORDS, source

    # encoding: every row's ids as the library has them, and its bytes back
    ranks = bpe.read_ranks(queries.RANKS)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = []
    for r in mixed:
        ids = plain.encode_ordinary(r["text"])
        digests = (hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), r["text"].encode()))
        wanted.append((r["doc_id"], len(ids), *digests))
    assert sorted(tuple(r.values()) for r in encoded) == sorted(wanted)


def test_repeats_leave_no_table_and_move_no_text_again(spark, sf_dir):
    own = own_session(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    found = bwt_dedup.remove_repeats(table(own, sf_dir, "documents"))
    assert not [t.name for t in own.catalog.listTables() if t.name.startswith("bwt_blocks")]
    assert "Bucketed: true" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == table(own, sf_dir, "documents").count()


def test_bpe_many_middling_words():
    """The state of a query's rounds is bounded whatever the words are like: these took more than a database may use."""
    ranks = bpe.read_ranks(queries.RANKS)
    encoder, draw = bpe.Encoder(ranks, public_tokenizers.PATTERN), random.Random(1)
    words = [" " + "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=250)) for _ in range(1500)]
    assert encoder.texts(["".join(words)]) == [b"".join(encoder._merge_long(w.encode()) for w in words)]
