"""Near copies, shards, pages, test passages and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casemill.llm import decontamination as D, ngram_join as J, pages as G, sharding as S
from casemill.llm.components import components
from casemill.sources.scratch import written


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute_components(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                root[find(a)] = find(b)
    least: dict[int, int] = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return sorted((doc if doc is not None else -1, len(sets[k]), least.get(find(k), -1) if sets[k] else (doc if doc is not None else -1)) for k, (doc, _) in enumerate(rows))


def near_copies(seed):
    draw = random.Random(seed)

    def changed(words, times):
        words = list(words)
        for _ in range(times):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        return " ".join(words)

    short, long_, tiny = [f"w{i}" for i in range(120)], [f"v{i}" for i in range(400)], [f"u{i}" for i in range(12)]
    rows = [(i, changed(short, draw.randrange(8))) for i in range(150)]
    rows += [(1000 + i, changed(long_, draw.randrange(16))) for i in range(40)]
    rows += [(2000 + i, changed(tiny, draw.randrange(2)) + " q" * draw.randrange(3)) for i in range(40)]
    rows += [(3000 + i, " ".join(long_[: 375 + i])) for i in range(20)]
    line = "a common line one two three four five six seven eight nine ten "
    rows += [(5000 + i, line + " ".join(f"r{draw.randrange(10**6)}" for _ in range(draw.randrange(12)))) for i in range(60)]
    rows += [(4000, None), (4001, ""), (4002, " \n"), (4003, "one"), (4004, "ONE"), (4005, "one two"), (None, "one two"), (None, "zz"), (7, "aa bb"), (7, "cc dd"), (4010, "a " * 9000), (4011, "A " * 7000)]
    return rows


@pytest.mark.parametrize("frequent, block", [(4, 16), (10**6, 256)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, frequent, block):
    monkeypatch.setattr(J, "FREQUENT_LEAST", frequent)
    monkeypatch.setattr(J, "BLOCK", block)
    rows = near_copies(3)
    found = J.joined(docs_of(spark, rows).selectExpr("*", "1 AS n", "2 AS cls", "3 AS key")).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in found)
    assert got == brute_components(rows)


def test_no_documents_and_no_links(spark):
    assert J.joined(docs_of(spark, [])).count() == 0
    assert {r["component_id"] for r in J.joined(docs_of(spark, [(1, "a b c"), (2, "d e f")])).collect()} == {1, 2}


def test_prefix_signatures_meet_whenever_sets_link():
    import numpy as np

    draw = np.random.default_rng(5)
    for _ in range(300):
        size = int(draw.integers(2, 60))
        pool = np.unique(draw.integers(0, 2**63, size + 40).astype(np.uint64))
        draw.shuffle(pool)
        common = np.sort(pool[:: int(draw.integers(1, 4))])
        rank = draw.permutation(len(common))
        left = pool[:size]
        right = np.concatenate((left[int(draw.integers(0, size // 5 + 1)) :], pool[size : size + int(draw.integers(0, size // 5 + 1))]))
        shared = len(np.intersect1d(left, right))
        if 100 * shared >= 80 * (len(left) + len(right) - shared) and set(left) != set(right):
            a, b = (J.prefix_signatures(np.sort(x), common, rank) for x in (left, right))
            assert len(np.intersect1d(a, b)), (size, len(right), shared)


def test_one_document_of_each_group_stays(spark):
    rows = near_copies(4)
    frame = docs_of(spark, rows).selectExpr("*", "'z' AS key", "1 AS cls", "2 AS _row", "3 AS _key")
    stay = J.representatives(frame)
    assert stay.columns == frame.columns
    left = [r["doc_id"] for r in stay.collect()]
    want = Counter(c for d, n, c in brute_components(rows) if n and d == c) + Counter(d for d, n, _ in brute_components(rows) if not n)
    assert Counter(d if d is not None else -1 for d in left if d is not None) == Counter({k: v for k, v in want.items() if k != -1})


def test_component_labels_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(101)) and all(found[1000 + i] == 1000 for i in range(50))


# --- shards -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "rows, shards",
    [
        ([(i, "hot") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(600)] + [(3000 + i, f"d{i // 3}") for i in range(200)], 24),
        ([(i, None if i % 2 else "") for i in range(50)] + [(None, "x"), (None, "x"), (7, "q"), (7, "q")], 24),
        ([(i, f"{i // 5}") for i in range(300)], 7),
        ([(1, "a")], 24),
    ],
)
def test_shards_are_even_and_gapless(spark, rows, shards):
    found = S.sharded(docs_of(spark, rows).selectExpr("*", "1 AS shard", "2 AS n"), shards).collect()
    slots = defaultdict(list)
    for row in found:
        slots[row["shard"]].append(row["slot"])
        assert row["law"] == "rows" and row["grown_shard"] is None
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    key = lambda doc, text: (doc if doc is not None else -1, len((text or "").encode()) + 8, zlib.crc32((text or "").encode()))
    assert sorted(key(*r) for r in rows) == sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in found)


def test_equal_texts_stay_together_where_they_fit(spark):
    rows = [(i, f"g{i % 40}") for i in range(160)] + [(1000 + i, f"alone {i}") for i in range(2000)]
    where = defaultdict(set)
    for row in S.sharded(docs_of(spark, rows)).collect():
        if row["doc_id"] < 1000:
            where[row["doc_id"] % 40].add(row["shard"])
    assert all(len(own) == 1 for own in where.values())
    assert S.sharded(docs_of(spark, [])).count() == 0


# --- pages --------------------------------------------------------------------------------------------------

PAGE = "<html><body><header><h1>Site</h1></header><nav><ul><li>m</ul></nav><div class='box'>Our staff welcomes you</div><div id=c><h2>T &lt;{0}&gt;</h2><p>one{0}<br>two <b>x</b>&nbsp; y<p>three{0}<form>f</form><div class='comments'>c</div></div><script>x<y</script><footer>f</footer>"


def test_repeated_subtrees_of_a_host_go(spark):
    rows = [(i, "https://a.example/p?x=1", PAGE.format(i)) for i in range(6)] + [(100, "https://b.example:80/", PAGE.format(100)), (101, None, None), (102, "x", ""), (103, "y", "plain &amp; text"), (100, "https://b.example/", PAGE.format(100))]
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in G.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS host")).collect()]
    text = {k: t for k, t, _ in found}
    assert text[3] == "T <3>\none3 two x y\nthree3"
    assert text[100] == "Our staff welcomes you\nT <100>\none100 two x y\nthree100"  # nothing repeats on its host
    assert text[101] == text[102] == "" and text[103] == "plain & text"
    assert len(found) == len(rows) and all(n == len(t) for _, t, n in found)


def test_articles_that_a_host_repeats_stay(spark):
    body = "<body><nav><a href=x>Home</a></nav><article><h1>News</h1><p>A text.</p><section class=x><p>Kept</p></section></article><div class=ad>Buy</div></body>"
    rows = [(i, "http://h.example/", body) for i in range(20)]
    found = {r["text"] for r in G.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {"News\nA text.\nKept"}


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<div>" * 2000 + "deep", "</p></div>x", "<p>" * 3000, "<!-- x", "<script>", "<a b='c", "<p title=\"a>b\">q</p>", "&#0; &bogus; &lt", "<button>gone</button>kept"])
def test_broken_pages_are_read(page):
    blocks, hashes = G.blocks_of(page)
    text = "\n".join(b[0] for b in blocks)
    assert "gone" not in text and ("deep" in text) == ("deep" in (page or "")) and ("kept" in text) == ("kept" in (page or ""))


def test_pages_of_the_tables(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for row in G.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = row["html"].split("<article>")[1].split("</article>")[0]
        assert len(row["text"]) > 0 and ("<nav>" not in row["text"]) and row["text"].split("\n")[0].split()[0] in inside.replace("&amp;", "&").replace("&quot;", '"')


# --- test passages ------------------------------------------------------------------------------------------


def brute_tiles(item, text, least):
    used_item, used_text, out = [False] * len(item), [w is None for w in text], []
    while True:
        best, places = 0, []
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not used_item[i + k] and not used_text[j + k]:
                    k += 1
                if k > best:
                    best, places = k, [(i, j)]
                elif k == best and k:
                    places.append((i, j))
        if best < least:
            return sorted(out)
        for i, j in sorted(places):
            if not any(used_item[i : i + best]) and not any(used_text[j : j + best]):
                used_item[i : i + best] = used_text[j : j + best] = [True] * best
                out.append(best)


def test_tilings_are_the_greedy_ones():
    draw = random.Random(1)
    for _ in range(150):
        words = draw.choice([2, 4, 30])
        item = [draw.randrange(words) for _ in range(draw.randrange(35))]
        text = [draw.randrange(words) for _ in range(draw.randrange(25))] + item[10:25] + [None] + item[:12]
        assert sorted(n for _, _, n in D.tiles(item, text, 3, draw.choice([3, 8, 32]))) == brute_tiles(item, text, 3)


def test_planted_passages_are_found(spark, sf):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = benchmark.orderBy("item_id").limit(4).collect()
    words = items[0]["text"].split()
    half = len(words) // 2
    rows = [(1, "aa bb " + " ".join(words[half:]) + " zz yy " + " ".join(words[:half])), (2, items[1]["text"].upper()), (3, "nothing here at all to see today"), (4, None), (5, ""), (None, items[2]["text"]), (1, "other"), (6, " ".join(words[:6])), (7, items[3]["text"] + " x" * 20000)]
    odd = benchmark.unionByName(benchmark.limit(2)).unionByName(spark.createDataFrame([(None, None), (777777, "a b"), (888888, "")], "item_id long, text string"))
    docs = docs_of(spark, rows).selectExpr("*", "1 AS item_id", "2 AS key", "3 AS seed")
    found = {(r["doc_id"], r["item_id"]): r["coverage"] for r in D.contaminated(docs, odd).collect()}
    assert found == {(1, 0): 1.0, (2, 1): 1.0, (None, 2): 1.0, (7, 3): 1.0}
    clean = D.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {3, 4, 5, 6}
    assert D.contaminated(docs.limit(0), benchmark).count() == 0 and D.contaminated(docs, benchmark.limit(0)).count() == 0


# --- pipeline -----------------------------------------------------------------------------------------------


def test_pipeline_takes_its_stages_in_turn(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.collect()}
        docs = written(stage(spark, docs, sf), name)
        assert {r["doc_id"] for r in docs.collect()} <= before
        if name != "pieces":
            assert docs.columns == columns
    got = {r["doc_id"]: r["n_pieces"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {r["doc_id"]: r["n_pieces"] for r in docs.collect()} and 0 < len(got) < left
    assert docs.where("NOT round_trip").count() == 0


def test_stages_take_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), f"empty-{name}")
        assert docs.count() == 0


def test_queries_return_their_columns(spark, sf):
    from casemill.llm.queries import llm_queries

    first = {
        1: "doc_id n_shingles component_id", 2: "doc_id n_pieces ids_crc32 round_trip", 3: "doc_id held_out score predicted", 4: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        5: "doc_id held_out score predicted", 6: "doc_id size text_crc32 law shard slot grown_shard", 7: "doc_id n_bytes n_tokens over_limit", 8: "page_id url text n_chars", 9: "doc_id start n_tokens ids_crc32", 10: "doc_id item_id",
    }
    for name, query in llm_queries().items():
        want = first[int(name[2:].split("_")[0])].split()
        assert query(spark, sf).columns[: len(want)] == want
    assert len(llm_queries()) == 10


def test_encoded_corpus_holds_its_ids(spark, sf):
    from casemill.llm.queries import llm_queries

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for found in (llm_queries()["op2_pieces"](spark, sf), corpus_pipeline.encoded(spark, docs, sf)):
        rows = found.collect()
        assert len(rows) == docs.count() and sum(r["n_pieces"] for r in rows) > 0
        for row in rows:
            raw = b"".join(i.to_bytes(4, "little") for i in row["ids"])
            assert len(row["ids"]) == row["n_pieces"] and zlib.crc32(raw) == row["ids_crc32"]


def test_parts_of_new_words_give_the_same_ids(monkeypatch):
    import public_tokenizers

    from casemill.llm import pieces

    texts = ["one two three", None, "", "x" * 300 + " two", "äöü 日本語 one"]
    path = public_tokenizers.path("piece_bpe_32k.model")
    want = [x.tolist() for x in pieces.Encoder(path).encode(texts)]
    monkeypatch.setattr(pieces, "PART_BYTES", 8)
    assert [x.tolist() for x in pieces.Encoder(path).encode(texts)] == want


def test_items_that_repeat_themselves_are_found(spark):
    line = "one two three four five six seven eight "
    items = spark.createDataFrame([(1, line * 12), (2, "tic toc " * 40), (3, line * 2 + " ".join(f"w{i}" for i in range(100)))], "item_id long, text string")
    docs = docs_of(spark, [(1, "before it " + line * 12 + "and after"), (2, "tic toc " * 40), (3, line), (4, "nothing of that")])
    found = {(r["doc_id"], r["item_id"]): r["coverage"] for r in D.contaminated(docs, items).collect()}
    assert found == {(1, 1): 1.0, (2, 2): 1.0}
    assert {r["doc_id"] for r in D.decontaminated(docs, items).collect()} == {3, 4}


def test_shuffled_seeds_and_blocks_of_items_find_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"this seed is in every item {i} " + " ".join(f"w{i}x{k}" for k in range(6))) for i in range(30)], "item_id long, text string")
    texts = [r["text"] for r in items.orderBy("item_id").collect()]
    rows = [(1, " zz ".join(texts)), (None, texts[3]), (2, " ".join(texts[20:25])), *[(10 + i, "this seed is in every item of none") for i in range(40)]]
    docs = docs_of(spark, rows)
    want = {(1, i) for i in range(30)} | {(None, 3)} | {(2, i) for i in range(20, 25)}
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()} == want
    for name, value in (("BROADCAST_KEYS", 0), ("ITEMS", 2), ("SENT_WORDS", 0), ("SALTS", 3)):
        monkeypatch.setattr(D, name, value)
    found = D.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want)


def texts_of(spark, pages):
    rows = [(i, "http://h.example/", page) for i, page in enumerate(pages)]
    return [r["text"] for r in G.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_recurring_paragraphs_of_marked_articles_go(spark):
    share = "<p>Share this with friends</p><ul><li><a href=x>More</a></ul>"
    page = "<body><article><h1>News {0}</h1><p>A text number {0} with its own words.</p><p>More of text {0} follows here.</p>" + share + "</article>"
    found = texts_of(spark, [page.format(i) for i in range(8)])
    assert found == [f"News {i}\nA text number {i} with its own words.\nMore of text {i} follows here." for i in range(8)]


@pytest.mark.parametrize("more", ["", "<p>A second paragraph of the same article.</p>"])
def test_copies_that_differ_in_date_and_links_keep_their_text(spark, more):
    body = "<body><div>Dated {0}</div><div class=x><h1>The title</h1><p>The copied article with its longest paragraph.</p>" + more + "</div><div><a href=x>A related page that has a very long title, number {0}</a></div>"
    other = "<body><div>Dated {0}</div><div class=x><h1>Page {0}</h1><p>Something else that only page {0} has to say.</p></div>"
    found = texts_of(spark, [body.format(i) for i in range(6)] + [other.format(i) for i in range(6, 12)])
    assert all("The title\nThe copied article with its longest paragraph." in t for t in found[:6])
    assert not more or all("A second paragraph" in t for t in found[:6])
    assert all(f"only page {i} has" in found[i] for i in range(6, 12))


def test_words_of_the_same_make_are_other_words(spark):
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    pair = ["".join("ab"[bit ^ turn] for bit in bits) for turn in (0, 1)]
    rows = [(1, pair[0]), (2, pair[1]), (3, " ".join([pair[0]] * 3 + ["q", "r", "s"])), (4, " ".join([pair[1]] * 3 + ["q", "r", "s"]))]
    found = {r["doc_id"]: r["component_id"] for r in J.joined(docs_of(spark, rows)).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 4}
    assert J.representatives(docs_of(spark, rows)).count() == 4
    items = spark.createDataFrame([(7, " ".join([pair[1]] * 6))], "item_id long, text string")
    docs = docs_of(spark, [(1, " ".join([pair[0]] * 6)), (2, " ".join([pair[1]] * 6))])
    assert [(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()] == [(2, 7)]


def test_crowded_signatures_miss_no_link(spark, monkeypatch):
    """Many classes of one slice share signatures; brute force over all pairs."""
    draw = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(draw.randrange(6)):
            words[draw.randrange(60)] = f"x{draw.randrange(50)}"
        rows.append((i, " ".join(words)))
    found = J.joined(docs_of(spark, rows).repartition(3)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(rows)


def test_pairs_of_unlike_sizes_are_shuffled_without_sketches(spark):
    sizes = spark.createDataFrame([(1, 10, b"\x05" * 2), (2, 9, b"\x05\x04"), (3, 100, b"\x32" * 2), (4, 10, None)], "cls long, n long, sketch binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4)], "cls long, hub long")
    made = J.hopeful_pairs(pairs, sizes, "sketch")
    joins = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert "greatest" not in joins[0] and "greatest" in joins[1]  # the last sketch is joined after sizes are compared
    assert sorted(map(tuple, made.collect())) == [(1, 2), (2, 4)]


def test_classes_count_as_a_whole_and_never_on_the_content(spark):
    long_ = "words of the article itself, enough of them to be most of what the page says. " * 3
    pages = [
        f'<body><div class="content no-sidebar"><p>{long_}</p></div><div class="sidebar">aside</div></body>',
        f'<body><article><header class="entry-header"><h1>Title</h1></header><p>{long_}</p><div class="social-studies"><p>taught</p></div></article></body>',
        f'<body><form action="/"><article><h1>Title</h1><p>{long_}</p></article><input></form></body>',
        f'<body><div class="header"><p>{long_}</p></div><form>your name</form></body>',
        f'<body><article><p>{long_}</p><div class="cookie-banner">we use them</div><div class="comments"><p>{long_}</p><p>{long_}</p></div></article></body>',
    ]
    text = long_.strip()
    assert texts_of(spark, pages) == [text, f"Title\n{text}\ntaught", f"Title\n{text}", text, text]


def test_prose_of_an_article_may_recur(spark):
    bodies = [f"sentence {i} of a text that is all its own and goes on for a while" for i in range(12)]
    share = '<ul><li><a href="/a">share here</a></li><li><a href="/b">share there</a></li></ul>'
    common = lambda i: "<h1>Conclusion</h1><p>the same words on many pages</p>" if i % 4 else "<h1>Other</h1>"
    pages = [f"<body><div><a href='/'>home</a></div><article>{common(i)}<p>{b}</p>{share}</article></body>" for i, b in enumerate(bodies)]
    assert texts_of(spark, pages) == [f"Conclusion\nthe same words on many pages\n{b}" if i % 4 else f"Other\n{b}" for i, b in enumerate(bodies)]


def test_subtrees_are_counted_as_by_hand(spark):
    draw = random.Random(6)
    widgets = [f"<div><p>widget {i} says this much</p></div>" for i in range(8)]
    rows = []
    for i in range(120):
        own = "".join(f"<div><p>page {i % 90} line {k} with words of its own {i % 90 * 7 + k}</p></div>" for k in range(4))
        some = "".join(w for w in widgets[: draw.randrange(9)])
        rows.append((i, f"http://{draw.choice('ab')}.example/{i}", f"<body>{some}{own}</body>"))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen, hosts = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        main, told = G.rests(*G.blocks_of(page))
        host = url.split("/")[2]
        hosts[host].add(main)
        for mark, rest in told:
            if rest is not None:
                seen[host, mark].add(rest)
    want = {key for key, found in seen.items() if len(found) >= 3 and len(found) >= min(0.01 * len(hosts[key[0]]), 100)}  # no page marks an article
    got = G.templates(G._addressed(frame, "page_id", "url", "html"))
    names = {spark.range(1).select(F.xxhash64(F.lit(h))).first()[0]: h for h in hosts}
    assert {(names[r["host"]], r["hash"]) for r in got.collect()} == want and want


def test_more_templates_than_are_sent(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"{sf}/pages.parquet").limit(60)
    sent = G.main_text(pages).collect()
    monkeypatch.setattr(G, "SENT_TEMPLATES", -1)
    assert sorted(G.main_text(pages).collect()) == sorted(sent)
