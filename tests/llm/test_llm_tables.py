"""Token files, nearest neighbours, page text and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from propensity.llm import ann, html_text, queries, tokenfile
from propensity.session import scratch_path
from test_llm_text import SF, documents, edge_docs, empty_docs


# ---------------------------------------------------------------- token files

@pytest.fixture(scope="module")
def tokenizer_file():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def library_ids(tokenizer_file, texts):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(tokenizer_file)
    return [full.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def test_token_files_round_trip(spark, tokenizer_file):
    rows = documents(spark).orderBy("doc_id").collect()
    expected = library_ids(tokenizer_file, [r.text for r in rows])
    got = queries.op10_token_binary(spark, SF).orderBy("doc_id").collect()
    start = 0
    for r, g, ids in zip(rows, got, expected, strict=True):
        assert (g.doc_id, g.start, g.n_tokens) == (r.doc_id, start, len(ids))
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_file_edges(spark, tokenizer_file):
    docs = edge_docs(spark, extra=("a  b", " lead", "trail ", "x y", "tab\tx \n y", "\x1c \x1d",
                                   "<|endoftext|>", "it's we'll  'tis", "x² ½ word². été d'a Àé×ö÷ ªµº ǅ ÿ.,; $*#x 9a",
                                   "".join(map(chr, range(33, 0x260))), " ".join(map(chr, range(33, 0x260))), "  z", "q " * 5000))
    path = scratch_path(spark, f"tokens-{random.random()}")
    tokenfile.write_token_files(docs, tokenizer_file, path)
    got = tokenfile.read_token_files(spark, path).collect()
    assert len(got) == docs.count()
    texts = [r.text for r in docs.collect()]
    expected = sorted(np.array(i, "<u4").tobytes() for i in library_ids(tokenizer_file, texts))
    assert sorted(bytes(r.ids) for r in got) == expected
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    path = scratch_path(spark, f"tokens-{random.random()}")
    tokenfile.write_token_files(empty_docs(spark), tokenizer_file, path)
    assert tokenfile.read_token_files(spark, path).collect() == []


def test_code_is_prefix_free_limited_and_optimal():
    rng = np.random.default_rng(2)
    counts = np.zeros(300, np.int64)
    counts[:260] = rng.zipf(1.3, 260)
    lengths = tokenfile.code_lengths(counts, 12)
    assert lengths.max() <= 12 and (lengths[260:] == 0).all() and (lengths[:260] > 0).all()
    assert sum(2.0 ** -x for x in lengths[:260].tolist()) <= 1
    import heapq
    heap = [int(c) for c in counts[:260]]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (tokenfile.code_lengths(counts, 40) * counts).sum() == cost
    code = tokenfile.Code(lengths)
    ids = rng.choice(260, 5000).astype(np.uint32)
    payload, start, marks = code.encode(ids, np.array([5000]))
    sizes = np.full(len(marks), tokenfile.EVERY)
    sizes[-1] = 5000 - tokenfile.EVERY * (len(marks) - 1)
    assert start.tolist() == [0]
    assert (np.concatenate(code.decode(payload, marks, sizes)) == ids).all()
    parts = np.array([1, 512, 513, 3000, 974])
    payload, start, marks = code.encode(ids, parts)
    lanes = -(-parts // tokenfile.EVERY)
    first = np.cumsum(parts) - parts
    for p, n in enumerate(parts):
        own = marks[np.cumsum(lanes)[p] - lanes[p]:np.cumsum(lanes)[p]] + 8 * start[p]
        counts = np.full(lanes[p], tokenfile.EVERY)
        counts[-1] = n - tokenfile.EVERY * (lanes[p] - 1)
        assert (np.concatenate(code.decode(payload, own, counts)) == ids[first[p]:first[p] + n]).all()
    payload, _, marks = code.encode(ids, np.array([5000]))
    alone = code.decode(payload, marks[3:4], sizes[3:4])[0]         # from one checkpoint
    assert (alone == ids[3 * tokenfile.EVERY:4 * tokenfile.EVERY]).all()
    assert tokenfile.code_lengths(np.array([0, 9, 0])).tolist() == [0, 1, 0]


# --------------------------------------------------------- nearest neighbours

def slow_neighbours(ids, vectors, query, k):
    score = vectors @ vectors[query]
    order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[query]]
    return [(int(ids[j]), float(score[j])) for j in order[:k]]


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    for options in ({}, {"shard_rows": 100, "query_rows": 10}):
        got = {}
        for r in ann.search(frame, F.col("vec_id") % 20 == 0, k=20, **options).collect():
            got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
        hits = total = 0
        for q in np.flatnonzero(ids % 20 == 0):
            expected = slow_neighbours(ids, vectors, q, 20)
            found = got[ids[q]]
            assert sorted(found) == list(range(1, 21))
            hits += len({v for v, _ in expected} & {v for v, _ in found.values()})
            total += 20
            scores = [found[i][1] for i in range(1, 21)]
            assert scores == sorted(scores, reverse=True)
            assert all(abs(s - vectors[ids == v][0] @ vectors[q]) < 1e-12 for v, s in found.values())
        assert hits / total >= 0.9


def test_neighbour_edges(spark):
    rng = np.random.default_rng(0)
    same = rng.normal(size=8).tolist()
    rows = [(i, same, "x") for i in range(300)]                    # one vector for most rows
    rows += [(i, (rng.normal(size=8) * rng.uniform(0.1, 9)).tolist(), "y") for i in range(300, 420)]
    bad = [(1000, None, "n"), (1020, [], "n"), (1040, [0.0] * 8, "n"), (1060, [1.0, None] + [0.0] * 6, "n"),
           (1080, [float("nan")] * 8, "n"), (1100, [float("inf")] + [0.0] * 7, "n"), (None, same, "n"),
           (1120, [1.0, 2.0, 3.0], "n"), (1140, [1.0, 2.0, 4.0], "n")]
    frame = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<double>, rank string")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0, k=20, shard_rows=64).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        expected = slow_neighbours(ids, vectors, q, 20)
        found = [v for _, v, _ in sorted(got[ids[q]])]
        hits += len({v for v, _ in expected} & set(found))
        total += 20
    assert hits / total >= 0.95
    assert [v for _, v, _ in sorted(got[0])] == [v for v, _ in slow_neighbours(ids, vectors, 0, 20)]
    assert [(rk, v) for rk, v, _ in got[1120]] == [(1, 1140)]
    assert set(got) == set(ids[ids % 20 == 0].tolist()) | {1120, 1140}
    assert ann.search(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


# ------------------------------------------------------------------ page text

def test_article_text():
    page = ("<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body>"
            "<header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav><!-- <p>no</p> -->"
            "<div class='cookie-notice'>We use</div><div class=\"sidebar\">s</div><main>"
            "<article class='post'><header><h1>A &amp; B</h1></header><p>one <b>bo</b>ld&nbsp;&nbsp;x"
            "<p class=\"ad\">buy<p>two<br>lines\n\n here<aside>aside</aside> tail</article>"
            "<section id='comments'><article class='comment'>reader</article></section></main>"
            "<form><p>mail</p></form><footer>&copy; f</footer>")
    kept = [t for t, kind in html_text.parse(page) if kind == html_text.KEEP]
    assert kept == ["A & B", "one bold x", "two lines here", "tail"]
    assert html_text.parse(None) == [] and html_text.parse("") == []
    assert html_text.parse("a < b <i>c") == [("a < b c", html_text.OPEN)]
    assert html_text.host_of("https://u@Www.Ex.com:80/x?y") == "www.ex.com"
    assert html_text.host_of(None) is None


def test_telling_parts_of_names_do_not_drop_main_text():
    kept = lambda page: [t for t, kind in html_text.parse(page) if kind == html_text.KEEP]
    left = lambda page: [t for t, kind in html_text.parse(page) if kind != html_text.DROP]
    for name in ("layout has-sidebar", "no-sidebar", "with-comments"):
        assert kept(f'<div class="{name}"><nav>n</nav><article><p>text</p></article></div>') == ["text"]
    assert kept('<main><h1>T</h1><div class="no-sidebar"><article>text</article></div></main>') == ["T", "text"]
    page = ('<article class="ad-free"><h2 id="cookies">Cookies</h2><h2 id="menu">Menu</h2>'
            '<p>We <span class="share">share</span> it<p class="notice">Notice<div class="ad">buy</div></article>')
    assert kept(page) == ["Cookies", "Menu", "We share it"]
    assert left(page) == ["Cookies", "Menu", "We share it", "Notice"]
    assert kept("<main><p>one<p>two<article>teaser</article></main>") == ["one", "two", "teaser"]
    assert left('<div class="content"><p>one<article>teaser</article></div>') == ["one", "teaser"]
    assert left('<article>a<div class="comments"><article class="x">c</article></div></article>') == ["a"]
    assert html_text.parse('<div class="cookie-bar">c</div><p>t') == [("c", html_text.OPEN), ("t", html_text.OPEN)]
    assert kept('<article>a<div class="related-posts"><article>r</article></div></article>') == ["a"]


def test_pages_match_their_articles(spark):
    import html
    import re
    rows = queries.op8_html_extraction(spark, SF).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", source[r.page_id], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", x))).strip()
                 for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text)


def test_repeated_runs_leave_open_blocks(spark):
    words = lambda seed, n: " ".join(
        "".join(random.Random(f"{seed}{i}").choices("abcdefgh", k=6)) for i in range(n))
    shared = words("menu", 14)
    rows = [(i, f"http://h.example/{i}", f"<div>{shared}</div><div>{words(i, 30)}</div>") for i in range(6)]
    rows += [(10, "http://other.example/1", f"<div>{shared}</div>"),            # another host: unique
             (11, "http://h.example/x", f"<article><p>{shared}</p></article>"),  # main text: stays
             (12, None, None), (13, "http://h.example/y", ""),
             (14, "http://h.example/z", f"<p>{words('m', 3)} {shared} {words('n', 3)}</p>"),
             (0, "http://h.example/0", rows[0][2]), (20, None, f"<div>{shared}</div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "text", F.lit("clash")).withColumn("host", F.lit(1))
    out = html_text.extract(pages).collect()
    by_id = {r.page_id: r.text for r in out}
    assert len(out) == len(rows)
    for i in range(6):
        assert by_id[i] == words(i, 30)
    assert by_id[10] == shared and by_id[11] == shared and by_id[20] == shared
    assert by_id[12] == "" and by_id[13] == ""
    assert by_id[14] == f"{words('m', 3)} {words('n', 3)}"
    assert html_text.extract(pages.limit(0)).collect() == []


def test_host_templates_leave_articles_and_copies_stay(spark):
    words = lambda seed, n: " ".join(
        "".join(random.Random(f"{seed}{i}").choices("abcdefgh", k=6)) for i in range(n))
    advert, passage, copied = words("advert", 12), words("passage", 20), [words(f"c{i}", 15) for i in range(4)]
    page = lambda blocks: "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    own = {i: [words(f"{i}a", 15), advert, words(f"{i}b", 15)] for i in range(40)}
    own[0] = [words("0a", 15), advert]                          # at the end of the article
    own |= {i: [words(f"{i}a", 15), passage, words(f"{i}b", 15)] for i in range(40, 43)}
    own |= {i: copied for i in range(50, 60)}                   # exact copies
    own |= {60 + i: [*copied[:i], words(f"n{i}", 15), *copied[i + 1:]] for i in range(4)}  # near copies
    rows = [(i, f"http://h.example/{i}", page(b)) for i, b in own.items()]
    rows += [(100, "http://other.example/", page(own[0]))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for i, blocks in own.items():
        assert got[i] == "\n".join(b for b in blocks if b != advert), i
    assert got[100] == "\n".join(own[0])


def test_template_runs_of_several_blocks_leave_articles_and_near_copies_stay(spark):
    words = lambda seed, n: " ".join(
        "".join(random.Random(f"{seed}{i}").choices("abcdefgh", k=6)) for i in range(n))
    page = lambda blocks: "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    three = [words(f"t{i}", 12) for i in range(3)]              # the middle one has the same neighbours
    three = [words("s0", 4), *three, words("s1", 4)]            # short ones leave with long neighbours
    title = words("title", 8)
    own = {i: [title, title, words(f"{i}a", 30), *three, words(f"{i}b", 30)] for i in range(6)}
    own[6] = [words("6a", 20), f"{three[1]} {words('6c', 3)}", words("6b", 20)]     # covered in part
    copied = [words(f"c{i}", 15) for i in range(6)]
    own |= {10 + i: [*copied[:i], words(f"n{i}", 15), *copied[i + 1:]] for i in range(6)}
    rows = [(i, f"http://h{i // 10}.example/{i}", page(b)) for i, b in own.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in html_text.extract(pages).collect()}
    for i, blocks in own.items():
        assert got[i] == [b for b in blocks if b not in three], i
    tokens = [b.split(" ") for b in ("a b c", "d", "e f g h")]
    assert html_text.leaving_blocks([["a", "b"], ["a", "b"], ["c"]], {0, 1}, run=3) == set()
    assert html_text.leaving_blocks(tokens, {0, 1, 4}, run=3) == {0, 1}
    assert html_text.leaving_blocks(tokens, {4, 5}, run=3) == {2}
    assert html_text.leaving_blocks(tokens, {0, 1, 2, 3}, run=3) == {0, 1}      # the rest of the third stays
    assert html_text.leaving_blocks(tokens, {0, 2, 5}, run=3) == {0, 1, 2}
    assert html_text.leaving_blocks(tokens, {1, 2, 3}, run=3) == set()


def slow_covered(streams, run):
    """Positions that a substring of ``run`` tokens shared by two pages covers."""
    seen = {}
    for page, tokens in streams.items():
        for i in range(len(tokens) - run + 1):
            seen.setdefault(tuple(tokens[i:i + run]), set()).add(page)
    return {page: {p for i in range(len(t) - run + 1) if len(seen[tuple(t[i:i + run])]) > 1
                   for p in range(i, i + run)} for page, t in streams.items()}


def test_suffix_table_equals_brute_force(spark):
    rng = random.Random(4)
    streams = {i: [rng.choice("abc") for _ in range(40)] for i in range(12)}
    pages = spark.createDataFrame([(i, "http://h/x", f"<p>{' '.join(t)}</p>") for i, t in streams.items()],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages, run=5).collect()}
    for i, covered in slow_covered(streams, 5).items():
        assert got[i] == " ".join(t for p, t in enumerate(streams[i]) if p not in covered)


# ------------------------------------------------------------------- pipeline

def test_pipeline_stages_take_effect(spark):
    docs = documents(spark)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "decontamination", "secret_scan", "sentencepiece"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        following = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert following.columns == docs.columns
            path = scratch_path(spark, f"stage-{random.random()}")
            following.write.parquet(path)
            following = spark.read.parquet(path)
        else:
            final = following.collect()
        docs = following
        counts.append(docs.count() if name != "sentencepiece" else len(final))
    assert counts == sorted(counts, reverse=True) and counts[3] < counts[0]
    assert counts[3] == counts[4] == counts[5] and counts[5] > 0.7 * counts[0]
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in final)
    assert {r.doc_id: r.ids_crc32 for r in final} == {
        r.doc_id: r.ids_crc32 for r in corpus_pipeline.run(spark, SF).collect()}


def test_pipeline_stages_on_edges(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            if name in ("secret_scan", "sentencepiece"):
                assert len(rows) == docs.count()
            if name != "sentencepiece":
                assert out.columns == docs.columns
