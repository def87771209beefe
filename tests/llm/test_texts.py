"""Suffix sorting, quality, page texts, decontamination and the pipeline."""

import html
import os
import re
import shutil
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from emberlog.llm import decontaminate, quality_mil, suffix_dedup, tag_paths
from emberlog.llm.induced import suffix_order


def check_order(strings, depth, memory=1 << 26):
    places, common, starts = suffix_order(strings, depth, memory)
    suffix = {st + i: s[i:][:depth] for s, st in zip(strings, starts.tolist(), strict=True) for i in range(len(s))}
    assert sorted(places.tolist()) == sorted(suffix)
    ordered = [suffix[p] for p in places.tolist()]
    for i, now in enumerate(ordered):
        want = os.path.commonprefix([ordered[i - 1], now]) if i else b""
        assert not i or ordered[i - 1] <= now
        assert common[i] == len(want)


def test_suffix_order_with_and_without_disk():
    rng = np.random.default_rng(0)
    check_order([b"banana", b"mississippi", b"aaaa", b"abab", b"", b"\0\0\xff"], 50)
    for _ in range(60):
        strings = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(0, 40), dtype=np.uint8)) for _ in range(rng.integers(1, 12))]
        if any(strings):
            check_order(strings, int(rng.choice([3, 8, 50])), int(rng.choice([0, 1 << 20])))
    base = bytes(rng.integers(0, 256, 600, dtype=np.uint8))
    check_order([base[i : i + 80] for i in rng.integers(0, 520, 60)], 50, 0)


def plain_spans(docs, length=50):
    first, out = {}, {}
    by_id = sorted((d, (t or "").encode()) for d, t in docs)
    for d, raw in by_id:
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], d)
    for d, raw in by_id:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < d:
                gone[i : i + length] = True
        out[d] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()))
    return out


def test_suffix_dedup_against_brute_force(spark):
    rng = np.random.default_rng(4)
    shared = ["".join(rng.choice(list("abcé "), n)) for n in (49, 50, 51, 75, 130, 400)]
    docs = []
    for i in range(60):
        parts = ["".join(rng.choice(list("abcdefg "), rng.integers(0, 120)))]
        for _ in range(rng.integers(0, 3)):
            parts += [shared[rng.integers(0, len(shared))], "".join(rng.choice(list("xyz"), rng.integers(0, 9)))]
        docs.append((i, "".join(parts)))
    docs += [(100 + i, "ab" * 60) for i in range(5)] + [(200 + i, "a" * (40 + 10 * i)) for i in range(4)]
    found = suffix_dedup.removal_digest(spark.createDataFrame(docs, "doc_id long, text string"), shard_bytes=3000, memory=1000).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in found} == plain_spans(docs)


def test_suffix_dedup_hard_cases(spark, hard, nothing):
    found = suffix_dedup.removal_digest(hard).collect()
    assert len(found) == hard.count()
    assert sorted((r.n_removed, r.n_bytes) for r in found if r.doc_id == 2) == [(0, 31), (184, 184), (184, 184)]
    assert all(r.n_removed == 0 for r in found if r.doc_id != 2)
    assert suffix_dedup.removal_digest(nothing).count() == 0
    kept = {r.kept for r in suffix_dedup.without_repeats(hard).collect() if r.doc_id == 2}
    assert {bytes(k) for k in kept} == {b"", b"Another text under the same id."}


def test_quality_query(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in entry.queries()["op3_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    unseen = [(found[r.doc_id].predicted, r.quality) for r in labels if found[r.doc_id].held_out]
    assert len(unseen) > 40 and np.mean([p == q for p, q in unseen]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())


def test_attention_gradients():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 3, 2, 5])
    x, y = rng.standard_normal((11, quality_mil.FEATURES)), np.array([0.0, 1, 1, 0])
    model = quality_mil.GatedAttention(None, None, [p.astype(np.float64) for p in quality_mil.GatedAttention._start(rng, 6, 4)])
    starts = np.cumsum(sizes) - sizes

    def loss():
        s = model._forward(x, starts, sizes)[-1]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for param, gradient in zip(model.params, model._gradients(x, starts, sizes, y), strict=True):
        flat = param.reshape(-1)
        for at in rng.integers(0, flat.size, 4):
            kept, out = flat[at], []
            for step in (1e-5, -1e-5):
                flat[at] = kept + step
                out.append(loss())
            flat[at] = kept
            assert abs((out[0] - out[1]) / 2e-5 - gradient.reshape(-1)[at]) < 1e-6


def test_quality_hard_cases(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (6, 0), (7, None), (8, 0), (None, 1)], "doc_id long, quality int")
    model = quality_mil.fit_quality(hard, labels)
    assert quality_mil.score_quality(hard, model).count() == hard.count()
    assert {r.held_out for r in quality_mil.score_quality(hard, model).where("doc_id is null").collect()} == {True}
    nobody = quality_mil.fit_quality(hard, labels.limit(0))
    assert {r.score for r in quality_mil.score_quality(hard, nobody).collect()} == {0.5}
    assert quality_mil.keep_good(hard, labels).columns == hard.columns
    assert quality_mil.keep_good(nothing, labels.limit(0)).count() == 0
    assert quality_mil.score_quality(nothing, nobody).count() == 0


def test_page_texts_query(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in entry.queries()["op4_tag_paths"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = re.split(r"</?(?:h1|p|br)>", re.sub(r"</?b>", "", article))
        assert r.text == " ".join(x for b in blocks if (x := " ".join(html.unescape(b).split())))
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)


PAGE = """<html><head><title>no</title></head><body><header><h1>Site</h1></header><div id="menu"><a>Home</a></div>
<div class="cookie-notice">We use cookies, ok?</div><div class="main"><h1>Title</h1>{p}<p>Short &amp; sweet.</p><aside>side, text.</aside>{p}
<ul><li>one<li>two</ul><form>Name: <input> <button>Go</button></form><div class="ad">Buy! Now!</div><pre>a
 b</pre></div><div class="comments"><p>{c}</p></div><div class="sidebar"><p>{c}</p></div><footer>end</footer></body>"""


def test_page_text_without_article_element():
    p, c = "<p>" + "Some words here, which make a sentence. " * 5 + "</p>", "Nice, I like it. Good! " * 9
    sentence = " ".join(["Some words here, which make a sentence."] * 5)
    assert tag_paths.main_text(PAGE.format(p=p, c=c)) == f"Title {sentence} Short & sweet. {sentence} one two a b"
    assert tag_paths.main_text("just text &lt;x&gt; &am") == "just text <x> &am"
    assert tag_paths.main_text("<p>a<b>b</b>c &nbsp; d<p>e<!-- x -->f<script>var t='</p>';</script>") == "abc d ef"
    assert tag_paths.main_text("<nav>menu</nav>") == tag_paths.main_text("") == ""


def test_page_text_in_several_elements():
    part = lambda n: "<p>" + "Some words here, which make a sentence. " * n + "</p>"
    text = " ".join(["Some words here, which make a sentence."] * 10)
    split = f"<body><div id=content><h1>Title</h1><div class=part>{part(6)}</div><div class=part>{part(4)}</div></div></body>"
    assert tag_paths.main_text(split) == f"Title {text}"
    articles = f"<body><div>x</div><article>{part(6)}</article><article><h2>Next</h2>{part(4)}</article></body>"
    assert tag_paths.main_text(articles).replace("Next ", "") == text and "Next" in tag_paths.main_text(articles)


def plain_means(paths, texts):
    """The ratios of tag paths, one block at a time."""
    size, marks, n = {}, {}, {}
    for p, t in zip(paths, texts, strict=True):
        size[p] = size.get(p, 0) + len(t)
        marks[p] = marks.get(p, 0) + sum(c in ".,;:!?…。，、；：！？¿¡" for c in t)
        n[p] = n.get(p, 0) + 1
    fused = [1.0] * len(paths)
    for total in (size, marks):
        raw = [total[p] / n[p] for p in paths]
        smooth = [(raw[max(i - 1, 0)] + 8 * raw[i] + raw[min(i + 1, len(raw) - 1)]) / 10 for i in range(len(raw))]
        mean = sum(smooth) / len(smooth)
        spread = (sum((v - mean) ** 2 for v in smooth) / len(smooth)) ** 0.5 or max(smooth) or 1.0
        fused = [f * (v / spread + 0.1) for f, v in zip(fused, smooth, strict=True)]
    fused = [f**0.5 for f in fused]
    mean = sum(fused) / len(fused)
    own = {p: [f for q, f in zip(paths, fused, strict=True) if q == p] for p in set(paths)}
    return [sum(own[p]) / len(own[p]) for p in paths], (sum((f - mean) ** 2 for f in fused) / len(fused)) ** 0.5


def test_path_ratios_against_a_plain_version():
    rng = np.random.default_rng(2)
    for _ in range(40):
        paths = rng.choice(["a/b", "a/c", "a/c/d", "e"], rng.integers(1, 30)).tolist()
        texts = ["".join(rng.choice(list("abc .,!"), rng.integers(1, 60))) for _ in paths]
        means, spread = tag_paths.path_means(paths, texts)
        plain, plain_spread = plain_means(paths, texts)
        assert np.allclose(means, plain) and np.isclose(spread, plain_spread)


LONG = "This sentence, one of many, has some words; and it ends here. " * 4
#: Pages without an article element or a telling name: (html, what is the article).
NAMELESS = [
    (f"<body><div class=a><span>x</span><div class=b>Unrelated teaser.</div></div><div class=c><h2>Head</h2><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div></body>", ["Head", LONG, "Short one.", LONG]),
    (f"<body><table><tr><td><a>one</a></td><td><a>two</a></td></tr></table><div><div><p>{LONG}</p><div><b>inner note</b></div><p>{LONG}</p></div><div>More: this, that</div></div></body>", [LONG, "inner note", LONG]),
    (f"<body><section><h1>Top</h1><section><p>{LONG}</p></section><section><p>{LONG}</p></section></section><div><div>a</div><div>b</div><div>c</div></div></body>", ["Top", LONG, LONG]),
    (f"<body><div><div>go</div><div>on</div></div><p>{LONG}</p><h3>Next</h3><p>{LONG}</p><div><div>in</div><div>out</div></div></body>", [LONG, "Next", LONG]),
]


def test_ratios_choose_the_content_of_nameless_pages():
    for page, parts in NAMELESS:
        assert tag_paths.main_text(page) == " ".join(" ".join(parts).split())
        everything = tag_paths.main_text(page, 0.0)
        assert len(everything) > len(tag_paths.main_text(page)) and "".join(everything.split()) == "".join(re.sub(r"<[^>]*>", " ", page).split())


def test_comments_and_articles_inside_articles():
    comment = "Nice post, thanks a lot, really. I read it twice, and then again!"
    for tag in (f'<article class="comment"><p>{comment}</p></article>', f"<article><article><p>{comment}</p></article><p>{LONG}</p></article>"):
        page = f"<body><main><article><h1>T</h1><p>{LONG}</p></article>{tag}</main><div>Unrelated teaser.</div></body>"
        found = tag_paths.main_text(page)
        assert "Nice post" not in found and "teaser" not in found and found.startswith("T This sentence")
    titled = f"<body><main>Stray words here<article><header><h1>T</h1></header><p>{LONG}</p></article></main></body>"
    assert tag_paths.main_text(titled) == " ".join(f"T {LONG}".split())
    deep = "<div>" * 3000 + "</x>" * 3000 + f"<p>{LONG}" + "</div>" * 3000
    assert tag_paths.main_text(deep) == " ".join(LONG.split())


def test_page_hard_cases(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>text", "y"), (2, None, "", None), (3, "v", "<p>" + "word, " * 50_000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = tag_paths.extract(pages).collect()
    assert sorted(r.n_chars for r in found) == [0, 0, 0, 4, 299_999]
    assert tag_paths.extract(pages.limit(0)).count() == 0


def test_leaks_query(spark):
    folder = "/root/testdata/sf0.01"
    items = {r.item_id: r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    words = lambda text: re.findall(r"[^\W_]+", text.lower())
    windows = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in ((i, words(t)) for i, t in items.items())}
    want = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        w = words(r.text)
        here = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
        want |= {(r.doc_id, i) for i, v in windows.items() if len(v & here) >= 0.8 * len(v)}
    found = entry.queries()["op6_decontaminate"](spark, folder).collect()
    assert want and {(r.doc_id, r.item_id) for r in found} == want


QUESTION = "A train leaves the station at 9 o'clock and travels 120 km north before Alice Miller counts 45 apples and 45 pears. How many remain?"


def test_templates_and_slots(spark):
    again = QUESTION.replace("120 km", "75 miles").replace("Alice Miller", "Bob").replace("45", "17")
    docs = [
        (1, "Before it. " + QUESTION + " After it."),
        (2, "Before it. " + again.upper().replace("BOB", "Bob") + " After it."),
        (3, "Before it. " + again.replace("17 pears", "18 pears")),
        (4, "A train leaves the station at 9 o'clock and then nothing more happens to anyone in this whole text."),
        (5, None), (None, QUESTION), (6, ""), (7, "two words"), (1, "Before it. " + QUESTION + " After it."),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit(1)).withColumn("place", F.lit("x"))
    bench = spark.createDataFrame([(10, QUESTION), (11, "two words"), (12, None), (13, ""), (None, "x y z")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(frame, bench).collect()}
    assert set(found) == {(1, 10), (2, 10), (7, 11)}
    assert found[1, 10].n_changed == 0 and found[2, 10].n_changed > 0
    kept = decontaminate.drop_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "6", "None"]
    assert decontaminate.find_leaks(frame.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0


LISTS = [
    "Add up the numbers 3, 7, 8, 12, 15, 20 and 31 in the list and write down the total of them all.",
    "The sensor in the hall was read on 2024-01-15 12:30:45 by the man on duty, who wrote it into the book.",
    "She mixed 3 kg 7 g 4 kg 9 g 5 kg 2 g of the flour with water until the dough was smooth and soft.",
]


def test_items_that_match_themselves_shifted(spark):
    changed = LISTS[0].replace("3, 7, 8, 12, 15, 20 and 31", "4, 9, 1, 22, 75, 30 and 61")
    moved = LISTS[0].replace("Add up the", "Add up all the").replace("list and", "long list and")
    docs = [(k, f"Some words before it. {text} Some words after it.") for k, text in enumerate([*LISTS, changed, moved])]
    bench = spark.createDataFrame(list(enumerate(LISTS)), "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench, share=0.5).collect()
    assert sorted((r.doc_id, r.item_id, r.n_changed) for r in found) == [(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 0, 7), (4, 0, 0)]
    assert all(r.start == 22 for r in found if r.doc_id < 4)


def test_siblings_do_not_hide_the_item(spark):
    sibling = QUESTION.replace("45 pears", "46 pears")
    docs = [(1, f"{sibling} Then: {QUESTION}"), (2, f"{QUESTION} Then: {sibling}"), (3, f"{sibling} Then: {sibling}")]
    bench = spark.createDataFrame([(10, QUESTION)], "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.n_changed) for r in found) == [(1, 10, 0), (2, 10, 0)]
    assert {r.doc_id: r.start for r in found} == {1: len(sibling) + 7, 2: 0}


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, kept = [n for n, _ in corpus_pipeline.STAGES], [docs.count()]
    assert len(names) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        kept.append(docs.count())
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert kept == sorted(kept, reverse=True) and 0.5 * kept[0] < kept[-1] < kept[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = [labels[r.doc_id] for r in docs.select("doc_id").collect() if r.doc_id in labels]
    assert left.count(0) <= 0.02 * len(left)
    assert decontaminate.find_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("gone", [["emberlog/llm", "corpus_pipeline.py", "tests/llm"]])
def test_the_rest_stands_without_this_part(tmp_path, gone):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in ("emberlog", "__spark_entry__.py"):
        source = os.path.join(root, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 100 and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_the_map_of_windows_grows_with_them(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MAP_BITS", 8)
    asked = spark.range(5000).selectExpr("id as doc_id", "id * 7919 as text_hash", "id % 97 as start")
    bits = suffix_dedup._bit_map(asked)
    # two bits of each of 5,000 windows; a map that is full picks every other window as well
    assert 0.03 < np.unpackbits(bits).mean() < 0.1
    monkeypatch.setattr(suffix_dedup, "MOST_BITS", 9)
    assert len(suffix_dedup._bit_map(asked)) == 64


def test_blocks_hold_their_columns():
    columns = [np.arange(7, dtype="<u8") << 40, np.zeros(0, np.int64), np.arange(300, dtype=np.uint16), np.arange(5, dtype=np.uint8)]
    for given, found in zip(columns, suffix_dedup._spread(suffix_dedup._squeezed(*columns)), strict=True):
        assert given.dtype == found.dtype and given.tolist() == found.tolist()
    # each of 64 shards costs a block: one for the whole pass, not one for each part of it
    made = suffix_dedup._blocks(64, 50, 16)
    texts = [" ".join(f"w{i * 7919 % 9973}x{i}" for i in range(k * 500, k * 500 + 110_000)) for k in range(10)]
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(10)), "text": texts, "text_hash": list(range(10))})
    assert sum(b.num_rows for b in made(iter([rows]))) == 64
