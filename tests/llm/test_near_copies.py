"""SimHash, paragraph and I-Match operators against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from emberlog.llm import decontaminate, imatch, paragraphs, simhash
from emberlog.llm.components import components
from emberlog.llm.jaccard import cells
from emberlog.llm.work import written


def grouped(nodes, links):
    label = {n: n for n in nodes}

    def top(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        label[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def plain_fingerprint(text, size=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query(spark, sf_dir, rows):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    prints = {d: plain_fingerprint(t) for d, t in docs}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = grouped(prints, links)
    assert rows(entry.queries()["op5_simhash"](spark, sf_dir)) == [(d, f"{prints[d]:016x}", want[d]) for d in sorted(prints)]


def test_simhash_hard_cases(spark, hard, nothing):
    found = simhash.near_duplicates(hard).collect()
    assert len(found) == hard.count()
    by_id = defaultdict(set)
    for r in found:
        by_id[r.doc_id].add((r.fingerprint, r.component_id))
    assert {c for _, c in by_id[1] | {x for x in by_id[2] if x in by_id[1]}} == {1}
    assert {next(iter(by_id[i])) for i in (3, 4, 5)} == {("0" * 16, 3)}
    assert {c for _, c in by_id[None]} == {None}
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(hard)
    assert kept.columns == hard.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[3] == 1 and ids[4] == 0 and ids[None] == 2 and ids[6] == ids[7] == ids[8] == 1
    assert simhash.keep_one(nothing).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 4, 7, 12])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(radius)
    for words in (1, 2):
        fps = np.repeat(rng.integers(0, 1 << 63, (20, words), dtype=np.uint64), 9, 0)
        for _ in range(8):
            flip = np.uint64(1) << rng.integers(0, 64, fps.shape, dtype=np.uint64)
            fps ^= np.where(rng.random(fps.shape) < 0.5, flip, np.uint64(0))
        n = len(fps)
        low, high = np.arange(n) + 1, np.full(n, n)
        got = {(int(a), int(b)) for x, y in simhash.close_pairs(fps, low, high, radius, block=97) for a, b in zip(x, y, strict=True)}
        distance = np.bitwise_count(fps[:, None] ^ fps[None]).sum(2)
        assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if distance[i, j] <= radius}


def test_cells_of_a_hot_bucket_lose_no_link(spark):
    rng = np.random.default_rng(5)
    fps = np.repeat(rng.integers(0, 1 << 63, 20, dtype=np.uint64), 20)
    for _ in range(6):
        fps ^= np.where(rng.random(len(fps)) < 0.5, np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64), np.uint64(0))
    n = len(fps)
    links = [(i, j) for i in range(n) for j in range(i + 1, n) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 4]
    reps = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64).tolist())], "fp long, rep long")
    edges = simhash.link_edges(reps, cell_rows=8)
    assert grouped(range(n), [tuple(r) for r in edges.collect()]) == grouped(range(n), links)
    same = {r.node: r.component for r in components(edges).collect()}
    assert {i: same.get(i, i) for i in range(n)} == grouped(range(n), links)


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(500)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (2000, 2001), (2001, 2000)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == grouped({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_groups(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, texts = [], []
    for i in range(60):
        words = list(rng.choice(vocabulary, 200))
        texts.append(words)
        rows += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(words))]
        changed = list(words)
        changed[50] = "other"
        changed[120:122] = ["x", "y"]
        rows.append((10 * i + 2, " ".join(changed)))
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), cell_rows=2).collect()}
    assert found == {d: d // 10 * 10 for d, _ in rows}


def plain_units(text, min_words):
    """(place, lines, block, words) of blocks between blank lines, and of long lines in them."""
    lines, out, at = [x.lower().split() for x in (text or "").split("\n")], [], 0
    while at < len(lines):
        end = at
        while end < len(lines) and lines[end]:
            end += 1
        words = [w for x in lines[at:end] for w in x]
        if len(words) >= 5:
            out.append((at, end - at, at, tuple(words)))
        if end - at > 1:
            out += [(k, 1, at, tuple(lines[k])) for k in range(at, end) if len(lines[k]) >= max(5, min_words)]
        at = end + 1
    return sorted(out)


def plain_repeats(docs, min_words=25, threshold=0.8):
    found = [(doc_id, *u) for doc_id, text in sorted(docs) for u in plain_units(text, min_words)]
    nodes = {}
    for *_, words in found:
        nodes.setdefault(words, (len(nodes), {tuple(words[i : i + 5]) for i in range(len(words) - 4)}))
    sets = [s for _, s in nodes.values()]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    label, first, gone = grouped(range(len(sets)), links), {}, []
    for doc_id, place, n, block, words in found:
        group = label[nodes[words][0]]
        if group in first:
            gone.append((doc_id, place, n, block, *first[group]))
        else:
            first[group] = (doc_id, place)
    blocks = {(d, b) for d, _, n, b, *_ in gone if n > 1}
    return [(d, p, kd, kp) for d, p, n, b, kd, kp in gone if n > 1 or (d, b) not in blocks]


def test_paragraphs_query(spark, sf_dir, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = entry.queries()["op8_paragraphs"](spark, sf_dir)
    lines = found.where("unit = 'paragraph'").select("doc_id", "place", "kept_doc_id", "kept_place")
    assert rows(lines) == sorted(plain_repeats(docs))
    flagged = {(r.doc_id, p) for r in found.collect() for p in range(r.start, r.end)}
    seen = {}
    for doc_id, text in sorted(docs):
        words = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"\S+", text or "")]
        for k in range(len(words) - 49):
            run = tuple(w for w, _, _ in words[k : k + 50])
            if seen.setdefault(run, doc_id) != doc_id:
                assert any((doc_id, p) in flagged for p in range(words[k][1], words[k + 49][2]))


def test_passages_inside_other_text(spark):
    rng = np.random.default_rng(6)
    draw = lambda n: " ".join(f"t{x}" for x in rng.integers(0, 10**9, n))
    passage, short = draw(51), draw(24)
    docs = [(i, f"{draw(20 + i)} {passage} {draw(30)} {short} {draw(9)}") for i in range(12)] + [(50 + i, draw(90)) for i in range(9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = paragraphs.repeated_paragraphs(frame).collect()
    assert {r.doc_id for r in found} == set(range(1, 12)) and {(r.unit, r.kept_doc_id) for r in found} == {("passage", 0)}
    texts = dict(docs)
    assert all(texts[r.doc_id][r.start : r.end] in passage for r in found)
    cut = {r.doc_id: r.text for r in paragraphs.without_repeats(frame).collect()}
    assert [i for i in texts if passage in cut[i]] == [0] and all(short in cut[i] for i in range(12))


def test_passages_go_from_the_first_word_to_the_last(spark):
    rng = np.random.default_rng(16)
    draw = lambda n: " ".join(f"t{x}" for x in rng.integers(0, 10**9, n))
    fifty, long, tail = draw(50), draw(173), draw(60)
    line = draw(40)
    docs = [(i, f"{draw(20 + i)} {fifty} {draw(30)} {long} {draw(9)}") for i in range(6)]
    # each half of the run is shared with another document
    docs += [(10, f"{draw(30)} {tail} {draw(30)}"), (11, f"{draw(9)} {long} {tail} {draw(9)}")]
    # a passage that begins inside a repeated line
    docs += [(20 + i, f"{draw(5)}\n{line}\n{tail[: len(tail) // 2]} {draw(40)}") for i in range(2)]
    texts, frame = dict(docs), spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.unit, texts[r.doc_id][r.start : r.end].strip()) for r in paragraphs.repeated_paragraphs(frame).collect()}
    assert {f for f in found if f[0] < 10} == {(i, "passage", p) for i in range(1, 6) for p in (fifty, long)}
    assert "".join(sorted(t for d, _, t in found if d == 11)).replace(" ", "") in {(x + y).replace(" ", "") for x, y in ((long, tail), (tail, long))}
    cut = {r.doc_id: r.text for r in paragraphs.without_repeats(frame).collect()}
    for i in range(1, 6):
        assert not set(cut[i].split()) & set(f"{fifty} {long}".split())
    assert (21, "paragraph", line) in found and line.split()[-1] not in cut[21]


def test_bands_that_hold_the_same_paragraphs_are_compared_once(spark, monkeypatch):
    words = [f"v{i}" for i in range(60)]
    texts = [" ".join(words[:i] + ["z"] * (i > 0) + words[i + 1 :]) for i in (0, 30, 59)] + [" ".join(f"r{i}" for i in range(40))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = paragraphs.paragraphs(frame, 25, 12, 4)
    content = {r.doc_id: r.content for r in found.collect()}
    label = grouped(content.values(), [tuple(r) for r in paragraphs.link_edges(frame, found, 0.8, 25).collect()])
    assert len({label[content[i]] for i in range(3)}) == 1 and label[content[3]] == content[3]
    monkeypatch.setattr(paragraphs, "jaccard_edges", lambda dealt, *_: dealt)
    together, held = defaultdict(set), defaultdict(set)
    for r in paragraphs.link_edges(frame, found, 0.8, 25).collect():
        together[r.band].add(r.content)
    for r in found.collect():
        for band in r.bands:
            held[band].add(r.content)
    compared = sorted(tuple(sorted(c)) for c in together.values())
    assert compared == sorted({tuple(sorted(c)) for c in held.values() if len(c) > 1})
    assert len(compared) < sum(len(c) > 1 for c in held.values())


def test_paragraphs_near_copies_and_hot_groups(spark):
    rng = np.random.default_rng(8)
    words = [f"v{i}" for i in range(60)]
    docs = [(i, "\n".join([f"head {i}", " ".join(words[:i % 7] + ["z"] * (i % 3) + words[i % 7 + 1 :])])) for i in range(120)]
    docs += [(500 + i, " ".join(rng.choice([f"r{k}" for k in range(999)], 40))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = paragraphs.paragraphs(frame, 25, 12, 4)
    edges = paragraphs.link_edges(frame, found, 0.8, 25, cell_rows=4)
    label = grouped({r.content for r in found.collect()}, [tuple(r) for r in edges.collect()])
    got = defaultdict(set)
    for r in found.where("n_lines = 1").collect():
        got[label[r.content]].add(r.doc_id)
    assert sorted(len(g) for g in got.values() if len(g) > 1) == [120]
    gone = sorted((r.doc_id, r.place, r.kept_doc_id, r.kept_place) for r in paragraphs.repeated_paragraphs(frame).where("unit = 'paragraph'").collect())
    assert gone == sorted(plain_repeats(docs))


def test_blocks_of_wrapped_lines(spark):
    rng = np.random.default_rng(9)
    draw = lambda n: [f"t{x}" for x in rng.integers(0, 10**9, n)]
    wrap = lambda words: "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12))
    body, short = draw(60), draw(24)
    changed = [*body[:30], "other", *body[31:]]
    docs = [(1, wrap(body)), (2, f"{wrap(draw(40))}\n\n{wrap(changed)}\n\n{wrap(draw(30))}"), (3, " ".join(body))]
    docs += [(4, " ".join(short)), (5, f"{' '.join(draw(30))}\n \t\n{' '.join(short)}"), (6, "a b c d"), (7, "a b c d")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = paragraphs.repeated_paragraphs(frame).where("unit = 'paragraph'").collect()
    texts = dict(docs)
    assert {(r.doc_id, r.kept_doc_id, texts[r.doc_id][r.start : r.end]) for r in found} == {
        (2, 1, wrap(changed)), (3, 1, " ".join(body)), (5, 4, " ".join(short)),
    }
    assert sorted((r.doc_id, r.place, r.kept_doc_id, r.kept_place) for r in found) == sorted(plain_repeats(docs))


def test_paragraphs_hard_cases(spark, hard, nothing):
    options = {"min_words": 5}
    found = paragraphs.repeated_paragraphs(hard, **options).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in found} == {(2, 1)}
    cut = paragraphs.without_repeats(hard, **options)
    assert cut.columns == hard.columns and cut.count() == hard.count()
    texts = Counter((r.doc_id, r.text) for r in cut.collect())
    assert texts[2, ""] + texts[2, " "] == 2 and texts[2, "Another text under the same id."] == 1
    assert paragraphs.repeated_paragraphs(nothing).count() == 0
    assert paragraphs.without_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        paragraphs.bands_for(0.1, 4, 0.999)


def edited(text, following):
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def test_imatch_query(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect(), reverse=True)
    found = {r.doc_id: r for r in entry.queries()["op10_imatch"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    by_text = defaultdict(set)
    for i, (doc_id, text) in enumerate(docs):
        text, r = text or "", found[doc_id]
        new = edited(text, docs[(i + 1) % len(docs)][1] or "")
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        by_text[text].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by_text.values())
    assert np.mean([r.near_edited for r in found.values()]) > 0.25
    assert np.mean([r.near_next for r in found.values()]) < 0.05


def test_imatch_hard_cases(spark, hard, nothing):
    found = imatch.fingerprint_with_edits(hard).collect()
    assert len(found) == hard.count()
    assert all(r.near_edited is not None and r.near_next is not None for r in found)
    one = spark.createDataFrame([(5, "only one text here")], "doc_id long, text string")
    (r,) = imatch.fingerprint_with_edits(one).collect()
    text = "only one text here"
    assert r.edited_sha256 == hashlib.sha256(edited(text, text).encode()).hexdigest() and r.near_next == 1.0
    assert imatch.fingerprint_with_edits(nothing).count() == 0
    plan = imatch.fingerprint_with_edits(one)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_places_in_joined_texts_equal_a_search():
    texts = ["", "A bb\n\n ccc", " ", "dÉ e", "\n", "x" * 5] * 40
    code, start, end, _, sizes = paragraphs._word_hashes(texts)
    joined = "\n".join(texts) + "\n"
    assert [joined[a:b] for a, b in zip(start, end, strict=True)] == joined.split()
    for bounds in (np.cumsum(sizes), np.flatnonzero(code == 10)):
        assert paragraphs._numbered(bounds, start).tolist() == np.searchsorted(bounds, start, "right").tolist()
    none = paragraphs._word_hashes([""])
    assert len(none[1]) == 0 and len(paragraphs._numbered(np.cumsum(none[4]), none[1])) == 0


def test_rows_of_a_pass_or_an_explode_are_not_broadcast(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    reps = written(spark.range(50).selectExpr("id * 7919 as fp", "id as fp2", "id as rep"))
    spread = reps.mapInArrow(simhash._sampled_keys(4, 3), "tab int, key long, fp long, fp2 long, rep long")
    dealt = cells(spread, ["tab", "key"], "rep", 4)
    assert "SortMergeJoin" in plan(dealt) and "BroadcastHashJoin" not in plan(dealt)
    text = "a question of many plain words that asks how far the small red train goes"
    docs = spark.createDataFrame([(i, f"{text} {i}") for i in range(9)], "doc_id long, text string")
    leaks = decontaminate.find_leaks(docs, spark.createDataFrame([(1, text)], "item_id long, text string"))
    assert re.search(r"SortMergeJoin \[doc_id#\w+, item_id#\w+, best#", plan(leaks)) and leaks.count() == 9
