"""Hard negatives, licence scan and conversation trie against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emberlog.llm import conversation_trie as ct
from emberlog.llm import hard_negatives as hn
from emberlog.llm import licenses

# ---------------------------------------------------------------- hard negatives


def plain_negatives(rows, anchors, low=30, high=90, positives=5, negatives=10, scale=256):
    """rows: (id, label, vector)."""
    known = sorted({(i, y, tuple(int(np.floor(scale * np.float64(x))) for x in v)) for i, y, v in rows})
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out, seen = [], set()
    for i, y, v in known:
        if not anchors(i) or i in seen:
            continue
        seen.add(i)
        others = [(-score(v, w), j, z == y) for j, z, w in known if j != i]
        for p, j, _ in sorted((s, j, m) for s, j, m in others if m)[:positives]:
            fit = sorted((s, n) for s, n, m in others if not m and -low * p <= -100 * s <= -high * p)
            out += [(i, j, r, n, -p, -s) for r, (s, n) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize(("spread", "focus", "bucket_rows", "pack"), [(0.1, 4, 32, 2), (1.0, 1, 1024, 16), (0.3, 3, 7, 3)])
def test_negatives_against_brute_force(spark, spread, focus, bucket_rows, pack):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(4, 8))
    rows = []
    for i in range(320):
        v = (middle[i % 4] + spread * rng.normal(size=8)) * rng.uniform(0.1, 3)
        rows.append((i, int(rng.integers(3)), [float(np.float32(x)) for x in v]))
    rows[40] = (40, 1, rows[41][2])
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    found = hn.mine(df, anchor=F.col("id") % 20 == 0, bucket_rows=bucket_rows, pack=pack, block_rows=5, focus=focus)
    want = plain_negatives(rows, lambda i: i % 20 == 0)
    assert len(want) > 200 and mined(found) == want


def test_copies_of_anchor_blocks_are_not_broadcast(spark):
    rows = [(i, i % 3, [float(i % 7), float(i % 5)]) for i in range(90)]
    index = hn.build_index(hn._quantised(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), 1.0, "embedding"), 8, 2)
    anchors = hn._quantised(spark.createDataFrame(rows[::3], "vec_id long, label int, embedding array<float>"), 1.0, "embedding")
    blocks = hn._blocks(anchors, 4)
    n_groups = index.select("grp").distinct().count()
    for same in (False, True):
        found = hn._passes(index, blocks, lambda a, _: ([[(i,)] for i in range(len(a["ids"]))], [[hn._Best(2, -np.inf, np.inf)] for _ in a["ids"]]), same, 2, "block long, place long, score long, other long")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [block#" in plan and "explode(sequence" not in plan
        # each anchor meets each group that can matter once: two of other labels or its own
        assert 0 < found.count() <= 2 * 30 * n_groups


def test_ranges_keep_every_row_and_drop_some():
    """Feasible ranges against the scores themselves."""
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(400, 6)) + 2 * np.eye(6)[rng.integers(6, size=400)] * 3).round(1)
    vectors = (vectors * 100).astype(np.int32)
    sizes = np.sqrt((vectors.astype(float) ** 2).sum(1))
    orders = np.argsort(vectors / sizes[:, None], axis=0, kind="stable").T.astype(np.uint16)
    bucket = hn._Bucket({
        "n": 400, "dim": 6, "label": 0, "ids": np.arange(400).tobytes(), "vectors": vectors.tobytes(),
        "sizes": sizes.tobytes(), "orders": np.ascontiguousarray(orders).tobytes(),
    })
    pruned = 0
    for q in vectors[:60]:
        size = np.sqrt((q.astype(float) ** 2).sum())
        scores = vectors.astype(np.int64) @ q.astype(np.int64)
        for least in np.quantile(scores, [0.0, 0.3, 0.9, 0.99, 1.0]):
            unit = (q / size)[None]
            focus = np.argsort(-np.abs(unit), axis=1)[:, :3]
            can, low, high = bucket.ranges(unit, np.array([size]), np.array([least]), focus)
            rows = set(bucket.candidates(focus[0], low[0], high[0]).tolist()) if can[0] else set()
            assert set(np.flatnonzero(scores >= least).tolist()) <= rows
            pruned += 400 - len(rows)
    assert pruned > 0.3 * 60 * 5 * 400


def test_negatives_hard_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.4]), (1, 1, [1.0, 0.4]), (2, 2, [0.6, 0.1]), (3, 2, [0.5, 0.1]),
        (3, 2, [0.4, 0.2]), (4, None, [1.0, 1.0]), (5, 1, None), (6, 1, [nan, 1.0]), (7, 2, [1.0, None]), (8, 2, [inf, 0.0]),
        (None, 1, [1.0, 1.0]), (9, 1, []), (10, 2, [0.7]), (11, 2, [0.6, 0.1]), (100, 3, [1.0, 0.0]), (200, 1, []), (-100, 2, [1e30, -1e30]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("v", F.lit("x")).withColumn("id", F.lit(1)).withColumn("size", F.lit(2))
    known = [(i, y, v) for i, y, v in rows if None not in (i, y, v) and all(x is not None and np.isfinite(x) for x in v)]
    known = [(i, y, [min(max(x, -4096.0), 4096.0) for x in v]) for i, y, v in known]
    assert mined(hn.mine(df)) == plain_negatives(known, lambda i: i % 100 == 0)
    assert hn.mine(df.limit(0)).count() == 0


def test_negatives_query_on_larger_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "label", "embedding").where("vec_id < 2000").collect()]
    ids, labels = np.array([r[0] for r in rows]), np.array([(r[1] + 1) % 10 if r[0] % 7 == 0 else r[1] for r in rows])
    m = np.floor(256 * np.array([r[2] for r in rows], np.float64)).astype(np.int64)
    want = []
    for at in np.flatnonzero(ids % 100 == 0):
        s = m @ m[at]
        order = [k for k in np.lexsort((ids, -s)) if k != at]
        for p in [k for k in order if labels[k] == labels[at]][:5]:
            fit = [k for k in order if labels[k] != labels[at] and 30 * s[p] <= 100 * s[k] <= 90 * s[p]][:10]
            want += [(int(ids[at]), int(ids[p]), r, int(ids[k]), int(s[p]), int(s[k])) for r, k in enumerate(fit, 1)]
    assert mined(entry.queries()["op11_hard_negatives"](spark, folder)) == sorted(want)


# ---------------------------------------------------------------- licences

BASE = {("under", "the", "mit", "license"): "mit", ("apache", "license", "version", "2"): "apache-2", ("cc", "by", "nc"): "cc-by-nc"}


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for i in range(len(words)) for phrase, label in BASE.items() if tuple(words[i : i + len(phrase)]) == phrase]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_licenses_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = entry.queries()["op12_licenses"](spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))
    gnu = [r for r in found if "gnu general public license, version 3" in docs[r.doc_id].lower()]
    assert gnu and all("gpl-3" in r.labels.split(",") for r in gnu)


def test_places_against_plain_search():
    rng = np.random.default_rng(1)
    pool = ["under", "the", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "Under", "é", "spdx", "identifier", "sa"]
    for _ in range(300):
        text = "".join(str(rng.choice(pool)) + str(rng.choice([" ", "-", ".\n", ": "])) for _ in range(rng.integers(0, 60)))
        n, hits = licenses.scan(text.encode())
        base = [h for h in hits if h[0] == "base"]
        words = [h[2] for h in base]
        got = (n, len(base), min(words, default=None), max(words, default=None), ",".join(sorted({h[1][0] for h in base})))
        assert got == plain_base(text)
        assert all(text[h[4] : h[5]] == h[6] for h in hits)


def plain_value(node):
    """Value and labels of an expression tree."""
    if isinstance(node, str):
        label = licenses.IDENTIFIERS[node.lower()]
        return licenses.VALUES[label], {label}
    op, left, right = node
    value, labels = plain_value(left)
    if op == "WITH":
        return min(1.0, value + licenses.EXCEPTION), labels
    other, more = plain_value(right)
    return (min if op == "AND" else max)(value, other), labels | more


def random_tree(rng, depth):
    names = ["MIT", "GPL-3.0", "Apache-2.0", "CC-BY-NC-4.0", "MPL-2.0", "LGPL-2.1"]
    if depth == 0 or rng.random() < 0.3:
        leaf = str(rng.choice(names))
        return ("WITH", leaf, "Some-exception-1.0") if rng.random() < 0.2 else leaf
    return (str(rng.choice(["AND", "OR"])), random_tree(rng, depth - 1), random_tree(rng, depth - 1))


def written_out(rng, node, above=0):
    if isinstance(node, str):
        return node
    op, left, right = node
    binds = {"OR": 1, "AND": 2, "WITH": 3}[op]
    text = f"{written_out(rng, left, binds)} {op} {written_out(rng, right, binds)}"
    return f"({text})" if binds < above or (binds < 3 and rng.random() < 0.3) else text


def test_expressions_against_trees():
    rng = np.random.default_rng(2)
    for _ in range(300):
        tree = random_tree(rng, 4)
        text = written_out(rng, tree)
        after = str(rng.choice([" ", "\nMIT OR", " and more text", " OR", " (", ".", " */", ""]))
        _, hits = licenses.scan(f"x SPDX-License-Identifier: {text}{after}".encode())
        value, labels = plain_value(tree)
        (hit,) = [h for h in hits if h[0] == "tag"]
        assert hit[7] == pytest.approx(value) and set(hit[1]) == labels and hit[6].endswith(text)


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("", "", 0.0), (None, "", 0.0), ("license: mine", "", 0.0), ("License: MIT/Apache-2.0", "apache-2,mit", 1.0),
        ("SPDX-License-Identifier: Unheard-1 AND MIT", "mit,other", 0.0), ("SPDX-License-Identifier: AND MIT", "", 0.0),
        ("SPDX-License-Identifier: ((MIT", "mit", 1.0), ('"license": "GPL-2.0-or-later",', "gpl-2", 0.5),
        ("All rights reserved. Under the MIT license", "all-rights-reserved,mit", 0.0), ("cc by-nc-sa 4.0", "cc-by-nc,cc-by-nc-sa", 0.2),
    ],
)
def test_license_labels(spark, text, labels, score):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = licenses.license_digest(licenses.scan_licenses(df)).first()
    assert (r.labels, r.score) == (labels, score)


def test_license_hard_cases(spark, hard, nothing):
    found = licenses.license_digest(licenses.scan_licenses(hard.withColumn("hits", F.lit("x")))).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_base) for r in found) == sorted((str(r.doc_id), *plain_base(r.text)[:2]) for r in hard.collect())
    assert licenses.scan_licenses(nothing).count() == 0


# ---------------------------------------------------------------- conversations


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in own.items()}
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        path = own.get(base, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, len(path)))
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
            leaves[k[:d]] += k not in kids
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c, n in m if n == len(k))))
        parent = min(members[k[:-1]])[0] if k else None
        out.append((min(m)[0], len(k), parent, len(m), kids.get(k, 0), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("x")).withColumn("one", F.lit(1))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    rebuilt = ct.rebuilt(ct.ordered_turns(df), F.col("conv_id") - F.col("conv_id") % 100, h, 5)
    return sorted((tuple(r) for r in ct.prefix_nodes(rebuilt, **options).select(NODE).collect()), key=str)


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 80):
            assert ct.two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda f: f & -f)


def test_local_trie_against_plain_prefixes():
    rng = np.random.default_rng(8)
    for _ in range(30):
        strings = {tuple(rng.integers(0, 2, rng.integers(0, 40)).tolist()) for _ in range(25)}
        strings |= {s[: int(rng.integers(0, len(s) + 1))] for s in list(strings)}
        key = lambda s: hashlib.md5(repr(s).encode()).digest()
        z, laid = ct.ZFastTrie(), {}
        every = list(strings)
        for at in range(0, len(every), 7):
            batch = {key(s): (0, [key(s[:d]) for d in range(len(s) + 1)], [d for d in range(len(s) + 1)]) for s in every[at : at + 7]}
            z.insert_batch(batch)
        for i, s in enumerate(every):
            laid[key(s)] = (1, 2, i)
        got = {r[0]: r[1:] for r in z.expanded(laid)}
        prefixes = {s[:d] for s in every for d in range(len(s) + 1)}
        assert set(got) == {key(p) for p in prefixes}
        for p in prefixes:
            below = [i for i, s in enumerate(every) if s[: len(p)] == p]
            parent = key(p[:-1]) if p else None
            assert got[key(p)] == (parent, len(p), len(p), len(below), 2 * len(below), min(below))
        # a node for each place where paths part or end
        assert len(z.nodes) <= 2 * len(every) + 1


@pytest.mark.parametrize("limit", [3, 300_000])
def test_trie_against_brute_force(spark, limit):
    rng = np.random.default_rng(4)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 205, -7, -100, 300]:
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, str(rng.choice(["user", "bot"])), str(rng.choice(["hi", "yes", "no", "so é"]))))
    assert trie(spark, rows, limit=limit) == plain_trie(rows)


def test_long_conversations_in_tiers(spark, monkeypatch):
    monkeypatch.setattr(ct, "TIER", 4)
    rows = [(c, t, "user", f"t{t % 5}") for c in (0, 1, 2, 100, 101) for t in range(3 + 5 * (c % 4))]
    rows += [(c, t, "user", "same") for c in (7, 8, 9) for t in range(12)]
    assert trie(spark, rows) == plain_trie(rows)


def test_trie_hard_cases(spark):
    long = "word " * 20_000
    rows = [
        (1, 0, None, None), (1, None, "user", "first"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, 1, "bot", "a"), (2, 0, "", ""),
        (3, 0, "user", long), (4, 0, "user", long), (None, 0, "user", "x"), (5, None, None, None), (5, None, None, None), (100, 5, "u", "x"),
        *[(200 + i, t, "user", "copy") for i in range(30) for t in range(3)],
    ]
    assert trie(spark, rows) == plain_trie(rows)
    assert trie(spark, [(None, 1, "a", "b")]) == []
