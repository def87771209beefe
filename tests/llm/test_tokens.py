"""Token files, packing and token counts against the tokenizer itself."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from emberlog.llm import packing, token_files, token_trees
from emberlog.llm.encoding import PieceEncoder
from emberlog.llm.work import work_folder

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = [
    "", " ", "a  b", "\n\nx\t y ", "foo\x1cbar \x1c baz", "a b  c", "<|endoftext|> x<|endoftext|>y", "don't 's  it's",
    "x\x01y \x02 \x01", "Å J̌ ́x ΣΑΣ", "a \nb\n c", "a.b. c, d. \ne, f.", "x.\ny,\nz.", "A. B. É. 3. 4,5. _. (a). b", "The END. of, ...",
    " one", " a b.", " .", " ,x", " \n", "  two", " 3.", " é ñ", " \u00a0x", " <|endoftext|>",
]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_ids_of_whole_texts(path):
    encode = plain(path)
    pieces = PieceEncoder(path, max_entries=8)
    for _ in range(2):
        ids, ends = pieces.encode(pa.array(ODD))
        for i, text in enumerate(ODD):
            assert ids[ends[i] : ends[i + 1]].tolist() == encode(text), repr(text)
        assert pieces.counts(pa.array(ODD)).tolist() == np.diff(ends).tolist()


def expected_files(docs, encode):
    start, out = 0, []
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*encode(text), 1]
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_token_files_query(spark, sf_dir, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows(entry.queries()["op1_token_files"](spark, sf_dir)) == expected_files(docs, plain(WORD))


def test_token_files_hard_cases_and_selective_reads(spark, hard, nothing, rows):
    path = work_folder(spark, "test")
    token_files.write_token_files(hard, path, WORD, end_id=1, page_rows=2)
    tokens = token_files.read_tokens(spark, path)
    want = expected_files([(r.doc_id, r.text) for r in hard.collect()], plain(WORD))
    assert sorted(rows(token_files.token_checksums(tokens)), key=lambda r: r[1]) == want
    some = token_files.read_tokens(spark, path, F.col("doc_id") == 7)
    assert [list(r.ids) for r in some.collect()] == [[*plain(WORD)("one"), 1]]
    plan = token_files.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    empty = work_folder(spark, "test")
    token_files.write_token_files(nothing, empty, WORD, end_id=1)
    assert token_files.read_tokens(spark, empty).count() == 0


def check_packing(pieces, docs, encode, limits=(1024, 128, 1024)):
    ids = defaultdict(list)
    for doc_id, text in docs:
        ids[doc_id].append([*encode(text), 0])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert sum(p.length for p in pieces) == sum(len(x) for v in ids.values() for x in v)
    for doc_id, parts in by_doc.items():
        if len(ids[doc_id]) == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p.start):
                assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids[doc_id][0]), crc(ids[doc_id][0][at : at + p.length]))
                at += p.length
            assert at == len(ids[doc_id][0])
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limits[0] and len(parts) <= limits[1] and sum(p.loss_tokens for p in parts) <= limits[2]
        padding += 0 if at & (at - 1) == 0 else limits[0] - at
    return padding


def test_packing_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    pieces = entry.queries()["op7_packing"](spark, sf_dir).collect()
    assert check_packing(pieces, docs, plain(BYTE)) < 0.01 * sum(p.length for p in pieces)


def test_packing_hard_cases_limits_and_prompts(spark, hard, nothing):
    docs = [(r.doc_id, r.text) for r in hard.collect()]
    some = packing.pack(hard.withColumn("prompt", F.lit(3)), BYTE, 0, max_tokens=64, max_segments=3, max_loss=40, prompt_column="prompt", keep_ids=True)
    pieces = some.collect()
    check_packing(pieces, docs, plain(BYTE), (64, 3, 40))
    assert all(crc(p.ids) == p.ids_crc32 for p in pieces)
    assert packing.pack(nothing, BYTE, 0).count() == 0


def spliced(text, edits):
    for start, gone, new in sorted(edits, reverse=True):
        start = min(start, len(text))
        text = text[:start] + new + text[start + gone :]
    return text


def test_token_counts_query(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    encode = plain(BYTE)
    for r in entry.queries()["op9_token_counts"](spark, sf_dir).collect():
        text = docs[r.doc_id]
        n = len(text)
        new = spliced(text, [(n // 5, 12, text[:30]), (n // 2, n // 50, ""), (n * 4 // 5, 0, "[removed]")])
        assert (r.n_tokens, r.edited_tokens, r.edited_chars) == (len(encode(text)), len(encode(new)), len(new))


def test_random_edits_keep_trees_right():
    rng = np.random.default_rng(2)
    encode, count = plain(BYTE), token_trees._counter(BYTE)
    letters = list("ab  \n.,'s1é")
    for _ in range(120):
        text = "".join(rng.choice(letters, rng.integers(0, 200)))
        leaves = token_trees.cut(text, 16)
        sizes, tree = [len(x) for x in leaves], token_trees.summed(count(leaves))
        for _ in range(3):
            start, gone, new = int(rng.integers(0, 210)), int(rng.integers(0, 40)), "".join(rng.choice(letters, rng.integers(0, 30)))
            doc = token_trees.Edited(text, sizes, tree, 16)
            doc.end(count(doc.begin(start, gone, new)))
            assert doc.text == text[:start] + new + text[start + gone :]
            text, sizes, tree = doc.text, doc.sizes, doc.tree
            assert sum(sizes) == len(text) and (tree[-1] if tree else 0) == len(encode(text))
            assert tree == token_trees.summed(tree[: len(sizes)])


def test_token_counts_hard_cases(spark, hard, nothing):
    encode = plain(BYTE)
    state = token_trees.build_trees(hard, BYTE, 64)
    edits = spark.createDataFrame(
        [(6, 100, 50, "new words"), (6, 10**9, 3, " end"), (7, None, None, None), (1, 5, 10**9, "x"), (99, 0, 1, "")],
        "doc_id long, start long, n_deleted long, inserted string",
    )
    out = token_trees.apply_edits(token_trees.gather_edits(state, edits), BYTE, 64).collect()
    assert len(out) == hard.count()
    assert all(r.n_tokens == len(encode(r.text)) for r in out)
    six = next(r for r in out if r.doc_id == 6)
    assert six.text.endswith(" end") and six.recounted_chars < len(six.text) / 20
    assert token_trees.build_trees(nothing, BYTE).count() == 0


def test_words_after_a_line_end_need_no_whole_pass(monkeypatch):
    words, encode = PieceEncoder(BYTE), plain(BYTE)
    asked = []
    monkeypatch.setattr(words, "_ask_joined", lambda texts: asked.extend(texts) or words._ask(texts))
    texts = ["one\nTwo\nthree four\n", "\nfive", "a\n\nb", "\n", "x\nété\n9"]
    ids, offsets = words.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [encode(x) for x in texts]
    assert not {"\nTwo", "\nthree"} & set(asked) and "\nété" in asked
