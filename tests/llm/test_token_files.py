"""Token files against the tokenizers library, and their defined cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from care_lake.llm import queries, token_files
from care_lake.llm.units import Kept, WordIds, read_tokenizer

ODD = [None, "", "  ", "don't rock'n'roll ''s x  y 　z", "É́ İstanbul", "a<|endoftext|>B C<|x", "a1,2!b -- c...\n\nd \t e\x1c f\x85 g",
       "ǅ K Å ﬁ", "x" * 300 + " " + "y," * 300, "≮ a̸", " ,a ,b   c!d"]


@pytest.fixture(scope="module")
def tokenizer():
    return read_tokenizer(queries.WORD_TOKENIZER)


@pytest.fixture(scope="module")
def whole(tokenizer):
    library = tokenizers.Tokenizer.from_str(tokenizer)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


def expected(rows, whole):
    """Ids of documents in ascending order, nulls first, and the ids before each."""
    out, before = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], zlib.crc32((r[1] or "").encode()))):
        ids = whole(t) + [1]
        out.append((i, before, ids))
        before += len(ids)
    return out


def test_ids_match_the_library(tokenizer, whole):
    for size in (len(ODD), 3, 1):
        encode = WordIds(tokenizer, most=10)
        for at in range(0, len(ODD), size):
            texts = ODD[at:at + size]
            ids, ends = encode(pa.array(texts, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [whole(t) for t in texts]
    assert len(encode(pa.array([], pa.string()))[0]) == 0


def test_units_in_use_are_kept():
    asked = []
    kept = Kept(lambda units: [asked.append(u) or u.upper() for u in units], 2)
    for units in ([b"a", b"b"], [b"c", b"a"], [b"a", b"d", b"e"], [b"a"], [b"a", b"f" * 100]):
        assert kept(units) == [u.upper() for u in units]
    assert asked.count(b"a") == 1 and b"f" * 100 not in kept.young


def test_files_of_documents(spark, tokenizer, whole, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    manifest = token_files.write_tokens(docs.repartition(5), tokenizer, str(tmp_path / "t"), n_parts=4).collect()
    want = expected([(r.doc_id, r.text) for r in docs.collect()], whole)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids) for r in token_files.read_tokens(spark, str(tmp_path / "t")).collect()}
    assert got == {i: (s, len(ids), ids) for i, s, ids in want}
    files = token_files.TokenFiles(f"file://{tmp_path}/t", manifest)
    assert len(files) == len(want) and len(manifest) == 4
    for number in (0, 1, 17, len(want) - 1):
        assert files[number].tolist() == want[number][2]
    flat = b"".join((tmp_path / "t" / f"{r.part:06d}.ids").read_bytes() for r in sorted(manifest, key=lambda r: r.part))
    assert np.frombuffer(flat, "<u2").tolist() == [x for _, _, ids in want for x in ids]
    with pytest.raises(IndexError):
        files[len(want)]


def test_query_matches_brute_force(spark, whole):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = [(i, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, ids in expected(rows, whole)]
    got = queries.op11_token_files(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_files_of_odd_rows(spark, tokenizer, whole, tmp_path):
    rows = [(1, None), (None, "null id"), (None, None), (2, "same"), (2, "same"), (2, "other text"), (-7, "below 0"), (3, "long text " * 200_000)] + [(10 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(i, t, 1, 2, "x", 3, 4) for i, t in rows], "doc_id long, text string, tie int, n int, ids string, row int, part int").repartition(3)
    manifest = token_files.write_tokens(docs, tokenizer, str(tmp_path / "odd"))
    got = sorted(token_files.read_tokens(spark, str(tmp_path / "odd")).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.ids) for r in got] == expected(rows, whole)
    assert manifest.agg({"null_ids": "sum"}).first()[0] == 2
    empty = token_files.write_tokens(docs.where("doc_id = -1"), tokenizer, str(tmp_path / "none"))
    assert empty.count() == 0 and token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0
    assert len(token_files.TokenFiles(str(tmp_path / "none"), [])) == 0


def test_wide_vocabularies_take_32_bits(spark, tokenizer, tmp_path):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    manifest = token_files.write_tokens(docs, tokenizer, str(tmp_path / "wide"), end_id=70_000).first()
    assert manifest.width == 4 and token_files.read_tokens(spark, str(tmp_path / "wide")).first().ids[-1] == 70_000
