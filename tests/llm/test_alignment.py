"""Alignment of tokenizers against the libraries and brute force, and its defined cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from care_lake.llm import alignment, queries
from care_lake.llm.pieces import read_model
from care_lake.llm.units import read_tokenizer

ODD = [None, "", " ", "   ", "\n", "\n\n a\n", "plain words, and more", "don't  rock'n'roll ''s", "x  y 　z w\u0085v", "a ▁ b", "▁", "é è ﬁ 漢字 🙂🙂 ​",
       "<|endoftext|> and <s>x</s> <0x41>", "tab\tand\r\nfeeds\x0b\x0c", "1234567890 12,5%", "ends with blanks  ", "  begins so", "ɐɑ ǅ ª", "x" * 5000, "a b " * 40_000]


@pytest.fixture(scope="module")
def names():
    return read_tokenizer(queries.BYTE_TOKENIZER), read_model(queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def libraries(names):
    a = tokenizers.Tokenizer.from_str(names[0])
    a.encode_special_tokens = True
    shown = {}
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for k, x in enumerate(x for x in range(256) if x not in visible):
        shown[chr(256 + k)] = x
    shown |= {chr(x): x for x in visible}
    b = sentencepiece.SentencePieceProcessor(model_proto=names[1])

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        """Ids and bytes of both sides; none if one does not give the text back."""
        if not text:
            return [], [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a, raw_b = [bytes(shown[c] for c in a.id_to_token(i)) for i in ids_a], [piece(i) for i in ids_b]
        whole = (" " + text).encode()
        return (ids_a, raw_a, ids_b, raw_b) if b"".join(raw_a) == whole == b"".join(raw_b) else ([], [], [], [])

    return encode


def brute_groups(raw_a, raw_b):
    ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
    common = sorted(set(ends_a) & set(ends_b))
    place_a, place_b = ({e: k + 1 for k, e in enumerate(ends)} for ends in (ends_a, ends_b))
    return [place_a[c] for c in common], [place_b[c] for c in common], ends_a, ends_b


def brute(rows, encode):
    out, links, held = [], {}, defaultdict(set)
    for n, (i, text) in enumerate(rows):
        ids_a, raw_a, ids_b, raw_b = encode(text)
        ga, gb, ends_a, ends_b = brute_groups(raw_a, raw_b) if ids_a else ([], [], [], [])
        starts_a, starts_b = [0, *ends_a][:-1], [0, *ends_b][:-1]
        links[n], first = [], 0
        for k, a in enumerate(ids_a):
            while first < len(ids_b) and ends_b[first] <= starts_a[k]:
                first += 1
            j = first
            while j < len(ids_b) and starts_b[j] < ends_a[k]:
                links[n].append((a, ids_b[j]))
                j += 1
        for pair in links[n]:
            held[pair].add(n)
        groups = ";".join(",".join(map(str, ids_a[p:q])) + "|" + ",".join(map(str, ids_b[r:s])) for p, q, r, s in zip([0, *ga], ga, [0, *gb], gb))
        out.append([i, len(ids_a), len(ids_b), len(ga), len(links[n]), hashlib.sha256(groups.encode()).hexdigest() if ids_a else ""])
    most = Counter()
    for (a, _), docs in held.items():
        most[a] = max(most[a], len(docs))
    return sorted(((*r[:5], sum(len(held[p]) == most[p[0]] for p in links[n]), sum(len(held[p]) for p in links[n]), r[5]) for n, r in enumerate(out)), key=str)


def found(df):
    assert df.dtypes == [("doc_id", "bigint"), ("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"), ("n_links", "bigint"),
                         ("n_best", "bigint"), ("count_sum", "bigint"), ("groups_sha256", "string")]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_runs_on_the_diagonal():
    rng = random.Random(3)
    for _ in range(300):
        last = rng.randrange(2, 400)
        a, b = (sorted({last, *rng.sample(range(1, last), rng.randrange(last))}) for _ in range(2))
        if rng.random() < 0.5:
            b = sorted({*a[:-1]} - {*rng.sample(a, len(a) // 9)} | {last})
        common = sorted(set(a) & set(b))
        want = [a.index(c) + 1 for c in common], [b.index(c) + 1 for c in common]
        for window in (1, 3, 1000):
            ga, gb = alignment.group_ends(np.array(a), np.array(b), window)
            assert (ga.tolist(), gb.tolist()) == want
    assert alignment.diagonal_groups(list(range(1, 1001)), list(range(1, 1001))) == [(1, 1, 1000)]
    assert alignment.diagonal_groups([1, 2, 5, 6, 7], [1, 3, 4, 5, 6, 7]) == [(1, 1, 1), (3, 4, 1), (4, 5, 2)]


def test_groups_of_odd_texts(spark, names, libraries):
    rows = [(i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in alignment.align(docs, *names).collect():
        ids_a, raw_a, ids_b, raw_b = libraries(ODD[r.doc_id])
        ga, gb = brute_groups(raw_a, raw_b)[:2] if ids_a else ([], [])
        assert (r.a_ids, r.b_ids, np.cumsum(r.group_a).tolist(), np.cumsum(r.group_b).tolist()) == (ids_a, ids_b, ga, gb)


def test_statistics_of_documents(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found(queries.op13_alignment(spark, "/root/testdata/sf0.001")) == brute(rows, libraries)


def test_statistics_of_odd_rows(spark, names, libraries, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (None, "null id"), (6, ODD[6]), (6, ODD[6])]
    extra = "doc_id long, text string, pair int, block string, n_a int, n int, value int"
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], extra).repartition(4)
    assert found(alignment.alignment_statistics(docs, *names)) == brute(rows, libraries)
    assert found(alignment.alignment_statistics(docs.where("doc_id = -1"), *names)) == []
    assert found(alignment.alignment_statistics(docs.where("text is null or text = ''"), *names)) == brute([r for r in rows if not r[1]], libraries)


def test_counts_over_many_files(spark, names, libraries):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "béta", "gamma,", "delta!!", f"n{i}"]) for _ in range(30))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(alignment.alignment_statistics(docs, *names)) == brute(rows, libraries)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
