"""The prefix trie against brute force, and its defined cases."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

from pyspark.sql import functions as F

from care_lake.llm import prefix_trie, queries

NONE = hashlib.sha256(b"").hexdigest()


def brute(sequences):
    """Nodes of sequences of (role, text), by id."""
    members, ends = defaultdict(list), defaultdict(list)
    for i, turns in sequences.items():
        path = ()
        members[path].append(i)
        for turn in turns:
            path = (path, turn)  # a chain, so long sequences stay cheap
            members[path].append(i)
        ends[path].append(i)
    depth = {(): 0}
    for p in sorted((p for p in members if p), key=lambda p: (len(members[p]), 0)):
        chain, q = [], p
        while q not in depth:
            chain.append(q)
            q = q[0]
        for k, x in enumerate(reversed(chain)):
            depth[x] = depth[q] + k + 1
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in sorted(members, key=depth.get, reverse=True):
        if not children[p]:
            leaves[p] = 1
        if p:
            saved[p] += (len(members[p]) - 1) * len(p[1][1].encode())
            children[p[0]] += 1
            leaves[p[0]] += leaves[p]
            saved[p[0]] += saved[p]
    return sorted(
        (min(m), depth[p], min(members[p[0]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest() if p in ends else NONE)
        for p, m in members.items())


def rebuilt(rows):
    own = defaultdict(list)
    for i, turn, role, text in rows:
        if i is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[i].append((turn is not None, turn, digest, role, text))
    own = {i: [(t[3], t[4]) for t in sorted(ts, key=lambda t: (t[0], t[1] or 0, t[2]))] for i, ts in own.items()}
    out = {}
    for i, ts in own.items():
        h, base = crc32(str(i).encode()) % 9, i - (i % 5 if i >= 0 else -(-i % 5))
        out[i] = own.get(base, [])[:h] + ts[h:]
    return out


def nodes(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == columns
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def trie(spark, sequences, parts=3):
    rows = [(i, p, r, t) for i, ts in sequences.items() for p, (r, t) in enumerate(ts)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    members = spark.createDataFrame([(i,) for i in sequences], "seq long")
    return nodes(prefix_trie.prefix_trie(prefix_trie.ranked_turns(turns), members))


def test_trie_of_conversations(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert nodes(queries.op12_prefix_trie(spark, f"/root/testdata/{sf}")) == brute(rebuilt(rows))


def test_branches_at_every_depth(spark):
    rng = random.Random(4)
    sequences = {}
    for i in range(150):
        opening = sequences[rng.choice(list(sequences))] if sequences and rng.random() < 0.9 else []
        ts = opening[:rng.randrange(len(opening) + 1)] + [("u", "x" * rng.randrange(3)) for _ in range(rng.choice([0, 1, 3, 70, 140]))]
        sequences[1000 - i] = ts
    assert trie(spark, sequences) == brute(sequences)


def test_sequences_far_longer_than_a_chunk(spark):
    long = [("a", f"t{k % 7}") for k in range(4500)]
    sequences = {1: long, 2: long[:4200] + [("a", "other")], 3: long[:64], 4: long[:65] + [("b", "x")] * 200, 5: [], 6: long[:63], 7: long}
    assert trie(spark, sequences) == brute(sequences)


def test_a_beginning_of_a_third_of_all_conversations(spark):
    sequences = {i: [("u", "hot")] + [("a", f"{i % 50}")] * (i % 3) if i % 3 == 0 else [("u", f"own {i}")] for i in range(900)}
    assert trie(spark, sequences, parts=7) == brute(sequences)


def test_ends_of_many_members_are_hashed_in_order(spark):
    sequences = {i * 1_000_003: [("u", "same")] for i in range(9000)}  # several segments
    got = trie(spark, sequences, parts=5)
    assert got == brute(sequences) and got[0][3] == 9000


def test_conversations_of_odd_rows(spark):
    rows = [(None, 0, "user", "nobody"), (1, None, None, None), (1, 0, "user", None), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (0, 1, None, "x"), (0, None, "user", "é"),
            (-7, 0, "user", "below"), (-5, 0, "user", "base"), (-5, 3, "a", "base"), (8, 0, "user", "base absent"), (12, 2, "user", "long " * 100_000), (5, 0, "", ""), (6, 0, "", "")]
    extra = "conv_id long, turn long, role string, text string, seq int, pos int, part int, depth int, name string, weight int"
    odd = spark.createDataFrame([(*r, 1, 2, 3, 4, "n", 5) for r in rows], extra).repartition(3)
    for df, kept in ((odd, rows), (odd.where("conv_id > 99"), [])):
        turns = prefix_trie.ranked_turns(df)
        opened = prefix_trie.with_shared_openings(turns, F.expr("seq - seq % 5"), F.crc32(F.col("seq").cast("string").cast("binary")) % 9, 8)
        assert nodes(prefix_trie.prefix_trie(*opened)) == brute(rebuilt(kept))
