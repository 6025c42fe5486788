import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountweave.llm import prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", "ends_sha256"]


def brute(convs):
    """Nodes of ``{id: [(role, text), ..]}``, by walking down turn by turn and summing up from the last made node."""
    number, above, depth, size, members, ends = {}, [None], [0], [0], [[]], [[]]
    for c in sorted(convs):
        at = 0
        members[0].append(c)
        for turn in convs[c]:
            if (at, turn) not in number:
                number[at, turn] = len(above)
                above.append(at)
                depth.append(depth[at] + 1)
                size.append(len(turn[1].encode()))
                members.append([])
                ends.append([])
            at = number[at, turn]
            members[at].append(c)
        ends[at].append(c)
    children = Counter(a for a in above if a is not None)
    leaves = [int(not children[i]) for i in range(len(above))]
    saved = [(len(members[i]) - 1) * size[i] for i in range(len(above))]
    for i in range(len(above) - 1, 0, -1):
        leaves[above[i]] += leaves[i]
        saved[above[i]] += saved[i]
    digest = lambda own: hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
    parent = lambda i: None if i == 0 else members[above[i]][0]
    return Counter((members[i][0], depth[i], parent(i), len(members[i]), children[i], leaves[i], saved[i], digest(ends[i])) for i in range(len(above)))


def plain(rows):
    """Conversations of rows (id, turn, role, text) whose turns differ within a conversation."""
    convs = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    return convs


def made(r, n, words="abc", longest=7):
    """Few words, so that many conversations start alike."""
    return [(c, t, r.choice(["user", "x", None]) if t == 3 else "user", r.choice(words)) for c in range(n) for t in range(r.randint(1, longest))]


def got(frame):
    return Counter(tuple(r) for r in frame.select(*OUT).collect())


@pytest.mark.parametrize("seed", range(3))
def test_same_as_brute_force(spark, seed):
    rows = made(random.Random(seed), 60)
    random.Random(seed).shuffle(rows)
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, COLUMNS))) == brute(plain(rows))


@pytest.fixture
def parts(spark):
    """Parts stay as they are dealt, however small."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_long_and_equal_conversations(spark, parts):
    """Conversations over many parts: one that is most of the table, its copies, and one that leaves it late."""
    r = random.Random(9)
    long = [("user", r.choice("abcde") * 3) for _ in range(900)]
    convs = {7: long, 8: long, 3: long[:800], 5: long[:700] + [("user", "other")] * 20, 1: [("user", "z")], 9: long[:1], 11: [("x", "z")]}
    rows = [(c, t, *turn) for c, turns in convs.items() for t, turn in enumerate(turns)]
    r.shuffle(rows)
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, COLUMNS))) == brute(convs)


def test_one_conversation_over_all_parts(spark, parts):
    rows = [(4, t, "user", f"turn {t % 7}") for t in range(5000)]
    frame = spark.createDataFrame(rows, COLUMNS)
    paths = prefix_trie.paths(prefix_trie.turn_hashes(frame)).collect()
    assert sorted(r.depth for r in paths) == list(range(5001)) and [r.depth for r in paths if r.ends] == [5000]
    digest, at = 1, {r.depth: r for r in paths}
    for d in range(5001):
        digest = (digest * prefix_trie.POINT + int.from_bytes(at[d].x, "big")) % prefix_trie.PRIME
        assert (at[d].k1, at[d].k2) == prefix_trie._halves(digest)
        assert d == 0 or (at[d].q1, at[d].q2) == (at[d - 1].k1, at[d - 1].k2) and at[d].before == at[d - 1].before + at[d - 1].n_bytes
    assert got(prefix_trie.prefix_trie(frame)) == brute(plain(rows))


def test_many_copies(spark, parts):
    """A group of copies with most of the conversations, and a node with very many children."""
    rows = [(c, t, "user", x) for c in range(3000) for t, x in enumerate("ab" if c % 3 else ["a", f"own {c}"])]
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, COLUMNS))) == brute(plain(rows))


def test_a_full_sketch_only_shuffles_more(spark):
    """Where every estimate is above one the result is the same."""
    rows = made(random.Random(4), 40)
    paths = prefix_trie.paths(prefix_trie.turn_hashes(spark.createDataFrame(rows, COLUMNS)))
    k1, k2 = (np.array([r[c] for r in paths.collect()], np.int64) for c in ("k1", "k2"))
    small = prefix_trie.sketch(paths, 3)
    assert prefix_trie.maybe_shared(small, 3, k1, k2).all()
    field = prefix_trie.sketch(paths, 14)
    counts = Counter(zip(k1.tolist(), k2.tolist(), strict=True))
    shared = prefix_trie.maybe_shared(field, 14, k1, k2)
    assert all(s or counts[k] == 1 for s, k in zip(shared, zip(k1.tolist(), k2.tolist(), strict=True), strict=True))
    assert sum(not s for s in shared) > 0.9 * sum(n == 1 for n in counts.values())


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "", ""), (2, 1, "", None), (2, 5, None, ""), (None, 1, "a", "b"), (-3, 0, "user", "é" * 40_000), (5, 0, "user", "é" * 40_000), (6, 0, "a", "bc"), (7, 0, "ab", "c")]
    frame = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(1) for c in ("conv", "x", "place", "n_bytes", "k1", "depth", "part", "last", "inner")})
    assert got(prefix_trie.prefix_trie(frame)) == brute(plain(rows))


def test_ties_and_repeated_rows(spark):
    """Equal places: the order is the same in whatever order the rows come."""
    rows = [(c, 0, "user", x) for c in (1, 2, 3) for x in "abc"] + [(4, 0, "user", "a")] * 3
    one, other = (got(prefix_trie.prefix_trie(spark.createDataFrame(r, COLUMNS))) for r in (rows, rows[::-1]))
    assert one == other
    assert {(r[0], r[1]): r[3] for r in one}[1, 3] == 3
    assert (4, 3) in {(r[0], r[1]) for r in one}


def test_empty_table_and_single_rows(spark):
    assert not got(prefix_trie.prefix_trie(spark.createDataFrame([], COLUMNS)))
    assert not got(prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], COLUMNS)))
    one = [(8, 0, "user", "alone")]
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(one, COLUMNS))) == brute(plain(one))


@pytest.mark.parametrize("seed", range(2))
def test_rebuilt_conversations(spark, seed):
    rows = [x for x in made(random.Random(seed), 80, "ab", 12) if x[0] not in (10, 20)]
    convs, want = plain(rows), {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = convs.get(c - c % 5, [])[:h] + convs[c][h:]
    assert any(not t for t in want.values()) or seed
    turns, ids = prefix_trie.rebuilt(prefix_trie.turn_hashes(spark.createDataFrame(rows, COLUMNS)))
    assert got(prefix_trie.trie(prefix_trie.paths(turns, ids))) == brute(want)
