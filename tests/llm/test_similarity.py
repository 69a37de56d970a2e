"""The Jaccard join and the repeated-string removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from barworks.llm import jaccard_join as J
from barworks.llm import suffix_dedup as S
from barworks.llm._util import components, documents

from helpers import EDGES, SF, brute_components, frame


def near_copies(seed, groups=6, copies=14):
    random.seed(seed)
    rows = []
    for g in range(groups):
        base = [f"w{random.randint(0, 400)}" for _ in range(random.choice([3, 5, 9, 12, 16, 40, 120]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(random.randint(0, 2)):
                w[random.randrange(len(w))] = f"w{random.randint(0, 400)}"
            if random.random() < 0.4:
                w += [f"w{random.randint(0, 400)}" for _ in range(random.randint(1, 3))]
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rows = near_copies(seed)
    got = J.similar_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_components_of_edges(spark):
    rows = EDGES + [(11, "x"), (12, "x"), (13, "x y z"), (14, "X y Z"), (15, "x y z w")]
    got = J.similar_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_components(rows), key=str)


def test_components_of_the_table(spark):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    got = J.similar_components(documents(spark, SF)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_linked_sets_share_keys():
    """Whatever the boundary, linked sets share a subset key or enough list keys."""
    random.seed(3)
    freq = np.random.default_rng(1).integers(1, 50, 1 << J.TABLE_BITS)
    for _ in range(400):
        light = random.randint(0, 14)
        universe = [random.getrandbits(64) for _ in range(60)]
        a = random.sample(universe, random.randint(1, 45))
        b = [x for x in a if random.random() < 0.96] + random.sample(universe, random.randint(0, 2))
        a, b = (np.unique(np.array(x or [1], np.uint64)) for x in (a, b))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        (ka, ta, _), (kb, tb, _) = (J.keys_of(x, freq, light, 85) for x in (a, b))
        if set(ka[ta < 0].tolist()) & set(kb[tb < 0].tolist()):
            continue
        n, m = len(a), len(b)
        early = [set(k[(t >= 0) & (t <= size - J.need(size))].tolist()) for k, t, size in ((ka, ta, n), (kb, tb, m))]
        assert len(early[0] & early[1]) >= max(1, J.overlap(n, m) - max(J.need(n), J.need(m)) + 1)
        # neither is dropped for having too few keys that another set holds
        assert len(set(ka[ta >= 0].tolist()) & set(kb[tb >= 0].tolist())) >= min(J.LISTS, J.need(n), J.need(m))


def linked_pairs(seed, times=300):
    """Linked sets of random sizes, with their keys and places."""
    random.seed(seed)
    freq = np.random.default_rng(seed).integers(1, 50, 1 << J.TABLE_BITS)
    for _ in range(times):
        universe = [random.getrandbits(64) for _ in range(400)]
        a = random.sample(universe, random.randint(30, 360))
        b = [x for x in a if random.random() < 0.95] + random.sample(universe, random.randint(0, 9))
        a, b = (np.unique(np.array(x, np.uint64)) for x in (a, b))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            yield (a, *J.keys_of(a, freq, 0, 85)[:2]), (b, *J.keys_of(b, freq, 0, 85)[:2])


def test_keys_that_tell_a_set_may_be_linked_grow_with_its_size():
    """A set is kept for sharing a share of its size in list keys, and a linked one shares that many."""
    needed = [int(J.least_lists(J.need(n))) for n in range(1, 2000)]
    assert needed == sorted(needed) and needed[-1] >= 160 and needed[0] == 1
    pairs = list(linked_pairs(4))
    assert len(pairs) > 100
    for (a, ka, _), (b, kb, _) in pairs:
        assert len(np.intersect1d(ka, kb)) >= max(J.least_lists(J.need(len(x))) for x in (a, b))


def test_first_shared_key_of_linked_sets(spark):
    rows = []
    for (a, ka, ta), (b, kb, tb) in linked_pairs(6):
        k = min(np.intersect1d(ka, kb), key=lambda x: ta[ka == x][0])
        rows.append((len(a), int(ta[ka == k][0]), len(b), int(tb[kb == k][0]), True))
    rows += [(100, 9, 100, 3, False), (100, 8, 100, 8, True), (100, 0, 85, 1, False), (100, 15, 85, 0, True)]
    df = spark.createDataFrame(rows, "n_a int, at_a int, n_b int, at_b int, want boolean")
    assert df.where(J.can_be_first() != df["want"]).count() == 0


def test_boundary_follows_cost():
    assert J.boundary({}) == J.MOST_LIGHT
    assert J.boundary({5: 1000}) >= 5
    assert 6 <= J.boundary({n: 10 for n in range(1, 25)}) < J.MOST_LIGHT


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_chain_of_links_in_many_partitions(spark, monkeypatch):
    monkeypatch.setattr("barworks.llm._util.EDGES", 10)
    test_chain_of_links(spark)


def test_components_of_few_edges_take_few_tasks(spark):
    """Rounds over a few edges ran in all shuffle partitions, thousands of tasks in all."""
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    sc, group = spark.sparkContext, "few-edges"
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (102, 101)], "a long, b long").coalesce(2)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        sc.setJobGroup(group, group)
        got = {r["node"]: r["component"] for r in components(edges).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 for i in range(61)} | {101: 101, 102: 101}
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i)
    assert 0 < tasks < 500, tasks


def brute_removed(rows, span=S.SPAN):
    seen = Counter()
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        seen.update(b[i:i + span] for i in range(len(b) - span + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i:i + span]] > 1:
                gone[i:i + span] = b"\1" * span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for x in bytes(gone).split(b"\0") if x)
        out.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts(seed):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdé") for _ in range(random.randint(1, 9)))
    passage = [" ".join(word() for _ in range(n)) for n in (70, 90, 130, 300)]
    rows = [(100 + i, " ".join([word()] * random.randint(0, 3) + [random.choice(passage)] + [word() for _ in range(random.randint(0, 80))]
                               + [random.choice(passage)[random.randint(0, 60):]])) for i in range(25)]
    return rows + [(200, "x" * 900), (201, "ab" * 300), (202, "y" * 399), (203, "y" * 400)]


@pytest.mark.parametrize("hot", [S.HOT, 2])
def test_removed_bytes(spark, hot):
    """Both ways give the brute-force bytes: sorted buckets, and counted windows for hot ones."""
    rows = EDGES + repeated_texts(5)
    got = S.repeated_removed(frame(spark, rows), hot=hot).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_removed(rows), key=str)


def test_removed_bytes_of_the_table_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 60_000)
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    got = S.repeated_removed(documents(spark, SF), text_column="kept").collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute_removed(rows))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_texts_are_cut_into_pieces_once(spark, monkeypatch, tmp_path):
    """The later steps take the pieces that the first one found."""
    once, log = S.Pieces, str(tmp_path / "made")

    def counted(data, lens):
        with open(log, "a") as f:
            f.write("x")
        return once(data, lens)

    monkeypatch.setattr(S, "Pieces", counted)
    rows = repeated_texts(7)
    got = S.repeated_removed(frame(spark, rows).coalesce(1), hot=2).collect()
    assert sorted(map(tuple, got)) == sorted(brute_removed(rows))
    assert open(log).read() == "x"


def test_windows_of_hot_cores_are_spread_by_their_number(spark, monkeypatch):
    counted = []
    once = S.global_counts

    def spy(blocks, entries):
        counted.append((entries, sum(len(S.unpack(r["keys"], np.uint64)) for r in blocks.select("keys").collect())))
        return once(blocks, entries)

    monkeypatch.setattr(S, "global_counts", spy)
    S.repeated_removed(frame(spark, repeated_texts(3)), hot=2)
    assert len(counted) == 2 and counted[1][1] > 0
    assert all(entries == held for entries, held in counted)


def test_difference_cover():
    m = S.COVER_MOD
    off = S._offsets()
    assert {(a - b) % m for a in S.COVER for b in S.COVER} == set(range(m))
    assert all((x + off[i, j]) % m in S.COVER for i in range(m) for j in range(m) for x in (i, j))


@pytest.mark.parametrize("seed", range(6))
def test_suffix_buckets(seed):
    random.seed(seed)
    base = [bytes(random.choice(b"ab") for _ in range(600)) for _ in range(3)] + [b"a" * 700, bytes(500)]
    pieces = []
    for _ in range(random.randint(1, 25)):
        b = random.choice(base)
        i = random.randint(0, 150)
        x = bytearray(b[i:i + random.randint(400, 520)])
        if random.random() < 0.5:
            x[random.randrange(len(x))] = ord("c")
        pieces.append(bytes(x))
    seen = Counter(p[i:i + 400] for p in pieces for i in range(len(p) - 399))
    want = [[seen[p[i:i + 400]] > 1 for i in range(len(p) - 399)] for p in pieces]
    assert [list(map(bool, g)) for g in S.repeated_suffixes(pieces)] == want


@pytest.mark.parametrize("run", [J.similar_components, S.repeated_removed])
def test_empty_table(spark, run):
    assert run(frame(spark, [])).collect() == []


def test_keys_that_agree_in_their_upper_bits(spark, monkeypatch):
    """Shingles whose upper 32 bits are all the same: no link is lost."""
    whole = J.shingle_sets
    monkeypatch.setattr(J, "shingle_sets", lambda *a: [np.unique(s & np.uint64(0xFFFFFFFF)) for s in whole(*a)])
    rows = near_copies(5, groups=8, copies=10)
    got = J.similar_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))
