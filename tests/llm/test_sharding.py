import zlib
from collections import Counter, defaultdict

from colloquy.llm import sharding as S


def check(rows, got, shards):
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_rows(awkward, awkward_rows):
    got = S.balanced_shards(awkward, shards=5).collect()
    check(awkward_rows, got, 5)
    want = sorted(((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in awkward_rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want


def test_groups_meet_and_a_hot_group_fills_whole_shards(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"g{i // 12}" if i % 3 == 1 else f"t{i}") for i in range(3000)]
    got = S.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=10, rounds=12).collect()
    check(rows, got, 10)
    text = dict(rows)
    where = defaultdict(Counter)
    for r in got:
        where[text[r.doc_id]][r.shard] += 1
    small = [c for t, c in where.items() if t.startswith("g")]
    assert sum(len(c) == 1 for c in small) > 0.9 * len(small)
    assert len(where["hot"]) <= 6  # 1000 rows, 300 a shard


def test_empty_table(empty):
    assert S.balanced_shards(empty).collect() == []


def test_quotas_never_overfill():
    want = {(0, 1): 10, (1, 0): 4, (2, 1): 7, (1, 2): 2}
    got = S.quotas(want, [0, 3, 0])
    change = Counter()
    for (i, j), n in got.items():
        assert n <= want[i, j]
        change[i] -= n
        change[j] += n
    assert all(change[s] <= room for s, room in enumerate([0, 3, 0]))


def test_a_hot_group_fills_whole_shards_with_production_settings(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 9}" if i % 3 == 1 else f"u{i}") for i in range(12000)]
    got = S.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got, S.SHARDS)
    hot = Counter(r.shard for r in got if rows[r.doc_id][1] == "hot")
    fullest = sorted(hot.values(), reverse=True)[:14]  # 4000 rows, 300 a shard
    assert sum(fullest) > 0.6 * 4000


def test_copies_meet_where_every_text_has_one_and_no_shard_has_room(spark):
    rows = [(i, f"t{i // 2}") for i in range(2400)]
    got = S.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    check(rows, got, 8)
    where = defaultdict(set)
    for r in got:
        where[rows[r.doc_id][1]].add(r.shard)
    assert sum(len(x) == 1 for x in where.values()) > 0.95 * len(where)


def test_quotas_admit_cycles_through_full_shards():
    assert S.quotas({(0, 1): 5, (1, 2): 3, (2, 0): 4, (2, 3): 9}, [0, 0, 0, 0]) == {(0, 1): 3, (1, 2): 3, (2, 0): 3}


def test_a_hot_group_among_linked_rows_only_touches_no_more_shards_than_it_needs(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 6},{i % 3}") for i in range(2400)]
    got = S.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    check(rows, got, 8)
    assert len({r.shard for r in got if rows[r.doc_id][1] == "hot"}) == 3  # 800 rows, 300 a shard


def cut(groups, shards):
    """Pairs of equal texts that lie in different shards."""
    where = defaultdict(Counter)
    for g, s in zip(groups, shards):
        where[g][s] += 1
    return sum(sum(c.values()) ** 2 - sum(n * n for n in c.values()) for c in where.values()) // 2


def plain_propagation(groups, k):
    """Label propagation row by row: a linked row changes places with one that gains by it or loses nothing, until none does."""
    n = len(groups)
    shard, count = [i % k for i in range(n)], defaultdict(Counter)
    for g, s in zip(groups, shard):
        count[g][s] += 1
    linked = {g for g, c in Counter(groups).items() if c > 1}
    rows = defaultdict(list)
    for i, s in enumerate(shard):
        rows[s].append(i)
    for _ in range(30):
        moved = False
        for i in range(n):
            g, s = groups[i], shard[i]
            if g not in linked:
                continue
            to = max(range(k), key=lambda x: (count[g][x], -x))
            if to == s or count[g][to] <= count[g][s] - 1:
                continue
            gain = count[g][to] - count[g][s] + 1
            for j in rows[to]:
                o = groups[j]
                if o != g and gain + count[o][s] - count[o][to] + 1 > 0:
                    for a, b, x, y in ((i, g, s, to), (j, o, to, s)):
                        count[b][x] -= 1
                        count[b][y] += 1
                        shard[a] = y
                        rows[x].remove(a)
                        rows[y].append(a)
                    moved = True
                    break
        if not moved:
            break
    return shard


def test_cut_edges_against_plain_propagation(spark):
    """Groups, also those of a third of a shard, meet as in row-by-row propagation."""
    import random

    for seed, sizes, left in ((1, [2, 2, 3, 5, 9], 0.01), (2, [2, 2, 3, 5, 9, 30], 0.01)):
        rnd, groups = random.Random(seed), []
        for g in range(60):
            groups += [f"g{g}"] * rnd.choice(sizes)
        groups += [f"single{i}" for i in range(150)]
        rnd.shuffle(groups)
        got = S.balanced_shards(spark.createDataFrame(list(enumerate(groups)), "doc_id long, text string"), shards=7).collect()
        ours = cut(groups, [r.shard for r in sorted(got, key=lambda r: r.doc_id)])
        start, plain = cut(groups, [i % 7 for i in range(len(groups))]), cut(groups, plain_propagation(groups, 7))
        assert ours <= plain * 1.1 + left * start
