import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from colloquy.operators import tree

SCHEMA = "thread_id string, post_id string, seq long, comment_id string, parent_id string, author string, body string, depth int"


def model(rows, limit):
    """Walks up from every comment until the parent is blank, the post, missing or met before."""
    by = {(r[0], r[3]): r for r in rows}
    out = {}
    for thread, post, _, node, parent, _, _, depth in rows:
        up, at = [], parent
        while at and at != post and at not in up and (thread, at) in by:
            up.insert(0, at)
            at = by[thread, at][4]
        told = [f"{by[thread, a][5]}: {by[thread, a][6]}" for a in (up[-limit:] if limit else [])]
        declared = 0 if parent == post else depth
        body = by[thread, parent][6] if (thread, parent) in by else ""
        out[thread, node] = (len(up) or declared, up[0] if up else node, ">".join(up), body, "\n".join(told))
    return out


def forest(seed, n):
    rnd, rows = random.Random(seed), []
    for k in range(n):
        thread = f"t{rnd.randint(0, max(1, n // 8))}"
        parent = rnd.choice([f"c{rnd.randint(0, n)}", f"c{k}", "", "p" + thread, f"c{max(0, k - 1)}"])
        rows.append((thread, "p" + thread, k, f"c{k}", parent, f"a{k % 3}", f"body {k}", rnd.randint(0, 4)))
    return rows


def enriched(spark, rows, limit):
    got = tree.enrich_context(spark.createDataFrame(rows, SCHEMA), limit).collect()
    return {(r.thread_id, r.comment_id): (r.depth, r.root_comment_id, r.ancestor_ids, r.parent_body, r.context_text) for r in got}


def test_random_forests_with_orphans_loops_and_cycles(spark):
    rows = [r for s in range(6) for r in [(f"{s}{x[0]}", *x[1:]) for x in forest(s, 40)]]
    for limit in (0, 2, 8):
        assert enriched(spark, rows, limit) == model(rows, limit)


def test_two_cycle_and_self_loop(spark):
    rows = [("t", "p", 0, "a", "b", "x", "A", 3), ("t", "p", 1, "b", "a", "y", "B", 3), ("t", "p", 2, "s", "s", "z", "S", 0), ("t", "p", 3, "o", "gone", "z", "O", 4)]
    got = enriched(spark, rows, 8)
    assert got["t", "a"] == (2, "a", "a>b", "B", "x: A\ny: B")
    assert got["t", "s"][:3] == (1, "s", "s")
    assert got["t", "o"] == (4, "o", "", "", "")


def test_a_deep_chain(spark):
    rows = [("t", "p", k, f"c{k}", f"c{k - 1}" if k else "p", "a", str(k), 0) for k in range(300)]
    got = enriched(spark, rows, 2)
    assert got["t", "c299"] == (299, "c0", ">".join(f"c{k}" for k in range(299)), "298", "a: 297\na: 298")


def test_nothing(spark):
    assert tree.enrich_context(spark.createDataFrame([], SCHEMA)).collect() == []


def stack_model(rows):
    out, open_, now = {}, {}, None
    for thread, post, _, node, _, _, _, depth in sorted(rows, key=lambda r: (r[0], r[2])):
        if thread != now:
            now, open_ = thread, {}
        depth = max(depth, 0)
        out[thread, node] = post if depth == 0 else open_.get(depth - 1, "")
        open_ = {d: i for d, i in open_.items() if d < depth} | {depth: node}
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-1, 4)), max_size=40))
def test_depth_stack(spark, pairs):
    rows = [(f"t{t}", f"p{t}", k, f"c{k}", "", "", "", d) for k, (t, d) in enumerate(pairs)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.thread_id, r.comment_id): r.parent_id for r in tree.depth_stack_parents(df).collect()} == stack_model(rows)
    deep = [(*r[:-1], r[-1] * 40) for r in rows]
    assert {(r.thread_id, r.comment_id): r.parent_id for r in tree.depth_stack_parents(spark.createDataFrame(deep, SCHEMA)).collect()} == stack_model(deep)
