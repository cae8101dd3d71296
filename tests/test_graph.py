import itertools
import random

from conftest import rows
from tessera.operators import graph
from tessera.sources.text import parse_edges

# The toy edge list of the triangle job's fixture (FIXTURES.md F3),
# duplicates and a self-edge included; it has 2 triangles.
TOY = [("1", "2"), ("2", "1"), ("2", "3"), ("3", "2"), ("1", "3"), ("3", "1"), ("1", "4"),
       ("4", "1"), ("4", "3"), ("3", "4"), ("3", "5"), ("5", "3"), ("1", "3"), ("3", "1"),
       ("1", "1"), ("3", "5"), ("5", "3"), ("1", "3"), ("3", "1"), ("1", "4"), ("4", "1"),
       ("4", "3")]


def edges(spark, pairs, schema="src string, dst string", parts=2):
    return spark.createDataFrame(pairs, schema).repartition(parts)


def count(spark, pairs, schema="src string, dst string"):
    return graph.triangle_count(edges(spark, pairs, schema)).collect()[0]["triangles"]


def brute_triangles(pairs):
    adj = {}
    for a, b in pairs:
        if a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    return {tuple(sorted(t)) for t in itertools.combinations(sorted(adj), 3)
            if t[1] in adj[t[0]] and t[2] in adj[t[0]] and t[2] in adj[t[1]]}


def test_toy_graph_has_two_triangles(spark):
    assert count(spark, TOY) == 2


def test_stage_goldens(spark):
    sym = graph.symmetric_edges(edges(spark, [("1", "2"), ("3", "1"), ("1", "2"), ("3", "2")]))
    assert rows(sym) == sorted([("2", "1"), ("1", "2"), ("1", "3"), ("3", "1"), ("3", "2"), ("2", "3")])
    assert rows(graph.drop_self_edges(edges(spark, [("1", "2"), ("1", "1")]))) == [("1", "2")]
    e = edges(spark, [("1", "2"), ("1", "3"), ("3", "1"), ("4", "2"), ("4", "1")])
    paths = spark.createDataFrame([("2", "1", "3"), ("2", "3", "1"), ("5", "1", "4"), ("6", "4", "2")],
                                  "middle string, start string, end string")
    got = rows(graph.closing_edges(e, paths), "start", "end", "middle")
    assert got == [("1", "3", "2"), ("3", "1", "2"), ("4", "2", "6")]


def test_triangle_paths_six_per_triangle(spark):
    got = rows(graph.triangle_paths(edges(spark, TOY)), "start", "end", "middle")
    exp = sorted((s, e, m) for t in brute_triangles(TOY) for (s, e, m) in itertools.permutations(t))
    assert got == exp and len(got) == 12


def test_random_graph_matches_brute_force(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(300)]
    pairs += [(0, k) for k in range(1, 40)]  # a hub
    tri = brute_triangles(pairs)
    got = rows(graph.triangles(edges(spark, pairs, "src long, dst long", 4)), "a", "b", "c")
    assert sorted(tuple(sorted(t)) for t in got) == sorted(tri)


def test_count_invariant_under_relabel_duplicates_self_edges(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(30), rng.randrange(30)) for _ in range(200)]
    base = count(spark, pairs, "src long, dst long")
    relabel = {v: (v * 17 + 5) % 101 for v in range(30)}
    assert count(spark, [(relabel[a], relabel[b]) for a, b in pairs], "src long, dst long") == base
    noisy = pairs + pairs[:50] + [(b, a) for a, b in pairs[:50]] + [(v, v) for v in range(30)]
    assert count(spark, noisy, "src long, dst long") == base == len(brute_triangles(pairs))


def test_two_paths_bounded_by_orientation(spark):
    # A star: the hub is last in (degree, id) order, so it has no
    # out-neighbours and pairs nothing; no two-path is produced at all.
    star = [(0, k) for k in range(1, 200)]
    o = graph.oriented_edges(edges(spark, star, "src long, dst long"))
    assert graph.two_paths(o).count() == 0
    assert rows(o.groupBy("src").count(), "count") == [(1,)] * 199


def test_parse_edges(spark):
    lines = spark.createDataFrame([("1 2",), ("3 4 5",), ("6",), ("7\t8",)], "value string")
    assert rows(parse_edges(lines)) == [("1", "2"), ("3", "4")]


def test_oriented_two_paths_and_closed_paths_match_definitions(spark):
    rng = random.Random(21)
    pairs = [(rng.randrange(30), rng.randrange(30)) for _ in range(160)] + [(0, k) for k in range(1, 30)]
    adj = {}
    for a, b in pairs:
        if a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    rank = {v: (len(n), v) for v, n in adj.items()}
    out = {v: {w for w in n if rank[v] < rank[w]} for v, n in adj.items()}
    exp_paths = sorted((m, s, e) for m, ns in out.items() for s in ns for e in ns if rank[s] < rank[e])
    df = edges(spark, pairs, "src long, dst long", 4)
    got_paths = rows(graph.two_paths(graph.oriented_edges(df)), "middle", "start", "end")
    assert got_paths == exp_paths
    # The reference's listing: every two-path of the symmetric graph that an edge closes.
    exp_closed = sorted((s, e, m) for m, ns in adj.items() for s in ns for e in ns
                        if s != e and e in adj[s])
    assert rows(graph.triangle_paths(df), "start", "end", "middle") == exp_closed


def test_bitmap_keeps_every_closed_path_and_drops_most_open_ones(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(2500)] + [(0, k) for k in range(1, 300)]
    o = graph.oriented_edges(edges(spark, pairs, "src long, dst long", 4))
    all_paths = set(rows(graph.two_paths(o), "middle", "start", "end"))
    joined = set(rows(o, "src", "dst"))
    closed = {p for p in all_paths if p[1:] in joined}
    assert closed and len(closed) == len(brute_triangles(pairs))
    for word_bits in (1, 6, 20):  # nearly every bit set; about half; few
        kept = rows(graph.closable_paths(graph.two_paths(o), o, word_bits), "middle", "start", "end")
        assert len(kept) == len(set(kept)) and closed <= set(kept) <= all_paths
    assert len(kept) - len(closed) < len(all_paths) / 100
    for word_bits in (1, 20):
        got = rows(graph.triangles(edges(spark, pairs, "src long, dst long", 4), word_bits=word_bits), "a", "b", "c")
        assert got == sorted(closed)


def test_bitmap_with_text_ids_and_empty_graphs(spark):
    for pairs, exp in ((TOY, 2), ([], 0), ([("1", "1")], 0), ([("1", None), ("1", "2")], 0)):
        df = edges(spark, pairs, "src string, dst string", 2)
        assert graph.triangle_count(df).collect()[0]["triangles"] == exp
        assert graph.triangle_paths(df).count() == 6 * exp
