from collections import defaultdict
from fractions import Fraction

import pytest

from tessera.llm import mixing as m
from tests.llm.conftest import edge_rows, prose, sorted_rows


def brute_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), cap=2):
    """Share by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: Fraction(0) for s in names}
    left, open_ = sum(sizes.values()) * share, list(names)
    while left > 0 and open_:
        total = sum(w[s] for s in open_)
        give = {s: left * w[s] / total for s in open_}
        left = Fraction(0)
        for s in open_:
            target[s] += give[s]
            if target[s] > cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = Fraction(cap * sizes[s])
        open_ = [s for s in open_ if target[s] < cap * sizes[s]]
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 7},
                                   {"a": 0, "b": 10}, {"x": 5}, {None: 9, "é": 3, "z": 1, "Z": 1000}, {"a": 0}])
def test_targets_against_repeated_sharing(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in m.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want)
    for s in want:
        assert abs(got[s] - float(want[s])) <= 1e-6 * max(1, float(want[s]))


def corpus(spark, n=900):
    rows = [(i, prose(i, 1 + i * 7 % 90), "big" if i % 3 else f"s{i % 5}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_meet_the_targets_and_reruns_agree(spark):
    docs = corpus(spark)
    got = m.mix(docs).collect()
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        most[r["source"]] = max(most[r["source"]], r["size"])
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and len(r["positions"]) == r["copies"]
        assert all(0 <= t <= 1 for t in r["positions"])
    for s in taken:
        assert abs(taken[s] - target[s]) <= most[s]
    again = m.mix(docs.repartition(7))
    assert sorted_rows(again) == sorted((tuple(r) for r in got), key=repr)


def test_curriculum_follows_the_schedule(spark):
    docs = corpus(spark)
    rows = m.curriculum(docs).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    plan = m.mix(docs).collect()
    assert len(rows) == sum(r["copies"] for r in plan)
    # Demand by half time is the integral of the ramp: 1/2 - r/4 of the target.
    names = sorted({r["source"] for r in plan})
    for i, s in enumerate(names):
        half = sum(len([t for t in r["positions"] if t < 0.5]) * r["size"] for r in plan if r["source"] == s)
        target = next(r["target"] for r in plan if r["source"] == s)
        slope = m.SLOPES[i % len(m.SLOPES)]
        assert abs(half / target - (0.5 - slope / 4)) < 0.06


def test_edges(edge_docs, clash_docs, empty_docs):
    got = sorted_rows(m.mix(edge_docs), "doc_id", "size", "source_size", "target", "taken")
    assert len(got) == len(edge_rows())
    assert got == sorted_rows(m.mix(clash_docs), "doc_id", "size", "source_size", "target", "taken")
    assert m.mix(empty_docs).count() == 0 and m.curriculum(empty_docs).count() == 0
    copies = sum(r["copies"] for r in m.mix(edge_docs).collect())
    out = m.curriculum(clash_docs)
    assert out.count() == copies and set(out.columns) == set(clash_docs.columns)


def test_no_python(spark):
    plan = m.ordered_mix(corpus(spark, 10))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def demand(t, r):
    return (1 - r) * t + r * t * t


def test_scheduled_rows_are_the_curriculum(spark):
    """Every copy's position solves D(t) = words before it / target."""
    docs = corpus(spark)
    rows = m.scheduled(docs).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    slope = {s: m.SLOPES[i % 3] for i, s in enumerate(sorted(set(source.values())))}
    plan = {r["doc_id"]: r for r in m.mix(docs).collect()}
    assert sum(r["copy"] is None or r["copy"] == 0 for r in rows) == len(plan)
    assert sum(r["copy"] is not None for r in rows) == sum(p["copies"] for p in plan.values())
    first = defaultdict(list)
    for r in rows:
        if r["copy"] is not None:
            words = demand(r["position"], slope[source[r["doc_id"]]]) * r["target"]
            first[source[r["doc_id"]]].append((round(words), r["copy"], r["size"], r["source_size"]))
    for copies in first.values():  # a pass is filled without gaps, and the next follows the whole source
        at = 0
        for words, copy, size, source_size in sorted(copies):
            if copy == 0:
                assert words >= at
                at = words + size
            else:
                assert words >= copy * source_size - 1
    got = sorted(r["position"] for r in m.curriculum(docs).collect())
    assert got == sorted(r["position"] for r in rows if r["position"] is not None)


def test_registered_query_runs_the_schedule_and_the_range_sort(spark, monkeypatch, tmp_path):
    from tessera.llm.queries import op7_curriculum_mix
    docs = corpus(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    written, write = {}, m.materialize

    def keep(df, name, **options):
        written[name] = (df._jdf.queryExecution().optimizedPlan().toString(), write(df, name, **options))
        return written[name][1]

    monkeypatch.setattr(m, "materialize", keep)
    out = op7_curriculum_mix(spark, str(tmp_path))
    plan, order = written["mix-order"]
    assert "RepartitionByExpression [position" in plan and "Sort [position" in plan
    assert sorted(r["position"] for r in order.filter("position IS NOT NULL").collect()) == sorted(
        t for r in m.mix(docs).collect() for t in r["positions"])
    want = [(*[r[c] for c in out.columns[:6]], min(r["positions"], default=None), max(r["positions"], default=None))
            for r in m.mix(docs).collect()]
    assert out.columns[6:] == ["first_position", "last_position"]
    assert sorted_rows(out) == sorted(want, key=repr)
