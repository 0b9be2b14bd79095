from __future__ import annotations

from collections import Counter

from parcella.llm import mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[n] for n in full)
        share = sum(weight[n] for n in names if n not in full)
        goal = {n: 3 * sizes[n] if n in full else left * weight[n] / share for n in names}
        over = {n for n in names if n not in full and goal[n] > 3 * sizes[n]}
        if not over:
            return goal
        full |= over


def test_targets_and_exact_budgets(docs_of, words):
    rows = [(i, words(i, 1 + i % 23), None, ["a", "B", "hot", "hot", "hot", "é", None][i % 7]) for i in range(700)]
    rows += [(900, words(1, 4), None, "small"), (901, None, None, "a"), (902, "", None, "none"), rows[5]]
    got = mixing.mix(docs_of(rows, clash=True)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes)
    source = {}
    for i, _, _, s in rows:
        source[i] = s
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        assert r.source_size == sizes[s]
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6
        assert 0 <= target[s] - taken[s] < 1 + 1e-6
    again = mixing.mix(docs_of(list(reversed(rows)))).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in again)


def test_mixed_documents(docs_of, words):
    rows = [(i, words(i, 10), None, "abc"[i % 3] if i < 90 else "big") for i in range(300)]
    docs = docs_of(rows, clash=True)
    taken = {r.doc_id: -(-r.taken // 10) for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in taken.items() if v})


def test_edges(docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    only = mixing.mix(docs_of([(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2
    long = mixing.mix(docs_of([(None, "w " * 200_000, None, "s"), (None, "w", None, "s")])).collect()
    assert sum(r.taken for r in long) == 200_001
    assert mixing.mixed_documents(docs_of([(None, "a b", None, "s")])).count() == 1
