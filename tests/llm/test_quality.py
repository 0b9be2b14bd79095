from __future__ import annotations

import re
from collections import defaultdict

from parcella.llm import quality, queries


def counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    inside = {i + d for i, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside))


TEXTS = [
    None, "", " \n\t", "a b c a b c", "a a a a a a", "one two", "one\ntwo\none\n\n \n one", "x y z " * 40, "a b c d e a b c d f a b",
    "#*$ %&|<> " * 30, "É\x0bé\x1fü\xa0z " * 20, "a,b a,b a,b\na,b a,b a,b",
]


def test_counts_match_brute_force(docs_of, words):
    rows = [(i, t, None, "s") for i, t in enumerate([*TEXTS, *(words(k, 30 * k) for k in range(1, 6))])]
    got = quality.apply_rules(docs_of(rows, clash=True)).collect()
    for r in got:
        text = rows[r.doc_id][1]
        want = counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_very_long_repeated_text_ends(docs_of, words):
    text = "\n".join([words(1, 20_000)] * 2)
    row = quality.apply_rules(docs_of([(1, text, None, "s")])).first()
    assert row.n_words == 40_000 and row.n_repeat_words == 40_000 and row.base_failed


def test_hosts_are_shrunk_and_judged(docs_of, words):
    good, bad = words(3, 80), "few words"
    rows = [(i, good if i % 10 else bad, None, f"h{i % 7}") for i in range(210)]
    rows += [(1000 + i, good if i % 20 == 0 else bad, None, "farm") for i in range(200)]
    rows += [(2000, bad, None, None), (2001, good, None, None), (3000, bad, None, "tiny")]
    got = {r.doc_id: r for r in quality.apply_rules(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    assert not got[1000].kept and got[1000].host_failed and not got[1000].base_failed
    assert got[1].kept and got[2001].kept
    measured = quality.measure(docs_of(rows))
    rate = {r.host: r.worst_rate for r in quality.host_verdicts(measured).collect()}
    by = defaultdict(list)
    for _, t, _, h in rows:
        by[h].append(len(t.split()) < 50)
    plain = {h: sum(x) / len(x) for h, x in by.items()}
    mean = sum(plain.values()) / len(plain)
    var = sum((x - mean) ** 2 for x in plain.values()) / len(plain)
    strength = max(0.0, mean * (1 - mean) / var - 1)
    for h, x in by.items():
        assert abs(rate[h] - (sum(x) + mean * strength) / (len(x) + strength)) < 1e-9


def test_kept_documents_agree_and_keep_columns(docs_of, words):
    rows = [(i, words(i, 40 + i), None, "s") for i in range(20)] + [(3, words(3, 90), None, None)] * 2
    docs = docs_of([*rows, (None, None, None, None)], clash=True)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(10, 20), 3, 3])
    assert quality.kept_documents(docs.limit(0)).count() == 0
    assert quality.apply_rules(docs.limit(0)).count() == 0


def test_symbols_and_repeated_lines_go_and_so_does_a_junk_host(docs_of, words):
    def junk(k):
        return " ".join(w + "&&***" for w in words(k, 80).split())

    rows = [(i, words(i, 80), None, f"h{i % 4}") for i in range(200)]
    rows += [(1000 + i, junk(i), None, f"h{i % 4}") for i in range(10)]
    rows += [(2000 + i, "\n".join([words(k, 30) for k in range(2)] + ["again and again"] * 8), None, "h0") for i in range(2)]
    rows += [(3000 + i, junk(i) if i % 4 else words(i, 80), None, "farm") for i in range(100)]
    rows += [(4000, junk(1), None, "tiny"), (4001, words(5, 80), None, "tiny")]
    docs = docs_of(rows)
    want = [*range(200), 4001]
    assert sorted(r.doc_id for r in quality.kept_documents(docs).collect()) == want
    for most in (quality.BROADCAST_HOSTS, 0):  # failing hosts broadcast, or joined by host and salt
        judged = quality.apply_rules(docs, most=most).collect()
        assert len(judged) == len(rows) and sorted(r.doc_id for r in judged if r.kept) == want
        assert {r.doc_id for r in judged if r.host_failed} == set(range(3000, 3100))
        assert sorted(r.doc_id for r in quality.kept_documents(docs, most=most).collect()) == want


def test_no_text_is_shuffled(docs_of, words):
    docs = docs_of([(i, words(i, 60), None, f"h{i % 3}") for i in range(30)])
    plan = quality.kept_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_query_matches_sql_on_mixed_hosts(spark, docs_of, words, tmp_path):
    """Hosts that fail, hosts in doubt, one document, no source: query and SQL twin agree."""
    import duckdb

    def junk(k):
        return " ".join(w + "&&***" for w in words(k, 60).split())

    rows = []
    for h, share in enumerate((0, 1, 5, 50, 90, 97)):
        rows += [(len(rows), junk(i) if i < share else words(i, 60), None, f"h{h}" if h else None) for i in range(100)]
    rows += [(9001, junk(1), None, "one"), (9002, None, None, "null"), (9003, words(2, 9), None, "few")]
    path = f"{tmp_path}/documents.parquet"
    docs_of(rows).coalesce(1).write.parquet(path)
    got = sorted(map(tuple, queries.op6_quality_rules(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["op6_quality_rules"]).fetchall())
    assert sum(not r[6] and not r[7] for r in got) > sum(x for x in (1, 5, 50, 90, 97)) + 1
