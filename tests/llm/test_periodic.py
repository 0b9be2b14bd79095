from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from parcella.llm import periodic, queries


def brute_runs(words, least=12):
    """Every maximal stretch of every period, smallest period only."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        k = q
        while k < n:
            start = k - q
            while k < n and words[k] == words[k - q]:
                k += 1
            if k - start >= max(least, 2 * q):
                part = words[start:k]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((start, k - start, q))
            k += 1
    return sorted(out, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    r = random.Random(seed)
    for _ in range(200):
        words = [r.choice("abcdefgh"[: r.choice([1, 2, 3, 8])]) for _ in range(r.randint(0, 50))]
        if words and r.random() < 0.5:
            a = r.randrange(len(words))
            p = 1 + r.randrange(max(1, (len(words) - a) // 2))
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        for least in (2, 6, 12):
            assert periodic.runs_in(words, least) == brute_runs(words, least), words


def test_runs_of_words_rich_in_squares():
    a, b = ["x"], ["x", "y"]
    while len(b) < 300:
        a, b = b, b + a
    assert periodic.runs_in(b) == brute_runs(b) and periodic.runs_in(b, 2) == brute_runs(b, 2)


def test_only_stretches_that_recur_in_themselves_are_searched():
    import numpy as np

    far = [f"w{i}" for i in range(100)]
    passage = [f"p{i}" for i in range(30)]
    hashes = np.array([hash(w) for w in passage + far + passage], np.int64).view(np.uint64)
    assert periodic.repeated_stretches(hashes) == []
    hashes = np.array([hash(w) for w in far + passage * 2 + far[::-1]], np.int64).view(np.uint64)
    assert periodic.repeated_stretches(hashes) == [(100, 160)]


def test_find_runs_takes_odd_rows(spark, docs_of):
    long = " ".join(["go on"] * 30_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 12), (4, "a " * 12), (5, "a " * 11), (6, long), (None, "É\x0bÉ " * 6)]
    got = periodic.find_runs(docs_of(rows, clash=True)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].collapsed for i in (1, 2, 3)] == [""] * 3 and by[1].runs == []
    assert [tuple(x) for x in by[4].runs] == [(0, 12, 1)] and by[4].collapsed == "a"
    assert by[5].runs == [] and by[5].collapsed == " ".join("a" * 11)
    assert [tuple(x) for x in by[6].runs] == [(0, 60_000, 2)] and by[6].collapsed == "go on"
    assert by[None].collapsed == "É"
    assert periodic.find_runs(docs_of(rows).limit(0)).count() == 0


def test_query_matches_brute_force(spark, docs_of, words, tmp_path):
    texts = [words(k, 5 * k) for k in range(60)]
    texts += ["x " + " ".join([words(k, k)] * 3) + "\n y" for k in range(1, 20)] + [None, "", "one"]
    docs_of([(i, t) for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, text in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            planted += 1
        runs = brute_runs(w)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        want = (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None)
        row = got[i]
        assert tuple(row)[:6] == want
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert planted > 3 and len(got) == len(texts)
