"""Periodic runs against brute force over every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ridgeline.llm import periodic, queries


def runs(words):
    """Every maximal stretch with smallest period q and at least max(6, 4 q) words."""
    n, out = len(words), []
    code = {w: i for i, w in enumerate(set(words))}
    x = np.array([code[w] for w in words], np.int64)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = stop - start + q
            part = x[start : start + length]
            if length >= max(6, 4 * q) and not any((part[:-p] == part[p:]).all() for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def transformed(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = transformed(doc_id, text)
    found = runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, runs int, `start` string")


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row)


def words_with_runs(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        block = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        out += block * rng.randint(1, 7) + block[: rng.randint(0, len(block))]
        out += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))]
    return out


def test_all_runs_of_random_words():
    rng = random.Random(3)
    texts = [words_with_runs(rng) for _ in range(600)] + [["a"] * n for n in range(12)] + [list("ab") * 300, list("aab" * 5 + "aabaab" * 70)]
    rows, begins = periodic._group_runs([[w.encode() for w in t] for t in texts])
    ends = [*begins[1:].tolist(), int(begins[-1]) + len(texts[-1])]
    got = [[(s - b, length, q) for s, length, q in rows.tolist() if b <= s < e] for b, e in zip(begins.tolist(), ends)]
    assert got == [runs(t) for t in texts]


def test_successor():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 64, 100):
        values = rng.permutation(n)
        tree = periodic.WaveletTree(values)
        low, above = rng.integers(0, n, 300), rng.integers(-1, n, 300)
        high = np.minimum(low + rng.integers(0, n + 1, 300), n)
        want = [min((v for v in values[a:b] if v > c), default=n) for a, b, c in zip(low, high, above)]
        assert tree.successor(low, high, above).tolist() == want


@pytest.mark.parametrize("group", [1 << 18, 5])
def test_odd_rows(spark, monkeypatch, group):
    monkeypatch.setattr(periodic, "GROUP", group)
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one two three " * 2000), (5, "A b C"), (5, "A b C"), (None, "x y " * 9), (6, "é’ 日本   ½ x1 " * 5)]
    rows += [(n, " ".join(words_with_runs(rng))) for n in range(10, 120)] + [(None, None)]
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows)
    out = periodic.digest(periodic.detected(docs_of(spark, rows), periodic.looped))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=key) == sorted((expected(d, t) for d, t in rows), key=key)
    assert periodic.detected(docs_of(spark, rows).limit(0)).count() == 0


def test_general_interface(spark):
    got = periodic.detected(docs_of(spark, [(1, "so la la la la la la la ti ti ti ti ti ti so")])).first()
    assert [tuple(r) for r in got["runs"]] == [(1, 7, 1), (8, 6, 1)] and tuple(got["strongest"]) == (1, 7, 1)
    assert got["collapsed"] == "so la ti so"


def test_query(spark, data_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, data_dir).collect()), key=key)
    assert got == sorted((expected(d, t) for d, t in rows), key=key)
