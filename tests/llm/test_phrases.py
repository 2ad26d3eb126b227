"""Collocations against counters in memory."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ridgeline.llm import hattrie, phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, top=2000, least=10, share=50):
    grams = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                grams["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        often = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        longer = Counter()
        for g, c in often.items():
            if len(g) == 3:
                for part in (g[:2], g[1:]):
                    longer[part] = max(longer[part], c)
        found = []
        for g, a in often.items():
            if len(g) == 2 and 100 * longer[g] >= share * a:
                continue
            cuts = [(10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -s))
    return sorted(out)


def docs_of(spark, rows):
    return spark.createDataFrame([(n, t, g, 1, "x") for n, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, rank int, w1 string")


def random_rows(seed, n):
    rng = random.Random(seed)
    letters = ["a", "B", "c", "dé", "日", "A", "b"]
    signs = [" ", " ", " ", " ", "\t", "  ", ".", ", ", "\n", "\x1c"]
    text = lambda: "".join(rng.choice(letters) + rng.choice(signs) for _ in range(rng.randint(0, 60)))
    return [(text(), rng.choice(["en", "de", None, "und", ""])) for _ in range(n)]


ODD = [(None, "en"), ("", None), (" \t\n.", "en"), ("a b c " * 30_000, "long"), ("x" * 5000, "de"), ("new york city " * 12, "en"), ("new york city " * 12, "en")]


@pytest.mark.parametrize("small", [False, True])
def test_against_counters(spark, monkeypatch, small):
    if small:  # many blocks, bursts, spills, renewed vocabularies, rows of runs and merges
        for name, value in {"WORDS": 6, "ENTRIES": 8, "BLOCK": 40, "CUT": 100, "RUN": 3, "MERGE": 10}.items():
            monkeypatch.setattr(phrases, name, value)
        monkeypatch.setattr(hattrie, "BURST", 2)
    rows = random_rows(1, 60 if small else 400) + (ODD[:3] + ODD[4:] if small else ODD)
    out = phrases.collocations(docs_of(spark, rows), top=40)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == expected(rows, top=40)


def test_query(spark, data_dir):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op12_collocations(spark, data_dir).collect())) == expected(rows)


def test_a_clash_of_hashes_is_noticed():
    same = np.array([5, 5], "<u8").tobytes()
    assert phrases.CLASH in [row[0] for row in phrases._merged_words([("en", b"ab cd", same, b"\x02\x03")], 1)]
    assert phrases.CLASH in [row[0] for row in phrases._merged_words([("en", b"ab", same[:8], b"\x02"), ("de", b"ab", same[:8], b"\x02")], 1)]
    twice = list(phrases._merged_words([("en", b"ab", same[:8], b"\x02"), ("en", b"ab", same[:8], b"\x02")], 3))
    assert sorted(row[0] for row in twice) == [phrases.TOTAL, 1] and {row[-1] for row in twice} == {4}


def test_small_bounds_in_one_process(monkeypatch):
    for name, value in {"WORDS": 6, "ENTRIES": 8, "BLOCK": 40, "CUT": 100, "RUN": 3}.items():
        monkeypatch.setattr(phrases, name, value)
    monkeypatch.setattr(hattrie, "BURST", 2)
    text = " ".join(random.Random(7).choices("abcdefgh.", k=3000)).encode()
    words = [w for part in phrases.pieces_of(text) for w in part if w]
    assert words == text.replace(b".", b"\n").split(b" ")
    counter, got = phrases.Counter(3, 64, 0, None), Counter()
    numbers = counter.words.numbers("en", words)
    for at in range(0, len(numbers), 50):
        counter.block(numbers[at : at + 52], 50)
    rows = list(counter.finished())
    assert all(len(r[5]) <= 3 * 24 for r in rows)
    for row in rows:
        if row[1] == 3:
            keys = np.frombuffer(row[5], np.uint64).reshape(-1, 3)
            assert (keys[1:, 0] >= keys[:-1, 0]).all() and {int(p) >> 58 for p in keys[:, 0]} == {row[0]}
            got.update(dict(zip(map(tuple, keys.tolist()), phrases._as_counts(row[6], len(keys)).tolist())))
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2) if b"\n" not in words[i : i + 3])
    assert sorted(got.values()) == sorted(grams.values())


def test_large_counts_are_exact(spark):
    a, l, r = 3_037_000_499_123, 9_007_199_254_741, 4_000_000_000_037
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(phrases._score(*[df[c] for c in "alr"])).first()[0] == 10**6 * a * a // (l * r)


def test_empty_table(spark):
    assert phrases.collocations(docs_of(spark, [("a", "b")]).limit(0)).count() == 0


def test_trie_counts_like_a_counter():
    rng = np.random.default_rng(0)
    trie, want = hattrie.HatTrie(lambda keys: phrases.mixed(keys.astype(np.uint64))), Counter()
    for _ in range(20):
        keys, counts = np.unique(rng.integers(0, 100_000, 20_000), return_counts=True)
        trie.add(keys, counts)
        want.update(dict(zip(keys.tolist(), counts.tolist())))
    assert len(trie) == len(want)
    got = {}
    for n in range(hattrie.FAN):
        got.update(zip(*(x.tolist() for x in trie.cut(n))))
    assert got == dict(want) and len(trie) == 0
