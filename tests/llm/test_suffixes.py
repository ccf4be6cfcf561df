"""Suffix sorting against plain sorting, removed bytes against every window of every text."""

import random
from collections import Counter

import numpy as np
import pytest

from bitextloom.llm.suffix_dedup import repeated_windows, strip_repeats
from bitextloom.llm.suffix_sort import common_prefix, deep_shallow
from bitextloom.llm.winnowing import anchors

LETTERS = "abcdefgh ."


def prose(rng, size):
    return "".join(rng.choice(LETTERS) for _ in range(size))


def plain(texts, window):
    """(n_bytes, spans, kept) of each text."""
    texts = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    result = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if counts[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        edges = np.flatnonzero(np.diff(np.frombuffer(gone, np.int8), prepend=0, append=0)).tolist()
        result.append((len(t), list(zip(edges[::2], edges[1::2])), bytes(b for b, g in zip(t, gone) if not g)))
    return result


def found(docs, **options):
    rows = strip_repeats(docs, **options).collect()
    return sorted((repr(r["doc_id"]), r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in rows)


def check(spark, texts, window, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = sorted((repr(i), *row) for i, row in enumerate(plain(texts, window)))
    assert found(docs, window=window, **options) == want


@pytest.mark.parametrize("seed", range(30))
def test_sort(seed):
    rng = random.Random(seed)
    stem = prose(rng, rng.choice([0, 5, 70])).encode()
    strings = [stem + bytes(rng.choices(b"ab", k=rng.randint(0, 80))) for _ in range(rng.randint(1, 60))]
    strings += [s + b"a" * 9 for s in strings[:5]] + strings[:3]
    order, shared = deep_shallow(strings)
    assert sorted(order) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)
    assert shared == [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]


def test_every_window_has_one_anchor():
    rng = random.Random(1)
    texts = [prose(rng, n).encode() for n in (0, 10, 130, 131, 2000, 129)] + [b"a" * 900, b"abc" * 300]
    starts = np.cumsum([0] + [len(t) for t in texts])
    got = anchors(np.frombuffer(b"".join(texts), np.uint8), starts, 130)
    windows = [s for first, n in zip(got.first, got.windows) for s in range(first, first + n)]
    assert sorted(windows) == [s for a, b in zip(starts, starts[1:]) for s in range(a, b - 129)]
    assert all(f + n - 1 <= p <= f + 130 - 64 for f, n, p in zip(got.first, got.windows, got.place))


@pytest.mark.parametrize("seed", range(10))
def test_members_of_an_anchor(seed):
    rng = random.Random(seed)
    anchor, pool = b"#" * 64, [prose(rng, 40).encode() for _ in range(3)]
    members = []
    for _ in range(rng.randint(2, 12)):
        left, right = b"".join(rng.choices(pool, k=2))[rng.randint(0, 20):], b"".join(rng.choices(pool, k=2))[: rng.randint(40, 80)]
        context = left + anchor + right
        windows = len(context) - 130 + 1
        if windows > 0:
            members.append((context, windows, len(left)))
    counts = Counter((o - w, c[w : w + 130]) for c, n, o in members for w in range(n))
    want = [[w for w in range(n) if counts[o - w, c[w : w + 130]] > 1] for c, n, o in members]
    got = repeated_windows(members, 130) if members else []
    assert [sorted(w for first, n in own for w in range(first, first + n)) for own in got] == want


@pytest.mark.parametrize("limit", [2, 4096])
def test_against_every_window(spark, limit):
    rng = random.Random(11)
    passages = [prose(rng, n) for n in (80, 99, 100, 101, 130, 170, 400)]
    texts = [None, "", "short", "é" * 60, "a" * 500, "xyz" * 200, passages[6] * 3]
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            if rng.random() < 0.4:
                at = rng.randrange(len(passage))
                passage = passage[:at] + "#" + passage[at + 1 :]
            parts += [passage[rng.randint(0, 3) :], prose(rng, rng.randint(0, 30))]
        texts.append("".join(parts))
    texts += texts[20:24] + [texts[30] + "!", "~" + texts[30], texts[31] + texts[31]]
    check(spark, texts, 100, limit=limit)


def test_production_window(spark):
    rng = random.Random(2)
    shared = prose(rng, 1500)
    texts = [prose(rng, 300) + shared[i * 40 : i * 40 + 399 + i] + prose(rng, 500) for i in range(20)]
    texts += [prose(rng, 1_200_000) + shared, shared[:400], shared[:399], "b" * 1_100_000]
    check(spark, texts, 400)


def test_edges(edge, clashing, none, spark):
    rows = edge.collect()
    want = sorted((repr(r["doc_id"]), *p) for r, p in zip(rows, plain([r["text"] for r in rows], 400)))
    assert found(edge) == want
    assert found(clashing) == want
    assert found(none) == []
    same = spark.createDataFrame([(1, "x" * 700), (1, "y" * 300), (None, "z" * 500), (None, "z" * 500)], "doc_id long, text string")
    assert found(same) == sorted([("1", 700, [(0, 700)], b""), ("1", 300, [], b"y" * 300), ("None", 500, [(0, 500)], b""), ("None", 500, [(0, 500)], b"")])
