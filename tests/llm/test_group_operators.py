"""Exact and near dedup, passages, mixing, vectors and toxicity on awkward and on plain rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bitextloom.llm.components import connected_components
from bitextloom.llm.embedding_dedup import vector_groups
from bitextloom.llm.exact_dedup import drop_exact_copies, exact_groups, heavy_groups
from bitextloom.llm.minhash_dedup import drop_near_copies, near_groups
from bitextloom.llm.passage_dedup import CHUNK, MIN_WORDS, SIMILARITY, WIDTH, PassageJoin, cartesian_spans, repeated_passages
from bitextloom.llm.source_mix import mix_sources, source_targets, take_mix
from bitextloom.llm.toxicity import drop_toxic, fit_toxicity, held_out, score_toxicity

BITS = 1 << 18


def low(doc_id):
    return -1 if doc_id is None else doc_id


@pytest.mark.parametrize("support", [0.5, 0.1, 1 / 1024])
def test_exact_groups(edge, support):
    rows = [(r.doc_id, r.text or "") for r in edge.collect()]
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text].append(doc_id)
    want = []
    for doc_id, text in rows:
        ids = [i for i in groups[text] if i is not None]
        keep = max(ids) if ids else None
        want.append((doc_id, keep, len(groups[text]), doc_id == keep))
    got = [tuple(r)[:4] for r in exact_groups(edge, support).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_heavy_groups_miss_no_frequent_digest(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"own {i}") for i in range(3000)]
    digests = spark.createDataFrame(rows, "doc_id long, text_sha256 string").repartition(7)
    heavy = {r.text_sha256: (r.keep_id, r.group_size) for r in heavy_groups(digests, 0.1).collect()}
    assert heavy["hot"] == (2997, 1000) and len(heavy) <= 10


def test_drop_exact_copies_keeps_columns(clashing, none):
    kept = drop_exact_copies(clashing)
    assert kept.columns == clashing.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[6] == 0 and ids[7] == 1 and ids[1] == 0 and ids[2] == 1 and ids[None] == 1 and ids[90] == 1
    assert drop_exact_copies(none).count() == exact_groups(none).count() == 0


def plain_sets(rows, width):
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(width, len(w))
        sets[doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    return sets


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = sorted((top(a), top(b)))
        root[q] = p
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("width", [2, 5])
def test_near_groups(edge, small, width):
    docs = edge.union(small.withColumn("doc_id", small.doc_id + 1000))
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    sets = plain_sets(rows, width)
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for a in ids for b in ids if a < b and min(len(sets[a]), len(sets[b])) * 5 >= 4 * max(len(sets[a]), len(sets[b]))]
    links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = plain_components(sets, links)
    got = near_groups(docs, width=width).collect()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert len(got) == docs.count() and len(set(want.values())) < len(want) - 8


def test_near_group_of_many_variants(spark):
    """A crowded list of texts that are no copies: chains and outliers end in the right components."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 14)):
            text[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(text)))
    sets = plain_sets(rows, 2)
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = plain_components(sets, links)
    got = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    assert got == want and len(set(want.values())) > 1


def test_texts_of_common_words_are_no_candidates(spark, monkeypatch):
    """Few of the pairs of unlike texts that share much of their words come to be compared, and those in parts of a few members."""
    from bitextloom.llm import minhash_dedup

    rng = np.random.default_rng(9)
    common = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(common[:20] + [f"o{i}.{k}" for k in range(60)])) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(0, 300, 30)]
    text = [f"w{k}" for k in range(100)]
    for i in range(2000, 2030):
        copy = list(text)
        copy[int(rng.integers(0, 100))] = f"x{i}"
        rows.append((i, " ".join(copy)))
    seen, agreeing = [], minhash_dedup.agreeing_pairs

    def counted(pairs, *rest):
        seen.append(pairs.select("a", "b").distinct().filter("a < 2000").count())
        return agreeing(pairs, *rest)

    monkeypatch.setattr(minhash_dedup, "agreeing_pairs", counted)
    monkeypatch.setattr(minhash_dedup, "PART", 4)
    got = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    assert all(got[1000 + i] == i for i in range(0, 300, 30)) and {got[i] for i in range(2000, 2030)} == {2000}
    assert len(set(got.values())) == 301 and max(seen) < 4500


def near_misses(rng):
    """150 texts with some 0.7 of their shingles in common, pair by pair, and a few real copies among them."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        text = list(base)
        for at in rng.choice(200, 9, replace=False):
            text[at] = f"x{i}.{at}"
        rows.append((i, " ".join(text)))
    return rows + [(1000 + i, rows[i][1] + " more") for i in (3, 77, 140)] + [(7, "said by the same id " + rows[20][1]), (1003, rows[3][1])]


@pytest.mark.parametrize("chunk", [1024, 40])
def test_near_misses_of_a_long_list_leave_no_task(spark, monkeypatch, chunk):
    """Of a crowded list's pairs that only nearly are similar none becomes a row; what is similar among them is linked."""
    from bitextloom.llm import minhash_dedup

    seen, verified, linked = [], minhash_dedup.verified, minhash_dedup.long_list_links
    monkeypatch.setattr(minhash_dedup, "CHUNK", chunk)
    monkeypatch.setattr(minhash_dedup, "SHORT_LIST", 2)
    monkeypatch.setattr(minhash_dedup, "PIVOT_TURNS", ())
    monkeypatch.setattr(minhash_dedup, "verified", lambda near, *rest: (seen.append(near.count()), verified(near, *rest))[1])
    monkeypatch.setattr(minhash_dedup, "long_list_links", lambda *given: (found := linked(*given), seen.append(found.count()))[0])
    rows = near_misses(np.random.default_rng(12))
    got = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    sets = [(i, plain_sets([(i, text)], 2)[i]) for i, text in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a != b and 100 * len(x & y) >= 80 * len(x | y)]
    assert got == plain_components(sorted({i for i, _ in sets}), links) and 3 <= len(set(links)) // 2 < 20
    assert sum(seen) < 150


def test_drop_near_copies_keeps_columns(clashing, none):
    kept = drop_near_copies(clashing)
    assert kept.columns == clashing.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[6] == 1 and ids[7] == 0 and ids[20] == 1 and ids[24] == 0 and ids[1] == ids[2] == 1 and ids[None] == 2
    assert drop_near_copies(none).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(500, 400), (500, 450), (700, 700)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 400, 400: 400, 450: 400}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cartesian_spans():
    rng = np.random.default_rng(3)
    for _ in range(50):
        values = rng.integers(0, 12, 30)
        first, last = cartesian_spans(values)
        for c in range(30):
            l = c
            while l > 0 and values[l - 1] > values[c]:
                l -= 1
            r = c
            while r < 29 and values[r + 1] >= values[c]:
                r += 1
            assert (first[c], last[c]) == (l, r)


def test_passages(edge, small, none, clashing):
    docs = edge.union(small.withColumn("doc_id", small.doc_id + 1000))
    found = repeated_passages(docs, bits=BITS).collect()
    texts = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate({c: c + 32 for c in range(65, 91)})) for r in docs.collect()}
    covered = defaultdict(set)
    for r in found:
        sides = [(r.doc_id, r.start_word, r.end_word), (r.other_id, r.other_start, r.other_end)]
        a, b = ({tuple(texts[i][k : k + 5]) for k in range(s, e - 4)} for i, s, e in sides)
        assert all(e - s >= 50 and e <= len(texts[i]) for i, s, e in sides) and r.doc_id != r.other_id
        assert 100 * len(a & b) >= 80 * len(a | b) and math.isclose(r.similarity, len(a & b) / len(a | b))
        covered[r.doc_id].update(range(r.start_word, r.end_word))
    holders = defaultdict(set)
    for i, w in texts.items():
        for k in range(len(w) - 49):
            if i is not None:
                holders[tuple(w[k : k + 50])].add(i)
    missed = [(i, k) for i, w in texts.items() if i is not None for k in range(len(w) - 49)
              if len(holders[tuple(w[k : k + 50])]) > 1 and not set(range(k, k + 50)) & covered[i]]
    assert not missed and {41, 43, 45, 47} <= set(covered) and not {1, 2, 3, 4, 8, 10, 90} & set(covered)
    assert repeated_passages(none, bits=BITS).count() == 0
    assert repeated_passages(clashing, bits=BITS).count() > 0


def test_passage_shared_by_many_and_its_near_copies(spark):
    """One passage in many documents, some with a changed word, among others that share only half of it."""
    rng = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(60)]
    rows, near, half = [], set(), set()
    for i in range(150):
        own = [f"o{i}.{k}" for k in range(200)]
        middle = list(passage)
        if i % 3 == 0:
            middle = passage[:24] + [f"h{i}.{k}" for k in range(36)]
            half.add(i)
        else:
            near.add(i)
            if i % 3 == 1:
                middle[int(rng.integers(25, 35))] = f"changed{i}"
        rows.append((i, " ".join(own[:100] + middle + own[100:])))
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), bits=BITS)
    ids = {r.doc_id for r in found.collect()}
    assert near <= ids and not half & ids


def brute_passages(a, b):
    """Start words (in a, in b) of all 50-word places with a similarity of 0.8 or more."""
    x, y = ([frozenset(tuple(w[k + i : k + i + 5]) for i in range(46)) for k in range(len(w) - 49)] for w in (a, b))
    return {(i, j) for i, p in enumerate(x) for j, q in enumerate(y) if p & q and 100 * len(p & q) >= 80 * len(p | q)}


def passage_links(found):
    """Rows of all pairs of documents: those returned, and those that follow from the classes."""
    rows = [(r.doc_id, r.start_word, r.end_word, r.other_id, r.other_start, r.other_end) for r in found]
    moves = defaultdict(list)
    for r in found:
        if r.same_class:
            moves[r.doc_id].append((r.start_word - 9, r.end_word + 9, r.other_id, r.other_start - r.start_word))
    known, todo = set(rows), list(rows)
    while todo:
        i, s, e, j, u, v = todo.pop()
        for low, high, k, d in moves[i]:
            new = (k, s + d, e + d, j, u, v)
            if low <= s and e <= high and k != j and new not in known:
                known |= {new, (j, u, v, k, s + d, e + d)}
                todo += [new, (j, u, v, k, s + d, e + d)]
    return known


@pytest.mark.parametrize("extra", [5, 10, 15, 20, 45])
def test_longer_passage_of_two_among_many(spark, extra):
    """Many texts share 100 words, two of them `extra` more: those two have all of them with each other."""
    rows = []
    for i in range(40):
        own = [f"o{i}.{k}" for k in range(60)]
        more = [f"m{i // 2}.{k}" for k in range(extra)] if i < 20 else []
        rows.append((i, " ".join(own[:30] + [f"p{k}" for k in range(100)] + more + own[30:])))
    links = passage_links(repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), bits=BITS).collect())
    for i in range(40):
        for j in range(40):
            if i != j:
                longest = max((e - s for a, s, e, b, _, _ in links if (a, b) == (i, j)), default=0)
                assert longest >= 100 + extra * (i // 2 == j // 2 and i < 20), (i, j, longest)


def test_every_pair_of_a_shared_passage_is_linked(spark):
    """Copies, and copies with words of their own or of a few, against brute force over all pairs."""
    rng = np.random.default_rng(12)
    texts = []
    for i in range(36):
        middle = [f"p{k}" for k in range(70)]
        if i % 3:
            for at in rng.integers(0, 70, i % 3):
                middle[int(at)] = f"c{i}" if i % 2 else f"v{int(rng.integers(0, 3))}"
        own = [f"o{i}.{k}" for k in range(40)]
        texts.append(own[: i % 20] + middle + own[i % 20 :])
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), bits=BITS).collect()
    links = passage_links(found)
    for a, s, e, b, u, v in links:
        x, y = ({tuple(texts[i][k : k + 5]) for k in range(p, q - 4)} for i, p, q in ((a, s, e), (b, u, v)))
        assert e - s >= 50 and v - u >= 50 and 100 * len(x & y) >= 80 * len(x | y)
    have = {(r[0], r[3]) for r in links}
    want = {(i, j) for i in range(36) for j in range(i) if brute_passages(texts[i], texts[j])}
    assert want and not {p for p in want if p not in have or p[::-1] not in have}
    assert sum(r.same_class for r in found) >= 10  # six plain copies nine words or more from the start are one class


def test_texts_travel_to_cells_not_to_pairs(spark):
    """300 different texts of one passage have 44,850 pairs; each text is sent once for each chunk it is compared with."""
    rows = []
    for i in range(300):
        middle = [f"p{k}" for k in range(160)]
        middle[3 + i // 2] = f"c{i}"
        rows.append((i, " ".join([f"o{i}.{k}" for k in range(20)] + middle)))
    join = PassageJoin(spark.createDataFrame(rows, "doc_id long, text string"), WIDTH, MIN_WORDS, SIMILARITY, BITS)
    reps = join.classes(join.units())[0]
    count = reps.select("rep").distinct().count()
    windows = join.windows(reps)
    dealt = join.cells(windows)
    assert dealt.count() == dealt.distinct().count() <= 300 * -(-300 // CHUNK)
    pairs = {(r.doc_id, r.other_id) for r in join.verified(windows).select("doc_id", "other_id").distinct().collect()}
    assert count > CHUNK and len(pairs) == count * (count - 1)


def test_targets_and_mix(spark, edge, none, clashing):
    rows = [(i, "w " * (i % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)] + [(9001, None, None), (9002, "a b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mix_sources(docs).collect()
    again = {r.doc_id: r.taken for r in mix_sources(docs.repartition(2)).collect()}
    assert again == {r.doc_id: r.taken for r in got} and len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
    order = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    sizes = {s: sum(r.size for r in by[s]) for s in by}
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            target.update({s: weight[s] * level for s in free})
            break
        target.update({s: 3.0 * sizes[s] for s in over})
        free -= over
    for s in by:
        assert all(math.isclose(r.target, target[s], abs_tol=1e-6) and r.source_size == sizes[s] for r in by[s])
        assert abs(sum(r.taken for r in by[s]) - target[s]) <= 50
        copies = {r.copies for r in by[s]}
        assert max(copies) - min(copies) <= 1  # complete epochs before a part of one
    assert mix_sources(none).count() == take_mix(none).count() == 0
    mixed = take_mix(clashing)
    assert mixed.columns == clashing.columns
    want = Counter({(r.doc_id, r.source): 0 for r in edge.collect()})
    for r in mix_sources(edge).collect():
        want[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +want


def test_mix_prefers_quality(spark):
    rows = [(i, "a b c", f"s{i % 2}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    quality = spark.createDataFrame([(i, 4.0 if i % 4 < 2 else 1.0) for i in range(4000)], "doc_id long, quality double")
    got = [r for r in mix_sources(docs, quality).collect() if r.source == "s0"]
    good, bad = (sum(r.copies for r in got if (r.doc_id % 4 < 2) == side) for side in (True, False))
    assert good > 1.3 * bad and source_targets(spark.createDataFrame([], "source string, mix_size long")).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 20))
    data = [(i, (centres[i % 6] + rng.normal(0, 0.02 + 0.4 * (i % 5 == 0), 20)).tolist()) for i in range(400)]
    data += [(400 + i, data[i][1]) for i in range(10)] + [(420, [2 * x for x in data[0][1]])]
    odd = [(500, None), (501, [0.0] * 20), (502, [None] * 20), (503, [math.nan] * 20), (504, [math.inf] + [1.0] * 19), (505, []), (None, data[0][1]), (506, [1.0, 2.0])]
    frame = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>").repartition(3)
    m = np.array([v for _, v in data])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.9
    ids = [i for i, _ in data]
    want = plain_components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b])
    got = vector_groups(frame).collect()
    for r in got:
        if r.vec_id in want:
            at = ids.index(r.vec_id)
            assert (r.n_links, r.component_id) == (int(near[at].sum()) - 1, want[r.vec_id])
            assert r.kept == (r.vec_id == r.component_id)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
    assert len(got) == len(data) + len(odd)
    assert vector_groups(frame.limit(0)).count() == 0


def test_crowded_cell_is_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr("bitextloom.llm.embedding_dedup.CHUNK", 50)
    rng = np.random.default_rng(7)
    m = rng.normal(size=16) + rng.normal(0, 0.3, (330, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    want = (m @ m.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in vector_groups(frame).collect()}
    assert got == {i: int(n) for i, n in enumerate(want)}


def test_vectors_are_dealt_once_a_pair_of_chunks(spark, monkeypatch):
    """Not once for every block and cell as well; links that only the last dimensions tell apart, and of long vectors, are right."""
    from bitextloom.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "CHUNK_BYTES", 8 * 64 * 100)
    rng = np.random.default_rng(8)
    m = rng.normal(size=(300, 64))
    m[100:200, :32] = m[:100, :32]
    m[200:] = m[:100] + rng.normal(0, 0.48, (100, 64))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    dealt, grouped = [], type(frame).groupBy

    def counted(self, *keys):
        if any(isinstance(key, str) and key == "j" for key in keys):
            dealt.append(self.count())
        return grouped(self, *keys)

    monkeypatch.setattr(type(frame), "groupBy", counted)
    got = {r.vec_id: r.n_links for r in vector_groups(frame).collect()}
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    want = (m @ m.T >= 0.9).sum(axis=1) - 1
    assert got == {i: int(n) for i, n in enumerate(want)} and 0 < want.sum() < 200
    assert dealt == [3 * 300]


def test_toxicity_learns_pairs_and_edges(spark, edge, none, clashing):
    """An insult counts only where a group is named: no additive model can tell the four kinds apart."""
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(4000):
        filler = [f"word{k}" for k in rng.integers(0, 300, 12)]
        insult, group = bool(rng.integers(0, 2)), bool(rng.integers(0, 2))
        filler += ["insult"] * insult + ["groupname"] * group + ["plain"] * (not insult) + ["other"] * (not group)
        rows.append((i, " ".join(rng.permutation(filler)), "en", "s", 1))
        labels.append((i, 0, int(insult == group)))
    docs = spark.createDataFrame(rows, edge.schema)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    toxic = dict((i, t) for i, _, t in labels)
    got = score_toxicity(docs, marks).collect()
    held = [r for r in got if r.held_out]
    assert 700 < len(held) < 1300 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert np.mean([(r.score >= 0.5) == bool(toxic[r.doc_id]) for r in held]) > 0.95
    scored = {r.doc_id: r.score for r in score_toxicity(docs.union(edge.filter("doc_id < 4").withColumn("doc_id", edge.doc_id + 10_000)), marks).collect()}
    assert scored[10_001] == scored[10_002] and 0 <= scored[10_001] <= 1
    for unlabelled in (marks.limit(0), marks.withColumn("toxic", marks.toxic.cast("int") * 0)):
        assert {r.predicted for r in score_toxicity(edge, unlabelled).collect()} == {0}
    assert score_toxicity(none, marks).count() == 0
    kept = drop_toxic(clashing, marks.limit(0))
    assert kept.columns == clashing.columns and kept.count() == clashing.count()


def test_terms_that_tell_only_together_enter_the_model(spark):
    """Each term is as common in both labels; only the pair tells."""
    rows = [(i, f"insult{i // 2 % 2} group{i % 2}", int(i // 2 % 2 == i % 2)) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = fit_toxicity(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert all(model.terms(w) for w in ("insult0", "insult1", "group0", "group1"))


def test_held_out_is_the_crc_of_the_decimal_id(spark):
    import zlib

    rows = spark.range(500).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
