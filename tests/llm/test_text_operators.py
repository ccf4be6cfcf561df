"""Line dedup, licence scan, token counts and the codec against plain versions of the same rules."""

import hashlib
import random
import re
import struct
from collections import defaultdict

import pytest
import public_tokenizers
import sentencepiece

from bitextloom.llm.bloom import PairFilter, pack, suspected, unpack
from bitextloom.llm.license_scan import TEMPLATES, bigrams, scan_licenses, words
from bitextloom.llm.line_dedup import dedup_lines
from bitextloom.llm.piece_codec import decode_ids, encode_texts, piece_bytes
from bitextloom.llm.pieces import pieces
from bitextloom.llm.token_count import count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BITS = 1 << 16


def plain_lines(rows):
    """The rule read literally."""
    strip, lower = " \t\n\x0b\x0c\r", {c: c + 32 for c in range(65, 91)}
    key = lambda line: line.strip(strip).translate(lower)
    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            holders[k].append(doc_id)
    low = lambda i: -1 if i is None else i
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            k = key(line)
            lost = len(k) >= 40 and len({i for i in holders[k] if i is not None}) >= 5 and low(doc_id) != max(map(low, holders[k]))
            kept += [] if lost else [line]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1 << 8, BITS, None])
def test_line_dedup(edge, bits):
    """A saturated filter gives the same result."""
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = [tuple(r) for r in dedup_lines(edge, bits=bits).collect()]
    assert sorted(got, key=str) == plain_lines(rows)
    assert sum(r[3] for r in got) > 10


@pytest.mark.parametrize("broadcast", [True, False])
def test_line_dedup_counts_documents_not_rows(spark, monkeypatch, broadcast):
    """Five rows of one id are one document; lost lines may also be joined by shuffle."""
    if not broadcast:
        monkeypatch.setattr("bitextloom.llm.line_dedup.BROADCAST_LINES", 0)
    line, other = "x" * 40, "y" * 41
    rows = [(1, line)] * 5 + [(2, f"{line}\n{other}")] + [(i, other) for i in (3, 4, 5, 6, None)]
    got = [tuple(r) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == plain_lines(rows)
    assert (1, line, 1, 0) in got and (2, line, 2, 1) in got and (None, "", 1, 1) in got and (6, other, 1, 0) in got


def test_line_dedup_clashing_and_empty(clashing, edge, none):
    left, right = dedup_lines(clashing, bits=BITS), dedup_lines(edge, bits=BITS)
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))
    assert dedup_lines(none, bits=BITS).count() == 0


def test_pair_filter():
    import numpy as np

    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 4000).astype(np.uint64)
    pair = PairFilter(1 << 18, 3)
    pair.add(h[:3000])
    pair.add(h[2000:])
    assert suspected(pair.twice, h[2000:3000], 3).all()
    assert suspected(pair.twice, h[:2000], 3).mean() < 0.1
    for n in (10, 60_000):
        part = np.packbits(np.isin(np.arange(1 << 16), rng.integers(0, 1 << 16, n)))
        assert (unpack(pack(part), 1 << 16) == np.flatnonzero(np.unpackbits(part))).all()


def test_tokens_and_codec(edge, clashing, none, small):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = edge.union(small)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = sorted(((i, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for i, t in texts), key=str)
    assert sorted((tuple(r) for r in count_tokens(docs, MODEL).collect()), key=str) == want
    assert any(r[3] for r in want)
    coded = decode_ids(encode_texts(docs, MODEL), MODEL).collect()
    ids = [(i, [1, *library.encode(t), 2]) for i, t in texts]
    want = sorted(((i, struct.pack(f"<{len(x)}I", *x), library.decode(x)) for i, x in ids), key=str)
    assert sorted(((r.doc_id, bytes(r.ids), r.text) for r in coded), key=str) == want
    assert count_tokens(clashing, MODEL).count() == encode_texts(clashing, MODEL).count() == len(texts) - small.count()
    assert count_tokens(none, MODEL).count() == decode_ids(encode_texts(none, MODEL), MODEL).count() == 0


def test_pieces_equal_library():
    """Random texts of awkward characters, and random ids with broken byte runs and control ids."""
    import random

    import numpy as np

    rng = random.Random(2)
    library, own, table = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces(MODEL), piece_bytes(MODEL)
    assert own.identity and own.prefix
    for _ in range(1500):
        text = "".join(rng.choice("ab e\n\t ▁é\U0001f642Ａ<s>/0x41\x00﻿中  ") for _ in range(rng.randint(0, 60)))
        assert [i for w in own.split(text) for i in own.encode(w)] == library.encode(text)
        assert sum(map(own.count, own.split(text))) == len(library.encode(text))
    for _ in range(1500):
        choice = [1, 2, 0, 231, 187, 176, 68, 258, 243, 162, 29871, 260, 261, rng.randrange(32000)]
        ids = [rng.choice(choice) for _ in range(rng.randint(0, 12))]
        assert table.decode(np.array(ids, np.uint32)) == library.decode(ids)


def test_license_scan(spark, none):
    mit, apache = dict(TEMPLATES)["MIT"], dict(TEMPLATES)["Apache-2.0 header"]
    wrapped = "\n".join(re.findall(r".{1,60}(?:\s|$)", mit))
    rows = [
        (1, f"prose before\n\nReleased under the MIT license!\nprose after"), (2, f"code\n\n{wrapped}\n\nmore code"),
        (3, apache.upper()), (4, "released under the"), (5, None), (6, ""), (7, "MIT"), (8, mit.replace("any", "each")),
        (9, "nothing of the kind, though a license is named"),
    ]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).filter("level <> 'window'")
    got = {(r.doc_id, r.license, r.level) for r in found.collect()}
    assert got == {
        (1, "MIT notice", "line"), (1, "MIT notice", "block"), (2, "MIT", "block"), (2, "MIT", "text"), (3, "Apache-2.0 header", "line"), (8, "MIT", "line"),
    }
    assert scan_licenses(none).count() == 0


def test_license_scan_prunes_nothing_it_should_find(spark):
    """All units against all templates without size bounds."""
    rng_rows = []
    for n, (_, text) in enumerate(TEMPLATES):
        tokens = text.split()
        for cut in range(0, len(tokens), max(1, len(tokens) // 8)):
            rng_rows.append((len(rng_rows), " ".join(tokens[cut:] + ["extra", "words"] * (cut // 9))))
    found = scan_licenses(spark.createDataFrame(rng_rows, "doc_id long, text string")).filter("level <> 'window'")
    got, want = {}, {}
    for r in found.collect():
        got.setdefault((r.doc_id, r.license), []).append(round(r.dice, 9))
    for doc_id, text in rng_rows:
        own = bigrams(words(text))
        for name, template in TEMPLATES:
            other = bigrams(words(template))
            dice = 2 * len(own & other) / (len(own) + len(other)) if own else 0
            if dice >= 0.8:
                want.setdefault((doc_id, name), []).append(round(dice, 9))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()} and len(want) > len(TEMPLATES)


def plain_windows(text):
    """Every window of every template's length."""
    tokens, out = words(text), []
    for name, template in TEMPLATES:
        other, length = bigrams(words(template)), len(words(template))
        good = []
        for i in range(len(tokens) - length + 1 if len(tokens) > length else 0):
            own = bigrams(tokens[i : i + length])
            dice = 2 * len(own & other) / (len(own) + len(other))
            if dice >= 0.8:
                good.append((dice, i, len(own)))
        group = []
        for window in [*good, None]:
            if group and (window is None or window[1] - group[-1][1] > length):
                best = max(group, key=lambda g: (g[0], -g[1]))
                out.append((name, best[1], best[2], best[0]))
                group = []
            if window:
                group.append(window)
    return sorted(out)


def test_license_windows(spark, edge, none, clashing):
    """Paragraphs amid code, notices inside lines, copies one after the other, changed words, long texts, repeated rows."""
    rng = random.Random(4)
    mit, isc = dict(TEMPLATES)["MIT"], dict(TEMPLATES)["ISC"]
    paragraphs = mit.replace("conditions: The", "conditions:\n\nThe").replace('Software. THE', 'Software.\n\nTHE')
    filler = lambda n: " ".join(rng.choice("for while return import def self the software of license".split()) for _ in range(n))
    texts = [
        f"int main() {{}}\n\n{paragraphs}\n\n# code\n{filler(300)}",
        "This library is released under the MIT License, see LICENSE for details.",
        "Copyright 2020 Foo. Released under the MIT License. Released under the MIT License.",
        f"{mit} {mit}\n{filler(20)}\n{isc}", mit.replace("any", "each") + filler(500), "", None, filler(40_000) + mit + filler(9),
        " ".join(w for i, w in enumerate(isc.split()) if i % 17) + filler(60), isc, "Released under the MIT License",
    ]
    for _ in range(12):
        parts = []
        for _ in range(rng.randint(1, 5)):
            tokens = rng.choice(TEMPLATES)[1].split()
            at = rng.randrange(len(tokens))
            tokens[at : at + rng.randint(0, 3)] = ["other"] * rng.randint(0, 3)
            parts += [" ".join(tokens), filler(rng.randint(0, 40))]
        texts.append("\n".join(parts))
    rows = list(enumerate(texts)) + [(1, texts[1])]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).filter("level = 'window'").collect()
    want = [(i, *w) for i, text in rows for w in plain_windows(text or "")]
    assert sorted((r.doc_id, r.license, r.position, r.n_bigrams, r.dice) for r in got) == sorted(want)
    found = {(r.doc_id, r.license) for r in got}
    assert {(0, "MIT"), (1, "MIT notice"), (2, "MIT notice"), (3, "MIT"), (3, "ISC"), (7, "MIT")} <= found and len(want) > 30
    assert scan_licenses(none).count() == 0
    assert sorted(map(str, scan_licenses(clashing).collect())) == sorted(map(str, scan_licenses(edge).collect()))


def test_kept_digest_is_of_the_text(edge):
    rows = dedup_lines(edge, bits=BITS).filter("doc_id = 2").collect()
    assert [(r.text, r.n_lines, r.n_dropped) for r in rows] == [("", 1, 0)]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_codec_with_a_small_word_table(spark):
    """A table that starts anew all the time changes no ids, and the pipeline's is smaller than op7's."""
    import corpus_pipeline
    from bitextloom.llm.pieces import TABLE_BYTES

    rows = [(i, " ".join(f"word{k} same" for k in range(i, i + 40))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    usual, small = (sorted((r.doc_id, bytes(r.ids)) for r in encode_texts(docs, MODEL, size).collect()) for size in (TABLE_BYTES, 1000))
    assert usual == small and corpus_pipeline.WORD_BYTES < TABLE_BYTES
