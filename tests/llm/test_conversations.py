"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest

from bitextloom.llm.catalog import damaged
from bitextloom.llm.conversation_repair import ConversationRepair, repair_conversations

TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def hurt(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def search(rows, faults):
    """The least (cost, audit, lines) of all edit sequences whose roles fit."""

    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def least(i, last, inserts):
        found = []
        if i == len(rows):
            if last in ("", "a"):
                found.append((0, "", ()))
        else:
            (_, _, role, text), fault = rows[i], faults[i]
            more = least(i + 1, last, 0)
            if more:
                found.append((more[0] + 2, "D" + more[1], more[2]))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                for edit, cost, new in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    more = least(i + 1, new[0], 0) if new and new[0] in follow[last] else None
                    if more:
                        found.append((more[0] + cost + extra, edit + more[1], (f"{new}:{text}", *more[2])))
        if inserts < 3:
            for new in ("user", "assistant"):
                more = least(i, new[0], inserts + 1) if new[0] in follow[last] else None
                if more:
                    found.append((more[0] + 5, "I" + more[1], (f"{new}:", *more[2])))
        return min(found, default=None, key=lambda f: f[:2])

    return least(0, "", 0)


def plain(original, rows):
    result = []
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            body = text.rstrip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = search(own, faults)
        result.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=str)


def found(spark, original, rows, **options):
    frame = lambda x: spark.createDataFrame(x, TURNS)
    return sorted(map(tuple, repair_conversations(frame(rows), frame(original), **options).collect()), key=str)


def test_all_short_signatures(spark):
    kinds = [("system", "a."), ("user", "b."), ("assistant", "c."), ("tool", "d."), ("user", "cut"), ("assistant", "off"), ("user", " ")]
    rows = []
    for conv, turns in enumerate(t for n in range(5) for t in product(range(len(kinds)), repeat=n)):
        # Numbered texts, so that only the last kind but one repeats.
        rows += [(conv, i, kinds[k][0], f"{i}{kinds[k][1]}" if k < 6 else " ") for i, k in enumerate(turns)]
    assert found(spark, rows, rows) == plain(rows, rows)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_long_conversations_in_blocks(spark, block):
    rng = random.Random(7)
    rows = []
    for conv in range(60):
        for i in range(rng.randint(1, 30)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "", "tool"])
            rows.append((conv, rng.choice([i, i, None, 3]), role, rng.choice(["Yes.", f"So {i}!", f"cut {i}", " \t", "", None, f"Fine {i}."])))
    filled = [(c, t, r, " " if x is None else x) for c, t, r, x in rows]
    assert found(spark, rows, rows, block=block) == plain(rows, filled)


def test_damage_and_edges(spark):
    rng = random.Random(3)
    rows = [(c if c else None, t, "user" if t % 2 else "assistant", f"Said {rng.randrange(4)}.") for c in range(40) for t in range(1, 9)]
    rows += [(50, None, "user", "Hm."), (51, 1, None, None), (52, 2, "user", "long " * 200_000 + "."), (52, 3, "assistant", "Yes."), (52, 3, "assistant", "Yes.")]
    got = damaged(spark.createDataFrame([(*r, "x") for r in rows], f"{TURNS}, damage string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(hurt(rows), key=str)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{TURNS}, conv string, place int")
    mine = sorted(map(tuple, repair_conversations(damaged(frame), frame).collect()), key=str)
    assert mine == plain(rows, list(hurt(rows)))
    assert found(spark, [], []) == []
    assert found(spark, [(1, 1, "user", "a.")], []) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi"), (1, 3, "user", "Who?"), (1, 4, "assistant", "Me.")]
    turns = ConversationRepair(spark.createDataFrame(rows, TURNS)).turns().orderBy("place").collect()
    assert [(t["role"], t["text"]) for t in turns] == [("user", "Be kind."), ("assistant", "Hello."), ("user", "Who?"), ("assistant", "Me.")]
