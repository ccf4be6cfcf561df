"""Repair of the structure of conversations: the cheapest edits that make the roles alternate, found on shared suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.ranks import ranked
from bitextloom.llm.tables import broadcast_if_small, stored

SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
# Initials of the roles that the grammar knows; any other is one more kind.
INITIALS = "sua"
OTHER = len(INITIALS)
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}
# Grammar states: nothing yet, after s, after u, after a. What a kept role and a made one (user or assistant) lead to.
STATES = range(4)
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
MADE = (2, 2, 3, 2)
MADE_ROLE = {2: "user", 3: "assistant"}
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
# Longer conversations are solved in blocks of so many rows, counted from their end.
BLOCK = 4096
FAR = 10**12
# The end of a conversation: what the inserts cost that close it.
END, END_NODE = "end", ((0, 10, 5, 0), ("", "II", "I", ""), (0, 3, 3, 3))
KEY = "conv"
TURNS = f"{KEY} string, kind int, place long, role string, text string"
SOLVED = (
    "signature string, terminal string, costs array<long>, audits array<string>, exits array<int>, "
    "blank long, duplicate long, truncated long, illegal long"
)


def node_above(symbol: int, below: tuple) -> tuple:
    """Costs to go, best audit suffixes and last states of the automaton node that reads `symbol` before `below`.

    Of equal costs the least first letter wins; different edits have different letters, so no suffixes are compared.
    """
    role, fault = divmod(symbol, 4)
    costs, audits, exits = below
    best = []
    for state in STATES:
        options = [(costs[state] + DELETE, "D", state)]
        if fault in (SOUND, TRUNCATED):
            extra = CUT if fault == TRUNCATED else 0
            if (state, role) in KEPT:
                options.append((costs[KEPT[state, role]] + extra, "K", KEPT[state, role]))
            options.append((costs[MADE[state]] + REROLE + extra, "R", MADE[state]))
        best.append(min(options))
    changed = True
    while changed:
        changed = False
        for state in STATES:
            option = (best[MADE[state]][0] + INSERT, "I", MADE[state])
            if option[:2] < best[state][:2]:
                best[state], changed = option, True

    def finish(state: int) -> tuple[str, int]:
        _, edit, to = best[state]
        if edit == "I":
            audit, last = finish(to)
            return edit + audit, last
        return edit + audits[to], exits[to]

    ends = [finish(state) for state in STATES]
    return tuple(b[0] for b in best), tuple(e[0] for e in ends), tuple(e[1] for e in ends)


def terminal_node(terminal: str) -> tuple:
    if terminal == END:
        return END_NODE
    return tuple(int(c) for c in terminal.split(",")), ("",) * 4, tuple(STATES)


def terminal_name(costs: list[int]) -> str:
    least = min(costs)
    return ",".join(str(c - least) for c in costs)


def solved(requests: DataFrame) -> DataFrame:
    """`SOLVED` for each distinct (signature, terminal).

    Signatures are sorted from their ends, so that those with a common suffix stand together and share the nodes of that
    suffix: a task holds one path of the automaton, and each node is computed once however many conversations end alike.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_terminal, last, path = None, "", []
        for batch in batches:
            out = []
            for signature, terminal in zip(*(batch.column(name).to_pylist() for name in ("signature", "terminal"))):
                turned = signature[::-1]
                if terminal != last_terminal:
                    last_terminal, last, path = terminal, "", [terminal_node(terminal)]
                shared = common_length(turned, last)
                del path[shared + 1 :]
                for letter in turned[shared:]:
                    path.append(node_above(int(letter, 16), path[-1]))
                last = turned
                out.append((signature, terminal, *map(list, path[-1]), *fault_counts(signature)))
            kinds = (pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.int64()] * 4)
            columns = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 9, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [part.split()[0] for part in SOLVED.split(", ")]
    turned = requests.select("signature", "terminal").distinct().withColumn("turned", F.reverse("signature"))
    dealt = turned.repartitionByRange("terminal", "turned").sortWithinPartitions("terminal", "turned")
    return stored(dealt.select("signature", "terminal").mapInArrow(build, SOLVED), "solved")


def common_length(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def fault_counts(signature: str) -> tuple[int, int, int, int]:
    """blank, duplicate, truncated, and illegal neighbours."""
    symbols = [int(letter, 16) for letter in signature]
    faults = [s % 4 for s in symbols]
    illegal = sum((a // 4, b // 4) not in LEGAL for a, b in zip(symbols, symbols[1:]))
    return faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal


def keyed(turns: DataFrame) -> DataFrame:
    """conv (never null), turn, role, text (null: one space), digest of the text."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    text = space("text")
    return turns.select(
        conv_key(), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest")
    )


def conv_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias(KEY)


def symbols(rows: DataFrame) -> DataFrame:
    """conv, turn, place, n and symbol of every row: role and first fault as one hexadecimal digit."""
    left = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(left == "", BLANK).when(F.instr(F.lit(STOPS), F.substring(left, -1, 1)) == 0, TRUNCATED).otherwise(SOUND)
    role = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    role = F.when((role == 0) | (F.col("role") == ""), OTHER).otherwise(role - 1)
    narrow = rows.select(KEY, "turn", "role", "digest", role.alias("initial"), fault.alias("fault"))
    placed = stored(ranked(narrow, KEY, ["turn", "role", "digest"], "turns"), "placed-turns")
    again = placed.groupBy(KEY, "role", "digest").agg(F.min("place").alias("seen"), F.count(F.lit(1)).alias("times"))
    again = stored(again.filter("times > 1").drop("times"), "said-again")
    joined = placed.join(broadcast_if_small(again), [KEY, "role", "digest"], "left")
    duplicate = (F.col("fault") != BLANK) & (F.col("place") > F.col("seen"))
    symbol = F.col("initial") * 4 + F.when(duplicate, DUPLICATE).otherwise(F.col("fault"))
    return joined.select(KEY, "turn", "place", "n", F.lower(F.hex(symbol)).alias("symbol"))


def signatures(rows: DataFrame, block: int) -> DataFrame:
    """conv, block (0 is the last), blocks and signature: the symbols of at most `block` rows."""
    at = F.expr(f"(n - 1 - place) div {block}").alias("block")
    whole = rows.groupBy(KEY, at, F.expr(f"(n + {block - 1}) div {block}").alias("blocks"))
    ordered = F.sort_array(F.collect_list(F.struct("place", "symbol")))
    return stored(whole.agg(F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("signature")), "signatures")


def terminals(long: DataFrame) -> DataFrame:
    """conv, block, terminal: what follows each block of the conversations of several blocks, as costs by state.

    Blocks that something follows are solved once for each state at their end alone; these costs, combined from the end
    of the conversation on, are the costs that each block meets. One row a block reaches a task, four numbers each.
    """
    ends = F.explode(F.array(*(F.lit(",".join("0" if s == t else str(FAR) for s in STATES)) for t in STATES)))
    requests = long.filter("block > 0").select("signature", ends.alias("terminal"))
    requests = requests.union(long.filter("block = 0").select("signature", F.lit(END).alias("terminal")))
    known = solved(requests).select("signature", "terminal", "costs")
    steps = long.select(KEY, "block", "signature").join(known.groupBy("signature").agg(F.collect_list(F.struct("terminal", "costs")).alias("by")), "signature")

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        costs, names = None, []
        frame = frame.sort_values("block")
        for by in frame["by"]:
            table = {row["terminal"]: list(row["costs"]) for row in by}
            if costs is None:
                names.append(END)
                costs = table[END]
                continue
            names.append(terminal_name(costs))
            # Of each state the least over the states that the block may end in.
            ways = [table[",".join("0" if s == t else str(FAR) for s in STATES)] for t in STATES]
            costs = [min(ways[t][s] + costs[t] for t in STATES) for s in STATES]
        return pd.DataFrame({KEY: frame[KEY], "block": frame["block"], "terminal": names})

    return steps.select(KEY, "block", "by").groupBy(KEY).applyInPandas(scan, f"{KEY} string, block long, terminal string")


def repair_plans(blocks: DataFrame) -> DataFrame:
    """conv, cost, audit, blank, duplicate, truncated, illegal."""
    names = ("blank", "duplicate", "truncated", "illegal")
    long = blocks.filter("blocks > 1")
    asked = blocks.filter("blocks = 1").select(KEY, "block", "signature", F.lit(END).alias("terminal"))
    several = not long.isEmpty()
    if several:
        named = stored(terminals(long), "terminals")
        asked = asked.union(long.join(named, [KEY, "block"]).select(KEY, "block", "signature", "terminal"))
        asked = stored(asked, "asked")
    known = solved(asked)
    small = known.agg(F.coalesce(F.sum(F.length("signature")), F.lit(0))).first()[0] <= 2**21
    found = asked.join(broadcast_if_small(known) if small else known, ["signature", "terminal"])
    short = blocks.filter("blocks = 1").select(KEY)
    if not several:
        return found.select(KEY, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"), *names)

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        state, cost, audit, last = 0, 0, [], None
        frame = frame.sort_values("block", ascending=False)
        illegal = int(frame["illegal"].sum())
        for signature, terminal, costs, audits, exits in zip(*(frame[c] for c in ("signature", "terminal", "costs", "audits", "exits"))):
            if last is not None:
                illegal += (last, int(signature[0], 16) // 4) not in LEGAL
            last = int(signature[-1], 16) // 4
            audit.append(audits[state])
            after = 0 if terminal == END else terminal_node(terminal)[0][exits[state]]
            cost, state = cost + int(costs[state]) - after, int(exits[state])
        sums = {name: [int(frame[name].sum())] for name in names[:3]}
        return pd.DataFrame({KEY: frame[KEY].iloc[:1].tolist(), "cost": [cost], "audit": ["".join(audit)], **sums, "illegal": [illegal]})

    schema = f"{KEY} string, cost long, audit string, blank long, duplicate long, truncated long, illegal long"
    walked = found.join(F.broadcast(long.select(KEY).distinct()) if long.count() <= 100_000 else long.select(KEY).distinct(), KEY, "left_semi")
    walked = walked.groupBy(KEY).applyInPandas(walk, schema)
    plain = found.join(short, KEY, "left_semi").select(KEY, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"), *names)
    return plain.union(walked)


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv, place, role, text of what stays, in order within each partition, a conversation in one piece.

    The plan of a conversation comes ahead of its rows, which are then streamed one by one: a task holds a plan, never
    the texts of a conversation.
    """
    none = F.lit(None)
    heads = plans.select(KEY, F.lit(0).alias("kind"), none.cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), none.cast("binary").alias("digest"))
    every = heads.union(rows.select(KEY, F.lit(1).alias("kind"), "turn", "role", "text", "digest"))
    order = [F.col(c).asc_nulls_first() for c in (KEY, "kind", "turn", "role", "digest")]
    dealt = every.repartition(KEY).sortWithinPartitions(*order).select(KEY, "kind", "role", "text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
        names = (KEY, "place", "role", "text")
        conv, audit, at, state, place = None, "", 0, 0, 0
        for batch in batches:
            out = []

            def inserts() -> None:
                nonlocal at, state, place
                while at < len(audit) and audit[at] == "I":
                    state = MADE[state]
                    out.append((conv, place, MADE_ROLE[state], ""))
                    place, at = place + 1, at + 1

            for key, kind, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if kind == 0:
                    conv, audit, at, state, place = key, text, 0, 0, 0
                    inserts()
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    state = KEPT[state, INITIALS.index(role[0])] if edit == "K" else MADE[state]
                    out.append((conv, place, role if edit == "K" else MADE_ROLE[state], text))
                    place += 1
                inserts()
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))

    return dealt.mapInArrow(apply, f"{KEY} string, place long, role string, text string")


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """conv and the sha256 of its `role:text`, joined by line ends, of the frame that `repaired_turns` gives."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            out = []
            for key, role, text in zip(*(batch.column(name).to_pylist() for name in (KEY, "role", "text"))):
                line = f"{role}:{text}".encode()
                if key != conv:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state = key, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (list(zip(*out)) or [()] * 2)], [KEY, "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], [KEY, "sha256"])

    return repaired.mapInArrow(digests, f"{KEY} string, sha256 string")


class ConversationRepair:
    """The repair of a table of turns (conv_id, turn, role, text): `report()`, `turns()` and `digests()`.

    Rows of a conversation stand by turn, nulls first, then by role and the md5 of the text. A null role or text is one
    space, rows without a conv_id are one conversation. Each row's first fault counts: blank (nothing but ASCII white space), duplicate
    (role and text seen earlier in the conversation), truncated (ends otherwise than in a stop). Edits: Keep costs nothing,
    Rerole to user or assistant 1, Delete 2 (the only one for blank and duplicate rows), Insert of an empty user or assistant row 5;
    a truncated row that stays costs 5 more. The cheapest edits make the role initials `(s?(ua)+)?`; of equal
    costs the audit that is least in ASCII. Other columns are ignored; an empty table has no conversations.

    Rows are ranked, compared and cut into blocks over the whole cluster. The symbols of a block, one digit a row, are its signature;
    distinct signatures share the nodes of their suffixes. Only the last pass, over texts in order, has a conversation in one task,
    which streams it: its digest is a hash of one sequence.
    """

    def __init__(self, turns: DataFrame, block: int = BLOCK) -> None:
        self.rows = keyed(turns)
        self.symbols = stored(symbols(self.rows), "symbols")
        self.plans = stored(repair_plans(signatures(self.symbols, block)), "plans")

    def report(self) -> DataFrame:
        """conv (`=` and the id, or empty for null), gaps, blank, duplicate, truncated, illegal, cost, audit."""
        gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0))
        spans = self.symbols.groupBy(KEY).agg(gaps.alias("gaps"))
        return spans.join(self.plans, KEY).select(KEY, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def turns(self) -> DataFrame:
        """conv, place, role, text of the repaired conversations."""
        return repaired_turns(self.rows, self.plans)

    def digests(self) -> DataFrame:
        """conv and sha256 of the repaired conversations that have a row."""
        return conversation_digests(self.turns())


def repair_conversations(turns: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct conv_id of `ids`: what `ConversationRepair` finds in `turns`, and repaired_sha256.

    A conversation without rows has zeros, an empty audit and the hash of an empty string.
    """
    repair = ConversationRepair(turns, block)
    every = ids.select("conv_id").distinct().withColumn(KEY, conv_key())
    joined = every.join(repair.report(), KEY, "left").join(repair.digests(), KEY, "left")
    numbers = [F.coalesce(name, F.lit(0)).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256"))
