"""Conversation structure repair: cheapest edits by bidirectional Dijkstra.

A repaired conversation's role initials spell ``(s?(ua)+)?``.  The automaton of
that pattern has four states (nothing yet, system seen, user's turn given,
assistant's turn given); a node of the edit lattice is (rows read, state).
Keep, Rerole and Delete read a row, Insert does not; letter and state fix which
role is inserted or assigned.  From the start and from the accepting nodes two
heaps work towards each other.  They go on until the sum of their least costs
exceeds the best total, so that all crossings of equal cost are finished, and
of those the least concatenation of audits is taken.

Long conversations.  Rows are sorted by range and cut into blocks of at most
``BLOCK`` rows, so a conversation that holds a third of the table is many
blocks.  A block's costs between states are a 4 x 4 table; one backward pass
over the tables gives what each exit state still costs, the blocks are solved
for each entry state, and one forward pass picks the solutions that fit.  Two
audits of equal cost never have one as a prefix of the other (the letters
determine the node), so the least audit is the chain of the blocks' least
audits.  The hash of a conversation's text is inherently one sequence: its rows
stream through one task in sorted batches and nothing but the current block's
audit is held.

Nulls: a null conv_id is a conversation of its own; null roles and texts are one
space; null turns sort first.  Rows of one turn are ordered by role and text.
Rows equal in all four columns are one row with a count, and all but the first
are duplicates.  A conversation that loses all its rows has zeros, an empty
audit and the hash of the empty string.  Empty and very long texts are ordinary
texts; an empty table gives no rows.  Other input columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import attach, partitions, save

#: Rows of a block at most: a power of two.
BLOCK = 1024
#: Costs of the edits (a truncated row that stays adds TRUNCATED).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user or assistant turn from each state, by the initial that fits there.
_NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_ROLE = {"u": "user", "a": "assistant"}
#: What a row is: kept as it is, or its first fault.
FINE, BLANK, DUPLICATE, CUT = range(4)
_FAR = 1 << 60


def steps(initial: str, fault: int, many: int, state: int):
    """(letter, cost, state after) of the edits that read one row in ``state``.
    A row that stands for ``many`` equal ones can only be deleted."""
    yield "D", DELETE * many, state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault == CUT else 0
    wanted, after = _NEXT[state]
    if initial == wanted:
        yield "K", more, after
    else:
        if initial == "s" and state == START:
            yield "K", more, SYSTEM
        yield "R", REROLE + more, after


def solve(initials, faults, many, entry: int, exits: dict[int, int], ends: bool) -> tuple[int, str, int]:
    """(cost, least audit, exit state) of the cheapest path through the rows from
    state ``entry``, where leaving in a state of ``exits`` costs its value.
    Only in a conversation's last block (``ends``) may rows be inserted after
    the last row."""
    n = len(initials)
    back: dict[tuple[int, int], list] = {}  # edges into a node, made when it is first asked for

    def into(i: int, s: int):
        if (i, s) not in back:
            edges = []
            for t in range(4):
                if i:
                    edges += [(i - 1, t, a, c) for a, c, after in steps(initials[i - 1], faults[i - 1], many[i - 1], t) if after == s]
                if (i < n or ends) and _NEXT[t][1] == s:
                    edges.append((i, t, "I", INSERT))
            back[i, s] = edges
        return back[i, s]

    def out_of(i: int, s: int):
        if i < n:
            for a, c, after in steps(initials[i], faults[i], many[i], s):
                yield i + 1, after, a, c
        if i < n or ends:
            yield i, _NEXT[s][1], "I", INSERT

    # labels are (cost, audit); of equal cost the nodes nearer to the search's own
    # end come first, as only edges that read a row cost nothing
    ahead = {(0, entry): (0, "")}
    behind = {(n, s): (c, "") for s, c in exits.items()}
    fore = [(0, 0, entry)]
    rear = [(c, 0, s) for s, c in exits.items()]
    heapq.heapify(rear)
    seen_f: set[tuple[int, int]] = set()
    seen_r: set[tuple[int, int]] = set()
    best = min((c for s, c in exits.items() if n == 0 and s == entry), default=_FAR)
    while fore and rear and fore[0][0] + rear[0][0] <= best:
        if fore[0][0] <= rear[0][0]:
            cost, i, s = heapq.heappop(fore)
            if (i, s) in seen_f:
                continue
            seen_f.add((i, s))
            audit = ahead[i, s][1]
            for j, t, letter, c in out_of(i, s):
                label = (cost + c, audit + letter)
                old = ahead.get((j, t))
                if old is None or label < old:
                    ahead[j, t] = label
                    if old is None or label[0] < old[0]:
                        heapq.heappush(fore, (label[0], j, t))
                if (j, t) in behind:
                    best = min(best, label[0] + behind[j, t][0])
        else:
            cost, far, s = heapq.heappop(rear)
            i = n - far
            if (i, s) in seen_r:
                continue
            seen_r.add((i, s))
            audit = behind[i, s][1]
            for j, t, letter, c in into(i, s):
                label = (cost + c, letter + audit)
                old = behind.get((j, t))
                if old is None or label < old:
                    behind[j, t] = label
                    if old is None or label[0] < old[0]:
                        heapq.heappush(rear, (label[0], n - j, t))
                if (j, t) in ahead:
                    best = min(best, label[0] + ahead[j, t][0])
    # a cheapest path leaves the forward search's nodes once: there it crosses
    found = []
    for i, s in seen_f:
        cost, audit = ahead[i, s]
        if i == n and s in exits and cost + exits[s] == best:
            found.append(audit)
        for j, t, letter, c in out_of(i, s):
            if (j, t) not in seen_f and (j, t) in seen_r and cost + c + behind[j, t][0] == best:
                found.append(audit + letter + behind[j, t][1])
    if not found:  # nothing was left to the forward search
        found = [behind[0, entry][1]]
    audit = min(found)
    state, at = entry, 0
    for letter in audit:
        if letter == "I":
            state = _NEXT[state][1]
            continue
        state = next(after for a, _, after in steps(initials[at], faults[at], many[at], state) if a == letter)
        at += 1
    return best, audit, state


def cost_table(initials, faults, many) -> np.ndarray:
    """Least cost from each state before the rows to each state right after the last."""
    table = np.full((4, 4), _FAR)
    np.fill_diagonal(table, 0)
    enter = np.full((4, 4), _FAR)  # insertions before a row
    for s in range(4):
        t, cost = s, 0
        while cost < enter[s, t]:
            enter[s, t] = cost
            t, cost = _NEXT[t][1], cost + INSERT
    for initial, fault, n in zip(initials, faults, many):
        row = np.full((4, 4), _FAR)
        for s in range(4):
            for _, cost, after in steps(initial, fault, n, s):
                row[s, after] = min(row[s, after], cost)
        for step in (enter, row):
            table = np.minimum((table[:, :, None] + step[None, :, :]).min(axis=1), _FAR)
    return table


#: What leaving a conversation costs in each state: insertions up to an accepting one.
_END = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}


def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv, turn, role, text, n) after damage: ``conv`` is conv_id as
    text (one space for null), ``n`` counts equal rows and repetitions."""
    blank = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    rows = conversations.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                                F.pmod(F.crc32(F.encode(F.concat_ws(":", conv, turn), "UTF-8")), F.lit(20)).alias("hit"))
    rows = rows.where("hit <> 0").select(
        "conv", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("hit") == 3, 2).otherwise(1).cast("long").alias("n"))
    return rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _fault(text: Column, again: Column) -> Column:
    end = F.right(F.rtrim(text, F.lit("\x20\x09\x0a\x0b\x0c\x0d")), F.lit(1))
    return F.when(end == "", BLANK).when(again, DUPLICATE).when(~end.isin(".", "!", "?"), CUT).otherwise(FINE)


def _runs(batches, keys: int):
    """Tables of whole runs of equal first ``keys`` columns from sorted batches."""
    kept = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([kept, t]) if kept is not None and kept.num_rows else t
        if t.num_rows == 0:
            continue
        t = t.combine_chunks()
        columns = [np.asarray(t.column(c).to_pylist(), object) for c in range(keys)]
        other = np.flatnonzero(np.any([c != c[-1] for c in columns], axis=0))
        last = int(other[-1]) + 1 if len(other) else 0
        if last:
            yield t.slice(0, last)
        kept = t.slice(last)
    if kept is not None and kept.num_rows:
        yield kept


def _blocks(batches):
    """One row per block from its rows in order: the rows' initials, faults and
    counts, the cost table and what the block adds to the report."""
    for t in _runs(batches, 2):
        conv, block = t.column(0).to_pylist(), t.column(1).to_numpy()
        turns, initials = t.column(3).to_pylist(), t.column(4).to_pylist()
        fault, n = t.column(5).to_numpy(), t.column(6).to_numpy()
        cuts = [i for i in range(t.num_rows) if i == 0 or conv[i] != conv[i - 1] or block[i] != block[i - 1]] + [t.num_rows]
        out = {name: [] for name in ("conv", "block", "initials", "faults", "many", "costs", "first", "last", "counts",
                                     "low", "high", "turns")}
        for a, b in zip(cuts, cuts[1:]):
            # a row that stands for n equal ones is itself and a run of n - 1 duplicates
            row, fl, many = [], [], []
            for i in range(a, b):
                if fault[i] in (BLANK, DUPLICATE):
                    row.append(initials[i]), fl.append(int(fault[i])), many.append(int(n[i]))
                    continue
                row.append(initials[i]), fl.append(int(fault[i])), many.append(1)
                if n[i] > 1:
                    row.append(initials[i]), fl.append(DUPLICATE), many.append(int(n[i]) - 1)
            count = [sum(m for m, f in zip(many, fl) if f == kind) for kind in (BLANK, DUPLICATE, CUT)]
            legal = ("su", "ua", "au")
            wrong = sum(x + y not in legal for x, y in zip(row, row[1:]))
            wrong += sum((m - 1) * (x + x not in legal) for x, m in zip(row, many))
            known = [x for x in turns[a:b] if x is not None]
            for name, value in (("conv", conv[a]), ("block", block[a]), ("initials", row), ("faults", fl), ("many", many),
                                ("costs", cost_table(row, fl, many).ravel().tolist()), ("first", row[0]), ("last", row[-1]),
                                ("counts", [*count, wrong]), ("low", min(known, default=None)), ("high", max(known, default=None)),
                                ("turns", len(set(known)))):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out.values(), [
                pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()),
                pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()])], list(out))


_BLOCK_SCHEMA = ("conv string, block long, initials array<string>, faults array<int>, many array<long>, costs array<long>, "
                 "first string, last string, counts array<long>, low long, high long, turns long")


def _rests(batches):
    """From cost tables in order of (conv, block descending): for every block
    whether it is the first or the last of its conversation, and what leaving it
    in each state costs after it."""
    conv, after, held = None, None, None

    def batch(rows):
        names = ["conv", "block", "ends", "opens", "rest"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    for b in batches:
        out = []
        for c, block, costs in zip(*(x.to_pylist() for x in b.columns)):
            again = c == conv
            if held is not None:
                out.append((*held, not again))
            conv, after = c, after if again else [_END[s] for s in range(4)]
            held = (c, block, not again, after)
            after = [min(costs[4 * s + t] + after[t] for t in range(4)) for s in range(4)]
        if out:
            yield batch([(c, k, ends, opens, rest) for c, k, ends, rest, opens in out])
    if held is not None:
        yield batch([(*held[:3], True, held[3])])


def _solved(batches):
    """The solutions of every block for the entry states that it can have."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            exits = {START: 0, ASSISTANT: 0} if row["ends"] else dict(enumerate(row["rest"]))
            for entry in [START] if row["opens"] else range(4):
                cost, audit, left = solve(row["initials"], row["faults"], row["many"], entry, exits, row["ends"])
                letters, at = [], 0
                for letter in audit:  # write the runs out
                    letters.append(letter if letter == "I" else letter * row["many"][at])
                    at += letter != "I"
                out.append((row["conv"], row["block"], entry, cost, "".join(letters), left))
        if out:
            yield _batch(out)


def _batch(rows) -> pa.RecordBatch:
    names = ["conv", "block", "entry", "cost", "audit", "left"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)


def _chained(batches):
    """From solutions in order of (conv, block, entry): those that fit together."""
    conv, state, block = None, START, None
    for batch in batches:
        keep = []
        for i, (c, b, entry, left) in enumerate(zip(*(batch.column(x).to_pylist() for x in (0, 1, 2, 5)))):
            if c != conv:
                conv, state, block = c, START, None
            if b != block and entry == state:
                keep.append(i)
                block, state = b, left
        yield batch.take(pa.array(keep, pa.int64()))


def _hashed(batches):
    """From rows (conv, block, at, audit, role, text, n) in order, a block's audit
    before its rows: the hash of each conversation's repaired text."""
    conv, digest, letters, first, out = None, None, "", True, []

    def emit(line: str):
        nonlocal first
        digest.update(("" if first else "\n").encode() + line.encode("utf-8", "surrogatepass"))
        first = False

    state, at = START, 0

    def inserted():
        nonlocal state, at
        while at < len(letters) and letters[at] == "I":
            initial, state = _NEXT[state]
            emit(f"{_ROLE[initial]}:")
            at += 1

    for batch in batches:
        for c, audit, role, text, n in zip(*(batch.column(x).to_pylist() for x in (0, 3, 4, 5, 6))):
            if c != conv:
                if digest is not None:
                    inserted()
                    out.append((conv, digest.hexdigest()))
                conv, digest, letters, first, state, at = c, hashlib.sha256(), "", True, START, 0
            if audit is not None:
                inserted()  # what the last block adds at its end
                letters, at = audit, 0
                continue
            while n:
                inserted()
                letter, initial_, after = letters[at], *_NEXT[state]
                at, n = at + 1, n - 1
                if letter == "D":
                    continue
                if letter == "R":
                    role, state = _ROLE[initial_], after
                else:
                    state = SYSTEM if role[:1] == "s" else after
                emit(f"{role}:{text}")
        if len(out) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.string()) for x in zip(*out)], ["conv", "sha"])
            out = []
    if digest is not None:
        inserted()
        out.append((conv, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.string()) for x in zip(*out)], ["conv", "sha"])


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of the input: what is wrong after damage, the cost and
    audit of the cheapest repair, and the hash of the repaired conversation."""
    spark = conversations.sparkSession
    width = partitions(spark)
    rows = damage(conversations)
    key = F.sha2(F.concat(F.length("conv"), F.lit(":"), "conv", F.length("role"), F.lit(":"), "role", "text"), 256)
    rows = save(rows.withColumn("key", key), "chat-rows")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = rows.groupBy("key").agg(F.min(when).alias("first"), F.count("*").alias("size")).where("size > 1")
    judged = attach(rows, save(seen, "chat-seen"), "key", "size", rows.count())
    judged = judged.withColumn("fault", _fault(F.col("text"), F.coalesce(when > F.col("first"), F.lit(False))))
    order = ["conv", "turn", "role", "text"]
    at = F.monotonically_increasing_id()
    ordered = save(judged.repartitionByRange(width, "conv", "turn", "role", F.left("text", F.lit(64)))
                   .sortWithinPartitions(*order).withColumn("at", at)
                   .withColumn("block", F.shiftright("at", BLOCK.bit_length() - 1))
                   .select(*order, "n", "fault", "at", "block"), "chat-order")
    narrow = ordered.select("conv", "block", "at", "turn", F.left("role", F.lit(1)).alias("initial"), "fault", "n")
    blocks = save(narrow.repartition(width, "conv", "block").sortWithinPartitions("conv", "block", "at")
                  .mapInArrow(_blocks, _BLOCK_SCHEMA), "chat-blocks")
    rests = (blocks.select("conv", "block", "costs").repartition(width, "conv").sortWithinPartitions("conv", F.desc("block"))
             .mapInArrow(_rests, "conv string, block long, ends boolean, opens boolean, rest array<long>"))
    solved = blocks.select("conv", "block", "initials", "faults", "many").join(rests, ["conv", "block"]).mapInArrow(
        _solved, "conv string, block long, entry int, cost long, audit string, left int")
    chosen = save(solved.repartition(width, "conv").sortWithinPartitions("conv", "block", "entry")
                  .mapInArrow(_chained, "conv string, block long, entry int, cost long, audit string, left int"), "chat-audits")
    audits = chosen.groupBy("conv").agg(
        F.min_by("cost", "block").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    pieces = ordered.select("conv", "block", "at", F.lit(None).cast("string").alias("audit"), "role", "text", "n").unionByName(
        chosen.select("conv", "block", F.lit(-1).cast("long").alias("at"), "audit", F.lit(None).cast("string").alias("role"),
                      F.lit(None).cast("string").alias("text"), F.lit(None).cast("long").alias("n")))
    hashes = pieces.repartition(width, "conv").sortWithinPartitions("conv", "block", "at").mapInArrow(_hashed, "conv string, sha string")
    turns = ordered.select("conv", "turn").where("turn is not null").distinct().groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    seam = F.expr("lag(last) over (partition by conv order by block)")  # one row per block
    report = blocks.withColumn("seam", F.when(F.concat(seam, "first").isin("su", "ua", "au"), 0).when(seam.isNull(), 0).otherwise(1)).groupBy(
        "conv").agg(*[F.sum(F.col("counts")[i]).alias(name) for i, name in enumerate(["blank", "duplicate", "truncated"])],
                    (F.sum(F.col("counts")[3]) + F.sum("seam")).alias("illegal"))
    ids = conversations.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    out = ids.join(report, "conv", "left").join(turns, "conv", "left").join(audits, "conv", "left").join(hashes, "conv", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
