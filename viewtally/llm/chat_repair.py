"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``.  Each row is kept, given another role or deleted, and turns
may be inserted; the repair wanted has the least (cost, audit), ``audit``
being the initials of its edits.

Deduction.  The item (i, q) says: the first i rows are edited and what they
left brings the pattern to state q.  Its hyperedges are

    (i, q), edit e of row i   =>  (i + 1, e(q))     row edits
    (i, q)                    =>  (i, r(q))         an inserted turn of role r
    (n, q), q accepting       =>  goal

Each adds its cost and appends its letter to the audit.  That never lowers
(cost, audit), and for one item it keeps their order: two audits of equal
cost hold one letter for each of the same rows, so none is a proper prefix of
the other and appending the same letters changes nothing.  The functions are
thus monotone and superior, and the agenda pops every item with its final
value, up to the goal.

Long conversations.  Rows are cut into blocks, each block is solved for every
state it may start in, and the results are antecedents of a second deduction,
(k, q), path of block k from q to r  =>  (k + 1, r), whose results are blocks
of the next level.  A turn is inserted before a row or, at the goal, behind the last, so
no edit belongs to two blocks.  No task holds more rows than a block.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally.llm.common import NULL_ID, id_key, ordered, ranks, stage

# Fixed values of the repair rule.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}

#: pattern states: nothing yet, after s, after u, after a
EMPTY, SYSTEM, USER, DONE = range(4)
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): DONE, (DONE, "u"): USER}
ACCEPTS = (EMPTY, DONE)

BLOCK = 512     # rows solved together
FAN = 16        # blocks joined together

Path = tuple[int, str]
Item = tuple[int, int]


def lightest(axioms: dict[Item, Path], deduce: Callable[[Item, Path], Iterable[tuple[int, str, Item]]],
             goals: Iterable[Item]) -> dict[Item, Path]:
    """Least (cost, audit) of each of ``goals`` that can be derived.  An item
    is final when popped; ``deduce`` then gives what follows from it."""
    agenda = [(cost, audit, item) for item, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    final: dict[Item, Path] = {}
    open_ = set(goals)
    wanted = frozenset(open_)
    while agenda and open_:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        open_.discard(item)
        for more, letters, head in deduce(item, final[item]):
            if head not in final:
                heapq.heappush(agenda, (cost + more, audit + letters, head))
    return {item: final[item] for item in wanted & final.keys()}


def _edits(initial: str, fault: str) -> list[tuple[int, str, str]]:
    """(cost, letter, role initial left or '') of the edits of one row."""
    if fault == "x":
        return [(DELETE, "D", "")]
    late = TRUNCATED if fault == "t" else 0
    return [(DELETE, "D", ""), (KEEP + late, "K", initial),
            *((REROLE + late, "R", r) for r in ROLES if r != initial)]


def _inserts(q: int) -> Iterator[int]:
    return (STEP[q, r] for r in ROLES if (q, r) in STEP)


@functools.lru_cache(1 << 16)
def solve(initials: str, faults: str, starts: tuple[int, ...] = (EMPTY,), closing: bool = True) \
        -> dict[tuple[int, int], Path]:
    """(start state, end state) -> least (cost, audit) over rows of these role
    initials and faults ('x' must go, 't' truncated, '.' none).  ``closing``:
    the rows end the conversation, so paths end in an accepting state and
    turns may be inserted behind the last row."""
    n = len(initials)
    edits = [_edits(i, f) for i, f in zip(initials, faults)]

    def deduce(item: Item, _path: Path):
        i, q = item
        if i < n or closing:
            for r in _inserts(q):
                yield INSERT, "I", (i, r)
        if i < n:
            for cost, letter, left in edits[i]:
                r = STEP.get((q, left), -1) if left else q
                if r >= 0:
                    yield cost, letter, (i + 1, r)
        elif closing and q in ACCEPTS:
            yield 0, "", (n + 1, DONE)

    ends = [(n + 1, DONE)] if closing else [(n, q) for q in range(4)]
    return {(s, q): path for s in starts
            for (_, q), path in lightest({(0, s): (0, "")}, deduce, ends).items()}


def join_paths(parts: list[dict[tuple[int, int], Path]], starts: Iterable[int] = range(4)) \
        -> dict[tuple[int, int], Path]:
    """Paths over consecutive blocks from the paths over each."""
    def deduce(item: Item, _path: Path):
        k, q = item
        if k < len(parts):
            for (start, stop), (cost, audit) in parts[k].items():
                if start == q:
                    yield cost, audit, (k + 1, stop)

    return {(s, q): path for s in starts
            for (_, q), path in lightest({(0, s): (0, "")}, deduce, [(len(parts), q) for q in range(4)]).items()}


def close(paths: dict[tuple[int, int], Path]) -> Path:
    """The conversation's repair from its paths: turns inserted at the end."""
    tail = solve("", "", tuple(range(4)))
    return min((cost + tail[q, DONE][0], audit + tail[q, DONE][1])
               for (s, q), (cost, audit) in paths.items() if s == EMPTY)


def illegal_pairs(initials: str) -> int:
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


_SUMMARY = ("struct<illegal:bigint,head:string,tail:string,"
            "paths:array<struct<start:int,stop:int,cost:bigint,audit:string>>>")


def _series(returns: str):
    """A pandas UDF made where it is used: parsing ``returns`` needs a session."""
    def wrap(f):
        @functools.wraps(f)
        def call(*cols) -> Column:
            return F.pandas_udf(f, returns)(*cols)
        return call
    return wrap


def _told(paths: dict[tuple[int, int], Path]) -> list[tuple]:
    return [(s, q, c, a) for (s, q), (c, a) in sorted(paths.items())]


def _read(paths) -> dict[tuple[int, int], Path]:
    return {(p["start"], p["stop"]): (p["cost"], p["audit"]) for p in paths}


@_series(_SUMMARY)
def _block(initials: pd.Series, faults: pd.Series, first: pd.Series, whole: pd.Series) -> pd.DataFrame:
    out = []
    for i, f, a, w in zip(initials, faults, first, whole):
        starts = (EMPTY,) if a else tuple(range(4))
        out.append((illegal_pairs(i), i[:1], i[-1:], _told(solve(i, f, starts, bool(w)))))
    return pd.DataFrame(out, columns=["illegal", "head", "tail", "paths"])


@_series(_SUMMARY)
def _joined(parts: pd.Series) -> pd.DataFrame:
    out = []
    for ps in parts:
        ends = [p["s"]["tail"] + q["s"]["head"] for p, q in zip(ps, ps[1:])]
        out.append((sum(p["s"]["illegal"] for p in ps) + sum(illegal_pairs(e) for e in ends),
                    ps[0]["s"]["head"], ps[-1]["s"]["tail"],
                    _told(join_paths([_read(p["s"]["paths"]) for p in ps]))))
    return pd.DataFrame(out, columns=["illegal", "head", "tail", "paths"])


@_series("struct<cost:bigint,audit:string>")
def _closed(paths: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([close(_read(p)) for p in paths], columns=["cost", "audit"])


def _slices(block: int):
    @_series("array<struct<blk:bigint,letters:string,seq:bigint,left:bigint>>")
    def cut(audits: pd.Series) -> pd.Series:
        """The audit of each block of rows, the number of its first edit and
        of the turns left before it (system turn not counted)."""
        out = []
        for audit in audits:
            # an odd number of turns is left only if the first is a system turn
            left = -((len(audit) - audit.count("D")) % 2)
            parts, start, rows = [], 0, 0
            for at, letter in enumerate(audit):
                rows += letter != "I"
                if letter != "I" and rows % block == 0:
                    parts.append((start, at + 1))
                    start = at + 1
            if start < len(audit):
                parts.append((start, len(audit)))
            if len(parts) > 1 and rows and rows % block == 0 and start < len(audit):
                parts[-2:] = [(parts[-2][0], len(audit))]       # turns behind the last row
            told = []
            for k, (a, b) in enumerate(parts):
                told.append((k, audit[a:b], a, left))
                left += b - a - audit.count("D", a, b)
            out.append(told)
        return pd.Series(out)
    return cut


@_series("array<struct<seq:bigint,edit:string,row:int,role:string>>")
def _spelled(letters: pd.Series, seqs: pd.Series, lefts: pd.Series) -> pd.Series:
    """One struct per edit: its number, letter, row in the block (from 1; null:
    inserted) and the role it sets (null: the row's own)."""
    out = []
    for text, seq, left in zip(letters, seqs, lefts):
        told, row = [], 0
        for k, letter in enumerate(text):
            row += letter != "I"
            role = "ua"[left % 2] if letter in "RI" else None
            told.append((seq + k, letter, None if letter == "I" else row, ROLES.get(role)))
            left += letter != "D"
        out.append(told)
    return pd.Series(out)


def faults(text: Column) -> tuple[Column, Column]:
    """(blank, truncated) of a text."""
    core = F.rtrim(text, F.lit(SPACE))
    return core == "", ~F.right(core, F.lit(1)).isin(".", "!", "?")


def repair(turns: DataFrame, block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """``turns`` (conv_id, turn, role, text) -> conversations and edits.

    conversations: conv_id, n_turns, gaps, blank, duplicate, truncated, illegal,
    cost, audit.  edits, one row per edit in order: conv_id, seq (from 0), edit
    (K, R, D or I), turn (null: inserted), role, text as the edit leaves them
    (a deleted row's own).

    Null role and text are empty.  Rows go by (turn, role, a hash of the text), nulls first;
    rows equal in these follow each other.  Repeated rows are duplicates; null conv_ids
    are one conversation.  A role whose initial is not s, u or a can't be kept.
    Texts of any length are read whole.  An empty table gives no rows; other
    columns are not looked at.  The audit of a conversation is one value, a
    byte for each edit.
    """
    text = F.coalesce("text", F.lit(""))
    rows = turns.select(id_key("conv_id").alias("_c"), F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
                        F.xxhash64(text).alias("_th"))
    placed = ordered(rows, ["_c", "turn", "role", "_th"], "turns")
    blank, truncated = faults(F.col("text"))
    initial = F.left("role", F.lit(1))
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    narrow = stage(placed.select("_c", "_at", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("i"),
                                 F.when(blank, "b").when(truncated, "t").otherwise(".").alias("f"), same.alias("same")),
                   "narrow")
    # the first of equal rows, by a number no two rows share: no group meets in a task
    first = narrow.groupBy("_c", "same").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("_new"))
    fault = F.when(F.col("f") == "b", "b").when(F.col("_new").isNull(), "d").otherwise(F.col("f"))
    told = ranks(narrow.drop("same").join(first, "_at", "left").withColumn("f", fault).drop("_new"),
                 ["_c"], "pos", narrow).withColumn("pos", F.col("pos") - 1)
    told = stage(told, "faults")
    of = lambda f: F.count(F.when(F.col("f") == f, 1))
    turns_seen = told.filter("turn is not null").groupBy("_c", "turn").agg(F.lit(1).alias("_one")).groupBy("_c") \
        .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    per = (told.groupBy("_c").agg(F.count(F.lit(1)).alias("n_turns"), of("b").alias("blank"),
                                  of("d").alias("duplicate"), of("t").alias("truncated"))
           .join(turns_seen, "_c", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)).cast("bigint")))
    per = stage(per, "counts")

    cell = F.sort_array(F.collect_list(F.struct("pos", "i", F.when(F.col("f").isin("b", "d"), "x").otherwise(F.col("f")).alias("f"), "_at")))
    blocks = (told.withColumn("blk", F.floor(F.col("pos") / block).cast("bigint"))
              .groupBy("_c", "blk").agg(cell.alias("rows"))
              .join(per.select("_c", "n_turns"), "_c")
              .select("_c", "blk", F.array_join(F.transform("rows", lambda x: x["i"]), "").alias("i"),
                      F.array_join(F.transform("rows", lambda x: x["f"]), "").alias("f"),
                      F.transform("rows", lambda x: x["_at"]).alias("ats"), (F.col("n_turns") <= block).alias("whole")))
    solved = stage(blocks.select("_c", "blk", "ats", "whole",
                                 _block("i", "f", F.col("blk") == 0, "whole").alias("s")), "blocks")
    level = solved.filter("not whole").select("_c", "blk", "s")
    most = per.agg(F.max("n_turns")).first()[0] or 0
    n = -(-most // block)
    while n > 1:
        level = stage(level.groupBy("_c", F.floor(F.col("blk") / fan).cast("bigint").alias("blk"))
                      .agg(F.sort_array(F.collect_list(F.struct("blk", "s"))).alias("parts"))
                      .select("_c", "blk", _joined("parts").alias("s")), "level")
        n = -(-n // fan)
    short = solved.filter("whole").select("_c", "s.illegal", F.col("s.paths")[0]["cost"].alias("cost"),
                                          F.col("s.paths")[0]["audit"].alias("audit"))
    long_ = (level.select("_c", "s.illegal", _closed("s.paths").alias("r"))
             .select("_c", "illegal", "r.cost", "r.audit"))
    best = stage(short.union(long_), "audits")

    letters = (best.select("_c", F.explode(_slices(block)("audit")).alias("p")).select("_c", "p.*")
               .join(solved.select("_c", "blk", "ats"), ["_c", "blk"])
               .select("_c", "ats", F.explode(_spelled("letters", "seq", "left")).alias("e"))
               .select("_c", "e.seq", "e.edit", F.col("e.role").alias("_role"),
                       F.when(F.col("e.row").isNotNull(), F.element_at("ats", F.col("e.row"))).alias("_at")))
    letters = stage(letters, "edits")
    real = (letters.filter("_at is not null").join(placed.select("_at", "turn", "role", "text"), "_at")
            .select("_c", "seq", "edit", "turn", F.coalesce("_role", "role").alias("role"), "text"))
    new = letters.filter("_at is null").select("_c", "seq", "edit", F.lit(None).cast("bigint").alias("turn"),
                                               F.col("_role").alias("role"), F.lit("").alias("text"))
    conv = F.when(F.col("_c") != NULL_ID, F.col("_c")).alias("conv_id")
    edits = real.union(new).select(conv, "seq", "edit", "turn", "role", "text")
    conversations = per.join(best, "_c").select(conv, "n_turns", "gaps", "blank", "duplicate", "truncated",
                                                "illegal", "cost", "audit")
    return conversations, edits


def repaired_digests(edits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 (of ``role:text`` of the turns left, in order,
    joined by newlines), for conversations that keep a turn.  A digest is
    sequential: a conversation's turns pass one task as a stream, and only the
    digest's state is held."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            ids, sums = [], []
            for c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or c != now:
                    if state is not None:
                        ids.append(now)
                        sums.append(state.hexdigest())
                    now, state = c, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sums, pa.string())], ["_c", "repaired_sha256"])
        if state is not None:
            yield pa.record_batch([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["_c", "repaired_sha256"])

    lines = (edits.filter("edit <> 'D'")
             .select(id_key("conv_id").alias("_c"), F.concat("role", F.lit(":"), "text").alias("line"), "seq")
             .repartition("_c").sortWithinPartitions("_c", "seq").select("_c", "line"))
    return lines.mapInArrow(digest, "_c bigint, repaired_sha256 string").select(
        F.when(F.col("_c") != NULL_ID, F.col("_c")).alias("conv_id"), "repaired_sha256")


def damaged(turns: DataFrame) -> DataFrame:
    """The test damage: by crc32 of ``conv_id:turn`` modulo 20 a row is dropped
    (0), emptied (1), loses its ``[.!?]`` (2), is repeated (3) or becomes a
    user's (4).  A null is one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    text = told("text")
    return (turns.select("conv_id", "turn", told("role").alias("role"), text.alias("text"), code.alias("_d"))
            .filter("_d <> 0")
            .withColumn("text", F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ".!?", ""))
                        .otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")))
            .withColumn("_n", F.explode(F.array_repeat(F.lit(1), F.when(F.col("_d") == 3, 2).otherwise(1))))
            .select("conv_id", "turn", "role", "text"))


def repair_damaged(turns: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Every conv_id of ``turns`` with the repair of its damaged rows: gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    conversations, edits = repair(damaged(turns), block, fan)
    ids = turns.select(id_key("conv_id").alias("_c")).distinct()
    keyed = lambda df: df.withColumn("_c", id_key("conv_id")).drop("conv_id")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (ids.join(keyed(conversations), "_c", "left").join(keyed(repaired_digests(edits)), "_c", "left")
            .select(F.when(F.col("_c") != NULL_ID, F.col("_c")).alias("conv_id"),
                    *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", none).alias("repaired_sha256")))
